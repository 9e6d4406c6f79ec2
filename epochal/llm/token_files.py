"""Token-ID files with constant-time keyed access.

Texts are encoded and written as raw ids in ascending doc_id order: a shard per part of the order,
each a header of 16 bytes and then little-endian ids, of 16 bits where the vocabulary allows it. A
minimal perfect hash maps each key (doc_id and its how-manieth row of that doc_id) to a slot that
holds a fingerprint of the key, the shard, the offset and the number of ids. The hash is built per
bucket of some thousands of keys: in each of its levels the keys that fall alone take a bit, the
others go on; a key's slot is the rank of its bit. After LEVELS levels only keys whose 64-bit hashes
are equal are left: these few stand in a list beside the hash, with the slots after all others.

Shards are written under a temporary name and then renamed, so a task that is run again leaves the
same file. They go to the shared folder of the session, never to a local one of a cluster.

Defined results: a null text is empty and holds the end id only; null doc_ids come first; rows with
one doc_id are rows of their own, numbered over all parts of the order (ties by row hash, and then by
place, so that a row that repeats very often is spread over parts); an empty table gives no rows; other columns are
not read. A key that is not in the index is not found but for one in 65,536 by its fingerprint.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

#: Id that ends each document; ids in a shard at most; keys in a bucket of the index.
END, SHARD_IDS, BUCKET = 1, 1 << 27, 16384
#: Levels of a bucket's hash at most.
LEVELS = 64
#: Words and parts of words that a Python worker remembers in each of two generations: the older one is
#: dropped when the younger is full, but for what has been met again meanwhile.
REMEMBERED = 300_000
#: Header: magic, bytes of an id, number of the shard.
MAGIC, HEADER, HEADER_BYTES = b"EPOIDS01", "<8sII", 16
#: Words that fall into one run of Latin letters and one of marks: the tokenizer's pattern splits them so too.
SIMPLE = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]*)([!#$%&()*+,\-./:;=?@|~]*)").fullmatch

#: The one mark between an ASCII letter and white space.
MARK = re.compile(rb"([!,\-.:;?)])(?=[\x09-\x0d\x20])(?<=[a-z].)").sub


#: What a tokenizer's file has where texts may be encoded by words: it lower-cases, white space only separates,
#: letters and marks are words of their own, and the last token of a word ends so.
BY_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
WORD_END = "</w>"


def by_words(path: str) -> bool:
    """Whether a tokenizer's file is of that kind; texts of others are encoded whole."""
    with open(path, encoding="utf-8") as lines:
        given = json.load(lines)
    model = given["model"]
    alone = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in given["added_tokens"])
    return alone and model.get("type") == "BPE" and model.get("end_of_word_suffix") == WORD_END and not model.get("dropout") and all(given[k] == v for k, v in BY_WORDS.items())


class Words:
    """Encodes texts word by word where by_words says that a text's ids are its words' ids, other tokenizers' whole.

    New words are split into letters and marks where that is plain, and these parts go to the
    tokenizer many at a time; the last id of each part is one that ends a word. Other words go alone.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.plain, self.memory = by_words(path), f"token files {path}"
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.width = int(self.kind[-1])
        self.as_they_are = [b"\xcc", b"\xcd", *(t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values())]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True

    def parts(self, new: list[str]) -> list[bytes]:
        """Packed ids of parts, each of them one word to the tokenizer."""
        out = []
        for lo in range(0, len(new), 512):
            some = new[lo : lo + 512]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):  # the tokenizer sees other words than we do: one at a time
                out += [self.alone(w) for w in some]
                continue
            packed, last = ids.tobytes(), 0
            for cut in (cuts * self.width).tolist():
                out.append(packed[last:cut])
                last = cut
        return out

    def alone(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, self.kind).tobytes()

    def learn(self, new: set[bytes], seen: dict[bytes, bytes], before: dict[bytes, bytes]) -> None:
        """Adds the ids of new words, and of their parts, to those seen; parts may be known from before."""
        pairs, want = [], {}
        for w in new:
            text = w.decode("utf-8", "surrogatepass")
            found = SIMPLE(text)
            if found is None:
                seen[w] = self.alone(text)
                continue
            letters, marks = found.groups()
            letters = letters.lower()
            if marks or letters != text:
                at, to = letters.encode(), marks.encode()
                pairs.append((w, at, to))
                for part, as_text in ((at, letters), (to, marks)):
                    if part and part not in seen:
                        if part in before:
                            seen[part] = before[part]
                        else:
                            want[part] = as_text
            else:
                want[w] = text
        seen.update(zip(want, self.parts(list(want.values())), strict=True))
        seen[b""] = b""
        for w, at, to in pairs:
            seen[w] = seen[at] + seen[to]

    def words(self, text: str) -> list[bytes]:
        """A text's words as UTF-8, split at ASCII white space only, as this tokenizer does.

        It lower-cases and splits off marks itself; done here already where that is plain, fewer words
        are new. A-Z stay where a combining mark (U+0300 to U+037F) may follow, which makes one character
        of some small letters but not of the large ones, and where small letters may name a special token.
        """
        data = text.encode("utf-8", "surrogatepass")
        small = data.lower()
        if not any(x in small for x in self.as_they_are):
            data = small
        return MARK(rb" \1", data).split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids and the end id, packed."""
        end = np.array([END], self.kind).tobytes()
        if not self.plain:
            return [self.alone(t) + end for t in texts]
        held = common.remembered(self.memory)
        seen, before = held.setdefault("younger", {}), held.setdefault("older", {})
        split = [self.words(t) for t in texts]
        new = set().union(*split).difference(seen)
        if len(seen) + len(new) > REMEMBERED:
            before, seen = seen, {}
            held.update(younger=seen, older=before)
            new = set().union(*split)
        known = new.intersection(before)
        seen.update(zip(known, map(before.__getitem__, known), strict=True))
        self.learn(new - known, seen, before)
        get = seen.__getitem__
        return [b"".join(map(get, words)) + end for words in split]


@functools.lru_cache(maxsize=2)
def words(path: str) -> Words:
    """One encoder in each Python worker."""
    return Words(path)


def open_folder(uri: str):
    """File system and path of a folder's URI, as executors reach it."""
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


ENTRIES = "doc_id long, occurrence long, shard long, at long, n long"


def write(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Writes the shards; doc_id, occurrence, shard, at (ids before it in the shard), n, pinned by a checkpoint."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("rid"), F.col("tie")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("rid"), F.monotonically_increasing_id().alias("tie"))
    rows = rows.repartitionByRange(common.partitions(docs.sparkSession), *order).sortWithinPartitions(*order).select("doc_id", "text")

    def save(batches):
        encoder, part = words(path), TaskContext.get().partitionId()
        where, base = open_folder(folder)
        out, name, shard, at, last, seen = None, "", part << 20, 0, object(), 0

        def close():
            if out is not None:
                out.close()
                where.move(f"{base}/{name}", f"{base}/shard-{shard:016d}.ids")

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            packed = encoder.encode(batch.column("text").to_pylist())
            entries = []
            for doc_id, data in zip(ids, packed, strict=True):
                n = len(data) // encoder.width
                if out is None or at and at + n > SHARD_IDS:
                    close()
                    shard, at, name = shard + (out is not None), 0, f"writing-{uuid.uuid4().hex}"
                    out = where.open_output_stream(f"{base}/{name}", buffer_size=1 << 20)
                    out.write(struct.pack(HEADER, MAGIC, encoder.width, shard & 0xFFFFFFFF))
                out.write(data)
                seen = seen + 1 if doc_id == last else 0
                last = doc_id
                entries.append((doc_id, seen, shard, at, n))
                at += n
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*entries, strict=True)], ["doc_id", "occurrence", "shard", "at", "n"])
        close()

    return occurrences(rows.mapInArrow(save, ENTRIES).checkpoint())


def occurrences(entries: DataFrame) -> DataFrame:
    """Entries whose occurrences, counted in each part of the order, go on from the parts before.

    Only the doc_id that a part begins with can have rows before it; they are at the ends of the parts
    before. So one row a part carries the numbers over.
    """
    null, part = F.col("doc_id").isNull(), F.shiftright("shard", 20)
    rows = entries.select("*", part.alias("_part"), F.struct((~null).alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id")).alias("_doc"))
    ends = rows.groupBy("_part").agg(F.min("_doc").alias("first"), F.max(F.struct("_doc", "occurrence")).alias("last"))
    first = ends.select("_part", F.col("first").alias("_doc"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("n"))
    last = ends.select("_part", F.col("last._doc").alias("_doc"), F.lit(1).alias("side"), (F.col("last.occurrence") + 1).alias("n"))
    so_far = Window.partitionBy("_doc").orderBy("_part", "side").rowsBetween(Window.unboundedPreceding, -1)  # two rows a part at most
    carried = first.unionByName(last).withColumn("before", F.coalesce(F.sum("n").over(so_far), F.lit(0))).filter("side = 0").select("_part", "_doc", "before")
    joined = rows.join(F.broadcast(carried), ["_part", "_doc"], "left")  # as many rows as parts
    return joined.select("doc_id", (F.col("occurrence") + F.coalesce("before", F.lit(0))).alias("occurrence"), "shard", "at", "n").checkpoint()


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit hash of 64-bit hashes for each level."""
    with np.errstate(over="ignore"):
        x = keys ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(29))


def build(keys: np.ndarray, room: float = 1.5) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels, their bits, one after another, and the places of keys that fall on none. keys: 64-bit hashes."""
    sizes, bits, left = [], [], np.arange(len(keys))
    while len(left) and len(sizes) < LEVELS:
        size = max(8, int(len(left) * room))
        at = (_mix(keys[left], len(sizes)) % np.uint64(size)).astype("i8")
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), left


def slots(keys: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of each key; -1 for one that falls on no bit."""
    ranks, out = np.cumsum(bits) - 1, np.full(len(keys), -1, "i8")
    left, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = base + (_mix(keys[left], level) % np.uint64(size)).astype("i8")
        hit = bits[at]
        out[left[hit]] = ranks[at[hit]]
        left, base = left[~hit], base + size
    return out


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1 << 20) >> np.uint64(40)).astype("u2")


def _key(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("key", F.xxhash64("doc_id", "occurrence", F.col("doc_id").isNull())).withColumn("bucket", F.pmod(F.hash("key"), F.lit(buckets)).cast("long"))


INDEX = "bucket long, levels array<long>, bits binary, listed array<string>, fingerprints binary, shards binary, ats binary, ns binary"


def index(entries: DataFrame, buckets: int) -> DataFrame:
    """One row a bucket: the levels and bits of its hash, the keys listed beside it, and in slot order fingerprints, shards, offsets and numbers of ids."""

    def one(group: pa.Table) -> pa.Table:
        common.remembered("id files")
        keys = group["key"].to_numpy().astype("i8").view("u8")
        sizes, bits, left = build(keys)
        slot = slots(keys, sizes, bits)
        slot[left] = len(keys) - len(left) + np.arange(len(left))
        by_slot = np.empty(len(keys), "i8")
        by_slot[slot] = np.arange(len(keys))
        column = lambda c, kind: group[c].to_numpy()[by_slot].astype(kind).tobytes()
        row = {"bucket": group["bucket"][0].as_py(), "levels": sizes, "bits": np.packbits(bits).tobytes(), "listed": _names(group.take(pa.array(left))), "fingerprints": _fingerprint(keys)[by_slot].tobytes()}
        return pa.Table.from_pylist([row | {"shards": column("shard", "i8"), "ats": column("at", "i8"), "ns": column("n", "i8")}], _index_schema())

    return _key(entries, buckets).groupBy("bucket").applyInArrow(one, INDEX)


def _index_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "binary": pa.binary()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in INDEX.split(", ")])


def _names(group: pa.Table) -> list[str]:
    """Keys as they are, for those that no hash tells apart."""
    return [f"{d} {k}" for d, k in zip(group["doc_id"].to_pylist(), group["occurrence"].to_pylist(), strict=True)]


def lookup(keys: DataFrame, indexed: DataFrame, buckets: int) -> DataFrame:
    """doc_id, occurrence, shard, at, n of each key (doc_id, occurrence) that the index holds."""
    schema = pa.schema([(f.split()[0], pa.int64()) for f in ENTRIES.split(", ")])

    def find(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not len(asked) or not len(held):
            return schema.empty_table()
        row = {c: held[c][0].as_py() for c in held.column_names}
        keys = asked["key"].to_numpy().astype("i8").view("u8")
        bits = np.unpackbits(np.frombuffer(row["bits"], "u1"), count=sum(row["levels"])).astype(bool)
        slot = slots(keys, row["levels"], bits)
        if row["listed"]:
            listed, missed = {name: i for i, name in enumerate(row["listed"])}, np.flatnonzero(slot < 0)
            slot[missed] = [listed.get(name, -1 - bits.sum()) + bits.sum() for name in _names(asked.take(pa.array(missed)))]
        good = (slot >= 0) & (np.frombuffer(row["fingerprints"], "u2")[slot] == _fingerprint(keys))
        asked, slot = asked.filter(pa.array(good)), slot[good]
        columns = [pa.array(np.frombuffer(row[c], "i8")[slot]) for c in ("shards", "ats", "ns")]
        return pa.Table.from_arrays([asked["doc_id"], asked["occurrence"], *columns], schema=schema)

    return _key(keys, buckets).groupBy("bucket").cogroup(indexed.groupBy("bucket")).applyInArrow(find, ENTRIES)


def fetch(found: DataFrame, folder: str) -> DataFrame:
    """Adds ids (little-endian 32-bit integers), read from the shards; rows are dealt in the order of shards."""
    near = found.repartitionByRange(common.partitions(found.sparkSession), "shard", "at").sortWithinPartitions("shard", "at")

    def read(batches):
        common.remembered("id files")  # a worker that encoded before forgets its words
        where, base = open_folder(folder)
        held, file, width = None, None, 0
        for batch in batches:
            ids = []
            for shard, at, n in zip(*[batch.column(c).to_pylist() for c in ("shard", "at", "n")], strict=True):
                if shard != held:
                    if file is not None:
                        file.close()
                    file, held = where.open_input_file(f"{base}/shard-{shard:016d}.ids"), shard
                    magic, width, _ = struct.unpack(HEADER, file.read_at(HEADER_BYTES, 0))
                    if magic != MAGIC:
                        raise ValueError(f"shard {shard} is no id file")
                ids.append(np.frombuffer(file.read_at(n * width, HEADER_BYTES + at * width), f"<u{width}").astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], [*batch.schema.names, "ids"])

    return near.mapInArrow(read, f"{ENTRIES}, ids binary")


def new_folder(spark: SparkSession) -> str:
    common.prepare(spark)
    folder = f"{common.checkpoint_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    where, base = open_folder(folder)
    where.create_dir(base, recursive=True)
    return folder


def store(docs: DataFrame, path: str, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Writes shards and index: the entries, the shards' first ids (shard, start), the index and its number of buckets."""
    entries = write(docs, path, folder)
    shards = entries.groupBy("shard").agg(F.sum("n").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    shards = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    buckets = max(1, entries.count() // BUCKET)
    index(entries, buckets).write.parquet(f"{folder}/index")
    return entries, shards, docs.sparkSession.read.parquet(f"{folder}/index"), buckets


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document, read back by its key: doc_id, start, n_tokens, ids_crc32, shard, at."""
    spark = docs.sparkSession
    folder = new_folder(spark)
    entries, shards, indexed, buckets = store(docs, path, folder)
    read = fetch(lookup(entries.select("doc_id", "occurrence"), indexed, buckets), folder)

    def crc(batches):
        for batch in batches:
            crcs = [zlib.crc32(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "shard", "at", "n")], pa.array(crcs, pa.int64())], ["doc_id", "shard", "at", "n", "crc"])

    got = read.mapInArrow(crc, "doc_id long, shard long, at long, n long, crc long")
    return got.join(F.broadcast(shards), "shard").select("doc_id", (F.col("start") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"), "shard", "at")
