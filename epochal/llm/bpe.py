"""Byte-level BPE: overlapping chunk encoding and decoding.

A long text is cut into chunks that overlap; the chunks are dealt out and pre-tokenised in
parallel. A chunk that starts inside a pre-token is wrong at first, but the pattern looks only
ahead: from the first boundary that two neighbouring chunks share, both go on alike. The texts are
stitched there, and each piece's ids are kept up to the stitch. Short texts are one chunk and need
no stitch. Decoding concatenates the raw bytes of the ids.

Defined results: a null text is an empty text without ids; rows that repeat each get their result;
a null doc_id is kept; an empty table gives no rows; other columns are not read. If two chunks share
no boundary in their overlap (a run without any boundary), the text is encoded in one piece.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Code points of a chunk and of the overlap with the next one.
CHUNK, OVERLAP = 32768, 512


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the adjacent pair with the lowest rank is joined, until none has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > 256:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    costs = [ranks.get(a + b, 1 << 30) for a, b in zip(parts, parts[1:], strict=False)]
    while costs:
        best = min(costs)
        if best == 1 << 30:
            break
        i = costs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del costs[i]
        if i:
            costs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
        if i < len(costs):
            costs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """merge() for long runs, by a heap over a linked list, so that its time stays near linear."""
    import heapq

    n = len(piece)
    ends, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := ranks.get(piece[i : ends[j]])) is not None:
            heapq.heappush(heap, (rank, i, ends[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or (j := after[i]) >= n or ends[j] != end:
            continue
        alive[j], ends[i], after[i] = False, end, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[piece[i : ends[i]]] for i in range(n) if alive[i]]


class Codec:
    """Encodes and decodes with the ranks of a file; remembers the ids of frequent pre-tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.memory = f"bpe {path}"  # ids are of these ranks only

    def packed(self, token: str) -> bytes:
        """The ids of a pre-token as little-endian 32-bit integers."""
        seen = common.remembered(self.memory)
        got = seen.get(token)
        if got is None:
            got = np.array(merge(token.encode("utf-8", "surrogatepass"), self.ranks), "<u4").tobytes()
            if len(token) < 64:
                if len(seen) >= common.REMEMBERED:
                    seen.clear()
                seen[token] = got
        return got

    def pretokens(self, text: str) -> list[str]:
        return self.find(text)

    def encode(self, text: str) -> bytes:
        seen, packed = common.remembered(self.memory), self.packed
        return b"".join([seen.get(t) or packed(t) for t in self.find(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec in each Python worker."""
    return Codec(path, pattern)


def _whole(path: str, pattern: str):
    def encode(batches):
        c = codec(path, pattern)
        for batch in batches:
            ids = [c.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return encode


def _chunks(path: str, pattern: str, chunk: int, overlap: int):
    """Ids of each chunk, with the boundaries in its head and tail and the ids before each of them."""

    def encode(batches):
        c = codec(path, pattern)
        for batch in batches:
            out = {"ids": [], "head_at": [], "head_ids": [], "tail_at": [], "tail_ids": []}
            for text in batch.column("text").to_pylist():
                tokens = c.pretokens(text)
                packs = [c.packed(t) for t in tokens]
                at = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype("i8")
                ids = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packs])]).astype("i8")
                head, tail = at < overlap, (at >= chunk) & (np.arange(len(at)) < len(at) - 2)  # the last pre-tokens may be cut short
                out["ids"].append(b"".join(packs))
                for name, keep, shift in (("head", head, 0), ("tail", tail, chunk)):
                    out[f"{name}_at"].append((at[keep] - shift).tolist())
                    out[f"{name}_ids"].append(ids[keep].tolist())
            arrays = [batch.column(k) for k in ("doc_id", "rid", "no", "chunks")]
            arrays += [pa.array(out["ids"], pa.binary())] + [pa.array(out[k], pa.list_(pa.int64())) for k in ("head_at", "head_ids", "tail_at", "tail_ids")]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "rid", "no", "chunks", "ids", "head_at", "head_ids", "tail_at", "tail_ids"])

    return encode


def stitch(parts: list[dict]) -> bytes | None:
    """Joins the ids of a text's chunks, in order; None if two neighbours share no boundary."""
    out, start = [], 0
    for this, after in zip(parts, [*parts[1:], None], strict=True):
        if after is None:
            out.append(this["ids"][4 * start :])
            break
        tail, head = list(this["tail_at"]), list(after["head_at"])
        shared = min(set(tail) & set(head), default=None)
        if shared is None:
            return None
        out.append(this["ids"][4 * start : 4 * int(this["tail_ids"][bisect_left(tail, shared)])])
        start = int(after["head_ids"][bisect_left(head, shared)])
    return b"".join(out)


def _stitched(groups: pa.Table) -> pa.Table:
    rows = sorted(groups.to_pylist(), key=lambda r: r["no"])
    firsts = [r for r in rows if r["no"] == 0]  # rows that repeat bring their chunks again
    parts = [r for i, r in enumerate(rows) if i == 0 or rows[i - 1]["no"] != r["no"]]
    ids = stitch(parts)
    return pa.table({"doc_id": pa.array([r["doc_id"] for r in firsts], pa.int64()), "rid": pa.array([r["rid"] for r in firsts], pa.string()), "ids": pa.array([ids] * len(firsts), pa.binary())})


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, ids: the ids of every text as little-endian 32-bit integers."""
    common.prepare(docs.sparkSession)
    length = F.coalesce(F.length("text"), F.lit(0))
    short = docs.filter(length <= chunk + overlap).select(F.col("doc_id").cast("long"), "text")
    whole = short.mapInArrow(_whole(path, pattern), "doc_id long, ids binary")
    long = docs.filter(length > chunk + overlap).select(F.col("doc_id").cast("long").alias("doc_id"), "text", common.row_key(F.col("doc_id"), F.col("text")).alias("rid"))
    chunks = F.ceil((F.length("text") - overlap) / chunk).cast("int")
    cut = long.withColumn("chunks", chunks).withColumn("no", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    last = F.col("no") == F.col("chunks") - 1
    cut = cut.select("doc_id", "rid", "no", "chunks", F.substring("text", F.col("no") * chunk + 1, F.when(last, F.lit(chunk * 2 + overlap)).otherwise(F.lit(chunk + overlap))).alias("text"))
    cut = cut.repartition(common.partitions(docs.sparkSession), "rid", "no")
    kinds = "doc_id long, rid string, no int, chunks int, ids binary, head_at array<long>, head_ids array<long>, tail_at array<long>, tail_ids array<long>"
    parts = cut.mapInArrow(_chunks(path, pattern, chunk, overlap), kinds)
    joined = parts.groupBy("rid").applyInArrow(_stitched, "doc_id long, rid string, ids binary")
    done = joined.filter("ids is not null").select("doc_id", "ids")
    rest = long.join(joined.filter("ids is null").select("rid").distinct(), "rid", "left_semi").select("doc_id", "text")
    return whole.unionByName(done).unionByName(rest.mapInArrow(_whole(path, pattern), "doc_id long, ids binary"))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, bytes: the raw bytes that the ids stand for."""

    def back(batches):
        c = codec(path, pattern)
        for batch in batches:
            raw = [c.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(raw, pa.binary())], ["doc_id", "ids", "bytes"])

    return encoded.mapInArrow(back, "doc_id long, ids binary, bytes binary")


def digests(docs: DataFrame, path: str, pattern: str, **sizes) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def digest(batches):
        c = codec(path, pattern)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), sha(ids), sha(map(c.decode, ids))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encode(docs, path, pattern, **sizes).mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
