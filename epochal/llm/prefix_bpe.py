"""Byte-level BPE by dynamic programming over prefixes, for files of the tokenizers library.

Each prefix of a pre-token has exactly one last token in its encoding. An automaton over the
vocabulary gives the tokens that end at a place; of these the last token is the one that stands alone
or is compatible with the last token of the prefix before it: two tokens are compatible if no merge
across their seam comes before the merges that make them. The ids are read off the back-pointers,
from the end. Time and memory grow with the length of a text, whatever its runs, and no rows move.

Texts are cut as the library cuts them: at added tokens, which are ids of their own, and then by the
pattern of its byte-level pre-tokenizer. Texts with letters or numbers of newer Unicode tables than
the library's are cut by the library itself. Decoding joins the bytes of the tokens and replaces what
is not UTF-8.

Defined results: a null text is an empty text without ids; rows that repeat each get their result; a
null doc_id is kept; an empty table gives no rows; other columns are not read. A file with another
model, normalizer, pre-tokenizer, decoder or kind of added token raises ValueError when it is loaded.
"""

from __future__ import annotations

import functools
import hashlib
import json

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import common

#: Fixed pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pairs of tokens whose compatibility a Python worker remembers, and pre-tokens.
PAIRS, PRETOKENS = 400_000, 300_000
ALWAYS = 1 << 40


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes as: printable Latin-1 stands for itself, others follow from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Prefixes:
    """The merges of a vocabulary, and the encoding of pre-tokens by the last tokens of their prefixes."""

    def __init__(self, tokens: dict[bytes, int], merges: list[tuple[bytes, bytes]], name: str = ""):
        self.memory = (f"pairs {name}", f"pretokens {name}")  # a vocabulary's own
        self.rank = [-1] * (max(tokens.values()) + 1)
        self.halves: list[tuple[int, int] | None] = [None] * len(self.rank)
        self.merges: dict[tuple[int, int], int] = {}
        for at, (left, right) in enumerate(merges):
            a, b, made = tokens[left], tokens[right], tokens[left + right]
            if self.halves[made] or any(self.halves[i] is None and len(t) > 1 for t, i in ((left, a), (right, b))):
                raise ValueError(f"merge {at} makes a token again, or one of tokens that are not made yet")
            self.rank[made], self.halves[made], self.merges[a, b] = at, (a, b), at
        if any(len(t) != 1 and self.halves[i] is None for t, i in tokens.items()):
            raise ValueError("a token is neither a byte nor made by a merge")
        self.size = {i: len(t) for t, i in tokens.items()}
        self.ending = ahocorasick.Automaton()
        for t, i in tokens.items():
            self.ending.add_word(t.decode("latin-1"), i)
        self.ending.make_automaton()

    def compatible(self, a: int, b: int) -> bool:
        """Whether a before b stays as it is: going back in time along the seam, no pair of the parts that
        touch there has a merge before one of them becomes part of something larger. Of equal merges the left one comes first."""
        rank, until = self.rank, ALWAYS
        while True:
            if self.merges.get((a, b), ALWAYS) < until:
                return False
            if rank[a] > rank[b]:
                until, a = rank[a], self.halves[a][1]
            elif rank[b] >= 0:
                until, b = rank[b] + 1, self.halves[b][0]
            else:
                return True

    def last_tokens(self, piece: bytes) -> list[int]:
        """For each length of a prefix, from 0 on, the last token of its encoding (-1 for the empty one)."""
        last, size, pairs = [-1] * (len(piece) + 1), self.size, common.remembered(*self.memory)
        for at, token in self.ending.iter(piece.decode("latin-1")):
            if last[at + 1] >= 0:
                continue  # there is only one
            before = last[at + 1 - size[token]]
            if before >= 0:
                known = pairs.get((before, token))
                if known is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    known = pairs[before, token] = self.compatible(before, token)
                if not known:
                    continue
            elif size[token] != at + 1:
                continue
            last[at + 1] = token
        return last

    def encode(self, piece: bytes) -> list[int]:
        last, at, out = self.last_tokens(piece), len(piece), []
        while at:
            out.append(last[at])
            at -= self.size[last[at]]
        return out[::-1]


class Codec:
    """Encodes and decodes texts by a tokenizer's file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as lines:
            given = json.load(lines)
        model, cut, back = given["model"], given["pre_tokenizer"] or {}, given["decoder"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)]
        odd += [k for k in ("byte_fallback", "ignore_merges") if model.get(k)] + ["normalizer"] * bool(given["normalizer"])
        odd += ["pre_tokenizer"] * (cut.get("type") != "ByteLevel" or cut.get("add_prefix_space", True) or not cut.get("use_regex", True))
        odd += ["decoder"] * (back.get("type") != "ByteLevel") + ["added_tokens"] * any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in given["added_tokens"])
        if model.get("type") != "BPE" or odd:
            raise ValueError(f"not a plain byte-level BPE file: {', '.join(odd)}")
        as_byte = byte_letters()
        raw = lambda token: bytes(map(as_byte.__getitem__, token))
        added = {t["content"]: t["id"] for t in given["added_tokens"]}
        tokens = {raw(t): i for t, i in model["vocab"].items() if t not in added}
        self.prefixes = Prefixes(tokens, [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]], path)
        self.memory = self.prefixes.memory[::-1]
        self.bytes_of = {i: t for t, i in tokens.items()} | {i: t.encode() for t, i in added.items()}
        self.added = added
        self.at_added = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")").split if added else None
        self.find = regex.compile(PATTERN).findall
        self.cutter = Tokenizer.from_file(path).pre_tokenizer
        self.newer = self._newer()

    def _newer(self) -> frozenset[str]:
        """Letters and numbers of the pattern's Unicode tables that the library doesn't take for such."""
        points = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]))
        found = []
        for kind, mark in (("L", "a"), ("N", "1")):
            some = regex.findall(rf"\p{{{kind}}}", points)
            joined = "".join(f" {mark}{c}" for c in some)
            alone = {joined[lo + 2] for _, (lo, hi) in self.cutter.pre_tokenize_str(joined) if hi - lo == 2 and joined[lo] == " "}
            found += alone & set(some)
        return frozenset(found)

    def pretokens(self, text: str) -> list[str]:
        if not text.isascii() and not self.newer.isdisjoint(text):
            return [text[lo:hi] for lo, hi in _joined(at for _, at in self.cutter.pre_tokenize_str(text))]
        return self.find(text)

    def packed(self, token: str) -> bytes:
        """The ids of a pre-token as little-endian 32-bit integers."""
        seen = common.remembered(*self.memory)
        got = seen.get(token)
        if got is None:
            got = np.array(self.prefixes.encode(token.encode("utf-8", "surrogatepass")), "<u4").tobytes()
            if len(token) < 64:
                if len(seen) >= PRETOKENS:
                    seen.clear()
                seen[token] = got
        return got

    def encode(self, text: str) -> bytes:
        seen, packed, out = common.remembered(*self.memory), self.packed, []
        for no, part in enumerate(self.at_added(text) if self.at_added else [text]):
            if no % 2:
                out.append(np.array([self.added[part]], "<u4").tobytes())
            elif part:
                out += [seen.get(t) or packed(t) for t in self.pretokens(part)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _joined(spans):
    """Spans in order, those of one character that was cut inside taken once."""
    last = 0
    for lo, hi in spans:
        if hi > last:
            yield max(lo, last), hi
            last = hi


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec in each Python worker."""
    return Codec(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: the ids of every text as little-endian 32-bit integers."""
    common.prepare(docs.sparkSession)

    def run(batches):
        c = codec(path)
        for batch in batches:
            ids = [c.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, text: the texts that the ids stand for."""

    def run(batches):
        c = codec(path)
        for batch in batches:
            texts = [c.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        c = codec(path)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), sha(ids), sha(c.decode(i).encode() for i in ids)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encode(docs, path).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
