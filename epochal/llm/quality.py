"""Quality classifier: a factorisation machine over hashed words, word shapes and structure statistics.

score = sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j); the pairs are summed in linear
time as half of |sum v_i x_i|^2 - sum |v_i x_i|^2. Inputs come from the text alone. The machine is
fitted on a bounded sample of labelled rows (SAMPLE rows of each label and VALUES feature values in all,
both parameters; labels without a document take no place in it); every row is scored, in the task
that holds it, with the broadcast model (a fixed size: BINS x (1 + RANK) floats).

Defined results: a null or empty text is scored from its structure statistics, like any other; rows
that repeat get equal scores; a null doc_id is scored and is not held out; without any labels of
one kind every text scores 0.5; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Labelled rows of each label that the fit takes at most.
SAMPLE = 6000
#: Feature values of the sample that the driver takes at most (8 bytes each), whatever the length of its texts.
VALUES = 1 << 24
#: Hash bins, latent dimensions, share threshold of a kept text.
BINS, RANK, KEEP = 1 << 15, 8, 0.3
STATS = 16
_SHAPE = ((re.compile(r"[^\W\d_]+"), lambda m: "A" if m.group().isupper() else "a"), (re.compile(r"\d+"), lambda m: "0"))


def _bins(word: str) -> int:
    """Bins of a word (times 2^16) and of its shape, one number in memory: letters as a or A, digits as 0, the rest as it stands (runs of three at most)."""
    shape = word
    for pattern, to in _SHAPE:
        shape = pattern.sub(to, shape)
    bare = word.lower().strip(".,;:!?\"'()")
    return (STATS + zlib.crc32(bare.encode("utf-8", "surrogatepass")) % (BINS - STATS)) << 16 | STATS + zlib.crc32(b"shape " + shape[:12].encode("utf-8", "surrogatepass")) % (BINS - STATS)


def _statistics(text: str, counts: Counter, n: int) -> list[float]:
    """Structure of a text: sizes, kinds of characters, repetition, lines; each near 0 to 1."""
    chars = max(1, len(text))
    sample = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(_CLASS[np.frombuffer(sample, "u1")], minlength=6) / max(1, len(sample)) if sample else np.zeros(6)
    lines = text.split("\n")
    top = max(counts.values(), default=0)
    return [
        1.0,
        np.log1p(n) / 10,
        np.log1p(chars) / 12,
        len(counts) / max(1, n),
        top / max(1, n),
        min(3.0, sum(map(len, counts)) / max(1, len(counts)) / 10),
        kinds[0], kinds[1], kinds[2], kinds[3] * 5, kinds[4], kinds[5] * 5,
        np.log1p(len(lines)) / 6,
        len(set(lines)) / len(lines),
        min(3.0, chars / len(lines) / 400),
        sum(c for c in counts.values() if c > 1) / max(1, n),
    ]


#: Classes of bytes: lower-case, upper-case, digit, ASCII punctuation, white space and sentence marks, other.
_CLASS = np.array([0 if 97 <= b <= 122 or b >= 128 else 1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 4 if b in b" \n.,;'" else 5 if b < 32 else 3 for b in range(256)])


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins and values of one text: statistics first, then words and shapes, scaled to unit length each."""
    text = text or ""
    seen = common.remembered("quality")
    words = text.split()
    counts = Counter(words)
    if len(seen) > common.HASHED:
        seen.clear()
    bins = []
    for w in counts:
        got = seen.get(w)
        if got is None:
            got = _bins(w)
            if len(w) < 40:
                seen[w] = got
        bins.append(got)
    stats = _statistics(text, counts, len(words))
    if not bins:
        return np.arange(STATS), np.array(stats, "f4")
    at = np.array(bins)
    tf = np.fromiter(counts.values(), "f4", len(counts))
    shape_bins, where = np.unique(at & 0xFFFF, return_inverse=True)
    shapes = np.sqrt(np.bincount(where, tf) / len(words))
    tf = np.log1p(tf)
    return np.concatenate([np.arange(STATS), at >> 16, shape_bins]), np.concatenate([stats, tf / np.linalg.norm(tf), shapes]).astype("f4")


class Machine:
    """A factorisation machine for rows given as flat bins and values with row starts."""

    def __init__(self, bins: int = BINS, rank: int = RANK, seed: int = 7):
        self.w0 = 0.0
        self.w = np.zeros(bins, "f4")
        self.v = np.random.default_rng(seed).normal(0, 0.02, (bins, rank)).astype("f4")

    def raw(self, at: np.ndarray, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0)
        vx = self.v[at] * x[:, None]
        total = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx * vx).sum(1), starts)
        return self.w0 + np.add.reduceat(self.w[at] * x, starts) + 0.5 * ((total * total).sum(1) - squares)

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        at, x, starts = flat(rows)
        return 1 / (1 + np.exp(-np.clip(self.raw(at, x, starts), -30, 30)))

    def fit(self, rows, labels: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.05, ridge: float = 2e-4, seed: int = 7) -> Machine:
        """Adagrad over mini-batches of the logistic loss; both labels weigh alike."""
        weight = np.where(labels > 0, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
        g0, gw, gv = 1e-6, np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6)
        shuffle = np.random.default_rng(seed)
        for _ in range(epochs):
            order = shuffle.permutation(len(rows))
            for lo in range(0, len(order), batch):
                pick = order[lo : lo + batch]
                at, x, starts = flat([rows[i] for i in pick])
                row_of = np.repeat(np.arange(len(pick)), np.diff(np.append(starts, len(at))))
                p = 1 / (1 + np.exp(-np.clip(self.raw(at, x, starts), -30, 30)))
                err = ((p - labels[pick]) * weight[pick] / len(pick)).astype("f4")
                total = np.add.reduceat(self.v[at] * x[:, None], starts, axis=0)
                e = err[row_of] * x
                used, where = np.unique(at, return_inverse=True)
                dw = np.bincount(where, e, len(used)) + ridge * self.w[used]
                each = e[:, None] * (total[row_of] - self.v[at] * x[:, None])
                dv = np.stack([np.bincount(where, each[:, k], len(used)) for k in range(self.v.shape[1])], 1) + ridge * self.v[used]
                gw[used] += dw * dw
                gv[used] += dv * dv
                g0 += float(err.sum()) ** 2
                self.w[used] -= (rate * dw / np.sqrt(gw[used])).astype("f4")
                self.v[used] -= (rate * 0.5 * dv / np.sqrt(gv[used])).astype("f4")
                self.w0 -= rate * float(err.sum()) / np.sqrt(g0)
        return self


def flat(rows):
    sizes = [len(r[0]) for r in rows]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype("i8") if rows else np.zeros(0, "i8")
    return (np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), starts) if rows else (np.zeros(0, "i8"), np.zeros(0, "f4"), starts)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> DataFrame:
    """text, label of at most sample labelled rows of each label whose doc_id is not held out, by hash order of doc_id. Of several texts of
    one doc_id the one with the least hash counts (then the least text), in whatever order rows come."""
    known = labels.select("doc_id", F.col(label).alias("label")).filter(F.col("label").isin(0, 1) & (common.crc_mod(F.col("doc_id"), 5) != 0))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = [known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    ids = picked[0].unionByName(picked[1])
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most 2 x sample ids
    return texts.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "label")


def within(rows: DataFrame, size: str, most: int) -> list:
    """doc_ids of a (bounded) sample, by hash of doc_id, whose sizes sum up to no more than most."""
    sizes = rows.select("doc_id", F.col(size).alias("n"), F.xxhash64("doc_id").alias("h")).collect()  # two numbers a row of the sample
    total, out = 0, []
    for r in sorted(sizes, key=lambda r: (r.h, r.doc_id)):
        if total + r.n <= most:
            total += r.n
            out.append(r.doc_id)
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, values: int = VALUES, **how) -> Machine | None:
    """The machine fitted on the sample; None if it lacks one of the labels."""
    common.prepare(docs.sparkSession)

    def extract(batches):
        for batch in batches:
            rows = [features(t) for t in batch.column("text").to_pylist()]
            packed = [pa.array([r[0].astype("<i4").tobytes() for r in rows], pa.binary()), pa.array([r[1].tobytes() for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *packed], ["doc_id", "label", "at", "x"])

    chosen = labelled_sample(docs, labels, "quality", sample).select(F.col("doc_id").cast("long"), "text", F.col("label").cast("int"))
    rows = chosen.mapInArrow(extract, "doc_id long, label int, at binary, x binary").withColumn("n", F.length("x") / 4).checkpoint()
    rows = rows.filter(F.col("doc_id").isin(within(rows, "n", values))).drop("n")
    got = sorted(rows.collect())  # bounded by sample and values
    y = np.array([r.label for r in got], "f4")
    if not len(y) or y.min() == y.max():
        return None
    return Machine().fit([(np.frombuffer(r.at, "<i4"), np.frombuffer(r.x, "f4")) for r in got], y, **how)


def _scorer(model):
    """A function from a list of texts to scores; model is a broadcast."""

    def score(texts: list[str | None]) -> np.ndarray:
        machine = model.value
        return machine.score([features(t) for t in texts]) if machine else np.full(len(texts), 0.5)

    return score


def score(docs: DataFrame, model: Machine | None, keep: float = KEEP) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    common.prepare(docs.sparkSession)
    scorer = _scorer(docs.sparkSession.sparkContext.broadcast(model))

    def rows(batches):
        for batch in batches:
            s = np.round(scorer(batch.column("text").to_pylist()).astype("f8"), 6)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= keep).astype("i4"))], ["doc_id", "score", "predicted"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(common.crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def keep(docs: DataFrame, model: Machine | None, least: float = KEEP) -> DataFrame:
    """The rows of docs whose text scores at least so much."""
    common.prepare(docs.sparkSession)
    scorer = _scorer(docs.sparkSession.sparkContext.broadcast(model))

    def rows(batches):
        for batch in batches:
            yield batch.filter(pa.array(np.round(scorer(batch.column("text").to_pylist()).astype("f8"), 6) >= least))

    return docs.mapInArrow(rows, docs.schema)
