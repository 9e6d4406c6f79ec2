"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows.

The lexicon holds terms, stems that stand for every word they begin, and repeated stems, which count
only where a text has them often (at least twice, and once in RARE words). All are learned from a
bounded sample of labelled rows: words that many toxic rows and hardly any others have, then, by greedy
cover, words and stems of the toxic rows that are left, as long as one newly covers COVER rows or more. A word is run through the trie with the states of a Levenshtein automaton (rows of
edit distances, cut where all exceed the limit), which finds terms that it equals or misspells by one
edit; stems are not misspelt. Each hit is weighed by its window: quotation marks, words of reporting
and address near it. A logistic model of the hits' counts, shares and windows gives the score.

Defined results: a null or empty text has no hits and scores the model's base; rows that repeat get
equal scores; a null doc_id is scored and is not held out; without labels of both kinds the lexicon is
empty, so that all texts score the base of the weights; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, quality

#: Labelled rows of each label that the fit takes at most.
SAMPLE = 5000
#: Toxic texts that a term must newly cover, share of toxic texts among those with it,
#: and the share of all toxic texts that makes a word a term of itself.
COVER, PURE, COMMON = 4, 0.95, 0.02
#: The share of toxic texts that a repeated stem needs; words in which it stands once at least.
PURE_REPEATED, RARE = 0.9, 250
#: Words that stand in toxic rows by chance alone: about so many are looked at, and fewer than one in
#: a hundred such samples may learn one.
CHANCE = 1e-7
#: Terms that make their common beginning a stem.
FAMILY = 4
#: Shortest and longest stem, and the shortest term of which one letter may differ.
STEM, LONGEST, FUZZY = 4, 7, 5
THRESHOLD = 0.5
#: Words on either side that a hit's window spans.
WINDOW = 6
QUOTES = frozenset("\"'“”‘’«»„`")
REPORT = frozenset("said says wrote writes quote quoted quotes called reported stated word words term phrase".split())
ADDRESS = frozenset("you your yours youre u ur".split())
WORD = re.compile(r"[^\W_]+")
FEATURES = 11


class Lexicon:
    """A trie of terms and stems, and the words that meet it."""

    def __init__(self, terms, stems, clean=(), repeated=(), fuzzy: int = FUZZY):
        self.root: dict = {}
        #: Words near a term that clean texts have: no misspellings.
        self.clean = frozenset(clean)
        for kind, entries in ((4, repeated), (1, terms), (2, stems)):
            for entry in entries:
                node = self.root
                for c in entry:
                    node = node.setdefault(c, {})
                node[""] = kind
        long = [t for t in terms if len(t) >= fuzzy]
        #: One edit leaves a term's first or last half as it is: words that share neither can't be near it.
        self.heads = {t[: len(t) // 2] for t in long}
        self.tails = {t[-(len(t) // 2) :] for t in long}
        self.halves = sorted({len(h) for h in self.heads})
        self.shortest, self.longest = min(map(len, long), default=0) - 1, max(map(len, long), default=0) + 1
        self.fuzzy = fuzzy
        self.name = f"toxicity {hash((tuple(terms), tuple(stems), self.clean, tuple(repeated)))}"

    def kind(self, word: str) -> int:
        """0: no hit; 1: a term; 2: begins with a stem; 3: a term with one letter changed, put in or left out; 4: begins with a repeated stem."""
        return self.kinds([word]).get(word, 0)

    def kinds(self, words) -> dict[str, int]:
        """The words that hit, with their kinds."""
        seen, out = common.remembered(self.name), {}
        for word in words:
            got = seen.get(word)
            if got is None:
                if len(seen) >= common.HASHED:
                    seen.clear()
                got = seen[word] = self._kind(word)
            if got:
                out[word] = got
        return out

    def _kind(self, word: str) -> int:
        node, repeated = self.root, False
        for i, c in enumerate(word):
            node = node.get(c)
            if node is None:
                break
            mark = node.get("")
            if mark == 2 or mark == 1 and i + 1 == len(word):
                return mark
            repeated |= mark == 4
        if repeated:
            return 4
        if not self.shortest <= len(word) <= self.longest:
            return 0
        if not any(word[:h] in self.heads or word[-h:] in self.tails for h in self.halves):
            return 0
        return 3 if word not in self.clean and self.near(word, 1) else 0

    def near(self, word: str, limit: int) -> bool:
        """Whether a term of the trie is within the limit of edits: the automaton of the word walks the trie."""
        todo = [(self.root, tuple(range(len(word) + 1)), 0)]
        while todo:
            node, row, depth = todo.pop()
            if node.get("") == 1 and depth >= self.fuzzy and row[-1] <= limit:
                return True
            for c, below in node.items():
                if c:
                    after = [row[0] + 1]
                    for i, w in enumerate(word):
                        after.append(min(after[-1] + 1, row[i + 1] + 1, row[i] + (w != c)))
                    if min(after) <= limit:
                        todo.append((below, tuple(after), depth + 1))
        return False


def features(lexicon: Lexicon, text: str | None) -> list[float]:
    """Counts and shares of a text's hits, by kind and by window."""
    text = text or ""
    found = WORD.findall(text.lower())
    kinds = lexicon.kinds(set(found))
    out = [0.0] * FEATURES
    if not kinds:
        return out
    spans = list(WORD.finditer(text.lower()))
    often = [kinds[m.group()] for m in spans if m.group() in kinds].count(4)
    if often < 2 or often * RARE < len(spans):
        kinds = {w: k for w, k in kinds.items() if k != 4}
        if not kinds:
            return out
    plain = quoted = aimed = 0
    count = [0, 0, 0, 0, 0]
    for i, m in enumerate(spans):
        k = kinds.get(m.group())
        if not k:
            continue
        count[k] += 1
        near = {s.group() for s in spans[max(0, i - WINDOW) : i + WINDOW + 1]}
        around = text[max(0, m.start() - 2) : m.start()] + text[m.end() : m.end() + 2]
        is_quoted = bool(QUOTES & set(around)) or bool(REPORT & near)
        quoted += is_quoted
        plain += not is_quoted
        aimed += bool(ADDRESS & near)
    n = len(spans)
    return [
        float(count[1] + count[2] > 0),
        np.log1p(count[1]),
        np.log1p(count[2]),
        float(count[3] > 0),
        np.log1p(count[3]),
        np.log1p(plain),
        quoted / max(1, plain + quoted),
        np.log1p(aimed),
        np.log1p(100 * sum(count) / n),
        float(count[4] > 0),
        np.log1p(100 * count[4] / n),
    ]


class Model:
    def __init__(self, terms=(), stems=(), clean=(), repeated=(), weights=None):
        self.terms, self.stems, self.clean, self.repeated = tuple(terms), tuple(stems), tuple(clean), tuple(repeated)
        self.weights = PRIOR if weights is None else weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + rows @ self.weights[1:], -30, 30)))


@functools.lru_cache(maxsize=2)
def _lexicon(terms, stems, clean, repeated) -> Lexicon:
    """One lexicon, with the words it has met, in each Python worker."""
    return Lexicon(terms, stems, clean, repeated)


def candidates(text: str) -> set[str]:
    """Words of a text, with a trailing star the stems that its words begin with, and with two stars those that it repeats."""
    found = WORD.findall(text.lower())
    counts = Counter(w for w in found if len(w) > 2 and not w.isdigit())
    stems: Counter = Counter()
    for w, n in counts.items():
        for k in range(STEM, min(LONGEST, len(w) - 1) + 1):
            stems[w[:k]] += n
    return {*counts, *[s + "*" for s in stems], *[s + "**" for s, n in stems.items() if n > 1 and n * RARE >= len(found)]}


def learn_lexicon(sample: DataFrame, cover: int = COVER, pure: float = PURE, common_share: float = COMMON) -> tuple[list[str], list[str], list[str]]:
    """Terms, stems and repeated stems that cover the toxic texts of the (bounded) sample and keep off the others.

    Texts that are near copies bring the same rare words; a term counts only for the texts that no
    term before it covers, so such words add little once real terms are in.
    """

    def count(batches):
        for batch in batches:
            for label in (0, 1):
                tally: dict[str, int] = {}
                for t, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                    if y == label:
                        for c in candidates(t or ""):
                            tally[c] = tally.get(c, 0) + 1
                yield pa.RecordBatch.from_arrays([pa.array(list(tally), pa.string()), pa.array([label] * len(tally), pa.int32()), pa.array(list(tally.values()), pa.int64())], ["term", "label", "n"])

    share = sample.agg(F.avg("label").alias("share")).first().share or 0.0
    if not 0 < share < 1:
        return [], [], []
    cover = max(cover, int(np.ceil(np.log(CHANCE) / np.log(share))))
    counts = sample.mapInArrow(count, "term string, label int, n long").groupBy("term").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("good"))
    needed = F.when(F.col("term").endswith("**"), PURE_REPEATED).otherwise(pure)
    good = counts.filter((F.col("bad") >= cover) & (F.col("bad") >= needed * (F.col("bad") + F.col("good"))))
    picked = good.collect()  # of the (bounded) sample
    known = {r.term: (r.bad, r.good) for r in picked}

    def meet(batches):
        for batch in batches:
            rows = [sorted(candidates(t or "") & known.keys()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["terms"])

    texts = sample.filter("label = 1").select("text").mapInArrow(meet, "terms array<string>").collect()  # bounded by the sample
    holds: dict[str, set[int]] = {}
    for i, row in enumerate(texts):
        for t in row.terms:
            holds.setdefault(t, set()).add(i)
    often = [t for t, s in holds.items() if not t.endswith("*") and len(s) >= max(cover, common_share * len(texts))]
    stems = sorted((t for t, s in holds.items() if t.endswith("*") and len(s) >= max(cover, common_share * len(texts))), key=lambda t: (-len(holds[t]) * (1 + len(t) / 20), t))
    chosen = []
    for stem in stems:  # a stem that many words share stands for them
        if sum(t.startswith(stem.rstrip("*")) for t in often) >= FAMILY:
            chosen.append(stem)
            often = [t for t in often if not t.startswith(stem.rstrip("*"))]
    chosen += sorted(often, key=lambda t: (-len(holds[t]), t))
    covered = set().union(*[holds[t] for t in chosen])
    offer = lambda t, new: (5 * known[t][1] - len(new), t.endswith("*"), len(t), t)
    heap = [offer(t, s - covered) for t, s in holds.items() if t not in set(chosen)]
    heapq.heapify(heap)
    while heap and -heap[0][0] >= cover:  # what a term newly covers only falls, so an offer that still stands is the best
        was = heapq.heappop(heap)
        now = offer(was[3], holds[was[3]] - covered)
        if now == was:
            chosen.append(was[3])
            covered |= holds[was[3]]
        elif -now[0] >= cover:
            heapq.heappush(heap, now)
    stars = lambda k: sorted(t.rstrip("*") for t in chosen if len(t) - len(t.rstrip("*")) == k)
    return stars(0), stars(1), stars(2)


#: Weights before any evidence: base, then one for each feature; what the sample doesn't show stays there.
PRIOR = np.array([-3.0, 3.0, 1.0, 1.0, 2.5, 1.0, 0.5, -0.5, 0.2, 0.2, 3.0, 0.5])


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.002, steps: int = 100) -> np.ndarray:
    """Logistic regression with intercept by Newton steps, drawn to PRIOR; both labels weigh alike."""
    a = np.concatenate([np.ones((len(x), 1)), x], 1)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, keep = PRIOR.copy(), ridge * np.eye(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + keep, a.T @ (weight * (p - y)) + keep @ (w - PRIOR))
        w -= step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    common.prepare(docs.sparkSession)
    chosen = quality.labelled_sample(docs, labels, "toxic", sample).select(F.col("doc_id").cast("long"), "text", F.col("label").cast("int")).checkpoint()  # bounded by the sample
    terms, stems, repeated = learn_lexicon(chosen)
    if not terms and not stems and not repeated:
        return Model()

    def near(batches):
        lexicon = _lexicon(tuple(terms), tuple(stems), (), tuple(repeated))
        for batch in batches:
            met = {w for t in batch.column("text").to_pylist() for w in WORD.findall((t or "").lower()) if lexicon.kind(w) == 3}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(met), pa.string())], ["word"])

    clean = sorted(r.word for r in chosen.filter("label = 0").select("text").mapInArrow(near, "word string").distinct().collect())  # bounded by the sample

    def extract(batches):
        lexicon = _lexicon(tuple(terms), tuple(stems), tuple(clean), tuple(repeated))
        for batch in batches:
            rows = [features(lexicon, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    got = sorted(chosen.mapInArrow(extract, "doc_id long, label int, x array<double>").collect())  # bounded by the sample
    y = np.array([r.label for r in got], "f8")
    if y.min() == y.max():
        return Model(terms, stems, clean, repeated)
    return Model(terms, stems, clean, repeated, fit_weights(np.array([r.x for r in got]), y))


def _scorer(model):
    def score(texts: list[str | None]) -> np.ndarray:
        m = model.value
        lexicon = _lexicon(m.terms, m.stems, m.clean, m.repeated)
        return np.round(m.score(np.array([features(lexicon, t) for t in texts]).reshape(-1, FEATURES)), 6)

    return score


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    common.prepare(docs.sparkSession)
    scorer = _scorer(docs.sparkSession.sparkContext.broadcast(model))

    def rows(batches):
        for batch in batches:
            s = scorer(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype("i4"))], ["doc_id", "score", "predicted"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(common.crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose text scores below the threshold."""
    common.prepare(docs.sparkSession)
    scorer = _scorer(docs.sparkSession.sparkContext.broadcast(model))

    def rows(batches):
        for batch in batches:
            yield batch.filter(pa.array(scorer(batch.column("text").to_pylist()) < threshold))

    return docs.mapInArrow(rows, docs.schema)
