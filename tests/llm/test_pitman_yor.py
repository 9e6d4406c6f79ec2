"""The base score against plain counts, the model against held-out texts and against itself."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from epochal.llm import common, pitman_yor


def held(doc_id):
    return common.crc_mod(doc_id, 7) == 2


def check(df):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    texts = [(d, common.lower_words(t) + ["\0"]) for d, t in rows]
    out_of = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(w for d, t in texts if not out_of(d) for w in t)
    total = sum(c.values())
    want = sorted((str(d), out_of(d), len(t), sum(c[w] > 0 for w in t), total, round(sum(math.log10((c[w] + 1) / (total + len(c) + 1)) for w in t), 4)) for d, t in texts)
    found = pitman_yor.score(df, held).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 2e-4
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    return found


def test_documents(docs):
    found = [r for r in check(docs) if r.held_out]
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_odd(odd, empty):
    check(odd)
    assert pitman_yor.score(empty, held).count() == 0


def test_reruns_agree(docs):
    a, b = (sorted((r.doc_id, r.score) for r in pitman_yor.score(x, held).collect()) for x in (docs, docs))
    assert a == b


def plain_scores(rows, held_ids, discount, strength, tables_of=None, parent_discount=pitman_yor.PARENT_DISCOUNT, parent_strength=pitman_yor.PARENT_STRENGTH, seed=1):
    """The model by dictionaries: one table a dish and context, or customers seated one by one in Gibbs sweeps."""
    texts = {d: ["\0start", *common.lower_words(t), "\0end"] for d, t in rows}
    n, V = Counter(), {w for d, t in texts.items() if d not in held_ids for w in t[1:]}
    for d, t in texts.items():
        if d not in held_ids:
            n.update(zip(t, t[1:]))
    count = Counter()
    for (u, _), k in n.items():
        count[u] += k
    rng = random.Random(seed)

    def parent(tables):
        c = Counter()
        for (_, w), k in tables.items():
            c[w] += k
        T = {w: 1 for w in c}
        if tables_of:
            pull = (parent_strength + parent_discount * len(V)) / (len(V) + 1)
            for w, k in c.items():
                for at in range(1, k):
                    T[w] += rng.random() < pull / (pull + at - parent_discount * T[w])
        base = (parent_strength + parent_discount * sum(T.values())) / (len(V) + 1)
        return lambda w: (max(c[w] - parent_discount * T.get(w, 0), 0) + base) / (sum(c.values()) + parent_strength)

    def opened(tables):
        out = Counter()
        for (u, _), k in tables.items():
            out[u] += k
        return out

    def sweep(tables, p):
        o, out = opened(tables), {}
        for (u, w), k in n.items():
            t, pull = 1, (strength + discount * o[u]) * p(w)
            for at in range(1, k):
                t += rng.random() < pull / (pull + at - discount * t)
            out[u, w] = t
        return out

    tables = dict.fromkeys(n, 1)
    p = parent(tables)
    means = Counter()
    sweeps = tables_of or 0
    if sweeps:
        uniform = lambda w: 1 / (len(V) + 1)
        for _ in range(2):
            tables = sweep(tables, uniform)
        p = parent(tables)
    kept = max(1, sweeps - 2)
    for k in range(max(1, sweeps)):
        if sweeps:
            tables = sweep(tables, p)
        if k >= max(1, sweeps) - kept:
            o = opened(tables)
            for t in texts.values():
                for u, w in set(zip(t, t[1:])):
                    means[k, u, w] = (max(n[u, w] - discount * tables.get((u, w), 0), 0) + (strength + discount * o[u]) * p(w)) / (count[u] + strength)
    last = range(max(1, sweeps) - kept, max(1, sweeps))
    return {d: sum(math.log10(sum(means[k, u, w] for k in last) / len(last)) for u, w in zip(t, t[1:])) for d, t in texts.items()}


def corpus(docs):
    rows = [(r.doc_id, r.text or "") for r in docs.orderBy("doc_id").limit(120).collect()]
    return rows, {d for d, _ in rows if zlib.crc32(str(d).encode()) % 7 == 2}


@pytest.mark.parametrize("split", [1 << 17, 200])
def test_scores_without_sampling_against_dictionaries(spark, docs, monkeypatch, split):
    """One table a dish: scores are exact, and the same where contexts are split over parts."""
    rows, out = corpus(docs)
    monkeypatch.setattr(pitman_yor, "SPLIT", split)
    monkeypatch.setattr(pitman_yor, "PART", split * 40)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in pitman_yor.score(df, held, sweeps=0, rounds=1, block=4000, parent_discount=0.4, parent_strength=7.0).collect()}
    want = plain_scores(rows, out, pitman_yor.DISCOUNT, pitman_yor.STRENGTH, parent_discount=0.4, parent_strength=7.0)
    tolerance = 2e-5 if split > 1000 else 3e-3
    worst = max(abs(got[d] - want[d]) / max(1, abs(want[d])) for d in want)
    assert worst <= tolerance


def test_sampled_scores_against_customers_one_by_one(spark, docs):
    rows, out = corpus(docs)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in pitman_yor.score(df, held).collect()}
    want = plain_scores(rows, out, pitman_yor.DISCOUNT, pitman_yor.STRENGTH, tables_of=6)
    assert abs(sum(got.values()) / sum(want.values()) - 1) < 0.004
    worst = max(abs(got[d] - want[d]) / (1 + abs(want[d])) for d in want)
    assert worst < 0.04


def test_split_contexts_change_little(spark, docs, monkeypatch):
    """With contexts split by dish and block the base stays exact and the model close."""
    a = {r.doc_id: r for r in pitman_yor.score(docs, held).collect()}
    monkeypatch.setattr(pitman_yor, "SPLIT", 500)
    monkeypatch.setattr(pitman_yor, "PART", 4000)
    b = {r.doc_id: r for r in pitman_yor.score(docs, held, block=5000).collect()}
    assert all(abs(a[d].base_score - b[d].base_score) < 1e-4 and a[d].n_known == b[d].n_known for d in a)
    assert abs(sum(x.score for x in a.values()) / sum(x.score for x in b.values()) - 1) < 0.005


def test_one_pair_goes_to_many_parts(spark, monkeypatch):
    """A line that repeats is split by blocks: no part has all tokens of one pair, and equal texts score alike."""
    monkeypatch.setattr(pitman_yor, "SPLIT", 500)
    monkeypatch.setattr(pitman_yor, "PART", 2000)
    df = spark.createDataFrame([(i, "buy now buy now buy now") for i in range(3000)], "doc_id long, text string").repartition(4)
    out = pitman_yor.score(df, held, block=300).cache()
    assert out.select("score").distinct().count() == 1 and out.count() == 3000
    plan = pitman_yor.Plan(18_000, 3, 3000, 3000, 21_000, 4, lambda split: [(5, 9000, 9000), (6, 9000, 9000)])
    keys = {int(plan.keys(np.array([5], "u8"), np.array([6], "u8"), block)[0]) for block in range(60)}
    assert int(plan.shares[0]) >= len(keys) > int(plan.shares[0]) // 2 > 4


def test_seating():
    n, names = np.array([0, 1, 2, 50, 100_000]), np.arange(5, dtype="u8")
    t = pitman_yor.seat(n, np.full(5, 0.5), 0.6, names, 1)
    assert t[0] == 0 and t[1] == 1 and 1 <= t[2] <= 2 and (t <= n).all() and t[4] > t[3]
    few = pitman_yor.seat(np.full(40_000, 2), np.ones(40_000), 0.5, np.arange(40_000, dtype="u8"), 3).mean()
    assert abs(few - (1 + 1.0 / 1.5)) < 0.01
    assert (pitman_yor.seat(n[::-1], np.full(5, 0.5), 0.6, names[::-1], 1)[::-1] == t).all()


def test_the_parent_is_seated_anew_with_tables_over_it(docs, monkeypatch):
    """Contexts are seated over a parent, and not over a uniform one only, before the parent is made that scores are taken from."""
    over, asked = [], pitman_yor.asked
    monkeypatch.setattr(pitman_yor, "asked", lambda dealt, told, *more: over.append(told is not None) or asked(dealt, told, *more))
    found = [r for r in pitman_yor.score(docs, held).collect() if r.held_out]
    assert over[0] is False and over[-1] is True
    assert sum(r.score for r in found) > sum(r.base_score for r in found)
