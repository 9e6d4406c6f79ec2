"""Quality and toxicity: held-out accuracy on planted texts, the pair identity, misspellings, edges."""

import random

import numpy as np
import pytest

from epochal.llm import quality, toxicity

from llm.conftest import words


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(700):
        junk, toxic = rng.random() < 0.3, rng.random() < 0.3
        text = words(rng, rng.randrange(30, 120))
        if junk:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if toxic:
            w = text.split()
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "zorgal", "zorgish", "zorgen", "zorgum"]))
            text = " ".join(w)
        rows.append((i, text))
        labels.append((i, int(not junk), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string").cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache()


def held_out(scored, labels, label):
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 60
    return np.mean([r.predicted == r[label] for r in rows])


def test_quality_held_out(planted):
    docs, labels = planted
    assert held_out(quality.score(docs, quality.fit(docs, labels)), labels, "quality") > 0.95


def test_toxicity_held_out(planted):
    docs, labels = planted
    model = toxicity.fit(docs, labels)
    assert held_out(toxicity.score(docs, model), labels, "toxic") > 0.95


def test_labels_of_held_out_rows_are_not_used(planted):
    docs, labels = planted
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.score(docs, quality.fit(docs, x)).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_pairs_in_linear_time():
    """The sum of squares equals the double loop over pairs."""
    m = quality.Machine(bins=50, rank=4)
    rng = np.random.default_rng(1)
    m.v, m.w, m.w0 = rng.normal(size=(50, 4)).astype("f4"), rng.normal(size=50).astype("f4"), 0.3
    at, x = np.array([3, 7, 20, 41]), rng.normal(size=4).astype("f4")
    want = m.w0 + m.w[at] @ x + sum(m.v[at[i]] @ m.v[at[j]] * x[i] * x[j] for i in range(4) for j in range(i + 1, 4))
    assert m.raw(at, x, np.array([0]))[0] == pytest.approx(want, abs=1e-4)


def test_automaton_against_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row = [i + 1] + [0] * len(b) if False else [*_next(row, x, b, i)]
        return row[-1]

    def _next(row, x, b, i):
        out = [i + 1]
        for j, y in enumerate(b):
            out.append(min(out[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        return out

    terms = ["idiot", "pathetic", "worthless", "scum"]
    lexicon = toxicity.Lexicon(terms, ["zorg"])
    rng = random.Random(2)
    for _ in range(2000):
        w = list(rng.choice(terms))
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(w))
            w[k : k + rng.randrange(2)] = rng.choice(["", "q", "z", w[k]])
            w = w or ["a"]
        w = "".join(w)
        near = min(distance(w, t) for t in terms if len(t) >= toxicity.FUZZY)
        kind = lexicon.kind(w)
        assert (kind in (1, 3)) == (near <= 1 or w == "scum")
    assert lexicon.kind("zorgish") == 2 and lexicon.kind("clean") == 0


def test_misspelt_and_quoted():
    model = toxicity.Model(terms=("idiot",))
    lexicon = toxicity.Lexicon(("idiot",), ())
    score = lambda t: model.score(np.array([toxicity.features(lexicon, t)]))[0]
    plain = "what an idiot this person is today and tomorrow"
    assert score(plain) > 0.5 > score("what a person this is today and tomorrow")
    assert score(plain.replace("idiot", "idi0t")) > 0.5
    assert score('the word "idiot" was quoted by the report and nothing else') < score(plain)


def test_repeated_stems():
    """Words of a repeated stem count only where a text has them often."""
    lexicon = toxicity.Lexicon(("idiot",), (), repeated=("zorgo",))
    often = toxicity.features(lexicon, "zorgola and zorgone and some words")
    once = toxicity.features(lexicon, "zorgola and some words")
    thin = toxicity.features(lexicon, "zorgola zorgone " + "some words " * 400)
    assert often[9] == 1.0 and not any(once) and not any(thin)
    assert toxicity.features(lexicon, "zorgola idiot")[:2] == [1.0, pytest.approx(np.log(2))]
    assert "zorgo**" in toxicity.candidates("zorgola zorgone") and "zorgo**" not in toxicity.candidates("zorgola")


@pytest.mark.parametrize("label", ["quality", "toxic"])
def test_labels_without_documents_take_no_place(spark, planted, label):
    """A sample of 40 rows is the same with 5,000 labels of documents that are not here."""
    docs, labels = planted
    foreign = spark.range(10**6, 10**6 + 5000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "cast(id % 2 as int) as toxic")
    pick = lambda x: sorted(r.doc_id for r in quality.labelled_sample(docs, x, label, 20).collect())
    assert pick(labels) == pick(labels.unionByName(foreign)) and len(pick(labels)) == 40


def test_sample_is_bounded_in_values(planted):
    docs, labels = planted
    rows = docs.selectExpr("doc_id", "length(text) as n")
    some = quality.within(rows, "n", 20_000)
    assert 0 < sum(r.n for r in rows.collect() if r.doc_id in set(some)) <= 20_000
    assert quality.fit(docs, labels, values=20_000) is not None


@pytest.mark.parametrize("which", [quality, toxicity])
def test_odd_and_empty(spark, odd, empty, labels, which):
    model = which.fit(odd, labels)
    out = which.score(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    by_text = {}
    for r, t in zip(out, [x.text for x in odd.select("text").collect()], strict=True):
        by_text.setdefault(t, set()).add(r.score)
    assert all(len(v) == 1 for v in by_text.values())
    assert which.score(empty, which.fit(empty, labels)).count() == 0
    assert which.score(odd, which.fit(odd, labels.limit(0))).count() == odd.count()
    assert which.keep(odd, model).columns == odd.columns
    nulls = spark.createDataFrame([(None, None, None), (1, None, None)], "doc_id long, quality int, toxic int")
    which.fit(odd, nulls)


def test_sample_is_the_same_in_any_order(spark):
    """Of several texts of one doc_id the sample has the same one, however rows are dealt."""
    rows = [(i % 40, f"text {i * 7919 % 400} of {i % 40}") for i in range(400)] + [(i % 40, None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.range(40).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    pick = lambda d: sorted(map(tuple, quality.labelled_sample(d, labels, "toxic", 100).collect()), key=str)
    once = pick(docs)
    assert once == pick(docs.repartition(7)) == pick(docs.orderBy("text").repartition(3, "text")) and len({r[0] for r in once}) == len(once)
