"""Near-duplicates against all pairs."""

import random
from itertools import combinations

import pytest

from epochal.llm import common, neardup

from llm.conftest import words


def brute(rows, size, least):
    sets = {}
    for i, (_, text) in enumerate(rows):
        w = common.lower_words(text)
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= least * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted((str(d), len(sets[i]), str(low.get(find(i), None))) for i, (d, _) in enumerate(rows))


def got(df, **how):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in neardup.linked(df, **how).collect())


@pytest.mark.parametrize(("size", "least"), [(3, 85), (5, 80)])
def test_documents(docs, size, least):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(docs, size=size, least_hundredths=least) == brute(rows, size, least)


def test_groups(spark):
    """Copies, near copies near the threshold, chains of edits, and a template that many share in part."""
    rng, rows, n = random.Random(4), [], 0
    for _ in range(6):
        text = words(rng, 160).split()
        for _ in range(12):
            t = list(text)
            for _ in range(rng.randrange(5)):
                t[rng.randrange(len(t))] = f"new{rng.randrange(10**6)}"
            rows.append((n := n + 1, " ".join(t)))
    chain = words(rng, 200).split()
    for _ in range(10):
        chain[rng.randrange(200)] = f"link{n}"
        rows.append((n := n + 1, " ".join(chain)))
    template = words(rng, 90)
    for _ in range(30):
        rows.append((n := n + 1, template + " " + words(rng, 60)))
    rows += [(n := n + 1, rows[3][1]) for _ in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, size=3, least_hundredths=85) == brute(rows, 3, 85)


def test_odd(odd, empty):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert got(odd, size=3, least_hundredths=85) == brute(rows, 3, 85)
    assert neardup.linked(empty).count() == 0
    assert neardup.keep(empty).count() == 0
    kept = neardup.keep(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 8").isEmpty() and kept.filter("doc_id = 7").count() == 1


def test_components(spark):
    """Paths and rings of links end at their smallest node."""
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (102, 100)]
    nodes = spark.createDataFrame([(i,) for i in [*range(61), 100, 101, 102, 200]], "node long")
    out = {r.node: r.component for r in neardup.components(nodes, spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, 200: 200}


@pytest.mark.parametrize("part_links", [1 << 20, 50])
def test_components_of_one_part_and_of_many(spark, monkeypatch, part_links):
    monkeypatch.setattr(neardup, "PART_LINKS", part_links)
    rng = random.Random(1)
    links = [(a, b) for a, b in [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 620)] if a != b]
    least = list(range(650))
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    got = neardup.components(spark.range(650).selectExpr("id as node"), spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == dict(enumerate(least))


@pytest.mark.parametrize(("share", "part_rows"), [(2048, 1 << 20), (40, 500)])
def test_lone_links_in_dense_families(spark, monkeypatch, share, part_rows):
    """Versions of a template whose pairs lie just below the threshold, but for one pair with fewer words of its own."""
    monkeypatch.setattr(neardup, "SHARE", share)
    monkeypatch.setattr(neardup, "PART_ROWS", part_rows)
    rng, rows = random.Random(9), []
    for family in range(3):
        for i in range(300):
            own = [f"f{family}t{k}" for k in range(900)]
            slots = range(12 * i, 12 * i + 12) if i < 2 else rng.sample(range(24, 300), 15)
            for k in slots:
                own[3 * k + 1] = f"own{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 3, 85)
    component = {int(a): int(c) for a, _, c in want}
    assert all(component[300 * family + 1] == 300 * family for family in range(3)) and sum(a != c for a, c in component.items()) < 90
    assert got(df, size=3, least_hundredths=85) == want
