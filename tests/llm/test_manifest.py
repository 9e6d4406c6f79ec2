"""The manifest against trees that are built and folded plainly, level by level."""

import zlib
from hashlib import sha256

import pytest

from epochal.llm import manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """Root and, for each leaf, its runs and places up to the root."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, a in enumerate(at):
            lo = a // 3 * 3
            paths[i].append((nodes[lo : lo + 3], a - lo))
            at[i] = a // 3
        nodes = [h("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def want(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by[s]])
    root, ups = tree([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, ups, strict=True):
        for r, path in zip(by[s], trees[s][1], strict=True):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            digest = leaf((*r[:4], r[4].replace("\n", ""))) if hit else leaf(r)
            siblings = ""
            for run, place in path + up:
                siblings += "".join(x for i, x in enumerate(run) if i != place)
                digest = h("".join(digest if i == place else x for i, x in enumerate(run)))
            out.append((r[0], leaf(r), trees[s][0], root, h(siblings), digest, digest == root))
    return sorted(out, key=str)


def got(df, **sizes):
    return sorted((tuple(r) for r in manifest.tampered(df, **sizes).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("height", [1, 2, 7])
def test_documents(docs, height):
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    found = got(docs, height=height)
    assert found == want(rows)
    assert {r[-1] for r in found} == {True, False}


def test_odd(odd, empty):
    assert got(odd) == want([tuple(r) for r in odd.select(*FIELDS).collect()])
    assert got(odd, height=1) == got(odd)
    assert manifest.tampered(empty).count() == 0


def test_one_row_and_many_sources(spark):
    rows = [(5, "a\nb", "en", "s", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got(df) == want([(5, "s", "en", 3, "a\nb")])
    many = [(i, f"t\n{i}", None, f"s{i % 50}" if i % 7 else None, i) for i in range(300)]
    df = spark.createDataFrame(many, "doc_id long, text string, lang string, source string, n_chars long")
    assert got(df, height=2) == want([(i, s, lang, n, t) for i, t, lang, s, n in many])


def test_repeated_rows_are_spread(spark):
    df = spark.range(2000).selectExpr("7L as doc_id", "'same\n' as text", "'en' as lang", "'s' as source", "5L as n_chars")
    found = got(df, height=3)
    assert found == want([(7, "s", "en", 5, "same\n")] * 2000)


def test_versions_share_what_is_untouched():
    """A version has new nodes on the way to its leaf only; all children off the way are the old ones."""
    digests = [sha256(bytes([i])).digest() for i in range(25)]
    root = manifest.build(digests, manifest.levels(25))
    before = repr(root)
    for at in range(25):
        steps = manifest.walk(root, at, manifest.levels(25))
        made = manifest.with_leaf(steps, b"x" * 32)
        assert len(made) == 4 and repr(root) == before
        for (old, place), new in zip(reversed(steps), made[1:], strict=True):
            assert all(a is b for i, (a, b) in enumerate(zip(old[1], new[1], strict=True)) if i != place)
        proof, places = manifest.proof_of(steps)
        assert manifest.continued(digests[at], proof, places)[-1] == root[0]
        assert manifest.continued(b"x" * 32, proof, places) == [x[0] for x in made[1:]]
