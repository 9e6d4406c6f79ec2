"""Merkle fingerprints against plain Python."""

import hashlib
import re

from epochal.llm import merkle

PIECE = re.compile(r"[^\n.]{0,48}\.|[^\n.]{1,48}")


def root(text):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    p = [sha("P" + "".join(map(sha, PIECE.findall(x)))) for x in text.split("\n")]
    s = [sha("S" + "".join(p[i : i + 8])) for i in range(0, len(p), 8)]
    return sha("R" + "".join(s)), p, s


def brute(rows):
    """Expected rows for distinct, non-null doc_ids."""
    rows = sorted(rows, reverse=True)
    for k, (d, x) in enumerate(rows):
        n = rows[(k + 1) % len(rows)][1]
        half = len(x) // 2
        e = x[: len(x) - half] + n[:half]
        like = lambda a, b: len(a & b) / len(a | b) if a | b else None
        A, B, C = (set(PIECE.findall(t)) for t in (x, e, n))
        yield d, len(x), e, root(x), root(e), like(A, B), like(A, C), x == e, x == n


def test_documents(docs):
    got = {r.doc_id: r for r in merkle.edited_likeness(docs).collect()}
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    for d, n, e, a, b, near, next_, same, same_next in brute(rows):
        r = got[d]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (a[0], b[0])
        assert abs(r.near_edited - (near if near is not None else float(same))) < 1e-8
        assert abs(r.near_next - (next_ if next_ is not None else float(same_next))) < 1e-8
        first = next((i for i in range(max(len(a[1]), len(b[1]))) if a[1][i : i + 1] != b[1][i : i + 1]), None)
        assert r.changed_paragraph == first
        assert (r.changed_section is None) == (first is None) and (first is None or r.changed_section == first // 8)


def test_pieces_are_the_whole_line(spark):
    """Texts that differ in a dot or a space only have other roots, and share the leaves of what is equal."""
    rows = [(1, "a..b"), (2, "a.b"), (3, "a. .b"), (4, "a..b."), (5, "x" * 100), (6, "x" * 101), (7, ""), (8, "\n"), (9, "...")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all("".join(PIECE.findall(t)) == t.replace("\n", "") for _, t in rows)
    got = {r.doc_id: r.fingerprint for r in merkle.fingerprints(df).collect()}
    assert len(set(got.values())) == len(rows) and got == {d: root(t)[0] for d, t in rows}


def test_odd(odd, empty):
    out = merkle.edited_likeness(odd).collect()
    assert len(out) == odd.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    prints = {(r.doc_id, r.fingerprint) for r in out}
    assert len({f for d, f in prints if d in (7, 8)}) == 1
    assert len({f for d, f in prints if d in (2, 3)}) == 1
    assert merkle.edited_likeness(empty).count() == 0
    assert merkle.fingerprints(odd).count() == odd.count()


def test_single(spark):
    r = merkle.edited_likeness(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert r.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and r.near_next == 1.0


def test_no_python(docs):
    plan = merkle.edited_likeness(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
