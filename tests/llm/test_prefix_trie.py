"""The trie against dictionaries of prefixes."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from epochal.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def want(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in convs.items()}
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        family = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        turns = tuple(convs.get(family, [])[:h] + own[h:])
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    children, total = {}, {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        leaves, saved = (0 if p in children else 1), (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        for q in children.get(p, ()):
            leaves, saved = leaves + total[q][0], saved + total[q][1]
        total[p] = leaves, saved
    return sorted(
        ((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, ())), *total[p], sha256(",".join(map(str, sorted(ends.get(p, ())))).encode()).hexdigest()) for p, m in members.items()),
        key=str,
    )


def got(df, **how):
    return sorted(map(tuple, prefix_trie.trie(df, **how).select(*OUT).collect()), key=str)


@pytest.mark.parametrize("band", [2, 4])
def test_conversations(spark, sf, band):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert got(df, band=band) == want(map(tuple, df.select(*SCHEMA.split(" ")[::2]).collect()))


def test_copies_and_branches(spark):
    """Conversations that share long beginnings, and copies of them, in bands of any height."""
    rng = random.Random(2)
    base = [[(rng.choice("ab"), rng.choice(["x", "y", ""])) for _ in range(rng.randrange(0, 40))] for _ in range(4)]
    rows = []
    for c in range(-30, 120):
        turns = list(rng.choice(base))
        if rng.random() < 0.6:
            turns = turns[: rng.randrange(len(turns) + 1)] + [("a", rng.choice("xyz")) for _ in range(rng.randrange(4))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    expected = want(rows)
    for band in (2, 3, 4, 16):
        assert got(df, band=band) == expected


def test_odd(spark):
    """Nulls in all columns, ties, repeated rows, columns with clashing names, no rows at all."""
    rows = [(1, None, "a", "late"), (1, None, None, None), (1, 2, "a", "é"), (1, 2, "a", "é"), (1, 2, "", "b"), (None, 1, "a", "no id"), (2, 0, "user", "x" * 5000), (5, 1, None, "x"), (6, 1, "", "x"), (7, 1, "", "x"), (10, None, None, None), (-3, 1, "a", "b"), (-5, 1, "q", "b"), (2**62, 1, "a", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.withColumns({"conv": F.lit(3), "h1": F.lit("z"), "depth": F.lit(0.5), "place": F.lit(None).cast("int")})
    assert got(extra) == want(rows)
    assert prefix_trie.trie(df.limit(0)).count() == 0


def test_one_long_conversation_over_many_parts(spark):
    """One conversation with nearly all rows, and copies of it: no part has all of it, sums are exact."""
    rows = [(c, i, "r", f"t{i % 7}") for c in (5, 10, 15) for i in range(700)] + [(20, i, "r", f"t{i % 7}") for i in range(300)] + [(21, 1, "r", "t")]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        assert got(df) == want(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_digest_of_many_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 20)
    rows = [(c, 1, "r", "same") for c in range(400)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == want(rows)
