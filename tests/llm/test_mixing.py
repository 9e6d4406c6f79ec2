"""Mixing against a plain water-filling loop, and the schedule's evenness."""

from collections import Counter

from epochal.llm import common, mixing
from pyspark.sql import functions as F


def plain_targets(sizes):
    """Share all words by weight; who is above three times its size stops there, the rest shares again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(sizes.values())
    while free:
        w = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] > 3 * sizes[s] * w}
        if not over:
            return target | {s: left * weight[s] / w for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        free -= over
    return target


def check(docs):
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len((r.text or "").split(None)) if (r.text or "").isascii() else len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", r.text)])
    want = plain_targets(sizes)
    placed, pieces = mixing.mixed(docs)
    got = {r.src: (r.target, r.source_size) for r in placed.select("src", "target", "source_size").distinct().collect()}
    for s, target in want.items():
        key = "1" if s is None else "0" + s
        assert abs(got[key][0] - target) < 1e-6 * max(1, target) and got[key][1] == sizes[s]
    out = mixing.taken(docs)
    assert out.count() == len(rows)
    assert out.filter("taken > 3 * size").isEmpty()
    by_target = {r.src: (r.words, r.n) for r in pieces.groupBy("src").agg(F.sum("words").alias("words"), F.countDistinct("slot").alias("n")).collect()}
    for s, target in want.items():
        words, n = by_target.get("1" if s is None else "0" + s, (0, 0))
        assert words <= target + 0.5 + 1e-6 and words >= target - 2.5 * mixing.BLOCK_WORDS
        assert words == min(n * mixing.BLOCK_WORDS, round(target)) or target - words < 1
    assert out.agg(F.sum("taken")).first()[0] == sum(w for w, _ in by_target.values())
    return out


def test_documents(docs):
    a = sorted(map(tuple, check(docs).collect()))
    assert a == sorted(map(tuple, mixing.taken(docs.repartition(3)).collect()))


def test_odd(odd):
    check(odd)


def test_empty(empty):
    assert mixing.taken(empty).count() == 0
    assert mixing.apply(empty).count() == 0


def test_schedule_is_even(spark):
    """Every stretch of the schedule holds each source near its share."""
    sources = spark.createDataFrame([("0a", 0, 600_000), ("0b", 600_000, 300_000), ("0c", 900_000, 100_000)], "src string, share_at long, take long")
    slots = [r.src for r in mixing.schedule(sources, 100).orderBy("slot").collect()]
    assert len(slots) == 10_000
    for lo in range(0, 10_000, 500):
        n = Counter(slots[lo : lo + 500])
        assert abs(n["0a"] - 300) <= 4 and abs(n["0b"] - 150) <= 4 and abs(n["0c"] - 50) <= 4
    ranks = mixing.schedule(sources, 100).groupBy("src").agg(F.max("rank").alias("m"), F.countDistinct("rank").alias("n")).collect()
    assert all(r.m + 1 == r.n for r in ranks)


def test_apply_is_in_slot_order(spark, docs):
    """Rows come in the order of the slots that draw them, as often as their walks are taken."""
    out = [r.doc_id for r in mixing.apply(docs).collect()]
    placed, pieces = mixing.mixed(docs)
    got = pieces.groupBy("src", "starts", "walk", "doc_id").agg(F.sum("words").alias("got"), F.min("slot").alias("slot"))
    rows = got.join(placed.filter("size > 0").select("src", "starts", "size"), ["src", "starts"]).filter("got * 2 > size").collect()
    slot_of = {}
    for r in rows:
        slot_of.setdefault(r.doc_id, []).append(r.slot)
    assert Counter(out) == {d: len(s) for d, s in slot_of.items()}
    place = [min(slot_of[d]) for d in dict.fromkeys(out)]
    assert place == sorted(place)


def test_a_row_that_repeats_very_often_is_spread(spark):
    df = spark.createDataFrame([(7, "a b c", "s")] * 4000 + [(8, "d e", "s"), (9, "f", "t")], "doc_id long, text string, source string")
    sized = mixing._sized(df)
    placed = common.running_totals(sized.withColumn("tie", F.monotonically_increasing_id()), [F.col("src"), F.col("shuffle"), F.col("tie")], {"at": F.col("size")})
    assert placed.filter("doc_id = 7").select("at").distinct().count() == 4000
    assert placed.filter("doc_id = 7").select(F.spark_partition_id().alias("p")).distinct().count() > 1
    out = mixing.taken(df)
    assert out.count() == 4002 and out.filter("taken > 3 * size").isEmpty()


def test_apply_keeps_columns(odd):
    out = mixing.apply(odd)
    assert out.columns == odd.columns
    assert out.filter("text is null").isEmpty()
