"""Two-level scans and range sums against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from epochal.operators import scans, temporal


def rows_of(seed, keys, n=400):
    rng = random.Random(seed)
    return [(i, rng.choice(keys), rng.randrange(60), rng.choice([None, *range(9)])) for i in range(n)]


@pytest.fixture(params=[["a", "b", None], ["one"]], ids=["keys", "one_key"])
def data(spark, request):
    rows = rows_of(1, request.param)
    return rows, spark.createDataFrame(rows, "id int, k string, at int, v int").repartition(3)


def earlier(rows, r):
    return [x for x in rows if x[1] == r[1] and (x[2], x[0]) < (r[2], r[0])]


@pytest.mark.parametrize("width", [1, 7, 100])
def test_before(data, width):
    rows, df = data
    out = scans.before(df, ["k"], F.floor(F.col("at") / width), ["at", "id"], {"s": F.col("v"), "n": F.lit(1)}, {"m": F.col("v")}, {"l3": (F.col("v"), 3), "l1": (F.col("v"), 1)})
    got = {r.id: (r.s, r.n, r.m, r.l3, r.l1) for r in out.collect()}
    assert len(got) == len(rows) and out.columns == [*df.columns, "s", "n", "m", "l3", "l1"]
    for r in rows:
        past = sorted(earlier(rows, r), key=lambda x: (x[2], x[0]))
        known = [x[3] for x in past if x[3] is not None]
        values = [x[3] for x in past]
        assert got[r[0]] == (sum(known), len(past), min(known, default=None), values[-3:], values[-1:])


def test_means(data):
    rows, df = data
    got = {r.id: r.x for r in scans.means(df, ["k"], F.floor(F.col("at") / 5), ["at", "id"], {"x": (F.col("v"), 4)}).collect()}
    for r in rows:
        known = [x[3] for x in earlier(rows, r) if x[3] is not None]
        assert got[r[0]] == (pytest.approx(sum(known) / len(known)) if len(known) >= 4 else None)


def test_range_sums(data):
    rows, df = data
    df = df.withColumns({"moment": F.col("at") * 24 + F.col("id") % 5, "at": F.col("at").cast("long")})
    out = scans.range_sums(df, ["k"], "at", "moment", {"s": F.col("v"), "n": F.lit(1)}, {"_9": 9, "_30": 30})
    got = {r.id: (r.s_9, r.s_30, r.n_9, r.n_30) for r in out.collect()}
    for r in rows:
        inside = lambda d: [x for x in rows if x[1] == r[1] and x[2] >= r[2] - d and x[2] * 24 + x[0] % 5 < r[2] * 24 + r[0] % 5]  # noqa: B023, E731
        total = lambda d: sum(x[3] or 0 for x in inside(d))  # noqa: B023, E731
        assert got[r[0]] == (total(9), total(30), len(inside(9)), len(inside(30)))


def test_running_best_with_a_seed(data):
    rows, df = data
    out = temporal.running_best(df.withColumn("seed", F.lit(4)), "v", "seed", ["k"], ["at", "id"], "best", F.floor(F.col("at") / 10))
    got = {r.id: r.best for r in out.collect()}
    for r in rows:
        past = sorted([*earlier(rows, r), r], key=lambda x: (x[2], x[0]))
        assert got[r[0]] == min(x for x in [4, *[x[3] for x in past[1:]]] if x is not None)


def test_one_key_is_spread(spark):
    """With one key only, no task of the scan has more than a few even parts' rows."""
    df = spark.range(20_000).selectExpr("id", "1 as k", "cast(id % 400 as int) as at")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = scans.before(df, ["k"], F.col("at"), ["id"], {"n": F.lit(1)})
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 2 * 20_000 / 4


def test_no_rows(spark):
    df = spark.createDataFrame([], "id int, k string, at long, v int")
    assert scans.before(df, ["k"], F.col("at"), ["at"], {"s": F.col("v")}, last={"l": (F.col("v"), 2)}).count() == 0
    assert scans.range_sums(df.withColumn("m", F.col("at")), ["k"], "at", "m", {"s": F.col("v")}, {"": 3}).count() == 0
