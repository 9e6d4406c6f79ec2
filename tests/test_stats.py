"""Correlations of many columns at once, ranks, and draws that follow their cell."""

import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from epochal.operators import stats


@pytest.fixture(scope="module")
def wide(spark):
    rng = random.Random(9)
    rows = []
    for i in range(500):
        x = rng.gauss(1e6, 3)
        cells = [x, -2 * x + rng.gauss(0, 4), float(rng.randrange(4)), 7.0, rng.gauss(0, 1), None]
        rows.append(tuple(None if rng.random() < 0.2 else c for c in cells))
    return rows, spark.createDataFrame(rows, ", ".join(f"c{k} double" for k in range(6))).repartition(5)


def test_pairwise_complete(wide):
    rows, df = wide
    got = {(r.a, r.b): (r.r, r.n) for r in stats.correlations(df, df.columns).collect()}
    assert len(got) == 15
    for i in range(6):
        for j in range(i + 1, 6):
            both = np.array([(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None], "f8").reshape(-1, 2)
            r, n = got[f"c{i}", f"c{j}"]
            assert n == len(both)
            if n < 2 or 3 in (i, j):
                assert r is None
            else:
                assert r == pytest.approx(np.corrcoef(both.T)[0, 1], abs=1e-9)


def test_ranks(wide):
    rows, df = wide
    got = stats.average_ranks(df.withColumn("id", F.monotonically_increasing_id()), ["c0", "c2", "c5"])
    assert got.columns == [*df.columns, "id"] and got.count() == len(rows)
    known = sorted(r[2] for r in rows if r[2] is not None)
    want = sorted(known.index(v) + (known.count(v) + 1) / 2 for v in known)
    assert sorted(r.c2 for r in got.collect() if r.c2 is not None) == want
    assert got.filter("c5 is not null").count() == 0


def kolmogorov(df, cell, value, mean, sd):
    """cell, n, far: the largest distance of a cell's values, put in order, from the normal curve of its mean and deviation."""
    from pyspark.sql.window import Window

    placed = df.withColumn("_k", F.row_number().over(Window.partitionBy(cell).orderBy(value))).withColumn("_n", F.count("*").over(Window.partitionBy(cell)))
    curve = F.udf(lambda v, m, s: NormalDist(m, s).cdf(v), "double")(value, mean, sd)
    far = F.greatest(F.abs(F.col("_k") / F.col("_n") - curve), F.abs((F.col("_k") - 1) / F.col("_n") - curve))
    return {r[cell]: (r.n, r.far) for r in placed.groupBy(cell).agg(F.count("*").alias("n"), F.max(far).alias("far")).collect()}


def test_draws_follow_their_cell(spark):
    """Within the bound of one in a thousand in each cell; draws that ignore the cell are far out."""
    df = spark.range(4000).withColumn("cell", F.col("id") % 4).withColumns({"mean": 100.0 + 20.0 * F.col("cell"), "sd": 5.0 + F.col("cell")})
    drawn = lambda mean, sd: df.withColumn("v", stats.drawn(F.col("id"), mean, sd, 1.0, 500.0))
    bound = lambda n: 1.95 / math.sqrt(n)
    own = kolmogorov(drawn(F.col("mean"), F.col("sd")), "cell", "v", "mean", "sd")
    blind = kolmogorov(drawn(F.lit(130.0), F.lit(6.5)), "cell", "v", "mean", "sd")
    assert len(own) == 4 and all(far < bound(n) for n, far in own.values())
    assert sum(far > bound(n) for n, far in blind.values()) >= 3


def test_ranks_of_a_frequent_value_stay_spread(spark):
    """Rows of a value that is nearly everywhere are not brought into one task to get their rank."""
    df = spark.range(0, 8000, 1, 8).selectExpr("case when id % 50 = 0 then cast(id as double) else 7.5d end as x")
    ranked = {(r.x): r.n for r in stats.average_ranks(df, ["x"]).groupBy("x").agg(F.count("*").alias("n")).collect()}
    assert len(ranked) == 161 and sum(ranked.values()) == 8000 and ranked[1 + (1 + 7840) / 2] == 7840
    melted = df.selectExpr("monotonically_increasing_id() as _row", "0 as c", "x as v")
    ranks = melted.groupBy("c", "v").agg(F.count("*").alias("_n"), F.lit(1.0).alias("_rank"))
    sizes = stats.with_ranks(melted, ranks).filter("v = 7.5").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) <= 1000
