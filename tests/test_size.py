"""What is moved or stored by queries that had grown too wide, by their plans."""

import time

import pytest

from epochal import session
from epochal.operators import scans, stats
from epochal.plans import kpi_queries as kpi
from epochal.sources import tables
from pyspark.sql import functions as F


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sides_move_four_sums(spark, sf):
    assert plan_of(tables.sides(spark, sf)).count("partial_sum(") == 4


def test_means_carry_each_value_once(spark):
    df = spark.createDataFrame([(1, "a", 1, 2.0)], "id int, k string, at int, v double")
    assert "_s__n_x" not in plan_of(scans.means(df, ["k"], F.col("at"), ["id"], {"x": (F.col("v"), 1)}))


def test_three_years_pin_moments(spark, sf, monkeypatch):
    seen, pinned = [], session.pinned
    monkeypatch.setattr(session, "pinned", lambda df: seen.append(df.columns) or pinned(df))
    kpi.per_mille_3y(spark, sf)
    assert seen and all("id" not in columns for columns in seen)


def test_priors_made_before(spark):
    df = spark.createDataFrame([(None, 0)], "x_pct double, n int")
    assert stats.shrink(df, ["x_pct"], "n", {"mean_x_pct": 0.25, "most_x_pct": 1.0}).first().x_pct == pytest.approx(0.25)


def test_trees_see_cells(spark, monkeypatch):
    """Each pass of the trees is over cells of bins, labels, target and check, however many rows they have."""
    from epochal.operators import ml

    seen, pinned = [], session.pinned
    monkeypatch.setattr(session, "pinned", lambda df: seen.append(pinned(df)) or seen[-1])
    df = spark.range(2000).selectExpr("cast(id % 3 as double) as x", "'a' as k", "cast(id % 2 as double) as target", "id % 10 = 0 as is_check")
    ml.fit(df, ["x"], ["k"], rounds=1)
    assert seen[-1].count() <= 12 and seen[-1].agg(F.sum("weight")).first()[0] == 2000


def test_a_word_is_remembered_as_one_number():
    from epochal.llm import quality

    assert isinstance(quality._bins("Word"), int)


def test_families_are_dealt_by_match_once(spark, sf):
    """Neither the families' joins nor the partner's values deal the wide rows of feature_table anew."""
    from epochal.plans import feature_queries as fq

    tables_before = spark.catalog.listTables()
    with_conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in with_conf}
    found = fq.table(spark, sf)
    try:
        for k, v in with_conf.items():
            spark.conf.set(k, v)
        plan = plan_of(found.filter("true"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange ") == 0 and plan.count("SortMergeJoin ") == 8
    assert spark.catalog.listTables() == tables_before


def test_steps_release_what_they_shuffled(spark):
    """What a stored step has shuffled is off the disks before the next one, with no collection of garbage in between."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    left = lambda: {str(x) for x in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    held = left()
    with session.released(spark):
        rows = session.stored(spark.range(1000).repartition(7, "id"))
    for _ in range(50):
        if not (left() - held):
            break
        time.sleep(0.1)
    assert not (left() - held)
    assert rows.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
