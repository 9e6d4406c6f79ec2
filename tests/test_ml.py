"""Held-out models: nothing of a test year reaches the model or its calibrator."""

import random

import pytest
from pyspark.sql import functions as F

from epochal.operators import ml, stats


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        x = rng.gauss(0, 1)
        rows.append((i // 2, 2000 + i // 100, x, rng.choice(["a", "b", None]), float(rng.random() < 1 / (1 + 2.718 ** (-2 * x)))))
    return spark.createDataFrame(rows, "id int, year int, x double, kind string, target double").cache()


def test_test_years_are_not_seen(panel):
    """Other labels of the test years change neither probabilities nor calibrated ones; other labels before do."""
    run = lambda p: sorted((r.id, round(r.prob, 9), round(r.calibrated, 9)) for r in ml.held_out_forward(p, ["x"], ["kind"], "year", 2003, folds=2, rounds=3).collect())
    flip = lambda cond: panel.withColumn("target", F.when(cond, 1 - F.col("target")).otherwise(F.col("target")))
    base = run(panel)
    assert len(base) == 200 and base == run(flip(F.col("year") > 2003))
    assert base != run(flip(F.col("year") <= 2003))


def test_calibrator_is_fitted_on_other_rows(spark):
    known = spark.createDataFrame([(0.2, 0.0), (0.4, 0.0), (0.6, 1.0), (0.8, 1.0)], "prob double, target double")
    rows = spark.createDataFrame([(0.1, 1.0), (0.9, 0.0)], "prob double, target double")
    assert [round(r.calibrated, 5) for r in ml.calibrated(rows, known).orderBy("prob").collect()] == [0.0, 1.0]


def test_metrics_by_group(panel):
    scored = panel.select("year", F.round(1 / (1 + F.exp(-F.col("x"))), 1).alias("p"), F.col("target").cast("int").alias("y"))
    by = {r.year: r.auc for r in stats.auc_by(scored, "year", "p", "y").collect()}
    for year in by:
        some = scored.filter(F.col("year") == year)
        assert by[year] == pytest.approx(stats.auc(some, "p", "y").first().auc)
        assert tuple(stats.losses(scored, "p", "y", by=["year"]).filter(F.col("year") == year).drop("year").first()) == pytest.approx(tuple(stats.losses(some, "p", "y").first()))


def test_every_year_is_held_out(panel):
    """Metrics cover all rows of all years, not those of the last ones."""
    rows = panel.filter("year >= 2003").select("id", "year", F.col("x").alias("elo_gap"), F.col("x").alias("kpi_mean"), F.lit(6.0).alias("rnd"), F.col("kind").alias("surface"), "target")
    found = {r.year: r.n for r in ml.yearly_metrics(rows, rounds=2).collect()}
    assert found == {r.year: r.n for r in rows.groupBy("year").agg(F.count("*").alias("n")).collect()} and len(found) == 3
