"""Grouped validation, boosted trees, calibration."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epochal import session
from epochal.operators import stats


def fold_sizes(panel: DataFrame, fold: str, group: str) -> DataFrame:
    """fold, held_out, rest, ids: rows held out in each fold, the others, and its groups."""
    sizes = panel.groupBy(fold).agg(F.count("*").alias("held_out"), F.countDistinct(group).alias("ids"))
    total = F.sum("held_out").over(Window.partitionBy(F.lit(1)))  # a row a fold
    return sizes.select(fold, "held_out", (total - F.col("held_out")).alias("rest"), "ids")


def split_by_group(panel: DataFrame, held_out: DataFrame, group: str, forward: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the other groups and of the held-out ones; forward: of the others only those before in that column."""
    inside = panel.join(held_out.select(group).distinct(), group, "left_semi")
    outside = panel.join(held_out.select(group).distinct(), group, "left_anti")
    if forward:
        first = inside.agg(F.min(forward).alias("first")).first().first
        outside = outside.filter(F.col(forward) < F.lit(first))
    return outside, inside


def pipeline(numbers: list[str], labels: list[str], rounds: int = 20, depth: int = 4, seed: int = 1) -> Pipeline:
    """Categories one-hot (unknown ones apart), numbers as they are, boosted trees that stop early on the rows marked is_check."""
    index = StringIndexer(inputCols=labels, outputCols=[f"{c}_no" for c in labels], handleInvalid="keep")
    hot = OneHotEncoder(inputCols=[f"{c}_no" for c in labels], outputCols=[f"{c}_hot" for c in labels])
    join = VectorAssembler(inputCols=[*numbers, *[f"{c}_hot" for c in labels]], outputCol="inputs", handleInvalid="keep")
    trees = GBTClassifier(featuresCol="inputs", labelCol="target", maxIter=rounds, maxDepth=depth, seed=seed, validationIndicatorCol="is_check", validationTol=0.001, weightCol="weight")
    return Pipeline(stages=[index, hot, join, trees])


#: Quantile bins of a number: as many as the trees tell apart.
BINS = 32


def fit(rows: DataFrame, numbers: list[str], labels: list[str], **how) -> PipelineModel:
    """The pipeline fitted by histograms of all rows: numbers are cut at quantiles of these rows, and the trees see each cell
    of bins, labels, target and is_check once, weighed by its rows, so that each of their passes is over cells."""
    cuts = rows.approxQuantile(numbers, [i / BINS for i in range(1, BINS)], 1 / (BINS * BINS))
    splits = [[float("-inf"), *(sorted(set(c)) or [0.0]), float("inf")] for c in cuts]
    names = [f"{c}_bin" for c in numbers]
    bins = Bucketizer(splitsArray=splits, inputCols=numbers, outputCols=names)
    cells = bins.transform(rows).groupBy(*labels, *names, "target", "is_check").agg(F.count("*").cast("double").alias("weight"))
    return PipelineModel([bins, pipeline(names, labels, **how).fit(session.pinned(cells))])


def prepared(panel: DataFrame, numbers: list[str], labels: list[str]) -> DataFrame:
    """Missing numbers and infinities as 0, missing labels as a level of their own."""
    clean = {c: F.when(F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf")), 0.0).otherwise(F.col(c).cast("double")) for c in numbers}
    return panel.withColumns(clean | {c: F.coalesce(F.col(c), F.lit("__MISSING__")) for c in labels})


def scored_by(model, rows: DataFrame) -> DataFrame:
    """Rows with prob, by a fitted pipeline."""
    return model.transform(rows.withColumn("is_check", F.lit(False))).select(*rows.columns, vector_to_array("probability")[1].alias("prob"))


#: Models that are fitted at a time.
AT_ONCE = 4


def out_of_fold(panel: DataFrame, numbers: list[str], labels: list[str], fold: str, folds: list, group: str = "id", **how) -> DataFrame:
    """Rows of the folds with prob, each from a model fitted on the rows of other folds, none of a group of the fold.
    Models are fitted side by side; the panel is stored with the folds that each row's group has rows in."""
    within = F.collect_set(fold).over(Window.partitionBy(group))
    panel = session.stored(prepared(panel, numbers, labels).withColumn("_within", within))

    def one(value):
        rest = panel.filter(~F.array_contains("_within", F.lit(value)))
        model = fit(rest.withColumn("is_check", F.pmod(F.xxhash64(group), F.lit(10)) == 0), numbers, labels, **how)
        return scored_by(model, panel.filter(F.col(fold) == value).drop("_within"))

    with ThreadPoolExecutor(AT_ONCE) as pool:
        parts = list(pool.map(one, folds))
    return reduce(DataFrame.unionByName, parts)


def calibrated(scored: DataFrame, known: DataFrame, score: str = "prob", label: str = "target") -> DataFrame:
    """Adds calibrated, by isotonic regression within 1e-6 of 0 and 1, fitted on other rows, whose labels are known."""
    weighted = known.groupBy(score).agg(F.avg(label).alias("label"), F.count("*").cast("double").alias("weight"))
    model = IsotonicRegression(featuresCol=score, labelCol="label", weightCol="weight", predictionCol="_c").fit(weighted)
    return model.transform(scored).withColumn("calibrated", F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), F.col("_c")))).drop("_c")


def held_out_forward(panel: DataFrame, numbers: list[str], labels: list[str], year: str, train_to: int, folds: int = 3, group: str = "id", **how) -> DataFrame:
    """Rows of the years after train_to with prob and calibrated; nothing of these years is seen before.

    The model is fitted on the years before train_to and stops early by the year train_to. The calibrator is fitted on
    what models of folds of groups, up to train_to, say of rows that they have not seen. Groups that have rows
    in both are left out of the earlier years.
    """
    panel = session.stored(prepared(panel, numbers, labels))
    later = panel.filter(F.col(year) > train_to)
    early, later = split_by_group(panel, later, group, forward=year)
    later = later.filter(F.col(year) > train_to)
    early = session.stored(early.withColumn("_fold", F.pmod(F.xxhash64(group, F.lit("fold")), F.lit(folds))))
    seen = session.stored(out_of_fold(early, numbers, labels, "_fold", list(range(folds)), group, **how).select("prob", "target"))
    model = fit(early.withColumn("is_check", F.col(year) == train_to), numbers, labels, **how)
    return calibrated(scored_by(model, later), seen)


NUMBERS, LABELS = ["elo_gap", "kpi_mean", "rnd"], ["surface"]


def example_panel(spark, sf_dir) -> DataFrame:
    """The panel with a rating gap, a lagged average, round, surface, year and target."""
    from epochal.functions import features as fx
    from epochal.operators import panel, ratings, scans
    from epochal.sources import tables

    m = tables.matches(spark, sf_dir)
    order = ["start_dtm", "tournament_id", "rnd", "id"]
    elo = ratings.elo_by_round(m, order, order[:3])
    s = tables.stats(spark, sf_dir).select("id", fx.ratio(F.col("won_points"), F.col("all_points")).alias("kpi"))
    p = panel.unpivot(m).join(s, "id", "left").join(elo.select("id", (F.col("winner_elo") - F.col("loser_elo")).alias("gap")), "id")
    p = scans.means(p, ["player_code"], F.trunc("start_dtm", "month"), order, {"kpi_mean": (F.col("kpi"), 1)})
    won = F.col("match_result") == "win"
    gap = F.when(won, F.col("gap")).otherwise(-F.col("gap"))
    return p.select("id", "player_code", "tournament_id", fx.leading_year(F.col("tournament_id")).alias("year"), F.col("rnd").cast("double").alias("rnd"), "surface", gap.alias("elo_gap"), "kpi_mean", won.cast("double").alias("target"))


def yearly_metrics(panel: DataFrame, **how) -> DataFrame:
    """year, n, auc, brier, log_loss, accuracy of every year, each held out from its model and from its calibrator,
    which is fitted on the other years' rows."""
    panel = session.stored(panel)
    years = sorted(r.year for r in panel.select("year").distinct().collect())  # a row a year
    scored = session.stored(out_of_fold(panel, NUMBERS, LABELS, "year", years, **how))
    parts = [calibrated(scored.filter(F.col("year") == y), scored.filter(F.col("year") != y)) for y in years]
    held = session.pinned(reduce(DataFrame.unionByName, parts).withColumn("label", F.col("target").cast("int")))
    counts = held.groupBy("year").agg(F.count("*").alias("n"))
    out = counts.join(stats.auc_by(held, "year", "calibrated", "label"), "year").join(stats.losses(held, "calibrated", "label", by=["year"]), "year")
    return out.select("year", "n", *[F.round(c, 6).alias(c) for c in ("auc", "brier", "log_loss", "accuracy")])
