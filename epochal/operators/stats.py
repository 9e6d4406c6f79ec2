"""Statistics over feature columns: correlations, shrinkage, profiles, thresholds, imputation."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epochal import session
from epochal.operators import order


MOMENTS = "i int, n array<double>, x array<double>, xx array<double>, xy array<double>"


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """a, b, r, n for each pair of columns over the rows where both are known; NaN counts as unknown.

    One scan makes, in each task, the Gram matrices of all columns and of what is known of them, shifted by the
    columns' means; a task sends a row of sums a pair, whatever its rows. A second, slim scan before it gives
    the means and the number of pairs grows with the square of the columns, not with the rows.
    """
    columns, count = list(columns), len(columns)
    number = {c: F.col(c).cast("double") for c in columns}
    known = df.select(*[F.when(~F.isnan(v), v).alias(c) for c, v in number.items()])
    means = known.agg(*[F.avg(c).alias(c) for c in columns]).first()  # one row
    shift = np.array([m if (m := means[c]) is not None else 0.0 for c in columns])

    def gram(batches):
        total = np.zeros((4, count, count))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1) if count else np.zeros((0, 0))
            there = ~np.isnan(x)
            m, x = there.astype("f8"), np.where(there, x - shift, 0.0)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        names = [f.split()[0] for f in MOMENTS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(range(count), pa.int32()), *[pa.array(t.tolist(), pa.list_(pa.float64())) for t in total]], names)

    rows = known.mapInArrow(gram, MOMENTS)
    cells = rows.select("i", F.posexplode(F.arrays_zip("n", "x", "xx", "xy")).alias("j", "m")).groupBy("i", "j").agg(*[F.sum(f"m.{k}").alias(k) for k in ("n", "x", "xx", "xy")])
    other = cells.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("x").alias("y"), F.col("xx").alias("yy"))
    both = cells.filter("i < j").join(other, ["i", "j"])  # a row a pair
    spread = F.sqrt((F.col("xx") - F.col("x") * F.col("x") / F.col("n")) * (F.col("yy") - F.col("y") * F.col("y") / F.col("n")))
    r = F.try_divide(F.col("xy") - F.col("x") * F.col("y") / F.col("n"), spread)
    name = F.array(*map(F.lit, columns)) if columns else F.array(F.lit(None).cast("string"))
    one = F.when((F.col("n") > 0) & (spread > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    return both.select(F.get(name, F.col("i")).alias("a"), F.get(name, F.col("j")).alias("b"), one.alias("r"), F.col("n").cast("long").alias("n"))


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column replaced by its average rank; null stays null.

    Values of all columns are melted; equal ones are counted, and the distinct values of all columns are put in
    order by one deal of ranges. Ranks go back to their rows by one join and one aggregate. Values with more than
    a quarter of an even part of all are at most four a part: their rows stay where they are and meet a broadcast.
    """
    columns = list(columns)
    rows = session.pinned(df.withColumn("_row", F.monotonically_increasing_id()))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]))
    melted = rows.select("_row", each.alias("_e")).select("_row", "_e.*").filter("v is not null")
    tally = melted.groupBy("c", "v").agg(F.count("*").alias("_n"))
    placed = order.running_totals(tally, [F.col("c"), F.col("v")], {"_below": F.col("_n")})
    starts = placed.groupBy("c").agg(F.min("_below").alias("_start"))  # a row a column
    ranks = placed.join(starts, "c").select("c", "v", "_n", (F.col("_below") - F.col("_start") + (F.col("_n") + 1) / 2).alias("_rank"))
    ranks = session.pinned(ranks)
    back = with_ranks(melted, ranks).groupBy("_row").agg(*[F.max(F.when(F.col("c") == i, F.col("_rank"))).alias(c) for i, c in enumerate(columns)])
    others = [c for c in df.columns if c not in columns]
    return rows.select("_row", *others).join(back, "_row", "left").select(*df.columns)


def with_ranks(melted: DataFrame, ranks: DataFrame) -> DataFrame:
    """melted with _rank of each c and v; no task gets the rows of a frequent value (_n: rows of a value)."""
    parts = int(melted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = ranks.agg(F.sum("_n")).first()[0] or 0  # one row
    hot = F.col("_n") > total // (4 * parts)
    frequent, others = ranks.filter(hot).drop("_n"), ranks.filter(~hot).drop("_n")  # four a part at most
    rest = melted.join(F.broadcast(frequent.drop("_rank")), ["c", "v"], "left_anti")
    return melted.join(F.broadcast(frequent), ["c", "v"]).unionByName(rest.join(others, ["c", "v"]))


def p_value(r: float | None, n: int | None) -> float | None:
    """Two-sided p of a correlation by the t distribution, with the incomplete beta function."""
    if r is None or n is None or n < 3 or math.isnan(r):
        return None
    if abs(r) >= 1:
        return 0.0
    df = n - 2
    return _beta_share(df / 2, 0.5, df / (df + r * r * df / (1 - r * r)))


def _beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_share(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > 1e-30 else 1e-30)
    out = d
    for k in range(1, 300):
        for top in (k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k)), -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))):
            d = 1 + top * d
            d = 1 / (d if abs(d) > 1e-30 else 1e-30)
            c = 1 + top / c
            c = c if abs(c) > 1e-30 else 1e-30
            out *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return front * out


#: Strength of the prior by the kind of a column, and how near to 0 and 1 shares may come.
WEIGHTS, EDGE = {"log_ratio": 30.0, "share": 20.0, "mean": 10.0}, 1e-6


def kind_of(column: str) -> str:
    if re.search(r"log_ratio", column):
        return "log_ratio"
    return "share" if re.search(r"_pct(_|$)|_share$|_rate$|_efficiency$", column) else "mean"


def profile(df: DataFrame, columns: Sequence[str], also: str | None = None) -> dict[str, float | None]:
    """mean_<column> and most_<column> in one aggregate; also: a prefix of columns that have the same ones."""
    known = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("most", F.max))]).first().asDict()  # one row
    return known | ({f"{n}_{also}{c}": known[f"{n}_{c}"] for c in columns for n in ("mean", "most")} if also else {})


def shrink(df: DataFrame, columns: Sequence[str], exposure: str | dict[str, str | Column], known: dict[str, float | None] | None = None) -> DataFrame:
    """Each column drawn to its prior by exposure / (exposure + weight), with <column>_was_na.

    exposure: the column that counts what stands behind a value, one for all or one for each column. Shares and
    means are drawn to their mean over all rows (one aggregate for all columns; 0.5 and 0 where no value is
    known), log ratios to 0; a missing value becomes its prior. Shares are of one, or of a hundred in a column
    whose largest value is above 1.5, and stay EDGE away from both ends. known: their profile, if it is made already.
    """
    known = profile(df, [c for c in columns if kind_of(c) != "log_ratio"]) if known is None else known
    out = {}
    for c in columns:
        kind, mean, most = kind_of(c), known.get(f"mean_{c}"), known.get(f"most_{c}")
        seen = exposure if isinstance(exposure, str) else exposure[c]
        n = F.coalesce(F.col(seen) if isinstance(seen, str) else seen, F.lit(0))
        unit = 100.0 if kind == "share" and most is not None and most > 1.5 else 1.0
        prior = F.lit(0.0 if kind == "log_ratio" else mean / unit if mean is not None else 0.5 if kind == "share" else 0.0)
        part = n / (n + F.lit(WEIGHTS[kind]))
        value = part * F.coalesce(F.col(c) / unit, prior) + (1 - part) * prior
        out[c] = F.least(F.lit(1 - EDGE), F.greatest(F.lit(EDGE), value)) * unit if kind == "share" else value
    flags = {f"{c}_was_na": F.col(c).isNull().cast("int") for c in columns}
    return df.select(*[F.col(c) for c in df.columns if c not in columns], *[v.alias(k) for k, v in (out | flags).items()])


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, null_share: one pass over all columns."""
    columns = columns or df.columns
    cells = [F.struct(F.lit(c).alias("column"), F.avg(F.col(c).isNull().cast("double")).alias("null_share")) for c in columns]
    return df.agg(F.array(*cells).alias("_c")).select(F.explode("_c").alias("_c")).select("_c.*")


def frequencies(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """Count and share of each fixed level, those without rows too."""
    spark = df.sparkSession
    fixed = spark.createDataFrame([(x,) for x in levels], f"{column} string")
    counted = fixed.join(df.groupBy(column).agg(F.count("*").alias("n")), column, "left").fillna(0, ["n"])
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # a row a level
    return counted.select(column, "n", F.try_divide(F.col("n"), total).alias("share"))


def prefix_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """score, hits, misses: positives and negatives with at least each distinct score.

    Counts of equal scores come first; distinct scores are put in order by ranges, not in one task.
    """
    tally = scored.groupBy(score).agg(F.sum(label).alias("_p"), F.sum(1 - F.col(label)).alias("_n"))
    above = order.running_totals(tally, [F.desc(score)], {"_hits": F.col("_p"), "_misses": F.col("_n")})
    return above.select(score, (F.col("_hits") + F.col("_p")).alias("hits"), (F.col("_misses") + F.col("_n")).alias("misses"))


def best_threshold(scored: DataFrame, score: str, label: str, cost_fp: float = 1.0, cost_fn: float = 1.0) -> DataFrame:
    """threshold, cost: the score at or above which calling positive costs least; 1 + 1e-12 where calling nothing does.

    The positives that a threshold misses are those at lower scores: the positives in all less its hits,
    which is the same number for every threshold, so one aggregate finds the best and adds it.
    """
    curve = prefix_counts(scored, score, label)
    gain = F.col("misses") * cost_fp - F.col("hits") * cost_fn
    best = curve.agg(F.min(F.struct(gain.alias("gain"), F.col(score).alias("threshold"))).alias("_b"), F.max("hits").alias("_all"))
    called = (F.col("_b.gain") + F.col("_all") * cost_fn).cast("double")
    none = (F.col("_all") * cost_fn).cast("double")
    return best.select(F.when(none < called, F.lit(1 + 1e-12)).otherwise(F.col("_b.threshold")).alias("threshold"), F.least(called, none).alias("cost"))


def auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """auc: share of positive-negative pairs in order, ties by half, from counts of equal scores."""
    tally = scored.groupBy(score).agg(F.sum(label).alias("_p"), F.sum(1 - F.col(label)).alias("_n"))
    steps = order.running_totals(tally, [F.col(score)], {"_below": F.col("_n")})
    return steps.agg(F.try_divide(F.sum(F.col("_p") * (F.col("_below") + F.col("_n") / 2)), F.sum("_p") * F.sum("_n")).alias("auc"))


def losses(scored: DataFrame, score: str, label: str, clip: float = 1e-6, by: Sequence[str] = ()) -> DataFrame:
    """brier, log_loss, accuracy in one aggregate, of all rows or of each group."""
    p = F.least(F.lit(1 - clip), F.greatest(F.lit(clip), F.col(score)))
    y = F.col(label)
    return scored.groupBy(*by).agg(F.avg((F.col(score) - y) * (F.col(score) - y)).alias("brier"), F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"), F.avg(((F.col(score) >= 0.5).cast("int") == y).cast("double")).alias("accuracy"))


def auc_by(scored: DataFrame, by: str, score: str, label: str) -> DataFrame:
    """by, auc: as auc for each group; the distinct scores of all groups are put in order at once."""
    tally = scored.groupBy(by, score).agg(F.sum(label).alias("_p"), F.sum(1 - F.col(label)).alias("_n"))
    steps = order.running_totals(tally, [F.col(by), F.col(score)], {"_below": F.col("_n")})
    first = F.min("_below")  # what all groups before come to
    sums = steps.groupBy(by).agg(F.sum(F.col("_p") * (F.col("_below") + F.col("_n") / 2)).alias("_s"), first.alias("_first"), F.sum("_p").alias("_ps"), F.sum("_n").alias("_ns"))
    return sums.select(by, F.try_divide(F.col("_s") - F.col("_first") * F.col("_ps"), F.col("_ps") * F.col("_ns")).alias("auc"))


def drawn(key: Column, mean: Column, deviation: Column, least: float, most: float, seed: int = 1) -> Column:
    """A normal draw that depends on the key and the seed only, whatever the partitioning, within bounds. Its two uniform
    numbers are the first 32 bits of MD5 of key, seed and 1 or 2, so that other engines draw the same."""
    bits = lambda k: F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)), F.lit(str(k))).cast("binary")), 1, 8), 16, 10)
    uniform = lambda k: (bits(k).cast("double") + 0.5) / float(1 << 32)
    normal = F.sqrt(-2 * F.log(uniform(1))) * F.cos(2 * math.pi * uniform(2))
    value = mean + normal * deviation
    return F.when(value.isNotNull(), F.least(F.lit(most), F.greatest(F.lit(least), value)))


def largest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """name, most: the largest value of each column, in one aggregate."""
    cells = [F.struct(F.lit(c).alias("name"), F.max(c).alias("most")) for c in columns]
    return df.agg(F.array(*cells).alias("_c")).select(F.explode("_c").alias("_c")).select("_c.*")


def by_tier(scored: DataFrame, tier: str, tokens: Sequence[str], also: Sequence[str] = (), score: str = "score", label: str = "hit") -> DataFrame:
    """tier, the columns of also, n, brier, accuracy: each row counts in every token that begins its tier."""
    fits = F.filter(F.array(*map(F.lit, tokens)), lambda t: F.startswith(F.col(tier), t))
    rows = scored.select(*also, F.explode(fits).alias("tier"), F.col(score).alias("_s"), F.col(label).alias("_y"))
    return rows.groupBy("tier", *also).agg(F.count("*").alias("n"), F.avg((F.col("_s") - F.col("_y")) * (F.col("_s") - F.col("_y"))).alias("brier"), F.avg(((F.col("_s") >= 0.5).cast("int") == F.col("_y")).cast("double")).alias("accuracy"))
