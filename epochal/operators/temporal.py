"""Point-in-time operators: as-of joins and lagged frames without leaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from epochal.operators import scans


def asof(probe: DataFrame, history: DataFrame, keys: Sequence[str], probe_time: str, history_time: str, values: Sequence[str], strict: bool = False, tie: Sequence[str] = (), slice_width: int | None = None) -> DataFrame:
    """Adds to each probe row the values of the last history row of its keys at or before its time.

    strict: before its time only. History rows of one time are taken in the order of tie, the last
    wins. Both sides are joined in one sort per key, never as a range join. slice_width: with
    integer or date times, keys are split into slices of that many units (days), and the last row of
    the slices before is carried over as the slice's first row, so that a key with very many rows is spread.
    """
    at, value = "_at", F.struct(*[F.col(c) for c in values])
    old = history.select(*keys, F.col(history_time).alias(at), F.lit(1 if strict else 0).alias("_side"), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)], value.alias("_value"))
    new = probe.select(*keys, F.col(probe_time).alias(at), F.lit(0 if strict else 1).alias("_side"), F.struct("*").alias("_row"))
    both = old.unionByName(new, allowMissingColumns=True)
    order = [F.col(at), F.col("_side"), *[F.col(f"_tie{i}") for i in range(len(tie))]]
    parts = list(keys)
    if slice_width:
        number = F.datediff(F.col(at), F.lit("1970-01-01")) if dict(both.dtypes)[at] == "date" else F.col(at)
        both, parts = both.withColumns({"_slice": F.floor(number / slice_width), "_kind": F.lit(1)}), [*keys, "_slice"]
        ends = both.groupBy(*parts).agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))).alias("_value"))
        ahead = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(*parts, F.last("_value", ignorenulls=True).over(ahead).alias("_value"), F.lit(0).alias("_kind"))
        both, order = both.unionByName(carried, allowMissingColumns=True), [F.col("_kind"), *order]
    so_far = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_last", F.last("_value", ignorenulls=True).over(so_far))
    return found.filter("_row is not null").select("_row.*", *[F.col(f"_last.{c}").alias(c) for c in values])


def before(partition: Sequence[str], order: Sequence[Column | str], rows: int | None = None) -> WindowSpec:
    """All rows before the current one, or the last so many; never the current one."""
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding if rows is None else -rows, -1)


def cumulative(value: Column, window: WindowSpec) -> Column:
    """Sum over the rows before; 0 at the first."""
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def exposed_mean(value: Column, window: WindowSpec, least: int = 1) -> Column:
    """Mean of the values before, nulls left out; null until there are so many of them."""
    return F.when(F.count(value).over(window) >= least, F.avg(value).over(window))


def running_best(df: DataFrame, rank: str, seed: str | None, partition: Sequence[str], order: Sequence[str], name: str, block: Column | None = None) -> DataFrame:
    """Adds the smallest rank up to the current row; with a seed, the first row of a partition has it instead of its own rank.
    block: a stretch of time that rises with the order, by which partitions are scanned in two levels."""
    block = F.lit(0) if block is None else block
    own = F.col(rank)
    if seed is not None:
        df = scans.before(df, partition, block, order, {"_earlier": F.lit(1)})
        own = F.when(F.col("_earlier") == 0, F.col(seed)).otherwise(own)
    best = scans.before(df.withColumn("_own", own), partition, block, order, least={"_best": F.col("_own")})
    return best.withColumn(name, F.least("_best", "_own")).drop("_own", "_best", "_earlier")


def never_rises(df: DataFrame, partition: Sequence[str], order: Sequence[Column | str], value: str, name: str) -> DataFrame:
    """The partition's columns and name: whether a value, its gaps filled with the last one, never rises; true without two values."""
    w = Window.partitionBy(*partition).orderBy(*order)
    held = df.select(*partition, *[c for c in order if isinstance(c, str)], F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_held"))
    steps = held.select(*partition, (F.col("_held") <= F.lag("_held").over(w)).alias("_falls"))
    return steps.groupBy(*partition).agg(F.coalesce(F.bool_and("_falls"), F.lit(True)).alias(name))


def previous_event(df: DataFrame, partition: Sequence[str], date: str, value: str, name: str) -> DataFrame:
    """Adds the largest value of the last earlier date of a partition (events on one date don't precede each other)."""
    dates = df.groupBy(*partition, date).agg(F.max(value).alias("_value"))
    dates = dates.withColumn(name, F.lag("_value").over(Window.partitionBy(*partition).orderBy(date))).drop("_value")
    return df.join(dates, [*partition, date], "left")
