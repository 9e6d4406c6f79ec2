"""Prefix scans in two levels, for keys of any size: rows are summed within a block of their key's order, and
what all earlier blocks come to is carried over, one row a block, as the block's first row.

A block is a stretch of time (a column or expression that rises with the order), so a key's blocks are as
many as its calendar has, and no task gets more than a block's rows or a key's blocks. Null keys are a key
of their own; keys and blocks need no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def before(df: DataFrame, keys: Sequence[str], block: Column, order: Sequence[str], sums: dict[str, Column] | None = None, least: dict[str, Column] | None = None, last: dict[str, tuple[Column, int]] | None = None, known: dict[str, Column] | None = None) -> DataFrame:
    """Adds what the rows of a key before the current one come to, in the order of block, then order.

    sums: the sum of a value (nulls left out), 0 at the first row. least: the smallest value, null at the
    first. last: the values of the last so many rows as an array, oldest first, nulls kept. known: as _sum_<name>
    and _n_<name> the sum of a value, as a double, and the number of rows that have it; rows carry the value only.
    """
    sums, least, last, known = dict(sums or {}), least or {}, last or {}, known or {}
    sums |= {f"_sum_{n}": v.cast("double") for n, v in known.items()}
    held = {f"_s_{n}": v for n, v in sums.items()} | {f"_m_{n}": v for n, v in least.items()} | {f"_l_{n}": F.struct(v.alias("v")) for n, (v, _) in last.items()}
    rows = df.withColumn("_block", block).withColumns(held).withColumn("_kind", F.lit(1))
    part = [*keys, "_block"]
    totals = rows.groupBy(*part).agg(F.lit(0).alias("_kind"), *[F.sum(f"_s_{n}").alias(f"_s_{n}") for n in sums], *[F.min(f"_m_{n}").alias(f"_m_{n}") for n in least], *([F.array(*[F.count(f"_s__sum_{n}") for n in known]).alias("_counts")] if known else []))
    if last:
        longest = max(k for _, k in last.values())
        behind = Window.partitionBy(*part).orderBy(*[F.desc(c) for c in order])
        ends = rows.select(*part, *[f"_l_{n}" for n in last], F.row_number().over(behind).alias("_back")).filter(F.col("_back") <= longest)
        tail = lambda n, k: F.transform(F.reverse(F.array_sort(F.collect_list(F.when(F.col("_back") <= k, F.struct("_back", f"_l_{n}"))))), lambda x: x[f"_l_{n}"])
        ends = ends.groupBy(*part).agg(F.lit(0).alias("_kind"), *[tail(n, k).alias(f"_t_{n}") for n, (_, k) in last.items()])
        blank = [F.lit(None).cast(dict(ends.dtypes)[f"_t_{n}"]).alias(f"_t_{n}") for n in last]
        both = totals.select("*", *blank).unionByName(ends, allowMissingColumns=True)
        totals = both.groupBy(*part).agg(F.lit(0).alias("_kind"), *[F.first(c, ignorenulls=True).alias(c) for c in both.columns if c not in {*part, "_kind"}])
    ahead = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = [F.coalesce(F.sum(f"_s_{n}").over(ahead), F.lit(0)).alias(f"_s_{n}") for n in sums] + [F.min(f"_m_{n}").over(ahead).alias(f"_m_{n}") for n in least]
    if known:
        carry.append(F.array(*[F.coalesce(F.sum(F.col("_counts")[i]).over(ahead), F.lit(0)) for i in range(len(known))]).alias("_counts"))
    for n, (_, k) in last.items():  # each earlier block has a row at least, so k blocks hold k rows
        some = F.flatten(F.collect_list(f"_t_{n}").over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(-k, -1)))
        carry.append(_end(some, k).alias(f"_t_{n}"))
    both = rows.unionByName(totals.select(*part, "_kind", *carry), allowMissingColumns=True)
    upto = Window.partitionBy(*part).orderBy("_kind", *order)
    w = upto.rowsBetween(Window.unboundedPreceding, -1)
    out = {n: F.sum(f"_s_{n}").over(w) for n in sums} | {n: F.min(f"_m_{n}").over(w) for n in least}
    for i, n in enumerate(known):
        out[f"_n_{n}"] = F.sum(F.when(F.col("_kind") == 1, F.col(f"_s__sum_{n}").isNotNull().cast("long")).otherwise(F.col("_counts")[i])).over(w)
    for n, (_, k) in last.items():
        start = F.first(f"_t_{n}").over(upto.rowsBetween(Window.unboundedPreceding, 0))
        here = F.collect_list(F.when(F.col("_kind") == 1, F.col(f"_l_{n}"))).over(upto.rowsBetween(-k, -1))
        out[n] = F.transform(_end(F.concat(start, here), k), lambda x: x["v"])
    return both.withColumns(out).filter("_kind = 1").select(*df.columns, *out)


def _end(items: Column, k: int) -> Column:
    """The last k items of an array."""
    return F.slice(items, F.greatest(F.size(items) - k + 1, F.lit(1)), k)


def means(df: DataFrame, keys: Sequence[str], block: Column, order: Sequence[str], values: dict[str, tuple[Column, int]], sums: dict[str, Column] | None = None) -> DataFrame:
    """Adds the mean of the values before, nulls left out; null until so many are known. sums: as in before."""
    totals = [f"{k}_{n}" for k in ("_sum", "_n") for n in values]
    out = before(df, keys, block, order, sums, known={n: v for n, (v, _) in values.items()})
    return out.withColumns({n: F.when(F.col(f"_n_{n}") >= least, F.col(f"_sum_{n}") / F.col(f"_n_{n}")) for n, (_, least) in values.items()}).drop(*totals)


def range_sums(df: DataFrame, keys: Sequence[str], day: str, moment: str, values: dict[str, Column], spans: dict[str, int]) -> DataFrame:
    """Adds, for each value's name and each span's suffix, the sum over rows from so many days before the current day up
    to, but not with, the current moment (which rises with the day); 0 without rows; exact for integers.

    Rows of one moment are summed first, so that a key has as many rows as its calendar has moments. Running
    sums are packed, and the one at a lower bound is looked up as a whole.
    """
    at = [*keys, day, moment]
    found = range_totals(moments(df, at, values), keys, day, moment, list(values), spans)
    return looked_up(df, found, at)


def moments(df: DataFrame, at: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """The sums of the values of the rows that are equal in the columns of at."""
    return df.groupBy(*at).agg(*[F.sum(v).alias(n) for n, v in values.items()])


def range_totals(sums: DataFrame, keys: Sequence[str], day: str, moment: str, values: Sequence[str], spans: dict[str, int]) -> DataFrame:
    """The sums that range_sums adds, a row a moment of a key: sums has one row of each, with the values' sums in it."""
    along = Window.partitionBy(*keys).orderBy(moment)
    running = F.struct(F.col(moment).alias("at"), *[F.coalesce(F.sum(n).over(along.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias(n) for n in values])
    packed = sums.select(*keys, day, moment, running.alias("_to")).withColumn("_upto", F.lag("_to").over(along))
    gone = {s: F.max("_to").over(Window.partitionBy(*keys).orderBy(day).rangeBetween(Window.unboundedPreceding, -d - 1)) for s, d in spans.items()}
    found = packed.withColumns({f"_gone{s}": w for s, w in gone.items()})
    totals = [(F.coalesce(F.col(f"_upto.{n}"), F.lit(0)) - F.coalesce(F.col(f"_gone{s}.{n}"), F.lit(0))).alias(f"{n}{s}") for n in values for s in spans]
    return found.select(*keys, day, moment, *totals)


def looked_up(df: DataFrame, found: DataFrame, at: Sequence[str]) -> DataFrame:
    """df with the other columns of found, which has a row at most for what the columns of at hold, nulls too."""
    there = found.withColumnsRenamed({c: f"_at_{c}" for c in at})
    same = [df[c].eqNullSafe(there[f"_at_{c}"]) for c in at]
    return df.join(there, same, "left").drop(*[f"_at_{c}" for c in at])
