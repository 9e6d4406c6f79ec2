"""Sums along a total order, dealt by ranges: no task gets all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epochal import session


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each name, the sum over all rows that come before in a total order (integers).

    Rows are dealt by range and pinned in the shared folder; each part sums on its own, and one number
    a part is carried over.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = session.pinned(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = part.select("*", *[F.coalesce(F.sum(e).over(before), F.lit(0)).cast("long").alias(f"_in_{k}") for k, e in sums.items()])
    totals = part.groupBy("_part").agg(*[F.sum(e).alias(f"_sum_{k}") for k, e in sums.items()])
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    carried = totals.select("_part", *[F.coalesce(F.sum(f"_sum_{k}").over(ahead), F.lit(0)).cast("long").alias(f"_to_{k}") for k in sums])
    joined = local.join(F.broadcast(carried), "_part")  # as many rows as parts
    return joined.select(*[F.col(c) for c in df.columns], *[(F.col(f"_in_{k}") + F.col(f"_to_{k}")).alias(k) for k in sums])
