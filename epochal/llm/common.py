"""What the operators of this subpackage share: reading, splitting, hashing, ordering, checkpoints."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epochal import session

#: Fixed pattern: words between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows in an Arrow batch; texts may be long, so batches stay small.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches (they stay so in the session), this package on the executors, and a checkpoint folder where the session names none."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    checkpoint_dir(spark)
    if spark.sparkContext.applicationId not in _SHIPPED:
        _SHIPPED.add(spark.sparkContext.applicationId)
        spark.sparkContext.addPyFile(_package())


#: Applications whose executors have the package.
_SHIPPED: set[str] = set()


def _package() -> str:
    """A zip of this package's modules, which Spark sends from the driver to each executor."""
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="epochal-"), "epochal.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("epochal", os.path.relpath(full, top)))
    return path


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only on a single machine whose session has none."""
    return session.shared_folder(spark)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: Column) -> Column:
    """Words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id as text, modulo n; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits, equal for repeated rows only: the identity of a row where doc_id may repeat."""
    return F.concat(F.hex(F.xxhash64(doc_id, text)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), text, doc_id)))


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each name, the sum over all rows that come before in a total order.

    Rows are dealt by range and pinned by a checkpoint; each part sums on its own, and one
    number a part is carried over. No task gets more than a part, whatever the keys.
    """
    spark = df.sparkSession
    part = df.repartitionByRange(partitions(spark), *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    before = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = part.select("*", *[F.coalesce(F.sum(e).over(before), F.lit(0)).cast("long").alias(f"_in_{k}") for k, e in sums.items()])
    totals = part.groupBy("_part").agg(*[F.sum(e).alias(f"_sum_{k}") for k, e in sums.items()])
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    carried = totals.select("_part", *[F.coalesce(F.sum(f"_sum_{k}").over(ahead), F.lit(0)).cast("long").alias(f"_to_{k}") for k in sums])
    joined = local.join(F.broadcast(carried), "_part")  # as many rows as parts
    return joined.select(*[F.col(c) for c in df.columns], *[(F.col(f"_in_{k}") + F.col(f"_to_{k}")).alias(k) for k in sums])


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds the number of rows that come before in a total order, like running_totals of 1, without a second deal:
    rows are sorted and numbered in their part of the range, and one number a part is carried over."""
    spark = df.sparkSession
    part = df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).withColumn("_no", F.monotonically_increasing_id()).checkpoint()
    part = part.select(*df.columns, F.shiftright("_no", 33).alias("_part"), F.col("_no").bitwiseAND(F.lit((1 << 33) - 1)).alias("_in"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    carried = part.groupBy("_part").agg(F.count("*").alias("n")).select("_part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_to"))
    joined = part.join(F.broadcast(carried), "_part")  # as many rows as parts
    return joined.select(*df.columns, (F.col("_in") + F.col("_to")).alias(name))


def spread_join(left: DataFrame, right: DataFrame, key: str | list[str]) -> DataFrame:
    """Inner join of left (pinned, any number of rows a key) with right (one row a key), such that no task gets a hot key.

    Keys with more than a quarter of an even part are at most four a part: their rows stay where they are
    and meet a broadcast; all others are dealt.
    """
    parts = partitions(left.sparkSession)
    most = left.count() // (4 * parts) + 1
    hot = left.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select(key).checkpoint()  # at most 4 * parts rows
    some = left.join(F.broadcast(right.join(F.broadcast(hot), key)), key)
    return some.unionByName(left.join(F.broadcast(hot), key, "left_anti").join(right, key))


#: Words that a Python worker remembers at most, and what it holds for one operator or another.
REMEMBERED = 400_000
#: Words whose hashes it remembers: they are made anew quickly.
HASHED = 200_000
_HELD: dict[str, dict] = {}


def remembered(name: str, *beside: str) -> dict:
    """The memory of one operator in this Python worker; what it held for others, but those beside, goes, so that workers stay small."""
    for other, held in _HELD.items():
        if other != name and held and other not in beside:
            held.clear()
    return _HELD.setdefault(name, {})


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text, as UTF-8, with A-Z, and no other letters, lower-cased: what bytes do of themselves."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    seen = remembered("hashes")
    try:
        return np.array([seen[w] for w in words], "u8")
    except KeyError:
        if len(seen) > HASHED:
            seen.clear()
        for w in words:
            if w not in seen:
                seen[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        return np.array([seen[w] for w in words], "u8")
