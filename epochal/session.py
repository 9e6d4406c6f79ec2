"""Session factory used by tests, the bench and local work."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g", name: str = "epochal") -> SparkSession:
    """A local session in UTC with adaptive execution; on a cluster, build your own and pass it in."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, for checkpoints and written tables. A session without one gets a
    temporary folder, but only where driver and executors are one machine."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if sc.getCheckpointDir() is None:
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        sc.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="epochal-"))
    return (named or sc.getCheckpointDir()).rstrip("/")


def pinned(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder: later steps start from there, even if executors are lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As pinned, by columns: wide rows take less room, and a later step reads the columns that it needs."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """As stored, in buckets of the key: joins and windows by the key start from there with no further deal. The table that
    says so is taken from the session's catalog again, its files stay."""
    spark = df.sparkSession
    name = f"dealt_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(parts, key).write.format("parquet").bucketBy(parts, key).option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"drop table {name}")
    return rows


@contextmanager
def released(spark: SparkSession):
    """Within it, what a step has shuffled leaves the disks as soon as the step is done, not when the driver next collects
    garbage. Each step's rows must be pinned, stored or collected; a session of an earlier Spark keeps its ways."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
