"""Batches with a log: a batch that fails is logged and changes nothing.

A batch writes its rows as a version of a table; the log has a row a batch with its counts, and the table's
current version is the last one that is logged as done.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG = "batch string, module string, status string, rows long, inserted long, updated long, seconds double, error string, version string, at double"


def run(spark: SparkSession, folder: str, module: str, build: Callable[[], DataFrame]) -> bool:
    """Writes what build gives (rows with a column action) as a new version of the module's table; whether it was done.

    Counts are observed while the rows are written, so nothing is read twice.
    """
    batch, seen = uuid.uuid4().hex, Observation()
    version = f"{folder}/{module}/{batch}"

    def work() -> dict:
        actions = [F.count(F.when(F.col("action") == a, 1)).alias(a) for a in ("insert", "update")]
        build().observe(seen, F.count("*").alias("rows"), *actions).write.parquet(version)
        return seen.get

    return logged(spark, folder, module, work, batch, version)


def logged(spark: SparkSession, folder: str, module: str, work: Callable[[], dict], batch: str | None = None, version: str | None = None) -> bool:
    """Does a piece of work, which gives counts (rows, insert, update), and logs it; whether it was done."""
    began = time.time()
    entry = {"batch": batch or uuid.uuid4().hex, "module": module, "version": version, "at": began}
    try:
        got = work()
        rows = got.get("rows", sum(got.get(a, 0) for a in ("insert", "update", "noop")))
        entry |= {"status": "done", "rows": rows, "inserted": got["insert"], "updated": got["update"]}
    except Exception as wrong:  # whatever fails a batch is logged, and its version is never current
        entry |= {"status": "failed", "error": str(wrong)[:500]}
    entry["seconds"] = time.time() - began
    names = [c.split()[0] for c in LOG.split(", ")]
    spark.createDataFrame([tuple(entry.get(n) for n in names)], LOG).write.mode("append").parquet(f"{folder}/log")
    return entry["status"] == "done"


def log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(f"{folder}/log")


def current(spark: SparkSession, folder: str, module: str) -> DataFrame | None:
    """The rows of the last batch of a module that was done; None before any."""
    last = log(spark, folder).filter((F.col("module") == module) & (F.col("status") == "done")).orderBy(F.desc("at")).select("version").first()
    return spark.read.parquet(last.version) if last else None
