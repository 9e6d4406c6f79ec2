"""The events table as a stream: deduplication, windows, sessions, upserts, ratings of the last value."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from epochal import session
from epochal.operators import merge, store


def source(spark: SparkSession, sf_dir: str, files: str = "events.parquet", each: int = 8) -> DataFrame:
    """events as a stream of files, some a batch; times get a zone, as watermarks ask for."""
    schema = spark.read.option("pathGlobFilter", files).parquet(sf_dir).schema if "*" in files else spark.read.parquet(f"{sf_dir}/{files}").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", files).option("maxFilesPerTrigger", each).parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def drained(stream: DataFrame, mode: str = "append", state: str | None = None, conf: dict[str, str] | None = None) -> DataFrame:
    """All that a stream gives for the input there is, as Parquet files in the shared folder; no rows pass the driver.

    Each batch is a folder, written anew if the batch is; with mode complete the last one is the result.
    state: a folder from which a stream goes on where it was; only what is new is given then. conf: settings
    that the stream is started with.
    """
    spark = stream.sparkSession
    target = f"{session.shared_folder(spark)}/drained/{uuid.uuid4().hex}"
    numbers = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/v{number}")
        numbers.append(number)

    before = {k: spark.conf.get(k, None) for k in conf or {}}
    for k, v in (conf or {}).items():
        spark.conf.set(k, v)
    try:
        running = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", state or f"{target}/state").trigger(availableNow=True).start()
        running.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    paths = [f"{target}/v{number}" for number in (numbers[-1:] if mode == "complete" else dict.fromkeys(numbers))]
    return spark.read.schema(stream.schema).parquet(*paths) if paths else spark.createDataFrame([], stream.schema)


def deduplicated(stream: DataFrame, keys: list[str], lateness: str = "1 hour") -> DataFrame:
    """The first row of each key within the lateness."""
    return stream.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, width: str, lateness: str = "1 hour") -> DataFrame:
    """starts, event_type, n, total of each window."""
    g = stream.withWatermark("ts", lateness).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("window.start").alias("starts"), "event_type", "n", "total")


def sessions(stream: DataFrame, gap: str, lateness: str = "1 hour") -> DataFrame:
    """user_id, starts, n of each session, which a gap ends."""
    g = stream.withWatermark("ts", lateness).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("session_window.start").alias("starts"), "n")


def upserting(table: store.Store, order: list, since: list[str]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merges the last row of each key of a batch into a table in parts; only the parts that the batch
    touches are written.

    A row counts only if it comes after the one that is there by the columns of since, so batches may be in any
    order. Versions bear the number of their batch: one that is run again changes nothing.
    """

    def merge_batch(batch: DataFrame, number: int) -> None:
        new, here = merge.first_rows(batch, table.keys, order), store.Store(batch.sparkSession, table.folder, table.keys, table.by)
        note = here.note()
        if note is None:
            here.create(new, str(number))
        elif number > int(note):
            here.merge(new, store.newest([c for c in new.columns if c not in table.keys], since), note=str(number))

    return merge_batch


def upserted(stream: DataFrame, keys: list[str], order: list, since: list[str], buckets: int = 16) -> DataFrame:
    """The table after all batches of the input there is; empty without any."""
    spark = stream.sparkSession
    target = f"{session.shared_folder(spark)}/upsert/{uuid.uuid4().hex}"
    table = store.Store(spark, target, keys, buckets)
    running = stream.writeStream.foreachBatch(upserting(table, order, since)).option("checkpointLocation", f"{target}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    return table.read() if table.versions() else spark.createDataFrame([], stream.schema)


STATE = "user_id long, ts timestamp, event_id long, before double, after double"
#: State of any number of keys beside the heap, with its changes logged.
ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Levels(StatefulProcessor):
    """A running level of each user, moved by a share of the way to each value.

    Values wait in a list, packed as they came with a batch. One timer a batch, at its earliest time, takes
    out all that the watermark has passed; the next waiting time gets a timer of its own. So the state is
    read and written once a user and batch, however many times the user's values have. All values of
    one time are a round, which starts from one level and moves it once.
    """

    def __init__(self, step: float):
        self.step = step

    def init(self, handle) -> None:
        self.handle = handle
        self.level = handle.getValueState("level", "level double")
        self.waiting = handle.getListState("waiting", "packed binary")

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for frame in rows:
            packed = np.empty(len(frame), WAITING)
            packed["at"] = frame["ts"].astype("datetime64[us]").astype("int64")
            packed["event"], packed["value"] = frame["event_id"], frame["value"]
            if len(packed):
                self.waiting.appendValue((packed.tobytes(),))
                first = min(int(packed["at"].min()), first) if first is not None else int(packed["at"].min())
        if first is not None:
            self.handle.registerTimer(first // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        packed = [np.frombuffer(x[0], WAITING) for x in self.waiting.get()] if self.waiting.exists() else []
        waiting = np.concatenate(packed) if packed else np.empty(0, WAITING)
        upto = max(timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs())
        passed = waiting["at"] // 1000 <= upto
        if not passed.any():
            return
        ready, rest = waiting[passed], waiting[~passed]
        # of rows with one time and event the last one read stays
        order = np.lexsort((np.arange(len(ready)), ready["event"], ready["at"]))
        ready = ready[order]
        ready = ready[np.append((ready["at"][1:] != ready["at"][:-1]) | (ready["event"][1:] != ready["event"][:-1]), True)]
        starts = np.flatnonzero(np.append(True, ready["at"][1:] != ready["at"][:-1]))
        sizes = np.diff(np.append(starts, len(ready)))
        means = np.add.reduceat(ready["value"], starts) / sizes
        level, levels = (self.level.get()[0] if self.level.exists() else 0.0), []
        for mean in means.tolist():
            levels.append(level)
            level += self.step * (mean - level)
        after = [*levels[1:], level]
        self.level.update((level,))
        if len(rest):
            self.waiting.put([(rest.tobytes(),)])
            self.handle.registerTimer(int(rest["at"].min()) // 1000)
        else:
            self.waiting.clear()
        out = pd.DataFrame({"user_id": key[0], "ts": ready["at"].astype("datetime64[us]"), "event_id": ready["event"], "before": np.repeat(levels, sizes), "after": np.repeat(after, sizes)})
        for at in range(0, len(out), SLICE):
            yield out.iloc[at : at + SLICE]

    def close(self) -> None:
        pass


#: A value that waits, and rows of a slice that is given out at once.
WAITING, SLICE = np.dtype([("at", "<i8"), ("event", "<i8"), ("value", "<f8")]), 1 << 16


def rated(stream: DataFrame, lateness: str = "1 hour", step: float = 0.5) -> DataFrame:
    """user_id, ts, event_id, before, after of each event that the watermark has passed, in whatever batches events come.

    Events without a value don't count; of rows with one time and event_id the last one read does. Needs ROCKS.
    """
    slim = stream.select("user_id", "ts", "event_id", "value").filter("value is not null and ts is not null").withWatermark("ts", lateness)
    return slim.groupBy("user_id").transformWithStateInPandas(Levels(step), outputStructType=STATE, outputMode="append", timeMode="eventTime")
