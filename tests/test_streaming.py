"""Drained streams against batch results; they are files, not rows of the driver."""

from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from epochal.streaming import events


@pytest.mark.parametrize("mode", ["append", "complete"])
def test_drained_is_files(spark, sf, mode):
    s, rows = events.source(spark, sf), spark.read.parquet(f"{sf}/events.parquet")
    if mode == "append":
        out, want = events.drained(s.select("event_id")), rows.select("event_id")
    else:
        out, want = events.drained(s.groupBy("user_id").agg(F.count("*").alias("n")), mode), rows.groupBy("user_id").agg(F.count("*").alias("n"))
    assert out.inputFiles() and all(f.endswith(".parquet") for f in out.inputFiles())
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


def test_upsert_over_three_batches(spark, sf, tmp_path):
    """Files in any order of time, one a batch: the last row of each user stays, whichever batch brought it."""
    rows = spark.read.parquet(f"{sf}/events.parquet")
    for k, part in enumerate(rows.randomSplit([1.0, 1.0, 1.0], seed=4)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = events.source(spark, str(tmp_path / "in"), "*.parquet", 1).select("user_id", "event_id", "value", "ts")
    out = events.upserted(stream, ["user_id"], [F.desc("ts"), F.desc("event_id")], ["ts", "event_id"])
    want = rows.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
    assert sorted(map(tuple, out.select("user_id", "event_id").collect())) == sorted(map(tuple, want.collect()))


def test_levels_by_rounds(spark, sf, tmp_path):
    """Files in any order of time within the lateness: levels are those of a fold in order, rounds at one time together."""
    rows = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.date_trunc("hour", "ts"))
    for part in rows.randomSplit([1.0, 1.0, 1.0], seed=4):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    end = rows.agg(F.max("ts")).first()[0]
    last = rows.limit(1).selectExpr("event_id", f"timestamp_ntz'{end}' + interval 400 days as ts", "-1L as user_id", "event_type", "value", "props")
    last.select(rows.columns).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))  # read last: its time passes all others
    out = events.drained(events.rated(events.source(spark, str(tmp_path / "in"), "*.parquet", 1), "400 days"), conf=events.ROCKS)
    got = {r.event_id: (round(r.before, 9), round(r.after, 9)) for r in out.filter("user_id >= 0").collect()}
    want, level = {}, {}
    by_round = {}
    for r in rows.filter("value is not null").collect():
        by_round.setdefault((r.user_id, r.ts), []).append(r)
    for (user, _), group in sorted(by_round.items()):
        now = level.get(user, 0.0)
        after = now + sum(0.5 * (r.value - now) / len(group) for r in sorted(group, key=lambda r: (r.event_id, r.value)))
        want |= {r.event_id: (round(now, 9), round(after, 9)) for r in group}
        level[user] = after
    assert got and all(abs(got[e][0] - want[e][0]) < 1e-6 and abs(got[e][1] - want[e][1]) < 1e-6 for e in got)
    assert len(got) >= 0.5 * len(want)


def test_levels_go_on_after_a_restart(spark, tmp_path):
    """A stream that is started again with its state gives the rest, as one run gives all."""
    rows = [(i, f"2024-01-{1 + i // 4:02d} {6 * (i % 4):02d}:00:00", i % 2, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, value double").withColumn("ts", F.to_timestamp("ts"))
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    stream = lambda: events.rated(events.source(spark, str(tmp_path / "in"), "*.parquet", 1))
    out = []
    for lo in (0, 20):
        df.filter(F.col("event_id").between(lo, lo + 19)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out += events.drained(stream(), state=str(tmp_path / "state"), conf=events.ROCKS).collect()
    level, want = {}, {}
    for i, _, user, value in rows:
        before = level.get(user, 0.0)
        level[user] = before + 0.5 * (value - before)
        want[i] = (before, level[user])
    got = {r.event_id: (r.before, r.after) for r in out}
    assert len(got) == len(out) == 39  # the last one waits
    assert all(got[i] == want[i] for i in got)


class Counted:
    """A state that counts its calls, each of which a worker sends to Spark."""

    def __init__(self):
        self.calls, self.held = 0, []

    def __getattr__(self, name):
        def call(*given):
            self.calls += 1
            if name in ("getValueState", "getListState", "getMapState"):
                return self
            if name == "appendValue":
                self.held.append(given[0])
            if name == "clear":
                self.held.clear()
            return iter(list(self.held)) if name in ("get", "iterator") else len(self.held) > 0 and name == "exists"

        return call


def test_levels_ask_for_state_by_batch_and_not_by_event():
    state, levels = Counted(), events.Levels(0.5)
    levels.init(state)
    n = 5000
    frame = pd.DataFrame({"ts": pd.to_datetime(np.arange(n), unit="s"), "event_id": range(n), "value": np.ones(n)})
    assert not any(len(x) for x in levels.handleInputRows((1,), iter([frame]), None))
    state.exists = lambda: len(state.held) > 0
    watermark = SimpleNamespace(getCurrentWatermarkInMs=lambda: 10**9)
    levels.level = SimpleNamespace(exists=lambda: False, update=lambda x: None)
    out = pd.concat(levels.handleExpiredTimer((1,), watermark, SimpleNamespace(getExpiryTimeInMs=lambda: 0)))
    assert len(out) == n and out["after"].iloc[1] == 0.75 and state.calls < 20
