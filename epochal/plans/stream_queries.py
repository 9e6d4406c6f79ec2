"""Streaming queries: each drains the events there are and gives the final state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from epochal import session
from epochal.operators import store
from epochal.plans.registry import query
from epochal.sources import tables
from epochal.streaming import events


@query("", "select event_id, user_id, event_type from {events}")
def stream_dedup(spark, sf_dir):
    s = events.source(spark, sf_dir)
    twice = s.unionByName(s)
    return events.drained(events.deduplicated(twice, ["event_id"]).select("event_id", "user_id", "event_type"))


@query("", "select cast(date_trunc('day', ts) as varchar) as starts, event_type, count(*) as n, round(sum(value), 4) as total from {events} group by 1, 2")
def stream_tumbling(spark, sf_dir):
    out = events.drained(events.tumbling(events.source(spark, sf_dir), "1 day"), "complete")
    return out.select(F.date_format("starts", "yyyy-MM-dd HH:mm:ss").alias("starts"), "event_type", "n", F.round("total", 4).alias("total"))


@query("", """select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as starts, count(*) as n from (select user_id, ts, sum(fresh) over (partition by user_id order by ts) as k from (
  select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 6 hour then 0 else 1 end as fresh from {events}) a) b group by user_id, k""")
def stream_session(spark, sf_dir):
    out = events.drained(events.sessions(events.source(spark, sf_dir), "6 hours"), "complete")
    return out.select("user_id", F.date_format("starts", "yyyy-MM-dd HH:mm:ss").alias("starts"), "n")


@query("", "select user_id, arg_max(event_id, (ts, event_id)) as event_id, arg_max(value, (ts, event_id)) as value from {events} group by 1")
def stream_upsert(spark, sf_dir):
    """The last event of each user, merged batch by batch into a table in the shared folder."""
    rows = events.source(spark, sf_dir).select("user_id", "event_id", "value", "ts")
    return events.upserted(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")], ["ts", "event_id"]).select("user_id", "event_id", "value")


#: Each event arrives some days after it happened, one in three once more, restated; arrivals make batches of 15 days.
ARRIVALS = """select event_id, event_type, cast(ts as date) as day, value + fix as value, fix, cast(floor((datediff('day', (select cast(min(ts) as date) from {events}), cast(ts as date)) + event_id % 29 + 5 * fix) / 15) as int) as batch
  from (select *, 0 as fix from {events} union all select *, 1 as fix from {events} where event_id % 3 = 0) as e"""


@query("", "with a as (" + ARRIVALS + """), w as (select batch, max(latest) over (order by batch rows between unbounded preceding and 1 preceding) as latest from (select batch, max(day) as latest from a group by batch) z),
  k as (select a.* from a join w on w.batch = a.batch where latest is null or day >= latest - 22), l as (select event_id, any_value(event_type) as event_type, any_value(day) as day, arg_max(value, batch * 2 + fix) as value from k group by event_id)
  select cast(day as varchar) as day, event_type, count(*) as n, round(sum(value), 4) as total from l group by 1, 2""")
def restated_days(spark, sf_dir):
    """Counts by day and type, kept up over batches that bring new and restated events; each makes only its own days anew."""
    arrivals = session.pinned(tables.run(spark, sf_dir, ARRIVALS.replace("datediff('day', ", "date_diff(day, ")))
    folder = f"{session.shared_folder(spark)}/restated/{uuid.uuid4().hex}"
    table, features = store.Store(spark, f"{folder}/events", ["event_id", "day"], "day"), store.Store(spark, f"{folder}/days", ["day", "event_type"], "day")
    build = lambda rows: rows.groupBy("day", "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    table.create(arrivals.limit(0))
    features.create(build(arrivals.limit(0)))
    for r in arrivals.select("batch").distinct().orderBy("batch").collect():  # a row a batch
        store.restate(table, features, arrivals.filter(F.col("batch") == r.batch), ["batch", "fix"], build)
    return features.read().select(F.col("day").cast("string").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


@query("", """with recursive e as (select user_id, ts, event_id, value, dense_rank() over (partition by user_id order by ts) as k from {events} where value is not null and ts <= (select date_trunc('milliseconds', max(ts)) - interval 1 hour from {events})),
  r as (select user_id, k, avg(value) as v from e group by 1, 2), l as (select user_id, k, 0.0::double as before, 0.5::double * v as after from r where k = 1 union all select r.user_id, r.k, l.after, l.after + 0.5::double * (v - l.after) from l join r on r.user_id = l.user_id and r.k = l.k + 1)
  select e.user_id, e.event_id, round(before, 6) as before, round(after, 6) as after from e join l on l.user_id = e.user_id and l.k = e.k""")
def levels_by_rounds(spark, sf_dir):
    """Levels of users before and after each event, round by round, of the events that the watermark has passed."""
    out = events.drained(events.rated(events.source(spark, sf_dir)), conf=events.ROCKS)
    return out.select("user_id", "event_id", F.round("before", 6).alias("before"), F.round("after", 6).alias("after"))
