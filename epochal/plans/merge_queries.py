"""Upserts, entity merges and the points rulebook."""

from __future__ import annotations

from pyspark.sql import functions as F

import uuid

from epochal import session
from epochal.functions import features as fx
from epochal.operators import merge, panel, store
from epochal.plans.registry import query
from epochal.sources import tables

#: Day from which a winner's matches are new: one in five winners has new ones only, one in five old ones only.
SINCE = "case winner % 5 when 0 then date '1900-01-01' when 1 then date '2100-01-01' else date '1998-01-01' end"
OLD = f"select winner as code, count(*) as n, min(surface) as surface, cast(max(start_dtm) as varchar) as last_day from m where start_dtm < {SINCE} group by 1"
NEW = f"select winner as code, count(*) as n, min(case when winner % 7 <> 3 then surface end) as surface, cast(max(start_dtm) as varchar) as last_day from m where start_dtm >= {SINCE} group by 1"
ALL = "select winner as code, count(*) as n, min(surface) as surface, cast(max(start_dtm) as varchar) as last_day from m group by 1"


def last_day():
    return F.max("start_dtm").cast("string").alias("last_day")


def split(spark, sf_dir):
    """A target and a source of players, of the matches before a day and of all others, with nulls and keys that either lacks."""
    m = tables.matches(spark, sf_dir)
    old = m.filter(f"start_dtm < {SINCE}").groupBy(F.col("winner").alias("code")).agg(F.count("*").alias("n"), F.min("surface").alias("surface"), last_day())
    new = m.filter(f"start_dtm >= {SINCE}").groupBy(F.col("winner").alias("code")).agg(F.count("*").alias("n"), F.min(F.when(F.col("winner") % 7 != 3, F.col("surface"))).alias("surface"), last_day())
    return old, new


@query("m", f"""select coalesce(o.code, s.code) as code, coalesce(s.n, o.n) as n, coalesce(s.surface, o.surface) as surface, coalesce(s.last_day, o.last_day) as last_day,
  case when o.code is null then 'insert' when s.code is not null and (coalesce(s.n, o.n) is distinct from o.n or coalesce(s.surface, o.surface) is distinct from o.surface or coalesce(s.last_day, o.last_day) is distinct from o.last_day) then 'update' else 'noop' end as action
  from ({OLD}) o full join ({NEW}) s on s.code = o.code""")
def merge_players(spark, sf_dir):
    old, new = split(spark, sf_dir)
    return merge.upsert(old, new, ["code"])


@query("m", f"""select coalesce(o.code, s.code) as code, case when s.code is null then o.n else greatest(coalesce(s.n, o.n), coalesce(o.n, s.n)) end as n, coalesce(s.surface, o.surface) as surface, case when o.code is null then s.last_day else o.last_day end as last_day,
  case when o.code is null then 'insert' when s.code is not null and (greatest(s.n, o.n) is distinct from o.n or coalesce(s.surface, o.surface) is distinct from o.surface) then 'update' else 'noop' end as action
  from ({OLD}) o full join ({NEW}) s on s.code = o.code""")
def merge_matches(spark, sf_dir):
    """The larger count stays, and the day that was there first."""
    old, new = split(spark, sf_dir)
    return merge.upsert(old, new, ["code"], {"n": F.greatest("old.n", "new.n"), "last_day": F.coalesce("old.last_day", "new.last_day")})


@query("m", f"""select o.code, coalesce(s.n, o.n) as n, coalesce(s.surface, o.surface) as surface, coalesce(s.last_day, o.last_day) as last_day,
  case when s.code is not null and (s.n is distinct from o.n or coalesce(s.surface, o.surface) is distinct from o.surface or s.last_day is distinct from o.last_day) then 'update' else 'noop' end as action
  from ({OLD}) o left join ({NEW}) s on s.code = o.code""")
def merge_stats(spark, sf_dir):
    """Updates only: keys that the target lacks are left out."""
    old, new = split(spark, sf_dir)
    return merge.upsert(old, new, ["code"], insert=False)


@query("m", f"""select a.code, a.n, coalesce(a.surface, b.surface) as surface, a.last_day from (select code, n, case when code % 4 = 1 then null else surface end as surface, last_day from ({ALL}) z where not (code % 10 = 2 and code + 2 in (select code from ({ALL}) y))) a
  left join (select code + 2 as code, case when code % 4 = 1 then null else surface end as surface from ({ALL}) z where code % 10 = 2) b on b.code = a.code""")
def entity_merge(spark, sf_dir):
    old = tables.matches(spark, sf_dir).groupBy(F.col("winner").alias("code")).agg(F.count("*").alias("n"), F.min("surface").alias("surface"), last_day())
    old = old.withColumn("surface", F.when(F.col("code") % 4 != 1, F.col("surface")))
    known = old.select(F.col("code").alias("new_code"))
    codes = old.filter("code % 10 = 2").select(F.col("code").alias("old_code"), (F.col("code") + 2).alias("new_code")).join(known, "new_code", "left_semi")
    return merge.merge_entities(old, codes, "code")


@query("m", "select id, case when winner % 10 = 2 then winner + 2 else winner end as winner, case when loser % 10 = 2 then loser + 2 else loser end as loser from m")
def entity_repoint(spark, sf_dir):
    m = tables.matches(spark, sf_dir)
    codes = m.select(F.col("winner").alias("old_code")).union(m.select("loser")).distinct().filter("old_code % 10 = 2").withColumn("new_code", F.col("old_code") + 2)  # players, few
    out = merge.replace_code(merge.replace_code(m, "winner", codes), "loser", codes)
    return out.select("id", "winner", "loser")


@query("m", "select code, n, coalesce(surface, '') as surface from (select winner as code, count(*) as n, min(surface) as surface from m group by 1) z where n > 3")
def change_hashes(spark, sf_dir):
    """Rows with equal hashes are the rows with equal values: each hash stands for one row."""
    g = tables.matches(spark, sf_dir).groupBy(F.col("winner").alias("code")).agg(F.count("*").alias("n"), F.min("surface").alias("surface"))
    one = merge.first_rows(g.withColumn("hash", merge.change_hash(["code", "n", "surface"])), ["hash"], ["code"])
    return one.filter("n > 3").select("code", "n", F.coalesce("surface", F.lit("")).alias("surface"))


@query("m", "select id, winner, rnd from (select *, row_number() over (partition by winner, loser, tournament_id order by rnd, id) as rn from m) z where rn = 1")
def dedupe_first(spark, sf_dir):
    return merge.first_rows(tables.matches(spark, sf_dir), ["winner", "loser", "tournament_id"], ["rnd", "id"]).select("id", "winner", "rnd")


#: Points of the rule sets in use here: rule, round, result, points.
RULEBOOK = [(1, r, "L", p) for r, p in ((6, 10), (7, 45), (8, 90), (9, 180), (10, 360), (11, 600))] + [(1, 11, "W", 1000)] + [(2, r, "L", p) for r, p in ((7, 20), (8, 45), (9, 90), (10, 180), (11, 300))] + [(2, 11, "W", 500)]
RULES = "(values " + ", ".join(map(str, RULEBOOK)) + ") as rb(rule, stage, result, points)"
RULED = "(select tournament_id, case when min(rnd) = 6 then 1 else 2 end as rule, min(rnd) as first_stage, max(rnd) as last_stage from m group by 1)"


def rulebook(spark):
    return spark.createDataFrame(RULEBOOK, "rule int, stage int, result string, points int")


def ruled(spark, sf_dir):
    return tables.matches(spark, sf_dir).groupBy("tournament_id").agg(F.when(F.min("rnd") == 6, 1).otherwise(2).alias("rule"), F.min("rnd").alias("first_stage"), F.max("rnd").alias("last_stage"))


@query("m", f"select tournament_id, rule, first_stage, last_stage, case when rule = 1 then 1000 else 500 end as top_points from {RULED} r")
def apply_points_rule(spark, sf_dir):
    """Two equi joins, one for rules tied to the first round and one for the rest, in place of an OR."""
    t = ruled(spark, sf_dir).drop("rule")
    rules = spark.createDataFrame([(1, 6), (2, None)], "rule int, first_stage int")
    top = rulebook(spark).groupBy("rule").agg(F.max("points").alias("top_points"))
    tied = t.join(F.broadcast(rules.filter("first_stage is not null")), "first_stage")
    rest = t.filter("first_stage <> 6").withColumn("rule", F.lit(2))
    return tied.unionByName(rest).join(F.broadcast(top), "rule").select("tournament_id", "rule", "first_stage", "last_stage", "top_points")


@query("p", f"""select p.tournament_id, p.player_code, cast(sum(coalesce(rb.points, 0)) as bigint) as points from p join {RULED} r on r.tournament_id = p.tournament_id
  left join {RULES} on rb.rule = r.rule and rb.stage = p.rnd and rb.result = case when p.match_result = 'win' then 'W' else 'L' end group by 1, 2""")
def points_by_tournament(spark, sf_dir):
    """A player's points: losers have those of the round they lost in, winners of finals those of the title."""
    p = panel.unpivot(tables.matches(spark, sf_dir)).join(ruled(spark, sf_dir).select("tournament_id", "rule"), "tournament_id")
    p = p.withColumn("result", F.when(F.col("match_result") == "win", "W").otherwise("L"))
    book = rulebook(spark).withColumnRenamed("stage", "rnd")
    scored = p.join(book, ["rule", "rnd", "result"], "left")
    return scored.groupBy("tournament_id", "player_code").agg(F.sum(F.coalesce("points", F.lit(0))).alias("points"))


@query("m", f"""select coalesce(o.tournament_id, s.tournament_id) as tournament_id, case when o.category in ('gs', 'finals') then o.category else coalesce(s.category, o.category) end as category, coalesce(s.n, o.n) as n,
  case when o.tournament_id is null then 'insert' when s.tournament_id is not null and (case when o.category in ('gs', 'finals') then o.category else coalesce(s.category, o.category) end is distinct from o.category or coalesce(s.n, o.n) is distinct from o.n) then 'update' else 'noop' end as action
  from (select tournament_id, case when count(*) % 3 = 0 then 'gs' else '250' end as category, count(*) as n from m where rnd < 9 group by 1) o
  full join (select tournament_id, case when count(*) % 5 = 0 then null else '500' end as category, count(*) as n from m where rnd >= 9 group by 1) s on s.tournament_id = o.tournament_id""")
def merge_tournaments(spark, sf_dir):
    """Tournaments as known from their early rounds, and read anew with the late ones; some categories are fixed."""
    m = tables.matches(spark, sf_dir)
    n = F.count("*")
    old = m.filter("rnd < 9").groupBy("tournament_id").agg(F.when(n % 3 == 0, "gs").otherwise("250").alias("category"), n.alias("n"))
    new = m.filter("rnd >= 9").groupBy("tournament_id").agg(F.when(n % 5 != 0, "500").alias("category"), n.alias("n"))
    fixed = F.when(F.col("old.category").isin("gs", "finals"), F.col("old.category")).otherwise(F.coalesce("new.category", "old.category"))
    return merge.upsert(old, new, ["tournament_id"], {"category": fixed})


@query("m", """select m.id, case when m.id % 97 = 0 then '64 64' when m.id % 2 = 0 then '64 36 76' else '63 62' end as score from m where m.id % 101 <> 0""")
def score_overrides(spark, sf_dir):
    """Scores corrected by a small list; matches on it that are to be skipped go."""
    m = tables.matches(spark, sf_dir).select("id", F.when(F.col("id") % 2 == 0, "64 36 76").otherwise("63 62").alias("score"))
    fixes = m.filter("id % 97 = 0 or id % 101 = 0").select("id", F.when(F.col("id") % 97 == 0, "64 64").alias("fixed"), (F.col("id") % 101 == 0).alias("skip"))
    joined = m.join(fixes, "id", "left").filter("not coalesce(skip, false)")
    return joined.select("id", F.coalesce("fixed", "score").alias("score"))


#: Matches as read a first and a second time: scores longer or shorter, links and durations there or not, statistics in the first only.
FIRST_READ = "select id, case when id % 3 = 0 then '64 36' when id % 3 = 1 then '64 36 76(5)' end as score, case when id % 4 <> 0 then concat('/stats-centre/', cast(id as string)) end as stats_url, case when id % 5 <> 0 then cast(60 + id % 90 as int) end as duration, cast(id % 20 as int) as aces from m where id % 11 <> 0"
SECOND_READ = "select id, case when id % 2 = 0 then '64 36 76' when id % 7 <> 0 then '64' end as score, case when id % 6 <> 0 then concat('/stats-centre/', cast(id as string)) end as stats_url, case when id % 7 <> 0 then cast(60 + id % 90 as int) end as duration, cast(null as int) as aces from m where id % 13 <> 0"


@query("m", f"""select coalesce(o.id, s.id) as id, case when s.id is null then o.score when o.id is null then s.score when coalesce(length(s.score), 0) > coalesce(length(o.score), 0) then s.score else o.score end as score,
  coalesce(s.stats_url, o.stats_url) as stats_url, coalesce(s.duration, o.duration) as duration, o.aces as aces, case when o.id is null then 'insert' when s.id is not null and (coalesce(length(s.score), 0) > coalesce(length(o.score), 0) or coalesce(s.stats_url, o.stats_url) is distinct from o.stats_url or coalesce(s.duration, o.duration) is distinct from o.duration) then 'update' else 'noop' end as action
  from ({FIRST_READ.replace("string", "varchar")}) o full join ({SECOND_READ.replace("string", "varchar")}) s on s.id = o.id""")
def merge_match_reads(spark, sf_dir):
    """Matches read again: the longer score counts, links and durations are kept where the new read lacks them, statistics stay."""
    old, new = (spark.sql(q.replace("from m ", "from {m} "), m=tables.matches(spark, sf_dir)) for q in (FIRST_READ, SECOND_READ))
    return merge.upsert(old, new, ["id"], {"score": merge.longer("score"), "aces": F.col("old.aces")})


#: Players 7 and 8 of ten are one and the same as player 6 (8 by way of 7); ids of matches have codes among their tokens.
ALIAS = "case when {0} % 10 in (7, 8) then {0} - {0} % 10 + 6 else {0} end"


@query("m", f"""select 'matches' as tab, concat_ws('-', 'm' || cast(id as varchar), cast({ALIAS.format("winner")} as varchar), cast({ALIAS.format("loser")} as varchar)) as k, cast({ALIAS.format("winner")} as varchar) as a, cast({ALIAS.format("loser")} as varchar) as b from m
  union all select 'enriched', concat_ws('-', 'm' || cast(id as varchar), cast({ALIAS.format("winner")} as varchar), cast({ALIAS.format("loser")} as varchar)), cast(id % 97 as varchar), null from m where id % 3 = 0
  union all select 'points', tournament_id || ' ' || cast({ALIAS.format("winner")} as varchar), cast(count(*) as varchar), null from (select distinct tournament_id, winner from m) z group by tournament_id, {ALIAS.format("winner")}
  union all select 'players', cast({ALIAS.format("winner")} as varchar), cast(arg_min(surface, winner) filter (surface is not null) as varchar), null from (select winner, case when winner % 10 = 6 then null else min(surface) end as surface from m group by winner) y group by {ALIAS.format("winner")}""")
def entity_merge_everywhere(spark, sf_dir):
    """Players merged in four tables by one commit; ids, codes and hashes follow."""
    m = session.pinned(tables.matches(spark, sf_dir))
    code = lambda c: F.col(c).cast("string")
    id_ = F.concat_ws("-", F.concat(F.lit("m"), code("id")), code("winner"), code("loser"))
    rows = {
        "players": m.groupBy("winner").agg(F.min("surface").alias("surface")).select(F.col("winner").alias("code"), F.when(F.col("winner") % 10 != 6, F.col("surface")).alias("surface")),
        "matches": m.select(id_.alias("id"), "winner", "loser").withColumn("hash", merge.change_hash(["id", "winner", "loser"])),
        "enriched": m.filter("id % 3 = 0").select(id_.alias("id"), (F.col("id") % 97).alias("figure")),
        "points": m.select("tournament_id", F.col("winner").alias("player_code")).distinct().withColumn("source", F.col("player_code")),
    }
    keys = {"players": ["code"], "matches": ["id"], "enriched": ["id"], "points": ["tournament_id", "player_code", "source"]}
    folder = f"{session.shared_folder(spark)}/everywhere/{uuid.uuid4().hex}"
    held = {t: store.Store(spark, f"{folder}/{t}", keys[t], 16) for t in rows}
    catalog = store.Catalog(folder, held)
    catalog.commit({t: s.create(rows[t]) for t, s in held.items()})
    codes = m.select(F.explode(F.array("winner", "loser")).alias("old_code")).distinct().filter("old_code % 10 in (7, 8)").withColumn("new_code", F.col("old_code") - 1)
    uses = {"matches": {"codes": ["winner", "loser"], "ids": ["id"], "hash": ("hash", ["id", "winner", "loser"])}, "enriched": {"ids": ["id"]}, "points": {"codes": ["player_code"]}}
    merge.merge_everywhere(catalog, codes, ("players", "code"), uses)
    matches = catalog.read("matches").filter(F.col("hash") == merge.change_hash(["id", "winner", "loser"]))  # rows whose hash was left behind would be missed
    points = catalog.read("points").groupBy("tournament_id", "player_code").agg(F.count("*").alias("n"))
    none = F.lit(None).cast("string").alias("b")
    parts = [matches.select(F.lit("matches").alias("tab"), F.col("id").alias("k"), code("winner").alias("a"), code("loser").alias("b")),
             catalog.read("enriched").select(F.lit("enriched").alias("tab"), F.col("id").alias("k"), code("figure").alias("a"), none),
             points.select(F.lit("points").alias("tab"), F.concat_ws(" ", "tournament_id", code("player_code")).alias("k"), code("n").alias("a"), none),
             catalog.read("players").select(F.lit("players").alias("tab"), code("code").alias("k"), F.col("surface").alias("a"), none)]
    return panel.union_sources(*parts)
