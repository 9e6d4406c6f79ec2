"""Upkeep of tables: work-lists, pivots and checks, the points rulebook, draw templates, incremental merges and their audit."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epochal import session
from epochal.functions import features as fx
from epochal.operators import audit, merge, panel, stats
from epochal.operators import temporal as tp
from epochal.plans.kpi_queries import LAGGED, VALUES_SQL, lagged_value, side_panel
from epochal.plans.panel_queries import base
from epochal.plans.registry import query
from epochal.plans.temporal_queries import ORDER, W1
from epochal.sources import tables

#: Days before and after a day in which matches are looked for.
BACK, AHEAD = 22, 5


@query("m", f"select id, tournament_id from m where start_dtm between date '1995-06-15' - {BACK} and date '1995-06-15' + {AHEAD}")
def worklist_window(spark, sf_dir):
    """Matches of the days around one: a range on the scanned column."""
    day = F.to_date(F.lit("1995-06-15"))
    return tables.matches(spark, sf_dir).filter(F.col("start_dtm").between(F.date_sub(day, BACK), F.date_add(day, AHEAD))).select("id", "tournament_id")


@query("m", """, u as (select id, concat('/en/scores/', case when id % 2 = 0 then 'stats-centre' else 'match-stats' end, '/', cast(id as varchar)) as url from m),
  s as (select concat('/en/scores/', case when l_orderkey % 3 = 0 then 'stats-centre' else 'match-stats' end, '/', cast(l_orderkey as varchar)) as url, min(case when l_returnflag = 'N' then l_linenumber end) as a, min(case when l_linestatus = 'F' then l_linenumber end) as b from {lineitem} group by 1)
  select u.id, s.a, s.b from u join s on replace(u.url, 'stats-centre', 'match-stats') = replace(s.url, 'stats-centre', 'match-stats') where s.a is not null or s.b is not null""")
def stats_by_url(spark, sf_dir):
    """Either form of a link finds the other: both are brought to one form, so that one equi join does it. Rows without values go."""
    variant = lambda even: F.when(even, "stats-centre").otherwise("match-stats")
    link = lambda even, key: F.concat(F.lit("/en/scores/"), variant(even), F.lit("/"), F.col(key).cast("string"))
    form = lambda url: F.replace(url, F.lit("stats-centre"), F.lit("match-stats"))
    u = tables.matches(spark, sf_dir).select("id", form(link(F.col("id") % 2 == 0, "id")).alias("url"))
    lines = tables.table(spark, sf_dir, "lineitem")
    s = lines.groupBy("l_orderkey").agg(F.min(F.when(F.col("l_returnflag") == "N", F.col("l_linenumber"))).alias("a"), F.min(F.when(F.col("l_linestatus") == "F", F.col("l_linenumber"))).alias("b"))
    s = s.filter(~panel.empty_row(["a", "b"])).select(form(link(F.col("l_orderkey") % 3 == 0, "l_orderkey")).alias("url"), "a", "b")
    return u.join(s, "url").select("id", "a", "b")


@query("m p pl", """, k as (select player_code, case when player_code % 4 = 0 then null else turned_pro end as turned_pro from pl), d as (select player_code, case when player_code % 8 <> 0 then cast(min(extract(year from start_dtm)) as int) end as debut from p group by 1)
  select * from (select p.id, p.player_code, coalesce(a.turned_pro, x.debut) as player_turned_pro, coalesce(b.turned_pro, y.debut) as opponent_turned_pro from p left join k a on a.player_code = p.player_code left join k b on b.player_code = p.opponent_code
    left join d x on x.player_code = p.player_code left join d y on y.player_code = p.opponent_code) z where player_turned_pro is not null and opponent_turned_pro is not null""")
def debut_backfill(spark, sf_dir):
    """The year of a debut fills an unknown one for both roles; rows that still lack one go."""
    p = base(spark, sf_dir)
    known = tables.players(spark, sf_dir).select("player_code", F.when(F.col("player_code") % 4 != 0, F.col("turned_pro")).alias("turned_pro"))
    debuts = p.groupBy("player_code").agg(F.when(F.col("player_code") % 8 != 0, F.min(F.year("start_dtm"))).alias("debut"))
    out = panel.filled(panel.attach(p, known, "player_code", ["turned_pro"]), "turned_pro", debuts, "player_code", "debut")
    return panel.known_in_both(out, "turned_pro").select("id", "player_code", "player_turned_pro", "opponent_turned_pro")


HOLES = "not (match_result = 'loss' and surface is null and rnd = 6)"


@query("p", f", h as (select * from p where {HOLES} union all select * from p where rnd = 11 and surface is null and match_result = 'win') select id, max(case when match_result = 'win' then player_code end) as winner_player_code, max(case when match_result = 'loss' then player_code end) as loser_player_code from h group by id having count(*) = 2 and count(case when match_result = 'win' then 1 end) = 1")
def match_pivot(spark, sf_dir):
    """Matches from a panel in which some have a row too few or too many: pairs by id, winner and loser by the result."""
    p = base(spark, sf_dir)
    return panel.matched(p.filter(HOLES).unionByName(p.filter("rnd = 11 and surface is null and match_result = 'win'")))


@query("p", f", h as (select * from p where {HOLES} union all select * from p where rnd = 11 and surface is null and match_result = 'win') select id, count(*) as \"rows\" from h group by id having count(*) <> 2")
def malformed_ids(spark, sf_dir):
    p = base(spark, sf_dir)
    return panel.malformed(p.filter(HOLES).unionByName(p.filter("rnd = 11 and surface is null and match_result = 'win'")))


@query("m t pl", "select m.winner, count(*) as titles, count(case when t.category = 'gs' then 1 end) as gs_titles from m join t on t.tournament_id = m.tournament_id where m.rnd = 11 and t.category in ('gs', '1000', 'atp500') and m.winner in (select player_code from pl where turned_pro < 2000) group by 1")
def titles_per_winner(spark, sf_dir):
    """Finals won in some categories, by the players of a cohort."""
    cohort = tables.players(spark, sf_dir).filter("turned_pro < 2000").select(F.col("player_code").alias("winner"))
    finals = tables.matches(spark, sf_dir).filter("rnd = 11").join(cohort, "winner", "left_semi")
    some = finals.join(tables.tournaments(spark, sf_dir).filter(F.col("category").isin("gs", "1000", "atp500")).select("tournament_id", "category"), "tournament_id")
    return some.groupBy("winner").agg(F.count("*").alias("titles"), F.count(F.when(F.col("category") == "gs", 1)).alias("gs_titles"))


@query("q", "select name, round(most, 6) as most, cast(most > 1.5 as int) as percent from (" + " union all ".join(f"select '{n}' as name, max({lagged_value(a, b)}) as most from q" for n, a, b, _ in LAGGED) + ") z")
def scale_detection(spark, sf_dir):
    """The largest value of each figure, and whether it is on a scale of percents: one aggregate."""
    values = side_panel(spark, sf_dir).select(*[F.expr(lagged_value(a, b)).alias(n) for n, a, b, _ in LAGGED])
    most = stats.largest(values, [n for n, *_ in LAGGED])
    return most.select("name", F.round("most", 6).alias("most"), (F.col("most") > 1.5).cast("int").alias("percent"))


@query("rk", "select player_code, cast(snapshot_date as varchar) as day, min(ranking) over (partition by player_code order by snapshot_date rows unbounded preceding) as best from rk")
def running_best_ranking(spark, sf_dir):
    """The smallest rank of each player up to a day, over all snapshots."""
    best = tp.running_best(tables.rankings(spark, sf_dir), "ranking", None, ["player_code"], ["snapshot_date"], "best")
    return best.select("player_code", F.col("snapshot_date").cast("string").alias("day"), "best")


@query("rk", """, z as (select player_code, snapshot_date, min(case when ranking % 3 <> 0 then ranking end) over (partition by player_code order by snapshot_date rows unbounded preceding) as best, last_value(case when ranking % 5 <> 0 then ranking end ignore nulls) over (partition by player_code order by snapshot_date rows unbounded preceding) as held from rk),
  d as (select *, best - lag(best) over w as d1, held - lag(held) over w as d2 from z window w as (partition by player_code order by snapshot_date)) select player_code, cast(coalesce(bool_and(d1 <= 0), true) as int) as best_falls, cast(coalesce(bool_and(d2 <= 0), true) as int) as rank_falls from d group by 1""")
def monotonicity(spark, sf_dir):
    """Whether a series, its gaps filled with the last value, never rises; true without two values."""
    w = Window.partitionBy("player_code").orderBy("snapshot_date")
    r = tables.rankings(spark, sf_dir)
    r = r.select("player_code", "snapshot_date", F.min(F.when(F.col("ranking") % 3 != 0, F.col("ranking"))).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("best"), F.when(F.col("ranking") % 5 != 0, F.col("ranking")).alias("rank"))
    best, rank = (tp.never_rises(r, ["player_code"], ["snapshot_date"], c, f"{c}_falls") for c in ("best", "rank"))
    return best.join(rank, "player_code").select("player_code", F.col("best_falls").cast("int").alias("best_falls"), F.col("rank_falls").cast("int").alias("rank_falls"))


#: Tokens of the slices: a row is in each whose token its category is or begins with.
TIERS = ("gs", "1000", "atp", "atp250")


@query("p t", f""", s as (select p.*, t.category, extract(year from p.start_dtm) as year, (player_code % 50 + 25) / 100.0::double as score, cast(match_result = 'win' as int) as hit from p join t on t.tournament_id = p.tournament_id)
  select tier, cast(year as int) as year, count(*) as n, round(avg((score - hit) * (score - hit)), 6) as brier, round(avg(cast(cast(score >= 0.5 as int) = hit as double)), 6) as accuracy from s join (values {", ".join(f"('{x}')" for x in TIERS)}) v(tier) on s.category = tier or starts_with(s.category, tier) where year >= 1996 group by 1, 2""")
def holdout_slices(spark, sf_dir):
    """Scores of held-out years by year and tier: a row counts in every tier whose token begins its category."""
    t = tables.tournaments(spark, sf_dir).select("tournament_id", "category")
    scored = base(spark, sf_dir).join(t, "tournament_id").withColumns({"year": F.year("start_dtm"), "score": (F.col("player_code") % 50 + 25) / 100.0, "hit": (F.col("match_result") == "win").cast("int")})
    return stats.by_tier(scored.filter("year >= 1996"), "category", TIERS, ["year"]).select("tier", "year", "n", F.round("brier", 6).alias("brier"), F.round("accuracy", 6).alias("accuracy"))


#: Rule, round, result, points.
RULEBOOK = """
gs F W 2000, gs F L 1200, gs SF L 720, gs QF L 360, gs R16 L 180, gs R32 L 90, gs R64 L 45, gs R128 L 10, gs Q3 W 25
1000-R128 F W 1000, 1000-R128 F L 600, 1000-R128 SF L 360, 1000-R128 QF L 180, 1000-R128 R16 L 90, 1000-R128 R32 L 45, 1000-R128 R64 L 25, 1000-R128 R128 L 10, 1000-R128 Q W 16
1000-R64 F W 1000, 1000-R64 F L 600, 1000-R64 SF L 360, 1000-R64 QF L 180, 1000-R64 R16 L 90, 1000-R64 R32 L 45, 1000-R64 R64 L 10, 1000-R64 Q W 25
atp500-R64 F W 500, atp500-R64 F L 300, atp500-R64 SF L 180, atp500-R64 QF L 90, atp500-R64 R16 L 45, atp500-R64 R32 L 20, atp500-R64 Q W 10
atp500-R32 Q W 20, atp500-R32 R16 L 45, atp500-R32 QF L 90, atp500-R32 SF L 180, atp500-R32 F L 300, atp500-R32 F W 500
atp250-R64 F W 250, atp250-R64 F L 150, atp250-R64 SF L 90, atp250-R64 QF L 45, atp250-R64 R16 L 20, atp250-R64 R32 L 5, atp250-R64 Q W 5
atp250-R32 Q W 12, atp250-R32 R16 L 20, atp250-R32 QF L 45, atp250-R32 SF L 90, atp250-R32 F L 150, atp250-R32 F W 250
ch100 F W 100, ch100 F L 60, ch100 SF L 35, ch100 QF L 18, ch100 R16 L 8, ch100 R32 L 5, ch100 Q W 4
ch50 F W 50, ch50 F L 30, ch50 SF L 17, ch50 QF L 9, ch50 R16 L 4, ch50 Q W 2
gsCup R16 L 75, gsCup SF L 150, gsCup QF L 300, gsCup F L 450, gsCup F W 600
gs Q3 L 16, gs Q2 L 8
atp250-R32 Q L 6, 1000-R128 Q L 8, 1000-R64 Q L 16, atp500-R32 Q L 10, atp500-R64 Q L 4, atp250-R64 Q L 3, ch50 Q L 1, ch100 Q L 2
atpFinals RR W 200, atpFinals F W 900, atpFinals F L 400
fu25 F W 20, fu25 F L 12, fu25 SF L 6, fu25 QF L 3, fu25 R16 L 1
fu15 F W 10, fu15 F L 6, fu15 SF L 4, fu15 QF L 2, fu15 R16 L 1
"""
BOOK = [(r, s, w, int(n)) for r, s, w, n in (x.split() for line in RULEBOOK.strip().splitlines() for x in line.split(","))]
#: The rules by category and first round (none: any), as their names say.
RULES = [("gs", "gs", None), ("1000-R128", "1000", "R128"), ("1000-R64", "1000", "R64"), ("atp500-R64", "atp500", "R64"), ("atp500-R32", "atp500", "R32"), ("atp250-R64", "atp250", "R64"), ("atp250-R32", "atp250", "R32")]

STAGES = ("Q1", "Q2", "Q3", "Q2", "R128", "R64", "R32", "R16", "QF", "SF", "F", "F", "R32")
STAGE_SQL = "case when m.id % 91 = 3 then 'RR' else case m.id % 13 " + " ".join(f"when {k} then '{s}'" for k, s in enumerate(STAGES)) + " end end"
PLACE_SQL = "case stage " + " ".join(f"when '{s}' then {i + 1}" for i, s in enumerate(fx.MAIN_LADDER)) + " end"
STAGED = f"(select *, {PLACE_SQL} as place, case when stage like 'Q_' then 'Q' else 'M' end as draw from (select m.id, m.tournament_id, m.start_dtm, m.winner, m.loser, case when t.country = 'BRAZIL' then 'dc' else t.category end as series, {STAGE_SQL} as stage from m join t on t.tournament_id = m.tournament_id) z)".replace("like 'Q_'", "in ('Q1', 'Q2', 'Q3')")
RULED = "(select f.tournament_id, r.rule from (select tournament_id, min(series) as series, min(place) as place from sg where draw = 'M' and series <> 'dc' group by 1) f join (values " + ", ".join(f"('{r}', '{c}', {fx.MAIN_LADDER.index(s) + 1 if s else 'null'})" for r, c, s in RULES) + ") r(rule, series, first_place) on r.series = f.series and (r.first_place = f.place or r.first_place is null))"


def staged(spark, sf_dir):
    """Matches with rounds of a full draw: stage, its place, draw (M or Q), series."""
    t = tables.tournaments(spark, sf_dir).select("tournament_id", F.when(F.col("country") == "BRAZIL", "dc").otherwise(F.col("category")).alias("series"))
    m = tables.matches(spark, sf_dir).join(t, "tournament_id")
    stage = F.when(F.col("id") % 91 == 3, "RR").otherwise(F.element_at(F.array(*map(F.lit, STAGES)), (F.col("id") % 13 + 1).cast("int")))
    m = m.withColumn("stage", stage)
    return m.withColumns({"place": fx.place(F.col("stage"), fx.MAIN_LADDER), "draw": F.when(F.col("stage").isin("Q1", "Q2", "Q3"), "Q").otherwise("M")})


def rules_of(m):
    """tournament_id, rule: two equi joins, by category and first round and by category alone, in place of an OR."""
    first = m.filter("draw = 'M' and series <> 'dc'").groupBy("tournament_id").agg(F.min("series").alias("series"), F.min("place").alias("place"))
    rules = m.sparkSession.createDataFrame([(r, c, fx.MAIN_LADDER.index(s) + 1 if s else None) for r, c, s in RULES], "rule string, series string, place int")
    tied = first.join(rules.filter("place is not null"), ["series", "place"])
    rest = first.join(rules.filter("place is null").drop("place"), "series")
    return tied.select("tournament_id", "rule").unionByName(rest.select("tournament_id", "rule"))


@query("m t", f", sg as {STAGED}, old as (select tournament_id, case when count(*) % 3 = 0 then 'gs' end as rule from m where start_dtm < date '1996-01-01' group by 1) select o.tournament_id, coalesce(n.rule, o.rule) as rule, case when coalesce(n.rule, o.rule) is distinct from o.rule then 'update' else 'noop' end as action from old o left join {RULED} n on n.tournament_id = o.tournament_id")
def merge_points_rules(spark, sf_dir):
    """Tournaments there are get the rule that fits; only those whose rule differs are updates."""
    m = staged(spark, sf_dir)
    old = tables.matches(spark, sf_dir).filter("start_dtm < date '1996-01-01'").groupBy("tournament_id").agg(F.when(F.count("*") % 3 == 0, "gs").alias("rule"))
    return merge.upsert(old, rules_of(m), ["tournament_id"], insert=False)


def points(m):
    """tournament_id, player_code, points: each row of a match names the lines of the book that it may score by, and one join finds them.

    Losers of the main draw score by their round, winners by the final or a round robin; in the qualifying
    of a grand slam both score by their round; in other draws (but cups) winners and losers of the last
    qualifying round score by it, unless it is the first.
    """
    last = m.filter("draw = 'Q' and series <> 'dc'").groupBy("tournament_id").agg(F.max("place").alias("last_place"))
    p = m.join(rules_of(m), "tournament_id").join(last, "tournament_id", "left")
    line = lambda when, stage, result: F.when(when, F.struct(F.lit(stage).alias("stage") if stage in ("Q",) else F.col("stage").alias("stage"), F.lit(result).alias("result")))
    main, slam = F.col("draw") == "M", (F.col("draw") == "Q") & (F.col("series") == "gs")
    ends = (F.col("draw") == "Q") & (F.col("place") == F.col("last_place")) & (F.col("stage") != "Q1")
    won = F.array(line(main & F.col("stage").isin("F", "RR"), "", "W"), line(slam, "", "W"), line(ends, "Q", "W"))
    lost = F.array(line(main, "", "L"), line(slam, "", "L"), line(ends, "Q", "L"))
    sides = F.array(F.struct(F.col("winner").alias("player_code"), won.alias("lines")), F.struct(F.col("loser").alias("player_code"), lost.alias("lines")))
    rows = p.select("tournament_id", "rule", F.explode(sides).alias("s")).select("tournament_id", "rule", "s.player_code", F.explode(F.filter("s.lines", lambda x: x.isNotNull())).alias("l"))
    book = m.sparkSession.createDataFrame(BOOK, "rule string, stage string, result string, points long")
    return rows.select("tournament_id", "rule", "player_code", "l.*").join(book, ["rule", "stage", "result"]).groupBy("tournament_id", "player_code").agg(F.sum("points").alias("points"))


_B = "join rb on rb.rule = r.rule and rb.result = '{0}' and rb.stage = {1}"
BRANCHES = " union all ".join(
    f"select g.tournament_id, g.{who} as player_code, rb.points from sg g join ru r on r.tournament_id = g.tournament_id {_B.format(result, stage)} {more}"
    for who, result, stage, more in (
        ("winner", "W", "g.stage", "where g.stage = 'F' and g.draw = 'M'"),
        ("loser", "L", "g.stage", "where g.draw = 'M'"),
        ("winner", "W", "g.stage", "where g.draw = 'Q' and g.series = 'gs'"),
        ("loser", "L", "g.stage", "where g.draw = 'Q' and g.series = 'gs'"),
        ("winner", "W", "'Q'", "join la on la.tournament_id = g.tournament_id and la.place = g.place where g.stage <> 'Q1'"),
        ("loser", "L", "'Q'", "join la on la.tournament_id = g.tournament_id and la.place = g.place where g.stage <> 'Q1'"),
        ("winner", "W", "g.stage", "where g.stage = 'RR' and g.draw = 'M'"),
    )
)
POINTS_SQL = f", sg as {STAGED}, ru as {RULED}, la as (select tournament_id, max(place) as place from sg where draw = 'Q' and series <> 'dc' group by 1), rb(rule, stage, result, points) as (values {', '.join(map(str, BOOK))}), pts as (select tournament_id, player_code, cast(sum(points) as bigint) as points from ({BRANCHES}) z group by 1, 2)"


@query("m t", POINTS_SQL + " select tournament_id, player_code, points from pts")
def points_seven_branches(spark, sf_dir):
    return points(staged(spark, sf_dir))


STALE = "(select tournament_id, player_code, case when player_code < 50 then points else 0 end as points from pts join (select tournament_id as t2, min(start_dtm) as d from m group by 1) z on t2 = tournament_id where d < date '1996-01-01')"


@query("m t", POINTS_SQL + f" select n.tournament_id, n.player_code, n.points, case when o.player_code is null then 'insert' when o.points <> n.points then 'update' else 'noop' end as action from pts n left join {STALE} o on o.tournament_id = n.tournament_id and o.player_code = n.player_code")
def merge_points(spark, sf_dir):
    """Points of all tournaments merged into a table that has some of them, a part of those out of date."""
    new = session.pinned(points(staged(spark, sf_dir)))
    days = tables.matches(spark, sf_dir).groupBy("tournament_id").agg(F.min("start_dtm").alias("d")).filter("d < date '1996-01-01'").select("tournament_id")
    old = new.join(days, "tournament_id", "left_semi").withColumn("points", F.when(F.col("player_code") < 50, F.col("points")).otherwise(0))
    return merge.upsert(old, new, ["tournament_id", "player_code"])


@query("p", f", c as (select id, player_code, start_dtm, coalesce(cast(sum(case when match_result = 'win' then 1 else 0 end) over {W1} as bigint), 0) as wins from p) select id, player_code, wins, case when start_dtm >= date '1995-10-01' then 'insert' when start_dtm >= date '1995-05-01' and wins <> 0 then 'update' else 'noop' end as action from c where start_dtm < date '1996-01-01'")
def merge_enriched(spark, sf_dir):
    """Rows for a list of ids are enriched anew, from the history of their players only, and merged into those there are."""
    p = base(spark, sf_dir)
    ids = p.filter("start_dtm >= date '1995-05-01' and start_dtm < date '1996-01-01'").select("id").distinct()
    enrich = lambda rows: rows.select("id", "player_code", "start_dtm", tp.cumulative((F.col("match_result") == "win").cast("int"), tp.before(["player_code"], ORDER)).cast("long").alias("wins"))
    players = p.join(ids, "id", "left_semi").select("player_code").distinct()
    new = enrich(p.join(players, "player_code", "left_semi")).join(ids, "id", "left_semi").drop("start_dtm")
    old = enrich(p).filter("start_dtm < date '1995-10-01'").select("id", "player_code", F.when(F.col("start_dtm") < "1995-05-01", F.col("wins")).otherwise(0).alias("wins"))
    return merge.upsert(old, new, ["id", "player_code"])


@query("m", """, o as (select id, case when id % 2 = 0 then '63 62' end as score, case when id % 3 = 0 then '(RET)' end as ret from m where start_dtm < date '1997-01-01'), n as (select id, '64 36 76' as score, match_ret as ret from m where start_dtm >= date '1996-01-01')
  select coalesce(o.id, n.id) as id, coalesce(n.score, o.score) as score, coalesce(n.ret, o.ret) as ret, case when o.id is null then 'insert' when n.id is not null and (o.score is distinct from n.score or coalesce(n.ret, o.ret) is distinct from o.ret) then 'update' else 'noop' end as action from o full join n on n.id = o.id""")
def merge_scores(spark, sf_dir):
    """Scores read anew are merged into staged matches: what is new and known replaces, what is missing is put in."""
    m = tables.matches(spark, sf_dir)
    old = m.filter("start_dtm < date '1997-01-01'").select("id", F.when(F.col("id") % 2 == 0, "63 62").alias("score"), F.when(F.col("id") % 3 == 0, "(RET)").alias("ret"))
    new = m.filter("start_dtm >= date '1996-01-01'").select("id", F.lit("64 36 76").alias("score"), F.col("match_ret").alias("ret"))
    return merge.upsert(old, new, ["id"])


@query("m", """select 'players' as module, 'done' as status, cast((select count(distinct winner) from m) as bigint) as "rows", cast((select count(*) from (select winner from m group by 1 having min(start_dtm) >= date '1993-01-01') z) as bigint) as inserted
  union all select 'broken', 'failed', cast(null as bigint), cast(null as bigint)""")
def batch_audit(spark, sf_dir):
    """The log of two batches: one that merges players, and one that fails and changes nothing."""
    m = tables.matches(spark, sf_dir)
    players = lambda rows: rows.groupBy(F.col("winner").alias("code")).agg(F.count("*").alias("n"))
    folder = f"{session.shared_folder(spark)}/audit/{uuid.uuid4().hex}"
    audit.run(spark, folder, "players", lambda: merge.upsert(players(m.filter("start_dtm < date '1993-01-01'")), players(m), ["code"]))
    audit.run(spark, folder, "broken", lambda: m.select(F.raise_error(F.lit("a broken batch")).alias("x"), F.lit("noop").alias("action")))
    return audit.log(spark, folder).select("module", "status", "rows", "inserted")


DRAWS = (("R128", 128), ("R96", 96), ("R64", 64), ("R56", 56), ("R48", 48))
#: Tournament codes whose qualifying differs from that of their series.
Q12_TOUR, Q8_CHALLENGER = ("339", "425"), ("2861", "2863", "3824", "7009")
CODES = ("339", "425", "2861", "2863", "3824", "7009", "100", "200")
SIZES = (128, 96, 64, 56, 48, 32, 28, 18, 12, 8, 32, 24)
SERIES = ("atp250", "atp500", "ch50", "ch100", "nextGen", "atpFinal", "gs")


@query("m", f""", z as (select tournament_id, min(id) as i from m group by 1), g as (select tournament_id, 2023 + cast(i % 3 as int) as year, [{", ".join(map(str, SIZES))}][1 + i % 12] as size, {list(SERIES)}[1 + i // 12 % 7] as series, {list(CODES)}[1 + i // 84 % 8] as code from z)
  select tournament_id, case when year < 2024 then null when size = 128 then 'R128' when size = 96 then 'R96' when size = 64 then 'R64' when size = 56 then 'R56' when size = 48 then 'R48'
    when size = 32 and series in ('atp250', 'atp500') then case when code in ('339', '425') then 'R32-Q12' else 'R32-Q8' end when size = 32 and series in ('ch50', 'ch100') then case when code in ('2861', '2863', '3824', '7009') then 'R32-Q8' else 'R32-Q12' end
    when size = 28 then 'R28' when size = 18 then 'RR18' when size = 12 then 'RR12' when size = 8 and series = 'nextGen' then 'RR8-NG' when size = 8 and series = 'atpFinal' then 'RR8-F' end as draw_template from g""")
def draw_templates(spark, sf_dir):
    pick = lambda values, at: F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))
    z = tables.matches(spark, sf_dir).groupBy("tournament_id").agg(F.min("id").alias("i"))
    i = F.col("i")
    g = z.select("tournament_id", (2023 + i % 3).alias("year"), pick(SIZES, i % 12).alias("size"), pick(SERIES, F.expr("i div 12") % 7).alias("series"), pick(CODES, F.expr("i div 84") % 8).alias("code"))
    return g.select("tournament_id", draw_template(F.col("year"), F.col("size"), F.col("series"), F.col("code")).alias("draw_template"))


def draw_template(year, size, series, code):
    """The template of a draw from 2024 on, by its size and, for 32 and 8 entries, by series and code; null for others."""
    q12 = F.when(series.isin("atp250", "atp500"), code.isin(*Q12_TOUR)).when(series.isin("ch50", "ch100"), ~code.isin(*Q8_CHALLENGER))
    of_32 = F.when(q12, "R32-Q12").when(~q12, "R32-Q8")
    of_8 = F.when(series == "nextGen", "RR8-NG").when(series == "atpFinal", "RR8-F")
    by_size = F.coalesce(fx.mapped(size, {n: name for name, n in DRAWS} | {28: "R28", 18: "RR18", 12: "RR12"}), F.when(size == 32, of_32), F.when(size == 8, of_8))
    return F.when(year >= 2024, by_size)


@query("m", "select cast(extract(year from start_dtm) as varchar) || '-' || case when winner % 10 = 2 then cast(winner + 2 as varchar) else cast(winner as varchar) end || '-x' as key, id from m")
def entity_repoint_ids(spark, sf_dir):
    """Codes are replaced inside the ids that are made of them, too."""
    m = tables.matches(spark, sf_dir).select("id", "winner", F.year("start_dtm").alias("year"), F.concat_ws("-", "winner", F.lit("x")).alias("rest"))
    codes = m.select(F.col("winner").alias("old_code")).distinct().filter("old_code % 10 = 2").withColumn("new_code", F.col("old_code") + 2)
    return merge.replace_code(m, "winner", codes, texts=["rest"]).select(F.concat_ws("-", "year", "rest").alias("key"), "id")
