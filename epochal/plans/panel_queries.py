"""Projections, filters, joins and aggregates over the panel."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epochal.functions import features as fx
from epochal.operators import panel
from epochal.plans.registry import query
from epochal.sources import tables


def base(spark, sf_dir):
    return panel.unpivot(tables.matches(spark, sf_dir))


@query("p", "select id, tournament_id, rnd, player_code, opponent_code, match_result, cast(match_result = 'win' as int) as target from p")
def panel_unpivot(spark, sf_dir):
    return base(spark, sf_dir).select("id", "tournament_id", "rnd", "player_code", "opponent_code", "match_result", (F.col("match_result") == "win").cast("int").alias("target"))


@query("p", """select id, player_code, opponent_code, match_result, 'tour' as origin from p where id % 2 = 0
  union all select id, player_code, opponent_code, match_result, 'cup' from p where id % 2 = 1 and match_ret is null""")
def panel_unpivot_4way(spark, sf_dir):
    m = tables.matches(spark, sf_dir)
    tour = m.filter("id % 2 = 0").withColumn("origin", F.lit("tour"))
    cup = m.filter("id % 2 = 1 and match_ret is null").withColumn("origin", F.lit("cup"))
    return panel.unpivot(panel.union_sources(tour, cup)).select("id", "player_code", "opponent_code", "match_result", "origin")


@query("m", """select id, tournament_id, cast(substr(tournament_id, 1, 4) as int) as year from m
  where cast(substr(tournament_id, 1, 4) as int) between 1994 and 1996 and (match_ret is null or match_ret <> '(W/O)')""")
def year_and_placeholder_filter(spark, sf_dir):
    m = tables.matches(spark, sf_dir).withColumn("year", fx.leading_year(F.col("tournament_id")))
    return m.filter(F.col("year").between(1994, 1996) & (F.col("match_ret").isNull() | (F.col("match_ret") != "(W/O)"))).select("id", "tournament_id", "year")


@query("p pl t", """select p.id, p.player_code, a.player_name, b.player_name as opponent_name, a.citizenship as player_citizenship, b.citizenship as opponent_citizenship,
  cast(coalesce(a.citizenship = t.country, false) as int) as player_home, cast(coalesce(b.citizenship = t.country, false) as int) as opponent_home
  from p left join pl a on a.player_code = p.player_code left join pl b on b.player_code = p.opponent_code left join t on t.tournament_id = p.tournament_id""")
def player_meta_join(spark, sf_dir):
    players = tables.players(spark, sf_dir).withColumnRenamed("player_name", "name")
    p = panel.attach(base(spark, sf_dir), players, "player_code", ["name", "citizenship"])
    p = p.join(tables.tournaments(spark, sf_dir).select("tournament_id", "country"), "tournament_id", "left")
    return p.select("id", "player_code", "player_name", "opponent_name", "player_citizenship", "opponent_citizenship", *[fx.home(F.col(f"{r}_citizenship"), F.col("country")).alias(f"{r}_home") for r in ("player", "opponent")])


@query("p t", "select p.id, p.player_code, p.tournament_id, t.country, t.category, t.indoor, cast(t.start_dtm as varchar) as starts from p left join t on t.tournament_id = p.tournament_id")
def tournament_meta_join(spark, sf_dir):
    t = tables.tournaments(spark, sf_dir).withColumnRenamed("start_dtm", "starts")
    return base(spark, sf_dir).join(t, "tournament_id", "left").select("id", "player_code", "tournament_id", "country", "category", "indoor", F.col("starts").cast("string").alias("starts"))


@query("m t pl", """select m.id, w.player_name as winner_name, l.player_name as loser_name, t.country, t.category,
  cast(m.start_dtm as varchar) || ' ' || lpad(cast(m.rnd as varchar), 2, '0') as ord_start,
  floor(((extract(year from m.start_dtm) - w.turned_pro) * 12 + extract(month from m.start_dtm) - 1) * 1000 / 12.0) / 1000 as winner_years,
  case when m.match_ret is null then 1000 * round(s.won_points / nullif(cast(s.won_points + s.lost_points as double), 0), 3) end as won_share
  from m join t on t.tournament_id = m.tournament_id join pl w on w.player_code = m.winner join pl l on l.player_code = m.loser
  left join (""" + tables.STATS + """) s on s.id = m.id""")
def star_view(spark, sf_dir):
    pl = tables.players(spark, sf_dir)
    m = tables.matches(spark, sf_dir).join(tables.tournaments(spark, sf_dir).drop("start_dtm", "continent"), "tournament_id")
    for role in ("winner", "loser"):
        m = m.join(pl.select(F.col("player_code").alias(role), F.col("player_name").alias(f"{role}_name"), F.col("turned_pro").alias(f"{role}_pro")), role)  # 150 players
    m = m.join(tables.stats(spark, sf_dir), "id", "left")
    months = F.months_between(F.trunc("start_dtm", "month"), F.make_date("winner_pro", F.lit(1), F.lit(1)))
    share = F.round(F.try_divide(F.col("won_points"), F.nullif((F.col("won_points") + F.col("lost_points")).cast("double"), F.lit(0.0))), 3) * 1000
    return m.select("id", "winner_name", "loser_name", "country", "category", fx.ordinal_start(F.col("start_dtm"), F.col("rnd")).alias("ord_start"), (F.floor(F.round(months) * 1000 / 12) / 1000).alias("winner_years"), F.when(F.col("match_ret").isNull(), share).alias("won_share"))


#: Day that parts a player's early and late rows: one in seven has late ones only, one in seven early ones only.
LATE = "case player_code % 7 when 0 then date '1900-01-01' when 1 then date '2100-01-01' else date '1998-01-01' end"


@query("p", f"""select coalesce(a.player_code, b.player_code) as player_code, coalesce(a.n, 0) as early, coalesce(b.n, 0) as late, coalesce(b.wins, 0) as late_wins, cast(coalesce(a.n, 0) + coalesce(b.n, 0) <= 20 as int) as low
  from (select player_code, count(*) n from p where start_dtm < {LATE} group by 1) a
  full join (select player_code, count(*) n, cast(count(*) filter (match_result = 'win') as bigint) wins from p where start_dtm >= {LATE} group by 1) b on a.player_code = b.player_code""")
def full_outer_counts(spark, sf_dir):
    p = base(spark, sf_dir)
    early = p.filter(f"start_dtm < {LATE}").groupBy("player_code").agg(F.count("*").alias("early"))
    late = p.filter(f"start_dtm >= {LATE}").groupBy("player_code").agg(F.count("*").alias("late"), F.count_if(F.col("match_result") == "win").alias("late_wins"))
    out = early.join(late, "player_code", "full").fillna(0, ["early", "late", "late_wins"])
    return out.withColumn("low", (F.col("early") + F.col("late") <= 20).cast("int"))


@query("m", "select distinct loser as player_code from m where start_dtm >= date '1995-01-16' and loser not in (select winner from m where start_dtm < date '1995-01-16')")
def new_players_anti(spark, sf_dir):
    """Who loses since a day without having won before it."""
    m = tables.matches(spark, sf_dir)
    known = m.filter("start_dtm < date '1995-01-16'").select(F.col("winner").alias("player_code"))
    return m.filter("start_dtm >= date '1995-01-16'").select(F.col("loser").alias("player_code")).distinct().join(known, "player_code", "left_anti")


@query("p", "select id, player_code, match_result from p where player_code in (select winner from m where rnd = 11 and surface = 'Grass' and start_dtm >= date '2001-01-01')")
def cohort_semi(spark, sf_dir):
    """All rows of those who won a final on grass in the last year."""
    finalists = tables.matches(spark, sf_dir).filter("rnd = 11 and surface = 'Grass' and start_dtm >= date '2001-01-01'").select(F.col("winner").alias("player_code"))
    return base(spark, sf_dir).join(finalists, "player_code", "left_semi").select("id", "player_code", "match_result")


@query("p", """select player_code, surface, wins, n, rate from (
  select *, row_number() over (partition by player_code order by rate desc, surface nulls first) as rn from (
    select player_code, surface, cast(count(*) filter (match_result = 'win') as bigint) as wins, count(*) as n, round(count(*) filter (match_result = 'win') / cast(count(*) as double), 6) as rate
    from p group by 1, 2) g) r where rn = 1""")
def favourite_surface(spark, sf_dir):
    g = base(spark, sf_dir).groupBy("player_code", "surface").agg(F.count_if(F.col("match_result") == "win").alias("wins"), F.count("*").alias("n"))
    g = g.withColumn("rate", F.round(F.col("wins") / F.col("n"), 6))
    first = F.row_number().over(Window.partitionBy("player_code").orderBy(F.desc("rate"), F.asc_nulls_first("surface")))
    return g.withColumn("rn", first).filter("rn = 1").drop("rn")


@query("p", """select tournament_id, player_code, count(*) as played, max(rnd) as furthest, cast(max(case when rnd = 11 and match_result = 'win' then 1 else 0 end) as int) as won from p group by 1, 2""")
def player_tournament(spark, sf_dir):
    won = F.max(F.when((F.col("rnd") == 11) & (F.col("match_result") == "win"), 1).otherwise(0)).cast("int")
    return base(spark, sf_dir).groupBy("tournament_id", "player_code").agg(F.count("*").alias("played"), F.max("rnd").alias("furthest"), won.alias("won"))


@query("m", """select tournament_id, case when kind = 'G' then 'gs' when kind = 'M' then '1000' when kind = 'A' then 'atp500' else kind end as category,
  case when n <= 12 then 'small' when n <= 20 and cast(substr(tournament_id, 1, 4) as int) < 1996 then 'early-mid' when n <= 20 then 'mid' else 'large' end as template, n
  from (select tournament_id, count(*) as n, case cast(min(id) % 5 as int) when 0 then 'G' when 1 then 'M' when 2 then 'A' when 3 then 'B' else 'C' end as kind from m group by 1) g""")
def category_recode(spark, sf_dir):
    kind = fx.mapped(F.min("id") % 5, {0: "G", 1: "M", 2: "A", 3: "B", 4: "C"})
    g = tables.matches(spark, sf_dir).groupBy("tournament_id").agg(F.count("*").alias("n"), kind.alias("kind"))
    early = fx.leading_year(F.col("tournament_id")) < 1996
    template = F.when(F.col("n") <= 12, "small").when((F.col("n") <= 20) & early, "early-mid").when(F.col("n") <= 20, "mid").otherwise("large")
    return g.select("tournament_id", fx.recoded(F.col("kind"), fx.LEVELS).alias("category"), template.alias("template"), "n")


@query("m", """select m.id, coalesce(m.match_order, f.n) as match_order from (select *, case when id % 4 <> 0 then id % 100 end as match_order from m) m
  left join (select id, row_number() over (partition by tournament_id, rnd order by id) as n from (select distinct id, tournament_id, rnd from m where id % 4 = 0) d) f on f.id = m.id""")
def sequence_fill(spark, sf_dir):
    m = tables.matches(spark, sf_dir).withColumn("match_order", F.when(F.col("id") % 4 != 0, F.col("id") % 100))
    number = F.row_number().over(Window.partitionBy("tournament_id", "rnd", F.col("match_order").isNull()).orderBy("id")).cast("long")
    return m.select("id", F.coalesce("match_order", number).alias("match_order"))


@query("m", """select least(winner, loser) as player_a, greatest(winner, loser) as player_b, count(*) as n from m group by 1, 2 having count(*) > 3 order by n desc, 1, 2 limit 50""")
def frequent_rivals(spark, sf_dir):
    pairs = tables.matches(spark, sf_dir).groupBy(F.least("winner", "loser").alias("player_a"), F.greatest("winner", "loser").alias("player_b")).agg(F.count("*").alias("n"))
    return pairs.filter("n > 3").orderBy(F.desc("n"), "player_a", "player_b").limit(50)


@query("m", "select tournament_id from (select distinct tournament_id from m) d order by md5(tournament_id || '42'), tournament_id limit 100")
def sampled_groups(spark, sf_dir):
    return tables.matches(spark, sf_dir).select("tournament_id").distinct().orderBy(F.md5(F.concat("tournament_id", F.lit("42")).cast("binary")), "tournament_id").limit(100)


@query("m", "select id from m where match_ret = '(W/O)' order by start_dtm desc, tournament_id, rnd, id limit 50")
def missing_stats_worklist(spark, sf_dir):
    return tables.matches(spark, sf_dir).filter("match_ret = '(W/O)'").orderBy(F.desc("start_dtm"), "tournament_id", "rnd", "id").limit(50).select("id")


@query("m sd", """select replace(link, 'stats-centre', 'match-stats') as stats_url, link as original_url from (select m.id, concat('/stats-centre/', cast(m.id as varchar)) as link, m.start_dtm, sd.w_aces, sd.l_aces from m left join sd on sd.id = m.id where m.id % 9 <> 0) z
  where w_aces is null or l_aces is null order by start_dtm desc, link limit 50""")
def missing_stats_links(spark, sf_dir):
    """Links of matches that have one and lack a side's statistics, rewritten to where they are now: a report of fifty."""
    m = tables.matches(spark, sf_dir).filter("id % 9 <> 0").withColumn("link", F.concat(F.lit("/stats-centre/"), F.col("id").cast("string")))
    lacking = m.join(tables.sides(spark, sf_dir).select("id", "w_aces", "l_aces"), "id", "left").filter("w_aces is null or l_aces is null")
    return lacking.orderBy(F.desc("start_dtm"), "link").limit(50).select(F.replace("link", F.lit("stats-centre"), F.lit("match-stats")).alias("stats_url"), F.col("link").alias("original_url"))


CODES = ", ".join(f"('{code}', '{name}')" for code, name in fx.continents().items())


@query("", f"select substr(n_name, 1, 3) as country, c.continent, count(*) as customers from {{customer}} join {{nation}} on c_nationkey = n_nationkey left join (values {CODES}) c(code, continent) on c.code = substr(n_name, 1, 3) group by 1, 2")
def continents(spark, sf_dir):
    """Customers by country code, with the continents that the list of codes gives."""
    c = tables.table(spark, sf_dir, "customer").join(tables.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    code = F.substring("n_name", 1, 3)
    return c.groupBy(code.alias("country")).agg(F.count("*").alias("customers")).select("country", fx.continent(F.col("country")).alias("continent"), "customers")


@query("m", "select winner as player_code from m where surface is null union select loser from m where surface = 'Carpet'")
def player_discovery(spark, sf_dir):
    m = tables.matches(spark, sf_dir)
    return m.filter("surface is null").select(F.col("winner").alias("player_code")).union(m.filter("surface = 'Carpet'").select("loser")).distinct()


@query("m", """select id, rnd, case rnd when 6 then 'R64' when 7 then 'R32' when 8 then 'R16' when 9 then 'QF' when 10 then 'SF' when 11 then 'F' end as stage,
  case rnd when 6 then 7 when 7 then 8 when 8 then 9 when 9 then 10 when 10 then 11 when 11 then 12 end as main_place,
  cast(match_ret = '(RET)' and match_ret is not null as int) as is_ret, cast(match_ret is not null and match_ret in ('(W/O)', '(WEA)', 'W/O') as int) as is_wo,
  case when lower(surface) like '%clay%' then 'Clay' when lower(surface) like '%grass%' then 'Grass' when lower(surface) like '%carpet%' then 'Carpet' when lower(surface) like '%hard%' then 'Hard' end as court from m""")
def ladder_and_flags(spark, sf_dir):
    stage = fx.mapped(F.col("rnd"), {6: "R64", 7: "R32", 8: "R16", 9: "QF", 10: "SF", 11: "F"})
    m = tables.matches(spark, sf_dir).withColumn("stage", stage)
    return m.select("id", "rnd", "stage", fx.place(F.col("stage"), fx.MAIN_LADDER).alias("main_place"), fx.retired(F.col("match_ret")).alias("is_ret"), fx.walkover(F.col("match_ret")).alias("is_wo"), fx.court(F.col("surface")).alias("court"))
