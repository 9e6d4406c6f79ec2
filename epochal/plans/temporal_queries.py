"""Point-in-time queries: rankings, career, form, pair history, averages, rest, range statistics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epochal.functions import features as fx
from epochal.operators import panel, scans
from epochal.operators import temporal as tp
from epochal.plans.panel_queries import base
from epochal.plans.registry import query
from epochal.sources import tables

ORDER = ["start_dtm", "tournament_id", "rnd", "id"]
O = "order by start_dtm, tournament_id, rnd, id"  # noqa: E741
#: Days of a slice of as-of joins.
SLICE = 91


def month():
    """The blocks that a player's matches are scanned by."""
    return F.trunc("start_dtm", "month")


def won():
    return F.col("match_result") == "win"


def ranked(spark, sf_dir, days=1, name="ranking"):
    """The panel with each player's last ranking at so many days before the match."""
    probe = base(spark, sf_dir).withColumn("probe_date", F.date_sub("start_dtm", days))
    history = tables.rankings(spark, sf_dir).withColumnRenamed("ranking", name)
    return tp.asof(probe, history, ["player_code"], "probe_date", "snapshot_date", [name], slice_width=SLICE).drop("probe_date")


ASOF = "select p.*, rk.ranking as {name} from p asof left join rk on rk.player_code = p.player_code and rk.snapshot_date <= p.start_dtm - {days}"


@query("p rk", "select id, player_code, ranking from (" + ASOF.format(name="ranking", days=1) + ") a")
def rank_asof(spark, sf_dir):
    return ranked(spark, sf_dir).select("id", "player_code", "ranking")


@query("p rk", """select a.id, a.player_code, a.r0, b.r28, c.r84 from (""" + ASOF.format(name="r0", days=1) + ") a join (" + ASOF.format(name="r28", days=29) + ") b on a.id = b.id and a.player_code = b.player_code join (" + ASOF.format(name="r84", days=85) + ") c on a.id = c.id and a.player_code = c.player_code")
def rank_asof_shifted(spark, sf_dir):
    return shifted(spark, sf_dir).select("id", "player_code", "r0", "r28", "r84")


def shifted(spark, sf_dir):
    """id, player_code, r0, r28, r84: one union for all three dates, a slim probe row for each of them, folded back."""
    p = base(spark, sf_dir).select("id", "player_code", "start_dtm")
    probes = p.select("id", "player_code", F.explode(F.array(F.lit(1), F.lit(29), F.lit(85))).alias("back"), "start_dtm")
    probes = probes.select("id", "player_code", "back", F.expr("date_sub(start_dtm, back)").alias("probe_date"))
    found = tp.asof(probes, tables.rankings(spark, sf_dir), ["player_code"], "probe_date", "snapshot_date", ["ranking"], slice_width=SLICE)
    picked = [F.max(F.when(F.col("back") == b, F.col("ranking"))).alias(n) for b, n in ((1, "r0"), (29, "r28"), (85, "r84"))]
    return found.repartition("id").groupBy("id", "player_code").agg(*picked)


@query("p rk", """select id, player_code, case when r0 is not null and r28 is not null then case when r28 - r0 >= greatest(1, ceil(greatest(r0, r28) * 0.02)) then 1 when r28 - r0 <= -greatest(1, ceil(greatest(r0, r28) * 0.02)) then -1 else 0 end end as trend_4w,
  case when r0 is not null and r84 is not null then case when r84 - r0 >= greatest(1, ceil(greatest(r0, r84) * 0.05)) then 1 when r84 - r0 <= -greatest(1, ceil(greatest(r0, r84) * 0.05)) then -1 else 0 end end as trend_12w
  from (select a.id, a.player_code, a.r0, b.r28, c.r84 from (""" + ASOF.format(name="r0", days=1) + ") a join (" + ASOF.format(name="r28", days=29) + ") b on a.id = b.id and a.player_code = b.player_code join (" + ASOF.format(name="r84", days=85) + ") c on a.id = c.id and a.player_code = c.player_code) z")
def rank_trend(spark, sf_dir):
    s = shifted(spark, sf_dir)
    return s.select("id", "player_code", fx.trend_number(fx.trend(F.col("r0"), F.col("r28"), 0.02)).alias("trend_4w"), fx.trend_number(fx.trend(F.col("r0"), F.col("r84"), 0.05)).alias("trend_12w"))


@query("p rk", """select id, player_code, theirs - ranking as rank_diff, case when ranking > 0 and theirs > 0 then round(ln(theirs) - ln(ranking), 6) end as rank_log_ratio
  from (select *, coalesce(lag(ranking) over w, lead(ranking) over w) as theirs from (""" + ASOF.format(name="ranking", days=1) + """) a window w as (partition by id order by match_result)) b""")
def rank_differences(spark, sf_dir):
    a = ranked(spark, sf_dir).withColumn("theirs", panel.partner("ranking"))
    logs = F.when((F.col("ranking") > 0) & (F.col("theirs") > 0), F.round(F.log("theirs") - F.log("ranking"), 6))
    return a.select("id", "player_code", (F.col("theirs") - F.col("ranking")).alias("rank_diff"), logs.alias("rank_log_ratio"))


@query("p rk pl", """, a as (""" + ASOF.format(name="ranking", days=1) + """), s as (select player_code, min(ranking) as seed from rk where snapshot_date < date '1993-01-01' group by 1)
  select id, player_code, min(case when rn = 1 then seed else ranking end) over (partition by player_code """ + O + """ rows between unbounded preceding and current row) as best_rank
  from (select a.*, s.seed, row_number() over (partition by a.player_code order by a.start_dtm, a.tournament_id, a.rnd, a.id) as rn from a left join s on s.player_code = a.player_code) z""")
def rank_best_so_far(spark, sf_dir):
    seeds = tables.rankings(spark, sf_dir).filter("snapshot_date < date '1993-01-01'").groupBy("player_code").agg(F.min("ranking").alias("seed"))
    a = ranked(spark, sf_dir).join(seeds, "player_code", "left")
    return tp.running_best(a, "ranking", "seed", ["player_code"], ORDER, "best_rank", month()).select("id", "player_code", "best_rank")


@query("rk pl", """select pl.player_code, pl.turned_pro, min(rk.ranking) as best_rank, count(*) as snapshots from pl join rk on rk.player_code = pl.player_code and extract(year from rk.snapshot_date) between pl.turned_pro and 1998 group by 1, 2""")
def interval_best_rank(spark, sf_dir):
    joined = tables.rankings(spark, sf_dir).join(tables.players(spark, sf_dir), "player_code").filter(F.year("snapshot_date").between(F.col("turned_pro"), 1998))
    return joined.groupBy("player_code", "turned_pro").agg(F.min("ranking").alias("best_rank"), F.count("*").alias("snapshots"))


W1 = "(partition by player_code " + O + " rows between unbounded preceding and 1 preceding)"


@query("p", f"""select id, player_code, coalesce(cast(sum(case when match_result = 'win' then 1 else 0 end) over w as bigint), 0) as prior_wins, row_number() over (partition by player_code {O}) - 1 as prior_matches,
  round((player_code % 5 + coalesce(sum(case when match_result = 'win' then 1 else 0 end) over w, 0)) / nullif(cast(player_code % 9 + row_number() over (partition by player_code {O}) - 1 as double), 0), 6) as win_rate
  from p window w as {W1}""")
def career_stats(spark, sf_dir):
    p = scans.before(base(spark, sf_dir), ["player_code"], month(), ORDER, {"prior_wins": won().cast("int"), "prior_matches": F.lit(1)})
    rate = F.try_divide(F.col("player_code") % 5 + F.col("prior_wins"), F.nullif((F.col("player_code") % 9 + F.col("prior_matches")).cast("double"), F.lit(0.0)))
    return p.select("id", "player_code", "prior_wins", "prior_matches", F.round(rate, 6).alias("win_rate"))


@query("p t", f"""select id, player_code, coalesce(cast(sum(won) over w as bigint), 0) as titles, coalesce(cast(sum(won * gs) over w as bigint), 0) as gs_titles
  from (select p.*, case when rnd = 11 and match_result = 'win' then 1 else 0 end as won, case when category = 'gs' then 1 else 0 end as gs from p join t on t.tournament_id = p.tournament_id) p window w as {W1.replace("start_dtm", "p.start_dtm")}""")
def titles_cumulative(spark, sf_dir):
    p = base(spark, sf_dir).join(tables.tournaments(spark, sf_dir).select("tournament_id", "category"), "tournament_id")
    title = ((F.col("rnd") == 11) & won()).cast("int")
    p = scans.before(p, ["player_code"], month(), ORDER, {"titles": title, "gs_titles": title * (F.col("category") == "gs").cast("int")})
    return p.select("id", "player_code", "titles", "gs_titles")


@query("p", f"""select id, player_code, surface, round((1 + coalesce(sum(case when match_result = 'win' then 1 else 0 end) over w, 0)) / cast(2 + row_number() over (partition by player_code, surface {O}) - 1 as double), 6) as surface_rate
  from p where surface is not null window w as (partition by player_code, surface {O} rows between unbounded preceding and 1 preceding)""")
def surface_progressive(spark, sf_dir):
    p = scans.before(base(spark, sf_dir).filter("surface is not null"), ["player_code", "surface"], month(), ORDER, {"wins": won().cast("int"), "played": F.lit(1)})
    return p.select("id", "player_code", "surface", F.round((1 + F.col("wins")) / (2 + F.col("played")).cast("double"), 6).alias("surface_rate"))


@query("p st", f"""select p.id, p.player_code, coalesce(cast(sum(sets) over w as bigint), 0) as prior_sets, coalesce(cast(sum(sets) over w as bigint), 0) + sets as sets_so_far from (
  select p.*, case when p.match_ret is null then coalesce(st.sets_played, 0) else 0 end as sets from p left join st on st.id = p.id) p window w as (partition by player_code, tournament_id order by rnd, id rows between unbounded preceding and 1 preceding)""")
def sets_in_tournament(spark, sf_dir):
    p = base(spark, sf_dir).join(tables.stats(spark, sf_dir).select("id", "sets_played"), "id", "left")
    p = p.withColumn("sets", F.when(F.col("match_ret").isNull(), F.coalesce("sets_played", F.lit(0))).otherwise(0))
    earlier = tp.cumulative(F.col("sets"), tp.before(["player_code", "tournament_id"], ["rnd", "id"])).cast("long")
    return p.select("id", "player_code", earlier.alias("prior_sets"), (earlier + F.col("sets")).cast("long").alias("sets_so_far"))


def last_rows(k):
    return f"(partition by player_code {O} rows between {k} preceding and 1 preceding)"


def form_shares(p):
    """The panel with the shares of the last five and ten matches that were won."""
    return shares(scans.before(p, ["player_code"], month(), ORDER, last={"_last": (won().cast("double"), 10)}))


def shares(p):
    """form_5 and form_10 of the results of the last ten matches (_last)."""
    share = lambda x: F.try_divide(F.aggregate(x, F.lit(0.0), lambda a, b: a + b), F.size(x))
    return p.withColumns({f"form_{k}": share(F.slice("_last", F.greatest(F.size("_last") - k + 1, F.lit(1)), k)) for k in (5, 10)}).drop("_last")


@query("p", f"""select id, player_code, round(form_5, 6) as form_5, round(form_10, 6) as form_10, cast(form_5 > 0.7 as int) as good_form from (
  select id, player_code, avg(win) over {last_rows(5)} as form_5, avg(win) over {last_rows(10)} as form_10 from (select *, case when match_result = 'win' then 1.0 else 0.0 end::double as win from p) q) r""")
def form_last_5_10(spark, sf_dir):
    f = form_shares(base(spark, sf_dir))
    return f.select("id", "player_code", F.round("form_5", 6).alias("form_5"), F.round("form_10", 6).alias("form_10"), (F.col("form_5") > 0.7).cast("int").alias("good_form"))


@query("p", """, pt as (select tournament_id, player_code, start_dtm, max(case when rnd = 11 and match_result = 'win' then 1 else 0 end) as won from p group by 1, 2, 3),
  prev as (select p.id, p.player_code, (select max(q.tournament_id) from pt q where q.player_code = p.player_code and q.start_dtm = (select max(z.start_dtm) from pt z where z.player_code = p.player_code and z.start_dtm < p.start_dtm)) as prev_tournament from p)
  select prev.id, prev.player_code, prev.prev_tournament, cast(coalesce(pt.won, 0) as int) as won_previous from prev left join pt on pt.player_code = prev.player_code and pt.tournament_id = prev.prev_tournament""")
def won_previous_tournament(spark, sf_dir):
    p = base(spark, sf_dir)
    won = p.groupBy(F.col("tournament_id").alias("prev_tournament"), "player_code").agg(F.max(((F.col("rnd") == 11) & (F.col("match_result") == "win")).cast("int")).alias("won"))
    prev = tp.previous_event(p, ["player_code"], "start_dtm", "tournament_id", "prev_tournament")
    return prev.join(won, ["player_code", "prev_tournament"], "left").select("id", "player_code", "prev_tournament", F.coalesce("won", F.lit(0)).alias("won_previous"))


def pairs(m):
    """Matches by pair, with an event key that counts days and rounds, and whether the smaller code won."""
    key = F.datediff("start_dtm", F.lit("1970-01-01")) * 100 + F.col("rnd")
    return m.select("*", F.least("winner", "loser").alias("player_a"), F.greatest("winner", "loser").alias("player_b"), key.alias("event_key"), (F.col("winner") < F.col("loser")).cast("int").alias("a_won"))


def pair_history(m, keys):
    """Matches with the counters of their pair after its last earlier event."""
    done = pairs(m).groupBy(*keys, "event_key").agg(F.count("*").alias("n"), F.sum("a_won").alias("a"))
    so_far = Window.partitionBy(*keys).orderBy("event_key").rowsBetween(Window.unboundedPreceding, 0)
    done = done.select(*keys, "event_key", F.sum("n").over(so_far).alias("met"), F.sum("a").over(so_far).alias("a_wins"))
    return tp.asof(pairs(m), done, keys, "event_key", "event_key", ["met", "a_wins"], strict=True, slice_width=100 * SLICE)


PAIRS = """, g as (select *, least(winner, loser) as player_a, greatest(winner, loser) as player_b, date_diff('day', date '1970-01-01', start_dtm) * 100 + rnd as event_key, cast(winner < loser as int) as a_won from m)"""


@query("m", PAIRS + " select g.id, g.player_a, g.player_b, (select count(*) from g h where h.player_a = g.player_a and h.player_b = g.player_b and h.event_key < g.event_key) as met, (select coalesce(cast(sum(h.a_won) as bigint), 0) from g h where h.player_a = g.player_a and h.player_b = g.player_b and h.event_key < g.event_key) as a_wins from g")
def h2h_full(spark, sf_dir):
    h = pair_history(tables.matches(spark, sf_dir), ["player_a", "player_b"])
    return h.select("id", "player_a", "player_b", F.coalesce("met", F.lit(0)).alias("met"), F.coalesce("a_wins", F.lit(0)).alias("a_wins"))


@query("m", PAIRS + " select g.id, g.surface, (select count(*) from g h where h.player_a = g.player_a and h.player_b = g.player_b and h.surface = g.surface and h.event_key < g.event_key) as met, (select coalesce(cast(sum(h.a_won) as bigint), 0) from g h where h.player_a = g.player_a and h.player_b = g.player_b and h.surface = g.surface and h.event_key < g.event_key) as a_wins from g where g.surface is not null")
def h2h_surface(spark, sf_dir):
    h = pair_history(tables.matches(spark, sf_dir).filter("surface is not null"), ["player_a", "player_b", "surface"])
    return h.select("id", "surface", F.coalesce("met", F.lit(0)).alias("met"), F.coalesce("a_wins", F.lit(0)).alias("a_wins"))


@query("m", PAIRS + """ select id, round(least(0.999, greatest(0.001, (a_wins + 4.0) / (met + 8.0))), 6) as h2h_rate, round(met / (met + 8.0), 6) as h2h_credibility, cast(met > 0 as int) as has_h2h from (
  select g.id, (select count(*) from g h where h.player_a = g.player_a and h.player_b = g.player_b and h.event_key < g.event_key) as met, (select coalesce(cast(sum(h.a_won) as bigint), 0) from g h where h.player_a = g.player_a and h.player_b = g.player_b and h.event_key < g.event_key) as a_wins from g) z""")
def h2h_smoothed(spark, sf_dir):
    h = pair_history(tables.matches(spark, sf_dir), ["player_a", "player_b"])
    return h.select("id", F.round(fx.smoothed(F.col("a_wins"), F.col("met"), 8.0), 6).alias("h2h_rate"), F.round(fx.credibility(F.col("met"), 8.0), 6).alias("h2h_credibility"), (F.coalesce("met", F.lit(0)) > 0).cast("int").alias("has_h2h"))


def kpis(spark, sf_dir):
    """The panel with the share of points won and aces of each match."""
    s = tables.stats(spark, sf_dir).select("id", fx.ratio(F.col("won_points"), F.col("all_points")).alias("kpi"), "aces", "lost_points", "won_points")
    return base(spark, sf_dir).join(s, "id", "left")


KPI = "(select p.*, case when all_points > 0 then won_points / cast(all_points as double) end as kpi, aces, won_points, lost_points from p left join st on st.id = p.id) k"


@query("p st", f"select id, player_code, round(avg(kpi) over {W1}, 6) as kpi_mean from {KPI}")
def kpi_lagged_avg(spark, sf_dir):
    return scans.means(kpis(spark, sf_dir), ["player_code"], month(), ORDER, {"mean": (F.col("kpi"), 1)}).select("id", "player_code", F.round("mean", 6).alias("kpi_mean"))


@query("p st", f"select id, player_code, case when count(kpi) over {W1} >= 5 then round(avg(kpi) over {W1}, 6) end as kpi_mean, case when count(aces) over {W1} >= 5 then round(avg(aces) over {W1}, 6) end as aces_mean from {KPI}")
def kpi_lagged_avg_min5(spark, sf_dir):
    k = scans.means(kpis(spark, sf_dir), ["player_code"], month(), ORDER, {f"{c}_mean": (F.col(c), 5) for c in ("kpi", "aces")})
    return k.select("id", "player_code", *[F.round(f"{c}_mean", 6).alias(f"{c}_mean") for c in ("kpi", "aces")])


@query("p st", f""", z as (select id, player_code, opponent_code, avg(kpi) over {W1} as v from {KPI}) select a.id, a.player_code, case when a.v is not null and b.v is not null then round(ln(greatest(a.v, 1e-6) / greatest(b.v, 1e-6)), 6) end as kpi_log_ratio from z a join z b on a.id = b.id and a.opponent_code = b.player_code""")
def log_ratio(spark, sf_dir):
    z = scans.means(kpis(spark, sf_dir), ["player_code"], month(), ORDER, {"v": (F.col("kpi"), 1)})
    return z.withColumn("theirs", panel.partner("v")).select("id", "player_code", F.round(fx.log_ratio(F.col("v"), F.col("theirs")), 6).alias("kpi_log_ratio"))


@query("p st", f"""select id, player_code, case when count(lost_points) over {W1} > 0 then round(avg(won_points) over {W1} / greatest(avg(lost_points) over {W1}, 1e-9), 6) end as efficiency, round(avg(won_points) over {W1} - avg(lost_points) over {W1}, 6) as clutch_gap,
  case when won_points is not null and lost_points is not null and aces is not null then greatest(0, least(won_points - aces, lost_points)) end as games from {KPI}""")
def clutch_gap(spark, sf_dir):
    k = scans.means(kpis(spark, sf_dir), ["player_code"], month(), ORDER, {f"_{c}": (F.col(c), 1) for c in ("won_points", "lost_points")})
    a, b = F.col("_won_points"), F.col("_lost_points")
    games = fx.clamped_games(F.col("won_points"), F.col("aces"), F.col("lost_points")).cast("long")
    efficiency = F.when(b.isNotNull(), a / F.greatest(b, F.lit(1e-9)))
    return k.select("id", "player_code", F.round(efficiency, 6).alias("efficiency"), F.round(a - b, 6).alias("clutch_gap"), games.alias("games"))


PT = """, pt as (select player_code, p.tournament_id, t.start_dtm, t.country, t.continent, t.indoor, min(p.surface) as surface, count(*) as played, max(rnd) as furthest from p join t on t.tournament_id = p.tournament_id group by 1, 2, 3, 4, 5, 6)"""
TW = "(partition by player_code order by start_dtm, tournament_id)"


def player_tournaments(spark, sf_dir):
    t = tables.tournaments(spark, sf_dir).select("tournament_id", F.col("start_dtm").alias("starts"), "country", "continent", "indoor")
    g = base(spark, sf_dir).join(t, "tournament_id").groupBy("player_code", "tournament_id", "starts", "country", "continent", "indoor")
    return g.agg(F.min("surface").alias("surface"), F.count("*").alias("played"), F.max("rnd").alias("furthest"))


@query("p t", PT + f""" select player_code, tournament_id, days, cast(coalesce(days <= 9, false) as int) as back_to_back, cast(coalesce(days > 9 and days <= 16, false) as int) as two_weeks, cast(coalesce(days >= 21, false) as int) as long_rest,
  2.0::double * cast(coalesce(continent <> c1, false) as int) + 1.0::double * cast(coalesce(country <> c2, false) as int) + 1.0::double * cast(coalesce(surface <> c3, false) as int) + 0.5::double * cast(coalesce(indoor <> c4, false) as int) as fatigue
  from (select *, date_diff('day', lag(start_dtm) over {TW}, start_dtm) as days, lag(continent) over {TW} as c1, lag(country) over {TW} as c2, lag(surface) over {TW} as c3, lag(indoor) over {TW} as c4 from pt) z""")
def rest_travel(spark, sf_dir):
    w = Window.partitionBy("player_code").orderBy("starts", "tournament_id")
    z = player_tournaments(spark, sf_dir).withColumn("days", F.datediff("starts", F.lag("starts").over(w)).cast("long"))
    change = {c: fx.changed(F.col(c), F.lag(c).over(w)) for c in ("continent", "country", "surface", "indoor")}
    return z.select("player_code", "tournament_id", "days", *[c.alias(k) for k, c in fx.rest_flags(F.col("days")).items()], fx.fatigue(*change.values()).alias("fatigue"))


@query("p t", PT + f""" select player_code, tournament_id, lag(played) over {TW} as prev_played, lag(furthest) over {TW} as prev_furthest from pt""")
def prev_tour_load(spark, sf_dir):
    w = Window.partitionBy("player_code").orderBy("starts", "tournament_id")
    return player_tournaments(spark, sf_dir).select("player_code", "tournament_id", F.lag("played").over(w).alias("prev_played"), F.lag("furthest").over(w).alias("prev_furthest"))


def timed(p):
    day = F.datediff("start_dtm", F.lit("1970-01-01")).cast("long")
    return p.withColumns({"day": day, "hour_order": day * 24 + F.col("rnd")})


DAYS3 = """, e as (select p.*, won_points, all_points, date_diff('day', date '1970-01-01', start_dtm) as day, date_diff('day', date '1970-01-01', start_dtm) * 24 + rnd as hour_order from p left join st on st.id = p.id)"""
PAST = "from e h where h.player_code = e.player_code and h.day >= e.day - 1095 and h.hour_order < e.hour_order and h.match_ret is null"


@query("p st", DAYS3 + f""" select id, player_code, (select count(*) {PAST} and h.match_result = 'win') as wins_3y, (select count(*) {PAST} and h.match_result = 'loss') as losses_3y,
  (select case when sum(h.all_points) > 0 then cast(floor(1000 * sum(h.won_points) / cast(sum(h.all_points) as double)) as bigint) end {PAST}) as won_share_3y from e""")
def stats_3y(spark, sf_dir):
    p = timed(base(spark, sf_dir).join(tables.stats(spark, sf_dir).select("id", "won_points", "all_points"), "id", "left"))
    done = F.col("match_ret").isNull()
    count = lambda r: F.when(done & (F.col("match_result") == r), 1).otherwise(0)
    sums = {"wins_3y": count("win"), "losses_3y": count("loss"), "won": F.when(done, F.col("won_points")), "known": (done & F.col("won_points").isNotNull()).cast("int"), "points": F.when(done, F.col("all_points"))}
    s = scans.range_sums(p, ["player_code"], "day", "hour_order", sums, {"": 1095})
    return s.select("id", "player_code", "wins_3y", "losses_3y", F.when((F.col("points") > 0) & (F.col("known") > 0), F.floor(F.lit(1000) * F.col("won") / F.col("points").cast("double"))).alias("won_share_3y"))


@query("m", """, e as (select *, date_diff('day', date '1970-01-01', start_dtm) as day, date_diff('day', date '1970-01-01', start_dtm) * 24 + rnd as hour_order from m)
  select id, (select count(*) from e h where h.winner = e.winner and h.loser = e.loser and h.day >= e.day - 1095 and h.hour_order < e.hour_order and h.match_ret is null) as winner_h2h_3y,
  (select count(*) from e h where h.winner = e.loser and h.loser = e.winner and h.day >= e.day - 1095 and h.hour_order < e.hour_order and h.match_ret is null) as loser_h2h_3y from e""")
def h2h_3y(spark, sf_dir):
    m = timed(pairs(tables.matches(spark, sf_dir)))
    done = F.col("match_ret").isNull()
    s = scans.range_sums(m, ["player_a", "player_b"], "day", "hour_order", {"a": F.when(done & (F.col("a_won") == 1), 1).otherwise(0), "b": F.when(done & (F.col("a_won") == 0), 1).otherwise(0)}, {"": 1095})
    won = F.col("a_won") == 1
    return s.select("id", F.when(won, F.col("a")).otherwise(F.col("b")).alias("winner_h2h_3y"), F.when(won, F.col("b")).otherwise(F.col("a")).alias("loser_h2h_3y"))


@query("p", """, e as (select p.*, date_diff('day', date '1970-01-01', start_dtm) as day, case when match_result = 'win' then rnd * 10 else 5 end as points from p)
  select id, player_code, (select coalesce(cast(sum(h.points) as bigint), 0) from e h where h.player_code = e.player_code and h.day >= e.day - 363 and h.day < e.day) as points_1y,
  (select coalesce(cast(sum(h.points) as bigint), 0) from e h where h.player_code = e.player_code and h.day >= e.day - 1095 and h.day < e.day) as points_3y,
  (select coalesce(cast(sum(h.points) as bigint), 0) from e h where h.player_code = e.player_code and h.surface = e.surface and h.day >= e.day - 363 and h.day < e.day) as surface_points_1y from e""")
def points_1y_3y(spark, sf_dir):
    p = timed(base(spark, sf_dir)).withColumn("points", F.when(F.col("match_result") == "win", F.col("rnd") * 10).otherwise(5))
    from epochal.plans.kpi_queries import points_before

    return points_before(p).select("id", "player_code", "points_1y", "points_3y", "surface_points_1y")
