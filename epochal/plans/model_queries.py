"""Statistics and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from epochal import session
from epochal.functions import features as fx
from epochal.operators import ml, stats
from epochal.plans.registry import query
from epochal.plans.temporal_queries import KPI, ORDER, W1, kpis
from epochal.operators import temporal as tp
from epochal.sources import tables

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def pair_sql(source, columns=tuple(NUMBERS)):
    return " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 5) as r, count(*) filter ({a} is not null and {b} is not null) as n from {source}" for i, a in enumerate(columns) for b in columns[i + 1 :])


@query("", pair_sql("{lineitem}"))
def corr_pearson(spark, sf_dir):
    return stats.correlations(tables.table(spark, sf_dir, "lineitem"), NUMBERS).withColumn("r", F.round("r", 5))


RANKED = "(select " + ", ".join(f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0 as {c}" for c in NUMBERS) + " from {lineitem})"


@query("", pair_sql(RANKED + " z"))
def corr_spearman(spark, sf_dir):
    ranks = stats.average_ranks(tables.table(spark, sf_dir, "lineitem").select(*NUMBERS), NUMBERS)
    return stats.correlations(ranks, NUMBERS).withColumn("r", F.round("r", 5))


CLOSE = ["won_points", "all_points", "lost_points", "sets_played", "aces"]
CLOSE_RANKED = "(select " + ", ".join(f"case when {c} is not null then rank() over (order by {c} nulls last) + (count(*) over (partition by {c}) - 1) / 2.0 end as {c}" for c in CLOSE) + " from st)"


@query("st", f"select x.a, x.b from ({pair_sql('st', CLOSE)}) x join ({pair_sql(CLOSE_RANKED + ' z', CLOSE)}) y on y.a = x.a and y.b = x.b where abs(x.r) > 0.7 and abs(y.r) > 0.7 and abs(x.r) * sqrt((x.n - 2) / (1 - x.r * x.r)) > 2")
def corr_high(spark, sf_dir):
    """Pairs that are close by both measures and not by chance; the p-values of a few dozen pairs are made on the driver."""
    rows = tables.stats(spark, sf_dir).select(*CLOSE)
    pearson = stats.correlations(rows, CLOSE)
    spearman = stats.correlations(stats.average_ranks(rows, CLOSE), CLOSE).select("a", "b", F.col("r").alias("rho"))
    high = [(x.a, x.b) for x in pearson.join(spearman, ["a", "b"]).collect() if x.r is not None and abs(x.r) > 0.7 and (stats.p_value(x.r, x.n) or 0) < 0.05 and abs(x.rho) > 0.7]  # a row a pair of columns
    return spark.createDataFrame(high, "a string, b string")


@query("m", "select id, case when x <= -0.2 then 'negative' when x <= 0.2 then 'neutral' else 'positive' end as sign from (select id, (winner - loser) / 100.0::double as x from m) z")
def discretise(spark, sf_dir):
    return tables.matches(spark, sf_dir).select("id", fx.cut_sign((F.col("winner") - F.col("loser")) / F.lit(100.0)).alias("sign"))


Z = f"(select id, player_code, row_number() over (partition by player_code order by start_dtm, tournament_id, rnd, id) - 1 as n, case when count(kpi) over {W1} >= 5 then avg(kpi) over {W1} end as kpi_share, case when count(aces) over {W1} >= 5 then avg(aces) over {W1} end as aces_mean from {KPI})"


def exposed(spark, sf_dir):
    from pyspark.sql.window import Window

    w = tp.before(["player_code"], ORDER)
    n = F.row_number().over(Window.partitionBy("player_code").orderBy(*ORDER)) - 1
    return kpis(spark, sf_dir).select("id", "player_code", n.alias("n"), tp.exposed_mean(F.col("kpi"), w, 5).alias("kpi_share"), tp.exposed_mean(F.col("aces"), w, 5).alias("aces_mean"))


@query("p st", f""", z as {Z}, g as (select avg(kpi_share) as k, avg(aces_mean) as a from z)
  select id, player_code, round(least(0.999999, greatest(0.000001, coalesce(n / (n + 20.0) * kpi_share + (1 - n / (n + 20.0)) * k, k))), 5) as kpi_share, round(coalesce(n / (n + 10.0) * aces_mean + (1 - n / (n + 10.0)) * a, a), 5) as aces_mean from z, g""")
def shrinkage(spark, sf_dir):
    s = stats.shrink(exposed(spark, sf_dir), ["kpi_share", "aces_mean"], "n")
    return s.select("id", "player_code", F.round("kpi_share", 5).alias("kpi_share"), F.round("aces_mean", 5).alias("aces_mean"))


@query("p st", f"select id, player_code, cast(kpi_share is null as int) as kpi_share_was_na, cast(aces_mean is null as int) as aces_mean_was_na from {Z} z")
def was_na_flags(spark, sf_dir):
    return stats.shrink(exposed(spark, sf_dir), ["kpi_share", "aces_mean"], "n").select("id", "player_code", "kpi_share_was_na", "aces_mean_was_na")


@query("m st", "select surface, rnd, count(all_points) as n, round(avg(all_points), 6) as mean, round(stddev_samp(all_points), 5) as sd from m left join st on st.id = m.id group by 1, 2")
def duration_cell_stats(spark, sf_dir):
    m = tables.matches(spark, sf_dir).join(tables.stats(spark, sf_dir), "id", "left")
    return m.groupBy("surface", "rnd").agg(F.count("all_points").alias("n"), F.round(F.avg("all_points"), 6).alias("mean"), F.round(F.stddev_samp("all_points"), 5).alias("sd"))


UNIFORM = "(cast(('0x' || substr(md5(cast(m.id as varchar) || '|1|{k}'), 1, 8)) as bigint) + 0.5::double) / 4294967296"


@query("m st", """, d as (select m.id, m.surface, m.rnd, all_points from m left join st on st.id = m.id), c as (select surface, rnd, avg(all_points) as mean, stddev_samp(all_points) as sd from d group by 1, 2)
  select m.id, cast(m.all_points is null as int) as imputed, round(coalesce(cast(m.all_points as double), least(500.0, greatest(1.0, mean + sqrt(-2 * ln(""" + UNIFORM.format(k=1) + ")) * cos(2 * pi() * " + UNIFORM.format(k=2) + """) * sd))), 5) as minutes
  from d m left join c on c.surface is not distinct from m.surface and c.rnd = m.rnd""")
def duration_imputed(spark, sf_dir):
    """Missing durations drawn from the mean and deviation of their cell; the draw depends on the id only."""
    m = tables.matches(spark, sf_dir).join(tables.stats(spark, sf_dir).select("id", "all_points"), "id", "left")
    cells = m.groupBy("surface", "rnd").agg(F.avg("all_points").alias("mean"), F.stddev_samp("all_points").alias("sd")).withColumnsRenamed({"surface": "s", "rnd": "r"})
    m = m.join(cells, m["surface"].eqNullSafe(cells["s"]) & (m["rnd"] == cells["r"]), "left")
    value = F.coalesce(F.col("all_points").cast("double"), stats.drawn(F.col("id"), F.col("mean"), F.col("sd"), 1.0, 500.0))
    return m.select("id", F.col("all_points").isNull().cast("int").alias("imputed"), F.round(value, 5).alias("minutes"))


def scored(spark, sf_dir):
    """A score with ties and a 0/1 label for each match side."""
    p = tables.matches(spark, sf_dir)
    return p.select(((F.col("winner") * 37 + F.col("id") % 41 * 5) % 97 / F.lit(97.0)).alias("score"), ((F.col("winner") * 37 + F.col("id") % 41 * 5) % 97 > F.col("loser") * 13 % 97).cast("int").alias("label"))


S = "(select ((winner * 37 + id % 41 * 5) % 97) / 97.0::double as score, cast((winner * 37 + id % 41 * 5) % 97 > loser * 13 % 97 as int) as label from m)"


@query("m", f"""select min_by(threshold, (cost, threshold)) as threshold, cast(min(cost) as double) as cost from (
  select s.score as threshold, count(*) filter (t.score >= s.score and t.label = 0) + count(*) filter (t.score < s.score and t.label = 1) as cost from (select distinct score from {S} a) s, {S} t group by 1
  union all select 1 + 1e-12, sum(label) from {S} b) z""")
def threshold_search(spark, sf_dir):
    return stats.best_threshold(scored(spark, sf_dir), "score", "label")


@query("m", f"select round(sum(case when a.score > b.score then 1.0 when a.score = b.score then 0.5 else 0.0 end * a.n * b.n) / sum(a.n * b.n), 6)::double as auc from (select score, count(*) as n from {S} x where label = 1 group by 1) a, (select score, count(*) as n from {S} y where label = 0 group by 1) b")
def auc_rank_sum(spark, sf_dir):
    return stats.auc(scored(spark, sf_dir), "score", "label").select(F.round("auc", 6).alias("auc"))


@query("m", f"""select round(avg((score - label) * (score - label)), 6) as brier, round(avg(-(label * ln(least(1 - 1e-6, greatest(1e-6, score))) + (1 - label) * ln(1 - least(1 - 1e-6, greatest(1e-6, score))))), 6) as log_loss,
  round(avg(cast(cast(score >= 0.5 as int) = label as int)), 6) as accuracy from {S} z""")
def brier_logloss(spark, sf_dir):
    out = stats.losses(scored(spark, sf_dir), "score", "label")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("m st", "select 'surface' as \"column\", round(avg(cast(surface is null as int)), 6) as null_share from m union all select 'match_ret', round(avg(cast(match_ret is null as int)), 6) from m union all select 'won_points', round(avg(cast(won_points is null as int)), 6) from m left join st on st.id = m.id")
def na_profile(spark, sf_dir):
    m = tables.matches(spark, sf_dir).join(tables.stats(spark, sf_dir), "id", "left")
    return stats.null_profile(m, ["surface", "match_ret", "won_points"]).withColumn("null_share", F.round("null_share", 6))


@query("m st", "select cast(substr(tournament_id, 1, 4) as int) as year, round(avg((cast(surface is null as int) + cast(match_ret is null as int) + cast(won_points is null as int)) / 3.0::double), 6) as null_share from m left join st on st.id = m.id group by 1")
def na_by_year(spark, sf_dir):
    m = tables.matches(spark, sf_dir).join(tables.stats(spark, sf_dir), "id", "left")
    share = sum((F.col(c).isNull().cast("int") for c in ("surface", "match_ret", "won_points")), F.lit(0)) / F.lit(3.0)
    return m.groupBy(fx.leading_year(F.col("tournament_id")).alias("year")).agg(F.round(F.avg(share), 6).alias("null_share"))


@query("m", "select l.surface, count(m.id) as n, round(count(m.id) / cast(sum(count(m.id)) over () as double), 6) as share from (values ('Clay'), ('Grass'), ('Hard'), ('Carpet'), ('Ice')) l(surface) left join m on m.surface = l.surface group by 1")
def freq_table(spark, sf_dir):
    return stats.frequencies(tables.matches(spark, sf_dir), "surface", ["Clay", "Grass", "Hard", "Carpet", "Ice"]).withColumn("share", F.round("share", 6))


@query("m", "select cast(substr(tournament_id, 1, 4) as int) as year, count(*) as n, cast(count(distinct winner) as bigint) as winners, min(rnd) as low, cast(quantile_cont(id, 0.5) as double) as middle, max(rnd) as high from m group by 1")
def year_summary(spark, sf_dir):
    m = tables.matches(spark, sf_dir).groupBy(fx.leading_year(F.col("tournament_id")).alias("year"))
    return m.agg(F.count("*").alias("n"), F.countDistinct("winner").alias("winners"), F.min("rnd").alias("low"), F.percentile("id", 0.5).alias("middle"), F.max("rnd").alias("high"))


@query("m", "select surface, id, round(won / avg(won) over (partition by surface), 6) as effect from (select surface, id, 1.0::double + id % 7 as won from m) z")
def surface_effect(spark, sf_dir):
    from pyspark.sql.window import Window

    won = (F.lit(1.0) + F.col("id") % 7).alias("won")
    return tables.matches(spark, sf_dir).select("surface", "id", won).select("surface", "id", F.round(F.col("won") / F.avg("won").over(Window.partitionBy("surface")), 6).alias("effect"))


@query()
def gbt_calibrated(spark, sf_dir):
    """Metrics by held-out year of boosted trees, calibrated by isotonic regression."""
    return ml.yearly_metrics(ml.example_panel(spark, sf_dir))


@query()
def gbt_holdout(spark, sf_dir):
    """Trees fitted on the first years, stopped by the next, calibrated out of fold, and measured on the last two by year and tier."""
    from epochal.plans.upkeep_queries import TIERS

    panel = session.stored(ml.example_panel(spark, sf_dir))
    last = panel.agg(F.max("year")).first()[0]
    held = ml.held_out_forward(panel, ml.NUMBERS, ml.LABELS, "year", last - 2)
    t = tables.tournaments(spark, sf_dir).select("tournament_id", "category")
    held = session.pinned(held.join(t, "tournament_id").withColumn("hit", F.col("target").cast("int")))
    kinds = [stats.by_tier(held, "category", TIERS, ["year"], score=c).withColumn("score", F.lit(c)) for c in ("prob", "calibrated")]
    return kinds[0].unionByName(kinds[1]).select("score", "tier", "year", "n", F.round("brier", 6).alias("brier"), F.round("accuracy", 6).alias("accuracy"))


@query("p", "select cast(substr(tournament_id, 1, 4) as int) as fold, count(*) as held_out, (select count(*) from p) - count(*) as rest, cast(count(distinct id) as bigint) as ids from p group by 1")
def yearly_folds(spark, sf_dir):
    from epochal.operators import panel

    return ml.fold_sizes(panel.unpivot(tables.matches(spark, sf_dir)).withColumn("fold", fx.leading_year(F.col("tournament_id"))), "fold", "id")
