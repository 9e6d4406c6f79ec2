"""Scores, dates and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from epochal.functions import dates, scores
from epochal.plans.registry import query
from epochal.sources import pages, tables

#: Score texts by id of the match, with what they parse to.
SCORES = ("64 36 76", "64 76(5)", "2218", "108 63", "63 810", "64 21 RET", "W/O", "WEA", "63 64 DEF", "64 36 [10-8]", "911 64 64", "63 36 64 67(3) 75")
TEXT = "case id % 12 " + " ".join(f"when {i} then '{s}'" for i, s in enumerate(SCORES)) + " end"


def scored(spark, sf_dir):
    return tables.matches(spark, sf_dir).select("id", "tournament_id", F.expr(TEXT).alias("score"))


@query("m", f"select id, score, case when score in ('W/O') then '(W/O)' when score = 'WEA' then '(WEA)' when score like '%RET%' or score like '%DEF%' then '(RET)' end as status from (select id, {TEXT} as score from m) z")
def score_status(spark, sf_dir):
    return scored(spark, sf_dir).select("id", "score", scores.status(F.col("score")).alias("status"))


#: What SCORES parse to: sets, games and tie-breaks of both sides; worked out by hand.
PARSED = ((2, 1, 16, 16, 1, 0), (2, 0, 13, 10, 1, 0), (1, 0, 22, 18, 0, 0), (2, 0, 16, 11, 0, 0), (1, 1, 14, 13, 0, 0), None, None, None, None, (2, 1, 10, 10, 1, 0), (2, 1, 21, 19, 0, 0), (3, 2, 28, 25, 0, 1))
NAMES = ("sets_won", "sets_lost", "games_won", "games_lost", "ties_won", "ties_lost")


@query("m", "select id, " + ", ".join("case id % 12 " + " ".join(f"when {i} then {p[k]}" for i, p in enumerate(PARSED) if p) + f" end as {n}" for k, n in enumerate(NAMES)) + " from m")
def score_parse(spark, sf_dir):
    return scored(spark, sf_dir).select("id", scores.parsed(F.col("score")).alias("p")).select("id", *[F.col(f"p.{n}") for n in NAMES])


@query("m", f"""select id, case when score like '%RET%' or score like '%DEF%' or score in ('W/O', 'WEA') then 0 else cast(len(string_split(score, ' ')) as int) end as n_sets,
  first_value(best) over (partition by tournament_id order by id) as best_of from (select id, tournament_id, {TEXT} as score, case when id % 12 = 11 then 5 else 3 end as best from m) z""")
def best_of(spark, sf_dir):
    from pyspark.sql.window import Window

    s = scored(spark, sf_dir).withColumn("best", scores.best_of(F.coalesce(scores.parsed(F.col("score"))["sets_won"], F.lit(0)), F.lit("")))
    return s.select("id", scores.n_sets(F.col("score")).alias("n_sets"), F.first("best").over(Window.partitionBy("tournament_id").orderBy("id")).alias("best_of"))


@query("m", "select id, cast(id % 8 as varchar) || cast(id % 5 as varchar) || ' 7' || '6(' || cast(id % 9 as varchar) || ')' as score from m")
def score_compose(spark, sf_dir):
    m = tables.matches(spark, sf_dir)
    return m.select("id", scores.composed(F.array(F.col("id") % 8, F.lit(7)), F.array(F.col("id") % 5, F.lit(6)), F.array(F.lit(None).cast("bigint"), F.col("id") % 9)).alias("score"))


@query("m", "select id, cast(start_dtm as varchar) as day, cast(start_dtm as varchar) as dotted, cast(start_dtm + 6 as varchar) as ends, cast(id % 5 * 60 + id % 60 as int) as minutes from m")
def date_forms(spark, sf_dir):
    """Dates of the panel written in several forms and read back."""
    m = tables.matches(spark, sf_dir)
    form = F.when(F.col("id") % 3 == 0, F.date_format("start_dtm", "dd.MM.yyyy")).when(F.col("id") % 3 == 1, F.date_format("start_dtm", "yyyyMMdd")).otherwise(F.date_format("start_dtm", "yyyy-MM-dd"))
    between = F.concat(F.date_format("start_dtm", "d MMMM, yyyy"), F.lit(" - "), F.date_format(F.date_add("start_dtm", 6), "d MMMM, yyyy"))
    clock = F.concat((F.col("id") % 5).cast("string"), F.lit(":"), (F.col("id") % 60).cast("string"))
    return m.select("id", dates.any_date(form).cast("string").alias("day"), dates.dotted_birth(F.date_format("start_dtm", "yyyy/MM/dd")).cast("string").alias("dotted"), dates.range_dates(between)["ends"].cast("string").alias("ends"), dates.minutes(clock).alias("minutes"))


@query("", "select page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) as title, cast(len(list_distinct(regexp_extract_all(html, '(?i)href=\"([^\"]*)\"', 1))) as int) as links from {pages}")
def html_title_links(spark, sf_dir):
    return pages.titles_and_links(tables.table(spark, sf_dir, "pages"))


@query("m", "select distinct cast(start_dtm as varchar) as day from m")
def date_list(spark, sf_dir):
    m = tables.matches(spark, sf_dir)
    mixed = F.when(F.col("id") % 2 == 0, F.date_format("start_dtm", "yyyy.MM.dd")).otherwise(F.date_format("start_dtm", "yyyy-MM-dd"))
    lines = m.select(F.concat(F.lit('<option value="'), mixed, F.lit('">')).alias("value"))
    return pages.date_list(lines).select(F.col("day").cast("string").alias("day"))


@query("rk", "select cast(snapshot_date as varchar) as snapshot_date, 'P' || cast(player_code as varchar) as player_code, ranking from rk")
def ranking_pages(spark, sf_dir):
    """Ranking pages built from the snapshots, with a repeated row, and read back."""
    row = F.concat(F.lit('<tr class="lower-row"><td class="r">'), F.col("ranking").cast("string"), F.lit('</td><td><a href="/players/x/p'), F.col("player_code").cast("string"), F.lit('/overview"></a></td></tr>'))
    again = F.when(F.col("ranking") == 1, F.concat(row, F.regexp_replace(row, ">1<", ">9<"))).otherwise(row)
    html = tables.rankings(spark, sf_dir).groupBy(F.col("snapshot_date").alias("day")).agg(F.array_join(F.collect_list(again), "").alias("html"))
    return pages.ranking_rows(html).withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
