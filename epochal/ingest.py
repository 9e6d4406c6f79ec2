"""A run from saved pages to tables and features, each stage reading what the ones before have written.

Saved pages are rows (kind, year, url, html), in Parquet parted by kind and year, so that a stage for one year
scans that year's pages only; kinds are archive, overview, profile, results and statistics, and profiles have no
year. Tables are Stores under one folder: merges write the years or buckets that they touch, and a run repeated over
the same pages changes nothing.

tournaments: archive pages give the tournaments, overview pages of their links the rest; one row a tournament counts.
players: profile pages, one row a player.
matches: result pages of tournaments that the table has; matches that don't count are appended to rejected with
  their reason. A match read again keeps the longer score, and its link and duration where the new read lacks them.
stats: statistics pages of matches that have no statistics yet; matches once filled are not read again.
features: lagged means, form and counts of each side of all matches, of the year given and all later ones anew, since
  these depend on it.

Null or empty pages give no rows; pages of unknown tournaments or matches are left out; without pages a
stage leaves its table as it was, and the features of a year without matches are empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epochal import session
from epochal.functions import dates, scores
from epochal.functions import features as fx
from epochal.operators import merge, panel, scans, store
from epochal.plans import kpi_queries as kpi
from epochal.plans import temporal_queries as tq
from epochal.sources import pages

PAGES = "kind string, year int, url string, html string"
#: Tables: their keys, and the column or number of buckets that they are parted by.
TABLES = {"tournaments": (["tournament_id", "year"], "year"), "players": (["player_code"], 64), "matches": (["id", "year"], "year"), "stats": (["id", "year"], "year"), "features": (["id", "player_code", "year"], "year")}
#: Series that a later read doesn't change.
FIXED_SERIES = ("gs", "atpFinal", "laverCup")


class Run:
    """The tables of a folder and the saved pages that feed them."""

    def __init__(self, spark: SparkSession, saved: str, folder: str):
        self.spark, self.saved, self.folder = spark, saved, folder.rstrip("/")
        self.tables = {name: store.Store(spark, f"{self.folder}/{name}", keys, by) for name, (keys, by) in TABLES.items()}

    def pages(self, kind: str, year: int | None = None) -> DataFrame:
        rows = self.spark.read.schema(PAGES).parquet(self.saved).filter(F.col("kind") == kind)
        return rows if year is None else rows.filter(F.col("year") == year)

    def rows(self, name: str, year: int | None = None) -> DataFrame:
        """A table's rows, or those of a year, of which no other file is read."""
        parts = None if year is None else [str(year)]
        return self.tables[name].read(parts=parts)

    def put(self, name: str, rows: DataFrame, policy: dict | None = None) -> dict:
        """Merges rows into a table, which the first rows create; counts of what happened to them."""
        table, rows = self.tables[name], session.pinned(rows)
        if not table.versions():
            table.create(rows.limit(0))
        return table.merge(rows, policy)

    def has(self, name: str) -> bool:
        return bool(self.tables[name].versions())


def tournaments(run: Run, year: int | None = None) -> dict:
    listed = pages.archive(run.pages("archive", year).withColumn("year", F.col("year").cast("string"))).withColumn("year", fx.leading_year(F.col("tournament_id")))
    seen = pages.overview(run.pages("overview", year), ["year", F.col("url").alias("overview_url")])
    rows = listed.join(merge.first_rows(seen, ["year", "overview_url"], ["draw", "surface", "prize", "location"]), ["year", "overview_url"], "left")
    days, draw, money, place = dates.range_dates(F.col("dates")), fx.split_draw(F.col("draw")), fx.prize(F.col("prize")), fx.location(F.col("location"))
    rows = rows.select(
        "tournament_id", "year", "name", "slug", "code", "overview_url", "results_url", days["starts"].alias("start_dtm"), days["ends"].alias("end_dtm"), draw["singles"].alias("singles"), draw["doubles"].alias("doubles"),
        fx.court(F.col("surface")).alias("surface"), money["money"].alias("money"), money["currency"].alias("currency"), F.nullif(place["city"], F.lit("")).alias("city"), F.nullif(place["country"], F.lit("")).alias("country"),
        fx.series_of(F.lit("atp"), F.col("banner"), money["money"]).alias("series"),
    )
    known = F.when(F.col("old.series").isin(*FIXED_SERIES), F.col("old.series")).otherwise(F.coalesce("new.series", "old.series"))
    return run.put("tournaments", merge.first_rows(rows, ["tournament_id"], [F.col("start_dtm").asc_nulls_last(), "name", "results_url"]), {"series": known})


def players(run: Run, year: int | None = None) -> dict:
    rows = pages.profiles(run.pages("profile")).filter("player_code is not null")
    return run.put("players", merge.first_rows(rows.withColumn("player_code", F.upper("player_code")), ["player_code"], [F.col("birth_date").asc_nulls_last(), "slug"]))


def matches(run: Run, year: int | None = None) -> dict:
    known = run.rows("tournaments", year).select("tournament_id", "year", F.col("results_url").alias("url"), "start_dtm", "surface")
    read = session.pinned(pages.read_results(run.pages("results", year).join(known.select("url", "year", "tournament_id"), ["url", "year"])))
    lost = read.filter("reason is not null").groupBy("tournament_id", "reason").agg(F.count("*").alias("n"))
    lost.write.mode("append").parquet(f"{run.folder}/rejected")
    mark = F.coalesce(scores.status(F.col("score")), scores.status(F.col("note")))
    rows = read.filter("reason is null").join(known.drop("url"), "tournament_id").withColumn("stage", fx.recoded(F.col("stage"), fx.ROUNDS))
    rows = rows.withColumns({"id": F.concat_ws("-", "tournament_id", "winner_code", "loser_code", "stage"), "match_ret": mark, "rnd": fx.place(F.col("stage"), fx.FULL_LADDER)})
    columns = ["id", "year", "tournament_id", "start_dtm", "surface", "stage", "rnd", "winner_code", "loser_code", "winner_seed", "loser_seed", "score", "match_ret", "stats_url", "duration"]
    rows = merge.first_rows(rows.select(*columns), ["id"], [F.desc(F.length("score")), F.col("stats_url").asc_nulls_last(), F.col("duration").asc_nulls_last()])
    return run.put("matches", rows, {"score": merge.longer("score")})


def missing_stats(run: Run, year: int | None = None) -> DataFrame:
    """id, year, stats_url of played matches without statistics."""
    todo = run.rows("matches", year).filter("stats_url is not null and coalesce(match_ret, '') <> '(W/O)'").select("id", "year", "stats_url")
    return todo.join(run.rows("stats", year).select("id", "year"), ["id", "year"], "left_anti") if run.has("stats") else todo


def stats(run: Run, year: int | None = None) -> dict:
    asked = missing_stats(run, year)
    shown = run.pages("statistics", year).join(asked.select(F.col("stats_url").alias("url"), "year").distinct(), ["url", "year"], "left_semi")
    read = pages.statistics(shown.withColumn("stats_url", F.struct("url", "year"))).select("stats_url.*", "*").drop("stats_url")
    read = merge.first_rows(read, ["url", "year"], [F.col(f"w_{c}") for c in pages.SINGLE.values()])
    rows = asked.join(read.withColumnRenamed("url", "stats_url"), ["stats_url", "year"]).drop("stats_url")
    return run.put("stats", rows)


def sided(run: Run) -> DataFrame:
    """The panel of all matches with the figures of both sides, of statistics and of the score."""
    m = run.rows("matches").withColumn("_s", scores.parsed(F.col("score"), fx.code_of(F.col("tournament_id"))))
    of_score = {f"{s}_{n}": F.col(f"_s.{n}_{f}") for n in ("games", "sets") for s, f in (("w", "won"), ("l", "lost"))} | {"w_tiebreaks": F.col("_s.ties_won"), "l_tiebreaks": F.col("_s.ties_lost")}
    m = m.withColumns(of_score).drop("_s")
    m = m.join(run.rows("stats"), ["id", "year"], "left") if run.has("stats") else m.withColumns({f"{s}_{n}": F.lit(None).cast("int") for s in "wl" for n in FIGURES})
    names = {n: (f"w_{n}", f"l_{n}") for n in FIGURES} | {f"{n}_won": (f"w_{n}", f"l_{n}") for n in ("games", "sets", "tiebreaks")}
    p = panel.unpivot(m, "winner_code", "loser_code", names)
    return p.withColumnsRenamed({f"player_{n}": n for n in names})


FIGURES = [*pages.SINGLE.values(), *[n for pair in pages.PAIRS.values() for n in pair]]


def features(run: Run, year: int | None = None) -> dict:
    sums = {"prior_matches": F.lit(1), "prior_wins": tq.won().cast("int")}
    p = scans.means(sided(run), ["player_code"], tq.month(), tq.ORDER, kpi.lagged_values(), sums)
    p = session.pinned(p.select("id", "year", "player_code", "opponent_code", "match_result", *tq.ORDER[:-1], *sums, *[n for n, *_ in kpi.LAGGED]))
    p = kpi.log_ratios(kpi.contrasts(tq.form_shares(p)))
    kept = ["form_5", "form_10", *sums, *[n for n, *_ in kpi.LAGGED], *[f"{n}_log_ratio" for n, *_ in kpi.LAGGED], *kpi.CONTRASTS]
    rows = p.select("id", "year", "player_code", "opponent_code", tq.won().cast("int").alias("target"), *kept)
    table = run.tables["features"]
    if not table.versions():
        table.create(rows.limit(0))
    years = {*run.tables["matches"].manifest(), *table.manifest()} - {"none"}
    anew = sorted(y for y in years if year is None or int(y) >= year)
    return table.replace(rows.filter(F.col("year").cast("string").isin(*anew)), anew)


STAGES: dict[str, Callable[[Run, int | None], dict]] = {"tournaments": tournaments, "players": players, "matches": matches, "stats": stats, "features": features}
