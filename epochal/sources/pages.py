"""Saved pages as a source: titles, links, dates and ranking rows taken out of HTML by pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epochal.functions import dates, scores


def saved(spark: SparkSession, path: str) -> DataFrame:
    """path, html of each file under a folder."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("content").cast("string").alias("html"))


def held(df: DataFrame) -> DataFrame:
    """The same rows behind a generator: filters on their columns stay above it, so what makes these is worked out once."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_held")).select("_held.*")


def _after_first(parts: Column) -> Column:
    """What follows each mark at which a text was split."""
    return F.slice(parts, 2, F.size(parts))


def titles_and_links(pages: DataFrame) -> DataFrame:
    """page_id, title, links: text of the first title and the number of distinct link targets."""
    links = F.array_distinct(F.regexp_extract_all("html", F.lit(r'(?i)href="([^"]*)"'), F.lit(1)))
    return pages.select("page_id", F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"), F.size(links).alias("links"))


def date_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """The dates of option values, each once, latest first; mixed separators are taken."""
    text = F.regexp_extract(column, r'value="(\d{4}[.-]\d{2}[.-]\d{2})"', 1)
    day = dates.any_date(F.regexp_replace(text, r"\.", "-"))
    return lines.select(day.alias("day")).filter("day is not null").distinct().orderBy(F.desc("day"))


def ranking_rows(pages: DataFrame, day: str = "day") -> DataFrame:
    """snapshot_date, player_code, ranking of the table rows of ranking pages; the first row of a player counts."""
    rows = pages.select(day, F.posexplode(F.regexp_extract_all("html", F.lit(r'(?is)<tr class="lower-row">(.*?)</tr>'), F.lit(1))).alias("at", "row"))
    rows = rows.select(day, "at", F.regexp_extract("row", r"(?s)<td[^>]*>\s*(\d+)", 1).cast("int").alias("ranking"), F.upper(F.regexp_extract("row", r"/players/[^/]+/([^/]+)/", 1)).alias("player_code"))
    rows = rows.filter("ranking is not null and player_code <> ''")
    first = F.row_number().over(Window.partitionBy(day, "player_code").orderBy("at"))
    return rows.withColumn("_rn", first).filter("_rn = 1").select(F.col(day).alias("snapshot_date"), "player_code", "ranking")


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _one(text: Column, pattern: str) -> Column:
    """The first match, without white space around it; null for none."""
    return F.nullif(F.trim(F.regexp_extract(text, pattern, 1)), F.lit(""))


def archive(pages: DataFrame, year: str = "year") -> DataFrame:
    """tournament_id, name, slug, code, dates, overview_url, results_url, banner of archive pages.

    Titles, links and dates are three lists of a page, paired in order up to the shortest; a banner may be missing.
    """
    lists = pages.select(
        year,
        _all(F.col("html"), r'(?s)<div class="top">\s*<span class="name">(.*?)</span>').alias("names"),
        _all(F.col("html"), r'<a[^>]*class="[^"]*tournament__profile[^"]*"[^>]*href="([^"]*)"').alias("links"),
        _all(F.col("html"), r'(?s)<div class="bottom">.*?<span class="[^"]*Date[^"]*">(.*?)</span>').alias("days"),
        _all(F.col("html"), r'<img[^>]*class="[^"]*events_banner[^"]*"[^>]*src="([^"]*)"').alias("banners"),
    )
    n = F.least(F.size("names"), F.size("links"), F.size("days"))
    rows = lists.filter(n > 0).select(year, F.explode(F.slice(F.arrays_zip("names", "links", "days", "banners"), F.lit(1), n)).alias("x")).select(year, "x.*")
    path = F.split(F.trim("links", F.lit("/")), "/")
    rows = rows.withColumns({"slug": F.get(path, F.lit(2)), "code": F.get(path, F.lit(3))}).filter("slug is not null and code is not null")
    return rows.select(F.concat_ws("-", year, "code").alias("tournament_id"), F.trim("names").alias("name"), "slug", "code", F.trim("days").alias("dates"), F.col("links").alias("overview_url"), F.concat(F.lit("/en/scores/archive/"), "slug", F.lit("/"), "code", F.lit("/"), year, F.lit("/results")).alias("results_url"), F.col("banners").alias("banner"))


def overview(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of keep, draw, surface, prize, location texts of overview pages, by their place in the left and right lists."""
    item = lambda side: _all(F.regexp_extract("html", rf'(?s)<ul class="td_{side}">(.*?)</ul>', 1), r"(?s)<li>.*?<span>.*?</span>\s*<span>(.*?)</span>.*?</li>")
    left, right = F.transform(item("left"), lambda x: F.trim(x)), F.transform(item("right"), lambda x: F.trim(x))
    return pages.select(*keep, F.get(left, F.lit(1)).alias("draw"), F.get(left, F.lit(2)).alias("surface"), F.get(left, F.lit(3)).alias("prize"), F.get(right, F.lit(0)).alias("location"))


def profiles(pages: DataFrame) -> DataFrame:
    """player_code, slug, first_name, last_name, country, birthplace, birth_date, turned_pro, weight, height, handedness, backhand
    of profile pages (url, html): labels and values of the personal details make a map."""
    path = F.split(F.rtrim("url", F.lit("/")), "/")
    name = F.split(F.trim(F.regexp_extract("html", r'(?s)<div class="info">.*?<div class="name">\s*<span>(.*?)</span>', 1)), r"\s+")
    pairs = F.transform(_all(F.col("html"), r"(?s)<li>\s*(<span>.*?)</li>"), lambda li: F.struct(F.trim(F.regexp_extract(li, r"(?s)<span>(.*?)</span>", 1)).alias("k"), F.regexp_extract(li, r"(?s)</span>\s*<span>(.*)</span>", 1).alias("v")))
    rows = pages.select(path.alias("path"), name.alias("name"), F.map_from_entries(F.array_distinct(F.filter(pairs, lambda p: p["k"] != ""))).alias("of"))
    text = lambda k: F.trim(F.regexp_replace(F.col("of")[k], r"<[^>]*>", ""))
    plays = F.transform(F.split(text("Plays"), ","), lambda x: F.trim(x))
    return rows.select(
        F.element_at("path", -2).alias("player_code"),
        F.element_at("path", -3).alias("slug"),
        F.col("name")[0].alias("first_name"),
        F.array_join(F.slice("name", F.lit(2), F.greatest(F.size("name") - 1, F.lit(0))), " ").alias("last_name"),
        F.upper(_one(F.col("of")["Country"], r'href="[^"]*-([^"-]*)"')).alias("country"),
        text("Birthplace").alias("birthplace"),
        F.to_date(_one(text("Age"), r"\((\d{4}/\d{2}/\d{2})\)"), "yyyy/MM/dd").alias("birth_date"),
        text("Turned pro").try_cast("int").alias("turned_pro"),
        _one(text("Weight"), r"(?i)\((\d+)\s*kg\)").cast("int").alias("weight"),
        _one(text("Height"), r"(?i)\((\d+)\s*cm\)").cast("int").alias("height"),
        F.get(plays, F.lit(0)).alias("handedness"),
        F.get(plays, F.lit(1)).alias("backhand"),
    )


#: Words of draws that are left out.
OTHER_DRAWS = ("Wheelchair", "Champions Tour", "International Jr Event")


def read_results(pages: DataFrame, tournament: str = "tournament_id") -> DataFrame:
    """tournament_id, stage, winner_code, loser_code, winner_seed, loser_seed, score, note, stats_url, duration of result
    pages, and reason: null, or why a match doesn't count (other draw, not two players, no code, long code).

    A page is cut at its matches and a match at its two players; who has the winner's mark is the winner.
    """
    nodes = pages.select(tournament, F.explode(_after_first(F.split("html", r'<div class="match">'))).alias("m"))
    stage = F.trim(F.regexp_replace(F.split_part(F.regexp_extract("m", r"(?s)<strong>(.*?)</strong>", 1), F.lit("-"), F.lit(1)), r"Day [1-6]", ""))
    items = _after_first(F.split("m", r'<div class="stats-item">'))
    rows = nodes.select(tournament, stage.alias("stage"), items.alias("items"), _one(F.col("m"), r'(?s)<div class="match-notes">(.*?)</div>').alias("note"), _one(F.col("m"), r'<a class="stats"[^>]*href="([^"]*)"').alias("stats_url"), _one(F.col("m"), r"(\d{2}:\d{2}:\d{2})").alias("clock"))

    def side(x):
        sets = F.transform(_all(x, r'(?s)<div class="score-item">(.*?)</div>'), lambda s: F.transform(F.regexp_extract_all(s, F.lit(r"<span>(\d*)</span>"), F.lit(1)), lambda v: v))
        return F.struct(F.upper(_one(x, r"/players/[^/]+/([^/]+)/")).alias("code"), _one(x, r'(?s)<div class="name">(?:(?!</div>).)*?<span>\(?([^)<]*)\)?</span>').alias("seed"), x.contains('<div class="winner">').alias("won"), sets.alias("sets"))

    rows = rows.select("*", side(F.get("items", F.lit(0))).alias("a"), side(F.get("items", F.lit(1))).alias("b"))
    rows = rows.select("*", F.when(F.col("a.won"), F.col("a")).otherwise(F.col("b")).alias("w"), F.when(F.col("a.won"), F.col("b")).otherwise(F.col("a")).alias("l"))
    games = lambda s: F.transform(s, lambda x: F.get(x, F.lit(0)).try_cast("int"))
    ties = F.zip_with("a.sets", "b.sets", lambda x, y: F.coalesce(F.get(y, F.lit(1)).try_cast("int"), F.get(x, F.lit(1)).try_cast("int")))
    seconds = F.split("clock", ":")
    minutes = seconds[0].cast("int") * 60 + seconds[1].cast("int")
    reason = F.when(F.col("stage").rlike("|".join(OTHER_DRAWS)), "other draw").when(F.size("items") != 2, "not two players")
    reason = reason.when(F.col("w.code").isNull() | F.col("l.code").isNull(), "no code").when(F.length("w.code") > 4, "long code")
    out = rows.select(tournament, "stage", F.col("w.code").alias("winner_code"), F.col("l.code").alias("loser_code"), F.col("w.seed").alias("winner_seed"), F.col("l.seed").alias("loser_seed"), scores.composed(games(F.col("w.sets")), games(F.col("l.sets")), ties).alias("score"), "note", "stats_url", minutes.alias("duration"), reason.alias("reason"))
    return held(out)


def results(pages: DataFrame, tournament: str = "tournament_id") -> DataFrame:
    """The matches of result pages that count, without reason."""
    return read_results(pages, tournament).filter("reason is null").drop("reason")


def rejected_results(pages: DataFrame, tournament: str = "tournament_id") -> DataFrame:
    """tournament_id, reason, n: the matches of result pages that don't count."""
    return read_results(pages, tournament).filter("reason is not null").groupBy(tournament, "reason").agg(F.count("*").alias("n"))


#: The places of figures in the list of a statistics page; a pair gives a value and its total.
PAIRS = {3: ("first_serves_in", "first_serves_total"), 4: ("first_serve_points_won", "first_serve_points_total"), 5: ("second_serve_points_won", "second_serve_points_total"), 6: ("break_points_saved", "break_points_serve_total"),
         10: ("service_points_won", "service_points_total"), 7: ("first_serve_return_won", "first_serve_return_total"), 8: ("second_serve_return_won", "second_serve_return_total"), 9: ("break_points_converted", "break_points_return_total"),
         13: ("return_points_won", "return_points_total"), 14: ("total_points_won", "total_points_total")}
SINGLE = {1: "aces", 2: "double_faults", 11: "service_games_played", 12: "return_games_played"}


def statistics(pages: DataFrame, key: str = "stats_url") -> DataFrame:
    """key, and w_<figure> and l_<figure> of statistics pages, by place in the lists of both sides; pages whose winner is not told apart are left out."""
    shown = F.slice(F.split("html", r'<div class="stats-item">'), 2, 2)
    won = F.transform(shown, lambda x: x.contains("winner"))
    digits = lambda v, mark, pattern: F.when(v.contains(mark), F.regexp_extract(v, pattern, 1).try_cast("int"))
    value = lambda v: F.struct(F.coalesce(digits(v, "(", r"\((\d+)\s*/"), F.trim(F.replace(v, F.lit("%"), F.lit(""))).try_cast("int")).alias("x"), digits(v, "/", r"/\s*(\d+)\)").alias("y"))
    side = lambda c: F.transform(_all(F.col("html"), rf'(?s)<div class="{c}-stats-item">\s*<div class="value">(.*?)</div>'), value)
    rows = held(held(pages.select(key, "html")).select(key, won.alias("won"), side("player").alias("a"), side("opponent").alias("b")))
    rows = rows.filter((F.size("won") == 2) & (F.col("won")[0] != F.col("won")[1]) & (F.size("a") > 0) & (F.size("b") > 0))
    rows = rows.select(key, F.when(F.col("won")[0], F.col("a")).otherwise(F.col("b")).alias("w"), F.when(F.col("won")[0], F.col("b")).otherwise(F.col("a")).alias("l"))
    at = lambda s, i, f: F.get(s, F.lit(i))[f]
    figures = {name: (i, "x") for i, name in SINGLE.items()} | {n: (i, f) for i, pair in PAIRS.items() for n, f in zip(pair, ("x", "y"), strict=True)}
    return rows.select(key, *[at(s, i, f).alias(f"{s}_{n}") for s in ("w", "l") for n, (i, f) in figures.items()])
