"""Saved pages of tournaments, players, matches and statistics: pages are made from the tables, and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from epochal.functions import features as fx
from epochal.plans.registry import query
from epochal.sources import pages, tables

T = "(select tournament_id, min(id) as i, cast(min(extract(year from start_dtm)) as int) as year from m group by 1)"
BANNER_NAMES = ("categorystamps_500", "categorystamps_1000", "categorystamps_nextgen", "categorystamps_250", "categorystamps_finals")
PLACES = ("Lyon, France", "Monaco", "Adelaide, SA, Australia", "")
MONEY = ("€2,345,000", "A$1.234.567", "$75,000", "$74,999", "")


def seen(spark, sf_dir):
    m = tables.matches(spark, sf_dir)
    return m.groupBy("tournament_id").agg(F.min("id").alias("i"), F.min(F.year("start_dtm")).cast("int").alias("year"))


def pick(values, at):
    return F.element_at(F.array(*map(F.lit, values)), (at % len(values) + 1).cast("int"))


def listed(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@query("m", f"select cast(year as varchar) || '-' || cast(i as varchar) as tournament_id, 'Open ' || cast(i as varchar) as name, 'open-' || cast(i as varchar) as slug, cast(i as varchar) as code, case {listed(BANNER_NAMES)}[1 + i % 5] when 'categorystamps_500' then 'atp500' when 'categorystamps_1000' then '1000' when 'categorystamps_nextgen' then 'nextGen' when 'categorystamps_finals' then 'atpFinal' else 'atp250' end as series from {T} z")
def archive_pages(spark, sf_dir):
    """One archive page a year, with the lists of its tournaments."""
    i = F.col("i").cast("string")
    block = F.concat(F.lit('<div class="event-badge_container"><img class="events_banner" src="/a/'), pick(BANNER_NAMES, F.col("i")), F.lit('.png"></div><a class="tournament__profile" href="/en/tournaments/open-'), i, F.lit("/"), i, F.lit('/overview"><div class="top"> <span class="name">Open '), i, F.lit('</span></div></a><div class="bottom"><span class="venue">x</span><span class="Date"> 1 - 7 May, '), F.col("year").cast("string"), F.lit(" </span></div>"))
    made = seen(spark, sf_dir).groupBy("year").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", block.alias("b")))), lambda x: x["b"]), "").alias("html"))
    a = pages.archive(made)
    return a.select("tournament_id", "name", "slug", "code", fx.series_of(F.lit("atp"), F.col("banner"), F.lit(None).cast("string")).alias("series"))


@query("m", f"""select tournament_id, case when i % 3 <> 0 then '32' end as singles, case when i % 3 = 1 then '16' end as doubles, case i % 5 when 0 then '2345000' when 1 then '1234567' when 2 then '75000' when 3 then '74999' end as money, case i % 5 when 0 then '€' when 1 then 'A$' when 2 then '$' when 3 then '$' end as currency,
  case i % 4 when 0 then 'Lyon' when 2 then 'Adelaide' else '' end as city, case i % 4 when 0 then 'France' when 1 then 'Monaco' when 2 then 'Australia' else '' end as country, case when i % 5 in (0, 1, 2) then 'ch100' else 'ch50' end as series from {T} z""")
def overview_pages(spark, sf_dir):
    i = F.col("i")
    draw = F.when(i % 3 == 0, "none").when(i % 3 == 1, " 32/16 ").otherwise("32/")
    li = lambda label, value: F.concat(F.lit(f"<li><span>{label}</span> <span>"), value, F.lit("</span></li>"))
    made = seen(spark, sf_dir).select("tournament_id", F.concat(F.lit('<div class="td_content"><ul class="td_left">'), li("City", F.lit("x")), li("Draw", draw), li("Surface", F.lit("Clay")), li("Prize", pick(MONEY, i)), F.lit('</ul><ul class="td_right">'), li("Location", pick(PLACES, i)), F.lit("</ul></div>")).alias("html"))
    o = pages.overview(made, ["tournament_id"])
    d, p, w = fx.split_draw(F.col("draw")), fx.prize(F.col("prize")), fx.location(F.col("location"))
    return o.select("tournament_id", d["singles"].alias("singles"), d["doubles"].alias("doubles"), p["money"].alias("money"), p["currency"].alias("currency"), w["city"].alias("city"), w["country"].alias("country"), fx.series_of(F.lit("ch"), F.lit(""), p["money"]).alias("series"))


@query("pl", """select 'P' || cast(player_code as varchar) as player_code, 'p-' || cast(player_code as varchar) as slug, 'Ann' as first_name, 'de ' || citizenship as last_name, upper(substr(citizenship, 1, 3)) as country, case when player_code % 3 = 0 then null else turned_pro end as turned_pro,
  cast(60 + player_code % 40 as int) as weight, cast(165 + player_code % 40 as int) as height, cast(date '1980-01-01' + cast(player_code as int) as varchar) as birth_date, 'Right-Handed' as handedness, case when player_code % 2 = 0 then 'Two-Handed Backhand' end as backhand from pl""")
def profile_pages(spark, sf_dir):
    c = F.col("player_code")
    li = lambda label, *value: F.concat(F.lit(f"<li> <span>{label}</span> <span>"), *value, F.lit("</span></li>"))
    born = F.date_format(F.date_add(F.to_date(F.lit("1980-01-01")), c.cast("int")), "yyyy/MM/dd")
    flag = F.concat(F.lit('<svg class="atp-flag"><use href="/x/flags.svg#flag-'), F.lower(F.substring("citizenship", 1, 3)), F.lit('"></use></svg>'))
    turned = F.when(c % 3 != 0, li("Turned pro", F.col("turned_pro").cast("string"))).otherwise("")
    plays = F.when(c % 2 == 0, "Right-Handed, Two-Handed Backhand").otherwise("Right-Handed")
    details = F.concat(li("Age", F.lit("30 ("), born, F.lit(")")), li("Weight", F.lit("150 lbs ("), (60 + c % 40).cast("string"), F.lit("kg)")), li("Height", F.lit("6'0 ("), (165 + c % 40).cast("string"), F.lit("cm)")), turned, F.lit("</ul><ul>"), li("Country", flag), li("Plays", plays))
    html = F.concat(F.lit('<div class="info"><div class="name"> <span> Ann  de '), F.col("citizenship"), F.lit('</span></div></div><div class="personal_details"><ul>'), details, F.lit("</ul></div>"))
    made = tables.players(spark, sf_dir).select(F.concat(F.lit("https://x/en/players/p-"), c.cast("string"), F.lit("/P"), c.cast("string"), F.lit("/overview")).alias("url"), html.alias("html"))
    return pages.profiles(made).select("player_code", "slug", "first_name", "last_name", "country", "turned_pro", "weight", "height", F.col("birth_date").cast("string").alias("birth_date"), "handedness", "backhand")


def result_html(spark, sf_dir):
    """One page a tournament; matches of wheelchair draws stand on it too."""
    c = lambda x: F.col(x).cast("string")
    even = F.col("id") % 2 == 0
    cell = lambda *v: F.concat(F.lit('<div class="score-item">'), *[F.concat(F.lit("<span>"), x, F.lit("</span>")) for x in v], F.lit("</div>"))
    two = lambda a, b: F.concat(*[cell(F.lit(x)) for x in a]) if b is None else F.concat(*[cell(F.lit(x)) for x in a], cell(F.lit(b[0]), b[1]))
    w = F.when(even, two("6", ("7", F.lit("")))).otherwise(two("366", None))
    lost = F.when(even, two("4", ("6", (F.col("id") % 6).cast("string")))).otherwise(two("631", None))
    seed = F.when(F.col("id") % 4 == 0, F.concat(F.lit("<span>("), (F.col("id") % 7).cast("string"), F.lit(")</span>"))).otherwise("")
    player = lambda code, mark, seeded, sets: F.concat(F.lit('<div class="stats-item"><div class="player-info"><div class="name"><a href="/en/players/p/'), F.concat(F.lit("p"), c(code)), F.lit('/overview">n</a>'), seeded, F.lit("</div>"), mark, F.lit('</div><div class="scores">'), sets, F.lit("</div></div>"))
    first, second = player("winner", F.lit('<div class="winner"></div>'), seed, w), player("loser", F.lit(""), F.lit(""), lost)
    both = F.when(F.col("id") % 3 == 0, F.concat(second, first)).otherwise(F.concat(first, second))
    head = F.when(F.col("id") % 41 == 0, "Wheelchair Final").otherwise(F.concat(F.lit("R"), c("rnd"), F.lit(" Day 2 - Court 1")))
    note = F.when(F.col("match_ret").isNotNull(), F.concat(F.lit('<div class="match-notes">'), "match_ret", F.lit("</div>"))).otherwise("")
    clock = F.concat(F.lit("<span>01:"), F.lpad((F.col("id") % 60).cast("string"), 2, "0"), F.lit(":09</span>"))
    node = F.concat(F.lit('<div class="match"><div class="match-header"><span><strong>'), head, F.lit("</strong></span>"), clock, F.lit("</div>"), both, note, F.lit('<a class="stats" href="/en/scores/match-stats/'), c("id"), F.lit('">x</a></div>'))
    made = tables.matches(spark, sf_dir).groupBy("tournament_id").agg(F.array_join(F.collect_list(node), "").alias("html"))
    return made


@query("m", """select tournament_id, 'R' || cast(rnd as varchar) as stage, 'P' || cast(winner as varchar) as winner_code, 'P' || cast(loser as varchar) as loser_code, case when id % 4 = 0 then cast(id % 7 as varchar) end as winner_seed, cast(null as varchar) as loser_seed,
  case when id % 2 = 0 then '64 76(' || cast(id % 6 as varchar) || ')' else '36 63 61' end as score, match_ret as note, '/en/scores/match-stats/' || cast(id as varchar) as stats_url, cast(60 + id % 60 as int) as duration from m where id % 41 <> 0""")
def result_pages(spark, sf_dir):
    return pages.results(result_html(spark, sf_dir))


@query("m", "select tournament_id, 'other draw' as reason, count(*) as n from m where id % 41 = 0 group by 1")
def result_rejects(spark, sf_dir):
    """Matches of result pages that don't count, by reason."""
    return pages.rejected_results(result_html(spark, sf_dir))


FIGURES = [*pages.SINGLE.items(), *[(i, n) for i, pair in pages.PAIRS.items() for n in pair]]


BEFORE = {y: x for x, y in pages.PAIRS.values()}


@query("sd m", "select m.id as stats_url, " + ", ".join(f"case when {s}_{BEFORE.get(n, n)} is not null then cast({s}_{n} as int) end as {s}_{n}" for s in "wl" for _, n in FIGURES) + " from m join sd on sd.id = m.id")
def statistics_pages(spark, sf_dir):
    """A page a match, with the lists of both sides; the winner stands left or right."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))

    def values(s):
        out = {0: F.lit("100"), **{i: text(f"{s}_{n}") for i, n in pages.SINGLE.items()}}
        for i, (x, y) in pages.PAIRS.items():
            out[i] = F.when(F.col(f"{s}_{x}").isNotNull(), F.concat(F.lit("50% ("), text(f"{s}_{x}"), F.lit("/"), text(f"{s}_{y}"), F.lit(")"))).otherwise("-")
        return [out[i] for i in range(15)]

    left = F.col("id") % 2 == 0
    mark = lambda on: F.concat(F.lit('<div class="stats-item"><div class="'), F.when(on, "winner").otherwise("other"), F.lit('"></div></div>'))
    side = lambda role, s: F.concat(*[F.concat(F.lit(f'<div class="{role}-stats-item"> <div class="value">'), v, F.lit("</div></div>")) for v in values(s)])
    lists = F.when(left, F.concat(side("player", "w"), side("opponent", "l"))).otherwise(F.concat(side("player", "l"), side("opponent", "w")))
    m = tables.matches(spark, sf_dir).select("id").join(tables.sides(spark, sf_dir), "id")
    got = pages.statistics(m.select(F.col("id").alias("stats_url"), F.concat(mark(left), mark(~left), lists).alias("html")))
    return got.select("stats_url", *[f"{s}_{n}" for s in "wl" for _, n in FIGURES])
