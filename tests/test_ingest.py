"""A run from saved pages to features: stages feed each other, repeated runs change nothing, a year touches its own files."""

import pytest

from epochal import ingest
from epochal.__main__ import main
from epochal.operators import audit
from epochal.sources import pages

#: tournament code -> (year, month); matches (code, stage, winner, loser, sets, note, id of statistics)
EVENTS = {"10": (1991, "May"), "11": (1991, "June"), "20": (1992, "May")}
MATCHES = [("10", "Semifinals", "A1", "B2", "64 64", None, "1"), ("10", "Final - Day 2", "A1", "C3", "36 76(5) 61", None, "2"), ("11", "Final", "B2", "A1", "60", "(RET)", "3"), ("20", "Final", "C3", "A1", "61 60", None, "4"), ("20", "Wheelchair Final", "X9", "Y9", "61 60", None, None)]


def archive(year):
    one = '<div class="event-badge_container"><img class="events_banner" src="/a/categorystamps_500.png"></div><a class="tournament__profile" href="/en/tournaments/open-{c}/{c}/overview"><div class="top"> <span class="name">Open {c}</span></div></a><div class="bottom"><span class="Date"> 1 - 7 {m}, {y} </span></div>'
    return "".join(one.format(c=c, y=y, m=m) for c, (y, m) in EVENTS.items() if y == year)


def overview(surface):
    li = "<li><span>x</span> <span>{}</span></li>"
    return '<ul class="td_left">' + "".join(map(li.format, ("Lyon", "32/16", surface, "€75,000"))) + '</ul><ul class="td_right">' + li.format("Lyon, France") + "</ul>"


def result(code, stage, winner, loser, sets, note, stat):
    def side(me, mark, at):
        games = []
        for s in sets.split():
            tie = f"<span>{s[3:-1]}</span>" if "(" in s and at == 1 else "<span></span>"
            games.append(f'<div class="score-item"><span>{s[at]}</span>{tie}</div>')
        return f'<div class="stats-item"><div class="name"><a href="/en/players/p/{me.lower()}/overview">n</a></div>{mark}<div class="scores">{"".join(games)}</div></div>'

    link = f'<a class="stats" href="/stats/{stat}">x</a>' if stat else ""
    return f'<div class="match"><strong>{stage}</strong><span>01:10:09</span>{side(winner, chr(60) + "div class=" + chr(34) + "winner" + chr(34) + "></div>", 0)}{side(loser, "", 1)}' + (f'<div class="match-notes">{note}</div>' if note else "") + link + "</div>"


def statistic(k):
    shown = '<div class="stats-item"><div class="winner"></div></div><div class="stats-item"><div class="other"></div></div>'
    values = ["100", str(3 * k), "1", *["50% (5/10)"] * 8, "8", "9", "50% (5/10)", "50% (5/10)"]
    return shown + "".join(f'<div class="{role}-stats-item"> <div class="value">{v}</div></div>' for role in ("player", "opponent") for v in values)


def saved(matches=MATCHES):
    rows = [("archive", y, None, archive(y)) for y in (1991, 1992)]
    rows += [("overview", y, f"/en/tournaments/open-{c}/{c}/overview", overview("Outdoor Clay")) for c, (y, _) in EVENTS.items()]
    rows += [("results", y, f"/en/scores/archive/open-{c}/{c}/{y}/results", "".join(result(*m) for m in matches if m[0] == c)) for c, (y, _) in EVENTS.items()]
    rows += [("results", 1991, "/en/scores/archive/unknown/99/1991/results", result("99", "Final", "A1", "B2", "60 60", None, None)), ("results", 1991, None, None)]
    rows += [("statistics", EVENTS[m[0]][0], f"/stats/{m[-1]}", statistic(int(m[-1]))) for m in matches if m[-1]]
    return rows + [("profile", None, f"https://x/en/players/p/{p}/overview", f'<div class="info"><div class="name"><span>Ann {p}</span></div></div>') for p in ("A1", "B2", "C3")]


@pytest.fixture
def run(spark, tmp_path):
    def write(rows):
        spark.createDataFrame(rows, ingest.PAGES).write.mode("overwrite").partitionBy("kind", "year").parquet(str(tmp_path / "pages"))

    write(saved())
    out = ingest.Run(spark, str(tmp_path / "pages"), str(tmp_path / "out"))
    out.write = write
    return out


def test_all_stages(spark, run):
    assert main(["all", "--pages", run.saved, "--out", run.folder]) == 0
    t = {r.tournament_id: r for r in run.rows("tournaments").collect()}
    assert set(t) == {"1991-10", "1991-11", "1992-20"} and {(r.surface, r.series, r.country, r.singles) for r in t.values()} == {("Clay", "atp500", "France", "32")}
    assert str(t["1991-11"].start_dtm) == "1991-06-01"
    m = {r.id: r for r in run.rows("matches").collect()}
    assert set(m) == {"1991-10-A1-B2-SF", "1991-10-A1-C3-F", "1991-11-B2-A1-F", "1992-20-C3-A1-F"}
    assert m["1991-10-A1-C3-F"].score == "36 76(5) 61" and m["1991-11-B2-A1-F"].match_ret == "(RET)"
    assert [tuple(r) for r in spark.read.parquet(f"{run.folder}/rejected").collect()] == [("1992-20", "other draw", 1)]
    assert {(r.id, r.w_aces) for r in run.rows("stats").collect()} == {("1991-10-A1-B2-SF", 3), ("1991-10-A1-C3-F", 6), ("1991-11-B2-A1-F", 9), ("1992-20-C3-A1-F", 12)}
    assert {r.player_code for r in run.rows("players").collect()} == {"A1", "B2", "C3"}
    f = {(r.id, r.player_code): r for r in run.rows("features").collect()}
    assert len(f) == 8
    last = f["1992-20-C3-A1-F", "A1"]
    assert (last.target, last.prior_matches, last.prior_wins, last.form_5) == (0, 3, 2, pytest.approx(2 / 3))
    assert last.serve_1st_in_pct == pytest.approx(0.5) and last.serve_1st_in_pct_log_ratio == pytest.approx(0.0)
    assert last.aces_per_match is None and f["1991-10-A1-B2-SF", "B2"].form_5 is None
    assert {r.status for r in audit.log(spark, run.folder).collect()} == {"done"}


def test_repeated_and_restated(spark, run):
    for stage in ingest.STAGES.values():
        stage(run, None)
    before = {name: run.tables[name].manifest() for name in ingest.TABLES}
    again = {name: stage(run, None) for name, stage in ingest.STAGES.items()}
    assert all(again[n]["insert"] == again[n]["update"] == 0 for n in ("tournaments", "players", "matches", "stats"))
    assert again["stats"]["parts"] == 0  # nothing was missing, so no page was asked for
    # 1992 is read again: a longer score counts, a shorter one doesn't, the link stays where the new page lacks it
    run.write(saved([*MATCHES[:3], ("20", "Final", "C3", "A1", "61 57 60", None, None)]))
    assert ingest.matches(run, 1992)["update"] == 1
    row = run.rows("matches", 1992).first()
    assert (row.score, row.stats_url) == ("61 57 60", "/stats/4")
    ingest.features(run, 1992)
    for name in ("matches", "features"):
        after = run.tables[name].manifest()
        assert after["1992"]["path"] != before[name]["1992"]["path"]
    assert before["matches"]["1991"]["rows"] == 3 and run.rows("features").count() == 8
    now = run.tables["features"].manifest()["1991"]["path"]
    ingest.features(run, 1992)
    assert run.tables["features"].manifest()["1991"]["path"] == now


def test_year_prunes_the_scan(spark, run):
    plan = run.pages("results", 1992)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan and "(year" in plan.split("PartitionFilters")[1].split("]")[0]
    ingest.tournaments(run, 1992)
    assert [r.year for r in run.rows("tournaments").collect()] == [1992]


def test_nothing_saved(spark, run):
    run.write([("archive", 1991, None, ""), ("results", 1991, "x", None)])
    for stage in ingest.STAGES.values():
        stage(run, None)
    assert all(run.rows(name).count() == 0 for name in ingest.TABLES)
    assert pages.results(run.pages("results").withColumnRenamed("url", "tournament_id")).count() == 0
