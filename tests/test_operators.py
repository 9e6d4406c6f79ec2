"""Operators on small fixtures: rules, edges, invariants."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epochal.functions import dates, scores
from epochal.functions import features as fx
from epochal.operators import merge, panel, ratings, stats
from epochal.operators import temporal as tp
from epochal.sources import files, pages


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "status"),
    [("W/O", "(W/O)"), ("INV", "(W/O)"), ("WEA", "(WEA)"), ("64 21 RET", "(RET)"), ("DEF", "(RET)"), ("UNP", "(RET)"), ("64 64", None), (None, None)],
)
def test_status(spark, text, status):
    assert one(spark, scores.status(F.lit(text).cast("string"))) == status


@pytest.mark.parametrize(
    ("text", "want"),
    [("64 36 76", (2, 1, 16, 16, 1, 0)), ("2218", (1, 0, 22, 18, 0, 0)), ("108", (1, 0, 10, 8, 0, 0)), ("810", (0, 1, 8, 10, 0, 0)), ("911", (0, 1, 9, 11, 0, 0)), ("76(5)", (1, 0, 7, 6, 1, 0)), ("[11-9]", (1, 0, 1, 0, 1, 0))],
)
def test_score(spark, text, want):
    assert tuple(one(spark, scores.parsed(F.lit(text)))) == want


def test_score_without_result(spark):
    assert one(spark, scores.parsed(F.lit("64 RET"))) is None
    assert one(spark, scores.n_sets(F.lit("64 RET"))) == 0
    assert one(spark, scores.n_sets(F.lit("64 76(5)"))) == 2


@pytest.mark.parametrize(("days", "want"), [(9, (1, 0, 0)), (10, (0, 1, 0)), (16, (0, 1, 0)), (17, (0, 0, 0)), (21, (0, 0, 1)), (None, (0, 0, 0))])
def test_rest(spark, days, want):
    flags = fx.rest_flags(F.lit(days).cast("int"))
    row = spark.range(1).select(*[c.alias(k) for k, c in flags.items()]).first()
    assert tuple(row) == want


def test_trend_and_cut(spark):
    assert one(spark, fx.trend(F.lit(45), F.lit(50), 0.02)) == "subida"
    assert one(spark, fx.trend(F.lit(None).cast("int"), F.lit(50), 0.02)) is None
    assert [one(spark, fx.cut_sign(F.lit(x))) for x in (-0.2, 0.2, 0.2001)] == ["negative", "neutral", "positive"]


def test_smoothing(spark):
    assert abs(one(spark, fx.smoothed(F.lit(3), F.lit(4), 8.0)) - 7 / 12) < 1e-9
    assert abs(one(spark, fx.credibility(F.lit(4), 8.0)) - 1 / 3) < 1e-9


def test_dates(spark):
    assert {one(spark, dates.any_date(F.lit(t))) for t in ("2020-01-04", "04.01.2020", "20200104", "2020.01.04", "2020/01/04")} == {dt.date(2020, 1, 4)}
    assert one(spark, dates.any_date(F.lit("soon"))) is None
    assert tuple(one(spark, dates.range_dates(F.lit("29 December, 2019 - 4 January, 2020")))) == (dt.date(2019, 12, 29), dt.date(2020, 1, 4))
    assert tuple(one(spark, dates.range_dates(F.lit("6 - 12 January, 2020")))) == (dt.date(2020, 1, 6), dt.date(2020, 1, 12))
    assert one(spark, dates.minutes(F.lit("02:15"))) == 135


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("width", [None, 7])
def test_asof_against_loop(spark, strict, width):
    rng = random.Random(5)
    history = [(rng.choice("ab"), rng.randrange(60), i, rng.choice([None, i])) for i in range(40)]
    history = list({(k, t): (k, t, i, v) for k, t, i, v in history}.values())
    probes = [(n, rng.choice("abc"), rng.randrange(60)) for n in range(50)]
    h = frame(spark, history, "k string, t int, v int, w int")
    out = tp.asof(frame(spark, probes, "n int, k string, at int"), h, ["k"], "at", "t", ["v", "w"], strict=strict, slice_width=width)
    got = {r.n: (r.v, r.w) for r in out.collect()}
    for n, k, at in probes:
        past = [x for x in history if x[0] == k and (x[1] < at or x[1] == at and not strict)]
        best = max(past, key=lambda x: x[1], default=None)
        assert got[n] == ((best[2], best[3]) if best else (None, None))


def test_asof_empty(spark):
    h = frame(spark, [], "k string, t int, v int")
    out = tp.asof(frame(spark, [("a", 1)], "k string, at int"), h, ["k"], "at", "t", ["v"], slice_width=5)
    assert [tuple(r) for r in out.collect()] == [("a", 1, None)]


def test_no_leak(spark, sf):
    """Features of rows up to a day don't change when later rows go."""
    from epochal.plans import temporal_queries as q
    from epochal.sources import tables

    m = tables.matches(spark, sf)
    full = panel.unpivot(m)
    cut = panel.unpivot(m.filter("start_dtm < date '1995-01-01'"))
    w = tp.before(["player_code"], q.ORDER)

    def feature(p):
        rows = p.select("id", "player_code", "start_dtm", F.avg((F.col("match_result") == "win").cast("double")).over(w).alias("x"))
        return {(r.id, r.player_code): r.x for r in rows.filter("start_dtm < date '1995-01-01'").collect()}

    assert feature(full) == feature(cut)


def test_unpivot_is_symmetric(spark, sf):
    from epochal.sources import tables

    p = panel.unpivot(tables.matches(spark, sf))
    assert p.groupBy("id").agg(F.count("*").alias("n"), F.sum((F.col("match_result") == "win").cast("int")).alias("w")).filter("n <> 2 or w <> 1").isEmpty()
    mirrored = p.select("id", F.col("opponent_code").alias("player_code")).exceptAll(p.select("id", "player_code"))
    assert mirrored.isEmpty()


def test_elo_rules(spark):
    rows = [(1, 1, 10, 20, None), (2, 2, 30, 40, "(RET)"), (3, 3, 50, 60, "(W/O)"), (4, 4, 10, 20, None), (5, 5, 30, 50, None)]
    m = frame(spark, rows, "id long, day int, winner int, loser int, match_ret string")
    e = {r.id: r for r in ratings.elo_by_round(m, ["day", "id"], ["day"]).collect()}
    assert (e[4].winner_elo, e[4].loser_elo) == (1520.0, 1480.0)
    assert (e[5].winner_elo, e[5].loser_elo, e[5].loser_n) == (1510.0, 1500.0, 0)


def test_elo_round_uses_one_snapshot(spark):
    rows = [(1, 1, 10, 20, None), (2, 1, 10, 30, None), (3, 2, 10, 40, None)]
    m = frame(spark, rows, "id long, day int, winner int, loser int, match_ret string")
    e = {r.id: r for r in ratings.elo_by_round(m, ["day", "id"], ["day"]).collect()}
    assert e[2].winner_elo == 1500.0 and e[3].winner_elo == 1540.0 and e[3].winner_n == 2


def test_surface_elo_without_surface(spark):
    m = frame(spark, [(1, 1, 10, 20, None, "Clay"), (2, 2, 10, 20, None, None), (3, 3, 10, 20, None, "Clay")], "id long, day int, winner int, loser int, match_ret string, surface string")
    e = {r.id: r for r in ratings.surface_elo(m, ["day", "id"]).collect()}
    assert e[2].winner_elo == 1500.0 and e[2].winner_prob == 0.5 and e[3].winner_elo == 1520.0


def test_upsert(spark):
    old = frame(spark, [(1, "a", None), (2, "b", 2), (3, "c", 3)], "k int, x string, y int")
    new = frame(spark, [(1, None, 7), (2, "b", None), (4, "d", 4)], "k int, x string, y int")
    got = {r.k: (r.x, r.y, r.action) for r in merge.upsert(old, new, ["k"]).collect()}
    assert got == {1: ("a", 7, "update"), 2: ("b", 2, "noop"), 3: ("c", 3, "noop"), 4: ("d", 4, "insert")}
    only = {r.k for r in merge.upsert(old, new, ["k"], insert=False).collect()}
    assert only == {1, 2, 3}


def test_change_hash_keeps_places(spark):
    df = frame(spark, [("a", None), (None, "a")], "x string, y string")
    assert df.select(merge.change_hash(["x", "y"]).alias("h")).distinct().count() == 2


def test_shrink(spark):
    df = frame(spark, [(0, None), (20, 0.5), (60, 0.9)], "n int, serve_pct double")
    got = [r for r in stats.shrink(df, ["serve_pct"], "n").orderBy("n").collect()]
    assert got[0].serve_pct == pytest.approx(0.7) and got[0].serve_pct_was_na == 1
    assert got[1].serve_pct == pytest.approx(0.6) and got[2].serve_pct == pytest.approx(0.75 * 0.9 + 0.25 * 0.7)


def test_shrink_by_kind(spark):
    """Percentages keep their scale and its bounds, log ratios go to 0, gaps to their mean, each by its own count; unknown ones to the prior."""
    rows = [(0, 10, 80.0, 1.0, 4.0, None), (20, 30, None, None, None, None), (980, 70, 140.0, -2.0, 0.0, None)]
    df = frame(spark, rows, "n int, k int, serve_1st_efficiency double, aces_log_ratio double, tie_gap double, none_pct double")
    by = {"serve_1st_efficiency": "n", "aces_log_ratio": F.least("n", "k"), "tie_gap": "k", "none_pct": "n"}
    a, b, c = stats.shrink(df, list(by), by).orderBy("n").collect()
    assert (a.serve_1st_efficiency, b.serve_1st_efficiency, c.serve_1st_efficiency) == pytest.approx((99.9999, 99.9999, 99.9999))
    assert (a.aces_log_ratio, b.aces_log_ratio, c.aces_log_ratio) == pytest.approx((0.0, 0.0, -2.0 * 70 / 100))
    assert (a.tie_gap, b.tie_gap, c.tie_gap) == pytest.approx((0.5 * 4 + 0.5 * 2, 2.0, 2.0 / 8))
    assert [r.none_pct for r in (a, b, c)] == [0.5] * 3 and b.tie_gap_was_na == 1 and a.tie_gap_was_na == 0
    assert stats.shrink(df.limit(0), list(by), by).count() == 0


def test_p_value():
    assert stats.p_value(0.5, 20) == pytest.approx(0.0248, abs=2e-4)
    assert stats.p_value(0.0, 20) == pytest.approx(1.0)
    assert stats.p_value(None, 3) is None


def test_drawn_is_stable(spark):
    df = spark.range(200).withColumn("x", stats.drawn(F.col("id"), F.lit(100.0), F.lit(20.0), 60.0, 300.0))
    a, b = [r.x for r in df.collect()], [r.x for r in df.repartition(7).orderBy("id").collect()]
    assert a == b and all(60 <= x <= 300 for x in a) and 95 < sum(a) / 200 < 106


def test_threshold_edges(spark):
    none = frame(spark, [(0.9, 0), (0.8, 0)], "score double, label int")
    assert stats.best_threshold(none, "score", "label").first().threshold > 1
    split = frame(spark, [(0.9, 1), (0.2, 0)], "score double, label int")
    assert tuple(stats.best_threshold(split, "score", "label").first()) == (0.9, 0.0)


def test_ranking_page(spark):
    html = '<tr class="lower-row"><td>1</td><td><a href="/players/a-b/x1/"></a></td></tr><tr class="lower-row"><td>2</td><td><a href="/players/c/y2/"></a></td></tr><tr class="lower-row"><td>3</td><td><a href="/players/a-b/x1/"></a></td></tr>'
    got = pages.ranking_rows(frame(spark, [("d", html)], "day string, html string"))
    assert {(r.player_code, r.ranking) for r in got.collect()} == {("X1", 1), ("Y2", 2)}


def test_panel_helpers(spark):
    df = frame(spark, [(1, 2, 3)], "win_a int, los_b int, c int")
    assert panel.rename_prefixes(df, {"win_": "player_", "los_": "opponent_"}).columns == ["player_a", "opponent_b", "c"]
    assert panel.keep_columns(df, ["c"], ["los_b", "none"]).columns == ["c", "win_a"]
    with pytest.raises(ValueError, match="missing"):
        panel.require(df, "zzz")
    assert panel.defaulted(df, "d", "c").first().d == 3


def test_split_by_group(spark):
    from epochal.operators import ml

    df = frame(spark, [(i // 2, 2000 + i // 4) for i in range(16)], "id int, year int")
    rest, held = ml.split_by_group(df, df.filter("year = 2002"), "id", forward="year")
    assert held.count() == 4 and rest.agg(F.max("year")).first()[0] == 2001
    assert rest.join(held, "id").isEmpty()


def test_types(spark, sf):
    from epochal.plans import registry

    for name in ("panel_unpivot", "form_last_5_10"):
        assert all(not isinstance(f.dataType, T.NullType) for f in registry.queries()[name](spark, sf).schema)


def test_merges_of_chains_many_and_absent(spark):
    """Olds 2 and 3 go to 1, 4 over 5 to 6, and 8 to 9, which is absent."""
    rows = [(1, None, None), (2, "x", None), (3, "y", "z"), (4, "a", None), (5, "b", "c"), (6, None, None), (8, "k", None), (7, "q", "r")]
    codes = spark.createDataFrame([(2, 1), (3, 1), (4, 5), (5, 6), (8, 9)], "old_code int, new_code int")
    out = merge.merge_entities(spark.createDataFrame(rows, "code int, a string, b string"), codes, "code")
    assert sorted(map(tuple, out.collect())) == [(1, "x", "z"), (6, "a", "c"), (7, "q", "r"), (9, "k", None)]
    with pytest.raises(ValueError):
        merge.resolved(spark.createDataFrame([(1, 2), (2, 1)], "old_code int, new_code int"))


def test_upserts_tell_values_apart(spark):
    """Values that look alike when joined, and nulls against empty texts, are changes."""
    old = spark.createDataFrame([(1, "a|b", "c"), (2, None, "x"), (3, "s", "t")], "k int, a string, b string")
    new = spark.createDataFrame([(1, "a", "b|c"), (2, "", "x"), (3, "s", "t")], "k int, a string, b string")
    assert {r.k: r.action for r in merge.upsert(old, new, ["k"]).collect()} == {1: "update", 2: "update", 3: "noop"}
    hashes = old.unionByName(new).select(merge.change_hash(["a", "b"]).alias("h")).distinct().count()
    assert hashes == 5


def test_ratings_of_separate_groups(spark):
    """Players that never meet are folded apart, with the same figures as together."""
    rows = [(i, i // 3, i % 4 + 10 * (i % 2), (i % 4 + 1) % 4 + 10 * (i % 2), None, "Clay") for i in range(60)]
    rows = [r for r in rows if r[2] != r[3]]
    m = spark.createDataFrame(rows, "id long, day int, winner int, loser int, match_ret string, surface string")
    linked = {r.player: r.group for r in ratings.groups(m).collect()}
    assert len(set(linked.values())) > 1
    both = {r.id: tuple(r) for r in ratings.elo_by_round(m, ["day", "id"], ["day"]).collect()}
    for g in set(linked.values()):
        mine = [p for p, x in linked.items() if x == g]
        apart = ratings.elo_by_round(m.filter(m.winner.isin(mine)), ["day", "id"], ["day"]).collect()
        assert all(both[r.id] == tuple(r) for r in apart)


def test_files(spark, tmp_path):
    """Rows of another length are told apart; any of the rank names is taken; what can't be read is null."""
    from epochal.sources import files

    (tmp_path / "a.csv").write_text("x,y\n1,2\n3\n4,5,6\n")
    good, bad = files.split_rejects(files.read_csv(spark, str(tmp_path / "a.csv"), "x int, y int", "broken").cache(), "broken")
    assert [tuple(r) for r in good.collect()] == [(1, 2)] and {r.line: r.fields for r in bad.collect()} == {"3": 1, "4,5,6": 3}
    for k, name in enumerate(files.RANK_NAMES):
        (tmp_path / f"s{k}").mkdir()
        (tmp_path / f"s{k}" / "rankings_2001-02-03.csv").write_text(f"player_code,{name}\nA1,7\nB2,none\n")
        assert sorted((r.player_code, r.ranking) for r in files.read_snapshots(spark, str(tmp_path / f"s{k}")).collect()) == [("A1", 7), ("B2", None)]
    assert files.quiet(spark.createDataFrame([("1.5", "x")], "a string, b string"), {"a": "double", "b": "int"}).first() == (1.5, None)


def test_short_sets_and_finite(spark):
    from epochal.functions import features, scores

    df = spark.createDataFrame([("43 34 42", "7696", float("inf")), ("43 34 42", "1", 2.0), ("64 [10-8]", "9210", None)], "s string, code string, x double")
    rows = df.select(scores.parsed(F.col("s"), F.col("code")).alias("p"), features.finite(F.col("x")).alias("x")).collect()
    assert [(r.p.ties_won, r.p.ties_lost) for r in rows] == [(1, 1), (0, 0), (1, 0)] and [r.x for r in rows] == [None, 2.0, None]


def test_known_in_both(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1, 1, 2), (2, None, 3), (3, 4, None)], "id int, player_y int, opponent_y int")
    seen = Observation()
    assert [r.id for r in panel.known_in_both(df, "y", watch=seen).collect()] == [1] and seen.get == {"seen": 3, "left_out": 2}


def test_runner(spark, sf, tmp_path):
    from epochal.__main__ import main

    assert main(["players", "--tables", sf, "--out", str(tmp_path / "o")]) == 0
    assert main(["players", "--tables", str(tmp_path / "none"), "--out", str(tmp_path / "p")]) == 1
