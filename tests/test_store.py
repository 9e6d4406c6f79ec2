"""Tables in parts: merges touch what they must, broken writes change nothing, late rows are told apart."""

import pytest
from pyspark.sql import functions as F

from epochal.operators import store

SCHEMA = "k int, v string, t int"


@pytest.fixture
def table(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "t"), ["k"], 8)
    s.create(spark.createDataFrame([(i, f"v{i}", 0) for i in range(100)], SCHEMA))
    return s


def rows(s, version=None):
    return {r.k: (r.v, r.t) for r in s.read(version).collect()}


def files(s, parts=None):
    return set(s.read(parts=parts).inputFiles())


def test_a_merge_writes_the_parts_it_touches(spark, table):
    before, old = {p: files(table, [p]) for p in table.manifest()}, rows(table)
    source = spark.createDataFrame([(3, "new", 1), (1000, "x", 1), (5, "v5", 0)], SCHEMA)
    touched = set(table.touched(source))
    said = table.merge(source)
    assert (said["insert"], said["update"], said["version"], said["parts"]) == (1, 1, 1, len(touched))
    assert rows(table) == old | {3: ("new", 1), 1000: ("x", 1)} and rows(table, 0) == old
    for p in before:
        assert (files(table, [p]) == before[p]) == (p not in touched)
    assert len(touched) < len(before)


def test_a_write_that_breaks_off_changes_nothing(spark, table, monkeypatch):
    old = rows(table)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(store.Store, "_commit", broken)
        with pytest.raises(OSError):
            table.merge(spark.createDataFrame([(3, "new", 1)], SCHEMA))
    assert rows(table) == old and table.versions() == [0]
    table.merge(spark.createDataFrame([(4, "new", 1)], SCHEMA))
    assert rows(table) == old | {4: ("new", 1)}
    assert table.vacuum() > 0 and table.versions() == [1] and rows(table) == old | {4: ("new", 1)}


def test_two_writers(spark, table):
    entries = table.manifest()
    table.merge(spark.createDataFrame([(3, "new", 1)], SCHEMA))
    with pytest.raises(store.Conflict):
        table._commit(entries, 0, None)
    assert table.versions() == [0, 1] and rows(table)[3] == ("new", 1)


def test_policies_and_empty_sources(spark, table):
    old = rows(table)
    table.merge(spark.createDataFrame([(1, None, 5), (2, "older", -1)], SCHEMA), store.newest(["v", "t"], ["t"]))
    assert rows(table) == old | {1: (None, 5)}
    said = table.merge(spark.createDataFrame([], SCHEMA))
    assert said["parts"] == said["insert"] == 0 and rows(table) == old | {1: (None, 5)}
    assert table.merge(spark.createDataFrame([(7777, "n", 1), (6, "u", 1)], SCHEMA), insert=False)["insert"] == 0
    assert 7777 not in rows(table) and rows(table)[6] == ("u", 1)
    with pytest.raises(ValueError, match="other parts"):
        table.replace(spark.createDataFrame([(i, "x", 1) for i in range(20)], SCHEMA), ["b00000"])


def test_restated_days_over_four_batches(spark, tmp_path):
    """Rows within the horizon restate their days; those beyond it are set aside; other days' features stay as they are."""
    day = lambda n: f"2024-03-{n:02d}"
    table, features = store.Store(spark, str(tmp_path / "e"), ["id", "day"], "day"), store.Store(spark, str(tmp_path / "f"), ["day"], "day")
    build = lambda r: r.groupBy("day").agg(F.count("*").alias("n"), F.sum("v").alias("total"))
    batch = lambda n, *r: spark.createDataFrame([(i, d, v, n) for i, d, v in r], "id int, day string, v int, at int").withColumn("day", F.col("day").cast("date"))
    table.create(batch(0).limit(0))
    features.create(build(batch(0).limit(0)))
    go = lambda n, *r: store.restate(table, features, batch(n, *r), ["at"], build)
    got = lambda: {str(r.day)[-2:]: (r.n, r.total) for r in features.read().collect()}
    assert go(1, (1, day(1), 10), (2, day(2), 20), (3, day(9), 30)) == {"taken": 3, "late": 0, "days": 3}
    kept = files(features, [day(1)])
    assert go(2, (2, day(2), 25), (4, day(2), 1), (5, day(24), 5)) == {"taken": 3, "late": 0, "days": 2}
    assert files(features, [day(1)]) == kept
    assert go(3, (6, day(1), 99), (3, day(9), 31), (7, day(2), 2)) == {"taken": 2, "late": 1, "days": 2}
    assert go(4, (8, None, 7), (3, day(9), 32), (3, day(9), 32)) == {"taken": 2, "late": 1, "days": 1}
    assert got() == {"01": (1, 10), "02": (3, 28), "09": (1, 32), "24": (1, 5)}
    assert files(features, [day(1)]) == kept
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "e" / "late")).collect()) == [6, 8]
    late_again = store.restate(table, features, batch(2, (3, day(9), 1)), ["at"], build)  # an older batch that is run again
    assert late_again["taken"] == 1 and got()["09"] == (1, 32)


def test_merging_in_four_tables_is_one_commit(spark, tmp_path, monkeypatch):
    """A failure after the second table leaves all four as they were; then ids, codes and hashes follow chains of codes."""
    from epochal.operators import merge

    data = {
        "players": spark.createDataFrame([("A1", "x", None), ("B2", None, "q"), ("C3", "z", "r"), ("A12", "w", "w")], "code string, name string, hand string"),
        "matches": spark.createDataFrame([("1-A1-B2", "A1", "B2", 0), ("2-C3-A12", "C3", "A12", 0), ("3-A12-A12", "A12", "A12", 0)], "id string, w string, l string, h long"),
        "enriched": spark.createDataFrame([("1-A1-B2", 5), ("3-A12-A12", 6)], "id string, n int"),
        "points": spark.createDataFrame([("t", "C3", 10), ("t", "B2", 20)], "t string, code string, n int"),
    }
    keys = {"players": ["code"], "matches": ["id"], "enriched": ["id"], "points": ["t", "code"]}
    held = {t: store.Store(spark, str(tmp_path / t), keys[t], 4) for t in data}
    catalog = store.Catalog(str(tmp_path), held)
    catalog.commit({t: s.create(data[t]) for t, s in held.items()})
    codes = spark.createDataFrame([("A1", "B2"), ("B2", "C4"), ("C3", "C4")], "old_code string, new_code string")
    uses = {"matches": {"codes": ["w", "l"], "ids": ["id"], "hash": ("h", ["id", "w", "l"])}, "enriched": {"ids": ["id"]}, "points": {"codes": ["code"]}}
    got = lambda t: sorted(tuple(r) for r in catalog.read(t).select(*data[t].columns).collect())
    before, real, calls = {t: got(t) for t in data}, store.Store.rewrite, []

    def third_fails(self, *args, **how):
        calls.append(self)
        if len(calls) == 3:
            raise OSError("lost")
        return real(self, *args, **how)

    with monkeypatch.context() as m:
        m.setattr(store.Store, "rewrite", third_fails)
        with pytest.raises(OSError):
            merge.merge_everywhere(catalog, codes, ("players", "code"), uses)
    assert {t: got(t) for t in data} == before and len(held["matches"].versions()) == 2
    merge.merge_everywhere(catalog, codes, ("players", "code"), uses)
    assert got("players") == [("A12", "w", "w"), ("C4", "x", "q")]
    assert [r[:3] for r in got("matches")] == [("1-C4-C4", "C4", "C4"), ("2-C4-A12", "C4", "A12"), ("3-A12-A12", "A12", "A12")]
    assert got("enriched") == [("1-C4-C4", 5), ("3-A12-A12", 6)] and got("points") == [("t", "C4", 10), ("t", "C4", 20)]
    hashes = {r.id: r.h for r in catalog.read("matches").withColumn("h", F.col("h") == merge.change_hash(["id", "w", "l"])).collect()}
    assert hashes == {"1-C4-C4": True, "2-C4-A12": True, "3-A12-A12": False}
