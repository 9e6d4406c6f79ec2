"""Files whose headers differ, checked writes, and tables of a database."""

import ast
import pathlib

import pytest

from epochal.sources import database, files, tables


def test_no_test_hides_another():
    """A second function of one name in a module would replace the first."""
    for path in pathlib.Path(__file__).parent.rglob("test_*.py"):
        names = [n.name for n in ast.parse(path.read_text()).body if isinstance(n, ast.FunctionDef)]
        assert len(names) == len(set(names)), path


def snapshots(spark, path):
    return sorted((r.player_code, str(r.snapshot_date), r.ranking) for r in files.read_snapshots(spark, str(path)).collect())


def test_snapshots_of_mixed_headers(spark, tmp_path):
    (tmp_path / "rankings_2020-01-06.csv").write_text("player_code,atp_rank\nA,1\nB,x\n")
    (tmp_path / "rankings_2020-01-13.csv").write_text("rank,player_code\n3,A\n")
    (tmp_path / "rankings_2020-01-20.csv").write_text('\ufeff"points", "ranking" ,"player_code"\n900,4,"A"\n')
    (tmp_path / "rankings_2020-01-27.csv").write_text("player_code,rank,ranking\nA,9,5\n")
    (tmp_path / "rankings_2020-02-03.csv").write_text("")
    (tmp_path / "rankings_undated.csv").write_text("player_code,rank\nC,7\n")
    assert snapshots(spark, tmp_path) == [("A", "2020-01-06", 1), ("A", "2020-01-13", 3), ("A", "2020-01-20", 4), ("A", "2020-01-27", 5), ("B", "2020-01-06", None), ("C", "None", 7)]


def test_unknown_headers_are_named(spark, tmp_path):
    (tmp_path / "rankings_2020-01-06.csv").write_text("player_code,rank\nA,1\n")
    (tmp_path / "rankings_2020-01-13.csv").write_text("player_code,position\nA,2\n")
    with pytest.raises(ValueError, match="player_code,position.*2020-01-13.*ranking"):
        files.read_snapshots(spark, str(tmp_path))
    with pytest.raises(ValueError, match="twice"):
        (tmp_path / "x").mkdir()
        (tmp_path / "x" / "rankings_2020-01-13.csv").write_text("rank,rank,player_code\n1,2,A\n")
        files.read_snapshots(spark, str(tmp_path / "x"))


def test_headers_of_many_splits(spark, tmp_path):
    """A file that is read in several splits has one header, its first line."""
    (tmp_path / "rankings_2020-01-06.csv").write_text("rank,player_code\n" + "".join(f"{i},p{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert files.headers(spark, str(tmp_path)).collect()[0].header == "rank,player_code"
        got = snapshots(spark, tmp_path)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 5000 and all(code == f"p{rank}" for code, _, rank in got)


def test_writes(spark, tmp_path):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "y int, x int")
    files.write_table(df, str(tmp_path / "t"), ["y"])
    assert sorted(p.name for p in (tmp_path / "t").glob("y=*")) == ["y=1", "y=2"]
    files.write_table(df.filter("y = 2"), str(tmp_path / "t"), ["y"])
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).select("y", "x").collect()] == [(2, 1)]
    files.write_csv(df, str(tmp_path / "c"), ["x"])
    lines = [line for p in sorted((tmp_path / "c").glob("part-*")) for line in p.read_text().splitlines() if line != "y,x"]
    assert lines == ["2,1", "1,2", "1,3"]


@pytest.fixture
def url(tmp_path):
    return f"jdbc:derby:{tmp_path}/db;create=true"


@pytest.mark.parametrize("name", ["players", "tournaments", "matches"])
def test_database_round_trip(spark, sf, url, tmp_path, name):
    """Loaded, read back in ranges and exported, a table has the same rows; a second load replaces the first."""
    df = getattr(tables, name)(spark, sf)
    n = df.count()
    assert database.load(df, url, name) == n
    assert database.load(df, url, name) == n
    column = {"players": "player_code", "tournaments": "start_dtm", "matches": "id"}[name]
    back = database.read_query(spark, url, f"select * from {name}", f'"{column}"', 5, fetch=100)
    assert back.rdd.getNumPartitions() == 5
    text = lambda d: sorted(tuple(map(str, r)) for r in d.select(*df.columns).collect())
    assert text(back) == text(df)
    database.export(spark, url, f"select * from {name}", f'"{column}"', str(tmp_path / "csv"), 3, [column])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == n


def test_a_load_that_fails_changes_nothing(spark, url):
    rows = lambda: sorted(tuple(r) for r in database.read_query(spark, url, "select * from t", '"k"', 2).collect())
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    database.load(good, url, "t", ['"k"'])
    with pytest.raises(ValueError, match="repeat"):
        database.load(spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, v string"), url, "t", ['"k"'])
    assert rows() == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="not a column"):
        database.load(spark.createDataFrame([(7, "x", 1)], "k int, v string, w int"), url, "t")
    assert rows() == [(1, "a"), (2, "b")]
    with pytest.raises(RuntimeError), database.transaction(spark, url) as run:
        run("delete from t")
        raise RuntimeError
    assert rows() == [(1, "a"), (2, "b")]


def test_an_empty_query(spark, url):
    database.load(spark.createDataFrame([(1, "a")], "k int, v string"), url, "t")
    assert database.read_query(spark, url, "select * from t where 1 = 0", '"k"', 4).count() == 0
    assert database.load(spark.createDataFrame([], "k int, v string"), url, "t") == 0
