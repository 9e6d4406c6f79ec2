"""From matches to a panel of two rows a match, and joins of attributes to both roles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def unpivot(matches: DataFrame, winner: str = "winner", loser: str = "loser", sided: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Two rows a match, player against opponent, in one scan.

    sided: name -> (winner's column, loser's column) becomes player_<name> and opponent_<name>.
    """
    sided = sided or {}
    taken = {winner, loser, *[c for pair in sided.values() for c in pair]}
    shared = [F.col(c) for c in matches.columns if c not in taken]

    def side(me: int) -> Column:
        ends = (winner, loser)
        fields = [F.col(ends[me]).alias("player_code"), F.col(ends[1 - me]).alias("opponent_code"), F.lit("loss" if me else "win").alias("match_result")]
        fields += [F.col(pair[i]).alias(f"{role}_{name}") for name, pair in sided.items() for role, i in (("player", me), ("opponent", 1 - me))]
        return F.struct(*fields)

    return matches.select(*shared, F.explode(F.array(side(0), side(1))).alias("_side")).select(*[F.col(c) for c in matches.columns if c not in taken], "_side.*")


def partner(column: str | Column, match: str = "id", side: str = "match_result") -> Column:
    """The other row's value of a panel with two rows a match, without joining the panel to itself."""
    w = Window.partitionBy(match).orderBy(side)
    return F.coalesce(F.lag(column).over(w), F.lead(column).over(w))


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of frames, columns by name; a column that one lacks is null there."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def attach(panel: DataFrame, attributes: DataFrame, key: str, columns: Sequence[str], roles: Sequence[str] = ("player", "opponent")) -> DataFrame:
    """Left-joins attributes (one row a key is kept) to each role as <role>_<column>."""
    one = attributes.dropDuplicates([key]).select(key, *columns)
    for role in roles:
        side = one.select(F.col(key).alias(f"{role}_code"), *[F.col(c).alias(f"{role}_{c}") for c in columns])
        panel = panel.join(side, f"{role}_code", "left")
    return panel


def rename_prefixes(df: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """Columns that begin with a prefix get the other one."""

    def renamed(c: str) -> str:
        for old, new in prefixes.items():
            if c.startswith(old):
                return new + c[len(old) :]
        return c

    return df.toDF(*map(renamed, df.columns))


def defaulted(df: DataFrame, column: str, other: str) -> DataFrame:
    """Adds a column as a copy of another if it is missing."""
    return df if column in df.columns else df.withColumn(column, F.col(other))


def keep_columns(df: DataFrame, first: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    """Drops columns that are there, and puts the given ones first."""
    rest = [c for c in df.columns if c not in drop and c not in first]
    return df.select(*[c for c in first if c in df.columns], *rest)


def known_in_both(df: DataFrame, column: str, roles: Sequence[str] = ("player", "opponent"), watch: Observation | None = None) -> DataFrame:
    """Rows whose <role>_<column> is known for every role; watch gets the numbers of rows seen and left out."""
    known = reduce(and_, [F.col(f"{r}_{column}").isNotNull() for r in roles])
    if watch is not None:
        df = df.observe(watch, F.count("*").alias("seen"), F.count(F.when(~known, 1)).alias("left_out"))
    return df.filter(known)


def filled(df: DataFrame, column: str, values: DataFrame, key: str, value: str, roles: Sequence[str] = ("player", "opponent")) -> DataFrame:
    """<role>_<column> filled, where it is null, from a table of (key, value)."""
    for r in roles:
        side = values.select(F.col(key).alias(f"{r}_code"), F.col(value).alias("_fill"))
        df = df.join(side, f"{r}_code", "left").withColumn(f"{r}_{column}", F.coalesce(f"{r}_{column}", "_fill")).drop("_fill")
    return df


def matched(panel: DataFrame, key: str = "id", side: str = "match_result", columns: Sequence[str] = ("player_code",)) -> DataFrame:
    """One row a match from its two rows: winner_<column> and loser_<column>. Keys without exactly one row a side are left out."""
    both = [F.max(F.when(F.col(side) == s, F.col(c))).alias(f"{r}_{c}") for c in columns for r, s in (("winner", "win"), ("loser", "loss"))]
    of = panel.groupBy(key).agg(F.count("*").alias("_n"), F.count(F.when(F.col(side) == "win", 1)).alias("_w"), *both)
    return of.filter("_n = 2 and _w = 1").drop("_n", "_w")


def malformed(panel: DataFrame, key: str = "id") -> DataFrame:
    """key, rows: keys whose number of rows is not two."""
    return panel.groupBy(key).agg(F.count("*").alias("rows")).filter("rows <> 2")


def empty_row(columns: Sequence[str]) -> Column:
    """Whether none of the columns has a value."""
    return F.coalesce(*[F.col(c).cast("string") for c in columns]).isNull()


def require(df: DataFrame, *columns: str) -> DataFrame:
    """df, or an error that names the columns it lacks."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def first_of(df: DataFrame, names: Sequence[str], to: str) -> DataFrame:
    """Renames the first of some names that df has; an error if it has none."""
    for name in names:
        if name in df.columns:
            return df.withColumnRenamed(name, to)
    raise ValueError(f"none of {', '.join(names)}")
