"""Files as sources and sinks: CSV with given schemas or by each file's header, snapshots dated by their names, checked writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epochal.operators import panel


#: Names that the rank column of a snapshot may have, in the order they are looked for.
RANK_NAMES = ("player_atp_ranking", "atp_rank", "player_rank", "ranking", "rank")


def split_rejects(df: DataFrame, corrupt: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the right length, and those of another as they stand (line) with the number of their fields."""
    bad = df.filter(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("line"), F.size(F.split(corrupt, ",")).alias("fields"))
    return df.filter(F.col(corrupt).isNull()).drop(corrupt), bad


def quiet(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns cast to other types; what can't be read is null."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as {kind})") for c, kind in kinds.items()})


def read_csv(spark: SparkSession, path: str, schema: str, corrupt: str | None = None) -> DataFrame:
    """CSV with a header by a given schema; rows of another length go to the corrupt column, if it is named."""
    reader = spark.read.option("header", True)
    if corrupt:
        return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).schema(f"{schema}, {corrupt} string").csv(path)
    return reader.schema(schema).csv(path)


def headers(spark: SparkSession, path: str) -> DataFrame:
    """file, header of each file that has a line: its first line, found in one scan."""
    first = F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id())
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value", first.alias("at"))
    return lines.filter("at is not null").groupBy("file").agg(F.min_by("value", "at").alias("header"))


def fields(header: str) -> list[str]:
    """The names of a CSV header, without a byte order mark, quotes and white space around them."""
    return [n.strip().strip('"').strip() for n in header.lstrip("\ufeff").split(",")]


def read_by_header(spark: SparkSession, path: str, columns: dict[str, Sequence[str]]) -> DataFrame:
    """CSV files of a folder whose headers differ: file_name and the columns, each under the first of its names that
    a file's own header has. Files of one header are read together, by name, and the reads are joined by union.

    A header that lacks a column, or has a name twice, raises ValueError with the header and a file that has it.
    The files are listed on the driver, as Spark lists them itself; their rows are not.
    """
    kinds: dict[str, list[str]] = {}
    for r in headers(spark, path).orderBy("file").collect():  # a row a file
        kinds.setdefault(r.header, []).append(r.file)
    reads = []
    for header, paths in kinds.items():
        names = fields(header)
        taken = {c: next((n for n in known if n in names), None) for c, known in columns.items()}
        lacking = [c for c, n in taken.items() if n is None]
        if lacking or len(set(names)) < len(names):
            raise ValueError(f"unknown header {header!r} in {paths[0]}: " + (f"nothing for {', '.join(lacking)}" if lacking else "a name stands twice"))
        schema = ", ".join(f"`{n}` string" for n in names)
        read = spark.read.option("header", True).option("enforceSchema", True).schema(schema).csv(paths)
        reads.append(read.select(F.col("_metadata.file_name").alias("file_name"), *[F.col(f"`{n}`").alias(c) for c, n in taken.items()]))
    if not reads:
        return spark.createDataFrame([], "file_name string, " + ", ".join(f"`{c}` string" for c in columns))
    return panel.union_sources(*reads)


def read_snapshots(spark: SparkSession, path: str, names: Sequence[str] = RANK_NAMES) -> DataFrame:
    """player_code, snapshot_date, ranking of rankings_YYYY-MM-DD.csv files; each file's rank column may have any of the
    names, in any place. What is no number is a null ranking, a name without a date a null date."""
    raw = read_by_header(spark, path, {"player_code": ["player_code"], "ranking": names})
    day = F.expr(r"try_cast(regexp_extract(file_name, '(\\d{4}-\\d{2}-\\d{2})', 1) as date)")
    return raw.select("player_code", day.alias("snapshot_date"), F.expr("try_cast(ranking as int)").alias("ranking"))


def write_table(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Replaces a Parquet table; by: partition columns."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("header", True).csv(path)
