"""Tables of a database over JDBC: reads in ranges whose bounds are asked for first, loads by a staging table.

The driver's own connection carries a few statements only (bounds, the swap); rows go between executors and
the database.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from epochal.sources import files

#: Rows that a read takes at a time.
FETCH = 200_000


def _ask(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    given = {"url": url, "query": query, **options}
    return spark.read.format("jdbc").options(**{k: str(v) for k, v in given.items()}).load()


def read_query(spark: SparkSession, url: str, query: str, column: str, parts: int, fetch: int = FETCH, **options) -> DataFrame:
    """A query's rows, read in so many ranges of a number or date column; its bounds are found by one query of two values.
    Rows whose column is null are in the first range. Without rows, or with one value only, there is one range."""
    low, high = _ask(spark, url, f"select min({column}) as low_end, max({column}) as high_end from ({query}) q", **options).first()
    given = {"url": url, "dbtable": f"({query}) q", "fetchsize": fetch, **options}
    if low is not None and low != high:
        given |= {"partitionColumn": column, "lowerBound": low, "upperBound": high, "numPartitions": parts}
    return spark.read.format("jdbc").options(**{k: str(v) for k, v in given.items()}).load()


@contextmanager
def transaction(spark: SparkSession, url: str):
    """A function that runs statements, all of them or, if one fails, none."""
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    connection.setAutoCommit(False)
    statement = connection.createStatement()
    try:
        yield statement.executeUpdate
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        statement.close()
        connection.close()


def load(df: DataFrame, url: str, table: str, keys: Sequence[str] = (), parts: int | None = None) -> int:
    """Replaces a table's rows; how many there are now.

    Rows go to <table>_staging first. Then, in one transaction, the table is emptied and filled from there by the
    columns that both have; a failure before or in it leaves the table as it was. A table that does not exist is
    made with the columns of df. keys: columns that must not repeat or be null, checked before the swap.
    """
    spark = df.sparkSession
    staging = f"{table}_staging"
    write = (df.coalesce(parts) if parts else df).write.format("jdbc").option("url", url)
    write.option("dbtable", staging).mode("overwrite").save()
    if keys:
        n = _ask(spark, url, f"select count(*) as n from {staging}").first()[0]
        whole = " and ".join(f"{k} is not null" for k in keys)
        apart = _ask(spark, url, f"select count(*) as n from (select distinct {', '.join(keys)} from {staging} where {whole}) d").first()[0]
        if n != apart:
            raise ValueError(f"{n - apart} of {n} rows for {table} repeat {', '.join(keys)} or lack it")
    try:
        _ask(spark, url, f"select * from {table} where 1 = 0").schema  # noqa: B018
    except Exception as absent:
        if "does not exist" not in str(absent):
            raise
        df.limit(0).write.format("jdbc").option("url", url).option("dbtable", table).save()
    names = ", ".join(f'"{c}"' for c in df.columns)
    with transaction(spark, url) as run:
        run(f"delete from {table}")
        return run(f"insert into {table} ({names}) select {names} from {staging}")


def export(spark: SparkSession, url: str, query: str, column: str, path: str, parts: int, order: Sequence[str] = (), fetch: int = FETCH) -> None:
    """Writes a query's rows, read in ranges, as CSV files with headers; order: sorted over all files."""
    files.write_csv(read_query(spark, url, query, column, parts, fetch), path, order)
