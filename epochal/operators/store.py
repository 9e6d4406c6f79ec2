"""Tables in parts under a manifest: a merge rewrites only the parts that its rows touch.

A table is a folder. Its rows lie in data/<write>/_part=<part>, a part being a bucket of the keys' hash or the
value of a column (a day); manifest/v<number> names the paths of all parts of a version. A write adds files
under a new name and then commits a manifest, made aside and renamed in one step. Until then readers see the
version before, and if a write breaks off, its files are named by none. Two writers of one version can't both
commit: the second raises, and its caller reads again and repeats the merge.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from epochal import session
from epochal.operators import merge

MANIFEST = "part string, path string, rows long, note string"


class Conflict(RuntimeError):
    """Another writer has committed the version first."""


class Store:
    """keys: what a row is known by; by: the column whose value is a row's part, or a number of buckets."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], by: str | int):
        self.spark, self.folder, self.keys, self.by = spark, folder.rstrip("/"), list(keys), by

    def part(self) -> Column:
        """A row's part, as text; a null column is a part of its own."""
        if isinstance(self.by, int):
            return F.format_string("b%05d", F.pmod(F.xxhash64(*self.keys), F.lit(self.by)))
        return F.coalesce(F.col(self.by).cast("string"), F.lit("none"))

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        path, fs = self._path("manifest")
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n[1:]) for n in names if n[0] == "v" and n[1:].isdigit())

    def manifest(self, version: int | None = None) -> dict[str, dict]:
        """The parts of a version (the last one): a row each, as many as buckets or days."""
        at = self.versions()
        if not at:
            return {}
        version = at[-1] if version is None else version
        return {r.part: r.asDict() for r in self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest/v{version}").collect() if r.part is not None}

    def read(self, version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version, or of some of its parts, without reading others."""
        entries = self.manifest(version)
        paths = [e["path"] for p, e in sorted(entries.items()) if (parts is None or p in set(parts)) and e["rows"]]
        schema = self.spark.read.parquet(f"{self.folder}/schema").schema
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame) -> tuple[dict[str, dict], dict]:
        """Files of the rows' parts: entries of a manifest, and what was seen of their column action.
        Parts are rebalanced, so that a large one gets several files from several tasks."""
        place, seen = f"{self.folder}/data/{uuid.uuid4().hex}", Observation()
        counted = rows if "action" in rows.columns else rows.withColumn("action", F.lit("insert"))
        counted = counted.observe(seen, *[F.coalesce(F.sum((F.col("action") == a).cast("long")), F.lit(0)).alias(a) for a in ("insert", "update", "noop")])
        counted.drop("action").withColumn("_part", self.part()).hint("rebalance", "_part").write.partitionBy("_part").parquet(place)
        path, fs = self._path(place.removeprefix(f"{self.folder}/"))
        if not [s for s in fs.listStatus(path) if s.isDirectory()]:
            return {}, dict.fromkeys(("insert", "update", "noop"), 0)  # no rows: nothing was observed
        counts = self.spark.read.option("basePath", place).parquet(place).groupBy(F.col("_part").cast("string").alias("part")).count().collect()  # a row a part
        return {r.part: {"part": r.part, "path": f"{place}/_part={r.part}", "rows": r["count"]} for r in counts}, seen.get

    def _commit(self, entries: dict[str, dict], after: int, note: str | None) -> int:
        rows = [(e["part"], e["path"], e["rows"], note) for e in entries.values()] or [(None, None, 0, note)]
        aside = f"manifest/_{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{self.folder}/{aside}")
        made, fs = self._path(aside)
        target, _ = self._path(f"manifest/v{after + 1}")
        if fs.exists(target) or not fs.rename(made, target):
            raise Conflict(f"version {after + 1} of {self.folder} is there already")
        return after + 1

    def note(self) -> str | None:
        """The note of the last version."""
        at = self.versions()
        return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest/v{at[-1]}").first().note if at else None

    def create(self, rows: DataFrame, note: str | None = None) -> int:
        """Version 0."""
        rows.limit(0).write.mode("overwrite").parquet(f"{self.folder}/schema")
        entries, _ = self._write(rows)
        return self._commit(entries, -1, note)

    def touched(self, rows: DataFrame) -> list[str]:
        """The parts that rows belong to."""
        return [r.part for r in rows.select(self.part().alias("part")).distinct().collect()]  # no more than there are parts

    def merge(self, source: DataFrame, policy: dict[str, Column] | None = None, insert: bool = True, note: str | None = None) -> dict:
        """Upserts rows (one a key) into the parts that they touch; all other files stay as they are. A key's part never
        changes: by a column, that column belongs to the key. Returns version, parts, insert, update, noop."""
        after, source = self.versions()[-1], session.pinned(source)
        parts = self.touched(source)
        merged = merge.upsert(self.read(after, parts), source, self.keys, policy, insert)
        return self._replaced(after, parts, merged, note)

    def replace(self, rows: DataFrame, parts: Sequence[str], note: str | None = None) -> dict:
        """Puts rows in the place of some parts; a part without rows is empty afterwards."""
        return self._replaced(self.versions()[-1], parts, rows, note)

    def _replaced(self, after: int, parts: Sequence[str], rows: DataFrame, note: str | None) -> dict:
        entries = self.manifest(after)
        new, seen = self._write(rows)
        if strange := set(new) - set(parts):
            raise ValueError(f"rows of other parts than those replaced: {sorted(strange)[:5]}")
        kept = {p: e for p, e in entries.items() if p not in set(parts)}
        return {"version": self._commit(kept | new, after, note), "parts": len(parts), **seen}

    def rewrite(self, gone: DataFrame, rows: DataFrame, version: int | None = None, note: str | None = None) -> dict:
        """Takes out the rows whose keys are in gone and puts rows in, which may belong to other parts; only parts of either
        are written. version: the one to go on from (the last)."""
        after = self.versions()[-1] if version is None else version
        gone, rows = session.pinned(gone.select(*self.keys)), session.pinned(rows)
        parts = sorted({*self.touched(gone), *self.touched(rows)})
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self.keys]
        left = self.read(after, parts).alias("a").join(gone.distinct().alias("b"), same, "left_anti")
        entries = self.manifest(after)
        new, _ = self._write(left.unionByName(rows.select(*left.columns)))
        kept = {p: e for p, e in entries.items() if p not in set(parts)}
        return {"version": self._commit(kept | new, self.versions()[-1], note), "parts": len(parts)}

    def vacuum(self, keep: int = 1) -> int:
        """Removes all versions but the last ones, and files that none of these names; how many folders went.
        Not while others write: their files are not named yet."""
        versions = self.versions()
        named = {e["path"].rsplit("/", 1)[0].rsplit("/", 1)[-1] + "/" + e["path"].rsplit("/", 1)[-1] for v in versions[-keep:] for e in self.manifest(v).values()}
        gone = 0
        data, fs = self._path("data")
        for write in fs.listStatus(data) if fs.exists(data) else []:
            for part in fs.listStatus(write.getPath()):
                if part.isDirectory() and f"{write.getPath().getName()}/{part.getPath().getName()}" not in named:
                    gone += fs.delete(part.getPath(), True)
        for v in versions[:-keep]:
            fs.delete(self._path(f"manifest/v{v}")[0], True)
        return gone


class Catalog:
    """Several tables that change together: a version of the catalog names a version of each. A change writes new
    versions of its tables, which nobody sees who reads by the catalog, and is there at once with the catalog's commit."""

    def __init__(self, folder: str, tables: dict[str, Store]):
        self.folder, self.tables = folder.rstrip("/"), tables
        self.spark = next(iter(tables.values())).spark

    def _log(self) -> Store:
        return Store(self.spark, f"{self.folder}/catalog", ["part"], 1)

    def now(self) -> dict[str, int]:
        """The version of each table in the last version of the catalog."""
        return {p: e["rows"] for p, e in self._log().manifest().items()}

    def commit(self, versions: dict[str, int], note: str | None = None) -> int:
        log = self._log()
        at = log.versions()
        after = self.now() | versions
        return log._commit({t: {"part": t, "path": "", "rows": v} for t, v in after.items()}, at[-1] if at else -1, note)

    def read(self, table: str) -> DataFrame:
        return self.tables[table].read(self.now()[table])


def newest(columns: Sequence[str], since: Sequence[str]) -> dict[str, Column]:
    """A policy for merge: a source row counts, nulls included, if it comes after the one that is there by the columns of since."""
    later = F.struct(*[F.col(f"new.{c}") for c in since]) > F.struct(*[F.col(f"old.{c}") for c in since])
    return {c: F.when(F.col("_old").isNull() | later, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) for c in columns}


def restate(table: Store, features: Store, batch: DataFrame, order: Sequence[str], build, horizon: int = 22, note: str | None = None) -> dict:
    """Takes a batch of rows, new and restated ones, into a table by days, and makes the features of its days anew.

    The table's last day is the watermark: rows of days more than horizon before it come too late; they are
    added to late/ in the table's folder and change nothing. Of a key's rows the last by order counts,
    in whatever batches they come. build gets all rows of the touched days and gives their features;
    features of other days are neither read nor written. Returns taken, late, days.
    """
    batch = session.pinned(batch)
    days = [p for p in table.manifest() if p != "none"]
    known = F.col(table.by)
    on_time = F.coalesce(known >= F.date_sub(F.lit(max(days)).cast("date"), horizon), F.lit(False)) if days else known.isNotNull()
    late = batch.filter(~on_time)
    n_late = late.count()
    if n_late:
        late.write.mode("append").parquet(f"{table.folder}/late")
    taken = merge.first_rows(batch.filter(on_time), table.keys, [F.desc(c) for c in order])
    parts = table.touched(taken)
    if parts:
        columns = [c for c in table.read().columns if c not in table.keys]
        table.merge(taken, newest(columns, order), note=note)
        features.replace(build(table.read(parts=parts)), parts, note=note)
    return {"taken": batch.count() - n_late, "late": n_late, "days": len(parts)}
