"""Incremental maintenance: change hashes, upserts, entity merges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epochal import session


def change_hash(columns: Sequence[str | Column]) -> Column:
    """64-bit hash of a row's values in order, each value on its own; a null is unlike an empty text and keeps its place."""
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(*[x for v in values for x in (v.isNull(), v)])


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row a key, the first in order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], policy: dict[str, Column] | None = None, insert: bool = True) -> DataFrame:
    """Target after merging source rows in, with a column action: insert, update or noop.

    The new value of a column is the source's, or the target's where that is null; policy gives
    other rules as columns over old.<name> and new.<name>. A row whose merged values are as before
    (a null equals a null only) is a noop. Both sides hold a key once.
    """
    values = [c for c in target.columns if c not in keys]
    policy = policy or {}
    old = target.select(*keys, F.struct(*values).alias("old"), F.lit(True).alias("_old"))
    new = source.select(*keys, F.struct(*[F.col(c) if c in source.columns else F.lit(None).cast(dict(target.dtypes)[c]).alias(c) for c in values]).alias("new"), F.lit(True).alias("_new"))
    both = old.join(new, list(keys), "full" if insert else "left")
    merged = [F.when(F.col("_new").isNull(), F.col(f"old.{c}")).otherwise(policy.get(c, F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")))).alias(c) for c in values]
    both = both.select("*", F.struct(*merged).alias("_merged"))
    differs = ~reduce(and_, [F.col(f"_merged.{c}").eqNullSafe(F.col(f"old.{c}")) for c in values], F.lit(True))
    action = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNotNull() & differs, "update").otherwise("noop")
    return both.select(*keys, "_merged.*", action.alias("action"))


def longer(column: str) -> Column:
    """A policy: the longer text counts, the old one of two as long; a null is the shortest."""
    length = lambda c: F.coalesce(F.length(c), F.lit(-1))
    return F.when(length(f"new.{column}") > length(f"old.{column}"), F.col(f"new.{column}")).otherwise(F.col(f"old.{column}"))


def replace_code(df: DataFrame, column: str, codes: DataFrame, old: str = "old_code", new: str = "new_code", texts: Sequence[str] = ()) -> DataFrame:
    """Repoints a column of codes by a map; texts: columns of ids that contain the code, in which it is replaced too."""
    pairs = codes.select(F.col(old).alias(column), F.col(new).alias("_to"))
    inside = {t: F.when(F.col("_to").isNotNull(), F.replace(t, F.col(column).cast("string"), F.col("_to").cast("string"))).otherwise(F.col(t)) for t in texts}
    return df.join(pairs, column, "left").withColumns({**inside, column: F.coalesce("_to", column)}).select(*df.columns)


def resolved(codes: DataFrame, old: str = "old_code", new: str = "new_code", most: int = 40) -> DataFrame:
    """The map with chains followed to their ends, in steps that double; an error if a chain comes back to itself."""
    now = session.pinned(codes.select(F.col(old).alias("_old"), F.col(new).alias("_new")).filter("_old <> _new"))
    for _ in range(most):
        step = now.alias("a").join(now.alias("b"), F.col("a._new") == F.col("b._old"), "left")
        after = session.pinned(step.select(F.col("a._old").alias("_old"), F.coalesce("b._new", "a._new").alias("_new"), F.col("b._new").isNotNull().alias("_more")))
        if after.filter("_more").isEmpty():
            return after.select(F.col("_old").alias(old), F.col("_new").alias(new))
        if not after.filter("_old = _new").isEmpty():
            break
        now = after.drop("_more")
    raise ValueError("the map of codes has a cycle")


def merge_entities(entities: DataFrame, codes: DataFrame, key: str, old: str = "old_code", new: str = "new_code") -> DataFrame:
    """Entities after each old code is merged into its new one: nulls filled from it, the old row gone.

    Chains of codes are followed. Of several old rows of one new code the smallest code's value counts
    that is not null. Where there is no row of the new code, the old ones make it.
    """
    values = [c for c in entities.columns if c != key]
    pairs = resolved(codes, old, new)
    gone = entities.join(pairs.select(F.col(old).alias(key), F.col(new).alias("_to")), key)
    gone = gone.groupBy(F.col("_to").alias(key)).agg(F.struct(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(key))).alias(c) for c in values]).alias("_from"))
    left = entities.join(pairs.select(F.col(old).alias(key)), key, "left_anti").select(key, F.struct(*values).alias("_own"))
    return left.join(gone, key, "full").select(key, *[F.coalesce(F.col(f"_own.{c}"), F.col(f"_from.{c}")).alias(c) for c in values])


def replace_tokens(id_: Column, pairs: Column, mark: str = "-") -> Column:
    """An id whose tokens between marks are codes: those that the map has are replaced, parts of other tokens are not."""
    return F.array_join(F.transform(F.split(id_, mark), lambda t: F.coalesce(F.try_element_at(pairs, t), t)), mark)


def merge_everywhere(catalog, codes: DataFrame, entity: tuple[str, str], uses: dict[str, dict], old: str = "old_code", new: str = "new_code", note: str | None = None) -> dict[str, int]:
    """Merges entities in all tables of a catalog, in one commit; how many rows changed in each.

    entity: table and key whose old rows are merged into the new ones, as by merge_entities. uses: for each
    other table the columns that hold a code (codes), the id columns with codes among their tokens
    (ids, found by the columns named in codes or, where there are none, by their tokens), and a column with the
    hash of others (hash: (name, columns)), which is made anew. If any table fails, none has changed.
    """
    now, versions, changed = catalog.now(), {}, {}
    pairs = session.pinned(resolved(codes, old, new).select(F.col(old).cast("string").alias("_old"), F.col(new).cast("string").alias("_new")))
    name, key = entity
    rows = catalog.read(name)
    taken = pairs.select(F.explode(F.array("_old", "_new")).alias("_old")).distinct()
    family = session.pinned(rows.join(taken, rows[key].cast("string") == taken["_old"], "left_semi"))
    kind = dict(rows.dtypes)[key]
    merged = merge_entities(family, pairs.select(F.col("_old").cast(kind).alias("o"), F.col("_new").cast(kind).alias("n")), key, "o", "n")
    versions[name] = catalog.tables[name].rewrite(family, merged, now[name])["version"]
    changed[name] = family.count()
    for name, spec in uses.items():
        table, rows = catalog.tables[name], catalog.read(name).withColumn("_row", F.struct("*"))
        found = [F.col(c).cast("string") for c in spec.get("codes", ())]
        tokens = F.array(*found) if found else F.flatten(F.array(*[F.split(c, "-") for c in spec["ids"]]))
        hits = rows.withColumn("_old", F.explode(F.array_distinct(tokens))).join(pairs, "_old")
        each = hits.groupBy("_row").agg(F.map_from_entries(F.collect_set(F.struct("_old", "_new"))).alias("_map"))  # a row's codes are few
        hits = session.pinned(each.select("_row.*", "_map"))
        kinds = dict(hits.dtypes)
        moved = {c: F.coalesce(F.try_element_at("_map", F.col(c).cast("string")).cast(kinds[c]), F.col(c)) for c in spec.get("codes", ())}
        moved |= {c: replace_tokens(F.col(c), F.col("_map")) for c in spec.get("ids", ())}
        after = hits.withColumns(moved).drop("_map")
        if "hash" in spec:
            after = after.withColumn(spec["hash"][0], change_hash(spec["hash"][1]))
        versions[name] = table.rewrite(hits.drop("_map"), after, now[name])["version"]
        changed[name] = hits.count()
    catalog.commit(versions, note)
    return changed
