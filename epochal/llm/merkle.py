"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces of each text.

Paragraphs are lines, sections are runs of SECTION paragraphs, pieces are the ends of sentences or
runs of 48 characters, and together they are the whole line. Leaves are SHA-256 of pieces; a
paragraph's hash is a SHA-256 over its leaves, a section's over its paragraphs, the root's over the
sections, each with a prefix for its level: equal roots mean equal texts. The likeness of two trees is
the share of leaves that both have. Where roots differ, the first branch that differs locates the edit.

Only DataFrame functions are used: no Python runs on the executors.

Defined results: a null text is an empty text, whose tree has one empty paragraph; two trees
without leaves are alike (1.0) if their roots are equal and unlike (0.0) if not; a table of one
document has itself as next; rows that repeat count once in the order of documents and each gets
the same result; null doc_ids come last in descending order; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Paragraphs in a section.
SECTION = 8
#: Pieces of a line: to the end of a sentence, 48 characters at most.
PIECE = r"[^\n.]{0,48}\.|[^\n.]{1,48}"


def leaves(text: Column) -> Column:
    """SHA-256 of the pieces of each line, an array a line."""
    return F.transform(F.split(text, "\n", -1), lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), lambda x: F.sha2(x.cast("binary"), 256)))


def paragraphs(of_lines: Column) -> Column:
    """SHA-256 over the leaves of each line."""
    return F.transform(of_lines, lambda p: F.sha2(F.concat(F.lit("P"), F.array_join(p, "")).cast("binary"), 256))


def sections(paragraph_hashes: Column) -> Column:
    """SHA-256 of each run of SECTION paragraph hashes."""
    last = F.floor((F.size(paragraph_hashes) - 1) / SECTION).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.sha2(F.concat(F.lit("S"), F.array_join(F.slice(paragraph_hashes, i * SECTION + 1, F.lit(SECTION)), "")).cast("binary"), 256),
    )


def root(section_hashes: Column) -> Column:
    return F.sha2(F.concat(F.lit("R"), F.array_join(section_hashes, "")).cast("binary"), 256)


def names(of_lines: Column) -> Column:
    """The set of a tree's leaves, by 64 bits of each hash."""
    return F.array_distinct(F.transform(F.flatten(of_lines), lambda x: F.xxhash64(x)))


def likeness(a: Column, b: Column, equal_roots: Column) -> Column:
    """Shared leaves against all leaves, 0 to 1."""
    shared = F.size(F.array_intersect(a, b))
    both = F.size(a) + F.size(b) - shared
    return F.when(both > 0, shared / both).otherwise(equal_roots.cast("double"))


def first_difference(a: Column, b: Column) -> Column:
    """Number (from 0) of the first branch in which two lists of hashes differ; null if none does."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    return F.nullif(F.array_position(same, False), F.lit(0)) - 1


def tree(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds <prefix>leaves, <prefix>paragraphs, <prefix>sections, <prefix>root and <prefix>names of a text column."""
    df = df.withColumn(f"{prefix}leaves", leaves(F.col(text)))
    df = df.withColumns({f"{prefix}paragraphs": paragraphs(F.col(f"{prefix}leaves")), f"{prefix}names": names(F.col(f"{prefix}leaves"))})
    df = df.withColumn(f"{prefix}sections", sections(F.col(f"{prefix}paragraphs")))
    return df.withColumn(f"{prefix}root", root(F.col(f"{prefix}sections")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, n_sections, n_paragraphs, fingerprint (the root)."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = tree(base, "text", "")
    return out.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.size("sections").alias("n_sections"), F.size("paragraphs").alias("n_paragraphs"), F.col("root").alias("fingerprint"))


KEY = ["id", "no_id", "h"]


def _neighbours(base: DataFrame) -> DataFrame:
    """KEY, and of the document before in descending order: to_id, to_no_id, to_h, to_half."""
    order = [F.col("no_id"), F.col("id").desc(), F.col("h")]
    ranked = common.running_totals(base.select(*KEY, F.length("text").alias("n")).distinct(), order, {"rank": F.lit(1)}).checkpoint()
    rows = (ranked.agg(F.max("rank")).first()[0] or 0) + 1
    before = ranked.select(((F.col("rank") + 1) % rows).alias("rank"), *[F.col(k).alias(f"to_{k}") for k in KEY], F.floor(F.col("n") / 2).cast("int").alias("to_half"))
    return ranked.join(before, "rank").select(*KEY, *[f"to_{k}" for k in KEY], "to_half")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints every text and its edited form, whose last half is taken from the next document.

    Texts move once, dealt by row; each row then sends its head, its root and the names of its leaves to
    the one document that it is next of.
    """
    common.prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(text.alias("text"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), F.xxhash64(text).alias("h"))
    near = _neighbours(base)
    ahead = base.join(near.hint("shuffle_hash"), KEY)  # the same columns as in the join below: one exchange serves both
    ahead = ahead.select(*[F.col(f"to_{k}").alias(k) for k in KEY], F.expr("left(text, to_half)").alias("head"), "text")
    ahead = tree(ahead, "text", "next_").select(*KEY, "head", "next_names", "next_root")
    ahead = ahead.dropDuplicates(KEY)
    joined = base.join(ahead, KEY).select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "text", "head", "next_names", "next_root", F.length("text").alias("n"))
    joined = joined.withColumn("edited", F.expr("concat(left(text, n - n div 2), head)"))
    both = tree(tree(joined, "text", "a_"), "edited", "b_")
    return both.select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("a_root").alias("fingerprint"),
        F.col("b_root").alias("edited_fingerprint"),
        F.round(likeness(F.col("a_names"), F.col("b_names"), F.col("a_root") == F.col("b_root")), 9).alias("near_edited"),
        F.round(likeness(F.col("a_names"), F.col("next_names"), F.col("a_root") == F.col("next_root")), 9).alias("near_next"),
        F.size("a_sections").cast("long").alias("n_sections"),
        F.size("a_paragraphs").cast("long").alias("n_paragraphs"),
        first_difference(F.col("a_sections"), F.col("b_sections")).alias("changed_section"),
        first_difference(F.col("a_paragraphs"), F.col("b_paragraphs")).alias("changed_paragraph"),
    )
