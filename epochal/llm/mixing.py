"""Mixing sources to target weights by a low-discrepancy schedule.

Golden-ratio points are mapped through the cumulative shares of the sources, so that every
stretch of the schedule holds each source near its share. The slots of a source are ranked, its
documents are laid in shuffled order on a line of words, the line is cut into blocks of one size,
and the block of rank k goes to the slot of rank k. A source takes what its slots draw: as many
blocks as points fell into its share (a source that no point falls to has one slot at the end), and
never more than its target, so its words are within a few blocks of the target. A source whose
target exceeds its size is walked again, up to three times.

Defined results: a null text has no words; a null source is a source of its own, last in order;
rows that repeat are documents of their own; documents without words are never taken; an empty
table gives no rows; other columns are not read, and apply hands them on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

#: Weights by place in the order of sources, repeating, and how often a source may be walked.
WEIGHTS, PASSES = (5, 2, 1), 3
#: Words in a block.
BLOCK_WORDS = 128
#: 2^31 and the odd number next to 2^31 / golden ratio; i * GOLDEN mod 2^31 walks all points.
MODULUS, GOLDEN = 2147483648, 1327217885
#: Cells of the unit line in which points meet the shares, and slots ranked at a time.
CELLS, CHUNK = 4096, 65536
#: Parts in which a source's rows meet the source's figures.
SALT = 32


def _sized(docs: DataFrame) -> DataFrame:
    """Slim rows, pinned: each text is read once here."""
    doc_id, source = F.col("doc_id"), F.col("source")
    return docs.select(
        doc_id,
        common.row_key(doc_id, F.col("text")).alias("rid"),
        F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source)).alias("src"),
        common.n_words(F.col("text")).alias("size"),
        F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")).alias("shuffle"),
    ).checkpoint()


def targets(sized: DataFrame) -> DataFrame:
    """src, source_size, target, take, line_at, share_at: one row a source.

    Sources are filled in the order of size / weight; those that the common level would lift
    above PASSES times their size stop there, and the rest shares what is left by weight.
    """
    sources = sized.groupBy("src").agg(F.sum("size").alias("source_size"))
    n = len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % n + 1).cast("int"))
    scale = F.element_at(F.array(*[F.lit(10 // w) for w in WEIGHTS]), (F.col("place") % n + 1).cast("int"))
    sources = common.running_totals(sources, [F.col("src")], {"place": F.lit(1), "line_at": F.col("source_size")})
    sources = sources.withColumns({"weight": weight.cast("long"), "fill": F.col("source_size") * scale, "cap": F.col("source_size") * PASSES})
    sources = common.running_totals(sources, [F.col("fill"), F.col("src")], {"cap_before": F.col("cap"), "weight_before": F.col("weight")}).checkpoint()
    total, weights = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    left, over = F.lit(total) - F.col("cap_before"), F.lit(weights) - F.col("weight_before")
    capped = left * F.col("weight") > F.col("cap") * over
    level = sources.filter(~capped).agg(F.max(left.cast("double") / over)).first()[0] or 0.0
    target = F.when(capped, F.col("cap").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    sources = sources.select("src", "source_size", "line_at", target.alias("target"), F.floor(target + 0.5).cast("long").alias("take"))
    return common.running_totals(sources, [F.col("src")], {"share_at": F.col("take")}).checkpoint()


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, src, rank: which source each slot of the mix draws from, and its how-manieth slot that is."""
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("take"), F.lit(0))).first()[0]
    slots = -(-total // block_words)
    fine = (F.expr(f"id div {MODULUS}") * GOLDEN % MODULUS + 0.5) / MODULUS  # later walks over all points fall between them
    point = (F.col("id") % MODULUS * GOLDEN % MODULUS + fine) / MODULUS
    cell = lambda x: F.floor(x.cast("double") / max(total, 1) * CELLS)
    at = F.floor(point * total).cast("long")
    points = spark.range(slots).select(F.col("id").alias("slot"), at.alias("at")).withColumn("cell", cell(F.col("at")))
    shares = sources.filter("take > 0").withColumn("ends", F.col("share_at") + F.col("take"))
    shares = shares.select("src", "share_at", "ends", F.explode(F.sequence(cell(F.col("share_at")), cell(F.col("ends") - 1))).alias("cell"))
    drawn = points.join(shares, "cell").filter("at >= share_at and at < ends").select("slot", "src")
    missed = sources.filter("take > 0").join(drawn.select("src").distinct(), "src", "left_anti")  # a share below any slot still gets one
    drawn = drawn.unionByName(missed.select((F.lit(slots) + F.col("share_at")).alias("slot"), "src"))
    drawn = drawn.withColumn("chunk", F.floor(F.col("slot") / CHUNK)).checkpoint()
    chunks = drawn.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("src", "chunk", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1
    return drawn.withColumn("_rank", rank).join(chunks, ["src", "chunk"]).select("slot", "src", (F.col("before") + F.col("_rank")).alias("rank"))


def lines(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with their place (starts, in words) on the shuffled line of their source."""
    tied = sized.withColumn("tie", F.monotonically_increasing_id())  # of pinned rows: a row that repeats is spread over parts
    placed = common.running_totals(tied, [F.col(c) for c in ("src", "shuffle", "doc_id", "size", "tie")], {"at": F.col("size")})
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("doc_id", "at"), F.lit(SALT)).cast("int")).join(salted, ["src", "salt"])
    return placed.select("doc_id", "rid", "src", "size", "source_size", "target", "take", (F.col("at") - F.col("line_at")).alias("starts"))


def mix(placed: DataFrame, slots: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, src, doc_id, starts, walk, first_word, words: the pieces that the slots draw."""
    walks = placed.filter("size > 0 and take > 0").withColumn("walk", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))))
    walks = walks.withColumn("lo", F.col("starts") + F.col("walk") * F.col("source_size")).filter("lo < take")
    walks = walks.withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("take")))
    pieces = walks.withColumn("rank", F.explode(F.sequence(F.expr(f"lo div {block_words}"), F.expr(f"(hi - 1) div {block_words}"))))
    first, last = F.greatest(F.col("lo"), F.col("rank") * block_words), F.least(F.col("hi"), (F.col("rank") + 1) * block_words)
    return pieces.join(slots, ["src", "rank"]).select("slot", "src", "doc_id", "starts", "walk", (first - F.col("lo")).alias("first_word"), (last - first).alias("words"))


def mixed(docs: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The documents with their places, and the pieces of the mix."""
    common.prepare(docs.sparkSession)
    sized = _sized(docs)
    sources = targets(sized)
    placed = lines(sized, sources)
    return placed, mix(placed, schedule(sources, block_words), block_words)


def taken(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, slots (that drew from it), first_slot (null for none)."""
    placed, pieces = mixed(docs, block_words)
    sums = pieces.groupBy("src", "starts").agg(F.sum("words").alias("taken"), F.count("slot").alias("slots"), F.min("slot").alias("first_slot"))
    sums = sums.withColumn("has", F.lit(True))
    out = placed.withColumn("has", F.col("size") > 0).join(sums, ["src", "starts", "has"], "left")
    return out.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), F.coalesce("taken", F.lit(0)).alias("taken"), F.coalesce("slots", F.lit(0)).alias("slots"), "first_slot")


def apply(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs in the order of the slots that draw them: a row comes once for each walk of which slots
    take over half of its words, at the first of these slots.

    Rows that repeat share their walks evenly, rounded.
    """
    spark = docs.sparkSession
    placed, pieces = mixed(docs, block_words)
    places = placed.filter("size > 0").select("src", "starts", "size", "rid")
    got = pieces.groupBy("src", "starts", "walk").agg(F.sum("words").alias("got"), F.min("slot").alias("slot")).join(places, ["src", "starts"])
    of_walk = got.filter(F.col("got") * 2 > F.col("size")).groupBy("rid", "walk").agg(F.count("*").alias("n"), F.min("slot").alias("slot"))
    walks = of_walk.groupBy("rid").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list("slot")).alias("slots"))  # a slot a walk
    copies = placed.groupBy("rid").agg(F.count("*").alias("rows")).join(walks, "rid")
    drawn = F.slice("slots", F.lit(1), F.round(F.col("n") / F.col("rows")).cast("int"))
    copies = copies.select("rid", F.explode(drawn).alias("slot"))
    rows = docs.select(F.struct("*").alias("row"), common.row_key(F.col("doc_id"), F.col("text")).alias("rid"))
    kept = rows.join(copies.hint("shuffle_hash"), "rid").select("slot", "row")
    return kept.repartitionByRange(common.partitions(spark), "slot").sortWithinPartitions("slot").select("row.*")
