"""MinHash near-duplicates by an LSH forest.

A text's set holds its distinct word shingles. Texts with equal sets are one class, of which the
smallest doc_id goes on. Each class gives TREES signatures of DEPTH minhashes; each tree sorts its
signatures, so that the neighbours of a row are those with the longest common prefix. Of each minhash
the last 16 bits are kept, as two planes of bytes: low ones (the sketch) and high ones. Rows that share
the first LEAST minhashes are a region. In a sparse region every pair is a candidate; in a dense one
the order deepens until the rows within WINDOW places are left, of which each row takes the first of
the region and those that agree with it in most of all minhashes. Pairs whose agreement is five
deviations below the least similarity are no candidates. Every candidate is confirmed on the full sets.

Candidates are made in two rounds. The first takes the best of each row in a few trees; what it links
is joined into components. The second takes all trees, between different components only, so that
large groups of near copies, already joined, cost few pairs. Components spread by smallest
neighbours until nothing changes; nothing of it passes the driver.

A third round makes dense regions exact. Of each dense region that still holds more than one component,
all rows are joined on the first common shingle that a pair above the least similarity must have: the
shingles are ordered by how many rows of this round have them, rarest first (any order gives the same
links), those of one component only come before all others and are never dealt. Shingles of many rows
are dealt in cells, each of two shares of the rows, so that no task gets all rows of one.

At the least similarity of 0.85, two texts that meet in no region of any of the 24 trees have a chance
of 2e-8 (3e-6 at 0.80). Texts that meet in a sparse region are candidates but for five deviations of
their agreement; texts that meet in dense ones only are found by the third round, without exception.

Defined results: a null or empty text, or one without words, has no shingles and is linked with
nothing; with fewer words than a shingle the whole sequence is one; rows that repeat share a
component; a null doc_id is never the smallest of a component unless it has no other, which is then
null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Words in a shingle and least similarity in hundredths, where a contract sets no others.
SHINGLE, LEAST_HUNDREDTHS = 5, 80
#: Trees, minhashes in a tree's signature, minhashes that a candidate pair shares at least.
TREES, DEPTH, LEAST = 24, 8, 4
#: Places after a row that are tried, rows of a sparse region, candidates of a row in a dense one,
#: trees of the first round, rows of a block of the order.
WINDOW, SPARSE, BEST, FIRST_TREES, BLOCK = 48, 12, 4, 4, 8192
#: How far below the least similarity the agreement of a candidate pair's minhashes may be: five deviations.
SLACK = 0.13
#: Links that a task joins into stars before the rounds.
PART_LINKS = 1 << 20
#: Ids that are broadcast at most (some tens of MB).
BROADCAST_IDS = 500_000
#: Third round: bits of the table of shingle counts, rows of a share of a shingle, rows of a part of the work.
COUNT_BITS, SHARE, PART_ROWS = 21, 2048, 1 << 20
_TURN = np.random.default_rng(2024).integers(1, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype("u4") | np.uint32(1)
_SHIFT = np.random.default_rng(2025).integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype("u4")


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles, A-Z lower-cased."""
    words = common.lower_words(text)
    if not words:
        return np.zeros(0, "u8")
    at, width = common.word_hashes(words), min(size, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(at) - width + 1, len(words) if len(words) < size else 0, "u8")
        for k in range(width):
            out = (out ^ at[k : len(at) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """TREES x DEPTH minhashes of a set of 64-bit hashes."""
    h = (found >> np.uint64(32)).astype("u4") ^ found.astype("u4")
    low = np.full(TREES * DEPTH, 0xFFFFFFFF, "u4")
    for lo in range(0, len(h), 1024):
        low = np.minimum(low, (h[lo : lo + 1024, None] * _TURN + _SHIFT).min(0))
    return low.reshape(TREES, DEPTH)


def sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, class (128-bit digest of the set), sketch and high (the low and the next byte of each
    minhash); the last three are null for a text without a set. Each text is read once here."""

    def extract(batches):
        for batch in batches:
            out = {"n": [], "class": [], "sketch": [], "high": []}
            for t in batch.column("text").to_pylist():
                found = shingles(t, size)
                some = len(found) > 0
                path = signature(found) if some else None
                out["n"].append(len(found))
                out["class"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if some else None)
                out["sketch"].append(path.astype("u1").tobytes() if some else None)
                out["high"].append((path >> np.uint32(8)).astype("u1").tobytes() if some else None)
            arrays = [pa.array(out["n"], pa.int64()), *[pa.array(out[c], pa.binary()) for c in ("class", "sketch", "high")]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_shingles", "class", "sketch", "high"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(extract, "doc_id long, n_shingles long, class binary, sketch binary, high binary")


def classes_of(rows: DataFrame) -> DataFrame:
    """class, node (64-bit), rep (smallest doc_id), n, sketch, high: equal sets are one class."""
    same = lambda c: F.first(c).alias(c)  # noqa: E731  equal within a class
    found = rows.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), same("sketch"), same("high"))
    return found.withColumn("node", F.xxhash64("class")).checkpoint()


def forest(classes: DataFrame) -> DataFrame:
    """node, n, tree, path, region (a number if it is dense, else null): rows of the trees whose region has other rows too.

    A path holds two bytes of each of DEPTH minhashes: both planes of the first LEAST, then both of the rest.
    """
    rows = classes.select("node", "n", "sketch", "high", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    plane = "substring({0}, tree * {1} + {2}, {3})"
    spans = [(c, DEPTH, at, width) for at, width in ((1, LEAST), (LEAST + 1, DEPTH - LEAST)) for c in ("sketch", "high")]
    rows = rows.select("node", "n", "tree", F.concat(*[F.expr(plane.format(*x)) for x in spans]).alias("path"))
    rows = rows.withColumn("key", F.xxhash64("tree", F.expr(f"substring(path, 1, {2 * LEAST})")))
    shared = rows.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1")
    return rows.join(shared, "key").select("node", "n", "tree", "path", F.when(F.col("rows") > SPARSE, F.col("key")).alias("region"))


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, text and the columns of wanted (rep, ...) for the rows whose doc_id is a rep.

    Few ids are broadcast, more are not: then the texts are dealt.
    """
    few = wanted.count() <= BROADCAST_IDS
    side = F.broadcast(wanted) if few else wanted.hint("shuffle_hash")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.join(side, rows["doc_id"].eqNullSafe(side["rep"])).drop("rep")


def ordered(trees: DataFrame) -> DataFrame:
    """The rows of all trees in one order, which a checkpoint pins, dealt in blocks that overlap by a window."""
    placed = common.numbered(trees, [F.col("tree"), F.col("path"), F.col("node")], "place")
    block = F.floor(F.col("place") / BLOCK)
    spread = F.when((F.col("place") % BLOCK < WINDOW) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    return placed.withColumn("block", F.explode(spread))


def candidates(blocks: DataFrame, nodes: DataFrame, trees: int, best: int, least_hundredths: int, component: str | None) -> DataFrame:
    """a, b: distinct candidate pairs of different components, of sizes that allow a link. nodes: node, sketch, component."""
    least = least_hundredths / 100 - SLACK

    def pairs(group: pa.Table) -> pa.Table:
        order = np.argsort(group["place"].to_numpy())
        node, n, tree = (group[c].to_numpy()[order] for c in ("node", "n", "tree"))
        of = group[component].to_numpy()[order] if component else node
        path = np.frombuffer(b"".join(group["path"].to_pylist()), "u1").reshape(-1, 2 * DEPTH)[order]
        sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), "u1").reshape(-1, TREES * DEPTH)[order]
        same = (path[1:, : 2 * LEAST] == path[:-1, : 2 * LEAST]).all(1) & (tree[1:] == tree[:-1])
        region = np.concatenate([[0], np.cumsum(~same)])
        first = np.concatenate([[0], np.flatnonzero(~same) + 1])[region]
        sparse = np.bincount(region)[region] <= SPARSE
        found = [(np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0))]

        def take(i, j):
            low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            good = (of[i] != of[j]) & (100 * low >= least_hundredths * high)
            i, j = i[good], j[good]
            likeness = (sketch[i] == sketch[j]).mean(1)
            good = likeness >= least
            found.append((i[good], j[good], likeness[good]))

        far = np.flatnonzero(np.arange(len(node)) - first > WINDOW)
        take(first[far], far)
        for step in range(1, min(WINDOW, len(node) - 1) + 1):
            hit = np.flatnonzero(region[step:] == region[:-step])
            if not len(hit):
                break
            take(hit, hit + step)
        i, j, likeness = (np.concatenate(x) for x in zip(*found, strict=True))
        both = np.concatenate([i, j])  # a pair stays if it is among the best of either row, or in a sparse region
        at = np.lexsort((-np.concatenate([likeness, likeness]), both))
        starts = np.searchsorted(both[at], both[at])
        top = np.zeros(len(both), bool)
        top[at] = np.arange(len(both)) - starts < best
        keep = top[: len(i)] | top[len(i) :] | sparse[i]
        ends = np.unique(np.stack([np.minimum(node[i[keep]], node[j[keep]]), np.maximum(node[i[keep]], node[j[keep]])], 1), axis=0)
        return pa.table({"a": pa.array(ends[:, 0], pa.int64()), "b": pa.array(ends[:, 1], pa.int64())})

    some = blocks.filter(F.col("tree") < trees).drop("region")  # a node has a row for each tree, so it is no hot key
    return some.join(nodes, "node").groupBy("block").applyInArrow(pairs, "a long, b long").distinct()


def crowded(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """node, component: the rows of dense regions that hold more than one component. found: node, component."""
    rows = blocks.filter("region is not null").select("node", "region").join(found.select("node", "component"), "node")
    mixed = rows.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("region").checkpoint()
    few = mixed.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(mixed) if few else mixed, "region", "left_semi").select("node", "component").distinct()


def by_shingles(docs: DataFrame, classes: DataFrame, rows: DataFrame, size: int, least_hundredths: int) -> DataFrame:
    """a, b: all pairs of rows (node, component) of different components that may be so similar, by a prefix filter."""
    spark, shift = docs.sparkSession, np.uint64(64 - COUNT_BITS)
    wanted = classes.select("node", "class", "rep").join(rows, "node").checkpoint()
    texts = texts_of(docs, wanted).select("node", "component", "class", "text")

    def held(batch):
        for node, of, digest, text in zip(*[batch.column(c).to_pylist() for c in ("node", "component", "class", "text")], strict=True):
            found = shingles(text, size)
            if hashlib.blake2b(found.tobytes(), digest_size=16).digest() == digest:
                yield node, of, found

    def count(batches):
        for batch in batches:
            some = list(held(batch))
            if some:
                of = np.repeat(np.array([x[1] for x in some], "i8"), [len(x[2]) for x in some])
                bucket = (np.concatenate([x[2] for x in some]) >> shift).astype("i4")
                order = np.argsort(bucket, kind="stable")
                bucket, of = bucket[order], of[order]
                cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                n = np.diff(np.append(cuts, len(bucket)))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket[cuts], n, np.minimum.reduceat(of, cuts), np.maximum.reduceat(of, cuts))], ["bucket", "n", "low", "high"])

    met = texts.mapInArrow(count, "bucket int, n long, low long, high long").groupBy("bucket").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    met = met.filter("low < high").select("bucket", "n").toArrow()  # at most 2 ** COUNT_BITS rows
    counts = np.zeros(1 << COUNT_BITS, "i8")  # none for the shingles of one component
    counts[met["bucket"].to_numpy()] = met["n"].to_numpy()
    shared = spark.sparkContext.broadcast(counts)

    def prefixes(batches):
        for batch in batches:
            out = [np.zeros((5, 0), "i8")]
            shares = [np.zeros(0, "i4")]
            for node, of, found in held(batch):
                n, seen = len(found), shared.value[found >> shift]
                place = np.arange(n - -(-least_hundredths * n // 100) + 1)
                first = np.lexsort((found, seen))[: len(place)]
                some = seen[first] > 0
                first, place = first[some], place[some]
                out.append(np.stack([found[first].view("i8"), np.full(len(first), node), np.full(len(first), of), np.full(len(first), n), place]))
                shares.append((seen[first] // SHARE + 1).astype("i4"))
            yield pa.RecordBatch.from_arrays([*map(pa.array, np.concatenate(out, 1)), pa.array(np.concatenate(shares))], ["shingle", "node", "component", "n", "place", "shares"])

    def pairs(group: pa.Table) -> pa.Table:
        key = group["key"].to_numpy()
        order = np.argsort(key)
        key, node, of, n, place = key[order], *(group[c].to_numpy()[order] for c in ("node", "component", "n", "place"))
        ends, live, step, found, room = np.searchsorted(key, key, "right"), np.arange(len(key)), 1, [np.zeros((0, 2), "i8")], 1 << 22
        while len(live := live[live + step < ends[live]]):
            i, j = live, live + step
            some = of[i] != of[j]
            i, j, step = i[some], j[some], step + 1
            left = np.minimum(n[i] - place[i], n[j] - place[j])  # common shingles at most, if this is the first
            some = left * (100 + least_hundredths) >= least_hundredths * (n[i] + n[j])
            i, j = node[i[some]], node[j[some]]
            found.append(np.stack([np.minimum(i, j), np.maximum(i, j)], 1))
            room -= len(i)
            if room < 0:
                found, room = [np.unique(np.concatenate(found), axis=0)], 1 << 22
        ends = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": pa.array(ends[:, 0], pa.int64()), "b": pa.array(ends[:, 1], pa.int64())})

    parts = max(common.partitions(spark), -(-int((counts * (counts // SHARE + 1)).sum()) // PART_ROWS))
    dealt = texts.mapInArrow(prefixes, "shingle long, node long, component long, n long, place long, shares int")
    dealt = dealt.select("*", F.pmod(F.xxhash64("node"), "shares").alias("own"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("other"))
    dealt = dealt.select(F.xxhash64("shingle", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "node", "component", "n", "place")
    return dealt.groupBy(F.pmod("key", F.lit(parts)).alias("part")).applyInArrow(pairs, "a long, b long").distinct()


def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, least_hundredths: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are at least so similar."""

    def extract(batches):
        for batch in batches:
            found = [shingles(t, size) for t in batch.column("text").to_pylist()]
            right = [hashlib.blake2b(f.tobytes(), digest_size=16).digest() == c for f, c in zip(found, batch.column("class").to_pylist(), strict=True)]
            packed = pa.array([f.tobytes() for f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), packed], ["node", "held"]).filter(pa.array(right, pa.bool_()))

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, "u8"), np.frombuffer(y, "u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= least_hundredths * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = classes.select("node", "class", "rep").join(ends, "node", "left_semi").checkpoint()
    held = texts_of(docs, wanted).mapInArrow(extract, "node long, held binary").dropDuplicates(["node"]).checkpoint()
    joined = pairs.join(held.select(F.col("node").alias("a"), F.col("held").alias("x")), "a").join(held.select(F.col("node").alias("b"), F.col("held").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def stars(edges: DataFrame, parts: int) -> DataFrame:
    """u, v: the links of each part, dealt evenly, as stars: each node that is not the smallest it reaches there, with that."""

    def join(batches):
        held = [(batch.column("u").to_numpy(), batch.column("v").to_numpy()) for batch in batches]  # PART_LINKS, about
        if held:
            nodes, ends = np.unique(np.concatenate([x for pair in zip(*held, strict=True) for x in pair]), return_inverse=True)
            a, b = ends.reshape(2, -1)
            low = np.arange(len(nodes))
            while (low[a] != low[b]).any():
                np.minimum.at(low, np.maximum(low[a], low[b]), np.minimum(low[a], low[b]))
                while (low[low] != low).any():
                    low = low[low]
            moved = np.flatnonzero(low != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[low[moved]])], ["u", "v"])

    return edges.repartition(parts).mapInArrow(join, "u long, v long")


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nodes with a component: the smallest node that each can reach over links (a, b).

    Each part of the links is joined into stars on its own. Where there is more than one part, rounds
    follow: each node is told the smallest of its neighbours, first by all and then by smaller ones,
    which halves the distances, until the links are stars around the smallest.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    parts = max(1, -(-edges.count() // PART_LINKS))
    edges = stars(edges, parts).distinct().checkpoint()
    before = None if parts > 1 else _mark(edges)
    while before != (now := _mark(edges)):
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        down = large.filter("u > v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("low"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u > v")
        edges = small.unionByName(least.select("u", F.col("low").alias("v"))).distinct().checkpoint()
    return nodes.join(edges.select(F.col("u").alias("node"), "v"), "node", "left").select(*nodes.columns, F.coalesce("v", "node").alias("component"))


def linked(docs: DataFrame, size: int = SHINGLE, least_hundredths: int = LEAST_HUNDREDTHS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    common.prepare(docs.sparkSession)
    rows = sets(docs, size).checkpoint()
    classes = classes_of(rows)
    blocks = ordered(forest(classes))
    nodes = classes.select("node", "sketch")
    first = candidates(blocks, nodes, FIRST_TREES, 1, least_hundredths, None).checkpoint()
    links = confirmed(docs, classes, first, size, least_hundredths).checkpoint()
    second = candidates(blocks, components(nodes, links), TREES, BEST, least_hundredths, "component").join(first, ["a", "b"], "left_anti").checkpoint()
    links = links.unionByName(confirmed(docs, classes, second, size, least_hundredths)).checkpoint()
    rest = crowded(blocks, components(nodes.select("node"), links))
    third = by_shingles(docs, classes, rest, size, least_hundredths).join(first.unionByName(second), ["a", "b"], "left_anti").checkpoint()
    links = links.unionByName(confirmed(docs, classes, third, size, least_hundredths)).checkpoint()
    found = components(classes.select("class", "node", "rep"), links).select("class", "rep", "component").checkpoint()
    smallest = found.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = common.spread_join(found.select("class", "component"), smallest, "component").select("class", "component_id").checkpoint()
    some = common.spread_join(rows.select("doc_id", "n_shingles", "class").filter("class is not null"), of_class, "class").drop("class")
    none = rows.filter("class is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return some.unionByName(none).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def keep(docs: DataFrame, size: int = SHINGLE, least_hundredths: int = LEAST_HUNDREDTHS) -> DataFrame:
    """The rows of docs whose doc_id stays: one document of each group. Of rows with one doc_id all stay."""
    stays = linked(docs, size, least_hundredths).filter("kept").select(F.col("doc_id").alias("stays")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"))
    return rows.join(stays.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("stays")), "left_semi").select("row.*")
