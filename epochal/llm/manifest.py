"""Merkle manifest of a dataset, with a version for each tampered leaf by path copying.

Each row is a leaf, a SHA-256 of its columns. The leaves of a source, in ascending order of doc_id, are
hashed in runs of FAN, level by level, until one node is left, the subroot; subroots, in order of
source, are hashed into the root in the same way. Trees are cut into aligned blocks of BLOCK
neighbouring nodes: a block holds HEIGHT levels, and the roots of blocks are the nodes of the next
round, so a task never holds more than one block at a time, however large a source is.

Trees are persistent. A leaf that was tampered with makes a version of its block that copies the
leaf's ancestors in the block and shares all other nodes; versions go on above their block where they
are, from the proof that comes down to each block, round by round: no node above gathers versions.
The proof of a row has its siblings, level by level up to the root.

Defined results: a null column is `-` in a leaf; a null source is a source of its own, before all
others; null doc_ids come first in their source; rows of one doc_id are ordered by their leaves, and
rows that repeat take places of their own beside each other; a tree of one node has no proof, and the
node is its root; an empty table gives no rows; columns other than those of the leaf are not read.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Nodes in a run, levels in a block, nodes at the foot of a block.
FAN, HEIGHT = 3, 7
BLOCK = FAN**HEIGHT
#: Rows that a task gathers before it hands them on.
ROWS = 2048


def leaf(columns: list[Column]) -> Column:
    """SHA-256 (32 bytes) of columns: `-` for null, else the UTF-8 length, a colon and the value."""
    written = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.sha2(F.concat(*written).cast("binary"), 256))


def joined(digests) -> bytes:
    """The hash of a run: SHA-256 over the digests as hex text."""
    return hashlib.sha256("".join(map(bytes.hex, digests)).encode()).digest()


def levels(n: int, height: int = HEIGHT) -> int:
    """Levels above the foot of a block in a tree of n nodes."""
    k = 0
    while k < height and FAN**k < n:
        k += 1
    return k


def build(digests: list[bytes], height: int) -> tuple:
    """The root of a block: a node is (digest, children), and never changes."""
    nodes = [(d, ()) for d in digests]
    for _ in range(height):
        runs = [tuple(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        nodes = [(joined(x[0] for x in run), run) for run in runs]
    return nodes[0]


def walk(root: tuple, at: int, height: int) -> list[tuple[tuple, int]]:
    """The nodes from the root down to the parent of a leaf, each with the place of the child on the way."""
    steps, node = [], root
    for k in reversed(range(height)):
        place = at // FAN**k % FAN
        steps.append((node, place))
        node = node[1][place]
    return steps


def with_leaf(steps: list[tuple[tuple, int]], digest: bytes) -> list[tuple]:
    """A version in which one leaf has another digest: its new nodes, from the leaf up to the version's root.
    They share the children off the way with the tree that was walked."""
    made = [(digest, ())]
    for (_, kids), place in reversed(steps):
        kids = (*kids[:place], made[-1], *kids[place + 1 :])
        made.append((joined(x[0] for x in kids), kids))
    return made


def proof_of(steps: list[tuple[tuple, int]]) -> tuple[bytes, bytes]:
    """The siblings on the way, from the leaf up, and a byte for each level: place in the run * 4 + nodes of the run."""
    up = steps[::-1]
    return b"".join(x[0] for node, place in up for i, x in enumerate(node[1]) if i != place), bytes(place * 4 + len(node[1]) for node, place in up)


def continued(digest: bytes, proof: bytes, places: bytes) -> list[bytes]:
    """The digests above one that the siblings of a proof lead to."""
    out, at = [], 0
    for p in places:
        place, others = p // 4, p % 4 - 1
        run = [proof[at + 32 * i : at + 32 * (i + 1)] for i in range(others)]
        run.insert(place, digest)
        digest = joined(run)
        out.append(digest)
        at += 32 * others
    return out


def _rows(batches):
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _dealt(rows, names, kinds):
    """Batches of rows."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)


TEXT, LONG, BYTES = pa.string(), pa.int64(), pa.binary()


def _in_blocks(nodes: DataFrame, height: int) -> DataFrame:
    """Nodes (tree, at, ...) with their block, those of a block together and in order."""
    block = F.floor(F.col("at") / FAN**height).cast("long")
    return nodes.withColumn("block", block)


def roots(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """tree, at, n, digest of tree, at, n, digest: the roots of the blocks, which are the next round's nodes."""
    size = FAN**height

    def run(batches):
        def found():
            for (tree, block), rows in groupby(_rows(batches), key=lambda r: r[:2]):
                rows = list(rows)  # a block
                n = rows[0][3]
                yield tree, block, -(-n // size), build([r[4] for r in rows], levels(n, height))[0]

        yield from _dealt(found(), ["tree", "at", "n", "digest"], [TEXT, LONG, LONG, BYTES])

    dealt = _in_blocks(nodes, height).select("tree", "block", "at", "n", "digest").repartition(common.partitions(nodes.sparkSession), "tree", "block")
    return dealt.sortWithinPartitions("tree", "block", "at").mapInArrow(run, "tree string, at long, n long, digest binary")


PROVEN = "tree string, at long, doc_id long, digest binary, changed binary, proof binary, places binary, copied binary, subroot binary, root binary"


def proven(nodes: DataFrame, above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The proofs of nodes (tree, at, n, doc_id, digest, changed), given those of their blocks' roots.

    copied has the digests of the version that the changed digest makes, or the own one where that is
    null, from the node's parent up to the root. above: tree, at, proof, places, subroot, root.
    """

    def run(batches):
        def found():
            for _, rows in groupby(_rows(batches), key=lambda r: r[:2]):
                rows = list(rows)  # a block, and before it the proof of its root
                proof_up, places_up, subroot, root = rows[0][7:11]
                n = rows[1][3]
                k = levels(n, height)
                tree = build([r[5] for r in rows[1:]], k)
                for name, _, at, _, doc_id, digest, changed, *_ in rows[1:]:
                    steps = walk(tree, at % FAN**height, k)
                    version = [x[0] for x in with_leaf(steps, digest if changed is None else changed)]
                    copied = version[1:] + continued(version[-1], proof_up, places_up)
                    proof, places = proof_of(steps)
                    yield name, at, doc_id, digest, changed, proof + proof_up, places + places_up, b"".join(copied), subroot, root

        names, kinds = zip(*[x.split() for x in PROVEN.split(", ")], strict=True)
        yield from _dealt(found(), list(names), [{"string": TEXT, "long": LONG, "binary": BYTES}[k] for k in kinds])

    own = _in_blocks(nodes, height).select("tree", "block", "at", "n", "doc_id", "digest", "changed", *[F.lit(None).cast("binary").alias(c) for c in ("proof", "places", "subroot", "root")])
    first = above.select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), *[F.lit(None).cast(k).alias(c) for c, k in (("n", "long"), ("doc_id", "long"), ("digest", "binary"), ("changed", "binary"))], "proof", "places", "subroot", "root")
    dealt = own.unionByName(first).repartition(common.partitions(nodes.sparkSession), "tree", "block").sortWithinPartitions("tree", "block", "at")
    return dealt.mapInArrow(run, PROVEN)


def _bare(nodes: DataFrame) -> DataFrame:
    """Nodes above the leaves: no document, nothing changed."""
    return nodes.select("tree", "at", "n", F.lit(None).cast("long").alias("doc_id"), "digest", F.lit(None).cast("binary").alias("changed"))


def climbed(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The nodes of each round, up to that in which each tree has one."""
    rounds = [nodes]
    while len(rounds) == 1 or rounds[-1].filter("n > 1").limit(1).count():
        rounds.append(roots(rounds[-1], height).checkpoint())
    return rounds


def versions(docs: DataFrame, columns: list[Column], source: Column, doc_id: Column, changed: Column, height: int = HEIGHT) -> DataFrame:
    """PROVEN for each row of docs; changed is the leaf after tampering, null where nothing was done.

    tree is the source after a 1, or 0 for null.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    rows = docs.select(doc_id.cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("1"), source), F.lit("0")).alias("tree"), leaf(columns).alias("digest"), changed.alias("changed"), F.monotonically_increasing_id().alias("tie"))
    placed = common.numbered(rows, [F.col("tree"), F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("tie")], "no")
    trees = placed.groupBy("tree").agg(F.min("no").alias("first"), F.count("*").alias("n"))
    leaves = common.spread_join(placed, trees, "tree").select("tree", (F.col("no") - F.col("first")).alias("at"), "n", "doc_id", "digest", "changed").checkpoint()
    rounds = climbed(leaves, height)
    subroots = common.numbered(rounds[-1].select(F.col("tree").alias("of"), "digest"), [F.col("of")], "at").checkpoint()
    over = subroots.select(F.lit("").alias("tree"), "at", F.lit(subroots.count()).cast("long").alias("n"), "digest")
    upper = climbed(over, height)
    none = F.lit(b"")
    above = upper[-1].select("tree", "at", none.alias("proof"), none.alias("places"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    for nodes in upper[-2::-1]:
        above = proven(_bare(nodes), above, height)
    above = above.join(subroots.select("at", "of", F.col("digest").alias("own")), "at").select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("at"), "proof", "places", F.col("own").alias("subroot"), "root").checkpoint()
    for nodes in rounds[-2:0:-1]:
        above = proven(_bare(nodes), above, height)
    return proven(leaves, above, height)


def tampered(docs: DataFrame, **sizes) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; where 2 divides the
    crc32 of doc_id, the newlines of the text are deleted after the manifest was made."""
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    base = [F.col(c) for c in names]
    without = leaf([*base[:-1], F.translate("text", "\n", "")])
    changed = F.when((common.crc_mod(F.col("doc_id"), 2) == 0) & F.contains(F.col("text"), F.lit("\n")), without)
    found = versions(docs, base, F.col("source"), F.col("doc_id"), changed, **sizes)
    text = lambda c: F.lower(F.hex(c))
    top = F.coalesce(F.nullif(F.expr("right(hex(copied), 64)"), F.lit("")), F.hex(F.coalesce("changed", "digest")))
    out = found.select("doc_id", text("digest").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"), F.sha2(text("proof").cast("binary"), 256).alias("proof_sha256"), F.lower(top).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
