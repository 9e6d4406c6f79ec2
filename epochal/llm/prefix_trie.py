"""Trie of conversation prefixes, with sums over subtrees by bands of depth.

Conversations are rebuilt first: the first turns of conversation c - c % 5, then c's own from there on.
Every prefix of a rebuilt conversation is a node; its key is 128 bits of a rolling hash of the turns up
to it, so nodes meet by one aggregate that is combined before it is shuffled.

Orders along conversations are scans: rows are dealt by ranges of (conversation, place) and each part
folds its rows; what runs over a part's edge is carried, two rows a part, so that one conversation may
be as long as it likes.

Sums over subtrees take bands of BAND levels. A node adds its values to its ancestors within its band,
BAND at most; a band's root then stands for the band in a tree that is BAND times lower, for which the
same is done, and so on until one root is left. On the way back the totals of band roots, complete by
then, are added to the nodes of the band above. A trie of depth d takes two rounds for each power of
BAND in d, and no node is exploded to more than BAND rows a round. A node's ancestors are the shorter
prefixes of its smallest member, found by one join on (conversation, depth). Nodes of one member have
one leaf and save nothing, so their values are known without it.

Defined results: turns are ordered by turn (null first), then role, text; null roles and texts are
empty; rows that repeat are turns of their own; rows without conv_id belong to no conversation and are
left out; a conversation without rebuilt turns is a member of the root only; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Levels of a band.
BAND = 4
#: Conversations of a family, and turns that are taken from the family's first at most.
FAMILY, SHARED = 5, 8
#: Bytes of member ids in a row, from which digests are made.
IDS = 1 << 16
#: Odd multipliers of the two rolling hashes, and of the depth in a key.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
DEPTH = np.uint64(0xD6E8FEB86659FD93)
WRAP = 1 << 64


class Scan:
    """Folds rows in order: for each its place in its conversation, and the rolling hashes up to it.

    state: conversation, rows of it so far, its two hashes so far.
    """

    def __init__(self, state=None):
        self.state = state
        self.powers = [np.ones(1, "u8") for _ in BASES]

    def power(self, k: int, n: int) -> np.ndarray:
        """The first n powers of a base, modulo 2^64."""
        if len(self.powers[k]) < n:
            self.powers[k] = np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(2 * n, BASES[k], "u8")]))
        return self.powers[k][:n]

    def step(self, conv: np.ndarray, hashes: list[np.ndarray]):
        """Places, hashes before and with each row."""
        n = len(conv)
        starts = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
        place = np.arange(n) - starts[run]
        goes_on = self.state is not None and self.state[0] == conv[0]
        first = int(starts[1]) if len(starts) > 1 else n
        before, after = [], []
        for k, h in enumerate(hashes):
            term = h * self.power(k, n)[place]
            total = np.cumsum(term)
            ends = total - (total - term)[starts[run]]
            if goes_on:
                shift = np.uint64(pow(BASES[k], self.state[1], WRAP))
                term[:first] *= shift
                ends[:first] = ends[:first] * shift + np.uint64(self.state[2 + k])
            before.append(ends - term)
            after.append(ends)
        if goes_on:
            place[:first] += self.state[1]
        self.state = (int(conv[-1]), int(place[-1]) + 1, *[int(a[-1]) for a in after])
        return place, before, after


def _columns(batch, names):
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def _edges(batches):
    """The first and the last run of a part: part, conv, rows, hashes; one row where they are one."""
    scan, first, closed, part = Scan(), None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, h1, h2 = _columns(batch, ["conv", "h1", "h2"])
        place, _, after = scan.step(conv, [h1.view("u8"), h2.view("u8")])
        first, part = (conv[0], batch.column("part")[0].as_py()) if first is None else (first, part)
        if closed is None or closed[0] == conv[0]:  # the first run, as far as this batch has it
            if (own := np.flatnonzero(conv == first)).size:
                i = own[-1]
                closed = (int(first), int(place[i]) + 1, int(after[0][i]), int(after[1][i]))
    if first is not None:
        rows = [closed] if scan.state[0] == closed[0] else [closed, scan.state]
        arrays = [pa.array([part] * len(rows), pa.int64()), *[pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], *[pa.array(np.array([r[i] for r in rows], "u8").view("i8")) for i in (2, 3)]]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "conv", "n", "h1", "h2"])


def carried(rows: DataFrame) -> tuple[dict, dict]:
    """For each part of (pinned, ordered) rows the state that it starts from, and the conversation after it."""
    edges: dict[int, list] = {}
    for r in rows.select("conv", "h1", "h2", "part").mapInArrow(_edges, "part long, conv long, n long, h1 long, h2 long").collect():  # two rows a part at most
        edges.setdefault(r.part, []).append((r.conv, r.n, r.h1 % WRAP, r.h2 % WRAP))
    states, following, state = {}, {}, None
    for part in sorted(edges):
        runs = edges[part]
        if part != min(edges):
            following[last] = runs[0][0]
        last = part
        if state and state[0] == runs[0][0]:
            states[part] = state
            n = state[1]
            runs[0] = (state[0], n + runs[0][1], *[(state[2 + k] + pow(BASES[k], n, WRAP) * runs[0][2 + k]) % WRAP for k in (0, 1)])
        state = runs[-1]
    return states, following


def ordered(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows dealt by range and sorted, pinned by a checkpoint without the columns that only order them."""
    parts = common.partitions(df.sparkSession)
    return df.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv", "h1", "h2", "bytes", F.spark_partition_id().cast("long").alias("part")).checkpoint()


def placed(turns: DataFrame) -> DataFrame:
    """conv, place (from 0), h1, h2, bytes of ordered turns."""
    states, _ = carried(turns)

    def run(batches):
        scan = None
        for batch in batches:
            if batch.num_rows:
                scan = scan or Scan(states.get(batch.column("part")[0].as_py()))
                conv, h1, h2 = _columns(batch, ["conv", "h1", "h2"])
                place, _, _ = scan.step(conv, [h1.view("u8"), h2.view("u8")])
                yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(place, pa.int64()), *[batch.column(c) for c in ("h1", "h2", "bytes")]], ["conv", "place", "h1", "h2", "bytes"])

    return turns.mapInArrow(run, "conv long, place long, h1 long, h2 long, bytes long")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv, at, h1, h2, bytes: the turns of rebuilt conversations in order of at, after a row that opens each of them."""
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    convs = turns.filter("place = 0").select("conv", (F.col("conv") - F.col("conv") % FAMILY).alias("head"), shared.alias("shared"))
    opens = convs.select("conv", F.lit(-SHARED - 1).cast("long").alias("at"), *[F.lit(0).cast("long").alias(c) for c in ("h1", "h2", "bytes")])
    heads = turns.filter((F.col("conv") % FAMILY == 0) & (F.col("place") < SHARED)).select(F.col("conv").alias("head"), "place", "h1", "h2", "bytes")
    taken = convs.join(heads, "head").filter("place < shared").select("conv", (F.col("place") - SHARED).alias("at"), "h1", "h2", "bytes")
    own = turns.filter(F.col("place") >= shared).select("conv", F.col("place").alias("at"), "h1", "h2", "bytes")
    return opens.unionByName(taken).unionByName(own)


def _mixed(x: np.ndarray, depth: np.ndarray) -> pa.Array:
    """A key's half: the hash and the depth, mixed so that all bits count."""
    x = x + depth.astype("u8") * DEPTH
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return pa.array((x ^ (x >> np.uint64(31))).view("i8"))


PREFIXES = "conv long, depth long, k1 long, k2 long, up1 long, up2 long, bytes long, ends boolean"


def prefixes(rows: DataFrame) -> DataFrame:
    """PREFIXES of ordered rebuilt turns: each prefix's key, its parent's, its last text's bytes, and whether the conversation ends there."""
    states, following = carried(rows)
    names = [x.split()[0] for x in PREFIXES.split(", ")]

    def run(batches):
        scan = held = part = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if scan is None:
                part = batch.column("part")[0].as_py()
                scan = Scan(states.get(part))
            conv, h1, h2 = _columns(batch, ["conv", "h1", "h2"])
            if held is not None:  # the row before is known to end its conversation or not only now
                yield closed(held, conv[0])
            depth, before, after = scan.step(conv, [h1.view("u8"), h2.view("u8")])
            held = conv, depth, [_mixed(x, depth) for x in after], [_mixed(x, depth - 1) for x in before], batch.column("bytes")
        if held is not None:
            yield closed(held, following.get(part))

    def closed(held, after):
        conv, depth, own, up, size = held
        ends = np.append(conv[1:] != conv[:-1], after is None or conv[-1] != after)
        return pa.RecordBatch.from_arrays([pa.array(conv), pa.array(depth, pa.int64()), *own, *up, size, pa.array(ends)], names)

    return rows.mapInArrow(run, PREFIXES)


def ends_digests(found: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256: SHA-256 of the ids that end at a node, ascending, joined by commas. Ids are first
    gathered into rows of IDS bytes where they are in the order; a node's digest streams over these."""
    names = ["k1", "k2", "first", "ids"]

    def gather(batches):
        rows = (r for batch in batches for r in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "conv")], strict=True))
        out = []
        for key, some in groupby(rows, key=lambda r: r[:2]):
            first, ids, size = None, [], 0
            for _, _, conv in some:
                first = conv if first is None else first
                ids.append(str(conv))
                size += len(ids[-1]) + 1
                if size > IDS:
                    out.append((*key, first, ",".join(ids)))
                    first, ids, size = None, [], 0
            if ids:
                out.append((*key, first, ",".join(ids)))
            if len(out) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    def digest(batches):
        rows = (r for batch in batches for r in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "ids")], strict=True))
        out = []
        for key, some in groupby(rows, key=lambda r: r[:2]):
            sha = hashlib.sha256()
            for i, (_, _, ids) in enumerate(some):
                sha.update((("," if i else "") + ids).encode())
            out.append((*key, sha.hexdigest()))
            if len(out) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["k1", "k2", "ends_sha256"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["k1", "k2", "ends_sha256"])

    parts = common.partitions(found.sparkSession)
    order = ["k1", "k2", "conv"]
    sorted_ids = found.filter("ends").select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    gathered = sorted_ids.mapInArrow(gather, "k1 long, k2 long, first long, ids string")
    return gathered.repartition(parts, "k1", "k2").sortWithinPartitions("k1", "k2", "first").select("k1", "k2", "ids").mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def ancestors(nodes: DataFrame, found: DataFrame, rounds: int, band: int) -> DataFrame:
    """k1, k2, round, inside, a1, a2, depth (the ancestor's): where inside, the ancestors of a node in its band of the
    round that its depth belongs to; else, for each round before, those between it and the band root above it."""
    power = lambda i: F.lit(band) ** i
    whole = lambda c: F.round(c).cast("long")
    own = sum([(F.col("depth") % band ** (i + 1) == 0).cast("int") for i in range(rounds)], F.lit(0))
    each = nodes.filter("depth > 0").select("k1", "k2", "conv", "depth", own.alias("own")).withColumn("round", F.explode(F.sequence(F.lit(0), "own")))
    width = whole(power(F.col("round")))
    steps = F.when(F.col("round") == F.col("own"), (F.expr("depth") / width).cast("long") % band).otherwise(band - 1)
    each = each.withColumn("step", F.explode(F.sequence(F.lit(1).cast("long"), steps.cast("long"))))
    wanted = each.select("k1", "k2", "round", (F.col("round") == F.col("own")).alias("inside"), "conv", (F.col("depth") - F.col("step") * width).alias("depth"))
    return wanted.join(found.select("conv", "depth", F.col("k1").alias("a1"), F.col("k2").alias("a2")), ["conv", "depth"]).drop("conv")


def rolled_up(nodes: DataFrame, found: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """k1, k2 and the values summed over the subtree of each node.

    nodes (pinned): k1, k2, conv (a member), depth, values; with a node all its ancestors. found: PREFIXES.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    rounds = 0
    while band**rounds <= deepest:
        rounds += 1
    sums = [F.sum(v).alias(v) for v in values]
    keys = ["k1", "k2", "depth"]
    state = nodes.select(*keys, *values)
    if not rounds:
        return state.drop("depth")
    edges = ancestors(nodes, found.filter(F.col("depth") < deepest), rounds, band).checkpoint()
    up = [F.col("a1").alias("k1"), F.col("a2").alias("k2"), "depth", *values]
    partial = []
    for i in range(rounds):  # each node into its band; band roots go on
        sent = edges.filter((F.col("round") == i) & F.col("inside")).join(state.drop("depth"), ["k1", "k2"]).select(*up)
        partial.append(state.unionByName(sent).groupBy(*keys).agg(*sums).checkpoint())
        state = partial[-1].filter(F.col("depth") % band ** (i + 1) == 0)
    for i in reversed(range(rounds)):  # complete band roots into the band above
        sent = edges.filter((F.col("round") == i) & ~F.col("inside")).join(state.drop("depth"), ["k1", "k2"]).select(*up)
        between = partial[i].filter(F.col("depth") % band ** (i + 1) != 0).unionByName(sent).groupBy(*keys).agg(*sums)
        state = state.unionByName(between).checkpoint()
    return state.drop("depth")


def trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    common.prepare(spark)
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")}
    turns = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), "turn", text["role"].alias("role"), text["text"].alias("text"), F.monotonically_increasing_id().alias("tie"))
    hashed = {"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(1), "text", "role"), "bytes": F.octet_length("text").cast("long")}
    turns = ordered(turns.withColumns(hashed), [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("tie")])
    found = prefixes(ordered(rebuilt(placed(turns)), [F.col("conv"), F.col("at")])).checkpoint()
    nodes = found.groupBy("k1", "k2").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), *[F.min(c).alias(c) for c in ("depth", "bytes", "up1", "up2")]).checkpoint()
    below = nodes.filter("depth > 0").groupBy(F.col("up1").alias("k1"), F.col("up2").alias("k2")).agg(F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single"))
    nodes = nodes.join(below, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).checkpoint()
    shared = nodes.filter("n_convs > 1 or depth = 0").select("k1", "k2", "conv", "depth", (F.coalesce("single", F.lit(0)) + (F.col("n_children") == 0).cast("long")).alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    sums = rolled_up(shared.checkpoint(), found, ["n_leaves", "saved_tokens"], band)
    parents = nodes.select(F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv").alias("parent_conv_id"))
    all_but_root = common.spread_join(nodes.filter("depth > 0"), parents, ["up1", "up2"])
    linked = all_but_root.unionByName(nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    out = linked.join(sums, ["k1", "k2"], "left").join(ends_digests(found), ["k1", "k2"], "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
