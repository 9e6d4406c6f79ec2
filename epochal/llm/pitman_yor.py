"""Language-model scoring: a hierarchical Pitman-Yor bigram model.

Each context (the word before, or the start of a text) is a restaurant whose dishes are the words
that follow it in the training texts. All of them share one parent, the restaurant of single words,
over a uniform base: a table of a context's restaurant is a customer of the parent. The tables of each
dish are sampled by Gibbs sweeps, customers being seated one after another given the tables of the
restaurant's other dishes, and predictive probabilities are averaged over the kept sweeps.

Texts are read twice. First all words are counted. Then every token goes, once, to the part of its
context, and that exchange is read twice: contexts are seated over a uniform parent to begin with, then
over the parent that their tables make until there were ROUNDS rounds, and at last sampled and scored over the parent
that these tables make. In each round after the first the contexts are seated anew over the parent, and the parent
anew with the tables that they then have, as a Gibbs sweep over both levels. In between, each part asks for what it lacks and gets it by one small exchange:
for each of its dishes the parent's customers and tables, summed over all parts. No table of words is broadcast.

A context with more than a quarter of an even part is hot, so there are four hot contexts a part at
most: only these are known to all tasks. Its tokens are split by dish, and those of dishes that are hot
words themselves by block of texts too, so that no part grows with a word or a pair of words. Its
customers are counted exactly, its tables and those pairs are summed over its shares in the same exchanges.

Defined results: a null text is empty and has the end token only; rows that repeat each get their
result and count as often in training; a row with a null doc_id is a training row; without training
rows every token has the base's probability; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Discount and strength of the context restaurants and of their parent; sweeps in all and those kept.
DISCOUNT, STRENGTH, PARENT_DISCOUNT, PARENT_STRENGTH, SWEEPS, KEPT = 0.7, 5.0, 0.3, 10.0, 6, 4
#: Times that the parent is seated with the contexts' tables before the last sampling; the first ones stem from a uniform parent.
ROUNDS = 2
#: Least tokens of a hot context, tokens of a part, parts at most, tokens and texts of a block.
SPLIT, PART, PARTS, BLOCK, BLOCK_TEXTS = 1 << 17, 3 << 19, 1 << 20, 1 << 20, 1 << 15
START, END = np.uint64(0x5A17F00D5EED0001), np.uint64(0x5A17F00D5EED0002)
#: Bits of a dish's hash that go along with a token.
DISH_BITS = np.uint64(40)
_DISH = np.uint64((1 << 40) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _blocks(batches, block: int = BLOCK):
    """Blocks of texts: doc_ids, training flags, and for each text the hashes of its words."""
    ids, train, words, size = [], [], [], 0
    for batch in batches:
        for doc_id, flag, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "train", "text")], strict=True):
            got = common.word_hashes(common.lower_words(text))
            ids.append(doc_id)
            train.append(flag)
            words.append(got)
            size += len(got) + 1
            if size >= block or len(ids) == BLOCK_TEXTS:
                yield ids, np.array(train), words
                ids, train, words, size = [], [], [], 0
    if ids:
        yield ids, np.array(train), words


def counts(rows: DataFrame) -> DataFrame:
    """word (64-bit hash), n, every: how often words stand in training texts and in all; the end of a text is a word."""

    def count(batches):
        for _, train, words in _blocks(batches):
            for flag in (True, False):
                some = [w for w, t in zip(words, train, strict=True) if t == flag]
                word, n = np.unique(np.concatenate([*some, np.full(len(some), END)]).astype("u8"), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view("i8")), pa.array(n.astype("i8") * flag), pa.array(n.astype("i8"))], ["word", "n", "every"])

    return rows.mapInArrow(count, "word long, n long, every long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("every").alias("every"))


def seat(n: np.ndarray, pull: np.ndarray, discount: float, names: np.ndarray, salt: int) -> np.ndarray:
    """Tables of dishes with n customers each; pull is what a new table weighs (an old one: its customers less the discount).

    The first 32 customers of a dish are seated one by one, more of them in steps of a quarter, of which as
    many as expected take new tables, rounded at random. Chance depends on names (64-bit hashes) and salt
    only, so a dish is seated alike whatever part it is in.
    """
    tables, at = (n > 0).astype("f8"), 1
    live = np.flatnonzero(n > 1)
    while len(live):
        step = 1 if at < 32 else at // 4
        old = at - discount * tables[live]
        new = (np.minimum(n[live], at + step) - at) * pull[live] / (pull[live] + np.maximum(old, 1e-9))
        with np.errstate(over="ignore"):
            chance = _mixed(names[live] + np.uint64(salt) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(at)) >> np.uint64(11)
        tables[live] += np.floor(new + chance * 2.0**-53)
        at += step
        live = live[n[live] > at]
    return tables


class Plan:
    """Totals of the counts, the number of parts, and the hot words with their counts (four a part at most)."""

    def __init__(self, total: int, kinds: int, ends: int, texts: int, tokens: int, least_parts: int, hot_of, block: int = BLOCK, parent_discount: float = PARENT_DISCOUNT, parent_strength: float = PARENT_STRENGTH, sampled: bool = True):
        self.sampled, self.block, self.parent_discount, self.parent_strength = sampled, block, parent_discount, parent_strength
        self.total, self.kinds, self.ends = total, kinds, ends
        self.parts = min(PARTS, max(least_parts, -(-tokens // PART)))
        self.split = max(SPLIT, tokens // (4 * self.parts))
        hot = [(np.uint64(w % (1 << 64)), n, every) for w, n, every in hot_of(self.split)] + ([(START, ends, texts)] if texts > self.split else [])
        hot.sort()
        self.hot = np.array([h[0] for h in hot], "u8")
        self.hot_n, self.shares = np.array([h[1] for h in hot], "i8"), np.array([h[2] // self.split + 1 for h in hot], "u8")
        #: Keys of the shares, in order, and the hot word of each.
        keys = [(int(_mixed(np.array([w], "u8") + np.uint64(1) + np.uint64(k))[0]), i) for i, w in enumerate(self.hot) for k in range(int(self.shares[i]))]
        keys.sort()
        self.hot_keys, self.hot_key_of = np.array([k for k, _ in keys], "u8"), np.array([i for _, i in keys], "i8")
        self.hot_dishes = np.unique(self.hot & _DISH)
        starts = [int(k) for k, i in keys if self.hot[i] == START]
        self.start_keys = np.array(starts or [int(_mixed(np.array([START], "u8"))[0])], "u8")

    def keys(self, context: np.ndarray, dish: np.ndarray, block: int) -> np.ndarray:
        """Keys by which tokens are dealt: the context, and of a hot one a share by dish, or by dish and block for hot dishes."""
        key = _mixed(context)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, context), len(self.hot) - 1)
            found = np.flatnonzero(self.hot[at] == context)
            share, low = dish[found] >> np.uint64(32), dish[found] & _DISH
            share = share + np.where(np.isin(low, self.hot_dishes), _mixed(np.array([block], "u8"))[0] >> np.uint64(8), np.uint64(0))
            key[found] = _mixed(context[found] + np.uint64(1) + share % self.shares[at[found]])
        return key

    def hot_at(self, keys: np.ndarray) -> np.ndarray:
        """Number of the hot word that each key is a share of; -1 for others."""
        if not len(self.hot_keys):
            return np.full(len(keys), -1, "i8")
        at = np.minimum(np.searchsorted(self.hot_keys, keys), len(self.hot_keys) - 1)
        return np.where(self.hot_keys[at] == keys, self.hot_key_of[at], -1)


def plan_of(counted: DataFrame, texts: int, least_parts: int, **settings) -> Plan:
    row = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("every"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("word") == int(END.view("i8")), F.col("n"))), F.lit(0))).first()
    hot_of = lambda split: [tuple(r) for r in counted.filter((F.col("every") > split) & (F.col("word") != int(END.view("i8")))).collect()]  # at most 4 a part
    return Plan(row[0], row[1], row[3], texts, row[2], least_parts, hot_of, **settings)


def deal(rows: DataFrame, shared) -> DataFrame:
    """part, block and packed tokens of a block of texts for each part; one row a block has its doc_ids instead."""

    def pack(batches):
        plan, base = shared.value, TaskContext.get().partitionId() << 32
        parts = plan.parts
        for no, (ids, train, words) in enumerate(_blocks(batches, plan.block)):
            sizes = np.array([len(w) + 1 for w in words])
            context = np.concatenate([x for w in words for x in ([START], w)]).astype("u8")
            dish = np.concatenate([x for w in words for x in (w, [END])]).astype("u8")
            text = np.repeat(np.arange(len(ids), dtype="u2") | (train.astype("u2") << np.uint16(15)), sizes)
            key = plan.keys(context, dish, base + no)
            order = np.argsort(key)
            key, dish, text = key[order], dish[order], text[order]
            low, high = (dish & np.uint64(0xFFFFFFFF)).astype("<u4"), ((dish >> np.uint64(32)) & np.uint64(0xFF)).astype("u1")
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            runs, keys = np.diff(np.append(cuts, len(key))).astype("<u4"), key[cuts]
            of_run = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype("i8")
            ends, token_ends = np.searchsorted(of_run, np.arange(parts + 1)), np.append(cuts, len(key))
            out = [(no % parts, base + no, None, None, None, None, None, ids, sizes.tolist(), train.tolist())]
            for p in np.unique(of_run).tolist():
                a, b = ends[p], ends[p + 1]
                lo, hi = token_ends[a], token_ends[b]
                out.append((p, base + no, keys[a:b].tobytes(), runs[a:b].tobytes(), low[lo:hi].tobytes(), high[lo:hi].tobytes(), text[lo:hi].tobytes(), None, None, None))
                if len(out) == 64:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    return rows.mapInArrow(pack, "part int, block long, keys binary, runs binary, dishes binary, tops binary, texts binary, ids array<long>, sizes array<long>, trains array<boolean>")


_PACKED = {"part": pa.int32(), "block": pa.int64(), **dict.fromkeys(("keys", "runs", "dishes", "tops", "texts"), pa.binary()), "ids": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "trains": pa.list_(pa.bool_())}


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PACKED.values(), strict=True)], list(_PACKED))


class Part:
    """The tokens of a part as restaurants: keys, pairs of key and dish with their training counts, dishes, and what it asks for.

    Names asked for are, in order: dishes, hot contexts, and pairs of hot contexts and hot dishes.
    """

    def __init__(self, group: pa.Table, plan: Plan):
        got = {c: [np.frombuffer(x.as_py(), k) for x in group[c]] for c, k in (("keys", "u8"), ("runs", "u4"), ("dishes", "u4"), ("tops", "u1"), ("texts", "u2"))}
        self.plan, self.texts, self.blocks = plan, got["texts"], group["block"].to_pylist()
        self.keys, key_of_run = np.unique(np.concatenate(got["keys"]), return_inverse=True)
        self.key = np.repeat(key_of_run, np.concatenate(got["runs"]))
        dish = np.concatenate(got["dishes"]).astype("u8") | (np.concatenate(got["tops"]).astype("u8") << np.uint64(32))
        pairs, self.pair = np.unique((self.key.astype("u8") << DISH_BITS) | dish, return_inverse=True)
        self.of = (pairs >> DISH_BITS).astype("i8")
        self.dishes, self.dish = np.unique(pairs & _DISH, return_inverse=True)
        marks = np.concatenate(self.texts)
        self.n = np.bincount(self.pair[(marks >> np.uint16(15)).astype(bool)], minlength=len(pairs))
        self.hot = plan.hot_at(self.keys)
        self.hot_contexts, self.hot_of = np.unique(self.hot[self.hot >= 0], return_inverse=True)
        #: Pairs that other parts may have too, and what they are called.
        self.split = np.flatnonzero((self.hot[self.of] >= 0) & np.isin(self.dishes, plan.hot_dishes)[self.dish])
        context = np.where(self.hot >= 0, plan.hot[self.hot] if len(plan.hot) else np.uint64(0), self.keys)
        self.pair_name = _mixed(context[self.of] ^ _mixed(self.dishes[self.dish]))
        self.pair_names, self.split_of = np.unique(self.pair_name[self.split] >> np.uint64(2), return_inverse=True)
        here = np.bincount(self.of, self.n, len(self.keys))
        self.count = np.where(self.hot >= 0, plan.hot_n[self.hot] if len(plan.hot) else 0, here)

    def names(self) -> np.ndarray:
        kind = lambda x, k: x.astype("u8") | np.uint64(k << 62)
        return np.concatenate([kind(self.dishes, 0), kind(self.hot_contexts, 1), kind(self.pair_names, 2)])

    def ask(self, tables: np.ndarray) -> np.ndarray:
        """Values for the names: tables of dishes, open tables of hot contexts, customers of split pairs.

        A split pair is seated with all its customers wherever it is, so each of its shares counts by its part of them.
        """
        whole = tables.astype("f8")
        whole[self.split] *= self.own / np.maximum(self.n[self.split], 1) if self.own is not None else 1.0
        customers = self.n[self.split] if self.own is None else self.own
        hot = np.bincount(self.hot_of, np.bincount(self.of, whole, len(self.keys))[self.hot >= 0], len(self.hot_contexts))
        return np.concatenate([np.bincount(self.dish, whole, len(self.dishes)), hot, np.bincount(self.split_of, customers, len(self.pair_names))])

    own = None

    def told(self, totals: np.ndarray, parent_tables: np.ndarray, all_customers: float, all_tables: float) -> None:
        """Takes the answers for the names: sums over all parts, and the parent's tables of dishes."""
        d, h = len(self.dishes), len(self.hot_contexts)
        less, strength = self.plan.parent_discount, self.plan.parent_strength
        base = (strength + less * all_tables) / (self.plan.kinds + 1)
        self.prior = ((np.maximum(totals[:d] - less * parent_tables[:d], 0) + base) / (all_customers + strength))[self.dish]
        self.open_hot = totals[d : d + h]
        self.own, self.n = self.n[self.split], self.n.copy()
        self.n[self.split] = np.round(totals[d + h :])[self.split_of]

    def seated(self, sweeps: int, kept: int, discount: float, strength: float, uniform: bool = False, turn: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Tables after some sweeps, and the predictive probability of each pair averaged over the kept ones.

        Without sweeps each dish has one table. Chance differs by turn. The tables of a hot context are those of all its shares, as last told.
        """
        prior = np.full(len(self.n), 1 / (self.plan.kinds + 1)) if uniform else self.prior
        tables, mean = (self.n > 0).astype("f8"), np.zeros(len(self.n))

        def opened() -> np.ndarray:
            out = np.bincount(self.of, tables, len(self.keys))
            if not uniform:
                out[self.hot >= 0] = self.open_hot[self.hot_of]
            return out

        for sweep in range(max(1, sweeps)):
            if sweeps:
                tables = seat(self.n, (strength + discount * opened())[self.of] * prior, discount, self.pair_name, 2 * sweep + uniform + 1000 * turn)
            if sweep >= max(1, sweeps) - kept:
                mean += (np.maximum(self.n - discount * tables, 0) + (strength + discount * opened())[self.of] * prior) / (self.count + strength)[self.of] / min(kept, max(1, sweeps))
        return tables, mean


ASKED = "bucket int, part int, names binary, tops binary, values binary"
TOLD = "bucket int, part int, totals binary, tables binary, customers double, open double"


def _bucketed(names: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which names are asked for, by bucket and name, and the ends of the buckets."""
    bucket = (_mixed(names) % np.uint64(parts)).astype("i8")
    order = np.lexsort((names, bucket))
    return order, np.searchsorted(bucket[order], np.arange(parts + 1))


def asked(dealt: DataFrame, told: DataFrame | None, shared, sweeps: int, discount: float, strength: float, turn: int = 0) -> DataFrame:
    """What each part asks of each bucket, with its own tables and customers."""
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), *[(c, pa.binary()) for c in ("names", "tops", "values")]])

    def ask(group: pa.Table, answers: pa.Table | None = None) -> pa.Table:
        group = group.filter(pa.compute.invert(group["ids"].is_valid()))
        if not len(group):
            return schema.empty_table()
        part, at = Part(group, shared.value), group["part"][0].as_py()
        if answers is not None:
            part.told(*_told(part, answers))
        tables, _ = part.seated(sweeps, 1, discount, strength, answers is None, turn)
        names, values, parts = part.names(), part.ask(tables), shared.value.parts
        order, ends = _bucketed(names, parts)
        names, values, rows = names[order], values[order].astype("<f4"), []
        for b in np.flatnonzero(np.diff(ends)).tolist():
            piece = slice(ends[b], ends[b + 1])
            low, top = (names[piece] & np.uint64(0xFFFFFFFF)).astype("<u4"), (names[piece] >> np.uint64(32)).astype("<u4")
            rows.append({"bucket": b, "part": at, "names": low.tobytes(), "tops": top.tobytes(), "values": values[piece].tobytes()})
        return pa.Table.from_pylist(rows, schema)

    if told is None:
        return dealt.groupBy("part").applyInArrow(lambda group: ask(group), ASKED)
    return dealt.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(lambda group, answers: ask(group, answers), ASKED)


def _told(part: Part, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, float, float]:
    """The answers of all buckets, in the order of the part's names."""
    names = part.names()
    order, _ = _bucketed(names, part.plan.parts)
    rows = sorted(answers.select(["bucket", "totals", "tables"]).to_pylist(), key=lambda r: r["bucket"])
    out = []
    for c in ("totals", "tables"):
        values = np.empty(len(names))
        values[order] = np.concatenate([np.frombuffer(r[c], "<f4") for r in rows])
        out.append(values)
    return *out, answers["all_customers"][0].as_py(), answers["all_open"][0].as_py()


def answered(asks: DataFrame, shared, turn: int = 0) -> DataFrame:
    """Sums over all parts for the names that each part asked for, in its order, with the parent's tables of dishes and the parent's totals."""
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("totals", pa.binary()), ("tables", pa.binary()), ("customers", pa.float64()), ("open", pa.float64())])

    def answer(group: pa.Table) -> pa.Table:
        plan = shared.value
        low, top, values = (np.concatenate([np.frombuffer(x.as_py(), k) for x in group[c]]) for c, k in (("names", "<u4"), ("tops", "<u4"), ("values", "<f4")))
        names, at = np.unique(low.astype("u8") | (top.astype("u8") << np.uint64(32)), return_inverse=True)
        totals = np.bincount(at, values, len(names))
        dish = names >> np.uint64(62) == 0
        customers = np.where(dish, np.round(totals), 0).astype("i8")
        pull = np.full(len(names), (plan.parent_strength + plan.parent_discount * plan.kinds) / (plan.kinds + 1))
        tables = seat(customers, pull, plan.parent_discount, names, 99 + 1000 * turn) if plan.sampled else (customers > 0).astype("f8")
        rows, start = [], 0
        for k, (part, size) in enumerate(zip(group["part"].to_pylist(), map(len, group["names"].to_pylist()), strict=True)):
            some = at[start : start + size // 4]
            start += size // 4
            rows.append({"bucket": group["bucket"][0].as_py(), "part": part, "totals": totals[some].astype("<f4").tobytes(), "tables": tables[some].astype("<f4").tobytes(), "customers": float(customers.sum()) if k == 0 else 0.0, "open": float(tables.sum()) if k == 0 else 0.0})
        return pa.Table.from_pylist(rows, schema)

    told = asks.groupBy("bucket").applyInArrow(answer, TOLD).withColumn("one", F.lit(1))
    totals = told.agg(F.sum("customers").alias("all_customers"), F.sum("open").alias("all_open")).withColumn("one", F.lit(1))
    return told.join(F.broadcast(totals), "one").drop("one")  # one row


SUMS = "block long, texts binary, model binary, base binary, known binary, ids array<long>, sizes array<long>, trains array<boolean>"


def restaurants(dealt: DataFrame, told: DataFrame, shared, sweeps: int, kept: int, discount: float, strength: float) -> DataFrame:
    """For each block and part: texts (numbers in the block) and their sums of log10 model probability,
    of log10(count + 1) of their words, and of known words. The rows with doc_ids pass through."""
    schema = pa.schema([("block", pa.int64()), *[(c, pa.binary()) for c in ("texts", "model", "base", "known")], *[(c, _PACKED[c]) for c in ("ids", "sizes", "trains")]])

    def score(group: pa.Table, answers: pa.Table) -> pa.Table:
        named = group["ids"].is_valid()
        names, group = group.filter(named).select(["block", "ids", "sizes", "trains"]).to_pylist(), group.filter(pa.compute.invert(named))
        return pa.Table.from_pylist(names + (sums(group, answers) if len(group) else []), schema)

    def sums(group: pa.Table, answers: pa.Table) -> list[dict]:
        part = Part(group, shared.value)
        part.told(*_told(part, answers))
        _, mean = part.seated(sweeps, kept, discount, strength)
        gain = np.log10(mean)[part.pair]
        start = np.isin(part.keys, shared.value.start_keys)
        base = np.where(start, 0.0, np.log10(part.count + 1))[part.key]
        known = ((part.count > 0) & ~start)[part.key]
        out, at = [], 0
        for block, some in zip(part.blocks, part.texts, strict=True):
            piece = slice(at, at + len(some))
            at += len(some)
            text = some & np.uint16(0x7FFF)
            texts = np.flatnonzero(np.bincount(text)).astype("<u2")
            each = [np.bincount(text, x[piece])[texts] for x in (gain, base, known)]
            out.append({"block": block, "texts": texts.tobytes(), "model": each[0].astype("<f4").tobytes(), "base": each[1].astype("<f8").tobytes(), "known": each[2].astype("<u4").tobytes()})
        return out

    return dealt.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(score, SUMS)


def score(docs: DataFrame, held_out, sweeps: int = SWEEPS, kept: int = KEPT, rounds: int = ROUNDS, discount: float = DISCOUNT, strength: float = STRENGTH, **settings) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    held_out: a function from the doc_id column to a boolean one. Without sweeps no table is sampled: each
    dish of a context has one, as in Kneser-Ney smoothing. settings: block, parent_discount, parent_strength.
    """
    common.prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~F.coalesce(held_out(F.col("doc_id")), F.lit(False))).alias("train"), "text")
    counted = counts(rows).checkpoint()
    plan = plan_of(counted, docs.count(), common.partitions(docs.sparkSession), sampled=sweeps > 0, **settings)
    shared = docs.sparkSession.sparkContext.broadcast(plan)  # four hot words a part at most
    dealt, told = deal(rows, shared), None
    for turn in range(rounds, 0, -1) if rounds > 1 else (0,):
        told = answered(asked(dealt, told, shared, min(sweeps, 2), discount, strength, turn), shared, turn)
    sums = restaurants(dealt, told, shared, sweeps, kept, discount, strength)
    total, kinds, ends = plan.total, plan.kinds, plan.ends
    least = float(np.log10(total + kinds + 1))

    def gather(block: pa.Table) -> pa.Table:
        named = block["ids"].is_valid()
        ids, sizes, trains = (block.filter(named)[c][0].as_py() for c in ("ids", "sizes", "trains"))
        parts_of = block.filter(pa.compute.invert(named))
        model, base, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), "i8")
        for texts, *values in zip(*[parts_of[c].to_pylist() for c in ("texts", "model", "base", "known")], strict=True):
            at = np.frombuffer(texts, "<u2")
            for total_of, value, kind in zip((model, base, known), values, ("<f4", "<f8", "<u4"), strict=True):
                total_of[at] += np.frombuffer(value, kind)
        sizes = np.array(sizes)
        base = base + np.log10(ends + 1) - sizes * least
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array([not t for t in trains]), "n_tokens": sizes, "n_known": known + (ends > 0), "base_score": base, "score": model})

    joined = sums.groupBy("block").applyInArrow(gather, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return joined.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), F.round("base_score", 6).alias("base_score"), F.round("score", 4).alias("score"))
