"""Token-id files against the tokenizers library, and the index against a dictionary."""

import json
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from epochal.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


def want(df):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    rows = [r for r in df.selectExpr("doc_id", "text", "xxhash64(doc_id, text) as rid").collect()]
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.rid)):
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        out.append((str(r.doc_id), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in token_files.digests(df, PATH).collect())


def test_documents(docs):
    assert got(docs) == want(docs)


def test_odd(odd, empty):
    assert got(odd) == want(odd)
    assert token_files.digests(empty, PATH).count() == 0


def test_special_marks_and_spaces(spark):
    rows = [(1, "a<|endoftext|>b <|startoftext|>"), (2, "nb sp \x1c\x85 x y"), (3, "é ́x I'M DON'T 12ab")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == want(df)


def test_words_split_before_the_tokenizer():
    """Letters that are made small, marks that are split off, and where neither may be."""
    texts = ["J\u030c j\u030c", "<|ENDOFTEXT|> A. <|endoftext|>", "Ab, ab., ab- ab -, é, E\u0301, \u212a. K.", "a.\u0338 b a=\u0338 c d.\te!\nf?\x0bg;\x1ch: ", "it's. DON'T, x1. 2, (z) z)) z) .", "İ. ß, SS! \u3000, \ud7ff."]
    rng = np.random.default_rng(7)
    some = list("aZ.,'!-) \n\té\u0301<|>1İK") + ["<|endoftext|>", "<|EndOfText|>"]
    texts += ["".join(rng.choice(some, 60)) for _ in range(400)]
    tokenizer, encoder = Tokenizer.from_file(PATH), token_files.Words(PATH)
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(packed, encoder.kind).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1], text


def test_other_tokenizers_encode_whole_texts(tmp_path):
    """A byte-level file, and the same words without lower-casing; one worker keeps what it remembers of each apart."""
    given = json.load(open(PATH))
    given["normalizer"]["normalizers"].pop()
    given["truncation"] = {"direction": "Right", "max_length": 2, "strategy": "LongestFirst", "stride": 0}
    (tmp_path / "case.json").write_text(json.dumps(given))
    paths = [PATH, public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "case.json")]
    assert [token_files.by_words(p) for p in paths] == [True, False, False]
    texts = ["Hello  World, it's\n\nnot. THE end", "hello world", "", " \t "]
    for path in [*paths, *paths]:
        library, encoder = Tokenizer.from_file(path), token_files.words(path)
        library.no_truncation()
        got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)]
        assert got == [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts], path


def test_perfect_hash():
    keys = np.random.default_rng(3).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    keys = np.unique(keys)
    sizes, bits, left = token_files.build(keys)
    slot = token_files.slots(keys, sizes, bits)
    assert len(left) == 0 and sorted(slot.tolist()) == list(range(len(keys)))
    others = np.random.default_rng(4).integers(0, 1 << 63, 5_000, dtype=np.uint64)
    at = token_files.slots(others, sizes, bits)
    prints = np.zeros(len(keys), "u2")
    prints[slot] = token_files._fingerprint(keys)
    false = (at >= 0) & (prints[at] == token_files._fingerprint(others))
    assert false.mean() < 0.01


def test_equal_hashes_are_listed():
    sizes, bits, left = token_files.build(np.array([5, 5, 9], "u8"))
    assert left.tolist() == [0, 1] and len(sizes) == token_files.LEVELS
    assert token_files.slots(np.array([5, 9], "u8"), sizes, bits).tolist() == [-1, 0]


def test_one_doc_id_over_many_parts(spark):
    """10,000 null and 10,000 repeated doc_ids over 8 parts: distinct texts, and equal ones."""
    rows = [(None if k % 2 else 7, f"w{k % 3000} x" if k < 16_000 else "same row") for k in range(20_000)] + [(8, None), (9, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        folder = token_files.new_folder(spark)
        entries, _, _, _ = token_files.store(df, PATH, folder)
        assert entries.select("doc_id", "occurrence").distinct().count() == len(rows)
        top = entries.groupBy("doc_id").agg({"occurrence": "max"}).collect()
        assert {r[0]: r[1] for r in top} == {None: 9_999, 7: 9_999, 8: 0, 9: 0}
        found = got(df)
        assert found == want(df)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_forced_clash(spark, docs, monkeypatch):
    """Keys of one 64-bit hash are found by their own names."""
    entries = spark.createDataFrame([(d, 0, 0, 10 * d, 10) for d in range(40)], token_files.ENTRIES).coalesce(1)
    same = lambda df, buckets: df.selectExpr("*", "case when doc_id < 20 then 5L else doc_id end as key", "0L as bucket")
    monkeypatch.setattr(token_files, "_key", same)
    indexed = token_files.index(entries, 1)
    asked = spark.createDataFrame([(d, 0) for d in range(30)] + [(3, 1)], "doc_id long, occurrence long")
    found = sorted((r.doc_id, r.at) for r in token_files.lookup(asked, indexed, 1).collect())
    assert found == [(d, 10 * d) for d in range(30)]


def test_missing_keys(spark, docs):
    folder = token_files.new_folder(spark)
    _, _, indexed, buckets = token_files.store(docs.limit(50), PATH, folder)
    asked = spark.createDataFrame([(10**9 + i, 0) for i in range(200)], "doc_id long, occurrence long")
    assert token_files.lookup(asked, indexed, buckets).count() <= 2
