"""BPE by prefixes against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from epochal.llm import prefix_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def codec():
    return prefix_bpe.codec(PATH)


def want(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((str(doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in prefix_bpe.digests(df, PATH).collect())


def test_documents(docs, library):
    assert got(docs) == want(library, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_odd(odd, empty, library):
    assert got(odd) == want(library, [tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert prefix_bpe.digests(empty, PATH).count() == 0


def test_decoded_texts(docs):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    back = prefix_bpe.decode(prefix_bpe.encode(docs, PATH), PATH).collect()
    assert all(r.text == (texts[r.doc_id] or "") for r in back) and len(back) == len(texts)


def test_hard_texts(library, codec):
    """Runs, white space, added tokens and parts of them, marks, mixed scripts, bytes in any order."""
    rng = random.Random(12)
    bits = ["a", "e", " ", "  ", "\n", "1", "'s", "'", "<|endoftext|>", "<|endof", "|>", "é", "日本", "😀", " ", "​", "́", "the", " the", "ing", "==", "١", "\U00011de0", "՘", "\x00", "퟿"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["".join(chr(rng.randrange(0x20, 0x2FFF)) for _ in range(40)) for _ in range(1000)]
    texts += ["".join(rng.choice("abAB") for _ in range(300)) for _ in range(200)]
    texts += ["a" * 70_000, " " * 30_000, "ab" * 20_000 + "<|endoftext|>" * 3, "=-" * 9000]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        mine = codec.encode(text)
        assert np.frombuffer(mine, "<u4").tolist() == ids, text[:200]
        assert codec.decode(mine) == library.decode(ids, skip_special_tokens=False)


def test_all_code_points(library, codec):
    """Pre-tokens are cut as the library does, whatever the character beside letters, numbers and marks."""
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    for lo in range(0, len(points), 128):
        text = "".join(f" a{c} 1{c} !{c} {c}" for c in map(chr, points[lo : lo + 128]))
        assert codec.pretokens(text) == [text[a:b] for a, b in prefix_bpe._joined(at for _, at in library.pre_tokenizer.pre_tokenize_str(text))], hex(points[lo])


def test_last_tokens(library, codec):
    """The last token stored for each prefix is the last of the prefix's own encoding."""
    for piece in ("internationalization", "aaaaaaaaaaaaa", "unbelievable", "zzyzxqj"):
        last = codec.prefixes.last_tokens(piece.encode())
        assert last[1:] == [library.encode(piece[:n], add_special_tokens=False).ids[-1] for n in range(1, len(piece) + 1)]


def test_other_files(tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        prefix_bpe.Codec(public_tokenizers.path("word_bpe_49k.json"))
    given = json.load(open(PATH, encoding="utf-8"))
    given["model"]["merges"][0], given["model"]["merges"][-1] = given["model"]["merges"][-1], given["model"]["merges"][0]
    (tmp_path / "t.json").write_text(json.dumps(given))
    with pytest.raises(ValueError, match="merge"):
        prefix_bpe.Codec(str(tmp_path / "t.json"))


def test_two_vocabularies_in_one_worker(tmp_path):
    """Pairs and pre-tokens that are remembered belong to a vocabulary: here the same file without its later merges."""
    given = json.load(open(PATH))
    kept = given["model"]["merges"][:2000]
    made = {"".join(m.split(" ") if isinstance(m, str) else m) for m in kept}
    added = {t["content"] for t in given["added_tokens"]}
    given["model"]["merges"], given["model"]["vocab"] = kept, {t: i for t, i in given["model"]["vocab"].items() if len(t) == 1 or t in made or t in added}
    (tmp_path / "small.json").write_text(json.dumps(given))
    texts = ["information about the same words", "naïve 12345 the"]
    for path in (PATH, str(tmp_path / "small.json"), PATH):
        own, codec = Tokenizer.from_file(path), prefix_bpe.codec(path)
        assert [np.frombuffer(codec.encode(t), "<u4").tolist() for t in texts] == [own.encode(t, add_special_tokens=False).ids for t in texts]
