"""TIFF columns: round trips over all codings, foreign byte order, broken files, digests."""

import hashlib
import os
import random
import struct
import zlib

import pytest

from epochal.llm import tiff


def payloads():
    rng = random.Random(8)
    yield bytes(rng.choice(b"aaaab  c") for _ in range(576 * 3))
    yield os.urandom(576 * 5)
    yield b"\xff" * 576
    yield bytes(rng.choice(b"abcdefghij ") for _ in range(576 * 40))


@pytest.mark.parametrize("compression", list(tiff.ENCODE))
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [0, 16, 64])
def test_round_trip(compression, predictor, tile):
    for p in payloads():
        file = tiff.write(p, compression=compression, predictor=predictor, tile=tile, page_rows=7)
        pages = [tiff.page_pixels(file, t) for t in tiff.directories(file)]
        assert b"".join(x.tobytes() for x in pages) == p and len(pages) == -(-len(p) // (576 * 7))


def test_lzw_widths():
    data = bytes(random.Random(2).choices(range(256), k=60_000))
    assert tiff.lzw_decode(tiff.lzw_encode(data)) == data
    same = b"a" * 50_000
    assert tiff.lzw_decode(tiff.lzw_encode(same)) == same


def test_known_streams():
    assert tiff.packbits_decode(bytes([0xFE, 0xAA, 0x02, 0x80, 0x00, 0x2A, 0xFD, 0xAA, 0x03, 0x80, 0x00, 0x2A, 0x22, 0xF7, 0xAA])) == bytes([0xAA] * 3 + [0x80, 0, 0x2A] + [0xAA] * 4 + [0x80, 0, 0x2A, 0x22] + [0xAA] * 10)
    assert tiff.lzw_decode(bytes([0x80, 0x01, 0xE0, 0x40, 0x80, 0x44, 0x08, 0x0C, 0x06, 0x80, 0x80])) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])


def test_big_endian(spark):
    fields = [(256, 4, 1, 4), (257, 4, 1, 1), (258, 3, 1, 8 << 16), (259, 3, 1, 1 << 16), (273, 4, 1, 8), (277, 3, 1, 1 << 16), (279, 4, 1, 4)]
    file = b"MM\0*" + struct.pack(">I", 12) + b"\1\2\3\4" + struct.pack(">H", len(fields)) + b"".join(struct.pack(">HHII", *f) for f in fields) + b"\0\0\0\0"
    df = spark.createDataFrame([(b"k", bytearray(file)), (b"n", None), (b"b", bytearray(b"no tiff"))], "key binary, media binary")
    rows = {bytes(r.key): r for r in tiff.read_pages(df, "key", "media").collect()}
    assert bytes(rows[b"k"].pixels) == b"\1\2\3\4" and rows[b"k"].width == 4
    assert b"n" not in rows and rows[b"b"].page == -1 and rows[b"b"].error


def altered(file, **tags):
    """A file with other values of tags (by number), or without those given as None."""
    (at,) = struct.unpack_from("<I", file, 4)
    (n,) = struct.unpack_from("<H", file, at)
    out = bytearray(file)
    for k in range(n):
        place = at + 2 + 12 * k
        tag = f"t{struct.unpack_from('<H', file, place)[0]}"
        if tag in tags:
            struct.pack_into("<H" if tags[tag] is None else "<I", out, place if tags[tag] is None else place + 8, 65000 if tags[tag] is None else tags[tag])
    return bytes(out)


def test_broken_files_give_error_rows(spark):
    """Whatever is wrong, a file gives one row with its error, and the others their pages."""
    strips, tiles = tiff.write(b"ab" * 288 * 3, strip_rows=1 << 16), tiff.write(b"ab" * 288 * 3, tile=16)
    bomb = tiff.write(b"\0" * 576 * 4, strip_rows=1 << 16)
    broken = [altered(strips, t256=None), altered(strips, t257=None), altered(strips, t273=None), altered(strips, t256=0), altered(strips, t277=0), altered(tiles, t322=0), altered(tiles, t323=0), altered(tiles, t322=None)]
    broken += [altered(strips, t257=0xFFFFFFFF), altered(tiles, t323=0xFFFFFFFF), altered(strips, t259=77), altered(strips, t273=1 << 30), altered(bomb, t257=1 << 20), strips[: len(strips) // 2], b"", b"II*\0", b"II*\0\xff\xff\xff\xff"]
    rows = [(b"good", bytearray(strips))] + [(b"bad%d" % k, bytearray(f)) for k, f in enumerate(broken)] + [(b"more", bytearray(tiles)), (b"none", None)]
    got = tiff.read_pages(spark.createDataFrame(rows, "key binary, media binary"), "key", "media").collect()
    assert {bytes(r.key) for r in got if r.error is None} == {b"good", b"more"}
    assert sorted(bytes(r.key) for r in got if r.page == -1 and r.error) == sorted(b"bad%d" % k for k in range(len(broken)))


def test_strips_are_unpacked_to_their_samples():
    assert tiff.inflate(zlib.compress(b"\0" * 100_000_000), 10) == b"\0" * 10
    assert len(tiff.lzw_decode(tiff.lzw_encode(b"a" * 100_000), 10)) < 100


def check(df, **how):
    got = sorted((str(r.doc_id), r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in tiff.digests(df, **how).collect())
    want = []
    for r in df.select("doc_id", "text").collect():
        raw = (r.text or "").encode()
        p = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        want.append((str(r.doc_id), len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:])))
    assert got == sorted(want)


@pytest.mark.parametrize("how", [{}, {"compression": tiff.LZW, "page_rows": 3}, {"compression": tiff.PACKBITS, "tile": 32}])
def test_digests(docs, odd, empty, how):
    check(docs.limit(60), **how)
    check(odd, **how)
    assert tiff.digests(empty, **how).count() == 0
    same = {(r.media_sha256, r.feature) for r in tiff.digests(odd).filter("doc_id in (7, 8)").collect()}
    assert len(same) == 1


def test_own_files_have_no_limit(spark, monkeypatch):
    """Files from elsewhere that name too many samples are refused, those written here are read whatever their size."""
    df = spark.createDataFrame([(1, "x" * 5000), (2, "y")], "doc_id long, text string")
    stored = tiff.store(df)
    pages = tiff.read_pages(stored, "key", "media", most=4000).collect()
    assert sorted(p.page for p in pages) == [-1, 0] and tiff.MOST < tiff.OWN
    assert {r.doc_id: r.n_bytes for r in tiff.digests(df).collect()} == {1: 5000, 2: 1}
