"""Media columns: TIFF files in a binary column, read page by page.

The reader walks the chain of image directories of each file, decodes PackBits, LZW or deflate
strips and tiles, undoes the horizontal predictor, and gives one row per page. The writer stores
byte strings losslessly as 8-bit gray pages. Files stay in the task that holds their row: nothing is
shuffled, and a page is at most PAGE_ROWS rows of its width.

Defined results: a null file, or one that is broken, gives no pages (a broken one names its error in
one row with page -1; so does one whose pages would hold more than MOST samples, or whose directories
name sizes of 0 or less data than their pages need: nothing is allocated before that is known); a null text is empty and is stored as padding; rows that repeat each get
their result; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: The format's tag numbers, compressions and field sizes.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_AT, SAMPLES, STRIP_ROWS, STRIP_BYTES, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 317
TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_BYTES = 322, 323, 324, 325
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
FIELD = {1: ("B", 1), 3: ("H", 2), 4: ("I", 4)}
#: Samples in a row and rows in a page of the writer; payloads are padded with PAD to whole rows.
ROW, PAGE_ROWS, PAD = 576, 256, 255
#: Samples that the pages of one file hold at most: of files from elsewhere, whose few bytes may name any size, and
#: of files written here, which are as large as their texts.
MOST, OWN = 1 << 30, 1 << 62
#: What a broken file can raise.
BROKEN = (ValueError, KeyError, IndexError, TypeError, ZeroDivisionError, OverflowError, MemoryError, struct.error, zlib.error)


def packbits_decode(data: bytes, most: int = MOST) -> bytes:
    out, i = [], 0
    while i < len(data) and len(out) <= most:
        n = data[i]
        if n < 128:
            out.append(data[i + 1 : i + 2 + n])
            i += n + 2
        elif n > 128:
            out.append(data[i + 1 : i + 2] * (257 - n))
            i += 2
        else:
            i += 1
    return b"".join(out)


def packbits_encode(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        run = i + 1
        while run < n and run - i < 128 and data[run] == data[i]:
            run += 1
        if run - i > 2:
            out += bytes([257 - (run - i), data[i]])
            i = run
            continue
        end = i + 1
        while end < n and end - i < 128 and data[end : end + 3] != data[end : end + 1] * 3:
            end += 1
        out += bytes([end - i - 1]) + data[i:end]
        i = end
    return bytes(out)


def inflate(data: bytes, most: int = MOST) -> bytes:
    """At most so many bytes: what a strip holds beyond its samples is not unpacked."""
    return zlib.decompressobj().decompress(data, most)


def lzw_decode(data: bytes, most: int = MOST) -> bytes:
    """Codes of 9 to 12 bits, high bits first; 256 clears the table, 257 ends; widths grow one code early."""
    out, table, width, held, bits, last = [], [bytes([i]) for i in range(256)] + [b"", b""], 9, 0, 0, None
    left = most
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        if left <= 0:
            break
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            break
        if code == 256:
            del table[258:]
            width, last = 9, None
            continue
        if last is None:
            entry = table[code]
        else:
            entry = table[code] if code < len(table) else last + last[:1]
            table.append(last + entry[:1])
        out.append(entry)
        left -= len(entry)
        last = entry
        width = min(12, (len(table) + 1).bit_length())
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    held, bits, width, out = 0, 0, 9, bytearray()

    def put(code: int) -> None:
        nonlocal held, bits
        held, bits = (held << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append((held >> bits) & 255)
            held &= (1 << bits) - 1

    put(256)
    table, size, prefix = {}, 258, None
    for byte in data:
        if prefix is None:
            prefix = byte
            continue
        if (found := table.get((prefix, byte))) is not None:
            prefix = found
            continue
        put(prefix)
        table[prefix, byte], size = size, size + 1
        width = min(12, size.bit_length())
        if size >= 4094:
            put(256)
            table, size, width = {}, 258, 9
        prefix = byte
    if prefix is not None:
        put(prefix)
        width = min(12, (size + 1).bit_length())
    put(257)
    if bits:
        out.append((held << (8 - bits)) & 255)
    return bytes(out)


ENCODE = {NONE: bytes, PACKBITS: packbits_encode, LZW: lzw_encode, DEFLATE: lambda d: zlib.compress(d, 1)}
DECODE = {NONE: lambda d, most: d[:most], PACKBITS: packbits_decode, LZW: lzw_decode, DEFLATE: inflate, OLD_DEFLATE: inflate}


def write(payload: bytes, width: int = ROW, page_rows: int = PAGE_ROWS, compression: int = DEFLATE, predictor: int = 2, tile: int = 0, strip_rows: int = 64) -> bytes:
    """A little-endian TIFF of gray pages that hold the payload, whose length is a multiple of width."""
    image = np.frombuffer(payload, "u1").reshape(-1, width)
    out, link = bytearray(b"II*\0\0\0\0\0"), 4
    for top in range(0, len(image), page_rows):
        page = image[top : top + page_rows]
        if tile:
            down, across = -(-len(page) // tile), -(-width // tile)
            padded = np.zeros((down * tile, across * tile), "u1")
            padded[: len(page), :width] = page
            cells = [padded[y * tile : (y + 1) * tile, x * tile : (x + 1) * tile] for y in range(down) for x in range(across)]
        else:
            cells = [page[y : y + strip_rows] for y in range(0, len(page), strip_rows)]
        places, sizes = [], []
        for cell in cells:
            if predictor == 2:
                cell = np.diff(cell, axis=1, prepend=np.zeros((len(cell), 1), "u1"))
            data = ENCODE[compression](cell.tobytes())
            places.append(len(out))
            sizes.append(len(data))
            out += data + b"\0" * (len(data) % 2)
        tags = [(WIDTH, [width]), (HEIGHT, [len(page)]), (BITS, [8]), (COMPRESSION, [compression]), (PHOTOMETRIC, [1]), (SAMPLES, [1]), (PREDICTOR, [predictor])]
        tags += [(TILE_WIDTH, [tile]), (TILE_HEIGHT, [tile]), (TILE_AT, places), (TILE_BYTES, sizes)] if tile else [(STRIP_AT, places), (STRIP_ROWS, [strip_rows]), (STRIP_BYTES, sizes)]
        fields = []
        for tag, values in sorted(tags):
            if len(values) == 1:
                fields.append(struct.pack("<HHII", tag, 4, 1, values[0]))
            else:
                fields.append(struct.pack("<HHII", tag, 4, len(values), len(out)))
                out += struct.pack(f"<{len(values)}I", *values)
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(fields)) + b"".join(fields)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def directories(data: bytes):
    """The tags of each image directory, in the order of the chain; a chain that returns to itself ends there."""
    if data[:4] not in (b"II*\0", b"MM\0*"):
        raise ValueError("not a TIFF file")
    end = "<" if data[:2] == b"II" else ">"
    (at,), seen = struct.unpack_from(f"{end}I", data, 4), set()
    while at and at not in seen:
        seen.add(at)
        (n,) = struct.unpack_from(f"{end}H", data, at)
        tags = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(f"{end}HHI", data, at + 2 + 12 * k)
            if kind in FIELD:
                code, size = FIELD[kind]
                place = at + 10 + 12 * k
                if count * size > 4:
                    (place,) = struct.unpack_from(f"{end}I", data, place)
                tags[tag] = struct.unpack_from(f"{end}{count}{code}", data, place)
        yield tags
        (at,) = struct.unpack_from(f"{end}I", data, at + 2 + 12 * n)


def page_pixels(data: bytes, tags: dict, most: int = MOST) -> np.ndarray:
    """Rows of samples of one page with 8-bit samples side by side."""
    one = lambda tag, default=None: tags[tag][0] if tag in tags else default
    width, height, samples = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
    if set(tags.get(BITS, (8,))) != {8} or one(COMPRESSION, NONE) not in DECODE:
        raise ValueError("samples or compression of another kind")
    decode, predictor = DECODE[one(COMPRESSION, NONE)], one(PREDICTOR, 1)
    tiled = TILE_AT in tags
    wide, high = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (width, min(one(STRIP_ROWS, height), height))
    places, sizes = (tags[TILE_AT], tags[TILE_BYTES]) if tiled else (tags[STRIP_AT], tags[STRIP_BYTES])
    if min(width, height, samples, wide, high) < 1:
        raise ValueError("a page, strip or tile of size 0")
    across = -(-width // wide)
    if max(height * width, (high if tiled else 1) * wide) * samples > most:
        raise ValueError("a page of too many samples")
    if len(places) < across * -(-height // high):
        raise ValueError("a page without all of its strips or tiles")
    page = np.zeros((height, width * samples), "u1")
    for k, (place, size) in enumerate(zip(places, sizes, strict=True)):
        y, x = k // across * high, k % across * wide
        if y >= height:
            break
        rows = high if tiled else min(high, height - y)
        need = rows * wide * samples
        cell = np.frombuffer(decode(data[place : place + size], need), "u1")[:need].reshape(rows, wide, samples)
        if predictor == 2:
            cell = np.cumsum(cell, axis=1, dtype="u1")
        cell = cell[: height - y, : width - x].reshape(min(rows, height - y), -1)
        page[y : y + len(cell), x * samples : x * samples + cell.shape[1]] = cell
    return page


PAGES = "key binary, file_no long, page int, pages int, width int, height int, samples int, pixels binary, error string"


def read_pages(files: DataFrame, key: str, media: str, most: int = MOST) -> DataFrame:
    """One row per page, in the order of rows and pages: key (bytes, as given), file_no (place of the
    file in its partition), page, pages, width, height, samples, pixels, error."""

    def read(batches):
        no = 0
        for batch in batches:
            for given, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, held = [], 0
                try:
                    found = list(directories(data)) if data is not None else []
                    for k, tags in enumerate(found):
                        held += tags[WIDTH][0] * tags[HEIGHT][0] * tags.get(SAMPLES, (1,))[0]
                        if held > most:
                            raise ValueError("pages of too many samples")
                        pixels, samples = page_pixels(data, tags, most), tags.get(SAMPLES, (1,))[0]
                        rows.append((given, no, k, len(found), pixels.shape[1] // samples, pixels.shape[0], samples, pixels.tobytes(), None))
                except BROKEN as wrong:
                    rows = [(given, no, -1, 0, 0, 0, 0, None, f"{type(wrong).__name__}: {wrong}")]
                no += 1
                for lo in range(0, len(rows), 32):
                    yield _batch(rows[lo : lo + 32])

    return files.select(F.col(key).alias("key"), F.col(media).alias("media")).mapInArrow(read, PAGES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string())
    names = [f.split()[0] for f in PAGES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def store(docs: DataFrame, **how) -> DataFrame:
    """key, media: each text's UTF-8 bytes, padded to whole rows, as a TIFF file.

    key packs what the row needs later: a flag for a null doc_id, doc_id, bytes of the text, and of the file its length and SHA-256.
    """

    def encode(batches):
        for batch in batches:
            keys, files = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                rows = max(1, -(-len(raw) // ROW))
                file = write(raw + bytes([PAD]) * (rows * ROW - len(raw)), **how)
                keys.append(struct.pack("<BqQQ", doc_id is None, doc_id or 0, len(raw), len(file)) + hashlib.sha256(file).digest())
                files.append(file)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(files, pa.binary())], ["key", "media"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "key binary, media binary")


def feature(counts: np.ndarray) -> str:
    """Mean, deviation and entropy of the samples, and their shares in eight equal ranges, in thousandths."""
    total = counts.sum()
    values = np.arange(256)
    mean = (counts * values).sum() / total
    deviation = np.sqrt((counts * (values - mean) ** 2).sum() / total)
    p = counts[counts > 0] / total
    shares = counts.reshape(8, 32).sum(1) * 1000 // total
    return f"mean={mean:.3f};dev={deviation:.3f};entropy={-(p * np.log2(p)).sum():.4f};shares=" + ",".join(map(str, shares))


def digests(docs: DataFrame, **how) -> DataFrame:
    """Per document: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, n_pages, feature.

    A file's pages come one after another in their partition and are folded into its row there.
    """
    common.prepare(docs.sparkSession)

    def fold(batches):
        done, now = [], None
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("key", "file_no", "page", "pages", "pixels", "error")]
            for key, no, _, pages, pixels, error in zip(*columns, strict=True):
                if error:
                    raise ValueError(error)
                if now is None or now["no"] != no:
                    if now:
                        done.append(_row(now))
                    now = {"no": no, "key": key, "pages": pages, "bytes": 0, "sha": hashlib.sha256(), "tail": b"", "counts": np.zeros(256, "i8")}
                now["sha"].update(pixels)
                now["bytes"] += len(pixels)
                now["tail"] = (now["tail"] + pixels[-32:])[-32:]
                now["counts"] += np.bincount(np.frombuffer(pixels, "u1"), minlength=256)
                if len(done) >= 512:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done = []
        if now:
            done.append(_row(now))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    longs, texts = ("doc_id", "n_bytes", "payload_bytes", "tail_crc32", "media_bytes", "n_pages"), ("payload_sha256", "media_sha256", "feature")
    schema = pa.schema([(c, pa.int64()) for c in longs] + [(c, pa.string()) for c in texts])
    kinds = ", ".join([f"{c} long" for c in longs] + [f"{c} string" for c in texts])
    return read_pages(store(docs, **how), "key", "media", most=OWN).mapInArrow(fold, kinds)  # own files hold what the texts hold


def _row(now: dict) -> dict:
    null, doc_id, n_bytes, media_bytes = struct.unpack_from("<BqQQ", now["key"])
    return {
        "doc_id": None if null else doc_id,
        "n_bytes": n_bytes,
        "payload_bytes": now["bytes"],
        "payload_sha256": now["sha"].hexdigest(),
        "tail_crc32": zlib.crc32(now["tail"]),
        "media_bytes": media_bytes,
        "media_sha256": now["key"][25:].hex(),
        "n_pages": now["pages"],
        "feature": feature(now["counts"]),
    }
