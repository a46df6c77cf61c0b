"""TIFF columns: a writer and a reader of 8-bit pages, and text stored as samples.

The reader walks the image directories of a file (either byte order, strips or tiles,
chunky or planar samples), decodes PackBits, LZW or deflate, undoes the horizontal
predictor and gives one row per page. The writer makes such files losslessly.

Defined results: a null or empty file has no page; a page that cannot be read gives a row
with the reason in ``error`` and no samples, and the walk goes on with the next directory; a
directory chain that returns to an earlier place ends there. In the text form, a null text
is empty; the payload is padded with bytes 32 to a positive multiple of 192, so an empty
text has 192 bytes. Equal texts give equal files; ids and other columns play no part.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow

# Tags, compressions and field types of the format.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_AT, SAMPLES, ROWS_PER_STRIP, STRIP_SIZES, PLANAR = 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_SIZES = 317, 322, 323, 324, 325
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
FIELDS = {1: ("B", 1), 3: ("H", 2), 4: ("I", 4), 16: ("Q", 8)}

#: Bytes of a row of stored text, and of a strip.
ROW, STRIP = 192, 1 << 16


# ---- codecs --------------------------------------------------------------------------------

def packbits_encode(data: bytes) -> bytes:
    """Runs of three and more as runs, the rest as literals."""
    a = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(a)) + 1
    out, literal = bytearray(), bytearray()

    def flush():
        for i in range(0, len(literal), 128):
            part = literal[i : i + 128]
            out.append(len(part) - 1)
            out.extend(part)
        literal.clear()

    for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(a)]):
        n = hi - lo
        if n < 3:
            literal.extend(data[lo:hi])
            continue
        flush()
        while n > 1:
            k = min(n, 128)
            out += bytes([257 - k, data[lo]])
            n -= k
        if n:
            literal.append(data[lo])
    flush()
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while len(out) < size:
        if i >= len(data):
            raise ValueError("PackBits data ends early")
        n = data[i]
        if n < 128:
            if i + 2 + n > len(data):
                raise ValueError("PackBits data ends early")
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        elif n > 128:
            out += data[i + 1 : i + 2] * (257 - n)
            i += 2
        else:
            i += 1
    return bytes(out[:size])


_CLEAR, _STOP = 256, 257


def lzw_encode(data: bytes) -> bytes:
    out, acc, bits, width = bytearray(), 0, 0, 9
    table = {bytes([i]): i for i in range(256)}
    free = 258

    def put(code):
        nonlocal acc, bits
        acc = acc << width | code
        bits += width
        while bits >= 8:
            bits -= 8
            out.append(acc >> bits & 255)
        acc &= (1 << bits) - 1

    put(_CLEAR)
    word = b""
    for c in data:
        nxt = word + bytes([c])
        if nxt in table:
            word = nxt
            continue
        put(table[word])
        table[nxt] = free
        free += 1
        if free == 4094:  # before codes of 13 bits would be needed
            put(_CLEAR)
            table, free, width = {bytes([i]): i for i in range(256)}, 258, 9
        elif free + 1 > 1 << width:  # widths change one code early in this format
            width += 1
        word = bytes([c])
    if word:
        put(table[word])
        free += 1
        if free + 1 > 1 << width and width < 12:
            width += 1
    put(_STOP)
    if bits:
        out.append(acc << (8 - bits) & 255)
    return bytes(out)


def lzw_decode(data: bytes, size: int) -> bytes:
    out, acc, bits, width, i = [], 0, 0, 9, 0
    base = [bytes([k]) for k in range(256)] + [b"", b""]
    table, last, made = list(base), b"", 0
    while made < size:
        while bits < width:
            if i >= len(data):
                raise ValueError("LZW data ends early")
            acc, bits, i = (acc << 8 | data[i]) & 0xFFFFFF, bits + 8, i + 1
        bits -= width
        code = acc >> bits & (1 << width) - 1
        if code == _CLEAR:
            table, last, width = list(base), b"", 9
            continue
        if code == _STOP:
            break
        if code < len(table):
            word = table[code]
        elif code == len(table) and last:
            word = last + last[:1]
        else:
            raise ValueError("LZW code out of range")
        out.append(word)
        made += len(word)
        if last:
            table.append(last + word[:1])
        last = word
        if len(table) + 1 >= 1 << width and width < 12:
            width += 1
    if made < size:
        raise ValueError("LZW data ends early")
    return b"".join(out)[:size]


def inflate(data: bytes, size: int) -> bytes:
    out = zlib.decompressobj().decompress(data, size)
    if len(out) < size:
        raise ValueError("deflate data ends early")
    return out


ENCODERS = {NONE: bytes, PACKBITS: packbits_encode, LZW: lzw_encode, DEFLATE: lambda d: zlib.compress(d, 1)}


def _decode(kind: int, data: bytes, size: int) -> bytes:
    if kind == NONE:
        if len(data) < size:
            raise ValueError("data ends early")
        return data[:size]
    if kind == PACKBITS:
        return packbits_decode(data, size)
    if kind == LZW:
        return lzw_decode(data, size)
    if kind in (DEFLATE, OLD_DEFLATE):
        return inflate(data, size)
    raise ValueError(f"compression {kind} is not supported")


# ---- files ---------------------------------------------------------------------------------

@dataclass
class Page:
    """Samples of one directory: (rows, columns, samples), or the reason why there are none."""

    samples: np.ndarray | None
    width: int = 0
    height: int = 0
    compression: int = 0
    error: str | None = None


def write(pages: list[np.ndarray], compression: int = DEFLATE, predictor: bool = True, tile: tuple[int, int] | None = None,
          order: str = "<", strip: int = STRIP) -> bytes:
    """A file of 8-bit pages, each (rows, columns) or (rows, columns, samples); ``tile`` is (rows, columns), multiples of 16."""
    out = bytearray(struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 0))
    link = 4  # where the place of the next directory goes
    for page in pages:
        page = page[:, :, None] if page.ndim == 2 else page
        h, w, c = page.shape
        th, tw = tile or (max(1, strip // max(1, w * c)), w)
        places, sizes = [], []
        for y in range(0, h, th):
            for x in range(0, w, tw):
                block = page[y : y + th, x : x + tw]
                if tile:
                    block = np.pad(block, ((0, th - block.shape[0]), (0, tw - block.shape[1]), (0, 0)))
                if predictor:
                    block = np.concatenate([block[:, :1], np.diff(block, axis=1)], 1)
                data = ENCODERS[compression](block.tobytes())
                places.append(len(out))
                sizes.append(len(data))
                out += data
        entries = [(WIDTH, 4, [w]), (HEIGHT, 4, [h]), (BITS, 3, [8] * c), (COMPRESSION, 3, [compression]), (PHOTOMETRIC, 3, [2 if c == 3 else 1]),
                   (SAMPLES, 3, [c]), (PLANAR, 3, [1]), (PREDICTOR, 3, [2 if predictor else 1])]
        entries += [(TILE_WIDTH, 4, [tw]), (TILE_HEIGHT, 4, [th]), (TILE_AT, 4, places), (TILE_SIZES, 4, sizes)] if tile else \
                   [(STRIP_AT, 4, places), (ROWS_PER_STRIP, 4, [th]), (STRIP_SIZES, 4, sizes)]
        records = []
        for tag, kind, values in sorted(entries):
            code, size = FIELDS[kind]
            body = struct.pack(f"{order}{len(values)}{code}", *values)
            if len(body) > 4:
                out += b"\0" * (len(out) % 2)
                at, body = len(out), body
                out += body
                body = struct.pack(order + "I", at)
            records.append(struct.pack(order + "HHI", tag, kind, len(values)) + body.ljust(4, b"\0"))
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(records)) + b"".join(records)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def _directory(data: bytes, at: int, order: str) -> tuple[dict[int, tuple], int]:
    (n,) = struct.unpack_from(order + "H", data, at)
    tags: dict[int, tuple] = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        if kind not in FIELDS:
            continue
        code, size = FIELDS[kind]
        where = at + 10 + 12 * i
        if count * size > 4:
            (where,) = struct.unpack_from(order + "I", data, where)
        tags[tag] = struct.unpack_from(f"{order}{count}{code}", data, where)
    (following,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)
    return tags, following


def _page(data: bytes, tags: dict[int, tuple]) -> np.ndarray:
    one = lambda tag, default=None: tags[tag][0] if tags.get(tag) else default
    w, h, c, kind = one(WIDTH), one(HEIGHT), one(SAMPLES, 1), one(COMPRESSION, NONE)
    if not w or not h:
        raise ValueError("no size")
    if set(tags.get(BITS, (1,))) != {8}:
        raise ValueError("only 8-bit samples are supported")
    tiled, planes = TILE_AT in tags, c if one(PLANAR, 1) == 2 else 1
    th, tw = (one(TILE_HEIGHT), one(TILE_WIDTH)) if tiled else (min(h, one(ROWS_PER_STRIP, h)), w)
    places, sizes = (tags.get(TILE_AT), tags.get(TILE_SIZES)) if tiled else (tags.get(STRIP_AT), tags.get(STRIP_SIZES))
    if not places or not sizes or not th or not tw:
        raise ValueError("no strips or tiles")
    per = c // planes if planes > 1 else c
    out = np.empty((h, w, c), np.uint8)
    blocks = [(p, y, x) for p in range(planes) for y in range(0, h, th) for x in range(0, w, tw)]
    if len(blocks) > min(len(places), len(sizes)):
        raise ValueError("strips or tiles are missing")
    for (p, y, x), at, size in zip(blocks, places, sizes):
        rows = th if tiled else min(th, h - y)
        block = np.frombuffer(_decode(kind, data[at : at + size], rows * tw * per), np.uint8).reshape(rows, tw, per)
        if one(PREDICTOR, 1) == 2:
            block = np.cumsum(block, axis=1, dtype=np.uint8)
        elif one(PREDICTOR, 1) != 1:
            raise ValueError("only the horizontal predictor is supported")
        out[y : y + th, x : x + tw, p * per : (p + 1) * per] = block[: h - y, : w - x]
    return out


def read(data: bytes | None) -> list[Page]:
    """Every page of a file, in the order of its directories."""
    if not data:
        return []
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        return [Page(None, error="not a TIFF file")]
    (at,) = struct.unpack_from(order + "I", data, 4)
    pages, seen = [], set()
    while at and at not in seen:
        seen.add(at)
        try:
            tags, following = _directory(data, at, order)
        except struct.error:
            pages.append(Page(None, error="the directory is cut off"))
            break
        try:
            s = _page(data, tags)
            pages.append(Page(s, s.shape[1], s.shape[0], tags.get(COMPRESSION, (NONE,))[0]))
        except (ValueError, zlib.error, struct.error, MemoryError, IndexError, OverflowError) as e:
            pages.append(Page(None, *(tags.get(t, (0,))[0] for t in (WIDTH, HEIGHT, COMPRESSION)), error=str(e)))
        at = following
    return pages


# ---- Spark ---------------------------------------------------------------------------------

PAGES = "file_id long, page int, width long, height long, channels int, compression int, samples binary, error string"


def read_pages(files: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """One row per page of the files in a binary column: size, compression and samples, or the reason why not."""

    def run(batches):
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string()]
        names = ["file_id", "page", "width", "height", "channels", "compression", "samples", "error"]
        for batch in batches:
            for file_id, media in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [(file_id, i, p.width, p.height, p.samples.shape[2] if p.samples is not None else 0, p.compression,
                         p.samples.tobytes() if p.samples is not None else None, p.error) for i, p in enumerate(read(media.as_py()))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    return files.select(F.col(id_col).cast("long").alias("file_id"), F.col(media_col).cast("binary").alias("media")).mapInArrow(run, PAGES)


def payload(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b" " * (-len(raw) % ROW or (0 if raw else ROW))


def features(samples: np.ndarray) -> str:
    """Mean, range and an 8 x 8 brightness hash of a page: which cells of a grid are brighter than the page."""
    flat = samples.reshape(samples.shape[0], -1)
    h, w = flat.shape
    rows = np.add.reduceat(flat.astype(np.int64), np.arange(8) * h // 8 if h >= 8 else np.arange(h), 0)
    rows = np.concatenate([rows, np.zeros((8 - len(rows), w), np.int64)]) if len(rows) < 8 else rows
    cells = rows.reshape(8, 8, w // 8).sum(2)
    n = np.diff(np.append(np.arange(8) * h // 8, h)) if h >= 8 else np.r_[np.ones(h, np.int64), np.zeros(8 - h, np.int64)]
    total, size = int(cells.sum()), h * w
    bright = cells * size > total * (n * (w // 8))[:, None]
    return f"{total * 1000 // size}:{int(flat.min())}-{int(flat.max())}:{int(''.join('01'[b] for b in bright.ravel().tolist()), 2):016x}"


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", compression: int = DEFLATE) -> DataFrame:
    """doc_id, n_bytes, media: each text as a one-page file of rows of ``ROW`` samples."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sizes, media = [], []
                for t in part.column(1).to_pylist():
                    p = payload(t)
                    sizes.append(len((t or "").encode("utf-8", "surrogatepass")))
                    media.append(write([np.frombuffer(p, np.uint8).reshape(-1, ROW)], compression))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def media_report(docs: DataFrame) -> DataFrame:
    """Digest and features of every stored text, from the pages read back."""

    def run(batches):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        for batch in batches:
            out = []
            for doc_id, n, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                media = media.as_py()
                (page,) = read(media)
                data = page.samples.tobytes()
                out.append((doc_id, n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(media), hashlib.sha256(media).hexdigest(), features(page.samples)))
            cols = list(zip(*out)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names)

    return store_texts(docs).mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
                                             "media_sha256 string, feature string")
