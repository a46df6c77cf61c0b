"""Main text of web pages by differencing each page with its neighbours in URL order.

Every page becomes lines of text, one a block element. Pages of a host are put in the order of
their URL paths, each is paired with the pages before and after it, the lines of a pair are
aligned by a longest common subsequence, and lines that a pair shares are deleted: menus,
notices and footers repeat from page to page, an article does not. Lines of an ``article`` (or
``main``) element serve the alignment and are never deleted. What differencing cannot see,
because it differs from page to page (adverts, comments), goes by the element that holds it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

# Fixed values of the markup language: elements without content, elements whose content is not
# markup, elements that start a block, and what a new element closes.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg object canvas audio video select".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td
    tfoot th thead tr ul""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
          "tbody": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "tfoot": {"td", "th", "tr", "tbody", "thead"}}
FENCE = frozenset("ul ol menu dl table article main section div body".split())

#: Elements outside the main text, and words of a class, id or role that say the same.
OUTSIDE = frozenset("nav header footer aside form menu dialog button search label".split())
WORDS = frozenset("""ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner nav navbar
    navigation menu breadcrumb breadcrumbs footer sidebar aside widget widgets cookie cookies consent gdpr notice notices popup modal
    newsletter subscribe comment comments commentlist disqus respond pagination pager share sharing social related complementary
    contentinfo search""".split())
PAGE_HEADERS = frozenset("header masthead site-header page-header main-header global-header top-header siteheader pageheader".split())
NEGATION = frozenset("no not has have with without is can".split())

OUTER, OTHER, MAIN, ARTICLE, MARKED = -1, 0, 1, 2, 3

_ATTRS = r"""((?>=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)"""
_TAG = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)" + _ATTRS + r">?|<[!?/][^>]*>?", re.S)
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Bits of an alignment table that are held at once.
TABLE_BITS = 1 << 28


def _marked(attrs: dict[str, str]) -> bool:
    for name in (attrs.get("class", "") + " " + attrs.get("id", "") + " " + attrs.get("role", "")).lower().split():
        pieces = re.split(r"[-_]+", name)
        if name in PAGE_HEADERS or (pieces[0] not in NEGATION and any(p in WORDS for p in pieces)):
            return True
    return False


def page_lines(html: str) -> list[tuple[str, int]]:
    """(text, kind) of every block of a page in order: character references decoded, white space made one space."""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int, bool]] = []  # element, kind of its text, whether an inner article may still be main text
    buffers: dict[int, list[str]] = {}

    def flush() -> None:
        for kind, parts in buffers.items():
            raw = "".join(parts)
            text = " ".join((unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append((text, kind))
        buffers.clear()

    def close(names, fence=frozenset()) -> None:
        """Close open elements through the nearest of ``names``, unless a fence stands before it."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in fence:
                return

    at, kind = 0, OTHER
    while True:
        lt = html.find("<", at)
        m = _TAG.match(html, lt) if lt >= 0 else None
        if lt >= 0 and m is None:  # a bare "<" is text
            buffers.setdefault(kind, []).append(html[at : lt + 1])
            at = lt + 1
            continue
        piece = html[at:lt] if lt >= 0 else html[at:]
        if piece:
            buffers.setdefault(kind, []).append(piece)
        if lt < 0:
            flush()
            return out
        at = m.end()
        if m[2] is None:
            continue  # comment, doctype
        name = m[2].lower()
        if m[1]:
            if name in BLOCK:
                flush()
            if name == "p" and not any(e[0] == "p" for e in stack):
                continue
            close({name})
        else:
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
                continue
            if name == "br":
                buffers.setdefault(kind, []).append(" ")
                continue
            if name in BLOCK:
                flush()
                close({"p"}, {"td", "th", "caption", "button", "table"})
            if name in CLOSES:
                close(CLOSES[name], FENCE - {name})
            if name in VOID:
                continue
            attrs = {k.lower(): a or b or c for k, a, b, c in _NAMED.findall(m[3])} if "=" in m[3] else {}
            inner, soft = (stack[-1][1], stack[-1][2]) if stack else (OTHER, True)
            article = name == "article" or attrs.get("itemprop", "").lower() == "articlebody"
            main = name == "main" or attrs.get("role", "").lower() == "main"
            if name in OUTSIDE:
                in_heading = name == "header" and inner in (MAIN, ARTICLE)  # an article's own header keeps its headings
                inner, soft = MARKED, in_heading
            elif name not in ("html", "body", "main") and attrs and _marked(attrs):
                inner, soft = MARKED, soft and not article
            elif (article or main) and (inner != MARKED or soft):
                inner, soft = (ARTICLE if article else max(MAIN, inner)), True
            elif inner == MARKED and soft and name in ("h1", "h2", "h3", "h4", "h5", "h6") and stack and _in_own_header(stack):
                inner = next(k for _, k, _ in reversed(stack) if k in (MAIN, ARTICLE))
            stack.append((name, inner, soft))
        kind = stack[-1][1] if stack else OTHER


def _in_own_header(stack: list[tuple[str, int, bool]]) -> bool:
    """Whether the innermost element outside the main text is the header of an article."""
    for name, kind, _ in reversed(stack):
        if kind != MARKED:
            return False
        if name in OUTSIDE:
            return name == "header" and any(k in (MAIN, ARTICLE) for _, k, _ in stack)
    return False


def _rows_of(masks: list[int], m: int) -> np.ndarray:
    """Bits of the last row of an alignment as a length of the common subsequence for every prefix."""
    raw = np.frombuffer(masks[-1].to_bytes((m + 7) // 8, "little"), np.uint8)
    return np.concatenate(([0], np.cumsum(1 - np.unpackbits(raw, bitorder="little")[:m].astype(np.int64))))


def _sweep(a: list, b: list, keep: bool) -> list[int]:
    """Bit rows of the alignment of ``a`` with ``b``; a zero bit is a step of the subsequence's length."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v, rows = full, []
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        if keep:
            rows.append(v)
    return rows if keep else [v]


def common_places(a: list, b: list) -> tuple[list[int], list[int]]:
    """Places in ``a`` and in ``b`` of a longest common subsequence, in bounded memory for any length."""
    lo, n, m = 0, len(a), len(b)
    while lo < n and lo < m and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < n - lo and hi < m - lo and a[n - 1 - hi] == b[m - 1 - hi]:
        hi += 1
    in_a, in_b = set(a[lo : n - hi]), set(b[lo : m - hi])
    pa_, pb = [i for i in range(lo, n - hi) if a[i] in in_b], [j for j in range(lo, m - hi) if b[j] in in_a]
    x, y = _middle([a[i] for i in pa_], [b[j] for j in pb])
    head, tail = list(range(lo)), range(hi)
    return head + [pa_[i] for i in x] + [n - hi + k for k in tail], head + [pb[j] for j in y] + [m - hi + k for k in tail]


def _middle(a: list, b: list) -> tuple[list[int], list[int]]:
    if not a or not b:
        return [], []
    if len(a) == 1:
        return ([0], [b.index(a[0])]) if a[0] in b else ([], [])
    if len(a) * len(b) > TABLE_BITS:  # halves, joined where their lengths add up to most
        half = len(a) // 2
        left = _rows_of(_sweep(a[:half], b, False), len(b))
        right = _rows_of(_sweep(a[half:][::-1], b[::-1], False), len(b))[::-1]
        cut = int(np.argmax(left + right))
        x1, y1 = _middle(a[:half], b[:cut])
        x2, y2 = _middle(a[half:], b[cut:])
        return x1 + [half + i for i in x2], y1 + [cut + j for j in y2]
    rows, i, j, x, y = _sweep(a, b, True), len(a), len(b), [], []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        elif i > 1 and not rows[i - 2] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            x.append(i)
            y.append(j)
    return x[::-1], y[::-1]


#: Characters of markup whose pages are handed on together.
_BATCH = 1 << 22
_SIGNED = pa.schema([("url", pa.string()), ("digest", pa.binary()), ("marks", pa.list_(pa.int64()))])
_PACKED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.binary()), ("kinds", pa.list_(pa.int8())), ("packed", pa.binary())])
_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_shared", pa.int64()), ("n_marked", pa.int64())])
_DDL = {"_SIGNED": "url string, digest binary, marks array<long>", "_PACKED": "page_id long, url string, digest binary, kinds array<byte>, packed binary",
        "_TEXTS": "page_id long, url string, text string, n_chars long, n_shared long, n_marked long"}


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def _in_batches(rows: Iterator[tuple[int, tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(size, row) pairs as record batches of about ``_BATCH``."""
    held, size = [], 0
    for n, row in rows:
        held.append(row)
        size += n + 100
        if size > _BATCH:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _digest(lines: list[tuple[str, int]]) -> bytes:
    return hashlib.md5("\n".join(t for t, _ in lines).encode()).digest()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """url, digest of all lines and a 64-bit mark of each line; marks only ever meet those of one neighbour."""
    def rows():
        for b in batches:
            for url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                lines = page_lines(html) if html else []
                marks = [int.from_bytes(hashlib.md5(t.encode()).digest()[:8], "little", signed=True) for t, _ in lines]
                yield len(html or ""), (url, _digest(lines), marks)

    yield from _in_batches(rows(), _SIGNED)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page_id, url, digest, kinds and the compressed lines that can be part of the text; the others' places stay empty."""
    pack = zstandard.ZstdCompressor()

    def rows():
        for b in batches:
            for page, url, html in zip(*[b.column(i).to_pylist() for i in range(3)]):
                lines = page_lines(html) if html else []
                best = max((k for _, k in lines if k in (MAIN, ARTICLE)), default=OTHER)
                kinds = [k if k in (best, MARKED) else OUTER for _, k in lines]
                yield len(html or ""), (page, url, _digest(lines), kinds, pack.compress("\n".join(t if k == best else "" for t, k in lines).encode()))

    yield from _in_batches(rows(), _PACKED)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of every page: its candidate lines without those that it shares."""
    pack = zstandard.ZstdDecompressor()

    def rows():
        for b in batches:
            for page, url, kinds, packed, shared in zip(*[b.column(i).to_pylist() for i in range(5)]):
                lines = pack.decompress(packed).decode().split("\n")
                gone = {i for i in shared or () if kinds[i] not in (MAIN, ARTICLE)}
                text = "\n\n".join(t for i, (t, k) in enumerate(zip(lines, kinds)) if k in (OTHER, MAIN, ARTICLE) and i not in gone)
                yield len(text), (page, url, text, len(text), len(gone), sum(k == MARKED for k in kinds))

    yield from _in_batches(rows(), _TEXTS)


def url_path(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; scheme, user, port, query and fragment play no part. No host: null."""
    rest = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)", 1)
    host = F.lower(F.regexp_replace(rest, r"^.*@|:[0-9]*$", ""))
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)", 2)
    return F.when(F.length(host) > 0, host), F.regexp_replace(path, r"(?:\.html?|/)$", "")


_SHARED = "host string, digest binary, shared array<int>"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("host", pa.string()), ("digest", pa.binary()), ("shared", pa.list_(pa.int32()))])
    for b in batches:
        for i in range(b.num_rows):
            host, digest, marks, before, after = (b.column(c)[i].as_py() for c in range(5))
            found = set(common_places(marks, before)[0]) if before else set()
            found |= set(common_places(marks, after)[0]) if after else set()
            yield pa.RecordBatch.from_arrays([pa.array([host]), pa.array([digest], pa.binary()), pa.array([sorted(found)], pa.list_(pa.int32()))], schema=schema)


def shared_lines(pages: DataFrame) -> DataFrame:
    """(host, digest, n, shared): the places of lines that a page shares with the page before or after it.

    ``pages`` has host, path, digest and marks (a mark a line). Pages of one host with the same lines
    throughout count as one page, as their lines say nothing about each other. Pages are cut into
    ranges of (host, path); the ends of ranges meet through one row a range, so a host of any size
    is never one task.
    """
    units = pages.where("host IS NOT NULL AND size(marks) > 0").groupBy("host", "digest").agg(
        F.min("path").alias("path"), F.first("marks").alias("marks"), F.count(F.lit(1)).alias("n"))
    rows = cut_lineage(units.repartitionByRange("host", "path", "digest").withColumn("part", F.spark_partition_id()))
    order = F.struct("host", "path", "digest")
    page = F.struct("host", "marks")
    ends = rows.groupBy("part").agg(F.min_by(page, order).alias("head"), F.max_by(page, order).alias("tail"))
    across = Window.orderBy("part")  # one row a range
    ends = ends.select("part", F.lag("tail").over(across).alias("carry_before"), F.lead("head").over(across).alias("carry_after"))
    inside = Window.partitionBy("part").orderBy("host", "path", "digest")
    met = rows.withColumn("before", F.lag(page).over(inside)).withColumn("after", F.lead(page).over(inside)).join(ends, "part")
    near = [F.coalesce(c, f"carry_{c}") for c in ("before", "after")]
    pairs = met.select("host", "digest", "marks", *[F.when(c["host"] == F.col("host"), c["marks"]).alias(a) for c, a in zip(near, ("before", "after"))])
    shared = cut_lineage(pairs.mapInArrow(_shared, _SHARED))
    return shared.join(rows.select("host", "digest", "n"), ["host", "digest"])


#: A page whose lines this share of all pages have is looked up by broadcast: at most as many such pages as the number says.
HOT = 1000


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_shared and n_marked of every page.

    ``text``: the blocks of the main text, in page order, joined by two line feeds. If the page has
    text in an ``article`` element these are its blocks, else those of ``main``, else all blocks;
    without those that it shares with its neighbours (``n_shared`` lines of the page; never article
    or main blocks) and those in menus, headers, footers, sidebars, notices, adverts, forms and
    comments (``n_marked`` lines). Scripts, styles and other content that is not text give no lines.

    Null or empty html gives an empty text. A page without a host (null url) has no neighbours.
    Repeated rows stay repeated; null ids are kept. Pages of a host with the same lines throughout
    do not delete each other's lines. A block without text is no block. Unclosed elements end where
    the page or an enclosing element ends. Further columns play no part.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host, path = url_path(F.col("url"))
    signed = cut_lineage(rows.select("url", "html").mapInArrow(_sign, _DDL["_SIGNED"]).select(host.alias("host"), path.alias("path"), "digest", "marks"))
    shared = cut_lineage(shared_lines(signed))
    total = signed.count()
    hot = shared.where(F.col("n") * HOT > total).select("host", "digest", F.col("shared").alias("hot_shared"))
    cold = shared.where(F.col("n") * HOT <= total).select("host", "digest", "shared")
    # pages are read and cut into lines again: what travels is their compressed text, once
    packed = rows.mapInArrow(_pack, _DDL["_PACKED"]).withColumn("host", host).withColumn("row", F.monotonically_increasing_id())
    found = packed.join(F.broadcast(hot), ["host", "digest"], "left")
    # rows that have their answer meet nothing more and are dealt evenly by their own number
    key = F.when(F.col("hot_shared").isNull(), F.col("digest")).otherwise(F.sha1(F.col("row").cast("string").cast("binary")).cast("binary"))
    met = found.withColumn("key", key).join(cold.withColumnRenamed("digest", "key").hint("merge"), ["host", "key"], "left")
    return met.select("page_id", "url", "kinds", "packed", F.coalesce("hot_shared", "shared").alias("shared")).mapInArrow(_unpack, _DDL["_TEXTS"])
