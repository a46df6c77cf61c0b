"""Token ids in binary blocks under a Re-Pair grammar.

Documents are sorted by id into ranges; each task encodes its range and writes blocks of
about ``BLOCK`` ids. In a block, the frequent pairs of neighbouring symbols become
nonterminals, again and again, until little is gained; pairs never cross a document. A
block stores its rules with the length of each expansion, so that one document, or any
slice of it, is decoded without the rest.

A block (little endian)::

    magic "RPB1", width of a symbol (2 or 4), first nonterminal, documents, rules, symbols
    ids of the documents (int64), which of them are null (uint8)
    symbols and token ids of each document (uint64, uint64)
    rules: left, right (width each), expansion length (uint64)
    symbols (width each)

Blocks are rows of a Parquet table in the shared folder: Spark's writer commits them as a
whole or not at all, and a lost task writes its range again.

Defined results: a null text is empty, so its document is the end id alone; null ids come
first; rows with the same id keep the order of their texts; an empty table gives no block.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import in_steps, keep, narrow, shared_path

END_ID = 2
BLOCK = 1 << 19
#: A pair must occur this often for a rule to pay, and a round must save this share to go on.
LEAST_PAIRS, LEAST_GAIN = 12, 0.02
#: Distinct pieces kept in a worker's cache, some 200 bytes each; a full cache is emptied.
CACHED = 800_000

_HEAD = "<4sIQQQQ"


# ---- text to ids ---------------------------------------------------------------------------

class Ids:
    """Id lists one after the other."""

    def __init__(self):
        self.flat, self.start = array("I"), array("q", [0])

    def add(self, ids: list[int]) -> int:
        self.flat.extend(ids)
        self.start.append(len(self.flat))
        return len(self.start) - 2

    def get(self, at: int) -> array:
        return self.flat[self.start[at] : self.start[at + 1]]

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the lists, joined, and the length of each."""
        start = np.frombuffer(self.start, np.int64)
        size = start[which + 1] - start[which]
        to = np.cumsum(size)
        at = np.repeat(start[which] - (to - size), size)
        at += np.arange(int(to[-1]) if len(to) else 0)
        return (np.frombuffer(self.flat, np.uint32)[at] if len(at) else np.zeros(0, np.uint32)), size


class Pieces(dict):
    """Piece of text -> place of its ids; pieces start at a space that follows a non-space.

    The tokenizer never joins characters across such a place, so the ids of a text are the
    ids of its pieces one after the other, and each distinct piece is encoded once.
    """

    def __init__(self, tokenizer, lead: str, store: Ids):
        super().__init__()
        self.tokenizer, self.lead, self.store = tokenizer, lead, store

    def __missing__(self, piece: str) -> int:
        self[piece] = at = self.store.add(self.tokenizer(self.lead, piece, self))
        return at


#: White space before a space: only then do pieces need the slower split.
_RUN, _SPLIT = re.compile(r"\s "), re.compile(r"(?<=\S) ")


# Fixed values of byte-level vocabularies: the pattern of pre-tokens, and the letter that stands for each byte
# (itself where it is printable, else the next free one from 256 on).
_PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}
#: A word and signs behind it, two pre-tokens; and what may be white space or a control string to one library only.
_WORD = re.compile(r"( ?)([^\W\d_]+)([.,;:!?)]*)")
_SPACE, _SIGNS = _BYTES[32], ".,;:!?)"
_RARE = re.compile(r"[\x00-\x08\x0b-\x1f\x7f-\xa0\xad]|<\|")


class Encoder:
    """Texts to ids with a tokenizer file, equal to encoding each whole text without added special tokens.

    Only a byte-level tokenizer is fed by pieces; another kind gets whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        told = json.loads(self.tokenizer.to_str())
        split = told.get("pre_tokenizer") or {}
        self.by_piece = (split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not told.get("normalizer")
                         and all(t["content"].startswith("<|") and " " not in t["content"] for t in told.get("added_tokens", [])))
        self.clear()

    def clear(self) -> None:
        self.ids, self.parts = Ids(), {}
        self.first, self.later = Pieces(self._one, "", self.ids), Pieces(self._one, " ", self.ids)

    def _word(self, letters: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(letters)]

    def _one(self, lead: str, piece: str, pieces: Pieces) -> list[int] | array:
        """Ids of a piece: those of its pre-tokens; a word before signs is a piece of its own. A piece with rare characters is encoded whole."""
        if self.by_piece and piece.isascii():  # the same as below, for most pieces
            if piece.isalpha():
                return self._word(_SPACE + piece if lead else piece)
            word = piece.rstrip(_SIGNS)
            if word.isalpha():
                return self.ids.get(pieces[word]) + self._part(piece[len(word):])
        s = lead + piece
        m = _WORD.fullmatch(s) if self.by_piece else None
        if m is not None and (s.isascii() or m[2].isalpha() and max(s) < "\u0250"):
            pre = (m[1] + m[2], m[3]) if m[3] else (m[1] + m[2],)
        elif not s:
            return array("I")
        elif self.by_piece and max(s) < "\u0250" and not _RARE.search(s):
            pre = _PRE_TOKEN.findall(s)
        else:
            return array("I", self.tokenizer.encode(s, add_special_tokens=False).ids)
        out = array("I")
        for p in pre:
            out += self._part(p)
        return out

    def _part(self, p: str) -> array:
        """Ids of a pre-token, which are kept."""
        ids = self.parts.get(p)
        if ids is None:
            if len(self.parts) >= CACHED // 4:
                self.parts.clear()
            ids = self.parts[p] = array("I", self._word(p.encode().decode("latin-1").translate(_BYTES)))
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, joined, and how many each has."""
        if len(self.ids.start) > CACHED:
            self.clear()
        first, later, which, count = self.first.__getitem__, self.later.__getitem__, array("q"), []
        for t in texts:
            parts = [t] if not self.by_piece else _SPLIT.split(t) if _RUN.search(t) else t.split(" ")
            which.append(first(parts[0]))
            which.extend(map(later, parts[1:]))
            count.append(len(parts))
        ids, size = self.ids.gather(np.frombuffer(which, np.int64))
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(count, dtype=np.int64)] if count else np.zeros(0, np.int64)
        return ids, np.diff(ends, prepend=0)


@lru_cache(2)
def _encoder(path: str) -> Encoder:
    keep(_encoder.cache_clear)  # up to CACHED pieces stay for the next task; tasks of other operators need not hold them
    return Encoder(path)


# ---- the grammar ---------------------------------------------------------------------------

def _slot(pairs: np.ndarray) -> np.ndarray:
    return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)


def compress(ids: np.ndarray, sizes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, symbols of each document, rules as pairs) of documents that lie one after the other."""
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[np.cumsum(sizes)[sizes > 0] - 1] = True
    rules: list[np.ndarray] = []
    made, room = 0, (1 << 16) - base if base < 1 << 16 else (1 << 31) - base
    while len(seq) > 1 and made < room:
        key = seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:]
        inner = ~last[:-1]
        # a pair is never more often than its slot, so only pairs in full slots are sorted and counted
        spread = _slot(key)
        full = np.bincount(spread[inner], minlength=1 << 18) >= LEAST_PAIRS
        keys, n = np.unique(key[inner & full[spread]], return_counts=True)
        often = np.flatnonzero(n >= LEAST_PAIRS)
        often = np.sort(often[np.argsort(-n[often], kind="stable")[: room - made]])
        if not len(often):
            break
        pairs = keys[often]
        # looked up by a hash; of pairs that fall in one slot the last is taken, the others wait for a later round
        slot = np.zeros(1 << 18, np.int32)
        slot[_slot(pairs)] = np.arange(len(pairs))
        at = slot[spread]
        p = np.flatnonzero((pairs[at] == key) & inner)
        # of neighbouring pairs that share a symbol, every other one is replaced
        new_run = np.diff(p, prepend=-2) > 1
        p = p[(p - p[np.maximum.accumulate(np.where(new_run, np.arange(len(p)), 0))]) % 2 == 0]
        used = np.bincount(at[p], minlength=len(pairs))
        paid = used >= LEAST_PAIRS
        p = p[paid[at[p]]]
        if not len(p):
            break
        name = np.cumsum(paid) - 1 + base + made
        seq[p] = name[at[p]]
        last[p] = last[p + 1]
        keep = np.ones(len(seq), bool)
        keep[p + 1] = False
        rules.append(pairs[paid])
        made += int(paid.sum())
        saved = len(p) / len(seq)
        seq, last = seq[keep], last[keep]
        if saved < LEAST_GAIN:
            break
    ends = np.flatnonzero(last) + 1
    symbols = np.zeros(len(sizes), np.int64)
    symbols[sizes > 0] = np.diff(ends, prepend=0)
    flat = np.concatenate(rules) if rules else np.zeros(0, np.uint64)
    return seq, symbols, np.stack([flat >> np.uint64(32), flat & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)


def expand(seq: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """Symbols back to ids."""
    seq = seq.astype(np.uint32)
    while len(rules) and (big := seq >= base).any():
        to = np.cumsum(big + 1) - (big + 1)
        out = np.repeat(seq, big + 1)
        rule = rules[seq[big] - base]
        out[to[big]], out[to[big] + 1] = rule[:, 0], rule[:, 1]
        seq = out
    return seq


def lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Expansion length of every rule; a rule only uses earlier ones."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1))
    return np.array(out, np.uint64)


def pack(doc_ids: list[int | None], ids: np.ndarray, sizes: np.ndarray, base: int) -> bytes:
    seq, symbols, rules = compress(ids, sizes, base)
    width = 2 if base + len(rules) <= 1 << 16 and (not len(seq) or int(seq.max()) < 1 << 16) else 4
    kind = f"<u{width}"
    return b"".join([
        struct.pack(_HEAD, b"RPB1", width, base, len(doc_ids), len(rules), len(seq)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        symbols.astype("<u8").tobytes(), sizes.astype("<u8").tobytes(),
        rules.astype(kind).tobytes(), lengths(rules, base).astype("<u8").tobytes(), seq.astype(kind).tobytes()])


class Block:
    """A stored block; decodes all of it, one document or a slice of one."""

    def __init__(self, payload: bytes):
        magic, width, self.base, docs, rules, symbols = struct.unpack_from(_HEAD, payload)
        if magic != b"RPB1":
            raise ValueError("not a token block")
        at = struct.calcsize(_HEAD)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        ids, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if x else d for d, x in zip(ids.tolist(), null.tolist())]
        self.symbols, self.sizes = take("<u8", docs).astype(np.int64), take("<u8", docs).astype(np.int64)
        self.rules, self.spans = take(f"<u{width}", 2 * rules).reshape(-1, 2).astype(np.uint32), take("<u8", rules).astype(np.int64)
        self.seq = take(f"<u{width}", symbols)

    def all(self) -> np.ndarray:
        return expand(self.seq, self.rules, self.base)

    def document(self, k: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of document ``k``; only the symbols that cover them are expanded."""
        lo = int(self.symbols[:k].sum())
        seq = self.seq[lo : lo + int(self.symbols[k])].astype(np.int64)
        stop = int(self.sizes[k]) if stop is None else min(stop, int(self.sizes[k]))
        if start >= stop:
            return np.zeros(0, np.uint32)
        size = np.ones(len(seq), np.int64)
        size[seq >= self.base] = self.spans[seq[seq >= self.base] - self.base]
        ends = np.cumsum(size)
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left"))
        skip = start - int(ends[a] - size[a])
        return expand(seq[a : b + 1], self.rules, self.base)[skip : skip + stop - start]


# ---- Spark ---------------------------------------------------------------------------------

def write_tokens(docs: DataFrame, path: str, tokenizer: str, base: int, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """Encode, sort by id, write blocks to ``path`` and return them as read back.

    ``base`` is the first number that is no token id. ``tokenizer`` must be readable on every executor.
    """

    def run(batches):
        part, encoder, number = TaskContext.get().partitionId(), _encoder(tokenizer), 0
        names: list[int | None] = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal names, parts, sizes, held, number
            n = np.concatenate(sizes)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([len(names)], pa.int64()), pa.array([int(n.sum())], pa.int64()),
                 pa.array([pack(names, np.concatenate(parts), n, base)], pa.binary())], ["part", "block", "docs", "tokens", "payload"])
            names, parts, sizes, held, number = [], [], [], 0, number + 1
            return row

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in in_steps(np.array([len(t) + 1 for t in texts], np.int64), 2 * block):
                flat, size = encoder.encode(texts[lo:hi])
                ends = np.cumsum(size)
                names += ids[lo:hi]
                parts.append(np.insert(flat, ends, end_id).astype(np.uint32))
                sizes.append(size + 1)
                held += len(flat) + hi - lo
                if held >= block:
                    yield flush()
        if names:
            yield flush()

    rows = narrow(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(run, "part int, block long, docs long, tokens long, payload binary").write.parquet(path)
    return docs.sparkSession.read.schema("part int, block long, docs long, tokens long, payload binary").parquet(path)


def read_documents(blocks: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 and place (part, block, offset) of every stored document, decoded from the blocks."""

    def run(batches):
        for batch in batches:
            for part, number, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                b = Block(payload)
                ids = b.all().astype("<u4")
                ends = np.cumsum(b.sizes)
                crc = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), b.sizes.tolist())]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, number, np.int64)), pa.array(ends - b.sizes),
                     pa.array(b.doc_ids, pa.int64()), pa.array(b.sizes), pa.array(crc, pa.int64())],
                    ["part", "block", "offset", "doc_id", "n_tokens", "ids_crc32"])

    return blocks.select("part", "block", "payload").mapInArrow(run, "part int, block long, offset long, doc_id long, n_tokens long, ids_crc32 long")


def block_starts(blocks: DataFrame) -> DataFrame:
    """Ids before each block: a sum over the parts (one row a task of the writer), then one inside each part."""
    rows = blocks.select("part", "block", "tokens")
    parts = rows.groupBy("part").agg(F.sum("tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    inner = F.sum("tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("tokens")
    return rows.join(parts.select("part", before.alias("before")), "part").select("part", "block", (F.col("before") + inner).alias("base"))


def token_report(docs: DataFrame, tokenizer: str, base: int, path: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the written files."""
    blocks = write_tokens(docs, path or shared_path(docs.sparkSession, "tokens"), tokenizer, base)
    return (read_documents(blocks).join(block_starts(blocks), ["part", "block"])
            .select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))
