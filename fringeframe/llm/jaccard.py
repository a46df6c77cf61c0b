"""Exact n-gram Jaccard join by grouped prefixes.

A document's set is its distinct word shingles, as 64-bit hashes. Equal sets are folded
first. Two sets with a similarity of at least t share a token among the first
n - ceil(t n) + 1 of each in any common order, so only these prefixes are exchanged. Sets
with the same prefix and size form one group that sends its prefix once; groups that meet in
a token, and whose sizes and places allow the overlap, are candidates; their members are
then expanded and compared on the whole sets.

The order is by hash, with tokens that many documents have put last. It is free to choose:
a token that is missed in that list costs time, never a link.

Where a token's list is long, its members are first compared with their neighbours by size and
with the list's hub, the member that is in the most long lists, as an original among its
copies is. These links are contracted to components; only pairs of different components whose
prefixes leave room for the overlap are left to compare. Links inside a component change nothing
in the result, so a large group of near copies costs about its size, not its square.

Defined results: a document without words (null, empty, blank) has an empty set, no links and
itself as component. Component ids are the least document id of the linked sets; rows with the
same id or text are folded by their set; a null id takes its component's least id, null if
there is none. An empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, drop_table, free_kept, fresh, in_steps, mix64, narrow, raw_texts
from .components import components
from .wordhash import hash_words

SHINGLE, PERCENT = 4, 85
#: Order only: a token this often in one task is reported; the most frequent LISTED ones go last.
LOCAL, FREQUENT, LISTED = 4, 64, 100_000
#: Tokens that a task counts at once.
COUNTED = 1 << 22
#: In lists up to SHORT, all pairs are candidates at once; in lists up to LIST, those of different components later.
SHORT, LIST = 8, 64
#: Bytes of text that a task hashes at once: its arrays of 8 bytes a byte stay small.
HASHED = 1 << 18


def shingle_sets(body: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, first = hash_words(body, offsets, lower=True)
    n = len(words)
    gram = np.zeros(n, np.uint64)
    for j in range(k):  # the grams that start at each word, whether or not they fit
        gram[: max(0, n - j)] = mix64(gram[: max(0, n - j)] + words[j:] + np.uint64(j + 1))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(gram[a : b - k + 1]))
        elif b > a:
            whole = hashlib.blake2b(words[a:b].tobytes(), digest_size=8, person=b"short").digest()
            out.append(np.frombuffer(whole, np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sets(batches, column: int, k: int = SHINGLE) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    free_kept()
    for batch in batches:
        body, offsets = raw_texts(batch.column(column))
        for lo, hi in in_steps(np.diff(offsets) + 1, HASHED):
            yield batch.slice(lo, hi - lo), shingle_sets(body[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], k)


def _set_id(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _contains(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of x are among the values."""
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.searchsorted(sorted_values, x)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == x


def _prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def frequent_tokens(rows: DataFrame, k: int = SHINGLE) -> np.ndarray:
    """Tokens to put last, at most LISTED; only the order of tokens depends on them."""

    def count(batches):
        held, n = np.empty(COUNTED, np.uint64), 0

        def told(some):
            # sorted in place: runs of LOCAL equal tokens are seen without a copy of all
            some.sort()
            same = some[LOCAL - 1 :] == some[: len(some) - LOCAL + 1]
            tokens = np.unique(some[: len(same)][same])
            n = np.searchsorted(some, tokens, "right") - np.searchsorted(some, tokens, "left")
            return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], ["token", "n"])

        for _, sets in _sets(batches, 1, k):
            for s in sets:
                while len(s):
                    part, s = s[: COUNTED - n], s[COUNTED - n :]
                    held[n : n + len(part)] = part
                    n += len(part)
                    if n == COUNTED:
                        yield told(held)
                        n = 0
        if n:
            yield told(held[:n])

    found = (rows.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
             .orderBy(F.desc("n"), "token").limit(LISTED).select("token").collect())
    return np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))


def signatures(rows: DataFrame, last, percent: int = PERCENT, k: int = SHINGLE) -> DataFrame:
    """Of every row: doc_id, th (hash of the text), n, sid (its set) and, for sets that can have links, gid and prefix.

    ``plain`` counts the prefix's tokens that are not put last. ``last`` is the broadcast list of tokens that come last in the order.
    """

    def sign(batches):
        for batch, sets in _sets(batches, 1, k):
            sid, gid, prefix, plain, often = [], [], [], [], last.value
            for s in sets:
                n = len(s)
                sid.append(_set_id(s) if n else None)
                # a set of up to 5 has only equal partners
                if n * 100 >= percent * (n + 1) or n >= 13:
                    put_last = _contains(often, s)
                    s = np.concatenate([s[~put_last], s[put_last]])
                    p = s[: _prefix_size(n, percent)]
                    prefix.append(p.view(np.int64))
                    plain.append(min(len(p), int((~put_last).sum())))
                    gid.append(int.from_bytes(hashlib.blake2b(p.tobytes() + n.to_bytes(8, "little"), digest_size=8).digest(), "little", signed=True))
                else:
                    prefix.append(None)
                    plain.append(None)
                    gid.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(sid, pa.binary()), pa.array(gid, pa.int64()),
                 pa.array(prefix, pa.list_(pa.int64())), pa.array(plain, pa.int32())], ["doc_id", "th", "n", "sid", "gid", "prefix", "plain"])

    keyed = rows.select("doc_id", "text", F.xxhash64("text").alias("th"))
    return cut_lineage(keyed.mapInArrow(sign, "doc_id long, th long, n long, sid binary, gid long, prefix array<long>, plain int"))


def _runs(batches, keys: int = 1) -> Iterator[list[np.ndarray]]:
    """Column arrays of each complete run of equal values of the first ``keys`` columns, from a sorted stream."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not batch.num_rows:
            continue
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:keys]], axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            part = [c[a:b] for c in cols]
            if held and any(h[0] != c[0] for h, c in zip(held[0][:keys], part)):
                yield [np.concatenate(x) for x in zip(*held)]
                held = []
            held.append(part)
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _may(n1, n2, i, j, percent):
    """Sizes n1 <= n2 and the places of a shared token allow the overlap, if it is the first one shared."""
    need = (percent * (n1 + n2) + 99 + percent) // (100 + percent)
    return (100 * n1 >= percent * n2) & (1 + np.minimum(n1 - i, n2 - j) - 1 >= need)


def _least_need(least, n, percent):
    """The least overlap that a set of size n needs with any not larger one, of size ``least`` or more."""
    least = np.maximum(least, (percent * n + 99) // 100)
    return (percent * (least + n) + 99 + percent) // (100 + percent)


def _meetable(run, n, pos, percent):
    """Which rows of lists, in order of size, can be in a pair whose first shared token is the list's.

    The smaller set of such a pair has the token so early that it could have one of its own size as
    a partner; the larger one, if not as early, has the least of those to pair with.
    """
    early = n - pos >= _least_need(n, n, percent)
    least = np.full(int(run[-1]) + 1 if len(run) else 0, np.iinfo(np.int64).max)
    at = np.flatnonzero(early)[::-1]
    least[run[at]] = n[at]  # the last one written is the first of its list
    least = least[run]
    late = np.flatnonzero(~early & (least <= n))
    early[late] = n[late] - pos[late] >= _least_need(least[late], n[late], percent)
    return early


def group_pairs(groups: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b) of groups, and the members (token, gid, n, pos) of long lists.

    Members of a list that no pair with the token as its first shared one can have are left out before.
    """
    tokens = groups.select(F.posexplode("prefix").alias("pos", "token"), "gid", "n")
    tokens = tokens.select("token", "gid", (F.shiftleft("n", 32) + F.col("pos")).alias("n_pos"))  # two small numbers in one
    listed = tokens.repartition("token").sortWithinPartitions("token", "n_pos", "gid")

    def meet(batches):
        names = ["long_list", "a", "b", "gid", "n", "pos"]
        held: list[pa.RecordBatch] = []

        def rows(long_list, *cols):
            cols = [np.full(len(cols[2]), c, np.int64) if np.isscalar(c) else c for c in cols]
            held.append(pa.RecordBatch.from_arrays([pa.array(np.full(len(cols[0]), long_list)), *map(pa.array, cols)], names))

        for token, gid, n, pos, run, length in _sorted_lists(batches, percent):
            for step in range(1, SHORT):  # neighbours at every distance in short lists, the nearest in long ones
                if len(token) <= step:
                    break
                short = length[step:] <= SHORT
                ok = (run[step:] == run[:-step]) & (short | (step == 1)) & (gid[step:] != gid[:-step])
                ok &= _may(n[:-step], n[step:], pos[:-step], pos[step:], percent)
                at = np.flatnonzero(ok)
                a, b = gid[at], gid[at + step]
                rows(False, np.minimum(a, b), np.maximum(a, b), np.zeros(len(at), np.int64), 0, 0)
            big = np.flatnonzero(length > SHORT)
            rows(True, token[big], 0, gid[big], n[big], pos[big])
            yield from held
            held.clear()

    found = cut_lineage(listed.mapInArrow(meet, "long_list boolean, a long, b long, gid long, n long, pos long"))
    return (found.where("NOT long_list").select("a", "b").distinct(),
            found.where("long_list").select(F.col("a").alias("token"), "gid", "n", "pos"))


def _sorted_lists(batches, percent):
    """(token, gid, n, pos, run number, run length) of lists of two or more that can meet, from a stream sorted by token and size."""
    rest: list[np.ndarray] = []

    def lists(cols):
        cols = [cols[0], cols[1], cols[2] >> 32, cols[2] & 0xFFFFFFFF]
        new = np.concatenate([[True], cols[0][1:] != cols[0][:-1]])
        run = np.cumsum(new) - 1
        keep = np.bincount(run)[run] > 1
        cols, run = [c[keep] for c in cols], run[keep]
        keep = _meetable(run, cols[2], cols[3], percent)
        cols, run = [c[keep] for c in cols], run[keep]
        length = np.bincount(run)[run]
        keep = length > 1
        return [*(c[keep] for c in cols), run[keep], length[keep]]

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        cols = [np.concatenate(x) for x in zip(rest, cols)] if rest else cols
        cut = int(np.searchsorted(cols[0], cols[0][-1], "left"))  # the last list may go on
        rest = [c[cut:] for c in cols]
        if cut:
            yield lists([c[:cut] for c in cols])
    if rest:
        yield lists(rest)


def sketch(kind: str) -> Column:
    """15 bits (smallint) or 31 bits (int) of each token of a prefix.

    Different tokens can share a number, so counts of common ones are never too small.
    """
    bits = {"smallint": 0x7FFF, "int": 0x7FFFFFFF}[kind]
    return F.transform("prefix", lambda x: x.bitwiseAND(F.lit(bits)).cast(kind))


def reach() -> Column:
    """Where a prefix ends in the order, as one number: a bit for tokens that come last, then the top of the hash."""
    last_one = F.when(F.size("prefix") > F.col("plain"), F.lit(1 << 62)).otherwise(F.lit(0).cast("long"))
    return F.shiftrightunsigned(F.element_at("prefix", -1), 2) + last_one


def _short_side(n1, n2, size1, size2, reach1, reach2, common, percent):
    """Whether two sets with so many common tokens in their prefixes can overlap enough.

    Where the prefix that ends first ends, its tokens that are not common are missing in the other set.
    """
    need = (percent * (n1 + n2) + 99 + percent) // (100 + percent)
    first = reach1 <= reach2
    return np.where(first, n1, n2) - (np.where(first, size1, size2) - 1 - common) >= need


#: Rows whose values are marked in one table at once.
MARKED = 64


def _in_both(x, nx, y, ny) -> np.ndarray:
    """For each row, how many of its values of x (nx of the 15-bit numbers) are among those of y, or the other way if that is more."""
    out, ends_x, ends_y = np.zeros(len(nx), np.int64), np.cumsum(nx), np.cumsum(ny)
    seen = np.zeros(MARKED << 15, bool)
    for lo in range(0, len(nx), MARKED):
        hi = min(lo + MARKED, len(nx))
        at = [np.repeat(np.arange(hi - lo), n[lo:hi]) for n in (nx, ny)]
        flat = [(row << 15) + v[ends[lo] - n[lo] : ends[hi - 1]] for row, v, n, ends in zip(at, (x, y), (nx, ny), (ends_x, ends_y))]
        for (row, own), other in zip(zip(at, flat), flat[::-1]):
            seen[other] = True
            out[lo:hi] = np.maximum(out[lo:hi], np.bincount(row[seen[own]], minlength=hi - lo))
            seen[other] = False
    return out


def close_pairs(pairs: DataFrame, groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Group pairs (a, b) whose prefixes leave room for the overlap."""

    def judge(batches):
        for batch in batches:
            n1, n2, reach1, reach2 = (batch.column(i).to_numpy() for i in (2, 5, 4, 7))
            x, y = batch.column(3), batch.column(6)
            nx, ny = (c.value_lengths().to_numpy().astype(np.int64) for c in (x, y))
            common = _in_both(x.flatten().to_numpy(), nx, y.flatten().to_numpy(), ny)
            keep = _short_side(n1, n2, nx, ny, reach1, reach2, common, percent)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep))

    side = groups.select("gid", "n", sketch("smallint").alias("s"), reach().alias("r"))
    wide = (pairs.join(side.select(F.col("gid").alias("a"), F.col("n").alias("na"), F.col("s").alias("pa"), F.col("r").alias("ra")), "a")
            .join(side.select(F.col("gid").alias("b"), F.col("n").alias("nb"), F.col("s").alias("pb"), F.col("r").alias("rb")), "b"))
    return wide.select("a", "b", "na", "pa", "ra", "nb", "pb", "rb").mapInArrow(judge, "a long, b long")


#: Sets that are fetched by a broadcast list of texts, and buckets named in it; more are fetched by a shuffle.
FETCHED, NAMED = 500_000, 4_000_000
#: Bytes of sets that meet in one bucket, about.
BUCKET = 1 << 22
#: Pairs of one set from which on its ends are looked up by broadcast; of P pairs there are at most 2 P / HEAVY such sets.
HEAVY = 100_000


def _towards_hubs(pairs: DataFrame, degree: DataFrame, most: int) -> DataFrame:
    """Pairs (hub, leaf), the end that is in more pairs first, with the hub's ``place``; no set is in more than ``most`` pairs."""
    ends = [degree.select(F.col("sid").alias(c), F.col("d").alias(f"d{c}"), F.col("place").alias(f"at{c}")) for c in "xy"]
    bound, free = None, pairs
    if most > HEAVY:
        for c, end in zip("xy", ends):
            free = free.join(F.broadcast(end.where(F.col(f"d{c}") > HEAVY)), c, "left")
        bound, free = free.where("dx IS NOT NULL OR dy IS NOT NULL"), free.where("dx IS NULL AND dy IS NULL").select("x", "y")
    for c, end in zip("xy", ends):
        free = free.join(end, c)
    first = F.coalesce("dx", F.lit(0)) >= F.coalesce("dy", F.lit(0))
    both = free if bound is None else bound.unionByName(free)
    return both.select(*[F.when(first, F.col(u)).otherwise(F.col(v)).alias(w) for u, v, w in (("x", "y", "hub"), ("y", "x", "leaf"), ("atx", "aty", "place"))])


def _bits(n: int) -> int:
    """Bits of each hash that a first comparison of a set of n takes: chance matches are one in 32 to 64 values."""
    return min(64, n.bit_length() + 5)


def _packed(s: np.ndarray) -> bytes:
    """The first bits of a set's sorted hashes as gaps, most of them in one byte; 255 goes on in the next."""
    gap = np.diff(s >> np.uint64(64 - _bits(len(s))), prepend=np.uint64(0)).astype(np.int64)
    out = np.full(len(s) + int((gap // 255).sum()), 255, np.uint8)
    out[np.cumsum(gap // 255 + 1) - 1] = gap % 255
    return out.tobytes()


def _unpacked(packed: bytes) -> tuple[np.ndarray, int]:
    """Sorted values and their bits."""
    gap = np.frombuffer(packed, np.uint8)
    values = np.cumsum(gap, dtype=np.uint64)[gap != 255]
    bits = _bits(len(values))
    return values.astype("<u2" if bits <= 16 else "<u4" if bits <= 32 else "<u8"), bits


def _compare(pairs: DataFrame, sets: DataFrame, rows: DataFrame, percent: int, whole: bool, k: int) -> DataFrame:
    """Of pairs (x, y) of sids, those whose sets are similar enough, by whole hashes or by the first bits of each.

    Pairs are judged in buckets. A pair goes where the end that is in more pairs, the hub, has its place: the
    least hash of itself and its partners, the same for most of a cluster; where such a place has too many pairs,
    its leaves are dealt out. A set travels once to each bucket that holds a pair of it, however many they are.
    """
    width = 8 if whole else 2
    size = F.col("n") * width + 64
    ends = [pairs.select(F.col(u).alias("sid"), F.xxhash64(v).alias("other")) for u, v in ("xy", "yx")]
    degree = ends[0].unionByName(ends[1]).groupBy("sid").agg(F.count(F.lit(1)).alias("d"), F.min("other").alias("other"))
    degree = cut_lineage(degree.join(sets.select("sid", "n", "rep", "th"), "sid").withColumn("place", F.least("other", F.xxhash64("sid"))).drop("other"))
    total, most = degree.agg(F.sum(size), F.max("d")).first()
    buckets = -(-(total or 1) // BUCKET)
    towards = _towards_hubs(pairs, degree, most or 0)
    if buckets > 1:
        # of S bytes in pairs, there are at most S / BUCKET such places
        full = degree.groupBy("place").agg(F.ceil(F.sum(F.col("d") * size) / BUCKET).cast("long").alias("salts")).where("salts > 1")
        towards = towards.join(F.broadcast(full), "place", "left")
        dealt = F.pmod(F.xxhash64("leaf"), F.coalesce("salts", F.lit(1)))
        met = towards.select("hub", "leaf", F.pmod(F.xxhash64("place", dealt), F.lit(buckets)).alias("bucket"))
    else:
        met = towards.select("hub", "leaf", F.lit(0).cast("long").alias("bucket"))
    met = cut_lineage(met)
    ends = met.select("bucket", F.explode(F.array("hub", "leaf")).alias("sid")).distinct().groupBy("sid").agg(F.collect_list("bucket").alias("buckets"))
    which = named_in = cut_lineage(degree.join(ends, "sid").select(F.col("rep").alias("r"), F.col("th").alias("t"), "buckets"))
    n, named = which.agg(F.count(F.lit(1)), F.sum(F.size("buckets"))).first()
    which = F.broadcast(which) if n <= FETCHED and (named or 0) <= NAMED else which
    texts = rows.withColumn("th", F.xxhash64("text"))
    texts = texts.join(which, F.col("doc_id").eqNullSafe(F.col("r")) & (F.col("th") == F.col("t"))).select("text", "buckets")
    names = ["bucket", "pair", "a", "b", "tokens"]

    def fetch(batches):
        for batch, found in _sets(batches, 0, k):
            to = batch.column(1).to_pylist()
            each, bucket = np.repeat(np.arange(len(found)), [len(b) for b in to]), np.array([b for bs in to for b in bs], np.int64)
            sid, sent = [_set_id(s) for s in found], [s.tobytes() if whole else _packed(s) for s in found]
            for lo in range(0, len(each), 1024):
                some = each[lo : lo + 1024]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[lo : lo + 1024]), pa.array(np.zeros(len(some), bool)), pa.array([sid[i] for i in some], pa.binary()),
                     pa.nulls(len(some), pa.binary()), pa.array([sent[i] for i in some], pa.binary())], names)

    schema = "bucket long, pair boolean, a binary, b binary, tokens binary"
    tokens = texts.mapInArrow(fetch, schema)
    wide = tokens.unionByName(met.select("bucket", F.lit(True).alias("pair"), F.col("hub").alias("a"), F.col("leaf").alias("b"), F.lit(None).cast("binary").alias("tokens")))

    def compare(batches):
        now, held = None, {}
        for batch in batches:
            bucket, pair = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            a, b = batch.column(2), batch.column(3)
            edges = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1]), [True]))) if len(bucket) else []
            for lo, hi in zip(edges[:-1], edges[1:]):
                if bucket[lo] != now:
                    now, held = bucket[lo], {}
                if not pair[lo]:
                    for i in range(lo, hi):
                        sent = batch.column(4)[i].as_py()
                        held[a[i].as_py()] = (np.frombuffer(sent, "<u8"), 64) if whole else _unpacked(sent)
                    continue
                x, y = a.slice(lo, hi - lo).to_pylist(), b.slice(lo, hi - lo).to_pylist()
                keep = _similar(x, y, held, percent)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for i in keep], pa.binary()), pa.array([y[i] for i in keep], pa.binary())], ["x", "y"])

    judged = wide.repartition("bucket").sortWithinPartitions("bucket", "pair", "a").mapInArrow(compare, "x binary, y binary")
    kept = cut_lineage(judged.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    for table in (degree, met, named_in):
        drop_table(table)
    return kept


def _similar(hubs: list[bytes], leaves: list[bytes], sets: dict[bytes, tuple[np.ndarray, int]], percent: int) -> list[int]:
    """Places of the pairs that are similar enough; pairs of one hub follow each other and are counted together, by the bits that both sides have."""
    keep, at = [], 0
    while at < len(hubs):
        end, (hub, hub_bits), size = at, sets[hubs[at]], 0
        while end < len(hubs) and hubs[end] == hubs[at] and size < 1 << 20:
            size += len(sets[leaves[end]][0])
            end += 1
        some = [sets[y] for y in leaves[at:end]]
        n, bits = np.array([len(t) for t, _ in some]), np.array([b for _, b in some])
        both = np.zeros(len(some), np.int64)
        for b in set(bits.tolist()):
            of = np.flatnonzero(bits == b)
            flat, least = np.concatenate([some[i][0] for i in of]), min(b, hub_bits)
            found = _contains(hub >> (hub_bits - least), flat >> (b - least))
            both[of] = np.add.reduceat(found.astype(np.int64), np.cumsum(n[of]) - n[of])
        keep += (at + np.flatnonzero(100 * both >= percent * (len(hub) + n - both))).tolist()
        at = end
    return keep


#: So few pairs are compared by whole hashes at once.
FEW = 4096


def verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame, percent: int = PERCENT, k: int = SHINGLE) -> DataFrame:
    """Of candidate pairs (x, y) of sids, those that are similar enough, judged on whole sets.

    First with a few bits of each hash, which finds no fewer tokens in common, then with the whole hashes.
    """
    if pairs.count() <= FEW:
        return _compare(pairs, sets, rows, percent, True, k)
    likely = _compare(pairs, sets, rows, percent, False, k)
    similar = _compare(likely, sets, rows, percent, True, k)
    drop_table(likely)
    return similar


#: Members of a group that one task chains, and that a pair of groups is expanded to at once.
PART = 4096


def _in_parts(members: DataFrame, *keys: str) -> DataFrame:
    """``members`` with ``part`` and ``parts``: those of equal ``keys`` dealt by their set into parts of about PART."""
    size = members.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / PART).cast("long").alias("parts"))
    return members.join(size, list(keys)).withColumn("part", F.pmod(F.xxhash64("sid"), "parts"))


def chains(members: DataFrame) -> DataFrame:
    """Pairs (x, y) of neighbours by sid inside each part of a group, and of neighbours among the parts' least sids."""
    inside = cut_lineage(_in_parts(members.select("gid", "sid"), "gid").select("gid", "part", "parts", "sid"))

    def neighbours(batches):
        for *_, sid in _runs(batches, 2):
            if len(sid) > 1:
                yield pa.RecordBatch.from_arrays([pa.array(sid[:-1].tolist(), pa.binary()), pa.array(sid[1:].tolist(), pa.binary())], ["x", "y"])

    heads = inside.where("parts > 1").groupBy("gid", "part").agg(F.min("sid").alias("sid")).withColumn("part", F.lit(-1).cast("long"))
    rows = inside.select("gid", "part", "sid").unionByName(heads)
    return rows.repartition("gid", "part").sortWithinPartitions("gid", "part", "sid").mapInArrow(neighbours, "x binary, y binary")


def _rooted(members: DataFrame, tied: DataFrame) -> DataFrame:
    return members.join(tied.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))


def _units(rooted: DataFrame) -> DataFrame:
    """(gid, root, n, one, m): the members of a group in one component, their least sid and their number."""
    return cut_lineage(rooted.groupBy("gid", "root").agg(F.min("n").alias("n"), F.min("sid").alias("one"), F.count(F.lit(1)).alias("m")))


def _pivots(units: DataFrame) -> DataFrame:
    """Pairs (x, y) of the representatives of each group's units with that of its largest unit."""
    most = units.groupBy("gid").agg(F.max(F.struct("m", "root", "one")).alias("most"), F.count(F.lit(1)).alias("c")).where("c > 1")
    return units.join(most, "gid").where("root != most.root").select(F.col("one").alias("x"), F.col("most.one").alias("y"))


#: Rows of one key from which on a join deals them into SALTS tasks; of P rows there are at most P / CROWD such keys.
CROWD, SALTS = 16_384, 64


def _spread_join(rows: DataFrame, *sides: tuple[DataFrame, list[str]]) -> DataFrame:
    """``rows``, a written table, joined with each (side, keys); rows of a frequent key are dealt into SALTS tasks, its side's rows sent to each."""
    hot = {}
    for i, (_, keys) in enumerate(sides):
        often = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > CROWD).select(*keys, F.lit(SALTS).alias(f"salts_{i}")))
        if not often.isEmpty():
            hot[i] = F.broadcast(often)
    deal = F.xxhash64(*rows.columns)
    for i in hot:
        rows = rows.join(hot[i], sides[i][1], "left").withColumn(f"salt_{i}", F.pmod(deal, F.coalesce(f"salts_{i}", F.lit(1)))).drop(f"salts_{i}")
    for i, (side, keys) in enumerate(sides):
        if i not in hot:
            rows = rows.join(side, keys)
            continue
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(f"salts_{i}", F.lit(1)).cast("long") - 1))
        rows = rows.join(side.join(hot[i], keys, "left").withColumn(f"salt_{i}", copies).drop(f"salts_{i}"), [*keys, f"salt_{i}"]).drop(f"salt_{i}")
    return rows


def _between(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """Group pairs (a, b) as pairs (a, ra, b, rb) of their units in different components."""
    left = units.select(F.col("gid").alias("a"), F.col("root").alias("ra"))
    right = units.select(F.col("gid").alias("b"), F.col("root").alias("rb"))
    return _spread_join(pairs, (left, ["a"]), (right, ["b"])).where("ra != rb").select("a", "ra", "b", "rb")


def _ends(found: DataFrame, side: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs (a, ra, b, rb) joined with ``side`` (gid, root, ...), whose other columns get the names' endings ``left`` and ``right``."""
    more = [c for c in side.columns if c not in ("gid", "root")]
    named = [(side.select(F.col("gid").alias(gid), F.col("root").alias(root), *[F.col(c).alias(f"{c}{end}") for c in more]), [gid, root])
             for gid, root, end in (("a", "ra", left), ("b", "rb", right))]
    return _spread_join(found, *named)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x < y").distinct()


def _representatives(found: DataFrame, units: DataFrame) -> DataFrame:
    """Pairs (x, y) of the sids that stand for the units of (a, ra, b, rb)."""
    return _ordered(_ends(found, units.select("gid", "root", "one"), "_x", "_y").select(F.col("one_x").alias("x"), F.col("one_y").alias("y")))


def _members(found: DataFrame, units: DataFrame, rooted: DataFrame, tied: DataFrame) -> DataFrame:
    """Pairs (x, y) of all members of the units (a, ra, b, rb) that are still in different components of ``tied``, part by part."""
    # a unit's component now is that of its representative, a key of its own
    now = units.select("gid", "root", "m", F.col("one").alias("node")).join(tied.select("node", F.col("root").alias("now")), "node", "left")
    now = cut_lineage(now.select("gid", "root", "m", F.coalesce("now", "node").alias("now")))
    some = _ends(found, now, "_x", "_y").where("now_x != now_y AND (m_x > 1 OR m_y > 1)")  # others are their representatives
    for end in "xy":
        some = some.withColumn(f"part_{end}", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(f"m_{end}") / PART).cast("long") - 1)))
    some = cut_lineage(some.select("a", "ra", "part_x", "b", "rb", "part_y"))
    held = _in_parts(rooted.select("gid", "root", "sid"), "gid", "root").select("gid", "root", "part", "sid")
    for gid, root, end in (("a", "ra", "x"), ("b", "rb", "y")):
        some = some.join(held.select(F.col("gid").alias(gid), F.col("root").alias(root), F.col("part").alias(f"part_{end}"), F.col("sid").alias(end)), [gid, root, f"part_{end}"])
    return _ordered(some)


def _tie(tied: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) of those found before and of further links (x, y)."""
    return components(tied.select(F.col("node").alias("x"), F.col("root").alias("y")).unionByName(links), "x", "y")


def hub_pairs(long_lists: DataFrame) -> DataFrame:
    """Pairs (a, b) of each member of a long list with the member that is in the most, longest lists: an original, where the others are its copies."""
    size = long_lists.groupBy("token").agg(F.count(F.lit(1)).alias("m"))
    rows = long_lists.join(size, "token")
    score = rows.groupBy("gid").agg(F.sum(F.log2("m")).alias("score"))
    rows = cut_lineage(rows.select("token", "gid").join(score, "gid"))
    hub = rows.groupBy("token").agg(F.max(F.struct("score", "gid"))["gid"].alias("hub"))
    return rows.join(hub, "token").where("gid != hub").select(F.least("gid", "hub").alias("a"), F.greatest("gid", "hub").alias("b")).distinct()


#: Values whose counts are held as a table at once.
WIDTH = 4096


def _common(lists: list[np.ndarray], left: int, right: int) -> np.ndarray:
    """For each of the first ``left`` lists and each list from ``right`` on, a count that is never below that of their common values.

    Counts are products of tables of WIDTH values at a time, so long lists take no more memory than
    short ones.
    """
    flat = np.concatenate(lists)
    row = np.repeat(np.arange(len(lists)), [len(p) for p in lists])
    _, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    some = n[at] > 1  # a value that comes once is common to none
    column, row = (np.cumsum(n > 1) - 1)[at[some]], row[some]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    total = np.zeros((left, len(lists) - right), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, WIDTH):
        lo, hi = np.searchsorted(column, [first, first + WIDTH])
        table = np.zeros((len(lists), WIDTH), np.float32)
        np.add.at(table, (row[lo:hi], column[lo:hi] - first), 1)
        total += table[:left] @ table[right:].T
    return total


#: Members of a list that are compared at once.
BLOCK = 512


def _close_in_blocks(side, n, sketches, reach, tokens, root, percent) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two blocks of a list (or inside one, if ``side`` is 0 throughout; each sorted by n) of different roots that the sketches leave possible.

    ``tokens`` are each member's tokens with long lists that are less than this list's: a pair that
    shares one is given in the list of the least. Counts of common values are matrix products, BLOCK by BLOCK.
    """
    size = np.array([len(p) for p in sketches])
    cut = int(np.searchsorted(side, 1))
    left = [np.arange(i, min(i + BLOCK, cut)) for i in range(0, cut, BLOCK)]
    right = [np.arange(i, min(i + BLOCK, len(n))) for i in range(cut, len(n), BLOCK)]
    for i, a in enumerate(left):
        for b in right or left[i:]:
            same = b is a
            if n[b[0]] * percent > n[a[-1]] * 100 or n[a[0]] * percent > n[b[-1]] * 100:
                continue
            both = a if same else np.concatenate([a, b])
            if len(np.unique(root[both])) == 1:
                continue
            at = 0 if same else len(a)
            common = _common([sketches[k] for k in both], len(a), at)
            earlier = _common([tokens[k] for k in both], len(a), at)
            na, nb = n[a][:, None], n[b][None, :]
            ok = _short_side(na, nb, size[a][:, None], size[b][None, :], reach[a][:, None], reach[b][None, :], common, percent)
            ok &= (earlier == 0) & (root[a][:, None] != root[b][None, :]) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            if same:
                ok &= a[:, None] < b[None, :]
            u, v = np.nonzero(ok)
            yield a[u], b[v]


#: Units of a long list in one block, about; a task holds two blocks at a time.
PACK = 4096


def _block_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Lists (token, gid, n, root) of several roots, cut into blocks: each row once for every pair of blocks (token, ci, bi, cj, bj) that it is in.

    Blocks are in order of size. A root with PACK units in a list has blocks of its own, so the many copies of
    a text meet the few strangers of their lists, not each other. Pairs of one root or of unlike sizes are left out.
    """
    by_root = lists.groupBy("token", "root").agg(F.count(F.lit(1)).alias("c"))
    mixed = by_root.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
    own = by_root.where(F.col("c") >= PACK).select("token", "root", F.col("root").alias("cls"))
    rows = lists.join(mixed, "token").join(own, ["token", "root"], "left")
    rows = cut_lineage(rows.select("token", F.coalesce("cls", F.lit("").cast("binary")).alias("cls"), "n", "gid", "root"))
    sizes = rows.groupBy("token", "cls", "n").agg(F.count(F.lit(1)).alias("c"))  # a row a size: what the window holds
    sizes = sizes.withColumn("begin", F.sum("c").over(Window.partitionBy("token", "cls").orderBy("n")) - F.col("c"))
    rows = rows.join(sizes, ["token", "cls", "n"]).withColumn("block", F.floor((F.col("begin") + F.pmod(F.xxhash64("gid", "root"), "c")) / PACK).cast("long"))
    rows = cut_lineage(rows.select("token", "cls", "block", "n", "gid", "root"))
    blocks = rows.groupBy("token", "cls", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("root").alias("r"), F.max("root").alias("t"))
    i, j = (blocks.select("token", *[F.col(c).alias(f"{d}{e}") for c, d in (("cls", "c"), ("block", "b"), ("lo", "lo"), ("hi", "hi"), ("r", "r"), ("t", "t"))]) for e in "ij")
    met = (i.join(j, "token").where("ci < cj OR ci = cj AND bi <= bj").where("least(ri, rj) < greatest(ti, tj)")
           .where(f"{percent} * loj <= 100 * hii AND {percent} * loi <= 100 * hij"))
    first, second = (F.struct(F.lit(k).alias("side"), F.col(f"c{e}").alias("cls"), F.col(f"b{e}").alias("block")) for k, e in enumerate("ij"))
    sides = F.when(F.expr("ci = cj AND bi = bj"), F.array(first)).otherwise(F.array(first, second))
    met = met.select("token", "ci", "bi", "cj", "bj", F.explode(sides).alias("e")).select("token", "ci", "bi", "cj", "bj", "e.*")
    return rows.join(met, ["token", "cls", "block"]).select("token", "ci", "bi", "cj", "bj", "side", "n", "gid", "root")


def _mixed(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lists (token, gid, n, pos, root) of several roots: those of up to LIST members, as a table, and the longer ones."""
    size = lists.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    size = cut_lineage(size.select("token", "c"))
    return cut_lineage(lists.join(size.where(F.col("c") <= LIST), "token").drop("c")), lists.join(size.where(F.col("c") > LIST).select("token"), "token")


def _list_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of groups that have different roots in a list (token, gid, n, pos, root) and could be similar if they share no token before."""
    a, b = (lists.select("token", F.col("gid").alias(g), F.col("n").alias(f"n{g}"), (F.col("n") - F.col("pos")).alias(f"left{g}"), F.col("root").alias(f"r{g}")) for g in "ab")
    need = f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}"
    return (a.join(b, "token").where("a < b AND ra != rb").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb) AND least(lefta, leftb) >= {need}")
            .select("a", "b").distinct())


def _across(lists: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, ra, b, rb) of units in different components that meet in a list (token, gid, n, root) and can be similar."""
    rows = cut_lineage(_block_pairs(lists, percent))
    mine = rows.groupBy("gid").agg(F.array_sort(F.collect_set("token")).alias("tokens"))  # no more than a prefix
    rows = rows.join(mine, "gid").join(groups.select("gid", sketch("int").alias("s"), reach().alias("r")), "gid")  # few chance matches keep the tables narrow
    at = ["token", "ci", "bi", "cj", "bj"]
    below = F.filter("tokens", lambda t: t < F.col("token")).alias("tokens")  # a pair is judged in the least list that it shares: only smaller ones matter here
    rows = rows.select(*at, "side", "n", "gid", "root", "s", "r", below).repartition(*at).sortWithinPartitions(*at, "side", "n", "gid", "root")

    def cross(batches):
        for _, _, _, _, _, side, n, gid, root, sketches, reach_, tokens in _runs(batches, len(at)):
            _, number = np.unique(np.array([r.hex() for r in root]), return_inverse=True)
            for a, b in _close_in_blocks(side, n.astype(np.int64), sketches, reach_, tokens, number, percent):
                for lo in range(0, len(a), 1 << 15):
                    u, v = a[lo : lo + (1 << 15)], b[lo : lo + (1 << 15)]
                    yield pa.RecordBatch.from_arrays([pa.array(gid[u]), pa.array(root[u].tolist(), pa.binary()), pa.array(gid[v]), pa.array(root[v].tolist(), pa.binary())], ["a", "ra", "b", "rb"])

    return rows.mapInArrow(cross, "a long, ra binary, b long, rb binary")


def join_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, sid, root and th of every row; sid names the row's set, null for none, root its component, th is a hash of the text."""
    rows = narrow(docs, id_col, text_col)
    last = rows.sparkSession.sparkContext.broadcast(frequent_tokens(rows, k))  # at most LISTED numbers
    wide = signatures(rows, last, percent, k)
    groups = cut_lineage(wide.where("gid IS NOT NULL").groupBy("gid", "n").agg(F.first("prefix").alias("prefix"), F.first("plain").alias("plain")))
    signed = cut_lineage(wide.select("doc_id", "th", "n", "sid", "gid"))
    drop_table(wide)  # each prefix is kept once, with its group
    sets = cut_lineage(signed.where("n > 0").groupBy("sid").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th")).alias("m"), F.min("n").alias("n"), F.min("gid").alias("gid"))
        .select("sid", F.col("m.doc_id").alias("rep"), F.col("m.th").alias("th"), "n", "gid"))
    members = sets.where("gid IS NOT NULL").select("sid", "gid", "n")
    pairs, long_lists = group_pairs(groups, percent)
    pairs = cut_lineage(close_pairs(pairs.unionByName(hub_pairs(long_lists)).distinct(), groups, percent))
    # members of one group are chained first; then one stands for all of a group and component
    near = cut_lineage(_ordered(chains(members)))
    tied = components(verified(near, sets, rows, percent, k), "x", "y")
    units = _units(_rooted(members, tied))
    first = cut_lineage(_ordered(_representatives(cut_lineage(_between(pairs, units)), units).unionByName(_pivots(units))).join(near, ["x", "y"], "left_anti"))
    tied = _tie(tied, verified(first, sets, rows, percent, k))
    tried = near.unionByName(first)
    # what is still apart: lists and pairs of groups by representatives, then by all members
    rooted = cut_lineage(_rooted(members, tied))
    units = _units(rooted)
    few, many = _mixed(cut_lineage(long_lists.select("token", "gid", "pos").join(units, "gid").select("token", "gid", "n", "pos", "root")))
    more = close_pairs(cut_lineage(_list_pairs(few, percent).join(pairs, ["a", "b"], "left_anti")), groups, percent)
    pairs = cut_lineage(pairs.unionByName(more))
    spread = many.select("token", "gid", "n", "root")
    # members of one group have one prefix: they meet in a list of their own
    alike = units.select(F.col("gid").alias("token"), "gid", "n", "root")
    found = _between(pairs, units).unionByName(_across(spread, groups, percent)).unionByName(_across(alike, groups, percent))
    swap = F.col("ra") > F.col("rb")
    found = cut_lineage(found.select(*[F.when(swap, F.col(v)).otherwise(F.col(u)).alias(u) for u, v in (("a", "b"), ("ra", "rb"), ("b", "a"), ("rb", "ra"))]).distinct())
    for whole in (False, True):
        left = _members(found, units, rooted, tied) if whole else _representatives(found, units)
        left = cut_lineage(left.join(tried, ["x", "y"], "left_anti"))
        if not left.isEmpty():
            tied = _tie(tied, verified(left, sets, rows, percent, k))
            tried = tried.unionByName(left)
    home = sets.select("sid", "rep").join(tied.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    home = cut_lineage(home)
    ids = home.groupBy("root").agg(F.min("rep").alias("component_id"))
    home = _spread_join(home, (ids, ["root"])).select("sid", "component_id", "root")
    return (signed.select("doc_id", "n", "sid", "th").join(home, "sid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "sid", "root", "th"))


def component_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return join_sets(docs).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE) -> DataFrame:
    """One row of each component: the one with the least id, then the least hash of its text; null ids come last.

    Rows are told apart by id and text, so unrelated texts under one id (or under none) are
    judged each for itself; of rows that are equal in id and text one stays, the same at every run.
    Rows without words are linked with nothing and all stay as they are.
    """
    mark, number, none = (fresh(docs, c) for c in ("mark", "number", "none"))
    found = join_sets(docs, percent=percent, k=k).where("root IS NOT NULL")
    least = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th")).alias("m"))
    # plain keys, a null id as a column of its own: one exchange of the texts serves the join and the grouping
    keys = {number: lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long")), none: lambda c: c.cast("long").isNull()}
    kept = cut_lineage(least.select(*[f(F.col("m.doc_id")).alias(c) for c, f in keys.items()], F.col("m.th").alias(mark)).distinct())
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.where(words).withColumns({**{c: f(F.col("doc_id")) for c, f in keys.items()}, mark: F.xxhash64(F.col("text").cast("string"))})
    some = rows.join(kept, [number, none, mark], "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = some.groupBy(number, none, mark, "doc_id").agg(F.min_by(whole, F.xxhash64(whole)).alias("row")).select("row.*")
    return one.select(docs.columns).unionByName(docs.where(~words))
