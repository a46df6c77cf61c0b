"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The words of a source are its documents in a keyed random order, cut into blocks. A source
whose target is r times its size gives floor(r) full rounds of its blocks and the first part
of one more round, to within about one document of the target. The number of blocks that
each source gives is exact; a binary tree over the output shards splits these quotas by
multivariate-hypergeometric draws, so that every shard gets a random share of every source
and equally many blocks. Each shard then takes disjoint blocks of the source's permuted
blocks, and rows are shuffled inside the shard by a keyed order.

The driver holds one row a source and one number a block; both are checked against a bound.
Everything else is a per-row expression: dealing moves no data.

Defined results: a null text has no words; a null source is a source of its own, last in
order; a source without words has target 0 and gives nothing. Repeated rows (same id and
text) are taken together. The order is keyed by id and text, so other columns, null or not,
play no part and are carried along. An empty table gives an empty mix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut_lineage, fresh, words_of

#: Bounds on what the driver holds and on what is broadcast.
MAX_SOURCES = 100_000
MAX_BLOCKS = 2_000_000
#: No document is taken more often than this.
MAX_REPEATS = 3
SEED = 20_011


@dataclass
class Share:
    """What one source gives."""

    key: str
    size: int
    target: float = 0.0
    rounds: int = 0
    cut: int = -1  # of the last round, documents up to this place of the order
    extra: int = -1  # and the one at this place
    blocks: int = 1
    deal: list[int] | None = None  # shard by round * blocks + block


def _key(source: Column) -> Column:
    """A source as a key without null; 't' sorts after 's', so null comes last."""
    return F.when(source.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def _place(doc_id: Column, text: Column, seed: int) -> Column:
    """Place of a document in the random order, 0 to 2**63 - 1."""
    return F.xxhash64(F.lit(seed), doc_id, text).bitwiseAND(F.lit((1 << 63) - 1))


def targets(sizes: list[int], weights: list[float], most: float = MAX_REPEATS) -> list[float]:
    """Shares of the total by weight; what a source cannot give in ``most`` rounds is shared again."""
    out, open_, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0 and weights[i] > 0], float(sum(sizes))
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if level * weights[i] > most * sizes[i]]
        for i in full or open_:
            out[i] = float(most * sizes[i]) if full else level * weights[i]
            left -= out[i]
        if not full:
            break
        open_ = [i for i in open_ if i not in set(full)]
    return out


def split_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sources, blocks of each) for every shard: exact quotas, even totals."""
    total = int(quotas.sum())
    ends = [total * j // shards for j in range(shards + 1)]
    out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, int), np.zeros(0, int))] * shards
    todo = [(0, shards, np.flatnonzero(quotas), quotas[quotas > 0])]
    while todo:
        lo, hi, who, n = todo.pop()
        if hi - lo == 1 or not len(who):
            out[lo] = (who, n)
            continue
        mid = (lo + hi) // 2
        left = rng.multivariate_hypergeometric(n, ends[mid] - ends[lo], method="marginals")
        for a, b, part in ((lo, mid, left), (mid, hi, n - left)):
            todo.append((a, b, who[part > 0], part[part > 0]))
    return out


def _deal(shares: list[Share], shards: int, seed: int) -> None:
    rng = np.random.default_rng(seed)
    drawn = []
    for s in shares:
        d = np.zeros((s.rounds + 1) * s.blocks, bool)
        d[: s.rounds * s.blocks] = True
        if s.cut >= 0:
            d[s.rounds * s.blocks : s.rounds * s.blocks + (s.cut >> 32) * s.blocks // (1 << 31) + 1] = True
        if s.extra >= 0:
            d[s.rounds * s.blocks + (s.extra >> 32) * s.blocks // (1 << 31)] = True
        drawn.append(d)
    leaves = split_tree(np.array([int(d.sum()) for d in drawn], np.int64), shards, rng)
    turns: list[list[np.ndarray]] = [[] for _ in shares]
    for shard, (who, n) in enumerate(leaves):
        for i, k in zip(who, n):
            turns[i].append(np.full(k, shard, np.int64))
    for s, d, t in zip(shares, drawn, turns):
        deal = np.full(len(d), -1, np.int64)
        if t:
            deal[rng.permutation(np.flatnonzero(d))] = np.concatenate(t)
        s.deal = deal.tolist()


def _frame(spark, shares: list[Share]) -> DataFrame:
    schema = "_key string, _size long, _target double, _rounds int, _cut long, _extra long, _blocks int, _deal array<int>"
    return spark.createDataFrame([(s.key, s.size, s.target, s.rounds, s.cut, s.extra, s.blocks, s.deal or []) for s in shares], schema)


def measure(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Narrow written table of all rows: doc_id, source key, words, place in the order."""
    return cut_lineage(docs.select(F.col("doc_id"), _key(F.col("source")).alias("_key"), words_of(F.col("text")).alias("size"),
                                   _place(F.col("doc_id"), F.col("text"), seed).alias("_u")))


def plan(measured: DataFrame, weights: tuple[float, ...] = (1, 2, 3), shards: int = 16, blocks_per_shard: int = 64,
         seed: int = SEED) -> list[Share]:
    """Target, rounds, last cut and dealt blocks of every source; weights repeat over the sources in order."""
    spark = measured.sparkSession
    rows = measured.groupBy("_key").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: group them first")
    shares = [Share(r["_key"], int(r["size"])) for r in sorted(rows, key=lambda r: r["_key"])]
    total = sum(s.size for s in shares)
    if total == 0:
        return shares
    for s, t in zip(shares, targets([s.size for s in shares], [float(weights[i % len(weights)]) for i in range(len(shares))])):
        s.target = t
        s.rounds = int(t / s.size + 1e-12) if s.size else 0
        s.blocks = max(1, min(1 << 20, round(s.size * shards * blocks_per_shard / total)))
    if sum((s.rounds + 1) * s.blocks for s in shares) > MAX_BLOCKS:
        raise ValueError(f"more than {MAX_BLOCKS} blocks: ask for fewer shards or blocks")
    rest = spark.createDataFrame([(s.key, max(0.0, s.target - s.rounds * s.size)) for s in shares], "_key string, rest double")
    by_key = {s.key: s for s in shares}
    for r in _last_round(measured, rest).collect():
        by_key[r["_key"]].cut, by_key[r["_key"]].extra = r["cut"], r["extra"]
    _deal(shares, shards, seed)
    return shares


def _last_round(measured: DataFrame, rest: DataFrame) -> DataFrame:
    """Where each source's last, partial round ends: bins of the order, then bins of the bin, then rows."""
    bits, found = 10, rest.withColumn("before", F.lit(0.0)).withColumn("bin", F.lit(0).cast("long"))
    left = measured.join(F.broadcast(rest), "_key")
    for level in (1, 2):
        shift = 63 - bits * level
        inside = left if level == 1 else measured.join(F.broadcast(found), "_key").where(F.shiftright("_u", shift + bits) == F.col("bin"))
        sums = inside.groupBy("_key", F.shiftright("_u", shift).alias("b")).agg(F.sum("size").alias("n"))
        run = F.sum("n").over(Window.partitionBy("_key").orderBy("b"))  # at most 1,024 rows a source
        sums = (sums.join(F.broadcast(found), "_key").withColumn("run", F.col("before") + run)
                .where("run > rest").groupBy("_key").agg(F.min(F.struct("b", "run", "n")).alias("x")))
        found = found.select("_key", "rest").join(sums, "_key").select("_key", "rest", (F.col("x.run") - F.col("x.n")).alias("before"), F.col("x.b").alias("bin"))
        found = cut_lineage(found)
    inside = measured.join(F.broadcast(found), "_key").where(F.shiftright("_u", 43) == F.col("bin"))  # a millionth of a source
    units = inside.groupBy("_key", "_u").agg(F.sum("size").alias("n"), F.first("rest").alias("rest"), F.first("before").alias("before"), F.first("bin").alias("bin"))
    run = F.col("before") + F.sum("n").over(Window.partitionBy("_key").orderBy("_u"))
    cuts = cut_lineage(units.withColumn("run", run).groupBy("_key").agg(
        F.coalesce(F.max(F.when(F.col("run") <= F.col("rest"), F.col("_u"))), F.first("bin") * F.lit(1 << 43) - 1).alias("cut"),
        (F.first("rest") - F.coalesce(F.max(F.when(F.col("run") <= F.col("rest"), F.col("run"))), F.first("before"))).alias("gap")))
    # one document beyond the cut that fills the gap best, if one makes it smaller
    best = (measured.join(F.broadcast(cuts), "_key").where(F.col("_u") > F.col("cut")).withColumn("off", F.abs(F.col("size") - F.col("gap")))
            .where("off < gap").groupBy("_key").agg(F.min(F.struct("off", "_u")).alias("x")))
    return cuts.join(best, "_key", "left").select("_key", "cut", F.coalesce("x._u", F.lit(-1).cast("long")).alias("extra"))


def place(rows: DataFrame, shares: list[Share], u: str, key: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the shards that take the row, one entry a copy. Rows stay where they are."""
    names = ["_key", "_size", "_target", "_rounds", "_cut", "_extra", "_blocks", "_deal"]
    mine = {n: fresh(rows, f"_share{n}") for n in names}
    shares_df = _frame(rows.sparkSession, shares).select([F.col(n).alias(mine[n]) for n in names])
    c = {n: F.col(mine[n]) for n in names}
    last = (F.col(u) <= c["_cut"]) | (F.col(u) == c["_extra"])
    copies = c["_rounds"] + F.when(last, 1).otherwise(0)
    block = F.shiftright(F.shiftright(u, 32) * c["_blocks"].cast("long"), 31).cast("int")
    dealt = F.when(copies > 0, F.transform(F.sequence(F.lit(0), copies - 1), lambda e: F.element_at(c["_deal"], e * c["_blocks"] + block + 1)))
    # one row a source and one number a block, both bounded by plan()
    return (rows.join(F.broadcast(shares_df), F.col(key) == c["_key"], "left")
            .withColumn(out, F.coalesce(dealt, F.array().cast("array<int>")))
            .withColumn(fresh(rows, "source_size"), F.coalesce(c["_size"], F.lit(0))).withColumn(fresh(rows, "target"), F.coalesce(c["_target"], F.lit(0.0)))
            .drop(*mine.values()))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), shards: int = 16, seed: int = SEED,
        shard_out: str = "shard", copy_out: str = "copy", order_out: str = "order") -> DataFrame:
    """The mixed rows with all columns of ``docs``: one row a copy, its shard, and the key that shuffles the shard.

    Added columns get another name where ``docs`` has one of that name.
    """
    shares = plan(measure(docs, seed), weights, shards, seed=seed)
    key, u, dealt = fresh(docs, "_key"), fresh(docs, "_u"), fresh(docs, "_dealt")
    rows = docs.withColumn(key, _key(F.col("source"))).withColumn(u, _place(F.col("doc_id"), F.col("text"), seed))
    rows = place(rows, shares, u, key, dealt)
    shard, copy, order = (fresh(docs, n) for n in (shard_out, copy_out, order_out))
    rest = [F.col(f"`{c}`") for c in docs.columns]
    return (rows.select(*rest, u, F.posexplode(dealt).alias(copy, shard))
            .select(*rest, shard, copy, F.xxhash64(F.lit(seed + 1), u, copy).alias(order)))


def in_shards(mixed: DataFrame, shard: str = "shard", order: str = "order") -> DataFrame:
    """Rows by shard, shuffled inside each; a large shard is spread over several tasks."""
    return mixed.repartitionByRange(shard, order).sortWithinPartitions(shard, order)


def mix_report(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), shards: int = 16, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document, and the shards of its copies."""
    measured = measure(docs, seed)
    return place(measured, plan(measured, weights, shards, seed=seed), "_u", "_key", "shards").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).cast("long").alias("taken"), "shards")


def restate(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), seed: int = SEED) -> DataFrame:
    """The mix as rows of ``docs``: a document appears once a copy."""
    return mix(docs, weights, seed=seed).select([F.col(f"`{c}`") for c in docs.columns])
