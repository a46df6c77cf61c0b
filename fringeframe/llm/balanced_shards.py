"""Shards by balanced label propagation, in DataFrame operations only.

Documents with the same link key (here: equal texts) are neighbours. Every document starts
in a shard drawn from its id; then, round by round, linked documents move to the shard that
holds most of their neighbours, as far as that shard still has room for linked documents.
The state is one row per (key, shard) with a count, not one per document, so a key of any
size is at most ``n_shards`` rows, and a round is a window over those rows and a join with the
shard's room. A key too large for one shard fills one shard and goes on to the next.
At last all rows get a place: the shards' linked documents key by key, then documents
without links as filling. Shards are equal cuts of the places, so their counts are at most one
apart, and only keys at a cut are split.

Ranks are taken in two levels (counts of buckets, then places inside a bucket; large keys are
salted into buckets of ``CHUNK``), so no task orders a whole key or the whole table.

Defined results: a null text has size 1 and the checksum of no bytes, and null texts are one
group of their own; null ids are allowed; repeated rows are neighbours; an empty table gives
no rows. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut_lineage, utf8_size

ROUNDS = 12
#: Rows of one key that are ranked in one group; buckets of a rank.
CHUNK, BUCKETS = 20_000, 1024


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null is not the empty text."""
    return F.struct(F.xxhash64(F.lit(11), text).alias("a"), F.xxhash64(F.lit(29), text, text.isNull()).alias("b"))


def measure(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """doc_id, size, text_crc32 and link key (ka, kb) of every row, as a written table."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (utf8_size(text) + 1).alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), (key if key is not None else text_key(text)).alias("k"))
    return cut_lineage(rows.select("doc_id", "size", "text_crc32", F.col("k.a").alias("ka"), F.col("k.b").alias("kb")))


def _start(n_shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), "doc_id", "ka"), F.lit(n_shards)).cast("int")


def propagate(rows: DataFrame, n_shards: int, total: int, rounds: int = ROUNDS) -> DataFrame:
    """(ka, kb, label, n): how many documents of each linked key end in each shard."""
    counts = rows.groupBy("ka", "kb", _start(n_shards).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy("ka", "kb"))
    state = cut_lineage(counts.withColumn("whole", whole).where("whole > 1").drop("whole"))
    room = total // n_shards
    per_key = Window.partitionBy("ka", "kb")
    for _ in range(rounds):
        used = {r["label"]: r["n"] for r in state.groupBy("label").agg(F.sum("n").alias("n")).collect()}  # one row a shard
        free = {b: room - used.get(b, 0) for b in range(n_shards)}
        if not used or max(free.values()) <= 0:
            break
        free_of = F.element_at(F.create_map(*[F.lit(x) for b, n in free.items() for x in (b, max(0, n))]), F.col("label"))
        # the fullest shard of the key that still has room; documents move up in (count, -shard) only
        aim = F.max(F.when(free_of > 0, F.struct("n", (-F.col("label")).alias("l")))).over(per_key)
        moves = (state.withColumn("aim", aim).where("aim IS NOT NULL AND aim > struct(n, -label)")
                 .select("ka", "kb", "label", "n", (-F.col("aim.l")).alias("to"), F.col("aim.n").alias("pull")))
        # strong pulls first: order of (pull, bucket), summed per shard over a bounded number of bins
        moves = moves.withColumn("bin", -F.floor(F.log2(F.col("pull") + 1)).cast("int") * 64 + F.pmod("kb", F.lit(64)).cast("int"))
        bins = moves.groupBy("to", "bin").agg(F.sum("n").alias("all"))
        before = F.sum("all").over(Window.partitionBy("to").orderBy("bin")) - F.col("all")
        free_to = F.element_at(F.create_map(*[F.lit(x) for b, n in free.items() for x in (b, max(0, n))]), F.col("to"))
        bins = bins.withColumn("open", free_to - before).where("open > 0").select("to", "bin", "open")
        ahead = F.sum("n").over(Window.partitionBy("to", "bin").orderBy("ka", "kb", "label")) - F.col("n")
        moved = moves.join(bins, ["to", "bin"]).withColumn("m", F.least(F.col("n"), F.col("open") - ahead)).where("m > 0")
        change = moved.select("ka", "kb", "label", (-F.col("m")).alias("n")).unionByName(moved.select("ka", "kb", F.col("to").alias("label"), F.col("m").alias("n")))
        change = cut_lineage(change)
        if change.isEmpty():
            break
        state = cut_lineage(state.unionByName(change).groupBy("ka", "kb", "label").agg(F.sum("n").alias("n")).where("n > 0"))
    return state


def _running(df: DataFrame, by: list[str], order: list, size: str, out: str) -> DataFrame:
    """``out``: sum of ``size`` over the rows before, inside ``by``."""
    return df.withColumn(out, F.coalesce(F.sum(size).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def assign(rows: DataFrame, n_shards: int = 8, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` of :func:`measure` with shard and slot."""
    total = rows.count()
    state = propagate(rows, n_shards, total, rounds)
    linked = {r["label"]: r["n"] for r in state.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    left = total - sum(linked.values())
    # places of the shards' parts: linked rows, then filling; one row a shard
    begin, parts, fill_begin = 0, [], 0
    for b in range(n_shards):
        n = linked.get(b, 0)
        fill = min(left - fill_begin, max(0, total * (b + 1) // n_shards - begin - n)) if b < n_shards - 1 else left - fill_begin
        parts.append((b, begin, begin + n, fill_begin, fill_begin + fill))
        begin, fill_begin = begin + n + fill, fill_begin + fill

    # 1. linked: place of each (shard, key), then of each row inside its key
    chunk = state.withColumn("bucket", F.pmod("ka", F.lit(BUCKETS)).cast("int"))
    sums = _running(chunk.groupBy("label", "bucket").agg(F.sum("n").alias("all")), ["label"], ["bucket"], "all", "b0").select("label", "bucket", "b0")
    label_at = F.element_at(F.create_map(*[F.lit(x) for p in parts for x in (p[0], p[1])]), F.col("label"))
    chunk = _running(chunk, ["label", "bucket"], ["ka", "kb"], "n", "c0").join(sums, ["label", "bucket"]).withColumn("at", label_at + F.col("b0") + F.col("c0"))
    chunk = _running(chunk, ["ka", "kb"], ["label"], "n", "first")
    runs = chunk.groupBy("ka", "kb").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("first", "at"))).alias("runs"))  # one entry a shard
    keyed = rows.join(runs, ["ka", "kb"], "left")
    tied = keyed.where("n IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.ceil(F.col("n") / CHUNK)).cast("int"))
    salts = _running(tied.groupBy("ka", "kb", "salt").agg(F.count(F.lit(1)).alias("all")), ["ka", "kb"], ["salt"], "all", "s0").select("ka", "kb", "salt", "s0")
    inner = F.row_number().over(Window.partitionBy("ka", "kb", "salt").orderBy("doc_id"))
    tied = tied.withColumn("r", inner - 1).join(salts, ["ka", "kb", "salt"]).withColumn("rank", F.col("s0") + F.col("r"))
    mine = F.element_at(F.filter("runs", lambda x: x["first"] <= F.col("rank")), -1)
    tied = tied.select("doc_id", "size", "text_crc32", (mine["at"] + F.col("rank") - mine["first"]).alias("place"))

    # 2. the others fill what is left of each shard
    lone = keyed.where("n IS NULL").withColumn("bucket", F.pmod("ka", F.lit(4 * BUCKETS)).cast("int"))
    sums = _running(lone.groupBy("bucket").agg(F.count(F.lit(1)).alias("all")).withColumn("one", F.lit(0)), ["one"], ["bucket"], "all", "b0").select("bucket", "b0")
    inner = F.row_number().over(Window.partitionBy("bucket").orderBy("ka", "kb", "doc_id"))
    lone = lone.withColumn("r", inner - 1).join(sums, "bucket").withColumn("rank", F.col("b0") + F.col("r"))
    place = F.coalesce(*[F.when(F.col("rank") < p[4], F.col("rank") - p[3] + p[2]) for p in parts])
    lone = lone.select("doc_id", "size", "text_crc32", place.alias("place"))

    shard = F.expr(f"(place * {n_shards}) div {max(1, total)}")
    return tied.unionByName(lone).withColumn("shard", shard.cast("int")).withColumn(
        "slot", (F.col("place") - F.expr(f"(shard * {max(1, total)}L + {n_shards - 1}) div {n_shards}")).cast("long")).drop("place")


def shard_report(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document; the law is equal counts."""
    return assign(measure(docs), n_shards).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                                  F.lit(None).cast("int").alias("grown_shard"))


def split_keys(sharded: DataFrame, key: str = "text_crc32") -> DataFrame:
    """Cut edges of a sharding: for each key, documents outside the shard that holds most of them."""
    per = sharded.groupBy(key, "shard").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(key).agg((F.sum("n") - F.max("n")).alias("cut"), F.sum("n").alias("n"))
