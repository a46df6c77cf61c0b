"""A Merkle manifest of a table: leaves, subtree roots per language, one root, and proofs.

The tree is built bottom up by a slot pivot: the children of a parent become its fanout
columns through conditional aggregates, the columns in order make the parent's digest, and
the columns other than a child's own are that child's siblings. A group of the aggregation
is one parent, so it never holds more than ``fanout`` rows, however large a language is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Siblings of the steps towards the root: digests left of the node's own, and right of it.
_STEPS = "array<struct<left:string,right:string>>"
COLUMNS = (("doc_id", "long"), ("leaf", "string"), ("subroot", "string"), ("root", "string"), ("proof_sha256", "string"), ("folded_root", "string"), ("verified", "boolean"))


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts' concatenated UTF-8 bytes."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """A field in a form that cannot be confused with another: ``-`` for null, else size and value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    """Digest of a document row whose text is ``text``."""
    return digest(*[framed(text if c == "text" else F.col(c)) for c in FIELDS])


def placed(nodes: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``at``, the gapless place from 0 of every row in its group along ``order`` (nulls first).

    Rows are cut into ranges of (group, order) and written; places are counted inside the ranges
    and one number a range and group is carried on, so a group is never one task.
    """
    keys = [*groups, *order]
    ranged = nodes.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    rows = cut_lineage(ranged)
    inner = F.row_number().over(Window.partitionBy("_part", *groups).orderBy(*order)) - 1
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("_part", *groups, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    a, b = rows.withColumn("_at", inner).alias("a"), counts.alias("b")
    same = F.col("a._part") == F.col("b._part")
    for g in groups:
        same = same & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    kept = [F.col(f"a.{c}") for c in nodes.columns]
    return a.join(b, same).select(*kept, (F.col("_at") + F.col("_before")).cast("long").alias("at"))


def _slots(fanout: int) -> list[str]:
    return [f"slot{j}" for j in range(fanout)]


def pivot(nodes: DataFrame, groups: Sequence[str], fanout: int, child: str) -> DataFrame:
    """One row a parent: (groups, at, slot0 …), the column ``child`` spread over the slots by the children's places."""
    spread = [F.max(F.when(F.pmod("at", F.lit(fanout)) == j, F.col(child))).alias(c) for j, c in enumerate(_slots(fanout))]
    return nodes.groupBy(*groups, F.expr(f"at div {fanout}").alias("_up")).agg(*spread).withColumnRenamed("_up", "at")


def _joined(digests: Sequence[Column], wanted: Callable[[int], bool] = lambda j: True) -> Column:
    """The wanted fanout columns in order as one text; absent slots (null) add nothing."""
    return F.concat_ws("", *[d for j, d in enumerate(digests) if wanted(j)])


def _step_of(digests: Sequence[Column], j: int) -> Column:
    """The siblings of slot ``j``: all fanout columns but its own."""
    return F.struct(_joined(digests, lambda i: i < j).alias("left"), _joined(digests, lambda i: i > j).alias("right"))


def _single(fanout: int) -> Column:
    """Whether a parent has the only child of its group; slots fill from the first."""
    return (F.col("at") == 0) & F.col("slot1").isNull()


def climb(nodes: DataFrame, groups: Sequence[str], fanout: int, size: int) -> tuple[list[DataFrame], DataFrame]:
    """Levels of parents above ``nodes`` (groups, at, hash; at most ``size`` in a group), and (groups, hash, height) of each group's top.

    A group with a single node has its top and takes no part in the next level. The number of
    levels is the logarithm of ``size``; each is a written table with 1 / fanout of the rows below.
    """
    levels, top = [], None
    while size > 1:
        both = cut_lineage(pivot(nodes, groups, fanout, "hash"))
        ended = both.where(_single(fanout)).select(*groups, F.col("slot0").alias("hash"), F.lit(len(levels)).alias("height"))
        top = ended if top is None else top.unionByName(ended)
        level = both.where(~_single(fanout))
        levels.append(level)
        nodes, size = level.select(*groups, "at", F.sha2(_joined(_slots(fanout)).cast("binary"), 256).alias("hash")), -(-size // fanout)
    ended = nodes.select(*groups, "hash", F.lit(len(levels)).alias("height"))
    return levels, ended if top is None else top.unionByName(ended)


def _same(groups: Sequence[str]) -> Column:
    cond = F.col("p.at") == F.col("t.at")
    for g in groups:
        cond = cond & F.col(f"p.{g}").eqNullSafe(F.col(f"t.{g}"))
    return cond


def descend(levels: list[DataFrame], top: DataFrame, groups: Sequence[str], fanout: int, carried: Sequence[str] = ()) -> DataFrame:
    """(groups, at, above, carried) of all nodes below ``levels``, given those of each group's top and its ``height``.

    ``above`` lists the siblings of every step from the node to the root. The levels are walked
    from the highest; a group enters at the level of its top. Joins are on (group, place), which
    is unique, so no group is one task.
    """
    kept = [*groups, "at", "above", *carried]
    known = None
    for k in range(len(levels), -1, -1):
        here = top.where(F.col("height") == k).withColumn("at", F.lit(0).cast("long")).select(*kept)
        known = here if known is None else known.unionByName(here)
        if k == 0:
            return known
        parents = levels[k - 1].alias("p").join(known.alias("t"), _same(groups)).select("p.*", "t.above", *[f"t.{c}" for c in carried])
        digests = [F.col(c) for c in _slots(fanout)]
        entries = [F.when(d.isNotNull(), F.struct((F.col("at") * fanout + j).alias("at"), _step_of(digests, j).alias("step"))) for j, d in enumerate(digests)]
        below = parents.select(*groups, "above", *carried, F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
        known = cut_lineage(below.select(*groups, F.col("e.at").alias("at"), F.concat(F.array("e.step"), "above").cast(_STEPS).alias("above"), *carried))


def fold(leaf: Column, above: Column) -> Column:
    """The root that a leaf's digest leads to through the siblings of its steps."""
    return F.aggregate(above, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]).cast("binary"), 256))


def manifest(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Every document's leaf, subtree root, root, proof and whether its folded root still fits.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Leaves of a language ascend by
    doc_id and are folded by runs of ``fanout`` to a subroot; subroots by language (null first,
    bytewise) are folded likewise to the root. Where 3 divides the CRC-32 of the decimal doc_id, the
    leaf is recomputed from a text with A-Z in lower case (a tampered text) before it is folded.

    Null fields are framed as ``-``, so null and empty differ. A null doc_id comes first in its
    language and is never tampered with; rows of equal doc_id are ordered by their digest, so
    repeated rows give equal leaves in neighbouring places. Further columns play no part. An
    empty table has no leaves and gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.col("n_chars").cast("long").alias("n_chars"), F.col("text").cast("string").alias("text"))
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    leaves = rows.select("lang", "doc_id", leaf_digest(F.col("text")).alias("hash"),
                         F.when(tampered, leaf_digest(F.translate("text", _UPPER, _LOWER))).alias("found"))
    leaves = placed(leaves, ["lang"], ["doc_id", "hash", "found"]).withColumn("node", F.struct("hash", "doc_id", "found"))
    base = cut_lineage(pivot(leaves, ["lang"], fanout, "node"))
    last = base.agg(F.max("at")).first()[0]
    if last is None:
        return base.select(*[F.lit(None).cast(t).alias(c) for c, t in COLUMNS]).limit(0)

    # up: the subroots, and the languages' own tree
    digests = [F.col(f"{c}.hash") for c in _slots(fanout)]
    first = base.select("lang", "at", F.when(_single(fanout), digests[0]).otherwise(F.sha2(_joined(digests).cast("binary"), 256)).alias("hash"))
    levels, tops = climb(first, ["lang"], fanout, last + 1)
    ranked = cut_lineage(placed(tops.withColumn("one", F.lit(0)), ["one"], ["lang"]))
    upper, summit = climb(ranked.select("one", "at", "hash"), ["one"], fanout, ranked.count())
    root = summit.first()["hash"]

    # down, with the siblings of every step
    inner = descend(upper, summit.withColumn("above", F.array().cast(_STEPS)), ["one"], fanout)
    tops = ranked.alias("p").join(inner.alias("t"), F.col("p.at") == F.col("t.at")).select("p.lang", "p.height", F.col("p.hash").alias("subroot"), "t.above")
    steps = descend(levels, tops, ["lang"], fanout, ["subroot"])
    parents = base.alias("p").join(steps.alias("t"), _same(["lang"])).select("p.*", "t.above", "t.subroot")
    entries = []
    for j, c in enumerate(_slots(fanout)):
        own = F.when(_single(fanout), F.array().cast(_STEPS)).otherwise(F.array(_step_of(digests, j)).cast(_STEPS))
        entries.append(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("node"), F.concat(own, "above").alias("above"))))
    kept = parents.select("subroot", F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("subroot", "e.node.*", "e.above")
    siblings = F.concat_ws("", F.transform("above", lambda s: F.concat(s["left"], s["right"])))
    out = kept.select("doc_id", F.col("hash").alias("leaf"), "subroot", F.lit(root).alias("root"), F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
                      fold(F.coalesce("found", "hash"), F.col("above")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
