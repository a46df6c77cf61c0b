"""Catalogue matching: spatial candidates on a grid, greedy pairs, triangles, votes.

Point tables are ``(id, x, y, flux)``.  Copies at one position are folded to that
position before any spatial join, so a crowd of copies never multiplies.
"""

from __future__ import annotations

import heapq
import math

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.order import grouped_median, value_counts, with_image
from ..functions.prefix import running_total, scan_sum
from ..session import cut_lineage


def position_pairs(a: DataFrame, b: DataFrame, radius: float) -> DataFrame:
    """Distinct positions (px, py) of ``a`` and (qx, qy) of ``b`` closer than ``radius``, with ``sep``.

    Cells are ``radius`` wide; ``b`` is repeated in the eight neighbours.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(float(radius)))
    p = a.select(F.col("x").alias("px"), F.col("y").alias("py")).distinct()
    p = p.withColumn("__cx", cell("px")).withColumn("__cy", cell("py"))
    q = b.select(F.col("x").alias("qx"), F.col("y").alias("qy")).distinct()
    around = F.array(*[F.lit(d).cast("long") for d in (-1, 0, 1)])
    q = q.withColumn("__dx", F.explode(around)).withColumn("__dy", F.explode(around))
    q = q.withColumn("__cx", cell("qx") + F.col("__dx")).withColumn("__cy", cell("qy") + F.col("__dy")).drop("__dx", "__dy")
    sep = F.hypot(F.col("px") - F.col("qx"), F.col("py") - F.col("qy"))
    return p.join(q, ["__cx", "__cy"]).withColumn("sep", sep).where(F.col("sep") < F.lit(float(radius))).drop("__cx", "__cy")


def ordinal_at_position(pts: DataFrame) -> DataFrame:
    """Add ``ord``: 1-based place by (flux, id) among the points of the same position.

    Counted, not sorted: distinct (flux, id block) groups are scanned in flux bins,
    and only a block of 4096 ids is ordered.  Ids must be unique integers.
    """
    block = F.floor(F.col("id") / F.lit(4096))
    d = pts.withColumn("__blk", block)
    g = d.groupBy("x", "y", "flux", "__blk").agg(F.count(F.lit(1)).alias("__n"))
    g = with_image(g.withColumn("__o", F.struct("flux", "__blk")), "flux")
    g = scan_sum(g, ["x", "y"], "__o", F.shiftright("__i", 37), "__n", "__cum")  # 32,768 bins between two powers of two
    g = g.select("x", "y", "flux", "__blk", (F.col("__cum") - F.col("__n")).alias("__before"))
    inside = Window.partitionBy("x", "y", "flux", "__blk").orderBy("id")
    d = d.withColumn("__k", F.row_number().over(inside)).join(g, ["x", "y", "flux", "__blk"])
    return d.withColumn("ord", F.col("__before") + F.col("__k")).drop("__blk", "__k", "__before")


#: Rows of a tile that one task may hold; a tile with more is left to the rounds on queues.
TILE_ROWS = 200_000
#: Width of a tile in search radii.
TILE_RADII = 32


def _match_tile(rows: list[tuple]) -> list[tuple]:
    """Pairs (px, py, qx, qy, source, reference) of one tile that the sequential rule makes, whatever happens outside.

    Rows are (kind, ax, ay, bx, by, (is NaN, flux, id)): 0 an edge p to q inside, 1 and 2 the lowest key of a neighbour outside of p and of q,
    3 and 4 the free sources at p and references at q in their order. Sources go in rising order; one that may go to a
    reference outside, or to one that a lower source may take, waits, and so does whoever wants what it may take.
    """
    edges, rival_p, rival_q, src, ref = {}, {}, {}, {}, {}
    for kind, ax, ay, bx, by, k in rows:
        if kind == 0:
            edges.setdefault((ax, ay), []).append((bx, by))
        elif kind < 3:
            rival, bound = (rival_p, rival_q)[kind - 1], (k, bx, by)
            rival[ax, ay] = min(rival.get((ax, ay), bound), bound)
        else:
            (src, ref)[kind - 3].setdefault((ax, ay), []).append(k)
    at_p, at_q = dict.fromkeys(src, 0), dict.fromkeys(ref, 0)
    heap, held, out = [(src[p][0], *p) for p in edges if p in src], set(), []
    heapq.heapify(heap)
    while heap:
        key = heapq.heappop(heap)
        p = key[1:]
        heads = [(ref[q][at_q[q]], *q) for q in edges[p] if q in ref and at_q[q] < len(ref[q])]
        if not heads:
            continue
        best = min(heads)
        q = best[1:]
        if q in held or p in rival_p and rival_p[p] < best or q in rival_q and rival_q[q] < key:
            held.update(h[1:] for h in heads)
            continue
        out.append((*p, *q, key[0][2], best[0][2]))
        at_p[p] += 1
        at_q[q] += 1
        if at_p[p] < len(src[p]):
            heapq.heappush(heap, (src[p][at_p[p]], *p))
    return out


def _tile_round(live: DataFrame, s: DataFrame, r: DataFrame, width: float, shift: tuple[float, float], crowd: DataFrame | None) -> DataFrame:
    """Matches that tiles of the sky can decide alone (:func:`_match_tile`); of neighbours outside a tile only the heads go there."""
    tile = lambda c, off: F.floor(F.col(c) / F.lit(width) + F.lit(off))
    d = live.select("*", tile("px", shift[0]).alias("ptx"), tile("py", shift[1]).alias("pty"), tile("qx", shift[0]).alias("qtx"), tile("qy", shift[1]).alias("qty"))
    inside = (F.col("ptx") == F.col("qtx")) & (F.col("pty") == F.col("qty"))

    def rows(d, t, kind, a, b, k, ord=None):
        none = F.lit(None).cast("double")
        ab = [F.col(c) for c in a] + ([F.col(c) for c in b] if b else [none, none])
        return d.select(F.col(t[0]).alias("tx"), F.col(t[1]).alias("ty"), F.lit(kind).alias("kind"), *[c.alias(n) for c, n in zip(ab, ("ax", "ay", "bx", "by"))],
                        (F.col(f"{k}.flux") if k else none).cast("double").alias("flux"), (F.col(f"{k}.id") if k else F.lit(None)).cast("long").alias("id"),
                        (F.col(ord) if ord else F.lit(0)).cast("long").alias("ord"))

    p, q, pt, qt = ("px", "py"), ("qx", "qy"), ("ptx", "pty"), ("qtx", "qty")
    own = d.where(inside)
    sends = [rows(own, pt, 0, p, q, None), rows(d.where(~inside), pt, 1, p, q, "rk"), rows(d.where(~inside), qt, 2, q, p, "sk"),
             rows(s.join(own.select(*p, *pt, "i").distinct(), [*p]).where(F.col("ord") >= F.col("i")), pt, 3, p, None, "k", "ord"),
             rows(r.join(own.select(*q, *qt, "j").distinct(), [*q]).where(F.col("ord") >= F.col("j")), qt, 4, q, None, "k", "ord")]
    sent = reduce(DataFrame.unionByName, sends)
    if crowd is not None:
        sent = sent.join(crowd, ["tx", "ty"], "left_anti")

    def run(batches):
        names, now, held = ["px", "py", "qx", "qy", "src_id", "ref_id"], None, []

        def told():
            cols = list(zip(*_match_tile(held))) or [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, [pa.float64()] * 4 + [pa.int64()] * 2)], names)

        for batch in batches:
            for tx, ty, kind, ax, ay, bx, by, flux, i in zip(*(batch.column(n).to_pylist() for n in range(9))):
                if (tx, ty) != now:
                    if held:
                        yield told()
                    now, held = (tx, ty), []
                held.append((kind, ax, ay, bx, by, None if flux is None else (flux != flux, 0.0 if flux != flux else flux, i)))
        if held:
            yield told()

    dealt = sent.repartition("tx", "ty").sortWithinPartitions("tx", "ty", "kind", "ord")
    return dealt.mapInArrow(run, "px double, py double, qx double, qy double, src_id long, ref_id long")


def _queue_round(live: DataFrame, s: DataFrame, r: DataFrame) -> DataFrame:
    """A position pair whose heads prefer each other is matched head to head for as long as no other neighbour could come in between."""
    best_p = live.groupBy("px", "py").agg(F.min(F.struct("rk", "qx", "qy")).alias("b"))
    best_q = live.groupBy("qx", "qy").agg(F.min(F.struct("sk", "px", "py")).alias("b"))
    e = live.join(best_p.withColumnRenamed("b", "bp"), ["px", "py"]).join(best_q.withColumnRenamed("b", "bq"), ["qx", "qy"])
    at_bp = (F.col("bp.qx") == F.col("qx")) & (F.col("bp.qy") == F.col("qy"))
    at_bq = (F.col("bq.px") == F.col("px")) & (F.col("bq.py") == F.col("py"))
    # the first rival of each side bounds the run
    rival_p = e.where(~at_bp).groupBy("px", "py").agg(F.min("rk").alias("rk2"))
    rival_q = e.where(~at_bq).groupBy("qx", "qy").agg(F.min("sk").alias("sk2"))
    m = (e.where(at_bp & at_bq).select("px", "py", "qx", "qy", "i", "j")
         .join(rival_p, ["px", "py"], "left").join(rival_q, ["qx", "qy"], "left"))
    left = m.join(s, ["px", "py"]).where((F.col("ord") >= F.col("i")) & (F.col("sk2").isNull() | (F.col("k") < F.col("sk2"))))
    left = left.select("px", "py", "qx", "qy", (F.col("ord") - F.col("i")).alias("n"), F.col("id").alias("src_id"))
    right = m.join(r, ["qx", "qy"]).where((F.col("ord") >= F.col("j")) & (F.col("rk2").isNull() | (F.col("k") < F.col("rk2"))))
    right = right.select("px", "py", "qx", "qy", (F.col("ord") - F.col("j")).alias("n"), F.col("id").alias("ref_id"))
    return left.join(right, ["px", "py", "qx", "qy", "n"]).drop("n")


def greedy_match(src: DataFrame, ref: DataFrame, epsilon: float) -> DataFrame:
    """One-to-one pairs: in rising flux each source takes the first free reference, also in rising
    flux, closer than ``epsilon``.  Returns ``src_id, ref_id``.

    Positions act as queues.  In a round a tile of the sky is matched by the sequential rule as far as
    nobody outside can come in between; four places of the tiles take turns, so every position pair lies inside
    one of them.  Tiles with too many rows for a task are left to rounds that match whole runs of two queues.  Only pairs
    of positions that still have points on both sides stay.  The pair with the globally lowest head can always be
    matched, so rounds go on until no pair is left; the result equals the sequential one.
    """
    key = F.struct("flux", "id")
    s = cut_lineage(ordinal_at_position(src).select(F.col("x").alias("px"), F.col("y").alias("py"), "id", key.alias("k"), "ord"))
    r = cut_lineage(ordinal_at_position(ref).select(F.col("x").alias("qx"), F.col("y").alias("qy"), "id", key.alias("k"), "ord"))
    live = position_pairs(src, ref, epsilon).drop("sep")
    at_p = cut_lineage(s.groupBy("px", "py").agg(F.count(F.lit(1)).alias("size")).withColumn("next", F.lit(1).cast("long")))
    at_q = cut_lineage(r.groupBy("qx", "qy").agg(F.count(F.lit(1)).alias("size")).withColumn("next", F.lit(1).cast("long")))
    width, shifts, turn, queues = TILE_RADII * float(epsilon), ((0.0, 0.0), (0.5, 0.5), (0.0, 0.5), (0.5, 0.0)), 0, False
    rounds: list[DataFrame] = []
    while True:
        hp = at_p.join(s.withColumnRenamed("ord", "next"), ["px", "py", "next"])
        hp = hp.select("px", "py", F.col("next").alias("i"), F.col("k").alias("sk"), (F.col("size") - F.col("next") + 1).alias("n_p"))
        hq = at_q.join(r.withColumnRenamed("ord", "next"), ["qx", "qy", "next"])
        hq = hq.select("qx", "qy", F.col("next").alias("j"), F.col("k").alias("rk"), (F.col("size") - F.col("next") + 1).alias("n_q"))
        live = cut_lineage(live.select("px", "py", "qx", "qy").join(hp, ["px", "py"]).join(hq, ["qx", "qy"]))
        if live.isEmpty():
            break
        if queues:
            new, queues = _queue_round(live, s, r), False
        else:
            shift = shifts[turn % len(shifts)]
            crowd = _crowded_tiles(live, width, shift)
            queues = not crowd.isEmpty()
            new = _tile_round(live, s, r, width, shift, crowd if queues else None)
            turn += 1
        new = cut_lineage(new)
        rounds.append(new.select(F.col("src_id").cast(s.schema["id"].dataType), F.col("ref_id").cast(r.schema["id"].dataType)))
        moved_p = new.groupBy("px", "py").agg(F.count(F.lit(1)).alias("t"))
        moved_q = new.groupBy("qx", "qy").agg(F.count(F.lit(1)).alias("t"))
        step = (F.col("next") + F.coalesce("t", F.lit(0).cast("long"))).alias("next")
        at_p = cut_lineage(at_p.join(moved_p, ["px", "py"], "left").select("px", "py", "size", step))
        at_q = cut_lineage(at_q.join(moved_q, ["qx", "qy"], "left").select("qx", "qy", "size", step))
    if not rounds:
        return s.select(F.col("id").alias("src_id"), F.col("id").alias("ref_id")).where(F.lit(False))
    return reduce(DataFrame.unionByName, rounds)


def _crowded_tiles(live: DataFrame, width: float, shift: tuple[float, float]) -> DataFrame:
    """Tiles (tx, ty) whose edges and free points are more than a task should hold."""
    tile = lambda x, y: [F.floor(F.col(x) / F.lit(width) + F.lit(shift[0])).alias("tx"), F.floor(F.col(y) / F.lit(width) + F.lit(shift[1])).alias("ty")]
    loads = [live.select(*tile("px", "py"), F.lit(1).cast("long").alias("n")), live.select(*tile("qx", "qy"), F.lit(1).cast("long").alias("n")),
             live.select("px", "py", "n_p").distinct().select(*tile("px", "py"), F.col("n_p").alias("n")),
             live.select("qx", "qy", "n_q").distinct().select(*tile("qx", "qy"), F.col("n_q").alias("n"))]
    return reduce(DataFrame.unionByName, loads).groupBy("tx", "ty").agg(F.sum("n").alias("n")).where(F.col("n") > TILE_ROWS).select("tx", "ty")


def nearest_match(src: DataFrame, ref: DataFrame, radius: float, dx: float | Column = 0.0, dy: float | Column = 0.0) -> DataFrame:
    """For each source the nearest reference within ``radius`` after taking off the mean offset.

    Returns ``src_id, ref_id, sep``; on equal distance the lowest reference id.
    """
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    moved = src.withColumn("x", F.col("x") - as_col(dx)).withColumn("y", F.col("y") - as_col(dy))
    at_q = ref.groupBy(F.col("x").alias("qx"), F.col("y").alias("qy")).agg(F.min("id").alias("ref_id"))
    pairs = position_pairs(moved, ref, radius).join(at_q, ["qx", "qy"])
    best = pairs.groupBy("px", "py").agg(F.min(F.struct("sep", "ref_id")).alias("b"))
    return moved.join(best, (F.col("x") == F.col("px")) & (F.col("y") == F.col("py"))).select(
        F.col("id").alias("src_id"), F.col("b.ref_id").alias("ref_id"), F.col("b.sep").alias("sep"))


def reject_multiple(pairs: DataFrame, order: str) -> DataFrame:
    """One pair per reference: the smaller |src_flux - ref_flux|, on ties the later in ``order``.

    An aggregate with partial minimum, so a much-matched reference is no hot group.
    """
    cols = [c for c in pairs.columns if c != "ref_id"]
    df = F.abs(F.col("src_flux") - F.col("ref_flux"))
    best = pairs.groupBy("ref_id").agg(F.min_by(F.struct(*cols), F.struct(df, -F.col(order))).alias("b"))
    return best.select("ref_id", *[F.col(f"b.{c}").alias(c) for c in cols])


def with_points(pairs: DataFrame, src: DataFrame, ref: DataFrame) -> DataFrame:
    """Positions and fluxes of both members beside each pair."""
    side = lambda d, n: d.select(F.col("id").alias(f"{n}_id"), *[F.col(c).alias(f"{n}_{c}") for c in ("x", "y", "flux")])
    return pairs.join(side(src, "src"), "src_id").join(side(ref, "ref"), "ref_id")


def offsets(pairs: DataFrame, same_sense: bool = True) -> DataFrame:
    """Mean and sample rms of the offsets; fields of opposite handedness add in y."""
    dx = F.col("src_x") - F.col("ref_x")
    dy = F.col("src_y") - F.col("ref_y") if same_sense else F.col("src_y") + F.col("ref_y")
    return pairs.agg(F.avg(dx).alias("mean_dx"), F.avg(dy).alias("mean_dy"), F.stddev_samp(dx).alias("rms_dx"),
                     F.stddev_samp(dy).alias("rms_dy"), F.count(F.lit(1)).alias("n"))


def crude_match(ref: DataFrame, src: DataFrame, radius: float) -> DataFrame:
    """References near any source, with ``n_src``: how often the list repeats each."""
    n_at = src.groupBy(F.col("x").alias("px"), F.col("y").alias("py")).agg(F.count(F.lit(1)).alias("n"))
    hits = position_pairs(src, ref, radius).join(n_at, ["px", "py"]).groupBy("qx", "qy").agg(F.sum("n").alias("n_src"))
    return ref.join(hits, (F.col("x") == F.col("qx")) & (F.col("y") == F.col("qy"))).drop("qx", "qy")


def unmatched(pairs: DataFrame, src: DataFrame, ref: DataFrame) -> DataFrame:
    """Sources and references without a partner."""
    s = src.join(pairs.select(F.col("src_id").alias("id")), "id", "left_anti").select(F.lit("S").alias("side"), "id")
    r = ref.join(pairs.select(F.col("ref_id").alias("id")), "id", "left_anti").select(F.lit("R").alias("side"), "id")
    return s.unionByName(r)


# ---------------------------------------------------------------- lists and triangles

def brightest(pts: DataFrame, n: int) -> DataFrame:
    """The n brightest points (a top-n, not a global sort)."""
    return pts.orderBy(F.desc("flux"), "id").limit(n)


def triangles(pts: DataFrame, n: int, epsilon: float, max_ratio: float = 10.0) -> DataFrame:
    """Triangles of the n brightest points with side ratio below ``max_ratio``.

    Vertex a joins the shortest and the longest side, b ends the shortest, c the
    longest.  The list is n points long by definition, so it is packed in one array.
    """
    top = brightest(pts, n).agg(F.array_sort(F.collect_list(F.struct("id", "x", "y"))).alias("p"))
    t = top.select("p", F.posexplode("p").alias("i", "a"))
    t = t.select("p", "a", F.posexplode(F.slice("p", F.col("i") + 2, n)).alias("__j", "b"), F.col("i"))
    t = t.select("a", "b", F.explode(F.slice("p", F.col("i") + F.col("__j") + 3, n)).alias("c"))

    def side(u, v, order):
        dx, dy = F.col(f"{v}.x") - F.col(f"{u}.x"), F.col(f"{v}.y") - F.col(f"{u}.y")
        return F.struct(F.sqrt(dx * dx + dy * dy).alias("len"), F.lit(order).alias("o"), dx.alias("dx"), dy.alias("dy"),
                        F.col(f"{u}.id").alias("u"), F.col(f"{v}.id").alias("v"))

    t = t.select(F.array_sort(F.array(side("a", "b", 0), side("b", "c", 1), side("c", "a", 2))).alias("s"))
    t = t.select(F.col("s")[0].alias("s2"), F.col("s")[1].alias("s1"), F.col("s")[2].alias("s3")).where(F.col("s2.len") > 0)
    common = F.when((F.col("s2.u") == F.col("s3.u")) | (F.col("s2.u") == F.col("s3.v")), F.col("s2.u")).otherwise(F.col("s2.v"))
    other = lambda s: F.when(F.col(f"{s}.u") == F.col("a"), F.col(f"{s}.v")).otherwise(F.col(f"{s}.u"))
    r2, r3 = F.col("s2.len"), F.col("s3.len")
    dot = F.col("s3.dx") * F.col("s2.dx") + F.col("s3.dy") * F.col("s2.dy")
    cross = F.col("s2.dy") * F.col("s3.dx") - F.col("s3.dy") * F.col("s2.dx")
    t = t.withColumn("a", common)
    t = t.select(
        "a", other("s2").alias("b"), other("s3").alias("c"), (r3 / r2).alias("ratio"), (dot / (r3 * r2)).alias("angle"),
        F.log10(r2 + r3 + F.col("s1.len")).alias("log_perimeter"), (F.coalesce(F.try_divide(cross, dot), F.lit(0.0)) > 0).alias("clockwise"),
        (1.0 / (r3 * r3) - dot / (r3 * r2) / (r3 * r2) + 1.0 / (r2 * r2)).alias("__f")).where(F.col("ratio") < max_ratio)
    e2, g2, f = epsilon * epsilon, F.col("angle") * F.col("angle"), F.col("__f")
    return t.withColumn("ratio_tol", 2.0 * F.col("ratio") * F.col("ratio") * e2 * f).withColumn(
        "angle_tol", 2.0 * (1.0 - g2) * e2 * f + 3.0 * g2 * (e2 * e2) * f * f).drop("__f")


def match_triangles(src: DataFrame, ref: DataFrame, width: float = 0.05) -> DataFrame:
    """Triangle pairs whose ratio and angle agree within the summed tolerances.

    A band join on the ratio: source triangles are repeated over the ratio bins
    that could hold a partner.
    """
    names = [c for c in src.columns]
    most = ref.agg(F.max("ratio_tol")).scalar()
    s = src.select(*[F.col(c).alias(f"s_{c}") for c in names])
    reach = F.sqrt(F.col("s_ratio_tol") + most)
    lo, hi = F.floor((F.col("s_ratio") - reach) / F.lit(width)), F.floor((F.col("s_ratio") + reach) / F.lit(width))
    s = s.withColumn("__bin", F.explode(F.sequence(lo, hi)))
    r = ref.select(*[F.col(c).alias(f"r_{c}") for c in names]).withColumn("__bin", F.floor(F.col("r_ratio") / F.lit(width)))
    sq = lambda c: (F.col(f"s_{c}") - F.col(f"r_{c}")) * (F.col(f"s_{c}") - F.col(f"r_{c}"))
    ok = (sq("ratio") < F.col("s_ratio_tol") + F.col("r_ratio_tol")) & (sq("angle") < F.col("s_angle_tol") + F.col("r_angle_tol"))
    return s.join(r, "__bin").where(ok).drop("__bin")


def _clip_width(true: int, false: int) -> float:
    """How many deviations a true match may lie from the mean, by the odds of true to false ones."""
    return 3.0 if true > 10 * false else 2.0 if true >= false else 1.0


def trim_triangles(pairs: DataFrame, rounds: int = 5) -> DataFrame:
    """Triangle pairs whose scale and handedness agree with the others (the vote of Groth and of Valdes et al.).

    True matches share one difference of log perimeters and one handedness.  What is kept
    is an interval of differences that narrows around the mean: a round reads one row
    (count, mean, deviation, how many agree in handedness) inside the interval, and the table
    is written once.  True minus false matches are estimated from the tally of all rounds.
    """
    shift = F.col("s_log_perimeter") - F.col("r_log_perimeter")
    table = cut_lineage(pairs.withColumn("__shift", shift).withColumn("__agrees", F.col("s_clockwise") == F.col("r_clockwise")))
    below, above, tally = -math.inf, math.inf, {True: 0, False: 0}
    inside = lambda: table.where((F.col("__shift") > below) & (F.col("__shift") < above))
    for left in reversed(range(rounds + 1)):
        seen = inside().agg(F.count_if("__agrees").alias("agree"), F.count_if(~F.col("__agrees")).alias("differ"),
                            F.avg("__shift").alias("mean"), F.stddev_pop("__shift").alias("spread")).first()
        tally[True] += seen["agree"]
        tally[False] += seen["differ"]
        if not left or seen["mean"] is None:
            break
        if not seen["spread"] > 0:
            below = above  # no scatter to measure by: nothing is left
            continue
        false = 2 * min(tally.values())  # opposed matches are chance, and as many agree by chance
        reach = seen["spread"] * _clip_width(sum(tally.values()) - false, false)
        below, above = max(below, seen["mean"] - reach), min(above, seen["mean"] + reach)
    kept = inside() if tally[True] == tally[False] else inside().where(F.col("__agrees") == F.lit(tally[True] > tally[False]))
    return kept.drop("__shift", "__agrees")


def vote(pairs: DataFrame) -> DataFrame:
    """Point pairs by falling votes, up to a repeated source or a vote below half the one before.

    The ballot holds at most (list length)^2 rows, the lists being the trimmed top-n.
    """
    p = pairs.select(F.explode(F.array(*[F.struct(F.col(f"s_{v}").alias("src_id"), F.col(f"r_{v}").alias("ref_id")) for v in "abc"])).alias("p"))
    v = p.groupBy("p.src_id", "p.ref_id").agg(F.count(F.lit(1)).alias("votes")).withColumn("__k", F.lit(1))
    order = Window.partitionBy("__k").orderBy(F.desc("votes"), "src_id", "ref_id")
    again = Window.partitionBy("src_id").orderBy(F.desc("votes"), "src_id", "ref_id")
    stop = (F.row_number().over(again) > 1) | (F.col("votes") < 0.5 * F.coalesce(F.lag("votes").over(order), F.lit(0)))
    v = v.withColumn("__stop", stop.cast("int")).withColumn("__best", F.max("votes").over(Window.partitionBy("__k")))
    v = v.withColumn("__stopped", F.max("__stop").over(order))
    return v.where((F.col("__stopped") == 0) & (F.col("__best") > 1)).select("src_id", "ref_id", "votes")


# ---------------------------------------------------------------- reports

def completeness(match: DataFrame, miss_src: DataFrame, miss_ref: DataFrame, bins: list[str]) -> DataFrame:
    """Per bin: matched, sources, references, completeness and reliability (null where undefined)."""
    tag = lambda d, n: d.groupBy(*bins).agg(F.count(F.lit(1)).alias(n))
    j = tag(match, "m").join(tag(miss_src, "s"), bins, "full_outer").join(tag(miss_ref, "r"), bins, "full_outer")
    j = j.fillna(0, ["m", "s", "r"])
    n_src, n_ref = F.col("m") + F.col("s"), F.col("m") + F.col("r")
    return j.select(*bins, F.col("m").alias("n_match"), n_src.alias("n_src"), n_ref.alias("n_ref"),
                    F.try_divide("m", n_ref).alias("completeness"), F.try_divide("m", n_src).alias("reliability"))


def flux_comparison(pairs: DataFrame) -> DataFrame:
    """Mean, median and standard deviation (population) of the flux difference."""
    d = pairs.withColumn("__all", F.lit(0)).withColumn("ds", F.col("src_flux") - F.col("ref_flux"))
    med = grouped_median(value_counts(d, ["__all"], "ds"), ["__all"]).select("__all", "median")
    agg = d.groupBy("__all").agg(F.avg("ds").alias("mean"), F.stddev_pop("ds").alias("std"), F.count(F.lit(1)).alias("n"))
    return agg.join(med, "__all").drop("__all")


def number_detections(det: DataFrame, order: str, key: str) -> DataFrame:
    """Number detections 1..n by ``order`` then ``key`` without a single-task sort."""
    return running_total(det, [order, key], F.lit(1).cast("long"), "number")
