"""Hand-computed values, properties and brute force on small fixtures."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringeframe.functions import healpix as hp
from fringeframe.functions import order, prefix, sky, spectral
from fringeframe.functions.cx import Cx
from fringeframe.operators import average, calibrate, detect, flag, image, joins, match, predict, select, skymodel, spectra, summary
from fringeframe.sources import caltext, catalogue, datagrams, publish, votable
from fringeframe.session import shared_path
from fringeframe.streaming import cycles, merge, sinks


def spec(spark, values, flags=None, sigma=None):
    n = len(values)
    return spark.createDataFrame(
        [(0, 1, 2, 0, "XX", [float(v) for v in values], [0.0] * n, flags or [False] * n, sigma or [1.0] * n)],
        "time long, ant1 long, ant2 long, beam long, pol string, re array<double>, im array<double>, flag array<boolean>, sigma array<double>")


# ---------------------------------------------------------------- averaging

@pytest.mark.parametrize("n_chan,n", [(4, 4), (54, 54), (8, 2), (54, 1)])
def test_channel_average(spark, n_chan, n):
    row = average.average_channels(spec(spark, range(n_chan)), n).first()
    width = max(n, 1)
    assert row["re"] == [pytest.approx(statistics.mean(range(i, i + width))) for i in range(0, n_chan, width)]
    assert not any(row["flag"])


def test_channel_average_must_divide(spark):
    with pytest.raises(Exception, match="does not divide"):
        average.average_channels(spec(spark, range(10)), 3).collect()


def test_channel_average_flags(spark):
    row = average.average_channels(spec(spark, [1, 2, 3, 4], [True, True, False, True], [1.0, 1.0, 2.0, 1.0]), 2, sigma=True).first()
    assert row["flag"] == [True, False] and row["re"] == [0.0, 3.0] and row["sigma"] == [0.0, 2.0]


def test_average_of_constant_is_constant(spark):
    assert average.average_channels(spec(spark, [2.5] * 12), 3).first()["re"] == [2.5] * 4


def test_merge_keeps_order(spark):
    a, b = spec(spark, [1, 2]), spec(spark, [3, 4])
    assert average.merge_spectra([a, b], ["time", "ant1", "ant2", "beam"], ["re"]).first()["re"] == [1, 2, 3, 4]


# ---------------------------------------------------------------- flags

def test_robust_statistics_take_elements(spark):
    amps = [5.0, 1.0, 9.0, 3.0, 7.0, 2.0, 8.0]
    s = sorted(amps)
    row = spark.createDataFrame([(amps,)], "a array<double>").select(*order.array_robust(F.col("a"))).first()
    assert row[0] == s[3] and row[1] == pytest.approx((s[5] - s[1]) / 1.34896)


def test_flags_only_grow(spark):
    flags = [i % 7 == 0 for i in range(30)]
    d = spec(spark, [random.Random(1).gauss(0, 1) + (50 if i == 11 else 0) for i in range(30)], flags)
    for f in (lambda x: flag.clip_auto(x, 3.0), lambda x: flag.clip_fixed(x, 0.1, 10.0), lambda x: flag.clip_stream(x, 1.0, 1.0),
              lambda x: flag.flag_channels(x, [(0, 5, 2)])):
        new = f(d).first()["flag"]
        assert all(b or not a for a, b in zip(flags, new))
    assert flag.clip_auto(d, 3.0).first()["flag"][11]


def test_stokes_v_skips_zero(spark):
    z = [0.0] * 8
    d = spark.createDataFrame([(z, z, z, z, [False] * 8)], "xy_re array<double>, xy_im array<double>, yx_re array<double>, yx_im array<double>, flag array<boolean>")
    assert flag.clip_stokes_v(d, 0.0).first()["flag"] == [False] * 8


def test_missing_uvw_must_be_flagged(spark):
    rows = spark.createDataFrame([(0, 0, 1, 0.0, 0.0, 0.0, False)], "t long, ant1 long, ant2 long, u double, v double, w double, flag boolean")
    with pytest.raises(Exception, match="zero uvw"):
        flag.shadowed_antennas(rows, ["t"], 12.0).collect()


# ---------------------------------------------------------------- order statistics and scans

@pytest.mark.parametrize("seed", range(3))
def test_select_ranks_matches_sort(spark, seed):
    rng = random.Random(seed)
    # one key holds most of the rows, with many equal values
    rows = [(0 if rng.random() < 0.7 else rng.randrange(1, 5), rng.choice([rng.gauss(0, 1e3), rng.gauss(0, 1e-3), 0.0, 7.0, -7.0])) for _ in range(4000)]
    d = spark.createDataFrame(rows, "k long, v double")
    got = {r["k"]: r for r in order.select_ranks(order.value_counts(d, ["k"], "v"), ["k"], order.QUARTILES).collect()}
    for k in got:
        s = sorted(v for kk, v in rows if kk == k)
        assert [got[k]["q1"], got[k]["q2"], got[k]["q3"]] == [s[len(s) // 4], s[len(s) // 2], s[3 * len(s) // 4]]


def test_madfm_and_quantiles(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(5, 2, 501)
    d = spark.createDataFrame([(0, float(x)) for x in v], "k long, v double")
    m = order.grouped_madfm(d, ["k"], "v").first()
    assert m["median"] == pytest.approx(np.median(v)) and m["madfm"] == pytest.approx(np.median(np.abs(v - np.median(v))))
    q = order.grouped_quantiles(d, ["k"], "v", {"p": 0.01}).first()
    assert q["p"] == pytest.approx(np.percentile(v, 1))


def test_runs_do_not_depend_on_buckets(spark):
    rows = [(i, (i // 3) % 2) for i in range(40)]
    d = spark.createDataFrame(rows, "t long, s long")
    want = [(i, i // 3 + 1) for i in range(40)]
    for width in (1, 4, 7, 1000):
        got = prefix.runs(d, [], "t", F.floor(F.col("t") / width), ["s"]).select("t", "run").orderBy("t").collect()
        assert [tuple(r) for r in got] == want


def test_interval_starts(spark):
    rng = random.Random(3)
    times = sorted(rng.uniform(0, 500) for _ in range(120))
    starts, last = [], None
    for t in times:
        if last is None or t - last >= 20:
            starts.append(t)
            last = t
    d = spark.createDataFrame([(t,) for t in times], "t double")
    got = sorted(r["start"] for r in summary.interval_starts(d, "t", 20.0).collect())
    assert got == starts


def test_interval_starts_in_crowded_bins(spark, monkeypatch):
    """A frame that reaches to the end of its bin is read anew for every row, so a bin cost its square."""
    plans, cut = [], summary.cut_lineage
    monkeypatch.setattr(summary, "cut_lineage", lambda d: plans.append(d._jdf.queryExecution().toString()) or cut(d))
    times = [0.0, 0.5, 1.0, 20.0, 20.5, 41.0, 41.0, 130.0, 149.9, 150.0, 90000.0]
    d = spark.createDataFrame([(t,) for t in times], "t double")
    assert sorted(r["start"] for r in summary.interval_starts(d, "t", 20.0).collect()) == [0.0, 20.0, 41.0, 130.0, 150.0, 90000.0]
    assert any("Window" in p for p in plans) and not any("unboundedfollowing" in p.lower() for p in plans)


# ---------------------------------------------------------------- sky

def test_healpix_round_trip(spark):
    for nside in (1, 8, 64):
        d = spark.range(12 * nside * nside).withColumn("c", hp.pix2ang_nest(nside, F.col("id")))
        assert d.where(hp.ang2pix_nest(nside, F.col("c.ra"), F.col("c.dec")) != F.col("id")).count() == 0


def test_healpix_known_base_pixels(spark):
    d = spark.createDataFrame([(45.0, 60.0, 0), (0.0, 0.0, 4), (45.0, -60.0, 8), (315.0, 60.0, 3)], "ra double, dec double, p long")
    assert all(r[0] == r[1] for r in d.select(hp.ang2pix_nest(1, F.col("ra"), F.col("dec")), "p").collect())


@pytest.mark.parametrize("ra,dec,radius", [(70.2, -61.8, 1.0), (0.3, 5.0, 4.0), (120.0, 89.5, 2.0), (200.0, -40.0, 15.0)])
def test_cone_is_complete_and_near(spark, ra, dec, radius):
    rng = random.Random(5)
    pts = [(rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(4000)]
    pts += [((ra + rng.uniform(-2, 2)) % 360, max(-90.0, min(90.0, dec + rng.uniform(-2, 2)))) for _ in range(500)]
    d = skymodel.index_components(spark.createDataFrame(pts, "ra_deg double, dec_deg double"))
    sep = sky.separation_deg(F.col("ra_deg"), F.col("dec_deg"), F.lit(ra), F.lit(dec))
    want = d.where(sep <= radius).count()
    loose = skymodel.cone_search(d, ra, dec, radius)
    assert skymodel.cone_search(d, ra, dec, radius, exact=True).count() == want
    assert loose.where(sep <= radius).count() == want
    assert loose.where(sep > radius + 2 * hp.max_pixel_radius_deg(1024)).count() == 0


def test_index_ranges():
    assert hp.index_ranges([3, 4, 9], 512) == [(12, 19), (36, 39)]
    assert hp.index_ranges([], 8) == []
    many = hp.index_ranges([*range(0, 400, 2), 700], 8)
    assert len(many) == hp.RANGES and many[-1] == (700 << 14, (701 << 14) - 1)
    assert all(any(lo <= p << 14 and ((p + 1) << 14) - 1 <= hi for lo, hi in many) for p in [*range(0, 400, 2), 700])


def test_search_reaches_the_scan(spark, tmp_path):
    rng = random.Random(6)
    pts = [(rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(2000)]
    d = skymodel.index_components(spark.createDataFrame(pts, "ra_deg double, dec_deg double"))
    d.sort("healpix_index").write.parquet(str(tmp_path / "sky"))
    found = skymodel.cone_search(spark.read.parquet(str(tmp_path / "sky")), 70.0, -60.0, 8.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "Join" not in plan
    assert sorted(found.collect()) == sorted(skymodel.cone_search(d, 70.0, -60.0, 8.0).collect())


def test_rect_wraps(spark):
    pts = [(359.5, 0.2), (0.5, -0.2), (3.0, 0.0), (180.0, 0.0)]
    d = skymodel.index_components(spark.createDataFrame(pts, "ra_deg double, dec_deg double"))
    assert {round(r["ra_deg"], 1) for r in skymodel.rect_search(d, 0.0, 0.0, 2.0, 1.0).collect()} == {359.5, 0.5}
    assert sky.rect_corners(0.0, 0.0, 2.0, 1.0)[0] == (359.0, 0.5)


def test_sexagesimal(spark):
    d = spark.createDataFrame([("-00:30:00",), ("12:59:59.99",), ("5h30m00s",)], "t string").select(sky.sexagesimal_to_deg(F.col("t")).alias("d"))
    assert [r["d"] for r in d.collect()] == [-0.5, pytest.approx(12.999997, abs=1e-6), 5.5]
    e = spark.createDataFrame([(-0.999999999,), (59.9999999,)], "d double").select(sky.deg_to_sexagesimal(F.col("d"), 1).alias("t"))
    assert [r["t"] for r in e.collect()] == ["-01:00:00.0", "+60:00:00.0"]


def test_text_catalogue(spark):
    s = {"ra": (3, "deg"), "dec": (4, "deg"), "pos_ang": (5, "rad"), "maj_axis": (6, "arcsec"), "min_axis": (7, "arcsec"), "flux": (10, "Jy")}
    lines = spark.createDataFrame([("0 0 0 187.5 -45.0 0.5 10 20 0 0 1e-3",), ("bad line",), ("# comment",)], "value string")
    good, bad = catalogue.parse_text(lines, s, 11)
    r = good.first()
    assert (r["maj_axis"], r["min_axis"]) == (20.0, 10.0) and r["pos_ang"] == pytest.approx(math.degrees(0.5))
    assert bad.count() == 1


def test_criteria_negative_is_unset(spark):
    d = spark.createDataFrame([(1.0, -0.5), (5.0, 0.5)], "flux_int double, spectral_index double")
    assert d.where(select.criteria({"flux_int": (-1.0, -1.0)})).count() == 2
    assert d.where(select.criteria({"spectral_index": (-1.0, 0.0)})).count() == 1


# ---------------------------------------------------------------- matching

def _greedy(src, ref, eps):
    used, out = set(), set()
    for s in sorted(src, key=lambda p: (p[3], p[0])):
        for r in sorted(ref, key=lambda p: (p[3], p[0])):
            if r[0] not in used and math.hypot(s[1] - r[1], s[2] - r[2]) < eps:
                used.add(r[0])
                out.add((s[0], r[0]))
                break
    return out


@pytest.mark.parametrize("seed", range(2))
def test_greedy_match(spark, seed):
    rng = random.Random(seed)
    cloud = lambda n: [(i, round(rng.uniform(0, 4), 2), round(rng.uniform(0, 4), 2), rng.randrange(30) / 4) for i in range(n)]
    crowd = lambda n, k: [(k + i, 2.0, 2.0, rng.randrange(5) / 1.0) for i in range(n)]  # a third are copies at one place
    src, ref = cloud(60) + crowd(30, 1000), cloud(60) + crowd(25, 2000)
    schema = "id long, x double, y double, flux double"
    got = match.greedy_match(spark.createDataFrame(src, schema), spark.createDataFrame(ref, schema), 0.4)
    assert {tuple(r) for r in got.select("src_id", "ref_id").collect()} == _greedy(src, ref, 0.4)


@pytest.mark.parametrize("rows, radii", [(40, 4), (10**6, 4)])
def test_greedy_match_across_tiles(spark, monkeypatch, rows, radii):
    """Small tiles, and tiles too full for a task, whose queues are matched in runs."""
    monkeypatch.setattr(match, "TILE_ROWS", rows)
    monkeypatch.setattr(match, "TILE_RADII", radii)
    rng = random.Random(radii)
    cloud = lambda n: [(i, round(rng.uniform(0, 3), 1), round(rng.uniform(0, 3), 1), rng.randrange(20) / 4) for i in range(n)]
    src, ref = cloud(70) + [(100 + i, 1.0, 1.0, i / 4) for i in range(20)], cloud(70) + [(100 + i, 1.1, 1.0, i / 3) for i in range(20)]
    schema = "id long, x double, y double, flux double"
    got = match.greedy_match(spark.createDataFrame(src, schema), spark.createDataFrame(ref, schema), 0.25)
    assert sorted(tuple(r) for r in got.select("src_id", "ref_id").collect()) == sorted(_greedy(src, ref, 0.25))


def test_greedy_match_of_a_chain_in_few_rounds(spark, monkeypatch):
    """Each source must wait for the one before it; a round for every link made crowded fields slow."""
    made, cut = [], match.cut_lineage
    monkeypatch.setattr(match, "cut_lineage", lambda d: made.append(1) or cut(d))
    schema = "id long, x double, y double, flux double"
    src = spark.createDataFrame([(i, 0.3 * i, 0.0, 1.0 + i) for i in range(24)], schema)
    ref = spark.createDataFrame([(i, 0.3 * i + 0.15, 0.0, 1.0 + i) for i in range(24)], schema)
    got = match.greedy_match(src, ref, 0.2)
    assert sorted(tuple(r) for r in got.collect()) == [(i, i) for i in range(24)]
    assert len(made) < 40


def test_triangle_scale_invariant(spark):
    pts = [(0, 0.0, 0.0, 3.0), (1, 3.0, 0.0, 2.0), (2, 0.0, 4.0, 1.0)]
    t = match.triangles(spark.createDataFrame(pts, "id long, x double, y double, flux double"), 3, 0.01).first()
    assert t["ratio"] == pytest.approx(5 / 3) and t["log_perimeter"] == pytest.approx(math.log10(12)) and t["a"] == 1


# ---------------------------------------------------------------- images

def ramp(spark, n=8):
    return spark.createDataFrame([(0, x, y, float(1 + x + n * y)) for x in range(n) for y in range(n)], "image_id long, x long, y long, value double")


@pytest.mark.parametrize("robust", [False, True])
def test_ramp_box(spark, robust):
    for r in image.sliding_stats(ramp(spark), ["image_id"], 1, (8, 8), robust).collect():
        inside = 0 < r["x"] < 7 and 0 < r["y"] < 7
        assert r["middle"] == pytest.approx(r["value"] if inside else 0.0)
        if inside and robust:
            assert r["spread"] == pytest.approx(7.0 / 0.6744888)


def test_masked_box(spark):
    d = ramp(spark).withColumn("valid", ~((F.col("x") == 3) & (F.col("y") == 3)))
    r = image.sliding_stats(d, ["image_id"], 1, (8, 8), False).where("x = 2 AND y = 2").first()
    vals = [1 + x + 8 * y for x in (1, 2, 3) for y in (1, 2, 3) if (x, y) != (3, 3)]
    assert r["middle"] == pytest.approx(statistics.mean(vals)) and r["spread"] == pytest.approx(statistics.stdev(vals))


@pytest.mark.parametrize("robust", [False, True])
def test_box_with_missing_pixels(spark, robust):
    rng = random.Random(11)
    pix = {(x, y): rng.random() for x in range(9) for y in range(9) if rng.random() < 0.5}
    d = spark.createDataFrame([(0, x, y, v) for (x, y), v in pix.items()], "image_id long, x long, y long, value double")
    for r in image.sliding_stats(d, ["image_id"], 1, (9, 9), robust).collect():
        if 0 < r["x"] < 8 and 0 < r["y"] < 8:
            box = [v for (x, y), v in pix.items() if abs(x - r["x"]) <= 1 and abs(y - r["y"]) <= 1]
            assert r["middle"] == pytest.approx(statistics.median(box) if robust else statistics.mean(box))


def test_box_spread_on_a_high_level(spark):
    rng = random.Random(12)
    pix = [(k, x, y, 1e8 * k + rng.random()) for k in (0, 1) for x in range(6) for y in range(6)]
    d = spark.createDataFrame(pix, "image_id long, x long, y long, value double")
    for r in image.sliding_stats(d, ["image_id"], 1, (6, 6), False).where("x BETWEEN 1 AND 4 AND y BETWEEN 1 AND 4").collect():
        box = [v for k, x, y, v in pix if k == r["image_id"] and abs(x - r["x"]) <= 1 and abs(y - r["y"]) <= 1]
        assert r["spread"] == pytest.approx(statistics.stdev(box), rel=1e-6) and r["middle"] == pytest.approx(statistics.mean(box), rel=1e-12)


def test_mosaic_of_one_image_is_the_image(spark):
    d = ramp(spark).withColumn("weight", F.lit(2.0)).withColumn("pb", F.lit(0.8))
    m = image.deweight(image.mosaic(image.weigh(d, "combined", "corrected"), ["x", "y"], 0.1, "combined"))
    assert m.join(d.select("x", "y", F.col("value").alias("v")), ["x", "y"]).where(F.abs(F.col("v") - F.col("value")) > 1e-9).count() == 0


@pytest.mark.parametrize("tile,reach", [(4, 1), (8, 1), (64, 1), (5, 2)])
def test_components_do_not_depend_on_tiles(spark, tile, reach):
    rng = random.Random(7)
    pts = {(x, y) for x in range(24) for y in range(24) if rng.random() < 0.3}
    pts |= {(x, 12) for x in range(24)}
    label, want = {}, {}
    for p in sorted(pts, key=lambda q: (q[1], q[0])):
        if p in label:
            continue
        stack, root = [p], p[1] * detect.ROW + p[0]
        label[p] = root
        while stack:
            x, y = stack.pop()
            for dx in range(-reach, reach + 1):
                for dy in range(-reach, reach + 1):
                    q = (x + dx, y + dy)
                    if q in pts and q not in label:
                        label[q] = root
                        stack.append(q)
    d = spark.createDataFrame([(0, x, y) for x, y in pts], "image_id long, x long, y long")
    got = {(r["x"], r["y"]): r["obj_id"] for r in detect.label_objects(d, reach, tile).collect()}
    assert got == label


def _grown(points, reach, chan_reach):
    """Objects by growing from every point."""
    label = {}
    for p in sorted(points, key=lambda q: (q[2], q[1], q[0])):
        stack, root = ([p], (p[2] * detect.ROW + p[1]) * detect.ROW + p[0]) if p not in label else ([], 0)
        label.setdefault(p, root)
        while stack:
            x, y, c = stack.pop()
            near = [q for q in points if q not in label and abs(q[0] - x) <= reach and abs(q[1] - y) <= reach and abs(q[2] - c) <= chan_reach]
            label.update((q, root) for q in near)
            stack += near
    return label


@pytest.mark.parametrize("tile,chan_tile,reach,chan_reach,share", [(4, 3, 1, 1, 0.12), (16, 16, 1, 1, 0.12), (5, 7, 3, 7, 0.01), (6, 2, 2, 0, 0.05), (3, 8, 3, 1, 0.02)])
def test_objects_on_three_axes(spark, tile, chan_tile, reach, chan_reach, share):
    """Any tiling gives the objects of plain growth, also a thread that winds through many tiles."""
    rng = random.Random(tile)
    points = {(x, y, c) for x in range(13) for y in range(13) for c in range(11) if rng.random() < share} | {(i, 12 - i, min(i, 10)) for i in range(13)}
    d = spark.createDataFrame([(5, *p) for p in points], "image_id long, x long, y long, chan int")
    got = {(r["x"], r["y"], r["chan"]): r["obj_id"] for r in detect.label_objects(d, reach, tile, "chan", chan_reach, chan_tile).collect()}
    assert got == _grown(points, reach, chan_reach)


def test_runs_of_a_tile():
    """Label of a tile against growth, with negative places and rows at the edge of the box."""
    rng = random.Random(3)
    for reach, chan_reach in ((1, 0), (1, 1), (2, 3), (4, 1)):
        for _ in range(30):
            points = sorted({(rng.randrange(-9, 9), rng.randrange(-5, 5), rng.randrange(-4, 4)) for _ in range(rng.randrange(1, 60))})
            x, y, c = (np.array(v) for v in zip(*points))
            root = detect.label_tile(x, y, c, reach, chan_reach)
            want = _grown(points, reach, chan_reach)
            assert {p: points[r] for p, r in zip(points, root)} == {p: min((q for q in points if want[q] == want[p]), key=lambda q: (q[2], q[1], q[0])) for p in points}


def test_object_limits(spark):
    line = [(0, x, 0, c, 1) for x in range(2) for c in range(3)] + [(0, x, 5, 0, 2) for x in range(9)] + [(0, 9, 9, c, 3) for c in range(9)]
    d = spark.createDataFrame(line, "image_id long, x long, y long, chan long, obj_id long")
    kept = lambda **k: sorted({r["obj_id"] for r in detect.keep_objects(d, **k).collect()})
    assert kept() == [1] and kept(min_pix=1, min_chan=1) == [1, 2, 3] and kept(min_pix=1, min_chan=1, max_chan=3) == [1, 2]
    assert kept(min_pix=1, min_chan=1, min_vox=7) == [2, 3] and kept(min_pix=1, min_chan=1, max_pix=2, max_vox=8) == [1]


def test_z_values(spark):
    """Against the standard library, to the far tails; nothing outside (0, 1)."""
    ps = [1e-300, 1e-20, 1e-7, 0.001, 0.02275, 0.1, 0.4999, 0.5, 0.7, 0.999999, 1.0 - 1e-12]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(spectral.normal_z_value(F.col("p"))).collect()]
    for p, z in zip(ps, got):
        assert z == pytest.approx(-statistics.NormalDist().inv_cdf(p), abs=1e-9, rel=1e-9)
    assert [r[0] for r in spark.createDataFrame([(0.0,), (1.0,), (-1.0,), (None,)], "p double").select(spectral.normal_z_value(F.col("p"))).collect()] == [None] * 4


def test_velocity_selector(spark):
    d = select.velocities(spec(spark, range(54)), -500.0, 1200.0, 1420.405752, 1400.0, 0.5).first()
    want = [i for i in range(54) if -500.0 <= 299792.458 * (1 - (1400.0 + i * 0.5) / 1420.405752) <= 1200.0]
    assert d["re"] == [float(i) for i in want] and d["first_chan"] == want[0]


# ---------------------------------------------------------------- scan inventory

@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_scans_restart_at_the_next_cycle(spark, chunk):
    """Any chunk length gives the scans of a plain walk: limits, pointings that drift or jump back, gaps, a cycle without a direction."""
    rng = random.Random(5)
    rows, t = [], 0.0
    for beam in range(3):
        ra = 20.0
        for c in range(60):
            t += rng.choice([0.5, 1.0, 3.0])
            ra = 20.0 if rng.random() < 0.2 else ra + rng.choice([0, 0, 2e-6, -2e-6])
            if rng.random() > 0.05:
                rows.append((beam, c, "f", c // 25, 0, t, ra if (beam, c) != (1, 30) else float("nan"), 60.0))
    want, last = [], None
    for beam, c, _, scan, _, t, ra, _ in rows:
        apart = 2 * math.asin(min(1.0, math.cos(math.radians(60)) * abs(math.sin(math.radians(ra - last[4]) / 2)))) if last and not math.isnan(ra) and not math.isnan(last[4]) else 1.0
        go_on = last and last[0] == beam and c == last[1] + 1 and scan == last[5] and c - last[2] < 9 and t - last[3] < 12.0 and apart < 1e-7
        if go_on:
            want[-1][2], want[-1][3] = c, want[-1][3] + 1
            last = (beam, c, *last[2:])
        else:
            want.append([beam, c, c, 1])
            last = (beam, c, c, t, ra, scan)
    df = spark.createDataFrame(rows, "beam long, cycle long, name string, scan long, field long, t double, ra double, dec double")
    got = summary.scan_inventory(df, 9, time_limit=12.0, time="t", chunk=chunk).collect()
    assert sorted([r["beam"], r["start_cycle"], r["end_cycle"], r["n_cycles"]] for r in got) == want


# ---------------------------------------------------------------- data sources

def _votable(tmp_path, name, fields, rows):
    head = "".join(f'<FIELD name="{n}" ucd="{u}" unit="{q}" datatype="{t}"/>' for n, u, q, t in fields)
    body = "".join("<TR>" + "".join(f"<TD>{c}</TD>" if c is not None else "<TD/>" for c in r) + "</TR>\n" for r in rows)
    (tmp_path / name).write_text(f'<?xml version="1.0"?>\n<VOTABLE xmlns="http://www.ivoa.net/xml/VOTable/v1.3"><RESOURCE><TABLE>{head}<DATA><TABLEDATA>\n{body}</TABLEDATA></DATA></TABLE></RESOURCE></VOTABLE>')
    return str(tmp_path / name)


ID, RA = ("a", "META.ID;META.MAIN", "none", "char"), ("b", "pos.eq.ra;meta.main", "deg", "double")


@pytest.mark.parametrize("step", [1, 7, 100, 1 << 20])
def test_votable_rows_belong_to_one_range(spark, tmp_path, step):
    rows = [(f"id &amp; {i}", i / 8) for i in range(60)] + [("", None)]
    path = _votable(tmp_path, "t.xml", [ID, RA], rows)
    if step == 1:
        path = _votable(tmp_path, "t.xml", [ID, RA], rows[:3] + rows[-1:])
        rows = rows[:3] + rows[-1:]
    got = votable.read(spark, path, step=str(step)).collect()
    assert sorted((r["component_id"], r["ra"]) for r in got if r["ra"] is not None) == sorted((a.replace("&amp;", "&"), b) for a, b in rows if b is not None)
    assert len(got) == len(rows)


def test_votable_orders_units_and_unknown_fields(spark, tmp_path):
    (tmp_path / "d").mkdir()
    _votable(tmp_path / "d", "1.xml", [ID, RA, ("flag", "", "", "boolean"), ("n", "x.y", "furlong", "int")], [("p", 90.0, "T", 3)])
    _votable(tmp_path / "d", "2.xml", [("n", "x.y", "", "int"), ("r", RA[1], "rad", "float"), ID], [(None, math.pi, "q")])
    df = votable.read(spark, str(tmp_path / "d"))
    assert dict(df.dtypes) == {"component_id": "string", "ra": "double", "flag": "boolean", "n": "int"}
    assert sorted(tuple(r) for r in df.select("component_id", F.round("ra", 4), "flag", "n").collect()) == [("p", 90.0, True, 3), ("q", 180.0, None, None)]


@pytest.mark.parametrize("field,message", [(("b", "pos.eq.ra;meta.main", "Jy", "double"), "unit 'Jy'"), (("b", "", "", "blob"), "unknown datatype")])
def test_votable_errors(spark, tmp_path, field, message):
    with pytest.raises(Exception, match=message):
        votable.read(spark, _votable(tmp_path, "e.xml", [ID, field], [("x", 1)])).collect()


def test_datagram_offsets(spark, tmp_path):
    """A file that grows, a record that is half written, a second file: every record comes once."""
    kind = datagrams.layout(3)
    rec = np.zeros(10, kind)
    rec["timestamp"], rec["baseline1"], rec["baseline2"], rec["freq"] = np.arange(10), 4, 5, 700.5
    rec["vis"][:, 0], rec["vis"][:, 1], rec["vis"][:, 2] = (1.5, -2.0), (np.nan, np.nan), (9.0, 9.0)
    raw, folder, out, ckpt = rec.tobytes(), tmp_path / "in", shared_path(spark, "sink"), shared_path(spark, "ckpt")
    folder.mkdir()
    seen = []
    for name, data in (("x.dat", raw[: 4 * kind.itemsize + 11]), ("x.dat", raw[: 7 * kind.itemsize]), ("y.dat", raw[7 * kind.itemsize :])):
        (folder / name).write_bytes(data)
        s = datagrams.stream(spark, str(folder), 3, 2)
        s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
        seen.append(sorted(r["timestamp"] for r in spark.read.parquet(out).collect()))
    assert seen == [list(range(4)), list(range(7)), list(range(10))]
    rows = datagrams.unpack(spark.read.parquet(out)).collect()
    assert len(rows) == 10 and {(r["baseline"], r["re"], r["im"], r["freq"]) for r in rows} == {(4, 1.5, -2.0, 700.5)}


def test_failed_attempt_is_not_read(spark, tmp_path):
    """Rows written without a manifest do not count; a repeated batch and a repeated micro-batch add nothing; damage is seen."""
    path = str(tmp_path / "t")
    d = spark.range(10).withColumn("k", F.col("id") % 3)
    d.write.partitionBy("k").parquet(f"{path}/data/b1-failed")
    with pytest.raises(ValueError):
        publish.published(spark, path)
    first = publish.publish(d, path, "b1", {"sb": 1}, ["k"])
    assert publish.publish(d.limit(3), path, "b1", partition_by=["k"]) == first and first["rows"] == 10 and first["about"] == {"sb": 1}
    publish.publish(d.withColumn("id", F.col("id") + 10), path, "b2", partition_by=["k"])
    rows = publish.published(spark, path)
    assert sorted((r["id"], r["k"]) for r in rows.collect()) == sorted((i, i % 10 % 3) for i in range(20))
    assert publish.published(spark, path, ["b2"]).count() == 10 and publish.damaged(spark, path) == []
    victim = next((tmp_path / "t" / first["folder"]).rglob("*.parquet"))
    victim.write_bytes(victim.read_bytes() + b"x")
    victim.with_name(f".{victim.name}.crc").unlink()  # the local file system's own check
    assert publish.damaged(spark, path) == [str(victim.relative_to(tmp_path / "t" / first["folder"]))]


def test_micro_batch_that_comes_again(spark, tmp_path):
    path = str(tmp_path / "t")
    s = lambda: _arrive(spark, [[(0, 1, i)] for i in range(3)], GRAMS)
    for ckpt in ("a", "b"):  # the second query has lost its checkpoint and sends all batches again
        publish.publish_batches(s(), path, str(tmp_path / ckpt), "grams").awaitTermination()
    assert sorted(r["item"] for r in publish.published(spark, path).collect()) == [0, 1, 2]


def test_ingest_twice(spark, tmp_path):
    c = spark.createDataFrame([("a", 1.0, 2.0), ("b", 200.0, -40.0)], "component_id string, ra double, dec double")
    path = str(tmp_path / "m")
    first = sorted(map(tuple, catalogue.ingest(c, path, 7).collect()))
    assert sorted(map(tuple, catalogue.ingest(c.union(c), path, 7).collect())) == first and catalogue.model(spark, path).count() == 2
    with pytest.raises(ValueError, match="one name"):
        catalogue.ingest(c.union(c), path, 8, retries=2)
    assert len({r[0] for r in catalogue.ingest(c, path, 9).collect()} | {r[0] for r in first}) == 4


def test_deposit_rules(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "i"))
    with pytest.raises(ValueError, match="no artefacts"):
        publish.deposit(spark, str(tmp_path / "o"), 1, {"evaluation": [str(tmp_path / "i")]})
    with pytest.raises(ValueError, match="time range"):
        publish.deposit(spark, str(tmp_path / "o"), 1, {"image": [str(tmp_path / "i")]})
    m = publish.deposit(spark, str(tmp_path / "o"), 1, {"image": [str(tmp_path / "i")]}, obs_start="a", obs_end="b")
    files = sorted(p.name for p in (tmp_path / "i").glob("*.parquet"))
    assert [f["name"] for f in m["artefacts"][0]["files"]] == files and (tmp_path / "o" / "1" / "READY").exists() and (tmp_path / "o" / "1" / "observation.json.checksum").exists()


# ---------------------------------------------------------------- streams with timers

EPOCH = 1_500_000_000_000


def _arrive(spark, batches, schema):
    """A stream that reads one batch a trigger."""
    path = shared_path(spark, "arrive")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


GRAMS, META = "stream long, t_ms long, item long", "stream long, t_ms long, scan_id long"


def test_merge_rules(spark):
    """Mistimed, skipped, idle and incomplete cycles, data before and after, a late file, an end scan."""
    v = _arrive(spark, [[(0, 1000, 0), (0, 1000, 1), (0, 2100, 0), (1, 3000, 7)], [(0, 2100, 1), (0, 2200, 9), (0, 4000, 0)], [(0, 9000, 1), (0, 10000, 3)], [(0, 1000, 5), (0, 12000, 1)]], GRAMS)
    m = _arrive(spark, [[(0, 1000, 3), (0, 2000, 3), (0, 3000, 3), (1, 3000, 0)], [(0, 4000, -1), (0, 5000, 4)], [(0, 9000, 4), (0, 10000, -2)], [(0, 11000, 4), (0, 20000, -1)]], META)
    out = sinks.drain(cycles.merged_cycles(v, m, 1000, 100, EPOCH), timers=True).collect()
    got = {(r["stream"], r["meta_ms"]): (r["t_ms"], r["scan_id"], r["flag"], list(r["received"])) for r in out}
    assert len(out) == len(got) and got == {
        (0, 1000): (1000, 3, False, [0, 1]), (0, 2000): (2100, 3, True, [0, 1]), (0, 3000): (None, 3, False, []), (0, 5000): (None, 4, False, []),
        (0, 9000): (9000, 4, False, [1]), (1, 3000): (3000, 0, False, [7])}


@pytest.mark.parametrize("records,message", [([[(0, 1000, 3), (0, 1000, 3)]], "two cycles of time 1000"), ([[(0, 1000, -7)]], "unexpected scan id -7")])
def test_merge_errors(spark, records, message):
    v = _arrive(spark, [[(0, 1000, 0)]], GRAMS)
    with pytest.raises(Exception, match=message):
        sinks.drain(cycles.merged_cycles(v, _arrive(spark, records, META), 1000, 100, EPOCH), timers=True)


def test_expected_grid(spark):
    m = spark.createDataFrame([(0, 1000, False, [0, 2]), (0, 2000, True, [1]), (1, 1000, False, [])], "stream long, meta_ms long, flag boolean, received array<long>")
    got = {(r["stream"], r["meta_ms"], r["item"]): (r["missing"], r["flag"]) for r in cycles.expected_grid(m, 3).collect()}
    assert got == {(s, t, i): (i not in have, i not in have or bad) for s, t, bad, have in ((0, 1000, False, (0, 2)), (0, 2000, True, (1,)), (1, 1000, False, ())) for i in range(3)}


def test_chunks_and_votes_over_triggers(spark):
    """The rows do not depend on how the data is cut into triggers."""
    grams = [(s, t, i) for t in range(0, 9000, 700) for s in (0, 1) for i in range(3)] + [(0, 30_000, 0)]
    parts = [(c, s, c * 1000 + (s == c % 3)) for c in range(9) for s in range(3 - (c == 4))] + [(40, 0, 40_000)]
    seen = []
    for step in (5, 1000):
        cut = lambda rows: [rows[i : i + step * 4] for i in range(0, len(rows), step * 4)]  # noqa: E731, B023
        a = sinks.drain(cycles.chunks(_arrive(spark, cut(grams), GRAMS), 100, EPOCH), timers=True)
        b = sinks.drain(cycles.merged_channels(_arrive(spark, cut(parts), "cycle long, stream long, t_ms long"), 3, 100, EPOCH), timers=True)
        seen.append((sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))))
    assert seen[0] == seen[1]
    assert seen[0][0] == sorted((s, t, 3, 3) for t in range(0, 9000, 700) for s in (0, 1))
    assert set(seen[0][1]) == {(c, s, c * 1000, 1, t != c * 1000) for c, s, t in parts if c < 40}  # a tie goes to the first stream


def test_latest_point_is_invalidated(spark):
    rows = [[("a", 1, 1.0), ("b", 1, 2.0)], [("a", 3, None), ("b", 0, 9.0)], [("a", 2, 5.0)]]
    last = merge.latest_points(_arrive(spark, rows, "point string, ts long, value double"), ["point"])
    assert {(r["point"], r["last"]["value"]) for r in sinks.drain_updates(last, ["point"]).collect()} == {("a", None), ("b", 2.0)}


# ---------------------------------------------------------------- calibration and prediction

def _four_pols(spark, v, extra):
    names = [f"{p}_{c}" for p in calibrate.POLS for c in ("re", "im")]
    return spark.createDataFrame([tuple(v) + (False,) + tuple(extra.values())], ", ".join(f"{n} double" for n in names) + ", flag boolean, " + ", ".join(f"{n} double" for n in extra))


def test_apply_inverts_corruption(spark):
    rng = np.random.default_rng(2)
    terms = {f"{n}_{c}_{s}": float(rng.normal(1.0 if n in ("g1", "g2") else 0.1, 0.2)) for s in "12" for n in ("g1", "g2", "d12", "d21") for c in ("re", "im")}
    z = lambda n, s: terms[f"{n}_re_{s}"] + 1j * terms[f"{n}_im_{s}"]
    J = {s: np.array([[z("g1", s), z("d12", s) * z("g1", s)], [-z("d21", s) * z("g2", s), z("g2", s)]]) for s in "12"}
    true = rng.normal(size=(2, 2)) + 1j * rng.normal(size=(2, 2))
    seen = (J["1"] @ true @ J["2"].conj().T).ravel()
    d = _four_pols(spark, [x for c in seen for x in (float(c.real), float(c.imag))], terms)
    r = calibrate.apply_jones(d, F.lit(True)).first()
    got = [r[f"{p}_re"] + 1j * r[f"{p}_im"] for p in calibrate.POLS]
    assert np.allclose(got, true.ravel())
    bad = calibrate.apply_jones(d, F.lit(False)).first()
    assert bad["flag"] and bad["xx_re"] == 0.0
    with pytest.raises(Exception, match="not allowed"):
        calibrate.apply_jones(d, F.lit(False), flag_allowed=False).collect()


def test_solve_recovers_gains(spark):
    rng = np.random.default_rng(4)
    g = rng.normal(1, 0.2, 6) + 1j * rng.normal(0, 0.3, 6)
    rows = [(0, a, b, float((g[a] * g[b].conj()).real), float((g[a] * g[b].conj()).imag), 1.0) for a in range(6) for b in range(a + 1, 6)]
    d = spark.createDataFrame(rows, "beam long, ant1 long, ant2 long, xr double, xi double, mm double")
    got = {r["ant"]: r["g_re"] + 1j * r["g_im"] for r in calibrate.solve_groups(d, ["beam"]).collect()}
    want = g * (g[0].conj() / abs(g[0]))
    assert max(abs(got[a] - want[a]) for a in range(6)) < 0.03


def test_predict_blocks_agree(spark):
    rng = random.Random(9)
    comps = spark.createDataFrame([(i, 0, rng.uniform(-.05, .05), rng.uniform(-.05, .05), rng.random()) for i in range(40)], "comp_id long, field long, l double, m double, flux double")
    rows = spark.createDataFrame([(i, 0, rng.uniform(-90, 90), rng.uniform(-90, 90), rng.uniform(-9, 9), 9e8) for i in range(10)], "row long, field long, u double, v double, w double, freq double")
    one = predict.predict(rows, predict.pack_components(comps, "field"), ["row"], "field", "freq")
    many = predict.predict(rows, predict.pack_components(comps, "field", size=7), ["row"], "field", "freq")
    a, b = ({r["row"]: (r["model_re"], r["model_im"]) for r in d.collect()} for d in (one, many))
    assert all(a[k] == pytest.approx(b[k]) for k in a)


def test_predict_against_plain_sum(spark, monkeypatch):
    """Several buckets a field, a field of one row, of no components, and null fields."""
    monkeypatch.setattr(predict, "ROWS", 7)
    rng = random.Random(5)
    comps = [(i, i % 2, rng.uniform(-.05, .05), rng.uniform(-.05, .05), rng.random()) for i in range(30)] + [(99, None, .01, .01, 5.0)]
    rows = [(i, rng.choice([0, 0, 0, 1, 4, None]), rng.uniform(-90, 90), rng.uniform(-90, 90), rng.uniform(-9, 9), 9e8, [i]) for i in range(120)]
    c = spark.createDataFrame(comps, "comp_id long, field long, l double, m double, flux double")
    d = spark.createDataFrame(rows, "row long, field long, u double, v double, w double, freq double, tag array<int>")
    got = predict.predict(d, predict.pack_components(c, "field", size=4), ["row"], "field", "freq")
    assert got.columns == [*d.columns, "model_re", "model_im"]
    seen = {r["row"]: r for r in got.collect()}
    assert len(seen) == got.count() == len(rows)
    for i, f, u, v, w, freq, tag in rows:
        want = 0
        for _, cf, l, m, flux in comps:
            if f is not None and cf == f:
                n = math.sqrt(1 - l * l - m * m)
                want += flux / n * np.exp(2j * math.pi * freq * (l * u + m * v + (n - 1) * w) / predict.C_M_S)
        assert seen[i]["model_re"] + 1j * seen[i]["model_im"] == pytest.approx(want, abs=1e-9) and seen[i]["tag"] == tag


def test_predict_without_rows_or_components(spark):
    c = spark.createDataFrame([], "comp_id long, field long, l double, m double, flux double")
    d = spark.createDataFrame([(1, 0, 1.0, 1.0, 1.0, 9e8)], "row long, field long, u double, v double, w double, freq double")
    assert [tuple(r)[-2:] for r in predict.predict(d, predict.pack_components(c, "field"), ["row"], "field", "freq").collect()] == [(0.0, 0.0)]
    assert predict.predict(d.limit(0), predict.pack_components(c, "field"), ["row"], "field", "freq").count() == 0


def test_gain_text_round_trip(spark, tmp_path):
    d = spark.createDataFrame([(1, 2, 1.5, -0.25, True, 0.0, 0.0, False)], "ant long, beam long, g1_re double, g1_im double, g1_valid boolean, g2_re double, g2_im double, g2_valid boolean")
    caltext.write_lines(caltext.gain_lines(d), str(tmp_path / "g"))
    r = caltext.read_lines(spark, str(tmp_path / "g")).collect()
    assert [(x["term"], x["ant"], x["beam"], x["re"], x["im"]) for x in r] == [("g11", 1, 2, 1.5, -0.25)]


def test_as_of_takes_last_before(spark):
    f = spark.createDataFrame([(0, t) for t in range(20)], "k long, t long")
    v = spark.createDataFrame([(0, 3, 1.0), (0, 4, 2.0), (0, 15, 3.0)], "k long, s long, g double")
    got = {r["t"]: r["g"] for r in joins.as_of(f, v, ["k"], "t", "s", 4, ["g"]).collect()}
    assert got == {t: (1.0 if t == 3 else 2.0 if t < 15 else 3.0) for t in range(3, 20)}


# ---------------------------------------------------------------- spectra

def test_delay_of_pure_tone(spark):
    n, res, tau = 64, 1e6, 3e-8
    re, im = ([float(f(2 * math.pi * res * i * tau)) for i in range(n)] for f in (math.cos, math.sin))
    d = spark.createDataFrame([(0, re, im, [False] * n)], "k long, re array<double>, im array<double>, flag array<boolean>")
    assert d.select(spectra.delay_fit(spectra.phases(F.col("re"), F.col("im")), res)).first()[0] == pytest.approx(tau)
    assert spectra.delay_fft(d, ["k"], res).first()["delay"] == pytest.approx(tau, abs=0.5 / (n * res))
    assert spectra.monitor_average(d, ["k"], res).first()["delay"] == pytest.approx(tau)


def test_lags_of_all_lengths(spark):
    """Spectra of mixed lengths, prime ones, single channels, empty and null ones in one batch."""
    rng = np.random.default_rng(1)
    rows = []
    for k, n in enumerate([1, 2, 3, 7, 12, 31, 36, 97, 128, 114 * 144, 0, 12, 7]):
        v = rng.normal(size=n) + 1j * rng.normal(size=n)
        rows.append((k, v.real.tolist(), v.imag.tolist()))
    d = spark.createDataFrame([*rows, (99, None, [1.0])], "k long, re array<double>, im array<double>").coalesce(1)
    got = {r["k"]: r["delay"] for r in spectra.delay_fft(d, ["k"], 1e6).collect()}
    for k, re, im in rows:
        n = len(re)
        lags = [abs(np.dot(np.array(re) + 1j * np.array(im), np.exp(-2j * math.pi * np.arange(n) * (j - n // 2) / n))) for j in range(n)] if n < 200 else \
            np.abs(np.fft.fftshift(np.fft.fft(np.array(re) + 1j * np.array(im))))
        assert got[k] == pytest.approx((int(np.argmax(lags)) - n // 2) / (n * 1e6) if n > 1 else 0.0)
    assert got[99] is None


@pytest.mark.parametrize("rmsf", [False, True])
def test_faraday_sums_and_sources_without_weight(spark, rmsf):
    rng = np.random.default_rng(6)
    lsq = [(299792458.0 / (8e8 + 1e7 * i)) ** 2 for i in range(17)]
    q, u, s = rng.normal(size=17), rng.normal(size=17), rng.uniform(0.1, 1, 17)
    nan = [float("nan")] * 17
    d = spark.createDataFrame([(0, q.tolist(), u.tolist(), s.tolist()), (1, nan, nan, [1.0] * 17), (2, None, u.tolist(), s.tolist())],
                              "k long, q array<double>, u array<double>, noise array<double>")
    out = spectra.rm_synthesis(d, ["k"], lsq, 9, 5.0, "variance", rmsf=rmsf)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["k"]: r for r in out.collect()}
    w = 1 / s ** 2
    l0 = (w * lsq).sum() / w.sum()
    n = 18 if rmsf else 9
    for j, p in enumerate(got[0]["fdf"]):
        phi = -n * 2.5 + 5.0 * j
        want = (w * (1 if rmsf else q + 1j * u) * np.exp(-2j * phi * (np.array(lsq) - l0))).sum() / w.sum()
        assert p["phi"] == phi and p["re"] + 1j * p["im"] == pytest.approx(want, abs=1e-9)
    assert len(got[0]["fdf"]) == n and got[0]["lsq0"] == pytest.approx(l0)
    assert {p["re"] for p in got[1]["fdf"]} == {None} and got[2]["fdf"] is None


@pytest.mark.parametrize("weighting", ["uniform", "variance"])
def test_faraday_thin_source(spark, weighting):
    lsq = [(299792458.0 / (8e8 + 1e7 * i)) ** 2 for i in range(30)]
    q, u = ([float(f(2 * 40.0 * x)) for x in lsq] for f in (math.cos, math.sin))
    d = spark.createDataFrame([(0, q, u, [0.01] * 30), (1, [float("nan")] + q[1:], u, [0.01] * 30)], "k long, q array<double>, u array<double>, noise array<double>")
    fdf = spectra.rm_synthesis(d, ["k"], lsq, 40, 10.0, weighting)
    for p in spectra.faraday_peak(fdf, ["k"], 30.0, 5.0, 6.0, 1.0).collect():
        assert p["detected"] and p["phi_peak"] == 40.0 and p["p_peak"] == pytest.approx(1.0, abs=1e-6) and not p["edge"]


def test_calibrator_range(spark):
    d = spark.createDataFrame([(1400.0,)], "f double")
    assert d.select(spectral.calibrator_1934(F.col("f"))).first()[0] == pytest.approx(14.98, abs=0.2)
    with pytest.raises(Exception, match="valid from"):
        d.select(spectral.calibrator_1934(F.col("f") / 10)).collect()


def test_band_integral_of_power_law(spark):
    d = spark.createDataFrame([(1.0, -0.7), (1.0, -1.0)], "s double, a double")
    got = [r[0] for r in d.select(spectral.power_law_integral(F.col("s"), F.lit(900.0), F.lit(1100.0), F.lit(1000.0), F.col("a"))).collect()]
    x = np.linspace(900, 1100, 20001)
    assert got == [pytest.approx(np.trapezoid((x / 1000) ** a, x), rel=1e-6) for a in (-0.7, -1.0)]


def test_file_name_rules(spark):
    d = spark.createDataFrame([(3, 1)], "b long, f long").withColumn("ts", F.lit("2017-02-03 04:05:06").cast("timestamp"))
    assert d.select(sinks.file_name("a_%d_%t.b%b.c%f.ms", F.col("ts"), F.col("b"), F.col("f"))).first()[0] == "a_2017-02-03_040506.b3.c1.ms"


def test_trim_triangles(spark):
    rng = random.Random(13)
    rows = [(i, rng.random() < 0.8, True, rng.gauss(0, 1) + (8 if i % 9 == 0 else 0), 0.0) for i in range(90)]
    d = spark.createDataFrame(rows, "i long, s_clockwise boolean, r_clockwise boolean, s_log_perimeter double, r_log_perimeter double")
    cur, same, opp = rows, 0, 0
    for _ in range(5):
        if not cur:
            break
        mags = [r[3] - r[4] for r in cur]
        same += sum(r[1] == r[2] for r in cur)
        opp += sum(r[1] != r[2] for r in cur)
        mean = sum(mags) / len(mags)
        rms = math.sqrt(sum(m * m for m in mags) / len(mags) - mean * mean)
        diff = abs(same - opp)
        odds = diff / (same + opp - diff) if same + opp > diff else math.inf
        scale = 1 if odds < 1 else 3 if odds > 10 else 2
        cur = [r for r, m in zip(cur, mags) if abs((m - mean) / rms) < scale]
    same += sum(r[1] == r[2] for r in cur)
    opp += sum(r[1] != r[2] for r in cur)
    want = {r[0] for r in cur if same == opp or (r[1] == r[2]) == (same > opp)}
    assert {r["i"] for r in match.trim_triangles(d).collect()} == want and want


def test_ranks_of_infinite_and_crowded_values(spark):
    rng = random.Random(2)
    values = [1000.0 + rng.random() * 1e-3 for _ in range(900)] + [float("inf")] * 3 + [float("-inf")] * 2
    d = spark.createDataFrame([("a", v) for v in values] + [("b", float("inf"))], "k string, v double")
    got = {r["k"]: r for r in order.grouped_median(order.value_counts(d, ["k"], "v"), ["k"]).collect()}
    s = sorted(values)
    assert got["a"]["median"] == s[len(s) // 2] and got["a"]["n"] == len(s) and got["b"]["median"] == float("inf")


def test_images_are_the_bits_of_doubles(spark):
    rng = np.random.default_rng(3)
    some = np.concatenate([rng.integers(0, 2047 << 52, 5000, dtype=np.int64).view(np.float64), 2.0 ** np.arange(-1074, 1024), np.nextafter(2.0 ** np.arange(-1022, 1024), 0),
                           [0.0, np.inf, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308]])
    d = spark.createDataFrame([(float(s * v),) for v in some for s in (1, -1)], "v double")
    bad = [(r["v"], r["__i"]) for r in order.with_image(d, "v").collect()
           if r["__i"] != int(np.float64(abs(r["v"])).view(np.int64)) * (-1 if r["v"] < 0 else 1)]
    assert not bad


@pytest.mark.parametrize("values", [
    [1e9 + i * 2.0 ** -23 for i in range(3001)],  # neighbouring doubles
    [5e-324 * i for i in range(-50, 52)],  # below the normal range
    [-1.0] * 400 + [float("inf")] * 401, [0.0, -0.0, 0.0], [-3.5]])
def test_ranks_in_narrow_and_extreme_ranges(spark, values):
    d = spark.createDataFrame([(0, v) for v in values] + [(1, float("nan")), (1, None), (2, 1.0)], "k long, v double")
    got = {r["k"]: r for r in order.select_ranks(order.value_counts(d, ["k"], "v"), ["k"], {**order.QUARTILES, **order.MIDDLE}).collect()}
    s, n = sorted(values), len(values)
    assert [got[0][c] for c in ("q1", "q2", "q3", "lo", "hi")] == [s[n // 4], s[n // 2], s[3 * n // 4], s[(n - 1) // 2], s[n // 2]]
    assert got[0]["n"] == n and got[2]["lo"] == 1.0 and 1 not in got


def test_ranks_shuffle_counts_only(spark):
    """Values meet in one plan a pass, after counting in the tasks; nothing is ordered but histograms."""
    d = spark.range(200_000).select((F.col("id") % 2).alias("k"), F.sin("id").alias("v"))
    r = order.grouped_madfm(d, ["k"], "v", {"p": 0.01, "q": 0.99})
    v = np.sin(np.arange(200_000))
    for row in r.collect():
        w = v[row["k"]::2]
        assert row["median"] == pytest.approx(np.median(w), abs=1e-12) and row["madfm"] == pytest.approx(np.median(np.abs(w - np.median(w))), abs=1e-12)
        assert [row["p"], row["q"]] == pytest.approx(list(np.percentile(w, [1, 99])), abs=1e-12)


def test_running_total_over_ranges(spark):
    from fringeframe.functions.prefix import running_total

    d = spark.range(1000).select((F.col("id") % 7).alias("o"), "id", F.lit(2).alias("w"))
    got = running_total(d.repartition(5), ["o", "id"], F.col("w"), "t").orderBy("o", "id").select("t").collect()
    assert [r[0] for r in got] == [2 * (i + 1) for i in range(1000)]


def test_solver_reports_what_it_reached():
    ant1, ant2 = np.array([0, 0, 1]), np.array([1, 2, 2])
    g, converged, steps, residual = calibrate.solve_gains(ant1, ant2, np.ones(3, complex), np.ones(3))
    assert converged and residual <= 1e-10 and steps > 0 and all(abs(abs(v) - 1) < 1e-6 for v in g.values())


def test_phase_reference_without_the_antenna(spark):
    d = spark.createDataFrame([(1, 0, 1.0, 1.0), (2, 2, 0.0, 2.0), (2, 0, 1.0, 0.0)], "cycle long, ant long, g_re double, g_im double")
    got = {(r["cycle"], r["ant"]): r["g_re"] for r in calibrate.phase_reference(d, ["cycle"], 2, strict=False).collect()}
    assert got[(1, 0)] is None and abs(got[(2, 2)] - 2.0) < 1e-12


def test_lookup_join_beyond_the_broadcast_size(spark, monkeypatch):
    facts = spark.range(500).select("id", (F.col("id") % 3).alias("k"), F.lit("x").alias("v"))
    table = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    small = sorted(tuple(r) for r in joins.lookup_join(facts, table, ["k"], "left").select("id", "name").collect())
    monkeypatch.setattr(joins, "SMALL", 0)
    assert sorted(tuple(r) for r in joins.lookup_join(facts, table, ["k"], "left").select("id", "name").collect()) == small


def test_hands_and_determinant(spark):
    """Each product has its own divisor; the determinant of all four is tested, not one of them."""
    cols = "pol string, re double, im double, x1 double, y1 double, x2 double, y2 double"
    zero = F.lit(0.0)
    gains = [(Cx(F.col(f"x{n}"), zero), Cx(F.col(f"y{n}"), zero)) for n in (1, 2)]
    apply = lambda rows: [(r["pol"], r["re"], r["im"]) for r in calibrate.apply_hands(spark.createDataFrame(rows, cols), *gains).collect()]
    assert apply([(p, 60.0, -30.0, 2.0, 3.0, 1.0, 5.0) for p in ("XX", "XY", "YX", "YY")]) == [
        ("XX", 30.0, -15.0), ("XY", 6.0, -3.0), ("YX", 20.0, -10.0), ("YY", 4.0, -2.0)]
    assert apply([("XX", 1.0, 0.0, 1e-6, 1e4, 1.0, 1.0)])[0][1] == pytest.approx(1e6)  # the determinant is 1e-4
    with pytest.raises(Exception, match="too close to zero"):
        apply([("XX", 1.0, 0.0, 1.0, 1e-3, 1.0, 1.0)])  # 1e-6, by the other hand
    with pytest.raises(Exception, match="unknown product"):
        apply([("I", 1.0, 0.0, 1.0, 1.0, 1.0, 1.0)])


def _painted(spark, comps, **more):
    schema = "x0 double, y0 double, flux double, freq0 double, alpha double, major double, minor double, pa double"
    return {(r["x"], r["y"], r["chan"]): r["value"] for r in image.paint_components(spark.createDataFrame(comps, schema), (40, 30), [1.0, 2.0], tile=16, **more).collect()}


def test_painted_components(spark):
    whole = _painted(spark, [(15.7, 15.2, 3.0, 1.0, -1.0, 4.0, 2.0, 0.6)])
    assert sum(v for k, v in whole.items() if k[2] == 0) == pytest.approx(3.0, abs=1e-6)
    assert sum(v for k, v in whole.items() if k[2] == 1) == pytest.approx(1.5, abs=1e-6)
    at = {k[:2]: v for k, v in whole.items() if k[2] == 0}
    assert sum(v * (x - 15.7) * (y - 15.2) for (x, y), v in at.items()) < 0  # the major axis turns from +y towards -x
    line = _painted(spark, [(15.5, 15.0, 2.0, 1.0, None, 3.0, 0.0, 0.5), (15.0, 15.0, 2.0, 1.0, None, 3.0, 0.0, 0.0)])
    assert sum(v for k, v in line.items() if k[2] == 0) == pytest.approx(4.0, abs=1e-6)
    point = _painted(spark, [(3.2, 4.6, 2.0, 1.0, -0.5, 0.0, 0.0, 0.0)], term=2)
    assert point[3, 5, 0] == pytest.approx(2.0 * 0.5 * -0.5 * -1.5) and len(point) == 2
    assert not _painted(spark, [(-0.1, 5.0, 2.0, 1.0, None, 3.0, 1.0, 0.0), (5.0, 29.5, 2.0, 1.0, None, 3.0, 1.0, 0.0), (5.0, None, 2.0, 1.0, None, 3.0, 1.0, 0.0)])


def test_painted_in_several_tasks(spark, monkeypatch):
    rng = random.Random(7)
    comps = [(rng.uniform(0, 39), rng.uniform(0, 29), 1.0, 1.0, -0.7, rng.uniform(1, 4), rng.uniform(0.5, 2), rng.uniform(0, 3)) for _ in range(60)]
    want = _painted(spark, comps, steps=4)
    monkeypatch.setattr(image, "PAINTED", 5)
    got = _painted(spark, comps, steps=4)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_samples_of_a_component_are_taken_once(monkeypatch):
    """Neighbouring pixels share the samples on their edge, and blocks of pixel rows change nothing."""
    x0, y0, major, minor, pa, steps = 5.3, 4.8, 3.0, 1.5, 0.6, 8
    xs, ys = np.arange(0, 12), np.arange(1, 11)
    at = np.arange(steps + 1) / steps - 0.5
    w = np.array([1, 4, 2, 4, 2, 4, 2, 4, 1]) / (3.0 * steps)
    sigma = image.FWHM
    want = np.zeros((len(ys), len(xs)))
    for i, y in enumerate(ys):
        for j, x in enumerate(xs):
            dx, dy = (x + at - x0)[None, :], (y + at - y0)[:, None]
            g = np.exp(-0.5 * (((dx * math.cos(pa) + dy * math.sin(pa)) * sigma / minor) ** 2 + ((dy * math.cos(pa) - dx * math.sin(pa)) * sigma / major) ** 2))
            want[i, j] = w @ g @ w * sigma**2 / (2 * math.pi * major * minor)
    taken, exp = [], np.exp
    for held in (1, 1 << 16):
        monkeypatch.setattr(image, "SAMPLES", held)
        assert np.allclose(image._shares(x0, y0, major, minor, pa, xs, ys, steps), want, rtol=1e-12, atol=1e-16)
    monkeypatch.setattr(image.np, "exp", lambda g, **more: taken.append(np.size(g)) or exp(g, **more))
    image._shares(x0, y0, major, minor, pa, xs, ys, steps)
    assert sum(taken) == (len(xs) * steps + 1) * (len(ys) * steps + 1)
