"""Streaming queries, run until their source is drained, and file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cx import Cx
from ..operators import calibrate, flag, joins, skymodel, summary
from ..session import shared_path
from ..sources import catalogue, datagrams, publish, streams, votable
from ..streaming import cycles, merge, sinks, state
from ..views import VIEWS, tables, view
from .calibration_queries import _G12, rs
from .flag_queries import _SH, _shadow
from .registry import ORACLES, op, r6
from .spectral_queries import _DATA, monitor_columns, monitored_spectra, preview


def stage(df, fmt="parquet", name="stage"):
    """Put rows derived from the tables where a stream can read them."""
    path = shared_path(df.sparkSession, name)
    df.write.format(fmt).save(path)
    return path


def vis_stream(spark, sf):
    """The sample view over a stream of the line table."""
    schema = tables(spark, sf, "lineitem").schema
    # a pattern, so that the table may be one file or a folder of parts
    s = spark.readStream.schema(schema).parquet(f"{sf}/lineitem.parque[t]")
    return spark.sql(VIEWS["v_vis"].replace("FROM lineitem", "FROM {t}"), t=s)


def meta_stream(spark, sf):
    m = view(spark, sf, "v_meta").select(F.col("field").alias("stream"), "cycle", "scan_id")
    path = stage(m)
    return spark.readStream.schema(m.schema).parquet(path)


@op("src8", "SELECT beam, chan AS channel, ant1 * 6 + ant2 AS baseline, COUNT(DISTINCT cycle) AS n, " + rs("SUM(re)", "re_sum") + """
FROM (SELECT cycle, beam, chan, ant1, ant2, MAX(re) AS re FROM v_vis GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3""")
def src8(spark, sf):
    """Datagrams with one payload entry per baseline, streamed and unpacked; absent baselines are null in the payload."""
    v = view(spark, sf, "v_vis").groupBy("cycle", "beam", "chan", (F.col("ant1") * 6 + F.col("ant2")).alias("b")).agg(F.max("re").alias("re"), F.max("im").alias("im"))
    d = v.withColumn("slice", F.floor(F.col("b") / 12)).groupBy("cycle", "beam", "chan", "slice").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("b") % 12, F.struct("re", "im")))).alias("m"))
    grams = d.select(F.lit(1).cast("long").alias("version"), "slice", (F.col("cycle") * 5000000).alias("timestamp"), F.lit(0).cast("long").alias("block"),
                     F.lit(0).cast("long").alias("card"), F.col("chan").alias("channel"), (700.0 + F.col("chan")).alias("freq"), "beam",
                     F.transform(F.sequence(F.lit(0).cast("long"), F.lit(11).cast("long")), lambda k: F.try_element_at("m", k)).alias("payload"))
    s = streams.unpack(streams.datagrams(spark, stage(grams)), 12).where("re IS NOT NULL")
    return sinks.drain(s).groupBy("beam", "channel", "baseline").agg(F.count_distinct("timestamp").alias("n"), r6(F.sum("re")).alias("re_sum"))


@op("src9", """SELECT cycle * 5000000 AS timestamp, scan_id, CASE WHEN scan_id >= 0 THEN cycle % 2 = 1 END AS flagged, CASE WHEN scan_id >= 0 THEN CAST(900.5 + field AS DOUBLE) END AS centre_mhz,
 CASE WHEN scan_id >= 0 THEN 'field' || field END AS target_name FROM v_meta""")
def src9(spark, sf):
    tv = lambda t, c: F.struct(F.lit(t).alias("type"), c.cast("string").alias("value"))
    m = view(spark, sf, "v_meta").select((F.col("cycle") * 5000000).alias("timestamp"), F.create_map(
        F.lit("scan_id"), tv("int", F.col("scan_id")), F.lit("flagged"), tv("bool", F.col("cycle") % 2 == 1),
        F.lit("sky_frequency"), tv("double", 900.5 + F.col("field")), F.lit("target_name"), tv("string", F.concat(F.lit("field"), F.col("field").cast("string"))),
        F.lit("corrmode"), tv("string", F.lit("standard"))).alias("data"))
    path = stage(m.select(F.to_json(F.struct("timestamp", "data")).alias("value")), "text")
    return sinks.drain(streams.metadata(spark, path)).select("timestamp", "scan_id", "flagged", "centre_mhz", "target_name")


@op("str1_stream", f"""WITH {_DATA} SELECT m.cycle * 1000 AS meta_ms, d.t AS t_ms, m.scan_id, d.t <> m.cycle * 1000 AS cycle_flag, COUNT(*) AS n_vis FROM v_meta m JOIN d ON ABS(d.t - m.cycle * 1000) < 500
WHERE m.scan_id >= 0 GROUP BY 1, 2, 3, 4""")
def str1_stream(spark, sf):
    """Two streams joined on time within half an interval; the batch form is str1."""
    at = lambda c: F.timestamp_millis(c + 1_500_000_000_000)  # cycles of a real epoch; time zero would be behind the first watermark
    v = vis_stream(spark, sf).withColumn("t_ms", F.col("cycle") * 1000 + (F.col("cycle") * 7) % 9 * 100).select("t_ms", "beam", "chan")
    m = meta_stream(spark, sf).withColumn("t_ms", F.col("cycle") * 1000)
    j = merge.merge_streams(v.withColumn("event_time", at(F.col("t_ms"))), m.withColumn("event_time", at(F.col("t_ms"))), 1000, "2 hours")
    return sinks.drain(j.select("meta_ms", "t_ms", "scan_id", "cycle_flag")).groupBy("meta_ms", "t_ms", "scan_id", "cycle_flag").agg(F.count(F.lit(1)).alias("n_vis"))


EPOCH = 1_500_000_000_000  # milliseconds; time zero would be behind the first watermark
STEPS = 8


def arriving(df, time, parts=4, late=None):
    """A stream of ``df`` that arrives in steps of 8000 ms, a trigger each; ``late`` arrives last."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, "arriving")
    df = df.withColumn("step", F.floor(F.col(time) / 8000))
    for i in range(STEPS + 1):
        df.where(F.col("step") == i).drop("step").repartition(parts).write.mode("append").parquet(path)
    if late is not None:
        late.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.drop("step").schema).option("maxFilesPerTrigger", parts).parquet(path)


def _grams(spark, sf):
    """(stream, t_ms, item): datagrams of each beam, a channel each, at the jittered times of str1."""
    t = (F.col("cycle") * 1000 + (F.col("cycle") * 7) % 9 * 100).alias("t_ms")
    return view(spark, sf, "v_vis").select(F.col("beam").alias("stream"), t, F.col("chan").alias("item"))


def _late(grams):
    """Rows that come an observation late, under numbers of their own that would show."""
    return grams.where("t_ms < 8000 AND stream = 1").withColumn("item", F.col("item") + 100).distinct()


def _merged(spark, sf):
    """Datagrams of four streams merged with metadata that ends each stream at another cycle."""
    m = view(spark, sf, "v_meta").withColumn("stream", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    m = m.select("stream", (F.col("cycle") * 1000).alias("t_ms"), F.when(F.col("cycle") == 50 + 3 * F.col("stream"), F.lit(-2)).otherwise(F.col("scan_id")).alias("scan_id"))
    v = _grams(spark, sf).distinct()
    return cycles.merged_cycles(arriving(v, "t_ms", parts=1, late=_late(v)), arriving(m, "t_ms", parts=1), 1000, 150, EPOCH)


_MERGED = """WITH d AS (SELECT DISTINCT beam AS stream, cycle * 1000 + (cycle * 7) % 9 * 100 AS t, chan FROM v_vis),
 m AS (SELECT stream, cycle * 1000 AS t, CASE WHEN cycle = 50 + 3 * stream THEN -2 ELSE scan_id END AS scan_id FROM v_meta CROSS JOIN (SELECT UNNEST(RANGE(4)) AS stream)),
 fin AS (SELECT stream, MIN(t) AS t_end FROM m WHERE scan_id = -2 GROUP BY 1),
 c AS (SELECT m.* FROM m LEFT JOIN fin USING (stream) WHERE scan_id >= 0 AND (t_end IS NULL OR m.t < t_end)),
 f AS (SELECT c.stream, c.t AS meta_ms, c.scan_id, MIN(d.t) AS t_ms FROM c LEFT JOIN d ON d.stream = c.stream AND ABS(d.t - c.t) * 2 < 1000 GROUP BY 1, 2, 3)"""


@op("str1_merge", _MERGED + """ SELECT f.stream, meta_ms, t_ms, scan_id, COALESCE(t_ms <> meta_ms, FALSE) AS flag, COUNT(d.chan) AS n_received
FROM f LEFT JOIN d ON d.stream = f.stream AND d.t = f.t_ms GROUP BY ALL""")
def str1_merge(spark, sf):
    """The merge rule by rule over many triggers: end scan, idle scans, mistimed, skipped and incomplete cycles, late data."""
    return sinks.drain(_merged(spark, sf), timers=True).select("stream", "meta_ms", "t_ms", "scan_id", "flag", F.size("received").cast("long").alias("n_received"))


@op("str3_stream", _MERGED + """, g AS (SELECT f.*, i FROM f CROSS JOIN (SELECT UNNEST(RANGE(54)) AS i))
SELECT g.stream, meta_ms, COUNT(*) AS n_expected, COUNT(*) - COUNT(d.chan) AS n_missing, COUNT(*) FILTER (d.chan IS NULL OR t_ms <> meta_ms) AS n_flagged
FROM g LEFT JOIN d ON d.stream = g.stream AND d.t = g.t_ms AND d.chan = g.i GROUP BY 1, 2""")
def str3_stream(spark, sf):
    """What did not arrive before a cycle was closed stays flagged."""
    grid = cycles.expected_grid(sinks.drain(_merged(spark, sf), timers=True), 54)
    n = lambda c: F.sum(F.col(c).cast("long"))
    return grid.groupBy("stream", "meta_ms").agg(F.count(F.lit(1)).alias("n_expected"), n("missing").alias("n_missing"), n("flag").alias("n_flagged"))


@op("str2_stream", f"WITH {_DATA} SELECT beam AS stream, t AS t_ms, COUNT(*) AS n_vis, COUNT(DISTINCT chan) AS n_chan FROM d WHERE t + 2150 < (SELECT MAX(t) FROM d) GROUP BY 1, 2")
def str2_stream(spark, sf):
    """Chunks without metadata; the last two seconds are still open when the source is drained."""
    g = _grams(spark, sf)
    return sinks.drain(cycles.chunks(arriving(g, "t_ms", late=_late(g)), 150, EPOCH), timers=True)


@op("str4_stream", """WITH p AS (SELECT DISTINCT cycle, chan // 9 AS stream, cycle * 1000 + CASE WHEN (cycle + chan // 9) % 4 = 0 THEN 1 WHEN (cycle * 3 + chan // 9) % 5 = 0 THEN 2 ELSE 0 END AS t FROM v_vis
  WHERE (cycle * 5 + chan // 9) % 11 <> 0),
 v AS (SELECT cycle, t, COUNT(*) AS n, MIN(stream) AS s0 FROM p GROUP BY 1, 2), b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cycle ORDER BY n DESC, s0) AS k, SUM(n) OVER (PARTITION BY cycle) AS tot FROM v)
SELECT p.cycle, p.stream, b.t AS merged_time, CAST(b.tot - b.n AS BIGINT) AS misaligned, p.t <> b.t AS flag FROM p JOIN b ON b.cycle = p.cycle AND b.k = 1
WHERE tot = 6 OR p.cycle * 1000 + 2152 < (SELECT MAX(t) FROM p)""")
def str4_stream(spark, sf):
    """Channel merge of streams of which some miss a cycle; late parts change nothing."""
    s, c = F.floor(F.col("chan") / 9), F.col("cycle")
    jit = F.when((c + s) % 4 == 0, 1).when((c * 3 + s) % 5 == 0, 2).otherwise(0)
    p = view(spark, sf, "v_vis").select("cycle", s.alias("stream"), (c * 1000 + jit).alias("t_ms")).where((c * 5 + F.col("stream")) % 11 != 0).distinct()
    late = p.where("cycle < 8").withColumn("t_ms", F.col("t_ms") + 5)
    return sinks.drain(cycles.merged_channels(arriving(p, "t_ms", parts=1, late=late), 6, 150, EPOCH), timers=True)


@op("str10_stream")
def str10_stream(spark, sf):
    """Monitoring store as an update stream over several triggers."""
    m = view(spark, sf, "v_mon").withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value"))).withColumn("t_ms", (F.col("event_id") % STEPS) * 8000)
    last = merge.latest_points(arriving(m, "t_ms"), ["antenna", "point"])
    return sinks.drain_updates(last, ["antenna", "point"]).select("antenna", "point", F.round("last.value", 6).alias("value"))


@op("str11_stream")
def str11_stream(spark, sf):
    """Live preview: averages of a channel range leave with each trigger, a spectrum at a time."""
    s = monitored_spectra(spark, sf).withColumn("t_ms", (F.col("spec_id") % STEPS) * 8000)
    return monitor_columns(sinks.drain(preview(arriving(s, "t_ms").drop("t_ms"), 4, 20)))


ORACLES.update(str10_stream=ORACLES["str10"], str11_stream=ORACLES["str11"])  # equal to the batch forms


@op("str7", """SELECT cycle, scan_id, CASE WHEN scan_id = -1 THEN 'idle' ELSE 'active' END AS state FROM v_meta""")
def str7(spark, sf):
    return sinks.drain(state.scan_states(meta_stream(spark, sf))).select("cycle", "scan_id", "state")


@op("str8", """WITH s AS (SELECT cycle, scan_id, CASE WHEN LAG(scan_id) OVER (PARTITION BY field ORDER BY cycle) IS DISTINCT FROM scan_id THEN 1 ELSE 0 END AS new, field FROM v_meta),
 r AS (SELECT cycle, field, SUM(new) OVER (PARTITION BY field ORDER BY cycle) AS run FROM s) SELECT cycle, ROW_NUMBER() OVER (PARTITION BY field, run ORDER BY cycle) <= 2 AS flag FROM r""")
def str8(spark, sf):
    return sinks.drain(state.quack(meta_stream(spark, sf), 2)).select("cycle", "flag")


@op("str9_stream", _SH + """, tt AS (SELECT cycle, LAG(cycle) OVER (PARTITION BY field ORDER BY cycle) AS p FROM (SELECT DISTINCT cycle FROM rows0) JOIN v_meta USING (cycle))
SELECT sh.cycle, sh.ant, 'enter' AS event FROM sh JOIN tt USING (cycle) WHERE NOT EXISTS (SELECT 1 FROM sh s2 WHERE s2.cycle = tt.p AND s2.ant = sh.ant)
UNION ALL SELECT tt.cycle, s2.ant, 'leave' AS event FROM tt JOIN sh s2 ON s2.cycle = tt.p WHERE NOT EXISTS (SELECT 1 FROM sh WHERE sh.cycle = tt.cycle AND sh.ant = s2.ant)""")
def str9_stream(spark, sf):
    rows, sh = _shadow(spark, sf)
    lists = rows.select("cycle").distinct().join(sh.groupBy("cycle").agg(F.collect_set("ant").alias("a")), "cycle", "left")
    d = lists.join(view(spark, sf, "v_meta").select("cycle", F.col("field").alias("stream")), "cycle").select("stream", "cycle", F.coalesce("a", F.array().cast("array<bigint>")).alias("ants"))
    s = spark.readStream.schema(d.schema).parquet(stage(d))
    return sinks.drain(state.shadow_log(s)).select("cycle", "ant", "event")


@op("jn4", f"""WITH g AS (SELECT ant, MAX(g_re) AS g_re, MAX(g_im) AS g_im FROM v_cal GROUP BY ant),
 j AS (SELECT v.*, {_G12[0]} AS gr, {_G12[1]} AS gi FROM v_vis v JOIN g g1 ON g1.ant = v.ant1 JOIN g g2 ON g2.ant = v.ant2)
SELECT cycle, ant1, ant2, {rs('SUM((re * gr + im * gi) / (gr * gr + gi * gi))', 're', 4)}, {rs('SUM((im * gr - re * gi) / (gr * gr + gi * gi))', 'im', 4)} FROM j GROUP BY 1, 2, 3""")
def jn4(spark, sf):
    """Gains, a static table, applied to the visibility stream."""
    g = view(spark, sf, "v_cal").groupBy("ant").agg(F.max("g_re").alias("g_re"), F.max("g_im").alias("g_im"))
    side = lambda n: g.select(F.col("ant").alias(f"ant{n}"), F.col("g_re").alias(f"g_re_{n}"), F.col("g_im").alias(f"g_im_{n}"))
    v = vis_stream(spark, sf)
    v = joins.lookup_join(joins.lookup_join(v, side(1), ["ant1"]), side(2), ["ant2"])
    g1, g2 = Cx.of("g_re_1", "g_im_1"), Cx.of("g_re_2", "g_im_2")
    out = calibrate.apply_hands(v, (g1, g1), (g2, g2))
    t = sinks.drain(out.select("cycle", "ant1", "ant2", "re", "im"))
    return t.groupBy("cycle", "ant1", "ant2").agg(r6(F.sum("re"), 4).alias("re"), r6(F.sum("im"), 4).alias("im"))


_HANDS = [("XX", "x", "x"), ("XY", "x", "y"), ("YX", "y", "x"), ("YY", "y", "y")]


def _hand(part):
    return "CASE pol " + " ".join(f"WHEN '{p}' THEN {part.format(a=a, b=b)}" for p, a, b in _HANDS) + " END"


@op("jn4_hands", f"""WITH g AS (SELECT ant, MAX(g_re) AS xr, MAX(g_im) AS xi, MIN(g_re) AS yr, MIN(g_im) AS yi FROM v_cal GROUP BY ant),
 j AS (SELECT v.*, {_hand('g1.{a}r * g2.{b}r + g1.{a}i * g2.{b}i')} AS gr, {_hand('g1.{a}i * g2.{b}r - g1.{a}r * g2.{b}i')} AS gi
   FROM v_vis v JOIN g g1 ON g1.ant = v.ant1 JOIN g g2 ON g2.ant = v.ant2)
SELECT cycle, ant1, ant2, pol, {rs('SUM((re * gr + im * gi) / (gr * gr + gi * gi))', 're', 4)}, {rs('SUM((im * gr - re * gi) / (gr * gr + gi * gi))', 'im', 4)} FROM j GROUP BY 1, 2, 3, 4""")
def jn4_hands(spark, sf):
    """As jn4 for all products, XY too, with a gain for each hand."""
    g = view(spark, sf, "v_cal").groupBy("ant").agg(F.max("g_re").alias("xr"), F.max("g_im").alias("xi"), F.min("g_re").alias("yr"), F.min("g_im").alias("yi"))
    side = lambda n: g.select(F.col("ant").alias(f"ant{n}"), *[F.col(c).alias(f"{c}_{n}") for c in ("xr", "xi", "yr", "yi")])
    v = joins.lookup_join(joins.lookup_join(vis_stream(spark, sf), side(1), ["ant1"]), side(2), ["ant2"])
    gains = lambda n: (Cx.of(f"xr_{n}", f"xi_{n}"), Cx.of(f"yr_{n}", f"yi_{n}"))
    t = sinks.drain(calibrate.apply_hands(v, gains(1), gains(2)).select("cycle", "ant1", "ant2", "pol", "re", "im"))
    return t.groupBy("cycle", "ant1", "ant2", "pol").agg(r6(F.sum("re"), 4).alias("re"), r6(F.sum("im"), 4).alias("im"))


@op("snk1", """SELECT beam, CAST(chan // 18 AS BIGINT) AS freq_chunk, 'vis_' || STRFTIME(ts, '%Y-%m-%d') || '_b' || beam || '_f' || (chan // 18) || '.ms' AS name, COUNT(*) AS n_vis FROM v_vis GROUP BY 1, 2, 3""")
def snk1(spark, sf):
    """Visibilities streamed to a folder for each date and read back; beam and frequency chunk are columns there."""
    v = vis_stream(spark, sf).select("ts", "beam", "chan", "re", "im")
    path = shared_path(spark, "vis")
    sinks.write_visibilities(v, path, shared_path(spark, "ckpt"), 18, ("date",)).awaitTermination()
    t = spark.read.parquet(path)
    name = sinks.file_name("vis_%d_b%b_f%f.ms", F.col("date"), F.col("beam"), F.col("freq_chunk"))
    return t.groupBy(F.col("beam").cast("long").alias("beam"), F.col("freq_chunk").cast("long").alias("freq_chunk"), name.alias("name")).agg(F.count(F.lit(1)).alias("n_vis"))


@op("snk4", "SELECT cycle || '/' || beam AS key, COUNT(*) AS n, " + rs("SUM(re)", "re_sum") + " FROM v_vis GROUP BY 1")
def snk4(spark, sf):
    """Rows as messages through a micro-batch sink, each batch written under its id."""
    msgs = sinks.as_messages(vis_stream(spark, sf).select("cycle", "beam", "chan", "pol", "re", "im"), ["cycle", "beam"])
    path = shared_path(spark, "messages")
    sinks.send(msgs, lambda batch, i: batch.write.mode("overwrite").parquet(f"{path}/batch={i}"), shared_path(spark, "ckpt")).awaitTermination()
    t = spark.read.parquet(path).select("key", F.get_json_object("value", "$.re").cast("double").alias("re"))
    return t.groupBy("key").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("re")).alias("re_sum"))


@op("src2", """SELECT 'c' || comp_id AS component_id, ROUND(ra_deg, 6) AS ra, ROUND(dec_deg, 6) AS dec, CASE WHEN comp_id % 3 = 0 THEN ROUND(flux_peak * 0.1 + 3.1e-9, 6) END AS lin_pol FROM v_comp""")
def src2(spark, sf):
    """Components and polarisation written as XML tables, loaded by position and matched on id."""
    c = view(spark, sf, "v_comp").withColumn("component_id", F.concat(F.lit("c"), F.col("comp_id").cast("string")))
    txt = lambda *cols: F.array(*[x.cast("string") for x in cols])
    a = c.select(txt(F.col("component_id"), F.round("ra_deg", 6), F.round("dec_deg", 6)).alias("TD"))
    b = c.where("comp_id % 3 = 0").select(txt(F.col("component_id"), r6(F.col("flux_peak") * 0.1)).alias("TD"))
    paths = []
    for d in (a, b):
        p = shared_path(spark, "votable")
        d.write.format("xml").option("rootTag", "TABLEDATA").option("rowTag", "TR").save(p)
        paths.append(p)
    out = catalogue.load_components(spark, paths[0], {"component_id": "string", "ra": "double", "dec": "double"}, paths[1],
                                    {"component_id": "string", "lin_pol": "double"})
    return out.select("component_id", "ra", "dec", "lin_pol")


_ID = {"ucd": "meta.id;meta.main", "datatype": "char", "unit": "--"}


@op("src2_fields", """SELECT 'c' || comp_id AS component_id, ROUND(ra_deg, 6) AS ra, ROUND(dec_deg, 6) AS dec, CAST(island_id AS INTEGER) AS island, ROUND(flux_peak * 1000 + 3.1e-9, 4) AS flux_peak,
 CASE WHEN comp_id % 3 = 0 THEN ROUND(flux_peak * 0.1 + 3.1e-9, 6) END AS lin_pol FROM v_comp""")
def src2_fields(spark, sf):
    """Documents with their fields in different orders and units, and a polarisation table, loaded by their own headers."""
    c = view(spark, sf, "v_comp").withColumn("id", F.concat(F.lit("c"), F.col("comp_id").cast("string")))
    path, pol = shared_path(spark, "votable"), shared_path(spark, "votable")
    field = lambda ucd, unit, kind="double": {"ucd": ucd, "unit": unit, "datatype": kind}
    a = {"id": _ID, "ra_deg": field("pos.eq.ra;meta.main", "deg"), "dec_deg": field("pos.eq.dec;meta.main", "deg"), "island": field("", "--", "int"),
         "peak": field("phot.flux.density;stat.max;em.radio;stat.fit", "Jy/beam")}
    b = {"peak": field("phot.flux.density;stat.max;em.radio;stat.fit", "mJy/beam"), "dec_rad": field("pos.eq.dec;meta.main", "rad"), "island": a["island"], "id": _ID,
         "ra_rad": field("pos.eq.ra;meta.main", "rad")}
    c = c.withColumn("island", F.col("island_id"))
    votable.write(c.where("comp_id % 2 = 0").withColumn("peak", F.col("flux_peak")), f"{path}/a", a)
    votable.write(c.where("comp_id % 2 = 1").select("id", "island", F.radians("ra_deg").alias("ra_rad"), F.radians("dec_deg").alias("dec_rad"), (F.col("flux_peak") * 1000).alias("peak")), f"{path}/b", b)
    votable.write(c.where("comp_id % 3 = 0").withColumn("lin_pol", r6(F.col("flux_peak") * 0.1)), pol, {"lin_pol": field("", "mJy"), "id": _ID})
    out = votable.load(spark, path, pol)
    return out.select("component_id", F.round("ra", 6).alias("ra"), F.round("dec", 6).alias("dec"), "island", r6("flux_peak", 4).alias("flux_peak"), "lin_pol")


@op("src8_binary", "SELECT beam, chan AS channel, ant1 * 6 + ant2 AS baseline, COUNT(DISTINCT cycle) AS n, " + rs("SUM(re)", "re_sum") + """
FROM (SELECT cycle, beam, chan, ant1, ant2, MAX(re) AS re FROM v_vis GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3""")
def src8_binary(spark, sf):
    """Binary datagrams that arrive in two parts; the second run of the stream starts at the offsets of the first."""
    v = view(spark, sf, "v_vis").groupBy("cycle", "beam", "chan", (F.col("ant1") * 6 + F.col("ant2")).alias("b")).agg(F.max("re").alias("re"), F.max("im").alias("im"))
    d = v.withColumn("slice", F.floor(F.col("b") / 12)).groupBy("cycle", "beam", "chan", "slice").agg(F.map_from_entries(F.collect_list(F.struct(F.col("b") % 12, F.struct("re", "im")))).alias("m"))
    whole = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(11).cast("long")), lambda k: F.try_element_at("m", k))
    zero = F.lit(0).cast("long")
    grams = d.select(F.lit(1).cast("long").alias("version"), "slice", (F.col("cycle") * 5000000).alias("timestamp"), zero.alias("block"), zero.alias("card"), F.col("chan").alias("channel"),
                     (700.0 + F.col("chan")).alias("freq"), "beam", (F.col("slice") * 12).alias("baseline1"), (F.col("slice") * 12 + 11).alias("baseline2"), whole.alias("payload"), "cycle")
    path, out, ckpt = (shared_path(spark, n) for n in ("datagrams", "sink", "ckpt"))
    for part in ("cycle < 32", "cycle >= 32"):
        datagrams.write(grams.where(part), path, 12).agg(F.sum("n")).first()
        s = datagrams.unpack(datagrams.stream(spark, path, 12, 4096))
        s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy("beam", "channel", "baseline").agg(F.count_distinct("timestamp").alias("n"), r6(F.sum("re")).alias("re_sum"))


def _components(spark, sf):
    return view(spark, sf, "v_comp").select(F.concat(F.lit("c"), F.col("comp_id").cast("string")).alias("component_id"), F.round("ra_deg", 6).alias("ra"),
                                            F.round("dec_deg", 6).alias("dec"), r6("flux_peak").alias("flux_peak"))


@op("src4", """SELECT 'c' || comp_id AS component_id, ROUND(ra_deg, 6) AS ra, ROUND(dec_deg, 6) AS dec, CAST(sb AS BIGINT) AS sb_id, CASE WHEN sb = 7 THEN 'survey' END AS data_source
FROM v_comp CROSS JOIN (SELECT UNNEST([7, 8]) AS sb)""")
def src4(spark, sf):
    """Two scheduling blocks ingested into one sky model, read back."""
    path = shared_path(spark, "skymodel")
    c = skymodel.index_components(_components(spark, sf), "ra", "dec")
    catalogue.ingest(c, path, 7, "2017-01-01 00:00:00", "survey")
    catalogue.ingest(c, path, 8)
    return catalogue.model(spark, path).select("component_id", "ra", "dec", "sb_id", "data_source")


@op("src4_again", """SELECT 'c' || comp_id AS component_id, CAST(7 AS BIGINT) AS sb_id, CAST(1 AS BIGINT) AS n_ids, CAST(1 AS BIGINT) AS n_rows FROM v_comp""")
def src4_again(spark, sf):
    """A job that is run three times, the last time with other rows: the block is there once, with the ids of the first run."""
    path = shared_path(spark, "skymodel")
    c = skymodel.index_components(_components(spark, sf), "ra", "dec")
    runs = [catalogue.ingest(d, path, 7, "2017-01-01 00:00:00", "survey") for d in (c, c, c.where("ra > 100"))]
    ids = runs[0].unionByName(runs[1]).unionByName(runs[2]).groupBy("component_id").agg(F.count_distinct("id").alias("n_ids"))
    n = catalogue.model(spark, path).groupBy("component_id", "sb_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return n.join(ids, "component_id").select("component_id", "sb_id", "n_ids", "n_rows")


@op("snk6_deposit", """SELECT 'image' AS kind, 1 AS n_artefacts, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_scans, CAST(NULL AS VARCHAR) AS obs_start, CAST(NULL AS VARCHAR) AS obs_end FROM v_pix
UNION ALL SELECT 'catalogue', 1, COUNT(*), 0, NULL, NULL FROM v_comp
UNION ALL SELECT 'measurement_set', 2, COUNT(*), (SELECT COUNT(*) FROM (SELECT DISTINCT cycle < 32, field, scan FROM v_vis)),
 STRFTIME(MIN(ts) FILTER (cycle < 32), '%Y-%m-%d'), STRFTIME(MAX(ts) FILTER (cycle < 32), '%Y-%m-%d') FROM v_vis""")
def snk6_deposit(spark, sf):
    """Deposit of an image, a catalogue and two visibility tables; the manifest is written twice and read back."""
    out = shared_path(spark, "deposit")
    vis = view(spark, sf, "v_vis")
    tables_ = {"image": {"i": view(spark, sf, "v_pix")}, "catalogue": {"c": view(spark, sf, "v_comp")}, "measurement_set": {"m0": vis.where("cycle < 32"), "m1": vis.where("cycle >= 32")}}
    declared, scans = {}, {}
    for kind, each in tables_.items():
        for name, df in each.items():
            df.write.parquet(f"{out}/in/{name}")
            declared.setdefault(kind, []).append(f"{out}/in/{name}")
            if kind == "measurement_set":
                scans[f"{out}/in/{name}"] = summary.scan_manifest(spark.read.parquet(f"{out}/in/{name}"))
    first = publish.deposit(spark, f"{out}/out", 7, declared, scans)
    assert publish.deposit(spark, f"{out}/out", 7, declared, scans) == first
    rows = []
    for kind in tables_:
        mine = [a for a in first["artefacts"] if a["kind"] == kind]
        ms = kind == "measurement_set"
        n = sum(spark.read.parquet(a["path"]).count() for a in mine)
        rows.append((kind, len(mine), n, sum(len(a.get("scans", ())) for a in mine), first["obs_start"][:10] if ms else None, first["obs_end"][:10] if ms else None))
    return spark.createDataFrame(rows, "kind string, n_artefacts int, n_rows long, n_scans long, obs_start string, obs_end string")


@op("src5", "SELECT COUNT(*) AS n_ids, COUNT(DISTINCT comp_id) AS n_distinct FROM v_comp")
def src5(spark, sf):
    """Upload of components that carry no index yet; returns their ids."""
    ids = catalogue.ingest(_components(spark, sf), shared_path(spark, "skymodel"), 9)
    return ids.agg(F.count(F.lit(1)).alias("n_ids"), F.count_distinct("id").alias("n_distinct"))
