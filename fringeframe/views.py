"""Domain views over the test tables.

One text per view serves Spark SQL and, as a WITH prefix, the checking SQL.
``v_cell`` gives ``v_vis`` a key: one averaged sample per spectrum channel.
Averages are rounded with a small offset, so that two engines agree on ties.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

N_CHAN = 54

VIEWS: dict[str, str] = {
    "v_vis": """
SELECT CAST(l_orderkey % 64 AS BIGINT) AS cycle,
       CAST(FLOOR((l_orderkey % 64) / 8.0) AS BIGINT) AS scan,
       CAST(l_orderkey % 3 AS BIGINT) AS field,
       CAST(l_suppkey % 6 AS BIGINT) AS ant1,
       CAST(l_partkey % 6 AS BIGINT) AS ant2,
       CAST(l_orderkey % 4 AS BIGINT) AS beam,
       CAST((l_partkey * 7 + l_linenumber) % 54 AS BIGINT) AS chan,
       CASE l_returnflag WHEN 'A' THEN 'XX' WHEN 'N' THEN 'XY' ELSE 'YY' END AS pol,
       l_quantity - 25.0 AS re,
       (l_discount - l_tax) * 100.0 AS im,
       (l_linestatus = 'F' AND l_linenumber = 7) AS flag,
       1.0 + l_tax AS sigma,
       CAST(l_partkey % 97 AS DOUBLE) - 48.0 AS u,
       CAST(l_suppkey % 89 AS DOUBLE) - 44.0 AS v,
       CAST(l_orderkey % 83 AS DOUBLE) - 41.0 AS w,
       l_shipdate AS ts
FROM lineitem""",
    "v_cell": """
SELECT scan, ant1, ant2, beam, pol, chan,
       ROUND(AVG(re) + 3.1e-9, 6) AS re, ROUND(AVG(im) + 3.1e-9, 6) AS im,
       MAX(CASE WHEN flag THEN 1 ELSE 0 END) = 1 AS flag,
       ROUND(AVG(sigma) + 3.1e-9, 6) AS sigma
FROM v_vis GROUP BY scan, ant1, ant2, beam, pol, chan""",
    "v_row": """
SELECT cycle, field, ant1, ant2, beam,
       MIN(u) AS u, MIN(v) AS v, MIN(w) AS w,
       MIN(CASE WHEN flag THEN 1 ELSE 0 END) = 1 AS flag,
       COUNT(*) AS n_sample
FROM v_vis GROUP BY cycle, field, ant1, ant2, beam""",
    "v_meta": """
SELECT CAST(o_orderkey % 64 AS BIGINT) AS cycle,
       MAX(CAST(o_custkey % 3 AS BIGINT)) AS field,
       MAX(CASE WHEN o_orderkey % 64 >= 60 THEN CAST(-1 AS BIGINT)
                ELSE CAST(FLOOR((o_orderkey % 64) / 8.0) AS BIGINT) END) AS scan_id,
       COUNT(*) AS n_expected
FROM orders GROUP BY o_orderkey % 64""",
    "v_comp": """
SELECT c_custkey AS comp_id,
       CAST((c_custkey * 7919) % 36000 AS DOUBLE) / 100.0 AS ra_deg,
       CAST((c_custkey * 104729) % 17000 AS DOUBLE) / 100.0 - 85.0 AS dec_deg,
       (c_acctbal + 1000.0) / 1000.0 AS flux_peak,
       CAST(c_nationkey AS BIGINT) AS island_id,
       CAST(c_custkey % 7 AS DOUBLE) / 10.0 - 0.8 AS spectral_index,
       888.0 + CAST(c_nationkey AS DOUBLE) AS freq_mhz
FROM customer""",
    "v_ref": """
SELECT c_custkey AS ref_id,
       CAST((c_custkey * 7919) % 36000 AS DOUBLE) / 100.0 + CAST(c_custkey % 3 AS DOUBLE) / 1000.0 AS ra_deg,
       CAST((c_custkey * 104729) % 17000 AS DOUBLE) / 100.0 - 85.0 AS dec_deg,
       (c_acctbal + 1000.0) / 1000.0 * 1.02 AS flux_peak
FROM customer WHERE c_custkey % 5 <> 0""",
    "v_cal": """
SELECT CAST(s_suppkey % 6 AS BIGINT) AS ant,
       CAST(s_suppkey * 10 % 64 AS BIGINT) AS cycle,
       MAX(1.0 + CAST(s_suppkey % 5 AS DOUBLE) / 10.0) AS g_re,
       MAX(CAST(s_suppkey % 3 AS DOUBLE) / 10.0) AS g_im
FROM supplier GROUP BY s_suppkey % 6, s_suppkey * 10 % 64""",
    "v_pix": """
SELECT CAST(l_orderkey % 3 AS BIGINT) AS image_id,
       CAST(l_partkey % 32 AS BIGINT) AS x,
       CAST((l_suppkey * 5 + l_linenumber) % 32 AS BIGINT) AS y,
       AVG(l_extendedprice) / 1000.0 AS value,
       AVG(l_quantity) / 50.0 AS weight
FROM lineitem
GROUP BY l_orderkey % 3, l_partkey % 32, (l_suppkey * 5 + l_linenumber) % 32""",
    "v_cube": """
SELECT CAST(l_orderkey % 3 AS BIGINT) AS image_id,
       CAST(l_partkey % 16 AS BIGINT) AS x,
       CAST((l_suppkey * 5 + l_linenumber) % 16 AS BIGINT) AS y,
       CAST(l_orderkey % 8 AS BIGINT) AS chan,
       ROUND(AVG(l_extendedprice) / 1000.0 + 3.1e-9, 6) AS value
FROM lineitem
GROUP BY l_orderkey % 3, l_partkey % 16, (l_suppkey * 5 + l_linenumber) % 16, l_orderkey % 8""",
    "v_spec": """
SELECT vec_id AS spec_id, CAST(label AS BIGINT) AS beam, embedding AS spectrum FROM embeddings""",
    "v_mon": """
SELECT event_id, user_id AS antenna, event_type AS point, value, ts FROM events""",
}


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BASE = ("region nation customer supplier part orders lineitem events "
         "documents embeddings pages benchmark labels conversations").split()


def needed(text: str) -> list[str]:
    """Views used by ``text``, dependencies first."""
    out: list[str] = []

    def visit(body: str) -> None:
        for name in VIEWS:
            if name not in out and re.search(rf"\b{name}\b", body):
                visit(VIEWS[name])
                if name not in out:
                    out.append(name)

    visit(text)
    return out


def with_views(sql: str) -> str:
    """Prefix a query with the views it names; a leading WITH list is joined to them."""
    names = needed(sql)
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    body = sql.strip()
    head = re.match(r"(?i)with\s+(recursive\s+)?", body)
    if head:
        word = "WITH RECURSIVE" if head.group(1) else "WITH"
        return f"{word} {ctes},\n{body[head.end():]}"
    return f"WITH {ctes}\n{body}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain view as a DataFrame over the tables in ``sf_dir``."""
    text = with_views(f"SELECT * FROM {name}")
    used = [t for t in _BASE if re.search(rf"\b{t}\b", text)]
    return spark.sql(
        re.sub(r"\b(" + "|".join(used) + r")\b", lambda m: "{t_" + m.group(1) + "}", text),
        **{f"t_{t}": tables(spark, sf_dir, t) for t in used},
    )


def spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_cell`` as spectra: one row per (scan, ant1, ant2, beam, pol), arrays over channel.

    The collected list holds one entry per channel of the instrument.  A channel
    without data is zero and flagged.
    """
    return to_spectra(view(spark, sf_dir, "v_cell"), ["scan", "ant1", "ant2", "beam", "pol"], N_CHAN)


def to_spectra(cells: DataFrame, keys: list[str], n_chan: int) -> DataFrame:
    """Cells keyed by (keys, chan) to array rows ``re, im, flag, sigma``."""
    grid = F.sequence(F.lit(0).cast("long"), F.lit(n_chan - 1).cast("long"))
    empty = lambda c: F.struct(c.alias("chan"), F.lit(0.0).alias("re"), F.lit(0.0).alias("im"), F.lit(True).alias("flag"), F.lit(0.0).alias("sigma"))
    d = cells.groupBy(*keys).agg(F.collect_list(F.struct("chan", "re", "im", "flag", "sigma")).alias("s"))
    missing = F.transform(F.array_except(grid, F.transform("s", lambda x: x["chan"])), empty)
    d = d.select(*keys, F.array_sort(F.concat("s", missing)).alias("cell"))
    pick = lambda n: F.transform("cell", lambda x: x[n]).alias(n)
    return d.select(*keys, *[pick(n) for n in ("re", "im", "flag", "sigma")])


#: Dense form of ``v_cell`` for checking SQL: every channel of every spectrum.
GRID_SQL = f"""v_key AS (SELECT DISTINCT scan, ant1, ant2, beam, pol FROM v_cell),
v_grid AS (
  SELECT k.*, g.chan, COALESCE(c.re, 0.0) AS re, COALESCE(c.im, 0.0) AS im,
         COALESCE(c.flag, TRUE) AS flag, COALESCE(c.sigma, 0.0) AS sigma
  FROM v_key k CROSS JOIN (SELECT UNNEST(RANGE({N_CHAN})) AS chan) g
  LEFT JOIN v_cell c ON c.scan = k.scan AND c.ant1 = k.ant1 AND c.ant2 = k.ant2
       AND c.beam = k.beam AND c.pol = k.pol AND c.chan = g.chan)"""
