"""Model visibilities, subtraction, and gridding."""

from __future__ import annotations

from collections.abc import Sequence

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import cut_lineage
from .joins import lookup_join

C_M_S = 299792458.0  # fixed value: speed of light
PACK = 4096  # components packed in one array
ROWS = 16_384  # rows of a field that meet its components in one bucket, about
_PRODUCT = 1 << 20  # phases of one matrix product, about


def pack_components(comps: DataFrame, field: str, size: int = PACK) -> DataFrame:
    """Components (``l, m, flux, comp_id``) of each field as arrays of about ``size`` at most.

    The block of a component is a hash of its id, with as many blocks as the
    fullest field needs; that count is taken once, on the component table.
    """
    fullest = comps.groupBy(field).count().agg(F.max("count").alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(fullest / size))
    n = F.sqrt(1.0 - (F.col("l") * F.col("l") + F.col("m") * F.col("m")))
    item = F.struct(F.col("l").cast("double").alias("l"), F.col("m").cast("double").alias("m"),
                    (n - 1.0).alias("n1"), (F.col("flux") / n).alias("amp"))
    return (comps.groupBy(field, F.pmod(F.xxhash64("comp_id"), F.lit(blocks)).alias("block"))
            .agg(F.collect_list(item).alias("comps")))


def _model(place: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Sum of amp exp(i place . (l, m, n - 1)) over the components of a block (l, m, n - 1, amp), for each row of ``place``."""
    out = np.empty(len(place), complex)
    step = max(1, _PRODUCT // block.shape[1])
    for lo in range(0, len(place), step):
        phase = place[lo : lo + step] @ block[:3]
        out.real[lo : lo + step], out.imag[lo : lo + step] = np.cos(phase) @ block[3], np.sin(phase) @ block[3]
    return out


def predict(rows: DataFrame, packed: DataFrame, row_keys: Sequence[str], field: str, freq: str) -> DataFrame:
    """Model ``model_re``/``model_im`` per row: flux exp(2 pi i freq (lu + mv + (n-1)w) / c) / n over the field's components.

    The rows of a field are dealt over as many buckets as its count asks for, by a hash of ``row_keys``, and move
    once; the field's packed blocks are sent to each of them. In a bucket the rows, about ``ROWS``, come first and
    are held; each block that follows is one matrix product. Rows of a field without components, or of none, get zero.
    """
    rows = cut_lineage(rows)  # counted, then dealt
    names, schema = rows.columns, StructType([*rows.schema.fields, StructField("model_re", DoubleType()), StructField("model_im", DoubleType())])
    per = rows.groupBy(F.col(field).alias("__f")).agg(F.ceil(F.count(F.lit(1)) / ROWS).alias("__n"))
    per = cut_lineage(per)
    bucket = lambda n: F.when(n > 1, F.pmod(F.xxhash64(*row_keys), n)).otherwise(F.lit(0))
    row = F.struct(*[F.col(c) for c in names])
    place = F.array(*[F.coalesce(F.col(c) * F.col(freq) * (2 * math.pi / C_M_S), F.lit(float("nan"))).cast("double") for c in "uvw"])
    data = rows.join(per, F.col(field).eqNullSafe(F.col("__f"))).select("__f", bucket(F.col("__n")).cast("long").alias("__s"), row.alias("__row"), place.alias("__at"))
    none = lambda name: F.lit(None).cast(data.schema[name].dataType).alias(name)
    model = packed.select(F.col(field).alias("__f"), "comps").join(per, "__f").select(
        "__f", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)).alias("__s"), none("__row"), none("__at"), "comps")
    wide = data.withColumn("comps", F.lit(None).cast(packed.schema["comps"].dataType)).unionByName(model)
    wide = wide.withColumn("__k", F.col("comps").isNotNull()).select("__f", "__s", "__k", "__row", "__at", "comps")

    def finish(held):
        for batch, at, sums in held:
            cols = [*pa.RecordBatch.from_struct_array(batch).columns, pa.array(sums.real), pa.array(sums.imag)]
            yield pa.RecordBatch.from_arrays(cols, [*names, "model_re", "model_im"])

    def multiply(batches):
        now, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            code = [batch.column(0).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False), *(batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))]
            new = np.any([c[1:] != c[:-1] for c in code], axis=0)
            edges = [0, *(np.flatnonzero(new) + 1), batch.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:]):
                key = (batch.column(0)[lo].as_py(), code[1][lo])
                if key != now:
                    yield from finish(held)
                    now, held = key, []
                if not code[2][lo]:
                    at = batch.column(4).slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).reshape(-1, 3)
                    held.append((batch.column(3).slice(lo, hi - lo), at, np.zeros(hi - lo, complex)))
                    continue
                for i in range(lo, hi):
                    c = batch.column(5).slice(i, 1).flatten()
                    block = np.stack([c.field(f).to_numpy(zero_copy_only=False).astype(float) for f in ("l", "m", "n1", "amp")])
                    for _, at, sums in held:
                        sums += _model(at, block)
        yield from finish(held)

    return wide.repartition("__f", "__s").sortWithinPartitions("__f", "__s", "__k").mapInArrow(multiply, schema)


def subtract_model(df: DataFrame) -> DataFrame:
    return df.withColumn("re", F.col("re") - F.col("model_re")).withColumn("im", F.col("im") - F.col("model_im"))


def nint(c: Column) -> Column:
    return F.floor(c + 0.5).cast("long")


def grid_box(samples: DataFrame, cell: float, n: int, freq: str, keys: Sequence[str] = ("pol",)) -> DataFrame:
    """Box-kernel gridding: weighted sums per cell; flagged samples and those off the grid are dropped."""
    scale = F.col(freq) / (C_M_S * cell)
    d = samples.where(~F.col("flag")).select(
        *keys, (nint(F.col("u") * scale) + n // 2).alias("iu"), (nint(F.col("v") * scale) + n // 2).alias("iv"),
        "re", "im", F.when(F.col("sigma") > 0, 1.0 / (F.col("sigma") * F.col("sigma"))).otherwise(0.0).alias("wt"))
    d = d.where(F.col("iu").between(0, n - 1) & F.col("iv").between(0, n - 1))
    return d.groupBy(*keys, "iu", "iv").agg(
        F.sum(F.col("re") * F.col("wt")).alias("g_re"), F.sum(F.col("im") * F.col("wt")).alias("g_im"),
        F.sum("wt").alias("g_wt"), F.count(F.lit(1)).alias("n"))


def box_kernel(spark, support: int) -> DataFrame:
    """Kernel table (fu, fv, du, dv, k) of equal weights over (2s+1)^2 cells, no oversampling."""
    side = 2 * support + 1
    return spark.range(side * side).select(
        F.lit(0).cast("long").alias("fu"), F.lit(0).cast("long").alias("fv"),
        (F.col("id") % side - support).alias("du"), (F.floor(F.col("id") / side) - support).alias("dv"),
        F.lit(1.0 / (side * side)).alias("k"))


def grid_kernel(samples: DataFrame, kernel: DataFrame, cell: float, n: int, oversample: int, freq: str,
                keys: Sequence[str] = ("pol",)) -> DataFrame:
    """Gridding with a kernel table: one equi join on the sub-cell offset, then partial sums.

    Samples are first summed per (cell, offset), so the kernel is applied to
    occupied sub-cells and not to every sample; the result is the same sum.
    """
    scale = F.col(freq) / (C_M_S * cell)
    d = samples.where(~F.col("flag")).select(
        *keys, (F.col("u") * scale).alias("su"), (F.col("v") * scale).alias("sv"), "re", "im",
        F.when(F.col("sigma") > 0, 1.0 / (F.col("sigma") * F.col("sigma"))).otherwise(0.0).alias("wt"))
    for a in ("u", "v"):
        i, f = nint(F.col(f"s{a}")), nint((nint(F.col(f"s{a}")) - F.col(f"s{a}")) * oversample)
        d = d.withColumn(f"__f{a}", f).withColumn(
            f"i{a}", i + F.when(F.col(f"__f{a}") < 0, 1).when(F.col(f"__f{a}") >= oversample, -1).otherwise(0) + n // 2)
        d = d.withColumn(f"f{a}", F.pmod(f"__f{a}", F.lit(oversample)))
    sub = d.groupBy(*keys, "iu", "iv", "fu", "fv").agg(
        F.sum(F.col("re") * F.col("wt")).alias("r"), F.sum(F.col("im") * F.col("wt")).alias("i"), F.sum("wt").alias("wt"))
    # a sample counts only if its whole footprint is on the grid
    reach = kernel.agg(F.max(F.greatest(F.abs("du"), F.abs("dv"))).alias("s")).scalar()
    inside = ((F.col("iu") - reach >= 0) & (F.col("iu") + reach < n) & (F.col("iv") - reach >= 0) & (F.col("iv") + reach < n))
    e = lookup_join(sub.where(inside), kernel, ["fu", "fv"])
    return e.groupBy(*keys, (F.col("iu") + F.col("du")).alias("iu"), (F.col("iv") + F.col("dv")).alias("iv")).agg(
        F.sum(F.col("r") * F.col("k")).alias("g_re"), F.sum(F.col("i") * F.col("k")).alias("g_im"),
        F.sum(F.col("wt") * F.col("k")).alias("g_wt"))


def taylor_weight(freq: Column, ref: float, order: int) -> Column:
    return F.lit(1.0) if order == 0 else F.pow((freq - ref) / ref, F.lit(float(order)))


def channel_to_plane(freq: Column, start: float, step: float, n: int) -> Column:
    """Nearest image plane of a frequency, -1 outside; a single plane takes all."""
    if n == 1:
        return F.lit(0).cast("long")
    k = nint((freq - start) / step)
    return F.when(k.between(0, n - 1), k).otherwise(F.lit(-1).cast("long"))
