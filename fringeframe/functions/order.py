"""Order statistics: inside an array, and over groups of any size.

The flaggers take the elements at positions n/4, n/2 and 3n/4 (0-based, no
interpolation) of the sorted amplitudes, so ``percentile`` does not fit.  For
arrays the spectrum is sorted in place.  For groups that may hold any share of
the table no group is ever sorted and no value is shuffled: a value has an
image, a 64-bit integer that sorts alike, and four histograms of 16 bits each
narrow the wanted ranks down to one value, whatever the range is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

IQR_TO_SIGMA = 1.34896  # fixed value: interquartile range of a unit normal
MADFM_TO_SIGMA = 0.6744888  # fixed value: MADFM of a unit normal

_INF = float("inf")
_LARGEST = 1.7976931348623157e308  # fixed value: largest finite double
_MANTISSA = 1 << 52  # fixed value: steps of a double between two powers of two
#: Bits of the image that one histogram resolves; four of them give the value.
_DIGIT = 16


# ---------------------------------------------------------------- arrays

def array_pick(sorted_arr: Column, num: int, den: int) -> Column:
    """Element floor(n * num / den), 0-based; null for an empty array."""
    n = F.size(sorted_arr)
    return F.try_element_at(sorted_arr, F.floor(n * num / den).cast("int") + 1)


def array_robust(arr: Column) -> tuple[Column, Column]:
    """(median, sigma from the interquartile range) of an array."""
    s = F.array_sort(arr)
    return array_pick(s, 1, 2), (array_pick(s, 3, 4) - array_pick(s, 1, 4)) / F.lit(IQR_TO_SIGMA)


def array_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def array_mean_std(arr: Column) -> tuple[Column, Column]:
    """Mean and sample standard deviation of an array."""
    n = F.size(arr)
    mean = F.try_divide(array_sum(arr), n)
    ss = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return mean, F.sqrt(F.try_divide(ss, n - 1))


# ---------------------------------------------------------------- groups

def with_image(df: DataFrame, value: str, name: str = "__i") -> DataFrame:
    """Add the 64-bit image of a double that is neither null nor NaN: a long that sorts as the values do, 0 for zero.

    The exponent is guessed by a logarithm and mended by exact divisions by powers of
    two, so that exponent and mantissa are the double's own; all of it stays in generated code.
    """
    m = F.abs(F.col(value))
    d = df.withColumn("__e", F.coalesce(F.least(F.greatest(F.floor(F.log2(F.least(m, F.lit(_LARGEST)))), F.lit(-1022)), F.lit(1023)), F.lit(-1022)))
    d = d.withColumn("__x", m * F.pow(F.lit(2.0), -F.col("__e").cast("double")))  # powers of two are exact
    up, down = F.col("__x") >= 2, (F.col("__x") < 1) & (F.col("__e") > -1022)
    e = F.col("__e") + F.when(up, 1).when(down, -1).otherwise(0)
    x = F.when(up, F.col("__x") / 2).when(down, F.col("__x") * 2).otherwise(F.col("__x"))
    bits = F.when(m == _INF, F.lit(2047 * _MANTISSA)).otherwise((e + 1022) * F.lit(_MANTISSA) + F.when(m < _INF, x * F.lit(float(_MANTISSA))).cast("long"))
    return d.withColumn(name, F.when(F.col(value) < 0, -bits).otherwise(bits)).drop("__e", "__x")


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, __v, __n): values and how often each counts, NaN and null dropped. Equal values may be in several rows."""
    v = F.col(value).cast("double")
    return (
        df.select(*keys, (v + F.lit(0.0)).alias("__v"), F.lit(1).cast("long").alias("__n"))
        .where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    )


def select_ranks(
    counts: DataFrame, keys: Sequence[str], ranks: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """Exact values at given ranks of each group, all ranks in one call.

    ``counts`` comes from :func:`value_counts`; ``ranks`` maps an output name to
    a function of the group size giving a 0-based rank.  Returns one row per
    group: keys, ``n`` and one column per rank.

    The values are written once with their images. Each of four passes counts the next
    16 bits of the images whose higher bits are those of a wanted rank, so what is
    shuffled are counts summed in the tasks, and a window runs over at most 65,536 of them.
    """
    keys = list(keys)
    if not keys:
        return select_ranks(counts.withColumn("__all", F.lit(0)), ["__all"], ranks).drop("__all")
    return _ranks(cut_lineage(with_image(counts, "__v")), keys, ranks)


def _ranks(data: DataFrame, keys: list[str], ranks: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """The passes of :func:`select_ranks` over a written table of values with their images."""
    part = [*keys, "__p"]
    run = Window.partitionBy(*part)
    wanted = None
    for shift in range(64 - _DIGIT, -1, -_DIGIT):
        if wanted is None:
            here = data.withColumn("__p", F.lit(0).cast("long"))
        else:
            here = data.withColumn("__p", F.shiftright("__i", shift + _DIGIT)).join(wanted.select(*part), part, "left_semi")
        value = [] if shift else [F.max("__v").alias("__v")]
        hist = here.groupBy(*part, F.shiftright("__i", shift).alias("__d")).agg(F.sum("__n").alias("__m"), *value)
        hist = hist.withColumn("__cum", F.sum("__m").over(run.orderBy("__d")))
        if wanted is None:
            each = F.array(*[F.struct(F.lit(name).alias("__name"), F.floor(fn(F.col("n"))).cast("long").alias("__rank")) for name, fn in ranks.items()])
            found = hist.withColumn("n", F.sum("__m").over(run)).withColumn("__w", F.explode(each)).select("*", "__w.*")
        else:
            found = hist.join(wanted, part)
        before = F.col("__cum") - F.col("__m")
        found = found.where((before <= F.col("__rank")) & (F.col("__rank") < F.col("__cum")))
        found = found.select(*keys, "n", "__name", (F.col("__rank") - before).alias("__rank"), F.col("__d").alias("__p"), *([] if shift else ["__v"]))
        # a written table has a known size, so the next pass sends it to the tasks if it is small
        wanted = cut_lineage(found) if shift else found
    return wanted.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("__name") == name, F.col("__v"))).alias(name) for name in ranks],
    )


QUARTILES = {"q1": lambda n: n / 4, "q2": lambda n: n / 2, "q3": lambda n: n * 3 / 4}
MIDDLE = {"lo": lambda n: (n - 1) / 2, "hi": lambda n: n / 2}


def grouped_robust(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per group: ``n``, ``median`` (element n/2) and ``sigma`` from the quartile elements."""
    r = select_ranks(value_counts(df, keys, value), keys, QUARTILES)
    return r.select(*keys, "n", F.col("q2").alias("median"),
                    ((F.col("q3") - F.col("q1")) / F.lit(IQR_TO_SIGMA)).alias("sigma"))


def grouped_median(counts: DataFrame, keys: Sequence[str], name: str = "median") -> DataFrame:
    """Per group median; an even count averages the two middle values."""
    r = select_ranks(counts, keys, MIDDLE)
    return r.select(*keys, "n", ((F.col("lo") + F.col("hi")) / 2).alias(name))


def grouped_madfm(df: DataFrame, keys: Sequence[str], value: str, qs: Mapping[str, float] | None = None) -> DataFrame:
    """Per group: ``n``, ``median``, ``madfm`` and ``sigma`` = madfm / 0.6744888, and quantiles found along with the median."""
    keys = list(keys)
    if not keys:
        return grouped_madfm(df.withColumn("__all", F.lit(0)), ["__all"], value, qs).drop("__all")
    counts = cut_lineage(with_image(value_counts(df, keys, value), "__v"))
    ranks, cols = _quantile_ranks(qs or {})
    r = _ranks(counts, keys, {**MIDDLE, **ranks})
    med = cut_lineage(r.select(*keys, "n", ((F.col("lo") + F.col("hi")) / 2).alias("median"), *cols))
    dev = counts.join(med.select(*keys, "median"), keys).select(*keys, F.abs(F.col("__v") - F.col("median")).alias("__v"), "__n")
    # an infinite value less an infinite median is no number
    mad = grouped_median(dev.where(~F.isnan("__v")), keys, "madfm").drop("n")
    return med.join(mad, keys).withColumn("sigma", F.col("madfm") / F.lit(MADFM_TO_SIGMA))


def _quantile_ranks(qs: Mapping[str, float]) -> tuple[dict[str, Callable[[Column], Column]], list[Column]]:
    """Ranks about each quantile, and the columns that interpolate between them."""
    ranks: dict[str, Callable[[Column], Column]] = {}
    cols = []
    for name, q in qs.items():
        ranks[f"__lo_{name}"] = lambda n, q=q: F.floor((n - 1) * F.lit(q))
        ranks[f"__hi_{name}"] = lambda n, q=q: F.ceil((n - 1) * F.lit(q))
        pos = (F.col("n") - 1) * F.lit(q)
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        cols.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return ranks, cols


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Mapping[str, float]) -> DataFrame:
    """Per group quantiles with linear interpolation between neighbours."""
    keys = list(keys)
    ranks, cols = _quantile_ranks(qs)
    return select_ranks(value_counts(df, keys, value), keys, ranks).select(*keys, "n", *cols)
