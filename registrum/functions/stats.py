"""Statistics as column expressions and small aggregations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rounded(c: Column, digits: int = 4) -> Column:
    """Half up on the binary value: the same in every engine, unlike round()."""
    return F.floor(c * 10.0**digits + 0.5) / 10.0**digits


def rate(condition: Column) -> Column:
    """Share of rows where the condition holds; rows where it is null do not count."""
    return F.avg(condition.cast("int").cast("double"))


def packed(conditions: Sequence[Column]) -> Column:
    """Conditions, true, false or null, as one number of two bits each: rows that move stay narrow."""
    return reduce(lambda a, b: a + b, (F.coalesce(c.cast("int"), F.lit(2)).cast("long") * 4**k for k, c in enumerate(conditions)))


def unpacked(c: Column, k: int) -> Column:
    """The condition of place k in packed()."""
    bits = F.shiftright(c, 2 * k).bitwiseAND(F.lit(3))
    return F.when(bits != 2, bits == 1)


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson interval, within 0 and 1; (0, 0) for n = 0."""
    k, n = k.cast("double"), F.nullif(n, F.lit(0)).cast("double")
    p = k / n
    centre = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    lo, hi = F.greatest(F.lit(0.0), centre - half), F.least(F.lit(1.0), centre + half)
    return F.coalesce(rounded(lo), F.lit(0.0)), F.coalesce(rounded(hi), F.lit(0.0))


def safe_corr(x: str, y: str) -> Column:
    """Pearson's r; null where either side does not vary."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    flat = (F.stddev_pop(F.when(both, F.col(x))) == 0) | (F.stddev_pop(F.when(both, F.col(y))) == 0)
    cov = F.covar_pop(x, y)
    return F.when(~flat, F.try_divide(cov, F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))))


PARTS = 64


def running(df: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, value, n, before, total): rows of each distinct value, rows of lesser ones and all rows of its group; nulls left out.

    No task sorts a group: distinct values fall into PARTS ranges between sampled quantiles, the
    ranges' totals are summed first, and a window runs inside each range only.
    """
    keys = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    cuts = counts.agg(F.percentile_approx(value, [k / PARTS for k in range(1, PARTS)], 1000).alias("__cuts"))
    counts = counts.join(F.broadcast(cuts)).withColumn("__p", F.expr(f"size(filter(coalesce(__cuts, array()), c -> c < `{value}`))")).drop("__cuts")  # one row of cuts
    totals = counts.groupBy(*keys, "__p").agg(F.sum("n").alias("__t"))
    group = W.partitionBy(*keys)
    totals = totals.select(*keys, "__p", (F.sum("__t").over(group.orderBy("__p")) - F.col("__t")).alias("__base"), F.sum("__t").over(group).alias("total"))  # PARTS rows a group
    inside = W.partitionBy(*keys, "__p").orderBy(value)
    counts = counts.withColumn("__in", F.sum("n").over(inside) - F.col("n")).join(totals, [*keys, "__p"])
    return counts.select(*keys, value, "n", (F.col("__base") + F.col("__in")).alias("before"), "total")


def ranked(df: DataFrame, value: str, rank: str = "rank", ties: str = "min") -> DataFrame:
    """df with the rank of value over all rows: ties get their least (min) or mean (average) rank; a null has none."""
    number = F.col("before") + 1 if ties == "min" else F.col("before") + (F.col("n") + 1) / 2.0
    return df.join(running(df, value).select(value, number.alias(rank)), value, "left")


def quantiles(df: DataFrame, value: str, at: dict[str, float], by: tuple[str, ...] = (), digits: int = 4) -> DataFrame:
    """One row per group: the interpolated quantiles named in `at`, rounded; a group of any size is held by no task."""
    out = []
    for name, p in at.items():
        place = F.lit(p) * (F.col("total") - 1)
        lo, hi = F.floor(place), F.ceil(place)
        held = lambda k: F.max(F.when((F.col("before") <= k) & (k < F.col("before") + F.col("n")), F.col(value)))
        a, b = held(lo), held(hi)
        out.append(rounded(a + (b - a) * F.max(place - lo), digits).alias(name))
    return running(df, value, by).groupBy(*by).agg(*out)


def auc(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """One row: n_pos, n_neg and auc, the rank-sum statistic with mean ranks; null auc for a missing class."""
    rows = ranked(df.where(F.col(score).isNotNull()).withColumn("__y", positive.cast("int")).where("__y is not null"), score, "__r", "average")
    agg = rows.agg(F.coalesce(F.sum("__y"), F.lit(0)).cast("long").alias("n_pos"), F.coalesce(F.sum(1 - F.col("__y")), F.lit(0)).cast("long").alias("n_neg"), F.sum(F.when(F.col("__y") == 1, F.col("__r"))).alias("s"))
    n1, n0 = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    return agg.select("n_pos", "n_neg", F.try_divide(F.col("s") - n1 * (n1 + 1) / 2, n1 * n0).alias("auc"))


def order_statistic(df: DataFrame, value: str, p: float, out: str) -> DataFrame:
    """One row: the value at index int(p * (n - 1)) of the sorted values, without interpolation."""
    at = running(df, value).where(F.col("before") + F.col("n") > F.floor(F.lit(p) * (F.col("total") - 1)))
    return at.agg(F.min(value).alias(out))
