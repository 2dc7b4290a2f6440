"""Interval estimates as column arithmetic."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wilson(k: str, n: str, level: float = 0.95) -> tuple[Column, Column]:
    """Wilson score interval for k of n; null where n is 0."""
    z = 1.96 if level == 0.95 else NormalDist().inv_cdf(0.5 + level / 2)
    nn, p = F.col(n).cast("double"), F.try_divide(F.col(k).cast("double"), F.col(n).cast("double"))
    den = 1 + F.try_divide(F.lit(z * z), nn)
    mid = (p + F.try_divide(F.lit(z * z), 2 * nn)) / den
    half = z * F.sqrt(F.try_divide(p * (1 - p), nn) + F.try_divide(F.lit(z * z), 4 * nn * nn)) / den
    return F.when(nn > 0, F.greatest(F.lit(0.0), mid - half)), F.when(nn > 0, F.least(F.lit(1.0), mid + half))


def bootstrap_mean(df: DataFrame, value: str, index: str, n: int, resamples: int, seed: int = 0, level: float = 0.95) -> DataFrame:
    """Percentile interval of the mean of `value` over rows numbered 0..n-1 in `index`: mean, ci_lower, ci_upper.

    The i-th draw of resample b is the row md5(seed:b:i) mod n, so results don't depend on partitioning. Work grows
    with resamples * n: meant for item tables. Draws stay distributed; resample means alone are sorted."""
    spark = df.sparkSession
    draws = spark.range(resamples * n).select((F.col("id") / n).cast("long").alias("b"), (F.col("id") % n).alias("i"))
    slot = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "b", "i")), 1, 8), 16, 10).cast("long") % n
    picked = draws.select("b", slot.alias(index)).join(df.select(F.col(index).cast("long").alias(index), F.col(value).cast("double").alias("v")), index)
    means = picked.groupBy("b").agg(F.avg("v").alias("m"))
    lo = (1 - level) / 2
    ci = means.agg(F.percentile("m", F.lit(lo)).alias("ci_lower"), F.percentile("m", F.lit(1 - lo)).alias("ci_upper"))
    mean = df.agg(F.avg(F.col(value).cast("double")).alias("mean"))
    return mean.unionByName(ci, allowMissingColumns=True).agg(*[F.round(F.max(c), 6).alias(c) for c in ("mean", "ci_lower", "ci_upper")])
