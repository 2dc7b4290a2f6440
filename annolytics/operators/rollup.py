"""Counts pooled over hierarchies; rates are computed after pooling, never averaged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup(df: DataFrame, top: str, sub: str, aggregates: list[Column]) -> DataFrame:
    """The aggregates at (top, sub), (top), (sub) and (), with `level` naming the grouping. Distinct counts are
    taken anew at each level. Nulls among the keys stay groups of their own, told apart by level."""
    g = df.groupingSets([[top, sub], [top], [sub], []], top, sub).agg(F.grouping_id().alias("__g"), *aggregates)
    names = {0: f"{top},{sub}", 1: top, 2: sub, 3: "total"}
    level = F.element_at(F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))]), F.col("__g").cast("int"))
    return g.withColumn("level", level).drop("__g")


def weighted_mean(value: str, weight: str) -> Column:
    """Weighted mean, 0 where the weights sum to 0."""
    return F.coalesce(F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(F.when(F.col(value).isNotNull(), F.col(weight)))), F.lit(0.0))


def annotator_bias(ratings: DataFrame, keys: tuple[str, ...], rater: str, value: str = "value", least_n: int = 5, least_delta: float = 0.2) -> DataFrame:
    """Per keys and rater n, prevalence, its distance from the pool and whether that is substantial. Groups with one
    rater only are left out."""
    r = ratings.where(F.col(value).isNotNull())
    own = r.groupBy(*keys, rater).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("p"))
    pool = r.groupBy(*keys).agg(F.avg(value).alias("pool"), F.count_distinct(rater).alias("raters")).where("raters >= 2")
    d = F.col("p") - F.col("pool")
    return own.join(pool, [*keys]).select(*keys, rater, "n", F.round("p", 6).alias("prevalence"), F.round(d, 6).alias("delta"), ((F.abs(d) >= least_delta) & (F.col("n") >= least_n)).alias("substantial"))
