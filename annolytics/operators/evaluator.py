"""Classifier quality: reliability bins, derived accuracy, truncation shares, ROC AUC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bin_no(p: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(9), F.floor(p * 10).cast("int")))


def bin_label(b: Column) -> Column:
    """X12: '[0.0,0.1)' to '[0.9,1.0]'."""
    lo, hi = F.format_string("%.1f", b / 10.0), F.format_string("%.1f", (b + 1) / 10.0)
    return F.concat(F.lit("["), lo, F.lit(","), hi, F.when(b == 9, F.lit("]")).otherwise(F.lit(")")))


def calibration_bins(df: DataFrame, p: str, truth: str) -> DataFrame:
    """Bin, n, mean_predicted, fraction_true; empty bins are absent. Null probabilities or truths don't count."""
    d = df.where(F.col(p).isNotNull() & F.col(truth).isNotNull()).withColumn("b", bin_no(F.col(p)))
    g = d.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("m"), F.avg(F.col(truth).cast("int")).alias("f"))
    return g.select(bin_label(F.col("b")).alias("bin"), "n", F.round("m", 6).alias("mean_predicted"), F.round("f", 6).alias("fraction_true"))


def derived_accuracy(df: DataFrame, n: str, prevalence: str, recall: str, predicted: str, tolerance: float = 0.01) -> DataFrame:
    """Accuracy from rates, by way of counts that must be whole; null with a note where nothing is predicted."""
    P, TP, PP = F.col(n) * F.col(prevalence), F.col(n) * F.col(prevalence) * F.col(recall), F.col(n) * F.col(predicted)
    far = F.greatest(*[F.abs(x - F.round(x)) for x in (P, TP, PP)]) > tolerance
    acc = (F.round(TP) + (F.col(n) - F.round(P) - (F.round(PP) - F.round(TP)))) / F.col(n)
    none = F.col(predicted) == 0
    return df.withColumn("accuracy", F.when(none, F.lit(None)).when(far, F.raise_error(F.lit("counts aren't whole")).cast("double")).otherwise(F.round(acc, 6))).withColumn("note", F.when(none, "nothing predicted"))


def truncation(df: DataFrame, length: Column, limits: tuple[int, ...]) -> DataFrame:
    """Per limit the share of texts that are longer, with the median and the largest length. One pass for all limits."""
    d = df.select(length.alias("x")).where("x IS NOT NULL")
    row = d.agg(F.count(F.lit(1)).alias("n"), F.percentile("x", F.lit(0.5)).alias("median"), F.max("x").alias("longest"), *[F.avg((F.col("x") > k).cast("int")).alias(str(k)) for k in limits])
    u = row.unpivot(["n", "median", "longest"], [f"`{k}`" for k in limits], "lim", "share")
    return u.select(F.col("lim").cast("int").alias("max_length"), "n", "median", "longest", F.round("share", 6).alias("share_longer"))


def roc_auc(df: DataFrame, score: str, truth: str) -> DataFrame:
    """Area under the ROC curve by counts per distinct score (ties count half); null without both classes. The scores
    are counted first, and the running sums go over ranges of distinct values, none over all of them."""
    from annolytics.operators.consolidate import running_before

    g = df.where(F.col(score).isNotNull() & F.col(truth).isNotNull()).groupBy(F.col(score).alias("__x")).agg(F.count_if(truth).cast("double").alias("p"), F.count_if(~F.col(truth)).cast("double").alias("q"))
    g = running_before(g, "__x", "q", "below")
    return g.agg(F.sum("p").alias("P"), F.sum("q").alias("N"), F.sum(F.col("p") * (F.col("below") + F.col("q") / 2)).alias("u")).select(F.round(F.try_divide("u", F.col("P") * F.col("N")), 6).alias("roc_auc"))
