"""Panel metrics and label rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolytics.functions.intervals import wilson

#: metric -> labels it rests on
SOURCES = {
    "topical_precision_at_k": ("topically_relevant",), "sufficiency_hit_at_k": ("evidence_sufficient",), "sufficiency_rate_at_k": ("evidence_sufficient",),
    "misleading_context_rate_at_k": ("misleading",), "mean_reciprocal_rank_at_k": ("topically_relevant",), "ndcg_at_k": ("topically_relevant", "evidence_sufficient"),
}


def complete_panels(items: DataFrame, panel: str, chunk: str, k: str) -> DataFrame:
    """(panel, complete): complete where as many different chunks have a label as were retrieved."""
    return items.groupBy(panel).agg((F.count_distinct(chunk) == F.max(k)).alias("complete"))


def panel_metrics(items: DataFrame, panel: str, chunk: str, rank: str, k: str) -> DataFrame:
    """M1-M5 and M10 over items with 0/1 labels: one row with the metrics over complete panels, their number and the
    number skipped. Means over panels, two-level. Metrics are null where no panel is complete."""
    p = items.groupBy(panel).agg(
        (F.count_distinct(chunk) == F.max(k)).alias("complete"), F.avg("topically_relevant").alias("rel"), F.max("evidence_sufficient").alias("hit"), F.avg("evidence_sufficient").alias("suf"),
        F.avg("misleading").alias("mis"), F.coalesce(1.0 / F.min(F.when(F.col("topically_relevant") == 1, F.col(rank))), F.lit(0.0)).alias("rr"),
    )
    ok = F.col("complete")
    mean = lambda c: F.round(F.avg(F.when(ok, F.col(c))), 6)
    return p.agg(
        F.count_if(ok).alias("n_panels"), F.count_if(~ok).alias("n_panels_skipped"), mean("rel").alias("topical_precision_at_k"), mean("hit").alias("sufficiency_hit_at_k"),
        mean("suf").alias("sufficiency_rate_at_k"), mean("mis").alias("misleading_context_rate_at_k"), mean("rr").alias("mean_reciprocal_rank_at_k"),
    )


def ndcg(items: DataFrame, panel: str, rank: str, gain: Column) -> DataFrame:
    """M6: (panel, ndcg) with gains discounted by log2(rank + 1) against the best order; 0 where no chunk has a gain.

    Panels are small (a query's retrieved chunks), so the windows sort few rows each."""
    g = items.withColumn("g", gain.cast("double"))
    at = Window.partitionBy(panel)
    g = g.withColumn("r", F.row_number().over(at.orderBy(rank, F.col("g").desc()))).withColumn("i", F.row_number().over(at.orderBy(F.col("g").desc())))
    s = g.groupBy(panel).agg(F.sum(F.col("g") / F.log2(F.col("r") + 1)).alias("dcg"), F.sum(F.col("g") / F.log2(F.col("i") + 1)).alias("ideal"))
    return s.select(panel, F.round(F.coalesce(F.try_divide("dcg", "ideal"), F.lit(0.0)), 6).alias("ndcg"))


def rates(items: DataFrame, labels: tuple[str, ...], level: float = 0.95) -> DataFrame:
    """M7/M9: per label n, k, rate and its Wilson interval."""
    m = items.unpivot([], [*labels], "label", "value").groupBy("label").agg(F.count("value").alias("n"), F.sum("value").cast("bigint").alias("k"))
    lo, hi = wilson("k", "n", level)
    return m.select("label", "n", "k", F.round(F.col("k") / F.col("n"), 6).alias("rate"), F.round(lo, 6).alias("ci_lower"), F.round(hi, 6).alias("ci_upper"))


def conditional_rate(items: DataFrame, given: str, then: str) -> DataFrame:
    """M8: share of `then` among items with `given`; null where there are none."""
    n, k = F.count_if(F.col(given) == 1), F.count_if((F.col(given) == 1) & (F.col(then) == 1))
    return items.agg(n.alias("n"), k.alias("k")).withColumn("rate", F.round(F.try_divide("k", "n"), 6))


#: constraint -> predicate of a violation over 0/1 labels
CONSTRAINTS = {
    "sufficient_implies_relevant": "evidence_sufficient = 1 AND topically_relevant = 0",
    "sufficient_excludes_misleading": "evidence_sufficient = 1 AND misleading = 1",
    "contradicted_implies_unsupported": "contradicted_claim_present = 1 AND unsupported_claim_present = 0",
    "fabricated_implies_cited": "fabricated_source = 1 AND source_cited = 0",
}


def violations(items: DataFrame, constraints: tuple[str, ...]) -> DataFrame:
    """(constraint_id, n_violations, n_rows), one row per constraint, 0 where it always holds."""
    row = items.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.expr(CONSTRAINTS[c])).alias(c) for c in constraints])
    return row.unpivot(["n_rows"], [*constraints], "constraint_id", "n_violations").select("constraint_id", "n_violations", "n_rows")


def weakest_alpha(metrics: dict[str, tuple[str, ...]], alphas: DataFrame) -> DataFrame:
    """Per metric the source label with the smallest alpha (ties by name); nulls where none has an alpha."""
    spark = alphas.sparkSession
    m = spark.createDataFrame([(k, l) for k, v in metrics.items() for l in v], "metric string, label string")
    j = m.join(alphas, "label", "left").groupBy("metric").agg(F.min(F.when(F.col("alpha").isNotNull(), F.struct("alpha", "label", "n_items", "degenerate"))).alias("w"))
    return j.select("metric", F.col("w.alpha").alias("alpha_min"), F.col("w.label").alias("alpha_min_label"), F.col("w.n_items").alias("alpha_min_n"), F.col("w.degenerate").alias("alpha_min_degenerate"))


def status_scaffold(scaffold: DataFrame, raw: DataFrame, kept: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """A row for every combination expected: n_raw, n_kept and status 'no_data', 'no_rows_after_filter' or 'ok'."""
    a, b = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_raw")), kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_kept"))
    j = scaffold.join(a, [*keys], "left").join(b, [*keys], "left").na.fill(0, ["n_raw", "n_kept"])
    return j.withColumn("status", F.when(F.col("n_raw") == 0, "no_data").when(F.col("n_kept") == 0, "no_rows_after_filter").otherwise("ok"))
