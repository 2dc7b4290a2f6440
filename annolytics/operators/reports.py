"""Report tables: one row for each combination expected, counts pooled before they are divided, fixed column orders.

The long form of responses has one row per response: domain, task, record_uuid, item (chunk or ''), annotator_id, status,
cal, record_status, us (time in microseconds), reason, notes. What was never measured is null, what was measured and not
found is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = ("unspecified", "other", "unclear_query", "broken_text", "off_topic")


def record_counts(x: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Record grain: records (items), completed and pending ones; response grain: submitted and discarded; annotators.

    An item is completed when one of its rows says so. Two aggregates, the first with a map-side part, so a hot item or
    domain is never one task's rows."""
    item = x.groupBy(*keys, "record_uuid", "item").agg(
        F.bool_or(F.col("record_status") == "completed").alias("done"), F.count_if(F.col("status") == "submitted").alias("sub"), F.count_if(F.col("status") == "discarded").alias("dis")
    )
    c = item.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_records"), F.count_if("done").alias("n_completed"), F.count_if(~F.coalesce("done", F.lit(False))).alias("n_pending"),
        F.sum("sub").alias("n_submitted"), F.sum("dis").alias("n_discarded"), F.count_if(F.col("sub") > 0).alias("n_items_annotated"),
    )
    who = x.where("annotator_id IS NOT NULL").groupBy(*keys, "annotator_id").agg(F.lit(1)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_annotators"))
    return c.join(who, [*keys], "left").na.fill(0, ["n_annotators"])


def share(k: Column | str, n: Column | str) -> Column:
    """k of n to six digits, null where n is 0."""
    return F.round(F.try_divide(k, n), 6)


def reason_counts(x: DataFrame, keys: tuple[str, ...], reasons: tuple[str, ...] = REASONS) -> DataFrame:
    """The discarded responses by reason as columns discard_<reason>, by keys; other reasons count as 'other'."""
    r = F.when(F.col("reason").isin(*reasons), F.col("reason")).otherwise("other")
    return x.where("status = 'discarded'").groupBy(*keys).agg(*[F.count_if(r == v).alias(f"discard_{v}") for v in reasons])


def breakdown(df: DataFrame, keys: tuple[str, ...], what: str, n: str, name: str) -> DataFrame:
    """X16: 'reason 12, other 3' of the counts n by `what`, most first, then by name."""
    g = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct((-F.col(n)).alias("m"), F.col(what).alias("w")))).alias("x"))
    return g.select(*keys, F.array_join(F.transform("x", lambda y: F.concat_ws(" ", y["w"], (-y["m"]).cast("string"))), ", ").alias(name))


def percent(c: Column) -> Column:
    """A share as '12.3 %', '-' where there is none."""
    return F.coalesce(F.concat(F.format_string("%.1f", F.round(c * 100, 1)), F.lit(" %")), F.lit("-"))


def thousands(c: Column) -> Column:
    """Whole numbers with commas between the thousands, '-' where there is none."""
    return F.coalesce(F.format_number(c, 0), F.lit("-"))


def label_stats(ratings: DataFrame, keys: tuple[str, ...], near: float = 0.05) -> DataFrame:
    """N, n_true, prevalence, degenerate (no variance) and near_degenerate (the rarer value below `near`), by keys."""
    g = ratings.where("value IS NOT NULL").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("bigint").alias("n_true"))
    rare = F.least("n_true", F.col("n") - F.col("n_true"))
    return g.select(*keys, "n", "n_true", share("n_true", "n").alias("prevalence"), (rare == 0).alias("degenerate"), ((rare > 0) & (rare / F.col("n") < near)).alias("near_degenerate"))


def pooled_levels(df: DataFrame, top: str, sub: str, aggregates: list[Column], shares: dict[str, tuple[str, str]]) -> DataFrame:
    """Counts at (top, sub), (top), (sub) and (); the shares are of the pooled counts."""
    from annolytics.operators.rollup import rollup

    g = rollup(df, top, sub, aggregates)
    return g.select("*", *[share(k, n).alias(name) for name, (k, n) in shares.items()])


def in_order(df: DataFrame, *order: Column) -> DataFrame:
    """Adds position (from 1) in the order of a report table, which has as many rows as a reader can read."""
    from pyspark.sql import Window

    return df.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def metric_rows(measured: DataFrame, catalogue: DataFrame, policy: str) -> DataFrame:
    """One row for each metric of the catalogue (task, metric, source_labels, expected): point, n, n_examples,
    policy, status. 'ok' with a value; 'undefined_no_denominator' where examples exist but the metric has none;
    'no_rows_after_filter' where the filters left nothing of some rows; 'no_data' where there never were any;
    'evaluator_labels_incomplete' where a label it rests on wasn't predicted (expected is false)."""
    j = catalogue.join(measured, ["task", "metric"], "left")
    n, ex, raw = F.coalesce("n", F.lit(0)), F.coalesce("n_examples", F.lit(0)), F.coalesce("n_raw", F.lit(0))
    status = F.when(~F.col("expected"), "evaluator_labels_incomplete").when(raw == 0, "no_data").when(ex == 0, "no_rows_after_filter").when(F.col("point").isNull(), "undefined_no_denominator").otherwise("ok")
    ok = status == "ok"
    return j.select("task", "metric", F.when(ok, F.round("point", 6)).alias("point"), F.when(ok, n).otherwise(F.lit(0)).cast("bigint").alias("n"), ex.cast("bigint").alias("n_examples"), F.lit(policy).alias("policy"), "source_labels", status.alias("status"))


def policy_slug(exclude_calibration: bool, all_panels: bool, predicted: bool = False) -> str:
    """'calib' or 'prod', 'complete' or 'allpanels', with 'pred-' before it for predictions."""
    return ("pred-" if predicted else "") + ("prod" if exclude_calibration else "calib") + "-" + ("allpanels" if all_panels else "complete")
