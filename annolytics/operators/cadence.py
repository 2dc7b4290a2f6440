"""Cadence: gaps between a rater's events, guarded by a session threshold.

Gaps are taken per user with lag; a user with very many events is split by time: only the last event of each earlier
bucket is carried over, so no window runs over a whole user (or, for the global stream, over the whole table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_S = 86_400


def gaps(events: DataFrame, keys: tuple[str, ...], us: str, record: str, bucket_s: int = BUCKET_S) -> DataFrame:
    """(keys, after_record, before_record, us, gap_us) for each pair of consecutive events; ties by record.

    Events are ordered within (keys, bucket); the last event of each bucket is handed to the next bucket that has events,
    through a window over one row per bucket."""
    e = events.select(*keys, F.col(us).alias("us"), F.col(record).alias("rec")).withColumn("bucket", F.floor(F.col("us") / (bucket_s * 1_000_000)))
    cell = Window.partitionBy(*keys, "bucket").orderBy("us", "rec")
    last = e.groupBy(*keys, "bucket").agg(F.max(F.struct("us", "rec")).alias("last"))
    carry = last.select(*keys, "bucket", F.lag("last").over(Window.partitionBy(*keys).orderBy("bucket") if keys else Window.orderBy("bucket")).alias("carry"))
    j = e.join(carry, [*keys, "bucket"])
    prev = F.coalesce(F.lag(F.struct("us", "rec")).over(cell), F.col("carry"))
    return j.withColumn("prev", prev).where("prev IS NOT NULL").select(*keys, F.col("prev.rec").alias("after_record"), F.col("rec").alias("before_record"), "us", (F.col("us") - F.col("prev.us")).alias("gap_us"))


def summary(events: DataFrame, keys: tuple[str, ...], us: str, record: str, threshold_s: int, min_events: int = 5) -> DataFrame:
    """Per key n_events, n_gaps_total, n_gaps_used (within the threshold), n_sessions, longest_pause_s and, where
    there are min_events events and a used gap, median, mean, p25, p75 of the used gaps in seconds (else null). Without
    keys all events are one stream; no events give no row."""
    if not keys:
        return summary(events.withColumn("__all", F.lit(0)), ("__all",), us, record, threshold_s, min_events).drop("__all")
    limit = threshold_s * 1_000_000
    n = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_events"))
    used = F.when(F.col("gap_us") <= limit, F.col("gap_us") / 1e6)
    every = gaps(events, keys, us, record)
    g = every.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_gaps_total"), F.count(used).alias("n_gaps_used"), F.max(F.when(F.col("gap_us") > limit, F.col("gap_us") / 1e6)).alias("longest_pause_s"),
        F.avg(used).alias("mean"),
    )
    q = quantiles(every.where(F.col("gap_us") <= limit), keys, "gap_us", (0.25, 0.5, 0.75)).select(*keys, F.transform("q", lambda x: x / 1e6).alias("q"))
    j = n.join(g.join(q, [*keys], "left"), [*keys], "left").na.fill(0, ["n_gaps_total", "n_gaps_used"])
    ok = (F.col("n_events") >= min_events) & (F.col("n_gaps_used") > 0)
    stat = lambda c, name: F.round(F.when(ok, c), 1).alias(name)
    return j.select(*keys, "n_events", "n_gaps_total", "n_gaps_used", (F.col("n_gaps_total") - F.col("n_gaps_used") + 1).alias("n_sessions"), F.round("longest_pause_s", 1).alias("longest_pause_s"), stat(F.col("q")[1], "median_s"), stat(F.col("mean"), "mean_s"), stat(F.col("q")[0], "p25_s"), stat(F.col("q")[2], "p75_s"))


def pooled(events: DataFrame, keys: tuple[str, ...], user: str, us: str, record: str, threshold_s: int, min_gaps: int = 5, quartiles: bool = False) -> DataFrame:
    """Used gaps of all users together, per keys: n_gaps_used, median_s, mean_s and, if asked for, p25_s and p75_s;
    suppressed below min_gaps gaps. Gaps never cross users. Equal gaps are counted before they are ordered (see
    `quantiles`), so no key's gaps have to fit one task. Without keys all gaps are one stream; no events give no row."""
    if not keys:
        return pooled(events.withColumn("__all", F.lit(0)), ("__all",), user, us, record, threshold_s, min_gaps, quartiles).drop("__all")
    limit = threshold_s * 1_000_000
    used = gaps(events, (*keys, user), us, record).where(F.col("gap_us") <= limit)
    none = events.select(*keys).distinct()
    parts = (0.25, 0.5, 0.75) if quartiles else (0.5,)
    q = quantiles(used, keys, "gap_us", parts)
    ok = F.col("n_gaps_used") >= min_gaps
    names = {0.25: "p25_s", 0.5: "median_s", 0.75: "p75_s"}
    j = none.join(q, [*keys], "left").withColumn("n_gaps_used", F.coalesce("n", F.lit(0)))
    stat = lambda c, name: F.round(F.when(ok, c / 1e6), 1).alias(name)
    return j.select(*keys, "n_gaps_used", stat(F.col("mean"), "mean_s"), *[stat(F.col("q")[i], names[p]) for i, p in enumerate(parts)])


#: Width of the bins in which the values of a key are counted before the wanted ranks are looked up.
BINS = 4096


def quantiles(df: DataFrame, keys: tuple[str, ...], value: str, parts: tuple[float, ...]) -> DataFrame:
    """(keys, n, mean, q): exact quantiles, linear between neighbours (type 7), of a whole-number value per key.

    No key's values are gathered in one task: the range of each key is cut into BINS bins, the bins are counted (at most
    BINS rows a key), the running counts tell which bins hold the two neighbours of each part, and only their values are
    counted again, one row per different value. Nulls don't count; keys without values have no row."""
    if not keys:
        return quantiles(df.withColumn("__all", F.lit(0)), ("__all",), value, parts).drop("__all")
    d = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("bigint").alias("__v"))
    ends = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("__v").alias("mean"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    width = F.greatest(F.lit(1), F.ceil((F.col("__hi") - F.col("__lo") + 1) / BINS))
    at = F.floor((F.col("__v") - F.col("__lo")) / width).cast("int")
    binned = d.join(ends, [*keys]).withColumn("__b", at)
    from pyspark.sql import Window

    running = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    counts = binned.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__c"), F.first("n").alias("n")).withColumn("__to", F.sum("__c").over(running))
    rank = lambda p: (F.col("n") - 1) * p
    low = [F.floor(rank(p)) for p in parts]
    wanted = F.lit(False)
    for r in low:  # ranks from 0; a bin holds the ranks from __to - __c to __to - 1
        for k in (r, F.least(r + 1, F.col("n") - 1)):
            wanted = wanted | ((k >= F.col("__to") - F.col("__c")) & (k < F.col("__to")))
    hit = counts.where(wanted).select(*keys, "__b", (F.col("__to") - F.col("__c")).alias("__before"))
    values = binned.join(hit, [*keys, "__b"]).groupBy(*keys, "__b", "__v").agg(F.count(F.lit(1)).alias("__c"), F.first("__before").alias("__before"), F.first("n").alias("n"))
    inside = Window.partitionBy(*keys, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    values = values.withColumn("__to", F.sum("__c").over(inside) + F.col("__before"))
    holds = lambda k: (k >= F.col("__to") - F.col("__c")) & (k < F.col("__to"))
    value_at = lambda k: F.max(F.when(holds(k), F.col("__v").cast("double")))
    pair = [x for p in parts for x in (value_at(F.floor(rank(p))), value_at(F.least(F.floor(rank(p)) + 1, F.col("n") - 1)))]
    got = values.groupBy(*keys).agg(F.first("n").alias("__n"), *[x.alias(f"__{i}") for i, x in enumerate(pair)])
    q = [F.col(f"__{2 * i}") + (F.col(f"__{2 * i + 1}") - F.col(f"__{2 * i}")) * ((F.col("__n") - 1) * p - F.floor((F.col("__n") - 1) * p)) for i, p in enumerate(parts)]
    return ends.select(*keys, "n", "mean").join(got.select(*keys, F.array(*q).alias("q")), [*keys])
