"""Keep-lists, record differences, pins, as-of lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prune(live: DataFrame, keep: DataFrame, key: str) -> DataFrame:
    """(key, state): 'kept', 'deleted' (live only) or 'missing' (on the keep-list only); one row per key."""
    a, b = live.select(key).distinct().withColumn("__live", F.lit(True)), keep.select(key).distinct().withColumn("__keep", F.lit(True))
    j = a.join(b, key, "full_outer")
    return j.select(key, F.when(F.col("__live") & F.col("__keep"), "kept").when(F.col("__live"), "deleted").otherwise("missing").alias("state"))


def latest_wins(lists: DataFrame, dataset: str, bundle: str) -> DataFrame:
    """Rows of each dataset's latest bundle only; a later list replaces an earlier one whole."""
    last = lists.groupBy(dataset).agg(F.max(bundle).alias(bundle))
    return lists.join(last, [dataset, bundle], "left_semi")


def diff(live: DataFrame, backup: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """(key, status, changed): 'new' (backup only), 'extra' (live only), 'identical' or 'updated' with the names
    of the columns that differ, in order. Nulls equal nulls. Keys must be unique on either side."""
    l, b = (d.select(F.col(key), *[F.col(c).alias(f"{p}_{c}") for c in columns], F.lit(True).alias(p)) for d, p in ((live, "l"), (backup, "b")))
    j = l.join(b, key, "full_outer")
    names = F.filter(F.array(*[F.when(~F.col(f"l_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in columns]), lambda x: x.isNotNull())
    both = F.col("l").isNotNull() & F.col("b").isNotNull()
    changed = F.when(both, F.array_join(names, ",")).otherwise(F.lit(""))
    return j.select(key, F.when(F.col("l").isNull(), "new").when(F.col("b").isNull(), "extra").when(changed == "", "identical").otherwise("updated").alias("status"), changed.alias("changed"))


def restore(live: DataFrame, backup: DataFrame, key: str, columns: tuple[str, ...], only: tuple[str, ...]) -> DataFrame:
    """Live rows with the columns in `only` taken from the backup; other columns, and rows without a backup, stay."""
    b = backup.select(key, *[F.col(c).alias(f"b_{c}") for c in only], F.lit(True).alias("__b"))
    j = live.select(key, *columns).join(b, key, "left")
    return j.select(key, *[F.when(F.col("__b"), F.col(f"b_{c}")).otherwise(F.col(c)).alias(c) if c in only else F.col(c) for c in columns])


def verify_pins(pins: DataFrame, files: DataFrame, path: str, digest: str) -> DataFrame:
    """(path, state): 'OK', 'MISMATCH' or 'ABSENT' for every pin."""
    f = files.select(path, F.col(digest).alias("__d"))
    return pins.join(f, path, "left").select(path, F.when(F.col("__d").isNull(), "ABSENT").when(F.col("__d") == F.col(digest), "OK").otherwise("MISMATCH").alias("state"))


def next_snapshot(exports: DataFrame, snapshots: DataFrame, at: str, run: str, max_lag_s: int, bucket_s: int | None = None) -> DataFrame:
    """For each export the first snapshot strictly after it; null where none follows within max_lag_s.

    An equi-join on time buckets of the largest lag: each export meets its own bucket and the next one only."""
    width = (bucket_s or max_lag_s) * 1_000_000
    e = exports.withColumn("__b", F.explode(F.array(*[F.floor(F.col(at) / width) + i for i in range(-(-max_lag_s * 1_000_000 // width) + 1)])))
    s = snapshots.select(F.col(run).alias("__r")).withColumn("__b", F.floor(F.col("__r") / width))
    ok = (F.col("__r") > F.col(at)) & (F.col("__r") - F.col(at) <= max_lag_s * 1_000_000)
    return e.join(s, "__b", "left").groupBy(*exports.columns).agg(F.min(F.when(ok, F.col("__r"))).alias("snapshot_us"))


def latest_run(runs: DataFrame, keys: tuple[str, ...], at: str, run_id: str) -> DataFrame:
    """The newest run of each key; ties go to the greater run id."""
    return runs.groupBy(*keys).agg(F.max(F.struct(at, run_id)).alias("m")).select(*keys, F.col(f"m.{at}").alias(at), F.col(f"m.{run_id}").alias(run_id))


def checksum(df: DataFrame, key: str, n: str):
    """sha256 over the sorted 'key:count' lines, for rollups that fit one row (a catalogue's keys)."""
    return df.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", key, n))), "\n"), 256).alias("checksum"))
