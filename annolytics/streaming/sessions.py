"""Live sessions: the batch operator's semantics on a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolytics.sources.tables import clean_key


def session_stream(events: DataFrame, gap_s: int = 1800, watermark: str = "1 day", user: str = "user_id", at: str = "inserted_at") -> DataFrame:
    """Sessions of a streaming DataFrame (append mode): user_id, start, end, n_events. Repeats within the watermark are
    dropped. Later events than the watermark allows are dropped too, which is where it may differ from the batch.
    A pause of exactly gap_s stays within the session, as in the batch: windows that touch are merged."""
    e = events.select(clean_key(user).alias("user_id"), F.col(at).cast("timestamp").alias("at"), clean_key("record_id").alias("record_id"), clean_key("task").alias("task")).where("user_id IS NOT NULL AND at IS NOT NULL")
    e = e.withWatermark("at", watermark).dropDuplicates(["user_id", "at", "record_id", "task"])
    g = e.groupBy(F.session_window("at", f"{gap_s} seconds").alias("w"), "user_id").agg(F.min("at").alias("start"), F.max("at").alias("end"), F.count(F.lit(1)).alias("n_events"))
    return g.select("user_id", "start", "end", "n_events")
