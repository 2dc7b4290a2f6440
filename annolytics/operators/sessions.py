"""Problem 5: grouping activity into sessions by start-end pairing.

An event starts a session when no event of its user lies in the gap before it, and ends one when none lies in the gap
after it. Both facts come from RANGE frames. Starts and ends are numbered separately, equal numbers are joined, and the
number of events is the difference of the two events' own ranks plus one.

Scale: a user may hold a third of all events, so no window runs over a whole user. Events are cut into (user, time bucket)
cells; each cell also receives its neighbours' events within one gap of its edge (the halo), which is all that a RANGE
frame of one gap can see. Ranks inside a cell become ranks of the user by adding the counts of the earlier cells; those
counts are one row per cell, summed in two steps so that a user with very many cells is split as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annolytics.session import persist_table
from annolytics.sources.tables import clean_key, micros

GAP_S = 1800
BUCKET_S = 6 * 3600
CELLS_PER_BLOCK = 4096


def clean_events(df: DataFrame, user: str = "user_id", at: str = "inserted_at", same: tuple[str, ...] = ("record_id", "task")) -> DataFrame:
    """(user_id, us, *same) of the events with a user and a time. Rows without either are dropped; extra columns are ignored."""
    return df.select(
        clean_key(user).alias("user_id"), micros(at).alias("us"), *[clean_key(c).alias(f"same_{i}") for i, c in enumerate(same)]
    ).where("user_id IS NOT NULL AND us IS NOT NULL")


def _with_offsets(cells: DataFrame) -> DataFrame:
    """Exclusive running sums of n, n_start and n_end over a user's cells, in blocks of CELLS_PER_BLOCK cells."""
    block = F.floor(F.col("cell") / CELLS_PER_BLOCK)
    inner = Window.partitionBy("user_id", "block").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("user_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    cols = ("n", "n_start", "n_end")
    cells = cells.withColumn("block", block)
    blocks = cells.groupBy("user_id", "block").agg(*[F.sum(c).alias(c) for c in cols])
    blocks = blocks.select("user_id", "block", *[F.coalesce(F.sum(c).over(outer), F.lit(0)).alias(f"b_{c}") for c in cols])
    within = cells.select("user_id", "block", "cell", *[F.coalesce(F.sum(c).over(inner), F.lit(0)).alias(f"i_{c}") for c in cols])
    return within.join(blocks, ["user_id", "block"]).select("user_id", "cell", *[(F.col(f"b_{c}") + F.col(f"i_{c}")).alias(f"o_{c}") for c in cols])


def sessions(df: DataFrame, gap_s: int = GAP_S, user: str = "user_id", at: str = "inserted_at", same: tuple[str, ...] = ("record_id", "task"), bucket_s: int = BUCKET_S) -> DataFrame:
    """One row per session: user_id, session_no (from 1 within a user), start_us, end_us, duration_s, n_events.

    A pause of exactly gap_s stays within the session. Rows alike in user, time and the columns `same` are one event;
    different events at one time all count. Rows with a null or blank user or a null time don't count. Nulls in `same`
    are equal to each other. An empty table gives no rows; extra columns are ignored. bucket_s must be at least gap_s.
    """
    if bucket_s < gap_s:
        raise ValueError("bucket_s must be at least gap_s")
    gap, width = gap_s * 1_000_000, bucket_s * 1_000_000
    keys = [f"same_{i}" for i in range(len(same))]
    e = clean_events(df, user, at, same)
    own = F.floor(F.col("us") / width)
    # the cells that must see the event: its own and those whose edge lies within one gap
    e = e.withColumn("own", own).withColumn("cell", F.explode(F.array_distinct(F.array(own, F.floor((F.col("us") - gap) / width), F.floor((F.col("us") + gap) / width)))))
    # one shuffle serves the removal of repeats and every window below: (user_id, cell) is a subset of all their keys
    e = e.repartition("user_id", "cell").dropDuplicates(["user_id", "cell", "us", *keys])
    w = Window.partitionBy("user_id", "cell").orderBy("us")
    before = F.count(F.lit(1)).over(w.rangeBetween(-gap, -1))
    after = F.count(F.lit(1)).over(w.rangeBetween(1, gap))
    e = e.withColumn("before", before).withColumn("after", after).where("own = cell")
    order = Window.partitionBy("user_id", "cell").orderBy("us", *[F.col(k).asc_nulls_first() for k in keys])
    e = e.withColumn("rank", F.row_number().over(order))
    # of several events at one time the first opens the session and the last closes it
    at_time = Window.partitionBy("user_id", "cell", "us")
    e = e.withColumn("is_start", (F.col("before") == 0) & (F.col("rank") == F.min("rank").over(at_time)))
    e = e.withColumn("is_end", (F.col("after") == 0) & (F.col("rank") == F.max("rank").over(at_time)))
    # written once, for the offsets, the starts and the ends: the rows that open or close a session and each cell's last
    cell = Window.partitionBy("user_id", "cell")
    e = e.withColumn("n", F.max("rank").over(cell)).where("is_start OR is_end OR rank = n")
    e = persist_table(e.select("user_id", "cell", "us", "rank", "n", "is_start", "is_end"), "boundaries")
    offsets = _with_offsets(e.groupBy("user_id", "cell").agg(F.max("n").cast("bigint").alias("n"), F.count_if("is_start").alias("n_start"), F.count_if("is_end").alias("n_end")))
    seq = cell.orderBy("rank")
    ends = []
    for kind in ("start", "end"):
        k = e.where(f"is_{kind}").withColumn("k", F.row_number().over(seq)).join(offsets, ["user_id", "cell"])
        ends.append(k.select("user_id", (F.col("k") + F.col(f"o_n_{kind}")).alias("session_no"), F.col("us").alias(f"{kind}_us"), (F.col("rank") + F.col("o_n")).alias(f"{kind}_rank")))
    s = ends[0].join(ends[1], ["user_id", "session_no"])
    return s.select(
        "user_id", F.col("session_no").cast("bigint").alias("session_no"), "start_us", "end_us",
        ((F.col("end_us") - F.col("start_us")) / 1_000_000).alias("duration_s"),
        (F.col("end_rank") - F.col("start_rank") + 1).cast("bigint").alias("n_events"),
    )
