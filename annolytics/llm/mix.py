"""Problem 8: mixing sources to target weights, as a Pfair schedule of blocks.

Each source is a stream of texts in the order of a hash, repeated at most max_repeats times, and cut into blocks of
equal size in tokens. With w the source's weight, its k-th block (from 0) is released at slot floor(k / w) and due at
slot ceil((k + 1) / w). Serving in each slot the released block that is due first (ties: heavier weight, then name) keeps
every source within less than one block of its share at every moment, which the schedule asserts. A quota needn't be a
whole number of blocks, so the light sources' last blocks are due after the heavy ones are done: then each source drops
out with its last block, and the rest is served by deadline until every source has all its blocks.

Scale: the number of blocks is a parameter and the sources are the target table's rows, so the schedule is of bounded
size at every amount of text and is made on the driver. Running sums over a source, which may hold a third of all texts,
go through hash buckets; no window runs over a whole source.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCKS, BUCKETS, MAX_SOURCES, LEAST_USE = 10_000, 1024, 10_000, 0.25
#: Sums of sources and buckets that come to the driver, at most; with many sources each has fewer buckets.
MAX_SUMS = 500_000


def schedule(weights: dict[str, int], blocks: int, need: dict[str, int] | None = None) -> list[tuple[int, str, int]]:
    """(slot, source, block) for integer weights (tokens); sources without weight don't occur.

    Without need, `blocks` slots, of which every source takes its share. With need, the blocks that each source has in
    all, it goes on until every source has them, and blocks is not read; slots follow one another without gaps.
    """
    total = sum(weights.values())
    w = {s: Fraction(v, total) for s, v in weights.items() if v > 0}
    left = {s: need[s] if need is not None else blocks for s in w}
    waiting = [(0, s, 0) for s in sorted(w) if left[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, Fraction, str, int]] = []
    out, done = [], False
    while (ready or waiting) and (need is not None or len(out) < blocks):
        slot = len(out)
        # once a source has dropped out, blocks may be served before their release
        while waiting and (waiting[0][0] <= slot or done and not ready):
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (math.ceil((k + 1) / w[s]), -w[s], s, k))
        due, _, s, k = heapq.heappop(ready)
        if due < slot + 1:
            raise AssertionError("a block missed its deadline")
        out.append((slot, s, k))
        if k + 1 < left[s]:
            heapq.heappush(waiting, (max(slot + 1, math.floor((k + 1) / w[s])), s, k + 1))
        elif need is not None:
            done = True
    return out


def plan(sizes: dict[str, int], targets: list[tuple[str, float, int]], total: int | None = None, least_use: float = LEAST_USE) -> dict[str, int]:
    """Tokens that each source of the targets gives: its share of the total, at most its own tokens times max_repeats.

    The default total is the largest at which every source reaches its share, but no less than least_use of the tokens
    at hand: sources that are too small for that, or empty, stay below their share. Shares that are null or negative
    count as 0, repeats that are null or below 1 as none.
    """
    caps = {s: sizes.get(s, 0) * max(r or 0, 0) for s, _, r in targets}
    shares = {s: max(p or 0.0, 0.0) for s, p, _ in targets}
    if total is None:
        have = sum(sizes.get(s, 0) for s in shares)
        full = [caps[s] / shares[s] for s in shares if shares[s] and caps[s]]
        total = min((t for t in full if t >= least_use * have), default=have)
    return {s: min(int(shares[s] * total + 0.5), caps[s]) for s in shares}


def mixed(docs: DataFrame, targets: DataFrame, total: int | None = None, blocks: int = BLOCKS, least_use: float = LEAST_USE) -> tuple[DataFrame, DataFrame]:
    """(texts, report) for docs (doc_id, source, n_tokens) and targets (source, target_share, max_repeats).

    Without a total, the mix is as large as every source's share allows, but uses least_use of the tokens at hand at
    least: below that, sources that are too small stay below their shares, which the report shows (0 keeps all shares).

    texts: source, doc_id, use_no (from 1), n_tokens, slot, position (within the block); a text is used as often as
    it begins within its source's quota, so a source exceeds its quota by less than one text. Order: slot, source,
    position. report: one row per target: source, target_share, max_repeats, available_tokens, planned_tokens,
    mixed_tokens, actual_share (null where nothing is mixed), n_texts, n_uses. Sources outside the targets, null
    sources and texts without tokens are left out; of repeated target rows the first by share and repeats holds; an empty table gives a report of zeros.
    """
    spark = docs.sparkSession
    t = targets.where("source IS NOT NULL").groupBy("source").agg(F.min(F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.*").limit(MAX_SOURCES + 1).collect()
    if len(t) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} target sources")
    rows = [(r.source, r.target_share, r.max_repeats) for r in t]
    d = docs.select("doc_id", "source", F.col("n_tokens").cast("bigint").alias("n_tokens")).where("n_tokens > 0")
    known = spark.createDataFrame(rows, "source string, target_share double, max_repeats int")
    d = d.join(known.select("source"), "source", "left_semi")
    d = d.withColumn("h", F.xxhash64("doc_id")).withColumn("bucket", F.pmod(F.col("h"), F.lit(max(1, min(BUCKETS, MAX_SUMS // max(1, len(rows)))))).cast("int"))
    sums = d.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("n")).orderBy("source", "bucket").collect()  # at most MAX_SUMS rows
    sizes: dict[str, int] = {}
    starts = []
    for r in sums:
        starts.append((r.source, r.bucket, sizes.get(r.source, 0)))
        sizes[r.source] = sizes.get(r.source, 0) + r.n
    quota = plan(sizes, rows, total, least_use)
    all_tokens = sum(quota.values())
    block = max(1, math.ceil(all_tokens / blocks))
    need = {s: -(-q // block) for s, q in quota.items()}
    slots = schedule(quota, sum(need.values()), need)
    if len(slots) != sum(need.values()):
        raise AssertionError("a block has no slot")
    slots_df = spark.createDataFrame([(s, k, slot) for slot, s, k in slots], "source string, block long, slot long")
    quota_df = spark.createDataFrame([(s, quota[s], sizes.get(s, 0)) for s, _, _ in rows], "source string, quota long, size long")
    starts_df = spark.createDataFrame(starts, "source string, bucket int, start long")
    w = Window.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("before", F.coalesce(F.sum("n_tokens").over(w), F.lit(0))).join(starts_df, ["source", "bucket"]).join(quota_df, "source")
    at = F.col("before") + F.col("start")
    # use u of a text begins at (u - 1) * size + at; it is used while that lies within the quota
    uses = F.floor((F.col("quota") - 1 - at) / F.col("size")) + 1
    u = d.withColumn("at", at).where("quota > at").withColumn("use_no", F.explode(F.sequence(F.lit(1), uses.cast("int"))))
    begin = F.col("at") + (F.col("use_no") - 1) * F.col("size")
    u = u.withColumn("block", F.floor(begin / block).cast("bigint")).withColumn("position", (begin % block).cast("bigint"))
    texts = u.join(slots_df, ["source", "block"], "left")
    texts = texts.withColumn("slot", F.coalesce("slot", F.raise_error(F.lit("a text without a slot")).cast("bigint"))).select("source", "doc_id", "use_no", "n_tokens", "slot", "position")
    got = u.groupBy("source").agg(F.sum("n_tokens").alias("mixed"), F.count_if(F.col("use_no") == 1).alias("n_texts"), F.count(F.lit(1)).alias("n_uses"))
    r = known.join(quota_df, "source").join(got, "source", "left")
    r = r.select("source", "target_share", "max_repeats", F.col("size").alias("available_tokens"), F.col("quota").alias("planned_tokens"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(a) for c, a in (("mixed", "mixed_tokens"), ("n_texts", "n_texts"), ("n_uses", "n_uses"))])
    # the report has one row per target, at most MAX_SOURCES
    whole = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(1)))
    return texts, r.withColumn("actual_share", F.try_divide("mixed_tokens", whole))
