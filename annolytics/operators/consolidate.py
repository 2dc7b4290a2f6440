"""Majority consolidation, first-wins dedup, latest-wins upserts, interspersion."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def majority(df: DataFrame, keys: tuple[str, ...], labels: tuple[str, ...], order: tuple[str, ...], least: tuple[str, ...] = (), most: tuple[str, ...] = ()) -> DataFrame:
    """A2: one value per item and label. More than half decides each label on its own; where true and false are equally
    many, the value comes from the first row (in `order`) that agrees with every decided label, else from the first row.

    Rows are first combined by item and combination of labels (map-side), so an item keeps at most 2 ** len(labels)
    combinations, however many rows it has; the second aggregate works on those. Labels must not be null. Adds n_votes.
    Ties in `order` are broken by the labels themselves, so repeated rows change nothing but counts. The columns `least`
    and `most` go along with their smallest and greatest value of the item, in the same two aggregates.
    """
    ints = [F.col(c).cast("int").alias(c) for c in labels]
    combos = df.select(*dict.fromkeys((*keys, *order, *least, *most)), *ints).groupBy(*keys, *labels).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("first"), *[F.min(c).alias(f"__least_{c}") for c in least], *[F.max(c).alias(f"__most_{c}") for c in most])
    g = combos.groupBy(*keys).agg(F.sum("n").alias("n_votes"), *[F.sum(F.col(c) * F.col("n")).alias(f"s_{c}") for c in labels], F.collect_list(F.struct("first", *labels)).alias("combos"), *[F.min(f"__least_{c}").alias(c) for c in least], *[F.max(f"__most_{c}").alias(c) for c in most])

    def place(x):
        agrees = F.lit(True)
        for c in labels:
            agrees = agrees & ((2 * F.col(f"s_{c}") == F.col("n_votes")) | (x[c] == (2 * F.col(f"s_{c}") > F.col("n_votes")).cast("int")))
        return F.struct((~agrees).alias("no"), x["first"].alias("first"), *[x[c].alias(c) for c in labels])

    g = g.withColumn("rep", F.array_min(F.transform("combos", place)))
    value = [F.when(2 * F.col(f"s_{c}") > F.col("n_votes"), 1).when(2 * F.col(f"s_{c}") < F.col("n_votes"), 0).otherwise(F.col(f"rep.{c}")).cast("int").alias(c) for c in labels]
    return g.select(*keys, "n_votes", *value, *least, *most)


def melt(df: DataFrame, keys: tuple[str, ...], labels: tuple[str, ...], value: str = "value") -> DataFrame:
    """Labels as rows (label, value): one pass over the table instead of one per label."""
    return df.unpivot([*keys], [*labels], "label", value)


def prevalence(items: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """Per label the items, true and false ones and the share of true ones."""
    m = melt(items, (), labels)
    return m.groupBy("label").agg(F.count("value").alias("n_items"), F.sum("value").cast("bigint").alias("n_true"), (F.count("value") - F.sum("value")).cast("bigint").alias("n_false"), F.round(F.avg("value"), 6).alias("prevalence"))


def dedup_first(df: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """The first row in `order` of each key and n_copies, the number of rows it stands for. An aggregate, not a
    window, so that a text with very many copies is combined on the map side."""
    rest = [c for c in df.columns if c not in key and c not in order]
    g = df.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("r"), F.count(F.lit(1)).alias("n_copies"))
    return g.select(*key, *[F.col(f"r.{c}").alias(c) for c in (*order, *rest)], "n_copies")


def upsert_latest(df: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """Of each key the row that is last in `order`; importing the same rows again changes nothing."""
    rest = [c for c in df.columns if c != key and c not in order]
    g = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("r"))
    return g.select(key, *[F.col(f"r.{c}").alias(c) for c in (*order, *rest)])


def edge_positions(n_base: int, n_edge: int, lead: int = 10, seed: int = 0) -> list[int]:
    """Where edge cases go among n_base + n_edge rows: sampled from [lead, end), end = max(lead + n_edge, total / 3)."""
    total = n_base + n_edge
    end = min(total, max(lead + n_edge, total // 3))
    start = max(0, min(lead, end - n_edge))
    return sorted(random.Random(seed).sample(range(start, end), n_edge))


def intersperse(base: DataFrame, edge: DataFrame, order: str, lead: int = 10, seed: int = 0) -> DataFrame:
    """Edge cases among the base rows at seeded positions; both sides keep their order. Adds position (from 0).

    Ranks come from range partitions (no window over the whole table); the positions, one number per edge case, are few
    by contract and made on the driver."""
    b, e = ranked(base, order, "k"), ranked(edge, order, "k")
    n_edge = edge.count()
    at = edge_positions(base.count(), n_edge, lead, seed)
    spark = base.sparkSession
    places = spark.createDataFrame([(i, p) for i, p in enumerate(at)], "k long, position long")
    # a base row moves behind as many edge cases as lie at or before its place: at[i] - i base rows precede the i-th one
    shifts = F.array(*[F.lit(p - i) for i, p in enumerate(at)]) if at else F.array().cast("array<int>")
    moved = b.withColumn("position", (F.col("k") + F.size(F.filter(shifts, lambda x: x <= F.col("k")))).cast("long"))
    return moved.unionByName(e.join(places, "k")).drop("k")


def ranked(df: DataFrame, order: str, name: str) -> DataFrame:
    """Consecutive numbers from 0 in the order of a unique column: ranks within range partitions plus the sizes of those before."""
    from annolytics.session import persist_table

    # written once: the bounds of the ranges are sampled, and ranks and sizes must see the same ones
    parts = persist_table(df.repartitionByRange(order).withColumn("__p", F.spark_partition_id()), "ranked")
    sizes = parts.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__o"))  # one row per partition
    w = Window.partitionBy("__p").orderBy(order)
    return parts.withColumn("__r", F.row_number().over(w) - 1).join(offsets, "__p").withColumn(name, (F.col("__r") + F.col("__o")).cast("long")).drop("__p", "__r", "__o")


def running_before(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """df, which has one row per `order`, with the sum of `value` over all rows before: sums within range partitions plus
    those of the partitions before, so no task sees the whole table."""
    from annolytics.session import persist_table

    parts = persist_table(df.repartitionByRange(order).withColumn("__p", F.spark_partition_id()), "running")
    sums = parts.groupBy("__p").agg(F.sum(value).alias("__s"))
    offsets = sums.select("__p", (F.sum("__s").over(Window.orderBy("__p")) - F.col("__s")).alias("__o"))  # one row per partition
    w = Window.partitionBy("__p").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("__r", F.coalesce(F.sum(value).over(w), F.lit(0))).join(offsets, "__p").withColumn(name, F.col("__r") + F.col("__o")).drop("__p", "__r", "__o")
