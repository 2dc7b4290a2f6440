"""Staging of prediction inputs, and what comes back from predictions: pairs, indexes, classes, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolytics.operators.consolidate import dedup_first, ranked

TEXT_PAIRS = {"retrieval": ("query", "chunk"), "grounding": ("answer", "context_set"), "generation": ("query", "answer")}


def solid(c: str) -> Column:
    return F.coalesce(F.regexp_replace(c, r"[\s\p{Z}]+", "") != "", F.lit(False))


def staged_pairs(rows: DataFrame, task: str, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """A30 (F1, F9, D2, F8): the text pairs of a task's submitted rows without their labels, first row of each item by
    order, pairs with a blank side refused: (keys, text, text_pair, n_copies)."""
    a, b = TEXT_PAIRS[task]
    r = rows.where("status = 'submitted'").select(*keys, *order, F.col(a).alias("text"), F.col(b).alias("text_pair"))
    return dedup_first(r, keys, order).where(solid("text") & solid("text_pair")).select(*keys, "text", "text_pair", "n_copies")


def with_index(df: DataFrame, order: str, name: str = "row_index") -> DataFrame:
    """rows numbered from 0 in the order of a unique column, without gaps, columns label_* and split_group dropped."""
    gone = [c for c in df.columns if c.startswith("label_") or c == "split_group"]
    return ranked(df.drop(*gone), order, name)


def join_on_index(predicted: DataFrame, truth: DataFrame, index: str = "row_index") -> DataFrame:
    """Probabilities and truth on the row index, each row exactly once: a row that is missing or comes twice on either
    side ends the job when it is read."""
    p, t = (d.groupBy(index).agg(F.count(F.lit(1)).alias(f"__{s}"), *[F.first(c).alias(c) for c in d.columns if c != index]) for d, s in ((predicted, "p"), (truth, "t")))
    j = p.join(t, index, "full_outer")
    ok = F.coalesce((F.col("__p") == 1) & (F.col("__t") == 1), F.lit(False))
    return j.withColumn(index, F.when(ok, F.col(index)).otherwise(F.raise_error(F.lit("a row of one side isn't there exactly once")).cast("long"))).drop("__p", "__t")


def fan_out(groups: DataFrame, key: str) -> DataFrame:
    """Of a query group with chunks array<struct<chunk_id, text>> k + 2 rows: (key, task, chunk_id, text, text_pair);
    chunk_id is null but for retrieval."""
    r = groups.select(key, F.explode("chunks").alias("c"), "query").select(key, F.lit("retrieval").alias("task"), F.col("c.chunk_id").alias("chunk_id"), F.col("query").alias("text"), F.col("c.text").alias("text_pair"))
    two = F.array(F.struct(F.lit("grounding").alias("task"), F.col("answer").alias("text"), F.col("context_set").alias("text_pair")), F.struct(F.lit("generation").alias("task"), F.col("query").alias("text"), F.col("answer").alias("text_pair")))
    g = groups.select(key, F.explode(two).alias("x")).select(key, "x.task", F.lit(None).cast("string").alias("chunk_id"), "x.text", "x.text_pair")
    return r.unionByName(g)


def import_contract(groups: DataFrame) -> DataFrame:
    """the fields of the import contract, others stripped on both levels."""
    chunk = lambda c: F.struct(c["chunk_id"].alias("chunk_id"), c["doc_id"].alias("doc_id"), c["chunk_rank"].alias("chunk_rank"), c["text"].alias("text"))
    return groups.select("query", "answer", "context_set", "language", F.transform("chunks", chunk).alias("chunks"))


def outcome(answer: str, n_chunks: Column) -> Column:
    """'error' without an answer, 'no_retrieval' for one that rests on no chunk, else 'ok'."""
    return F.when(~solid(answer), "error").when(F.coalesce(n_chunks, F.lit(0)) == 0, "no_retrieval").otherwise("ok")


def class_floor(counts: DataFrame, floor: int, narrow: tuple[str, ...] | None = None) -> DataFrame:
    """(.., n_minority, kept) of label counts (label, n_true, n_false): a label with fewer of the rarer class than
    the floor, or outside the narrower list if given, isn't kept."""
    m = F.least("n_true", "n_false")
    keep = m >= floor
    return counts.withColumn("n_minority", m).withColumn("kept", keep & F.col("label").isin(*narrow) if narrow else keep)


def confusion(df: DataFrame, keys: tuple[str, ...], p: str, truth: str, threshold: float = 0.5) -> DataFrame:
    """Per keys n, precision, recall, f1 and accuracy of p >= threshold; null where a rate has no denominator."""
    y, z = F.col(truth), F.col(p) >= threshold
    g = df.where(F.col(p).isNotNull() & y.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(y & z).alias("tp"), F.count_if(~y & z).alias("fp"), F.count_if(y & ~z).alias("fn"))
    r = lambda k, n, name: F.round(F.try_divide(k, n), 6).alias(name)
    tp, fp, fn, n = (F.col(c) for c in ("tp", "fp", "fn", "n"))
    return g.select(*keys, "n", r(tp, tp + fp, "precision"), r(tp, tp + fn, "recall"), r(2 * tp, 2 * tp + fp + fn, "f1"), r(n - fp - fn, n, "accuracy"))


def not_trained(expected: DataFrame, present: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The labels expected that no run has."""
    return expected.select(*keys).distinct().join(present.select(*keys).distinct(), [*keys], "left_anti")


def gender_slots(df: DataFrame, slots: tuple[str, ...], fallback: str, verdicts: DataFrame, name: str = "name", verdict: str = "verdict") -> DataFrame:
    """Df with g_<slot> for each slot of authors and gender: the verdict on the slot's first name from the table
    (name, verdict), 'unknown' without one, null for an empty slot. The fallback column stands for the first slot only
    where all are empty; slots are never moved up. gender: the only verdict of the known slots, 'mixed' for several,
    'unknown' for none."""
    from annolytics.functions.scalars import first_name

    empty = F.lit(True)
    for s in slots:
        empty = empty & F.col(s).isNull()
    out = df.withColumn("__s0", F.when(empty, F.col(fallback)).otherwise(F.col(slots[0])))
    for i, s in enumerate(slots):
        c = F.col("__s0") if i == 0 else F.col(s)
        v = verdicts.select(F.lower(name).alias("__n"), F.col(verdict).alias(f"__v{i}"))
        out = out.withColumn("__k", F.lower(first_name(c))).join(v, F.col("__k") == F.col("__n"), "left").drop("__k", "__n").withColumn(f"g_{s}", F.when(c.isNotNull(), F.coalesce(f"__v{i}", F.lit("unknown")))).drop(f"__v{i}")
    known = F.array_distinct(F.filter(F.array(*[F.col(f"g_{s}") for s in slots]), lambda x: x.isNotNull() & (x != "unknown")))
    return out.drop("__s0").withColumn("gender", F.when(F.size(known) == 0, "unknown").when(F.size(known) == 1, known[0]).otherwise("mixed"))
