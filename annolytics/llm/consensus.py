"""Problem 4: consensus of several annotators by expectation-maximisation over confusion matrices.

A vote is an annotator's latest submitted value of a label that isn't null. The model is the one of Dawid and Skene: per
label a share of true items, and per annotator and label the probability of voting true on true and on false items, all
smoothed by pseudo-counts. The chance-corrected agreement (Krippendorff's alpha, nominal) is reported separately.

Scale: items with the same annotators and votes are one pattern, and the rounds work on patterns and how often they
occur, of which there are far fewer than items: only building them, and giving the items their results, touch all votes.
Patterns of up to ONE_TASK votes in all, which is counted first, go through all rounds in one task. Beyond, each round is
a job, the rates, one row per annotator and label, are a table written in each, and only the greatest change comes to
the driver. Rates, and in the end patterns, are broadcast up to MAX_BROADCAST rows and joined by a shuffle beyond, hot
annotators and patterns apart. Either way the rounds go on until no rate moves by more than the tolerance; the annotators' table
says after how many rounds, and whether that was reached.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annolytics.operators.joins import join_unique
from annolytics.session import forget, persist_table
from annolytics.sources.tables import clean_key

#: The rounds end by the tolerance; ROUNDS only keeps a model that swings from running for ever, and is reported.
ROUNDS, TOLERANCE = 500, 1e-4
#: Pseudo-counts: an annotator starts as if right PRIOR_RIGHT and wrong PRIOR_WRONG times on either class.
PRIOR_RIGHT, PRIOR_WRONG, PRIOR_CLASS = 2.0, 1.0, 1.0
#: Rows of rates or patterns up to which they are broadcast; beyond, a shuffle join takes over.
MAX_BROADCAST = 200_000
#: Votes of all patterns up to which one task runs the rounds (some 150 MB of it).
ONE_TASK = 1_000_000
CHUNK = r"^.+-c\d+$"


def votes(rows: DataFrame, label: str, chunk: bool) -> DataFrame:
    """(label_name, record_uuid, chunk_id, annotator_id, vote), one row per item and annotator.

    Only submitted rows with a value count; of an annotator's rows on an item the one inserted last holds, of those
    inserted at one time a true one. Rows without record or annotator drop out, and for labels of chunks those whose
    chunk_id is null, blank or a placeholder. Null insertion times come before all others.
    """
    r = rows.select(
        F.lit(label).alias("label_name"), clean_key("record_uuid").alias("record_uuid"), (clean_key("chunk_id") if chunk else F.lit("")).alias("chunk_id"),
        clean_key("annotator_id").alias("annotator_id"), F.col("inserted_at").alias("t"), F.col(label).cast("boolean").alias("v"), clean_key("response_status").alias("status"),
    ).where("status = 'submitted' AND v IS NOT NULL AND record_uuid IS NOT NULL AND annotator_id IS NOT NULL")
    if chunk:
        r = r.where(F.col("chunk_id").rlike(CHUNK))
    # max of a struct aggregates on the map side; a window would sort whole groups
    return r.groupBy("label_name", "record_uuid", "chunk_id", "annotator_id").agg(F.max(F.struct("t", "v")).alias("m")).select("label_name", "record_uuid", "chunk_id", "annotator_id", F.col("m.v").cast("int").alias("vote"))


RATES = "who string, label_name string, annotator_id string, n_votes bigint, sensitivity double, specificity double, w1 double, w0 double, base double, change double"


def _who():
    return F.concat_ws("\0", "label_name", "annotator_id")


def consensus(v: DataFrame, rounds: int = ROUNDS, tolerance: float = TOLERANCE, limit: int = MAX_BROADCAST, one_task: int = ONE_TASK) -> tuple[DataFrame, DataFrame]:
    """(items, annotators) of votes. items: label_name, record_uuid, chunk_id, n_votes, n_true, p_true, agreement (the
    share of pairs of votes that agree; null for one vote). annotators: label_name, annotator_id, n_votes, sensitivity,
    specificity, reliability (their mean), n_rounds, converged. Starts from each item's share of true votes. Empty votes
    give empty tables. A label whose votes are all alike keeps them. Rounds end when no rate moves by more than the
    tolerance; converged is false where `rounds` ended them first.
    """
    item = ["label_name", "record_uuid", "chunk_id"]
    items = v.groupBy(*item).agg(F.sort_array(F.collect_list(F.struct("annotator_id", F.col("vote").cast("int").alias("vote")))).alias("votes"))
    items = persist_table(items.withColumn("pattern", F.sha2(F.concat_ws("\0", "label_name", F.to_json("votes")), 256)), "items")
    patterns = items.groupBy("pattern").agg(F.first("label_name").alias("label_name"), F.first("votes").alias("votes"), F.count(F.lit(1)).cast("double").alias("n"))
    patterns = persist_table(patterns.withColumn("number", F.monotonically_increasing_id()), "patterns")
    size = patterns.agg(F.sum(F.size("votes"))).first()[0] or 0
    if size <= one_task:
        flat = patterns.withColumn("x", F.explode("votes")).select("number", "label_name", "x.annotator_id", "x.vote", "n").repartition(1)
        run = lambda batches: _all_rounds(batches, rounds, tolerance)
        rates = persist_table(flat.mapInPandas(run, RATES + ", n_rounds int, converged boolean"), "rates")
    else:
        rates = _in_jobs(patterns, rounds, tolerance, limit)
    n_rates = rates.count()
    scored = persist_table(_scored(patterns, rates, n_rates, limit).select("pattern", "p"), "scored")
    k = F.aggregate("votes", F.lit(0), lambda x, y: x + y["vote"]).cast("bigint")
    out = join_unique(items.select(*item, "pattern", F.size("votes").cast("bigint").alias("n_votes"), k.alias("n_true")), scored, "pattern", limit=limit)
    n, k = F.col("n_votes"), F.col("n_true")
    out = out.select(*item, "n_votes", "n_true", F.col("p").alias("p_true"), F.when(n > 1, (k * (k - 1) + (n - k) * (n - k - 1)) / (n * (n - 1))).alias("agreement"))
    forget(patterns)
    ann = rates.select("label_name", "annotator_id", "n_votes", "sensitivity", "specificity", ((F.col("sensitivity") + F.col("specificity")) / 2).alias("reliability"), "n_rounds", "converged")
    return out, ann


def _all_rounds(batches: Iterator[pd.DataFrame], rounds: int, tolerance: float) -> Iterator[pd.DataFrame]:
    """All rounds over the votes of the patterns (number, label_name, annotator_id, vote, n), in arrays."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return
    x = pd.concat(parts, ignore_index=True)
    pattern, names = pd.factorize(x["number"])
    who, who_names = pd.factorize(pd.MultiIndex.from_arrays([x["label_name"], x["annotator_id"]]))
    first = pd.Series(np.arange(len(x))).groupby(who).first().to_numpy()
    label, labels = pd.factorize(x["label_name"].to_numpy()[first])
    vote, n, size = x["vote"].to_numpy(float), x["n"].to_numpy(float), np.bincount(pattern).astype(float)
    label_of = np.zeros(len(names), int)
    label_of[pattern] = label[who]
    total = lambda w: np.bincount(who, weights=w, minlength=len(who_names))
    p, old, change, done, converged = np.bincount(pattern, weights=vote) / size, None, None, 0, False
    while True:
        pv = p[pattern]
        share = n / size[pattern]
        prior = (np.bincount(label, weights=total(pv * share), minlength=len(labels)) + PRIOR_CLASS) / (np.bincount(label, weights=total(share), minlength=len(labels)) + 2 * PRIOR_CLASS)
        sens = (total(pv * vote * n) + PRIOR_RIGHT) / (total(pv * n) + PRIOR_RIGHT + PRIOR_WRONG)
        spec = (total((1 - pv) * (1 - vote) * n) + PRIOR_RIGHT) / (total((1 - pv) * n) + PRIOR_RIGHT + PRIOR_WRONG)
        w1, w0, base = np.log(sens / (1 - spec)), np.log((1 - sens) / spec), np.log(prior / (1 - prior))
        if old is not None:
            change = np.maximum(np.abs(sens - old[0]), np.abs(spec - old[1]))
            done += 1
            converged = bool(change.max() < tolerance)
        if converged or done >= rounds:
            break
        old = (sens, spec)
        z = np.bincount(pattern, weights=np.where(vote == 1, w1[who], w0[who])) + base[label_of]
        p = 1 / (1 + np.exp(-z))
    yield pd.DataFrame({
        "who": [f"{a}\0{b}" for a, b in who_names], "label_name": [a for a, _ in who_names], "annotator_id": [b for _, b in who_names], "n_votes": total(n).round().astype("int64"),
        "sensitivity": sens, "specificity": spec, "w1": w1, "w0": w0, "base": base[label], "change": change if change is not None else np.full(len(who_names), np.nan), "n_rounds": np.int32(done), "converged": converged,
    })


def _in_jobs(patterns: DataFrame, rounds: int, tolerance: float, limit: int) -> DataFrame:
    """The rounds as jobs over the table of patterns, for any number of them."""
    share = patterns.select("pattern", "label_name", "votes", "n", F.aggregate("votes", F.lit(0.0), lambda x, y: x + y["vote"], lambda x: x / F.size("votes")).alias("p"))
    rates, done, converged = _rates(share, None), 0, False
    n_rates = rates.count()
    while n_rates and not converged and done < rounds:
        new = _rates(_scored(patterns, rates, n_rates, limit), rates)
        forget(rates)
        rates, done = new, done + 1
        converged = rates.agg(F.max("change")).first()[0] < tolerance
    out = rates.withColumn("n_rounds", F.lit(done)).withColumn("converged", F.lit(converged))
    return out


def _rates(scored: DataFrame, old: DataFrame | None) -> DataFrame:
    """The rates after a round, written as a table: one row per annotator and label, with what its votes weigh."""
    x = scored.withColumn("x", F.explode("votes")).select("label_name", F.col("x.annotator_id").alias("annotator_id"), F.col("x.vote").alias("v"), "p", "n", (F.col("n") / F.size("votes")).alias("share"))
    p, q, v, c = F.col("p"), 1 - F.col("p"), F.col("v"), F.col("n")
    m = x.groupBy("label_name", "annotator_id").agg(
        F.sum(p * c).alias("t"), F.sum(p * v * c).alias("t1"), F.sum(q * c).alias("f"), F.sum(q * (1 - v) * c).alias("f0"), F.sum(c).cast("bigint").alias("n_votes"), F.sum(p * F.col("share")).alias("i1"), F.sum("share").alias("i")
    )
    label = Window.partitionBy("label_name")  # one row per annotator
    prior = (F.sum("i1").over(label) + PRIOR_CLASS) / (F.sum("i").over(label) + 2 * PRIOR_CLASS)
    m = m.withColumn("prior", prior).withColumn("sensitivity", (F.col("t1") + PRIOR_RIGHT) / (F.col("t") + PRIOR_RIGHT + PRIOR_WRONG)).withColumn("specificity", (F.col("f0") + PRIOR_RIGHT) / (F.col("f") + PRIOR_RIGHT + PRIOR_WRONG))
    m = m.withColumn("who", _who())
    if old is None:
        m = m.withColumn("change", F.lit(None).cast("double"))
    else:
        m = m.join(old.select("who", F.col("sensitivity").alias("s0"), F.col("specificity").alias("p0")), "who")
        m = m.withColumn("change", F.greatest(F.abs(F.col("sensitivity") - F.col("s0")), F.abs(F.col("specificity") - F.col("p0"))))
    s, z = F.col("sensitivity"), F.col("specificity")
    m = m.withColumn("w1", F.log(s / (1 - z))).withColumn("w0", F.log((1 - s) / z)).withColumn("base", F.log(F.col("prior") / (1 - F.col("prior"))))
    return persist_table(m.selectExpr(*[f.split()[0] for f in RATES.split(", ")]), "rates")


def _scored(patterns: DataFrame, rates: DataFrame, n_rates: int, limit: int) -> DataFrame:
    """(pattern, label_name, votes, n, p): how probably the items of a pattern are true."""
    x = patterns.withColumn("x", F.explode("votes")).select("*", F.concat_ws("\0", "label_name", "x.annotator_id").alias("who"))
    x = join_unique(x, rates.select("who", "w1", "w0", "base"), "who", limit=limit, n_small=n_rates)
    g = x.groupBy("pattern").agg(F.first("label_name").alias("label_name"), F.first("votes").alias("votes"), F.first("n").alias("n"), F.sum(F.when(F.col("x.vote") == 1, F.col("w1")).otherwise(F.col("w0"))).alias("z"), F.first("base").alias("base"))
    return g.select("pattern", "label_name", "votes", "n", (1 / (1 + F.exp(-(F.col("z") + F.col("base"))))).alias("p"))


def alpha(items: DataFrame) -> DataFrame:
    """label_name, n_items (with two votes or more), alpha: Krippendorff's alpha over the items' vote counts; 1 where all votes agree on one value, null without pairs."""
    p = items.where("n_votes > 1").select("label_name", F.col("n_votes").cast("double").alias("n"), F.col("n_true").cast("double").alias("k"))
    a = p.groupBy("label_name").agg(F.count(F.lit(1)).alias("n_items"), F.sum("n").alias("N"), F.sum("k").alias("K"), F.sum(2 * F.col("k") * (F.col("n") - F.col("k")) / (F.col("n") - 1)).alias("d"))
    de = 2 * F.col("K") * (F.col("N") - F.col("K")) / (F.col("N") * (F.col("N") - 1))
    return a.select("label_name", "n_items", F.when(de == 0, F.lit(1.0)).otherwise(1 - F.col("d") / F.col("N") / de).alias("alpha"))
