"""Problem 1: same or near-same records across splits.

Two records overlap when their queries agree and their answers agree; two texts agree when at least SHARE of the words
of the longer one are matched by words of the other, order, case, accents, punctuation and markup aside. Words are kept
as 32-bit hashes of (word, how often it occurred before in the text), so a multiset of words is a plain set; the chance
that a collision lifts a pair of 50 words over the limit is below one in a million.

Candidates come from hashes of word n-grams. Since order doesn't count, these aren't n-grams of the running text: an
n-gram is a set of n words among the rarest ones of a text, that is, prefix filtering with pairs of words: two sets that share ALPHA of the words of the longer one share at least n words among their first
size - ceil(SHARE * size) + n, so every set of n of those words is hashed, and no overlapping pair can be missed. n is 2;
for very short and very long queries, where there are too few or too many such sets, n is 1. The evaluation side's
hashes are partitioned together with the training side's, never broadcast. Each hash carries the query's size and a
bitmap of its words: bitmaps can't differ in more bits than the sets differ in words, so the join itself drops what
can't overlap, before anything is shuffled again.

Scale: records that are alike in both texts are one class, and queries that are alike are one query class, so copies meet
once. Queries are linked first; answers are compared only under linked queries, again through the rare words of their
prefix, so that a query asked by a third of all records doesn't lead to all pairs of its answers. Word counts cover all
distinct queries and answers and are kept in a sketch of fixed size (SLOTS counters), which only orders words: collisions
change the work, not the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolytics.llm.defects import defects, tokens
from annolytics.session import persist_table
from annolytics.sources.tables import clean_key

SHARE, GRAM, SHORT, LONG, SLOTS = 0.8, 2, 2, 200, 1 << 17
BITMAP = 3  # words of 64 bits
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(33)
    x *= _MIX1
    x ^= x >> np.uint64(33)
    x *= _MIX2
    return x ^ (x >> np.uint64(33))


def word_set(text: str | None) -> np.ndarray:
    """Sorted 32-bit hashes of the words of a text; the k-th occurrence of a word is an element of its own."""
    import xxhash

    seen: dict[str, int] = {}
    out = []
    for w in tokens(text or ""):
        k = seen.get(w, 0)
        seen[w] = k + 1
        out.append(xxhash.xxh32_intdigest(w if not k else f"{w}\0{k}"))
    return np.unique(np.array(out, np.uint32)).view(np.int32)


def need(n: int) -> int:
    """How many words of a set of n must be matched: ceil(SHARE * n), in whole numbers."""
    return -(-n * 4 // 5)


def prefix(words: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The len - need + n rarest words (ties by hash)."""
    w = words.astype(np.int32).view(np.uint32)
    order = np.lexsort((w, counts[w & np.uint32(SLOTS - 1)]))
    return w[order[: max(0, len(w) - need(len(w)) + n)]]


_COMBOS: dict[int, np.ndarray] = {}


def signatures(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hashes of the n-grams of a query's rare words, for n of 2 and, where the sizes call for it, of 1.

    The n of a pair depends on the larger set; a set of n words meets sets of up to n / SHARE, hence the two ranges.
    """
    n = len(words)
    out = []
    if n * 5 >= (SHORT + 1) * 4 and n <= LONG:
        p = np.sort(prefix(words, counts, GRAM)).astype(np.uint64)
        c = _COMBOS.get(len(p))
        if c is None:
            c = _COMBOS[len(p)] = np.array(list(combinations(range(len(p)), GRAM)), np.int64).reshape(-1, GRAM)
        h = _mix(p[c[:, 0]])
        for i in range(1, GRAM):
            h = _mix(h ^ p[c[:, i]])
        out.append(h)
    if n <= SHORT or n * 5 > LONG * 4:
        out.append(_mix(prefix(words, counts, 1).astype(np.uint64) | np.uint64(1 << 40)))
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


def bitmap(words: np.ndarray) -> np.ndarray:
    """A bit for each word among 64 * BITMAP."""
    at = words.astype(np.int32).view(np.uint32) % np.uint32(64 * BITMAP)
    out = np.zeros(BITMAP, np.uint64)
    np.bitwise_or.at(out, at >> 6, np.uint64(1) << (at & np.uint32(63)).astype(np.uint64))
    return out.view(np.int64)


def _counts(df: DataFrame, col: str) -> np.ndarray:
    """How often words fall into each of SLOTS counters, over all rows: at most SLOTS rows come to the driver."""
    rows = df.select(F.explode(col).alias("w")).groupBy(F.col("w").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    out = np.zeros(SLOTS, np.int64)
    out[rows["slot"].to_numpy(np.int64)] = rows["n"]
    return out


def _with_hashes(df: DataFrame, col: str, counts: np.ndarray, one: bool, keep: str) -> DataFrame:
    """(keep, sig) rows: the n-gram hashes of each set, or its prefix words where one is set."""
    shared = df.sparkSession.sparkContext.broadcast(counts)

    bits = [] if one else [f"b{i}" for i in range(BITMAP)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = shared.value
        for b in batches:
            sets = b.pop(col)
            sigs = [prefix(w, counts, 1).astype(np.int64) if one else signatures(w, counts) for w in sets]
            if not one:
                b["n"] = np.fromiter(map(len, sets), "int32", len(sets))
                maps = np.array([bitmap(w) for w in sets]).reshape(-1, BITMAP)
                for i, c in enumerate(bits):
                    b[c] = maps[:, i]
            size = [len(s) for s in sigs]
            yield pd.DataFrame({**{c: np.repeat(b[c].to_numpy(), size) for c in b}, "sig": np.concatenate(sigs) if sigs else np.empty(0, np.int64)})

    cols = keep.split()
    types = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in df.select(*cols).schema] + ([] if one else ["n int", *[f"{c} bigint" for c in bits]]))
    return df.select(*cols, col).mapInPandas(run, types + ", sig bigint")


def _agree(a: str, b: str) -> F.Column:
    both = F.size(F.array_intersect(a, b))
    return both * 5 >= F.greatest(F.size(a), F.size(b)) * 4


def read(df: DataFrame) -> DataFrame:
    """(record_uuid, train, q, a, qid, cid): the sets of words and the ids of query class and class. Records without a
    key, a split or words in both texts can't overlap and are left out."""
    base = df.select(clean_key("record_uuid").alias("record_uuid"), (clean_key("split") == "train").alias("train"), "query", "answer").where("record_uuid IS NOT NULL AND train IS NOT NULL AND query IS NOT NULL AND answer IS NOT NULL")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"record_uuid": b["record_uuid"], "train": b["train"], "q": list(map(word_set, b["query"])), "a": list(map(word_set, b["answer"]))})

    r = base.mapInPandas(run, "record_uuid string, train boolean, q array<int>, a array<int>").where("size(q) > 0 AND size(a) > 0")
    return r.withColumn("qid", F.xxhash64("q")).withColumn("cid", F.xxhash64("q", "a"))


def linked_classes(r: DataFrame) -> DataFrame:
    """(t_cid, e_cid, q_share, a_share) of every pair of a training and an evaluation class that overlap; the shares are
    those of the evaluation record's words that the training record contains."""
    classes = r.groupBy("cid", "train").agg(F.first("qid").alias("qid"), F.first("a").alias("a"))
    queries = persist_table(r.groupBy("qid").agg(F.first("q").alias("q"), F.bool_or("train").alias("t"), F.bool_or(~F.col("train")).alias("e")), "queries")
    hashed = _with_hashes(queries, "q", _counts(queries, "q"), False, "qid t e")
    side = lambda which, x: hashed.where(which).select(F.col("qid").alias(f"{x}_qid"), "sig", *[F.col(c).alias(f"{x}_{c}") for c in ("n", *[f"b{i}" for i in range(BITMAP)])])
    n, m = F.col("t_n"), F.col("e_n")
    most = F.greatest(n, m)
    differ = sum((F.bit_count(F.col(f"t_b{i}").bitwiseXOR(F.col(f"e_b{i}"))) for i in range(BITMAP)), F.lit(0))
    possible = (F.least(n, m) * 5 >= most * 4) & (differ <= n + m - 2 * F.floor((most * 4 + 4) / 5))
    te = side("t", "t").join(side("e", "e"), "sig").where(possible & (F.col("t_qid") != F.col("e_qid"))).select("t_qid", "e_qid").distinct()
    q = queries.select("qid", "q")
    links = te.join(q.select(F.col("qid").alias("t_qid"), F.col("q").alias("tq")), "t_qid").join(q.select(F.col("qid").alias("e_qid"), F.col("q").alias("eq")), "e_qid").where(_agree("tq", "eq"))
    share = F.size(F.array_intersect("tq", "eq")) / F.size("eq")
    same = queries.where("t AND e").select(F.col("qid").alias("t_qid"), F.col("qid").alias("e_qid"), F.lit(1.0).alias("q_share"))
    links = persist_table(links.select("t_qid", "e_qid", share.alias("q_share")).unionAll(same), "links")
    # answers under linked queries, met through their rare words
    t = classes.where("train").join(links.select(F.col("t_qid").alias("qid")).distinct(), "qid", "left_semi")
    e = classes.where("NOT train").join(links.select(F.col("e_qid").alias("qid")).distinct(), "qid", "left_semi")
    both = persist_table(t.unionByName(e), "answers")
    hashed = _with_hashes(both, "a", _counts(both, "a"), True, "cid qid train")
    tw, ew = hashed.where("train").select(F.col("cid").alias("t_cid"), F.col("qid").alias("t_qid"), "sig"), hashed.where("NOT train").select(F.col("cid").alias("e_cid"), F.col("qid").alias("e_qid"), "sig")
    met = tw.join(links, "t_qid").join(ew, ["e_qid", "sig"]).groupBy("t_cid", "e_cid").agg(F.max("q_share").alias("q_share"))
    a = both.select("cid", "a", "train")
    found = met.join(a.where("train").select(F.col("cid").alias("t_cid"), F.col("a").alias("ta")), "t_cid").join(a.where("NOT train").select(F.col("cid").alias("e_cid"), F.col("a").alias("ea")), "e_cid").where(_agree("ta", "ea"))
    return found.select("t_cid", "e_cid", "q_share", (F.size(F.array_intersect("ta", "ea")) / F.size("ea")).alias("a_share"))


def _members(r: DataFrame) -> DataFrame:
    return r.select("cid", "train", "record_uuid").distinct()


def _broken(df: DataFrame, ids: DataFrame) -> DataFrame:
    """(u): those of the records `ids` (u) that have a defect, written as a table."""
    judged = df.withColumn("u", clean_key("record_uuid")).join(ids, "u", "left_semi").select(F.col("u").alias("record_uuid"), "query", "answer", *[c for c in df.columns if c == "language"])
    return persist_table(defects(judged, words_of=df).select(F.col("record_uuid").alias("u")), "broken")


def overlaps(df: DataFrame) -> DataFrame:
    """(train_uuid, eval_uuid, query_containment, answer_containment) of every pair of a training record and one of
    another split that overlap. Records with a defect don't count; repeated rows count once; null texts never overlap;
    rows with a null split or key are left out. An empty table gives no rows; extra columns are ignored."""
    r = persist_table(read(df), "words")
    links = linked_classes(r)
    member = _members(r)
    t, e = member.where("train").select(F.col("cid").alias("t_cid"), F.col("record_uuid").alias("train_uuid")), member.where("NOT train").select(F.col("cid").alias("e_cid"), F.col("record_uuid").alias("eval_uuid"))
    pairs = persist_table(links.join(t, "t_cid").join(e, "e_cid").where("train_uuid <> eval_uuid").groupBy("train_uuid", "eval_uuid").agg(F.max("q_share").alias("query_containment"), F.max("a_share").alias("answer_containment")), "pairs")
    broken = _broken(df, pairs.select(F.col("train_uuid").alias("u")).unionAll(pairs.select("eval_uuid")).distinct())
    for side in ("train_uuid", "eval_uuid"):
        pairs = pairs.join(broken.withColumnRenamed("u", side), side, "left_anti")
    return pairs.select("train_uuid", "eval_uuid", "query_containment", "answer_containment")


def overlap_counts(df: DataFrame) -> DataFrame:
    """(eval_uuid, n_pairs, answer_containment) of the evaluation records that overlap with training: the number of
    training records and the greatest containment, as `overlaps` has them, without pairing the members of linked classes:
    a class counts with the number of its training records. Only records that stand in several classes, delivered again
    with other texts, are paired, to count no pair twice."""
    r = persist_table(read(df), "words")
    links = persist_table(linked_classes(r), "classes")
    member = _members(r)
    met = links.select(F.col("t_cid").alias("cid")).unionAll(links.select("e_cid")).distinct()
    member = persist_table(member.join(met, "cid", "left_semi"), "members")
    broken = _broken(df, member.select(F.col("record_uuid").alias("u")).distinct())
    member = member.join(broken.withColumnRenamed("u", "record_uuid"), "record_uuid", "left_anti")
    t, e = member.where("train").select(F.col("cid").alias("t_cid"), F.col("record_uuid").alias("train_uuid")), member.where("NOT train").select(F.col("cid").alias("e_cid"), F.col("record_uuid").alias("eval_uuid"))
    sizes = t.groupBy("t_cid").agg(F.count(F.lit(1)).alias("n"))
    # per evaluation class first, however many members it has
    per_class = links.join(sizes, "t_cid").groupBy("e_cid").agg(F.sum("n").alias("n"), F.max("a_share").alias("c"))
    counts = e.join(per_class, "e_cid").groupBy("eval_uuid").agg(F.sum("n").alias("n"), F.max("c").alias("answer_containment"))
    several = member.groupBy("record_uuid").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("record_uuid")
    once = lambda d, c: d.join(several.withColumnRenamed("record_uuid", c), c, "left_semi")
    rest = lambda d, c: d.join(several.withColumnRenamed("record_uuid", c), c, "left_anti")
    part = lambda a, b: links.join(a, "t_cid").join(b, "e_cid").select("train_uuid", "eval_uuid")
    twice = part(once(t, "train_uuid"), e).unionAll(part(rest(t, "train_uuid"), once(e, "eval_uuid")))
    # of these pairs every one beyond the first, and every record paired with itself, is taken off
    twice = twice.groupBy("eval_uuid", "train_uuid").agg(F.count(F.lit(1)).alias("k"))
    off = twice.groupBy("eval_uuid").agg(F.sum(F.col("k") - (F.col("train_uuid") != F.col("eval_uuid")).cast("int")).alias("off"))
    n = F.col("n") - F.coalesce("off", F.lit(0))
    return counts.join(off, "eval_uuid", "left").select("eval_uuid", n.alias("n_pairs"), "answer_containment").where("n_pairs > 0")
