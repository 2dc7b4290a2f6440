"""Queries of the operators for training data, and the SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolytics.llm import consensus as cs
from annolytics.llm import defects, encode, mix, overlap, pii, related, split
from annolytics.session import persist_table
from annolytics.sources.tables import clean_key, table


def p1_found(spark, sf_dir):
    p = overlap.overlaps(table(spark, sf_dir, "qa_records"))
    return p.select(F.least("train_uuid", "eval_uuid").alias("record_uuid_a"), F.greatest("train_uuid", "eval_uuid").alias("record_uuid_b"))


def p1_report(spark, sf_dir):
    """Per split and source_domain of the evaluation side: its records, those that overlap with training, and the pairs."""
    q = table(spark, sf_dir, "qa_records").select(clean_key("record_uuid").alias("eval_uuid"), clean_key("split").alias("split"), "source_domain").where("split <> 'train'").dropDuplicates(["eval_uuid"])
    p = overlap.overlap_counts(table(spark, sf_dir, "qa_records")).select("eval_uuid", F.col("n_pairs").alias("n"), F.col("answer_containment").alias("c"))
    return q.join(p, "eval_uuid", "left").groupBy("split", "source_domain").agg(F.count(F.lit(1)).alias("n_records"), F.count("n").alias("n_overlapping"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"), F.round(F.avg("c"), 6).alias("mean_containment"))


def p2_found(spark, sf_dir):
    p = split.pieces(table(spark, sf_dir, "qa_records").withColumn("record_uuid", clean_key("record_uuid")), ("record_uuid",), ("context_set", "answer"), with_text=False)
    # a record that was delivered with several long texts is one row
    return p.where("piece_no = 2").select("record_uuid", "field_name").distinct()


def p2_pieces(spark, sf_dir):
    q = table(spark, sf_dir, "qa_records").withColumn("record_uuid", clean_key("record_uuid"))
    return split.pieces(q, ("record_uuid",), ("context_set", "answer"))


def p3_found(spark, sf_dir):
    g = related.related_records(table(spark, sf_dir, "retrieval_rows"), table(spark, sf_dir, "qa_records"))
    return g.where("size > 1").select("record_uuid", "group_uuid")


def p3_splits(spark, sf_dir):
    g = persist_table(related.related_records(table(spark, sf_dir, "retrieval_rows"), table(spark, sf_dir, "qa_records")), "groups")
    dealt = related.deal(g.select("group_uuid", "size").distinct())
    return g.select("record_uuid", "group_uuid").join(dealt.select("group_uuid", "split"), "group_uuid").select("record_uuid", "group_uuid", "split")


def _votes(spark, sf_dir):
    a = cs.votes(table(spark, sf_dir, "retrieval_rows"), "topically_relevant", chunk=True)
    return a.unionByName(cs.votes(table(spark, sf_dir, "grounding_rows"), "support_present", chunk=False))


def p4_found(spark, sf_dir):
    items, _ = cs.consensus(_votes(spark, sf_dir))
    return items.where("n_votes >= 3 AND p_true > 0.5").select("label_name", "record_uuid", "chunk_id")


def p4_items(spark, sf_dir):
    items, _ = cs.consensus(_votes(spark, sf_dir))
    return items.select("label_name", "record_uuid", "chunk_id", "n_votes", "n_true", F.round("p_true", 6).alias("p_true"), "agreement")


def p4_annotators(spark, sf_dir):
    return cs.consensus(_votes(spark, sf_dir))[1]


def p4_alpha(spark, sf_dir):
    v = _votes(spark, sf_dir).groupBy("label_name", "record_uuid", "chunk_id").agg(F.count(F.lit(1)).alias("n_votes"), F.sum("vote").alias("n_true"))
    return cs.alpha(v).select("label_name", "n_items", F.round("alpha", 6).alias("alpha"))


def p6_found(spark, sf_dir):
    return defects.defects(table(spark, sf_dir, "qa_records"))


def p7_ids(spark, sf_dir):
    return encode.encode(table(spark, sf_dir, "documents"))


def _mix(spark, sf_dir):
    sized = encode.encode(table(spark, sf_dir, "documents"), count_only=True, keep=("source",))
    return mix.mixed(persist_table(sized, "sizes"), table(spark, sf_dir, "mix_targets"))


def p8_mix(spark, sf_dir):
    return _mix(spark, sf_dir)[0]


def p8_shares(spark, sf_dir):
    return _mix(spark, sf_dir)[1].withColumn("actual_share", F.round("actual_share", 6))


def p9_found(spark, sf_dir):
    m = pii.mentions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "name_hints"))
    return m.select("doc_id", "kind", "start_pos")


def p9_masked(spark, sf_dir):
    return pii.mask(table(spark, sf_dir, "documents"), table(spark, sf_dir, "name_hints"))


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p2_found, p2_pieces, p3_found, p3_splits, p4_found, p4_items, p4_annotators, p4_alpha, p6_found, p7_ids, p8_mix, p8_shares, p9_found, p9_masked)}

_STRIP = "E' \\t\\n\\r'"


def _vote_sql(table_name: str, label: str, chunk: str, where: str) -> str:
    return f"""SELECT '{label}' AS label_name, record_uuid, chunk_id, annotator_id, v FROM (
  SELECT lower(trim(record_uuid, {_STRIP})) AS record_uuid, {chunk} AS chunk_id, lower(trim(annotator_id, {_STRIP})) AS annotator_id, {label} AS v, inserted_at AS t
  FROM {table_name} WHERE lower(trim(response_status, {_STRIP})) = 'submitted' AND {label} IS NOT NULL)
WHERE {where} QUALIFY row_number() OVER (PARTITION BY record_uuid, chunk_id, annotator_id ORDER BY t DESC, v DESC) = 1"""


_TIDY = r"replace(replace(replace(replace(regexp_replace(lower(trim(source_domain, E' \t\n\r')), '[\s_]+', '-', 'g'), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss')"
_RID, _CID = f"nullif(lower(trim(record_uuid, {_STRIP})), '')", f"lower(trim(chunk_id, {_STRIP}))"

ORACLE = {
    # the reachable records of each record, by all paths over shared documents
    "p3_found": f"""
WITH RECURSIVE rr AS (SELECT {_RID} AS r, {_CID} AS c, nullif({_TIDY}, '') AS own FROM retrieval_rows WHERE {_RID} IS NOT NULL),
kn AS (SELECT {_RID} AS r, min(nullif({_TIDY}, '')) AS dom FROM qa_records GROUP BY 1), sp AS (SELECT r, min(own) AS own FROM rr GROUP BY 1),
ids AS (SELECT sp.r, coalesce(dom, own) AS dom FROM sp LEFT JOIN kn USING (r)),
ed AS (SELECT DISTINCT rr.r, dom || ':' || regexp_extract(c, '^(.+)-c[0-9]+$', 1) AS doc FROM rr JOIN ids USING (r) WHERE regexp_matches(c, '^.+-c[0-9]+$') AND dom IS NOT NULL),
nb AS (SELECT DISTINCT a.r AS a, b.r AS b FROM ed a JOIN ed b USING (doc)),
tc AS (SELECT DISTINCT r, r AS t FROM ed UNION SELECT tc.r, nb.b FROM tc JOIN nb ON tc.t = nb.a)
SELECT r AS record_uuid, min(t) AS group_uuid FROM tc GROUP BY 1 HAVING count(*) > 1""",
    "p2_found": f"""
SELECT DISTINCT lower(trim(record_uuid, {_STRIP})) AS record_uuid, f AS field_name
FROM (SELECT record_uuid, 'context_set' AS f, context_set AS t FROM qa_records UNION ALL SELECT record_uuid, 'answer', answer FROM qa_records) WHERE length(t) > 2000""",
    "p4_alpha": f"""
WITH v AS ({_vote_sql("retrieval_rows", "topically_relevant", f"lower(trim(chunk_id, {_STRIP}))", "regexp_matches(chunk_id, '^.+-c[0-9]+$')")} UNION ALL {_vote_sql("grounding_rows", "support_present", "''", "true")}),
i AS (SELECT label_name, record_uuid, chunk_id, count(*)::DOUBLE AS n, sum(v::INT)::DOUBLE AS k FROM v GROUP BY ALL HAVING count(*) > 1),
s AS (SELECT label_name, count(*) AS n_items, sum(n) AS nn, sum(k) AS kk, sum(2 * k * (n - k) / (n - 1)) AS d FROM i GROUP BY ALL)
SELECT label_name, n_items, round(CASE WHEN kk = 0 OR kk = nn THEN 1 ELSE 1 - (d / nn) / (2 * kk * (nn - kk) / (nn * (nn - 1))) END, 6) AS alpha FROM s""",
}
