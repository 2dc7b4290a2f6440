"""Queries over the rater tables: consolidation, agreement, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolytics.functions.intervals import bootstrap_mean
from annolytics.operators import agreement as A
from annolytics.operators import clean as C
from annolytics.operators import consolidate as K
from annolytics.operators import metrics as M
from annolytics.sources.tables import clean_key, table

RET, GND = C.LABELS["retrieval"], C.LABELS["grounding"]
WS = "E' \\t\\n\\r'"
ORDER = ("inserted_at", "annotator_id")


def key(c: str) -> str:
    return f"nullif(lower(trim({c}, {WS})), '')"


# The rater tables with clean keys, as SQL
R_SQL = f"""r AS (SELECT {key("record_uuid")} AS record_uuid, {key("annotator_id")} AS annotator_id, {key("response_status")} AS status, calibration, inserted_at, {key("discard_reason")} AS discard_reason, notes, n_retrieved_chunks,
  CASE WHEN regexp_matches({key("chunk_id")}, '^.+-c[0-9]+$') THEN {key("chunk_id")} END AS chunk_id, chunk_rank, {", ".join(RET)} FROM retrieval_rows)"""
G_SQL = f"""g AS (SELECT {key("record_uuid")} AS record_uuid, {key("annotator_id")} AS annotator_id, {key("response_status")} AS status, calibration, inserted_at, {key("discard_reason")} AS discard_reason, notes, {", ".join(GND)} FROM grounding_rows)"""
SUB_R = "rs AS (SELECT * FROM r WHERE status = 'submitted' AND chunk_id IS NOT NULL AND " + " AND ".join(f"{c} IS NOT NULL" for c in RET) + ")"
SUB_G = "gs AS (SELECT * FROM g WHERE status = 'submitted' AND " + " AND ".join(f"{c} IS NOT NULL" for c in GND) + ")"


def majority_sql(src: str, keys: str, labels: tuple[str, ...], order: tuple[str, ...]) -> str:
    on = keys.replace(" ", "").split(",")
    agree = " AND ".join(f"(2*s_{c} = n_votes OR {c}::INT = (2*s_{c} > n_votes)::INT)" for c in labels)
    sort = ", ".join([f"NOT ({agree})", *order, *labels])
    return f"""mc AS (SELECT {keys}, count(*) AS n_votes, {", ".join(f"sum({c}::INT) AS s_{c}" for c in labels)} FROM {src} GROUP BY ALL),
mj AS (SELECT {src}.*, n_votes, {", ".join(f"s_{c}" for c in labels)}, row_number() OVER (PARTITION BY {", ".join(f"{src}.{k}" for k in on)} ORDER BY {sort}) AS rn FROM {src} JOIN mc USING ({keys})),
items AS (SELECT {keys}, n_votes, {", ".join(f"(CASE WHEN 2*s_{c} > n_votes THEN 1 WHEN 2*s_{c} < n_votes THEN 0 ELSE {c}::INT END)::INT AS {c}" for c in labels)} FROM mj WHERE rn = 1)"""


def retrieval(spark, d):
    return C.responses(table(spark, d, "retrieval_rows"), RET, chunk=True)


def grounding(spark, d):
    return C.responses(table(spark, d, "grounding_rows"), GND, chunk=False)


def ret_sub(spark, d):
    return C.submitted(retrieval(spark, d), RET).where("chunk_id IS NOT NULL")


def gnd_sub(spark, d):
    return C.submitted(grounding(spark, d), GND)


def ret_items(spark, d):
    """The consolidated items with their rank and the number k of chunks that were retrieved."""
    i = K.majority(ret_sub(spark, d), ("record_uuid", "chunk_id"), RET, ORDER, least=("chunk_rank",), most=("n_retrieved_chunks",))
    return i.withColumn("chunk_rank", F.col("chunk_rank").cast("int")).withColumnRenamed("n_retrieved_chunks", "k")


ITEMS_R = f"{R_SQL},\n{SUB_R},\n{majority_sql('rs', 'record_uuid, chunk_id', RET, ORDER)},\npl AS (SELECT record_uuid, chunk_id, min(chunk_rank)::INT AS chunk_rank, max(n_retrieved_chunks) AS k FROM rs GROUP BY ALL),\nit AS (SELECT * FROM items JOIN pl USING (record_uuid, chunk_id))"
ITEMS_G = f"{G_SQL},\n{SUB_G},\n{majority_sql('gs', 'record_uuid', GND, ORDER)}"
Q, S = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            S[f.__name__] = sql
        return f

    return add


_PANEL = """p AS (SELECT record_uuid, count(DISTINCT chunk_id) = max(k) AS complete, avg(topically_relevant) AS rel, max(evidence_sufficient) AS hit, avg(evidence_sufficient) AS suf, avg(misleading) AS mis,
  coalesce(1.0::DOUBLE / min(CASE WHEN topically_relevant = 1 THEN chunk_rank END), 0) AS rr FROM it GROUP BY 1)
SELECT count(*) FILTER (complete) AS n_panels, count(*) FILTER (NOT complete) AS n_panels_skipped, round(avg(rel) FILTER (complete), 6) AS topical_precision_at_k, round(avg(hit) FILTER (complete), 6) AS sufficiency_hit_at_k,
  round(avg(suf) FILTER (complete), 6) AS sufficiency_rate_at_k, round(avg(mis) FILTER (complete), 6) AS misleading_context_rate_at_k, round(avg(rr) FILTER (complete), 6) AS mean_reciprocal_rank_at_k FROM p"""


@query(f"WITH {ITEMS_R},\n{_PANEL}")
def panel_metrics(spark, d):
    return M.panel_metrics(ret_items(spark, d), "record_uuid", "chunk_id", "chunk_rank", "k")


_LI = "rs AS (SELECT l_orderkey AS record_uuid, l_linenumber AS chunk_id, l_linenumber AS chunk_rank, l_partkey, l_suppkey, l_quantity, l_returnflag = 'R' AS topically_relevant, l_linestatus = 'F' AS evidence_sufficient, l_discount >= 0.08 AS misleading FROM lineitem)"
_LI_ORDER = ("l_partkey", "l_suppkey", "l_quantity")


def line_responses(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("record_uuid"), F.col("l_linenumber").alias("chunk_id"), F.col("l_linenumber").alias("chunk_rank"), *_LI_ORDER,
        (F.col("l_returnflag") == "R").alias("topically_relevant"), (F.col("l_linestatus") == "F").alias("evidence_sufficient"), (F.col("l_discount") >= 0.08).alias("misleading"),
    )


@query(f"WITH {_LI},\n{majority_sql('rs', 'record_uuid, chunk_id', RET, _LI_ORDER)},\nit AS (SELECT *, chunk_id AS chunk_rank, max(chunk_id) OVER (PARTITION BY record_uuid) AS k FROM items),\n{_PANEL}")
def panel_metrics_lineitem(spark, d):
    """The flagship over the largest driver table: orders as queries, line numbers as chunks."""
    i = K.majority(line_responses(spark, d), ("record_uuid", "chunk_id"), RET, _LI_ORDER).withColumn("chunk_rank", F.col("chunk_id"))
    # a panel's k is its greatest line number, which the panel's own aggregate takes
    return M.panel_metrics(i.withColumn("k", F.col("chunk_id")), "record_uuid", "chunk_id", "chunk_rank", "k")


@query(f"""WITH {ITEMS_R},
gg AS (SELECT record_uuid, (topically_relevant + evidence_sufficient)::DOUBLE AS g, chunk_rank FROM it),
o AS (SELECT *, row_number() OVER (PARTITION BY record_uuid ORDER BY chunk_rank NULLS FIRST, g DESC) AS r, row_number() OVER (PARTITION BY record_uuid ORDER BY g DESC) AS i FROM gg)
SELECT record_uuid, round(coalesce(sum(g / log2(r + 1)) / nullif(sum(g / log2(i + 1)), 0), 0), 6) AS ndcg FROM o GROUP BY 1""")
def ndcg_at_k(spark, d):
    return M.ndcg(ret_items(spark, d), "record_uuid", "chunk_rank", F.col("topically_relevant") + F.col("evidence_sufficient"))


@query(f"WITH {ITEMS_R} SELECT record_uuid, chunk_id, n_votes, {', '.join(RET)} FROM items")
def majority_consolidation(spark, d):
    return K.majority(ret_sub(spark, d), ("record_uuid", "chunk_id"), RET, ORDER)


@query("WITH " + ITEMS_R + "\n" + " UNION ALL ".join(f"SELECT '{c}' AS label, count(*) AS n_items, sum({c})::BIGINT AS n_true, (count(*) - sum({c}))::BIGINT AS n_false, round(avg({c}), 6) AS prevalence FROM items" for c in RET))
def label_prevalence(spark, d):
    return K.prevalence(K.majority(ret_sub(spark, d), ("record_uuid", "chunk_id"), RET, ORDER), RET)


@query(f"WITH {R_SQL}, k AS (SELECT record_uuid FROM r GROUP BY 1 HAVING NOT bool_and(coalesce(calibration, false))) SELECT record_uuid, count(*) AS n_rows, count(*) FILTER (calibration) AS n_calibration FROM r WHERE record_uuid IN (SELECT record_uuid FROM k) GROUP BY 1")
def drop_wholly_calibration(spark, d):
    return C.drop_wholly_calibration(retrieval(spark, d)).groupBy("record_uuid").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("calibration").alias("n_calibration"))


def _ratings(spark, d, calibration: bool = True):
    """(source_domain, label, record_uuid, chunk_id, annotator_id, value): one rating per annotator, item and label.

    Agreement describes calibration rows only, the ones that several annotators share; calibration=False takes all."""
    s = ret_sub(spark, d)
    if calibration:
        s = s.where("calibration")
    s = s.groupBy("record_uuid", "chunk_id", "annotator_id").agg(F.max(F.struct("inserted_at", *[F.col(c).cast("int").alias(c) for c in RET])).alias("m"))
    dom = table(spark, d, "qa_records").select(clean_key("record_uuid").alias("record_uuid"), "source_domain").groupBy("record_uuid").agg(F.min("source_domain").alias("source_domain"))
    s = s.select("record_uuid", "chunk_id", "annotator_id", *[F.col(f"m.{c}").alias(c) for c in RET]).join(dom, "record_uuid")
    return K.melt(s, ("source_domain", "record_uuid", "chunk_id", "annotator_id"), RET)


def rate_sql(calibration: bool = True) -> str:
    return f"""WITH {R_SQL}, {SUB_R},
lt AS (SELECT *, row_number() OVER (PARTITION BY record_uuid, chunk_id, annotator_id ORDER BY inserted_at DESC, {", ".join(c + " DESC" for c in RET)}) AS rn FROM rs {"WHERE calibration" if calibration else ""}),
dom AS (SELECT {key("record_uuid")} AS record_uuid, min(source_domain) AS source_domain FROM qa_records GROUP BY 1),
w AS (SELECT lt.*, source_domain FROM lt JOIN dom USING (record_uuid) WHERE rn = 1),
ra AS ({" UNION ALL ".join(f"SELECT source_domain, '{c}' AS label, record_uuid, chunk_id, annotator_id, {c}::INT AS value FROM w" for c in RET)})"""


_RATE = rate_sql()


def _alpha_sql(keys: str) -> str:
    return f"""{_RATE}, ic AS (SELECT {keys}, record_uuid, chunk_id, count(*)::DOUBLE AS n, sum(value)::DOUBLE AS k FROM ra GROUP BY ALL HAVING count(*) >= 2),
s AS (SELECT {keys}, count(*) AS n_items, sum(n) AS nn, sum(k) AS kk, sum(2 * k * (n - k) / (n - 1)) AS d FROM ic GROUP BY ALL)
SELECT {keys}, n_items, nn::BIGINT AS n_ratings, (kk = 0 OR kk = nn) AS degenerate, round(CASE WHEN kk = 0 OR kk = nn THEN 1.0::DOUBLE ELSE 1 - d / nn / (2 * kk * (nn - kk) / (nn * (nn - 1))) END, 6) AS alpha FROM s"""


@query(_alpha_sql("source_domain, label"))
def alpha_by_group(spark, d):
    return A.alpha(A.item_counts(_ratings(spark, d), ("source_domain", "label"), ("record_uuid", "chunk_id")), ("source_domain", "label"))


@query(_alpha_sql("label"))
def alpha_pooled(spark, d):
    return A.alpha(A.item_counts(_ratings(spark, d), ("label",), ("record_uuid", "chunk_id")), ("label",))


@query()
def alpha_ci(spark, d):
    """A5: alpha per source_domain and label with its bootstrap interval (1,000 resamples of the items, seed 0)."""
    return A.alpha_interval(A.item_counts(_ratings(spark, d), ("source_domain", "label"), ("record_uuid", "chunk_id")), ("source_domain", "label"))


@query(f"{_RATE} SELECT label, count(*) AS n_ratings, sum(value)::BIGINT AS n_true, least(sum(value), count(*) - sum(value))::BIGINT AS n_minority, round(avg(value), 6) AS prevalence, round(CASE WHEN count(*) >= 2 THEN 2.0::DOUBLE * sum(value) * (count(*) - sum(value)) / (count(*)::DOUBLE * (count(*) - 1)) END, 6) AS expected_disagreement FROM ra GROUP BY 1")
def calibration_marginals(spark, d):
    return A.marginals(_ratings(spark, d), ("label",))


@query(f"{_RATE}, ic AS (SELECT label, count(*)::DOUBLE AS n, sum(value)::DOUBLE AS k FROM ra GROUP BY label, record_uuid, chunk_id HAVING count(*) >= 2) SELECT label, count(*) AS n_items, round(avg((k*(k-1) + (n-k)*(n-k-1)) / (n*(n-1))), 6) AS pct_agreement FROM ic GROUP BY 1")
def pct_agreement(spark, d):
    return A.percent_agreement(A.item_counts(_ratings(spark, d), ("label",), ("record_uuid", "chunk_id")), ("label",))


@query(f"{_RATE}, pi AS (SELECT source_domain, label, count(DISTINCT annotator_id) AS raters, min(value) AS lo, max(value) AS hi FROM ra GROUP BY source_domain, label, record_uuid, chunk_id) SELECT source_domain, label, count(*) FILTER (raters >= 2) AS n_overlap, CASE WHEN count(*) FILTER (raters >= 2) > 0 THEN min(lo) FILTER (raters >= 2) = max(hi) FILTER (raters >= 2) END AS degenerate FROM pi GROUP BY 1, 2")
def degenerate_overlap(spark, d):
    return A.degenerate_overlap(_ratings(spark, d), ("source_domain", "label"), ("record_uuid", "chunk_id"), "annotator_id")


@query(f"""{_RATE}, p AS (SELECT a.label, a.annotator_id AS annotator_a, b.annotator_id AS annotator_b, count(*) AS n_items, avg((a.value = b.value)::INT) AS po, avg(a.value) AS px, avg(b.value) AS py
  FROM ra a JOIN ra b ON a.label = b.label AND a.record_uuid = b.record_uuid AND a.chunk_id = b.chunk_id AND a.annotator_id < b.annotator_id GROUP BY ALL)
SELECT label, annotator_a, annotator_b, n_items, round(CASE WHEN px*py + (1-px)*(1-py) = 1 THEN 1.0::DOUBLE ELSE (po - (px*py + (1-px)*(1-py))) / (1 - (px*py + (1-px)*(1-py))) END, 6) + 0 AS kappa FROM p""")
def cohen_kappa_pairs(spark, d):
    return A.cohen_pairs(_ratings(spark, d).drop("source_domain"), ("label",), ("record_uuid", "chunk_id"), "annotator_id")


def gnd_items(spark, d):
    return K.majority(gnd_sub(spark, d), ("record_uuid",), GND, ORDER)


_W = "1.96::DOUBLE"


@query(f"""WITH {ITEMS_G}, m AS ({" UNION ALL ".join(f"SELECT '{c}' AS label, count(*) AS n, sum({c})::BIGINT AS k FROM items" for c in GND)}), x AS (SELECT *, k / n::DOUBLE AS p, {_W} AS z FROM m)
SELECT label, n, k, round(p, 6) AS rate, round(greatest(0.0::DOUBLE, ((p + z*z/(2*n)) - z*sqrt(p*(1-p)/n + z*z/(4.0::DOUBLE*n*n))) / (1 + z*z/n)), 6) AS ci_lower, round(least(1.0::DOUBLE, ((p + z*z/(2*n)) + z*sqrt(p*(1-p)/n + z*z/(4.0::DOUBLE*n*n))) / (1 + z*z/n)), 6) AS ci_upper FROM x""")
def rates_wilson(spark, d):
    return M.rates(gnd_items(spark, d), GND)


@query(f"WITH {ITEMS_G} SELECT count(*) FILTER (source_cited = 1) AS n, count(*) FILTER (source_cited = 1 AND fabricated_source = 1) AS k, round(count(*) FILTER (source_cited = 1 AND fabricated_source = 1) / nullif(count(*) FILTER (source_cited = 1), 0)::DOUBLE, 6) AS rate FROM items")
def conditional_rate(spark, d):
    return M.conditional_rate(gnd_items(spark, d), "source_cited", "fabricated_source")


_CON = {"r": ("sufficient_implies_relevant", "sufficient_excludes_misleading"), "g": ("contradicted_implies_unsupported", "fabricated_implies_cited")}
_ints = lambda cols: ", ".join(f"{c}::INT AS {c}" for c in cols)


@query(f"WITH {R_SQL}, {SUB_R}, {G_SQL}, {SUB_G}, ri AS (SELECT {_ints(RET)} FROM rs), gi AS (SELECT {_ints(GND)} FROM gs) " + " UNION ALL ".join(f"SELECT '{c}' AS constraint_id, count(*) FILTER ({M.CONSTRAINTS[c]}) AS n_violations, count(*) AS n_rows FROM {t}i" for t, cs in _CON.items() for c in cs))
def constraint_violations(spark, d):
    ints = lambda df, cols: df.select(*[F.col(c).cast("int").alias(c) for c in cols])
    return M.violations(ints(ret_sub(spark, d), RET), _CON["r"]).unionByName(M.violations(ints(gnd_sub(spark, d), GND), _CON["g"]))


_MET = " UNION ALL ".join(f"SELECT '{m}' AS metric, '{l}' AS label" for m, v in M.SOURCES.items() for l in v)


@query(f"WITH al AS ({_alpha_sql('label')}), m AS ({_MET}), j AS (SELECT metric, label, alpha, n_items, degenerate, row_number() OVER (PARTITION BY metric ORDER BY alpha, label) AS rn FROM m LEFT JOIN al USING (label)) SELECT metric, alpha AS alpha_min, CASE WHEN alpha IS NOT NULL THEN label END AS alpha_min_label, n_items AS alpha_min_n, degenerate AS alpha_min_degenerate FROM j WHERE rn = 1")
def weakest_alpha(spark, d):
    return M.weakest_alpha(M.SOURCES, alpha_pooled(spark, d))


@query(f"""WITH {R_SQL}, {SUB_R}, dom AS (SELECT {key("record_uuid")} AS record_uuid, min(source_domain) AS source_domain FROM qa_records GROUP BY 1), sc AS (SELECT DISTINCT source_domain FROM dom UNION SELECT 'no-such-domain'),
a AS (SELECT source_domain, count(*) AS n_raw FROM r JOIN dom USING (record_uuid) GROUP BY 1), b AS (SELECT source_domain, count(*) AS n_kept FROM rs JOIN dom USING (record_uuid) WHERE calibration GROUP BY 1)
SELECT source_domain, coalesce(n_raw, 0) AS n_raw, coalesce(n_kept, 0) AS n_kept, CASE WHEN n_raw IS NULL THEN 'no_data' WHEN n_kept IS NULL THEN 'no_rows_after_filter' ELSE 'ok' END AS status FROM sc LEFT JOIN a USING (source_domain) LEFT JOIN b USING (source_domain)""")
def status_scaffold(spark, d):
    dom = table(spark, d, "qa_records").select(clean_key("record_uuid").alias("record_uuid"), "source_domain").groupBy("record_uuid").agg(F.min("source_domain").alias("source_domain"))
    sc = dom.select("source_domain").union(spark.createDataFrame([("no-such-domain",)], "source_domain string")).distinct()
    return M.status_scaffold(sc, retrieval(spark, d).join(dom, "record_uuid"), ret_sub(spark, d).where("calibration").join(dom, "record_uuid"), ("source_domain",))


@query("""WITH i AS (SELECT c_custkey - 1 AS i, c_acctbal AS v FROM customer), n AS (SELECT count(*) AS n FROM i), dr AS (SELECT b, (('0x' || substr(md5('0:' || b || ':' || x), 1, 8))::BIGINT) % n.n AS i FROM n, range(1000) t(b), range(n.n) u(x)),
m AS (SELECT b, avg(v) AS m FROM dr JOIN i USING (i) GROUP BY 1) SELECT round((SELECT avg(v) FROM i), 6) AS mean, round(quantile_cont(m, 0.025), 6) AS ci_lower, round(quantile_cont(m, 0.975), 6) AS ci_upper FROM m""")
def bootstrap_ci(spark, d):
    c = table(spark, d, "customer").select((F.col("c_custkey") - 1).alias("i"), F.col("c_acctbal").alias("v"))
    return bootstrap_mean(c, "v", "i", c.count(), 1000)


QUERIES, ORACLE = Q, S
