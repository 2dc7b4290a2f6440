"""Report tables over the rater tables and the response log."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolytics.operators import agreement as A, cadence, clean as C, consolidate as K, reports as T
from annolytics.plans import annotation as P
from annolytics.plans.operations import _EV, _gap_sql, events
from annolytics.sources.tables import clean_key, micros, table

Q, S = {}, {}
key = P.key


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            S[f.__name__] = sql
        return f

    return add


def domains(spark, d):
    return table(spark, d, "qa_records").select(clean_key("record_uuid").alias("record_uuid"), "source_domain").groupBy("record_uuid").agg(F.min("source_domain").alias("domain"))


def responses(spark, d):
    """The long form of both tasks' responses (see operators/reports.py)."""
    out = None
    for task in ("retrieval", "grounding"):
        t = table(spark, d, f"{task}_rows")
        cid = clean_key("chunk_id") if task == "retrieval" else F.lit("")
        x = t.select(
            F.lit(task).alias("task"), clean_key("record_uuid").alias("record_uuid"), (F.when(cid.rlike(C.CHUNK_ID), cid) if task == "retrieval" else cid).alias("item"), clean_key("annotator_id").alias("annotator_id"),
            clean_key("response_status").alias("status"), F.coalesce("calibration", F.lit(False)).alias("cal"), clean_key("record_status").alias("record_status"), micros("inserted_at").alias("us"),
            F.coalesce(clean_key("discard_reason"), F.lit("unspecified")).alias("reason"), "notes",
        ).where("item IS NOT NULL")
        out = x if out is None else out.unionByName(x)
    return out.join(domains(spark, d), "record_uuid")


def _x(task: str) -> str:
    item = f"CASE WHEN regexp_matches({key('chunk_id')}, '^.+-c[0-9]+$') THEN {key('chunk_id')} END" if task == "retrieval" else "''"
    return f"SELECT '{task}' AS task, {key('record_uuid')} AS record_uuid, {item} AS item, {key('annotator_id')} AS annotator_id, {key('response_status')} AS status, coalesce(calibration, false) AS cal, {key('record_status')} AS record_status, epoch_us(inserted_at) AS us, coalesce({key('discard_reason')}, 'unspecified') AS reason, notes FROM {task}_rows"


X = f"dom AS (SELECT {key('record_uuid')} AS record_uuid, min(source_domain) AS domain FROM qa_records GROUP BY 1), x AS (SELECT u.*, domain FROM ({_x('retrieval')} UNION ALL {_x('grounding')}) u JOIN dom USING (record_uuid) WHERE item IS NOT NULL)"


def counts_sql(keys: str, src: str = "x") -> str:
    """The SQL of record_counts as a CTE rc."""
    k = keys + ", " if keys else ""
    g = f"GROUP BY {keys}" if keys else ""
    return f"""it AS (SELECT {k}record_uuid, item, bool_or(record_status = 'completed') AS done, count(*) FILTER (status = 'submitted') AS sub, count(*) FILTER (status = 'discarded') AS dis FROM {src} GROUP BY {k}record_uuid, item),
rc0 AS (SELECT {k}count(*) AS n_records, count(*) FILTER (done) AS n_completed, count(*) FILTER (NOT coalesce(done, false)) AS n_pending, sum(sub)::BIGINT AS n_submitted, sum(dis)::BIGINT AS n_discarded, count(*) FILTER (sub > 0) AS n_items_annotated FROM it {g}),
wh AS (SELECT {k}count(DISTINCT annotator_id) AS n_annotators FROM {src} {g}), rc AS (SELECT * FROM rc0 {f"JOIN wh USING ({keys})" if keys else "CROSS JOIN wh"})"""


_REASON_COLS = ", ".join(f"count(*) FILTER (status = 'discarded' AND (CASE WHEN reason IN ({', '.join(repr(r) for r in T.REASONS)}) THEN reason ELSE 'other' END) = '{r}') AS discard_{r}" for r in T.REASONS)
_GAPS = """sb AS (SELECT DISTINCT domain, task, annotator_id, us, record_uuid, item FROM x WHERE status = 'submitted' AND us IS NOT NULL AND annotator_id IS NOT NULL),
ga AS (SELECT domain, task, us - lag(us) OVER (PARTITION BY domain, task, annotator_id ORDER BY us, record_uuid || ':' || item) AS g FROM sb),
ca AS (SELECT domain, task, count(*) AS n_gaps_used, round(CASE WHEN count(*) >= 5 THEN quantile_cont(g / 1e6, 0.5) END, 1) AS median_gap_s, round(CASE WHEN count(*) >= 5 THEN avg(g / 1e6) END, 1) AS mean_gap_s,
  round(CASE WHEN count(*) >= 5 THEN quantile_cont(g / 1e6, 0.25) END, 1) AS gap_p25_s, round(CASE WHEN count(*) >= 5 THEN quantile_cont(g / 1e6, 0.75) END, 1) AS gap_p75_s FROM ga WHERE g <= 1800000000 GROUP BY 1, 2)"""
_PANELS = f"""pn AS (SELECT domain, count(*) AS n_panels, count(*) FILTER (done) AS n_panels_complete FROM (SELECT domain, record_uuid, count(DISTINCT chunk_id) FILTER (status = 'submitted') >= max(n_retrieved_chunks) AS done
  FROM r JOIN dom USING (record_uuid) WHERE chunk_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"""


def panels(spark, d):
    """(domain, record_uuid, complete) of every retrieval panel; complete when every chunk has a submitted response."""
    r = P.retrieval(spark, d).where("chunk_id IS NOT NULL").join(domains(spark, d), "record_uuid")
    chunks = r.groupBy("domain", "record_uuid", "chunk_id").agg(F.bool_or(F.col("status") == "submitted").alias("s"), F.max("n_retrieved_chunks").alias("k"))
    return chunks.groupBy("domain", "record_uuid").agg((F.count_if("s") >= F.max("k")).alias("complete"))


@query(f"""WITH {P.R_SQL}, {X}, {counts_sql("domain, task")}, re AS (SELECT domain, task, {_REASON_COLS} FROM x GROUP BY 1, 2), {_GAPS}, {_PANELS},
sc AS (SELECT domain, task FROM (SELECT DISTINCT domain FROM dom), (SELECT unnest(['retrieval', 'grounding']) AS task))
SELECT domain, task, n_records AS n_records_live, n_completed AS n_records_completed, n_pending AS n_records_pending, n_submitted AS n_responses_submitted, n_items_annotated, n_annotators, n_discarded AS n_responses_discarded,
  round(n_discarded / nullif(n_discarded + n_submitted, 0)::DOUBLE, 6) AS discard_rate, {", ".join(f"discard_{r}" for r in T.REASONS)}, median_gap_s, mean_gap_s, gap_p25_s, gap_p75_s, n_gaps_used,
  CASE WHEN task = 'retrieval' THEN n_panels END AS n_panels, CASE WHEN task = 'retrieval' THEN n_panels_complete END AS n_panels_complete
FROM sc LEFT JOIN rc USING (domain, task) LEFT JOIN re USING (domain, task) LEFT JOIN ca USING (domain, task) LEFT JOIN pn USING (domain)""")
def ops_report(spark, d):
    """A19 with all its columns: one row per domain and task, blank where nothing was recorded."""
    x, k = responses(spark, d), ("domain", "task")
    sub = x.where("status = 'submitted' AND us IS NOT NULL AND annotator_id IS NOT NULL").select("domain", "task", "annotator_id", "us", F.concat_ws(":", "record_uuid", "item").alias("rec")).distinct()
    gaps = cadence.pooled(sub, k, "annotator_id", "us", "rec", 1800, quartiles=True).where("n_gaps_used > 0")
    gaps = gaps.select(*k, "n_gaps_used", F.col("median_s").alias("median_gap_s"), F.col("mean_s").alias("mean_gap_s"), F.col("p25_s").alias("gap_p25_s"), F.col("p75_s").alias("gap_p75_s"))
    pn = panels(spark, d).groupBy("domain").agg(F.count(F.lit(1)).alias("n_panels"), F.count_if("complete").alias("n_panels_complete")).withColumn("task", F.lit("retrieval"))
    sc = domains(spark, d).select("domain").distinct().withColumn("task", F.explode(F.array(F.lit("retrieval"), F.lit("grounding"))))
    rc, re = T.record_counts(x, k), x.groupBy(*k).agg(F.lit(1)).select(*k).join(T.reason_counts(x, k), [*k], "left").na.fill(0)
    j = sc.join(rc, [*k], "left").join(re, [*k], "left").join(gaps, [*k], "left").join(pn, [*k], "left")
    return j.select(
        *k, F.col("n_records").alias("n_records_live"), F.col("n_completed").alias("n_records_completed"), F.col("n_pending").alias("n_records_pending"), F.col("n_submitted").alias("n_responses_submitted"), "n_items_annotated", "n_annotators",
        F.col("n_discarded").alias("n_responses_discarded"), T.share("n_discarded", F.col("n_discarded") + F.col("n_submitted")).alias("discard_rate"), *[f"discard_{r}" for r in T.REASONS],
        "median_gap_s", "mean_gap_s", "gap_p25_s", "gap_p75_s", "n_gaps_used", "n_panels", "n_panels_complete",
    )


# --- labels of both tasks -----------------------------------------------------------------------------------------
def all_ratings(spark, d, calibration: bool):
    """(domain, task, label, record_uuid, item, annotator_id, value) of submitted rows, the annotator's latest on an item."""
    out = None
    for task, labels in (("retrieval", P.RET), ("grounding", P.GND)):
        s = P.ret_sub(spark, d).withColumn("item", F.col("chunk_id")) if task == "retrieval" else P.gnd_sub(spark, d).withColumn("item", F.lit(""))
        s = s.where("calibration") if calibration else s
        s = s.groupBy("record_uuid", "item", "annotator_id").agg(F.max(F.struct("inserted_at", *[F.col(c).cast("int").alias(c) for c in labels])).alias("m")).select("record_uuid", "item", "annotator_id", *[F.col(f"m.{c}").alias(c) for c in labels])
        m = K.melt(s.join(domains(spark, d), "record_uuid").withColumn("task", F.lit(task)), ("domain", "task", "record_uuid", "item", "annotator_id"), labels)
        out = m if out is None else out.unionByName(m)
    return out


def _ar(name: str, calibration: bool) -> str:
    def one(task, src, item, labels):
        order = ", ".join(c + " DESC" for c in labels)
        base = f"(SELECT *, {item} AS item FROM {src} {'WHERE calibration' if calibration else ''} QUALIFY row_number() OVER (PARTITION BY record_uuid, {item}, annotator_id ORDER BY inserted_at DESC, {order}) = 1)"
        return " UNION ALL ".join(f"SELECT domain, '{task}' AS task, '{c}' AS label, record_uuid, item, annotator_id, {c}::INT AS value FROM {base} JOIN dom USING (record_uuid)" for c in labels)

    return f"{name} AS ({one('retrieval', 'rs', 'chunk_id', P.RET)} UNION ALL {one('grounding', 'gs', repr(''), P.GND)})"


_BASE = f"{P.R_SQL}, {P.SUB_R}, {P.G_SQL}, {P.SUB_G}, dom AS (SELECT {key('record_uuid')} AS record_uuid, min(source_domain) AS domain FROM qa_records GROUP BY 1)"


def _agree_sql(keys: str, src: str = "cr") -> str:
    """alpha, pct_agreement and pairable items by keys, as a CTE ag."""
    return f"""ic AS (SELECT {keys}, count(*)::DOUBLE AS n, sum(value)::DOUBLE AS k FROM {src} GROUP BY {keys}, record_uuid, item{", domain" if "domain" not in keys else ""} HAVING count(*) >= 2),
ag0 AS (SELECT {keys}, count(*) AS n_items, sum(n) AS nn, sum(k) AS kk, sum(2 * k * (n - k) / (n - 1)) AS dd, avg((k*(k-1) + (n-k)*(n-k-1)) / (n*(n-1))) AS pa FROM ic GROUP BY {keys}),
ag AS (SELECT {keys}, n_items, (kk = 0 OR kk = nn) AS degenerate, round(pa, 6) AS pct_agreement, round(CASE WHEN kk = 0 OR kk = nn THEN 1.0::DOUBLE ELSE 1 - dd / nn / (2 * kk * (nn - kk) / (nn * (nn - 1))) END, 6) AS alpha FROM ag0)"""


def _agreement(r, keys):
    c = A.item_counts(r, keys, ("record_uuid", "item"))
    return A.alpha(c, keys).drop("n_ratings").join(A.percent_agreement(c, keys).drop("n_items"), [*keys])


def _majority_items(spark, d):
    """(domain, task, label, value) of the consolidated items of both tasks."""
    r = P.ret_items(spark, d).join(domains(spark, d), "record_uuid").withColumn("task", F.lit("retrieval"))
    g = P.gnd_items(spark, d).join(domains(spark, d), "record_uuid").withColumn("task", F.lit("grounding"))
    return K.melt(r, ("domain", "task", "record_uuid"), P.RET).unionByName(K.melt(g, ("domain", "task", "record_uuid"), P.GND))


_MAJ = f"ri AS ({{r}}), gi AS ({{g}}), mi AS ({' UNION ALL '.join([f'''SELECT domain, 'retrieval' AS task, '{c}' AS label, {c} AS value FROM ri JOIN dom USING (record_uuid)''' for c in P.RET] + [f'''SELECT domain, 'grounding' AS task, '{c}' AS label, {c} AS value FROM gi JOIN dom USING (record_uuid)''' for c in P.GND])})"


def _maj_sql() -> str:
    r, g = P.majority_sql("rs", "record_uuid, chunk_id", P.RET, P.ORDER), P.majority_sql("gs", "record_uuid", P.GND, P.ORDER)
    return _MAJ.format(r=f"WITH {r} SELECT * FROM items", g=f"WITH {g} SELECT * FROM items")


@query(f"""WITH {_BASE}, {_ar("cr", True)}, {_ar("al", False)}, {_agree_sql("domain, task, label")}, {_maj_sql()},
sc AS (SELECT domain, task, label FROM (SELECT DISTINCT domain FROM dom), (SELECT DISTINCT task, label FROM (VALUES {", ".join([f"('retrieval', '{c}')" for c in P.RET] + [f"('grounding', '{c}')" for c in P.GND])}) t(task, label))),
m AS (SELECT domain, task, label, count(*) AS n_items, sum(value)::BIGINT AS n_true FROM mi GROUP BY ALL), w AS (SELECT domain, task, label, count(DISTINCT annotator_id) AS n_annotators FROM al GROUP BY ALL)
SELECT domain, task, label, coalesce(m.n_items, 0) AS n_items, coalesce(n_annotators, 0) AS n_annotators, coalesce(n_true, 0) AS n_true, pct_agreement AS pct_agree, alpha, ag.n_items AS n_items_calibration, degenerate AS degenerate_calibration
FROM sc LEFT JOIN m USING (domain, task, label) LEFT JOIN w USING (domain, task, label) LEFT JOIN ag USING (domain, task, label)""")
def label_table(spark, d):
    """One row per domain, task and label: consolidated items, annotators, agreement on the calibration overlap."""
    k = ("domain", "task", "label")
    sc = domains(spark, d).select("domain").distinct().withColumn("x", F.explode(F.array(*[F.struct(F.lit(t).alias("task"), F.lit(c).alias("label")) for t, ls in (("retrieval", P.RET), ("grounding", P.GND)) for c in ls]))).select("domain", "x.*")
    m = _majority_items(spark, d).groupBy(*k).agg(F.count("value").alias("n_items"), F.sum("value").cast("bigint").alias("n_true"))
    w = all_ratings(spark, d, False).groupBy(*k).agg(F.count_distinct("annotator_id").alias("n_annotators"))
    ag = _agreement(all_ratings(spark, d, True), k).select(*k, F.col("pct_agreement").alias("pct_agree"), "alpha", F.col("n_items").alias("n_items_calibration"), F.col("degenerate").alias("degenerate_calibration"))
    j = sc.join(m, [*k], "left").join(w, [*k], "left").na.fill(0, ["n_items", "n_true", "n_annotators"]).join(ag, [*k], "left")
    return j.select(*k, "n_items", "n_annotators", "n_true", "pct_agree", "alpha", "n_items_calibration", "degenerate_calibration")


@query()
def label_table_bounds(spark, d):
    """A20's two columns of bounds: alpha_ci_low and alpha_ci_high beside its keys (1,000 resamples, seed 0)."""
    k = ("domain", "task", "label")
    ci = A.alpha_interval(A.item_counts(all_ratings(spark, d, True), k, ("record_uuid", "item")), k)
    return ci.select(*k, "alpha", F.col("ci_lower").alias("alpha_ci_low"), F.col("ci_upper").alias("alpha_ci_high"))


@query(f"WITH {_BASE}, {_ar('al', False)}, st AS (SELECT task, label, count(*) AS n, sum(value)::BIGINT AS n_true FROM al GROUP BY ALL) SELECT task, label, n, n_true, round(n_true / n::DOUBLE, 6) AS prevalence, least(n_true, n - n_true) = 0 AS degenerate, (least(n_true, n - n_true) > 0 AND least(n_true, n - n_true) / n::DOUBLE < 0.05) AS near_degenerate FROM st")
def label_stats(spark, d):
    return T.label_stats(all_ratings(spark, d, False), ("task", "label"))


@query(f"""WITH {_BASE}, {_ar('al', False)}, w AS (SELECT domain, task, label, annotator_id, count(*) AS n, avg(value) AS p FROM al GROUP BY ALL), pl AS (SELECT domain, task, label, avg(value) AS pool, count(*) AS n_pool FROM al GROUP BY ALL HAVING count(DISTINCT annotator_id) >= 2),
b AS (SELECT w.domain, w.task, annotator_id, sum(n)::BIGINT AS n, sum(abs(p - pool) * n) / sum(n) AS mad, max(n_pool) AS n_pool, count(*) FILTER (abs(p - pool) >= 0.2 AND n >= 5) AS n_substantial FROM w JOIN pl USING (domain, task, label) GROUP BY ALL)
SELECT domain, task, annotator_id, n, round(mad, 6) AS mean_abs_delta, n_pool, n_substantial FROM b""")
def annotator_bias_worst(spark, d):
    """Per annotator the n-weighted mean distance from the pool over the labels, with the pool's size."""
    r, k = all_ratings(spark, d, False), ("domain", "task", "label")
    own = r.groupBy(*k, "annotator_id").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("p"))
    pool = r.groupBy(*k).agg(F.avg("value").alias("pool"), F.count(F.lit(1)).alias("n_pool"), F.count_distinct("annotator_id").alias("w")).where("w >= 2")
    far = F.abs(F.col("p") - F.col("pool"))
    j = own.join(pool, [*k]).groupBy("domain", "task", "annotator_id").agg(F.sum("n").alias("n"), F.round(F.sum(far * F.col("n")) / F.sum("n"), 6).alias("mean_abs_delta"), F.max("n_pool").alias("n_pool"), F.count_if((far >= 0.2) & (F.col("n") >= 5)).alias("n_substantial"))
    return j


# --- R1 to R11 ----------------------------------------------------------------------------------------------------
@query(f"""WITH {P.R_SQL}, {X}, y AS (SELECT *, CASE WHEN cal THEN 'calibration' ELSE 'production' END AS split FROM x UNION ALL SELECT *, 'overall' FROM x), {counts_sql("split", "y")}, {_PANELS}
SELECT split, n_records, n_submitted, n_completed, n_pending, round(n_completed / nullif(n_records, 0)::DOUBLE, 6) AS share_completed, CASE WHEN split = 'overall' THEN (SELECT sum(n_panels_complete)::BIGINT FROM pn) END AS n_panels_complete FROM rc""")
def report_overall(spark, d):
    """Production, calibration and overall; panels on the overall row only."""
    x = responses(spark, d)
    y = x.withColumn("split", F.explode(F.array(F.when(F.col("cal"), "calibration").otherwise("production"), F.lit("overall"))))
    pn = panels(spark, d).agg(F.count_if("complete").alias("n_panels_complete")).withColumn("split", F.lit("overall"))
    return T.record_counts(y, ("split",)).join(pn, "split", "left").select("split", "n_records", "n_submitted", "n_completed", "n_pending", T.share("n_completed", "n_records").alias("share_completed"), "n_panels_complete")


@query(f"""WITH {P.R_SQL}, {X}, {counts_sql("domain")}, {_PANELS}, j AS (SELECT domain, n_records, n_submitted, n_completed, n_annotators, n_panels, n_panels_complete FROM rc LEFT JOIN pn USING (domain)),
p AS (SELECT *, row_number() OVER (ORDER BY n_submitted DESC, domain)::INT AS position FROM j)
SELECT position, domain, n_records, n_submitted, n_completed, round(n_completed / nullif(n_records, 0)::DOUBLE, 6) AS share_completed, n_panels_complete, round(n_panels_complete / nullif(n_panels, 0)::DOUBLE, 6) AS share_panels, n_annotators FROM p""")
def report_progress_by_domain(spark, d):
    """Most submitted first, then by name."""
    pn = panels(spark, d).groupBy("domain").agg(F.count(F.lit(1)).alias("n_panels"), F.count_if("complete").alias("n_panels_complete"))
    j = T.record_counts(responses(spark, d), ("domain",)).join(pn, "domain", "left")
    j = T.in_order(j, F.col("n_submitted").desc(), F.col("domain"))
    return j.select("position", "domain", "n_records", "n_submitted", "n_completed", T.share("n_completed", "n_records").alias("share_completed"), "n_panels_complete", T.share("n_panels_complete", "n_panels").alias("share_panels"), "n_annotators")


@query(f"WITH {X}, {counts_sql('domain, task')} SELECT domain, task, n_records, n_submitted, n_completed, round(n_completed / n_records::DOUBLE, 6) AS share_completed, n_annotators FROM rc WHERE n_submitted > 0")
def report_task_counts(spark, d):
    """Domains and tasks with submitted responses."""
    return T.record_counts(responses(spark, d), ("domain", "task")).where("n_submitted > 0").select("domain", "task", "n_records", "n_submitted", "n_completed", T.share("n_completed", "n_records").alias("share_completed"), "n_annotators")


@query(f"WITH {_BASE}, {_ar('cr', True)}, {_agree_sql('task, label')} SELECT task, round(avg(alpha), 4) AS mean_alpha, count(*) AS n_labels FROM ag GROUP BY 1")
def report_iaa_by_task(spark, d):
    """The unweighted mean of the labels' pooled alphas; labels without variance enter it with 1."""
    return _agreement(all_ratings(spark, d, True), ("task", "label")).groupBy("task").agg(F.round(F.avg("alpha"), 4).alias("mean_alpha"), F.count(F.lit(1)).alias("n_labels"))


@query(f"""WITH {_BASE}, {_ar('cr', True)}, {_agree_sql('task, label')}, st AS (SELECT task, label, count(*)::DOUBLE AS n, sum(value)::DOUBLE AS t FROM cr GROUP BY ALL)
SELECT task, label, alpha, pct_agreement, n_items, n::BIGINT AS n_ratings, least(t, n - t)::BIGINT AS n_minority, round(t / n, 6) AS prevalence, round(CASE WHEN n >= 2 THEN 2 * t * (n - t) / (n * (n - 1)) END, 6) AS expected_disagreement, least(t, n - t) = 0 AS flagged FROM st LEFT JOIN ag USING (task, label)""")
def report_iaa_by_label(spark, d):
    """Pooled alpha with the marginals it comes from; flagged where the label never varies."""
    r, k = all_ratings(spark, d, True), ("task", "label")
    return A.marginals(r, k).drop("n_true").join(_agreement(r, k).drop("degenerate"), [*k], "left").withColumn("flagged", F.col("n_minority") == 0)


@query(f"""WITH {_BASE}, {_ar('cr', True)}, {_ar('al', False)}, {_agree_sql('domain, task, label')}, pv AS (SELECT domain, task, label, round(avg(value), 6) AS prevalence FROM al GROUP BY ALL), w AS (SELECT domain, task, label, count(DISTINCT annotator_id) AS n_annotators FROM cr GROUP BY ALL)
SELECT domain, task, label, alpha, CASE WHEN alpha < 0 THEN 'red' WHEN alpha < 0.667 THEN 'yellow' ELSE 'ok' END AS tier, pct_agreement, prevalence, n_items, n_annotators FROM ag JOIN pv USING (domain, task, label) JOIN w USING (domain, task, label)""")
def report_alpha_by_domain(spark, d):
    """A diagnosis, not a headline; prevalence over all submitted rows."""
    from annolytics.functions.scalars import alpha_tier

    k, cr = ("domain", "task", "label"), all_ratings(spark, d, True)
    pv = all_ratings(spark, d, False).groupBy(*k).agg(F.round(F.avg("value"), 6).alias("prevalence"))
    w = cr.groupBy(*k).agg(F.count_distinct("annotator_id").alias("n_annotators"))
    return _agreement(cr, k).drop("degenerate").join(pv, [*k]).join(w, [*k]).withColumn("tier", alpha_tier(F.col("alpha")))


@query(f"WITH {_BASE}, {_ar('al', False)} SELECT task, label, domain, CASE WHEN grouping(domain) = 1 THEN 'total' ELSE 'domain' END AS level, count(*) AS n, sum(value)::BIGINT AS n_true, round(sum(value) / count(*)::DOUBLE, 6) AS prevalence FROM al GROUP BY GROUPING SETS ((task, label, domain), (task, label))")
def report_label_distribution(spark, d):
    """Class balance by task and label, in total and by domain, pooled before it is divided."""
    r = all_ratings(spark, d, False)
    g = r.groupingSets([["task", "label", "domain"], ["task", "label"]], "task", "label", "domain").agg(F.when(F.grouping("domain") == 1, "total").otherwise("domain").alias("level"), F.count("value").alias("n"), F.sum("value").cast("bigint").alias("n_true"))
    return g.withColumn("prevalence", T.share("n_true", "n"))


@query(f"""WITH {X}, c AS (SELECT domain, count(*) FILTER (status = 'submitted') AS n_submitted, count(*) FILTER (status = 'discarded') AS n_discarded FROM x GROUP BY 1), rs0 AS (SELECT domain, reason, count(*) AS n FROM x WHERE status = 'discarded' GROUP BY 1, 2),
b AS (SELECT domain, string_agg(reason || ' ' || n, ', ' ORDER BY n DESC, reason) AS reasons FROM rs0 GROUP BY 1)
SELECT domain, n_submitted, n_discarded, round(n_discarded / nullif(n_submitted + n_discarded, 0)::DOUBLE, 6) AS discard_rate, format('{{:.1f}}', round(100 * n_discarded / nullif(n_submitted + n_discarded, 0)::DOUBLE, 1)) || ' %' AS shown, reasons FROM c LEFT JOIN b USING (domain)""")
def report_discards(spark, d):
    """Discards by domain with their reasons, most frequent first."""
    x = responses(spark, d)
    c = x.groupBy("domain").agg(F.count_if(F.col("status") == "submitted").alias("n_submitted"), F.count_if(F.col("status") == "discarded").alias("n_discarded"))
    b = T.breakdown(x.where("status = 'discarded'").groupBy("domain", "reason").agg(F.count(F.lit(1)).alias("n")), ("domain",), "reason", "n", "reasons")
    rate = F.try_divide(F.col("n_discarded"), F.col("n_submitted") + F.col("n_discarded"))
    return c.join(b, "domain", "left").select("domain", "n_submitted", "n_discarded", F.round(rate, 6).alias("discard_rate"), T.percent(rate).alias("shown"), "reasons")


@query(f"WITH {X} SELECT domain, {_REASON_COLS} FROM x WHERE status = 'discarded' GROUP BY 1")
def discard_pivot(spark, d):
    """Discarded responses by domain and reason, as columns."""
    return T.reason_counts(responses(spark, d), ("domain",))


@query(f"""WITH {P.R_SQL}, {P.SUB_R}, {P.G_SQL}, {P.SUB_G}, dom AS (SELECT {key("record_uuid")} AS record_uuid, min(source_domain) AS domain FROM qa_records GROUP BY 1), v AS (
{" UNION ALL ".join(f"SELECT domain, '{c}' AS constraint_id, ({P.M.CONSTRAINTS[c].replace(' = 1', '').replace('topically_relevant = 0', 'NOT topically_relevant').replace('unsupported_claim_present = 0', 'NOT unsupported_claim_present').replace('source_cited = 0', 'NOT source_cited')}) AS bad FROM {t}s JOIN dom USING (record_uuid)" for t, cs in P._CON.items() for c in cs)})
SELECT domain, constraint_id, CASE WHEN grouping(domain) = 0 AND grouping(constraint_id) = 0 THEN 'domain,constraint_id' WHEN grouping(domain) = 0 THEN 'domain' WHEN grouping(constraint_id) = 0 THEN 'constraint_id' ELSE 'total' END AS level, count(*) FILTER (bad) AS n_violations, count(*) AS n_checked, round(count(*) FILTER (bad) / count(*)::DOUBLE, 6) AS share FROM v GROUP BY GROUPING SETS ((domain, constraint_id), (domain), (constraint_id), ())""")
def report_constraints(spark, d):
    """Violations by domain and constraint, with their sums at every level."""
    dom, parts = domains(spark, d), []
    for sub, cs, labels in ((P.ret_sub(spark, d), P._CON["r"], P.RET), (P.gnd_sub(spark, d), P._CON["g"], P.GND)):
        i = sub.select("record_uuid", *[F.col(c).cast("int").alias(c) for c in labels]).join(dom, "record_uuid")
        parts.append(i.select("domain", F.explode(F.array(*[F.struct(F.lit(c).alias("constraint_id"), F.expr(P.M.CONSTRAINTS[c]).alias("bad")) for c in cs])).alias("x")).select("domain", "x.*"))
    v = parts[0].unionByName(parts[1])
    return T.pooled_levels(v, "domain", "constraint_id", [F.count_if("bad").alias("n_violations"), F.count(F.lit(1)).alias("n_checked")], {"share": ("n_violations", "n_checked")})


@query(f"""WITH {P.R_SQL}, dom AS (SELECT {key("record_uuid")} AS record_uuid, min(source_domain) AS domain FROM qa_records GROUP BY 1), p AS (SELECT domain, record_uuid, count(DISTINCT chunk_id) FILTER (status = 'submitted') >= max(n_retrieved_chunks) AS done FROM r JOIN dom USING (record_uuid) WHERE chunk_id IS NOT NULL GROUP BY 1, 2),
q AS (SELECT sc.domain, p.done, p.record_uuid FROM (SELECT DISTINCT domain FROM dom) sc LEFT JOIN p USING (domain))
SELECT domain, CASE WHEN grouping(domain) = 1 THEN 'total' ELSE 'domain' END AS level, count(record_uuid) AS n_panels, count(*) FILTER (done) AS n_complete, round(count(*) FILTER (done) / nullif(count(record_uuid), 0)::DOUBLE, 6) AS fraction_complete FROM q GROUP BY GROUPING SETS ((domain), ())""")
def panel_completeness(spark, d):
    """Complete panels by domain and in total; the fraction is null where there are no panels."""
    q = domains(spark, d).select("domain").distinct().join(panels(spark, d), "domain", "left")
    g = q.groupingSets([["domain"], []], "domain").agg(F.when(F.grouping("domain") == 1, "total").otherwise("domain").alias("level"), F.count("record_uuid").alias("n_panels"), F.count_if("complete").alias("n_complete"))
    return g.withColumn("fraction_complete", T.share("n_complete", "n_panels"))


@query(f"""WITH dom AS (SELECT {key("record_uuid")} AS record_uuid, min(source_domain) AS domain FROM qa_records GROUP BY 1), {_EV}, ed AS (SELECT ev.*, domain FROM ev JOIN dom ON dom.record_uuid = ev.record_id),
ga AS (SELECT domain, task, us - lag(us) OVER (PARTITION BY domain, task, user_id ORDER BY us, record_id) AS g FROM ed), n AS (SELECT domain, task, count(*) AS n_events FROM ed GROUP BY 1, 2), m AS (SELECT domain, task, count(*) AS n_gaps, quantile_cont(g / 1e6, 0.5) AS med FROM ga WHERE g <= 1800000000 GROUP BY 1, 2),
j AS (SELECT domain, task, n_events, coalesce(n_gaps, 0) AS n_gaps, round(CASE WHEN n_gaps >= 5 THEN med END, 1) AS median_s FROM n LEFT JOIN m USING (domain, task))
SELECT *, row_number() OVER (ORDER BY median_s ASC NULLS LAST, domain, task)::INT AS position FROM j""")
def pace_by_domain(spark, d):
    """The pooled median gap by domain and task, shortest first, those without one last."""
    e = events(spark, d).join(domains(spark, d).withColumnRenamed("record_uuid", "record_id"), "record_id")
    g = cadence.pooled(e, ("domain", "task"), "user_id", "us", "record_id", 1800).select("domain", "task", F.col("n_gaps_used").alias("n_gaps"), "median_s")
    j = e.groupBy("domain", "task").agg(F.count(F.lit(1)).alias("n_events")).join(g, ["domain", "task"], "left").na.fill(0, ["n_gaps"])
    return T.in_order(j, F.col("median_s").asc_nulls_last(), F.col("domain"), F.col("task"))


@query(f"WITH {X}, g AS (SELECT domain, CAST(make_timestamp(us) AS DATE) AS day, count(*) AS n FROM x WHERE status = 'submitted' AND us IS NOT NULL GROUP BY 1, 2) SELECT domain, day, n, sum(n) OVER (PARTITION BY domain ORDER BY day)::BIGINT AS done FROM g")
def progress_series(spark, d):
    """Submitted responses by domain and day and their running sum, which goes over one row per day."""
    from pyspark.sql import Window

    x = responses(spark, d).where("status = 'submitted' AND us IS NOT NULL").groupBy("domain", F.to_date(F.timestamp_micros("us")).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return x.withColumn("done", F.sum("n").over(Window.partitionBy("domain").orderBy("day")))


@query(f"""WITH {X}, {counts_sql("domain")}, al AS (SELECT DISTINCT domain FROM dom UNION SELECT 'no-such-domain') SELECT domain, CASE WHEN n_submitted > 0 THEN 'ok' WHEN n_records IS NOT NULL THEN 'no submitted responses' ELSE 'no data' END AS state, coalesce(n_records, 0) AS n_records, coalesce(n_submitted, 0) AS n_submitted FROM al LEFT JOIN rc USING (domain)""")
def report_summary(spark, d):
    """Every domain asked for by name; those that failed stand in the table with their reason, not in its sums."""
    al = domains(spark, d).select("domain").union(spark.createDataFrame([("no-such-domain",)], "domain string")).distinct()
    j = al.join(T.record_counts(responses(spark, d), ("domain",)), "domain", "left")
    return j.select("domain", F.when(F.col("n_submitted") > 0, "ok").when(F.col("n_records").isNotNull(), "no submitted responses").otherwise("no data").alias("state"), F.coalesce("n_records", F.lit(0)).alias("n_records"), F.coalesce("n_submitted", F.lit(0)).alias("n_submitted"))


@query(f"WITH {X}, y AS (SELECT *, CASE WHEN cal THEN 'calibration' ELSE 'production' END AS purpose FROM x), {counts_sql('task, purpose', 'y')} SELECT task, purpose, n_records AS total, n_completed AS completed, n_pending AS pending FROM rc")
def record_progress(spark, d):
    """Records in all, completed and pending, by task and purpose."""
    y = responses(spark, d).withColumn("purpose", F.when(F.col("cal"), "calibration").otherwise("production"))
    return T.record_counts(y, ("task", "purpose")).select("task", "purpose", F.col("n_records").alias("total"), F.col("n_completed").alias("completed"), F.col("n_pending").alias("pending"))


@query(f"WITH {_BASE}, {_ar('al', False)}, m AS (SELECT task, label, count(*) AS n, sum(value)::BIGINT AS k FROM al GROUP BY ALL), w AS (SELECT *, k / n::DOUBLE AS p, 1.96::DOUBLE AS z FROM m) SELECT task, label, n, k, round(p, 6) AS rate, round(greatest(0.0::DOUBLE, ((p + z*z/(2*n)) - z*sqrt(p*(1-p)/n + z*z/(4.0::DOUBLE*n*n))) / (1 + z*z/n)), 6) AS ci_lower, round(least(1.0::DOUBLE, ((p + z*z/(2*n)) + z*sqrt(p*(1-p)/n + z*z/(4.0::DOUBLE*n*n))) / (1 + z*z/n)), 6) AS ci_upper, CASE WHEN least(k, n - k) = 0 THEN 'constant' WHEN least(k, n - k) / n::DOUBLE < 0.05 THEN 'rare' ELSE 'ok' END AS colour FROM w")
def prevalence_shown(spark, d):
    """L3: prevalence with its interval and the class that its colour stands for."""
    from annolytics.functions.intervals import wilson

    st = T.label_stats(all_ratings(spark, d, False), ("task", "label"))
    lo, hi = wilson("n_true", "n")
    return st.select("task", "label", "n", F.col("n_true").alias("k"), F.col("prevalence").alias("rate"), F.round(lo, 6).alias("ci_lower"), F.round(hi, 6).alias("ci_upper"), F.when(F.col("degenerate"), "constant").when(F.col("near_degenerate"), "rare").otherwise("ok").alias("colour"))


@query(f"WITH {_EV}, {_gap_sql('user_id')}, s AS (SELECT user_id, sum(gap_us) FILTER (gap_us > 1800000000) AS pauses, max(gap_us) FILTER (gap_us > 1800000000) AS longest, sum(gap_us) FILTER (gap_us <= 1800000000) AS active, arg_max(after_record, (gap_us, us)) FILTER (gap_us > 1800000000) AS after_record FROM gp GROUP BY 1), n AS (SELECT user_id, max(us) - min(us) AS span FROM ev GROUP BY 1) SELECT user_id, span AS span_us, coalesce(active, 0)::BIGINT AS active_us, coalesce(pauses, 0)::BIGINT AS pauses_us, longest AS longest_pause_us, after_record AS longest_pause_after FROM n LEFT JOIN s USING (user_id)")
def cadence_spans(spark, d):
    """C4: the span of each annotator's events, active time, pauses in all, the longest and the record before it."""
    e = events(spark, d)
    g, lim = cadence.gaps(e, ("user_id",), "us", "record_id"), 1_800_000_000
    long = F.col("gap_us") > lim
    s = g.groupBy("user_id").agg(F.sum(F.when(long, F.col("gap_us"))).alias("p"), F.max(F.when(long, F.col("gap_us"))).alias("longest_pause_us"), F.sum(F.when(~long, F.col("gap_us"))).alias("a"), F.max(F.when(long, F.struct("gap_us", "us", "after_record")))["after_record"].alias("longest_pause_after"))
    n = e.groupBy("user_id").agg((F.max("us") - F.min("us")).alias("span_us"))
    return n.join(s, "user_id", "left").select("user_id", "span_us", F.coalesce("a", F.lit(0)).alias("active_us"), F.coalesce("p", F.lit(0)).alias("pauses_us"), "longest_pause_us", "longest_pause_after")


@query(f"WITH {_EV}, {_gap_sql('task, user_id')}, u AS (SELECT task, user_id, gap_us / 1e6 AS g FROM gp WHERE gap_us <= 1800000000), s AS (SELECT task, user_id, quantile_cont(g, 0.5) AS m, count(*) AS n FROM u GROUP BY 1, 2), w AS (SELECT task, sum(m * n) / sum(n) AS wm FROM s GROUP BY 1), p AS (SELECT task, quantile_cont(g, 0.5) AS pm, count(*) AS n_gaps FROM u GROUP BY 1) SELECT task, n_gaps, round(pm, 1) AS pooled_median_s, round(wm, 6) AS weighted_median_s FROM p JOIN w USING (task)")
def task_pace_both(spark, d):
    """The median of all gaps beside the mean of the annotators' medians, weighted by their gaps."""
    from annolytics.operators.rollup import weighted_mean

    e = events(spark, d)
    used = cadence.gaps(e, ("task", "user_id"), "us", "record_id").where("gap_us <= 1800000000")
    own = cadence.quantiles(used, ("task", "user_id"), "gap_us", (0.5,)).select("task", (F.col("q")[0] / 1e6).alias("m"), "n").groupBy("task").agg(F.round(weighted_mean("m", "n"), 6).alias("weighted_median_s"))
    return cadence.quantiles(used, ("task",), "gap_us", (0.5,)).select("task", F.col("n").alias("n_gaps"), F.round(F.col("q")[0] / 1e6, 1).alias("pooled_median_s")).join(own, "task")


QUERIES, ORACLE = Q, S
