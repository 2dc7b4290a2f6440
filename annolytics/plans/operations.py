"""Queries over events, records and catalogues: cadence, rollups, manifests, lineage, evaluators."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolytics.functions import scalars as X
from annolytics.operators import cadence, clean as C, consolidate as K, evaluator as E, lineage as L, rollup as R
from annolytics.plans import annotation as P
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


def events(spark, d):
    e = table(spark, d, "response_log").select(clean_key("user_id").alias("user_id"), micros("inserted_at").alias("us"), clean_key("record_id").alias("record_id"), clean_key("task").alias("task"), F.coalesce(clean_key("purpose"), F.lit("unknown")).alias("purpose"))
    return e.where("user_id IS NOT NULL AND us IS NOT NULL").dropDuplicates(["user_id", "us", "record_id", "task"])


_EV = f"""e0 AS (SELECT {key("user_id")} AS user_id, epoch_us(inserted_at) AS us, {key("record_id")} AS record_id, {key("task")} AS task, coalesce({key("purpose")}, 'unknown') AS purpose FROM response_log),
ev AS (SELECT user_id, us, record_id, task FROM e0 WHERE user_id IS NOT NULL AND us IS NOT NULL GROUP BY ALL)"""


def _gap_sql(keys: str) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    return f"ga AS (SELECT {keys + ',' if keys else ''} lag(record_id) OVER w AS after_record, record_id AS before_record, us, us - lag(us) OVER w AS gap_us FROM ev WINDOW w AS ({part}ORDER BY us, record_id)), gp AS (SELECT * FROM ga WHERE gap_us IS NOT NULL)"


def _summary_sql(keys: str) -> str:
    k, g = (keys + ", ", "GROUP BY " + keys) if keys else ("", "")
    u = "gap_us / 1e6 ELSE NULL END"
    using = f"LEFT JOIN s USING ({keys})" if keys else "LEFT JOIN s ON true"
    stat = lambda c: f"round(CASE WHEN n_events >= 5 AND coalesce(n_gaps_used, 0) > 0 THEN {c} END, 1)"
    return f"""WITH {_EV}, {_gap_sql(keys)}, n AS (SELECT {k}count(*) AS n_events FROM ev {g}), u AS (SELECT *, CASE WHEN gap_us <= 1800000000 THEN {u} AS used FROM gp),
s AS (SELECT {k}count(*) AS n_gaps_total, count(used) AS n_gaps_used, max(CASE WHEN used IS NULL THEN gap_us / 1e6 END) AS lp, quantile_cont(used, 0.25) AS q1, quantile_cont(used, 0.5) AS q2, quantile_cont(used, 0.75) AS q3, avg(used) AS mean FROM u {g})
SELECT {k}n_events, coalesce(n_gaps_total, 0) AS n_gaps_total, coalesce(n_gaps_used, 0) AS n_gaps_used, coalesce(n_gaps_total, 0) - coalesce(n_gaps_used, 0) + 1 AS n_sessions, round(lp, 1) AS longest_pause_s, {stat("q2")} AS median_s, {stat("mean")} AS mean_s, {stat("q1")} AS p25_s, {stat("q3")} AS p75_s FROM n {using}"""


@query(f"WITH {_EV}, {_gap_sql('user_id')} SELECT user_id, us, gap_us, gap_us > 1800000000 AS is_break FROM gp")
def cadence_gaps(spark, d):
    g = cadence.gaps(events(spark, d), ("user_id",), "us", "record_id")
    return g.select("user_id", "us", "gap_us", (F.col("gap_us") > 1_800_000_000).alias("is_break"))


@query(_summary_sql("user_id"))
def cadence_per_annotator(spark, d):
    return cadence.summary(events(spark, d), ("user_id",), "us", "record_id", 1800)


@query(f"WITH {_EV}, {_gap_sql('task, user_id')}, u AS (SELECT task, CASE WHEN gap_us <= 1800000000 THEN gap_us / 1e6 END AS used FROM gp) SELECT task, count(used) AS n_gaps_used, round(CASE WHEN count(used) >= 5 THEN quantile_cont(used, 0.5) END, 1) AS median_s, round(CASE WHEN count(used) >= 5 THEN avg(used) END, 1) AS mean_s FROM u GROUP BY 1")
def cadence_pooled(spark, d):
    return cadence.pooled(events(spark, d), ("task",), "user_id", "us", "record_id", 1800)


@query(_summary_sql(""))
def cadence_global(spark, d):
    e = events(spark, d).withColumn("all", F.lit(1))
    return cadence.summary(e, ("all",), "us", "record_id", 1800).drop("all")


@query(f"WITH {_EV}, {_gap_sql('user_id')}, x AS (SELECT user_id, sum(gap_us) FILTER (gap_us <= 1800000000) / 3.6e9 AS hours FROM gp GROUP BY 1), n AS (SELECT user_id, count(*) AS n_events FROM ev GROUP BY 1) SELECT user_id, n_events, round(coalesce(hours, 0), 6) AS active_hours, round(n_events / nullif(hours, 0), 6) AS per_hour FROM n LEFT JOIN x USING (user_id)")
def pace(spark, d):
    e = events(spark, d)
    h = cadence.gaps(e, ("user_id",), "us", "record_id").groupBy("user_id").agg((F.sum(F.when(F.col("gap_us") <= 1_800_000_000, F.col("gap_us"))) / 3.6e9).alias("hours"))
    j = e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events")).join(h, "user_id", "left")
    return j.select("user_id", "n_events", F.round(F.coalesce("hours", F.lit(0.0)), 6).alias("active_hours"), F.round(F.expr("try_divide(n_events, hours)"), 6).alias("per_hour"))


@query(f"WITH {_EV}, {_gap_sql('task, user_id')}, s AS (SELECT task, user_id, quantile_cont(gap_us / 1e6, 0.5) AS m, count(*) AS n FROM gp WHERE gap_us <= 1800000000 GROUP BY 1, 2) SELECT task, round(coalesce(sum(m * n) / sum(n), 0), 6) AS weighted_median_s, sum(n)::BIGINT AS n_gaps FROM s GROUP BY 1")
def task_pace_weighted(spark, d):
    g = cadence.gaps(events(spark, d), ("task", "user_id"), "us", "record_id").where("gap_us <= 1800000000")
    s = g.groupBy("task", "user_id").agg(F.percentile(F.col("gap_us") / 1e6, F.lit(0.5)).alias("m"), F.count(F.lit(1)).alias("n"))
    return s.groupBy("task").agg(F.round(R.weighted_mean("m", "n"), 6).alias("weighted_median_s"), F.sum("n").alias("n_gaps"))


@query(f"WITH {_EV} SELECT task, count(*) FILTER (purpose = 'production') AS production, count(*) FILTER (purpose = 'calibration') AS calibration, count(*) FILTER (purpose = 'unknown') AS unknown, count(*) AS total FROM e0 WHERE user_id IS NOT NULL GROUP BY 1")
def counts_split_pivot(spark, d):
    e = table(spark, d, "response_log").select(clean_key("user_id").alias("user_id"), clean_key("task").alias("task"), F.coalesce(clean_key("purpose"), F.lit("unknown")).alias("purpose")).where("user_id IS NOT NULL")
    p = e.groupBy("task").pivot("purpose", ["production", "calibration", "unknown"]).count().na.fill(0)
    return p.withColumn("total", F.col("production") + F.col("calibration") + F.col("unknown"))


_RB = f"{P.R_SQL}, dom AS (SELECT {key('record_uuid')} AS record_uuid, min(source_domain) AS domain FROM qa_records GROUP BY 1), b AS (SELECT domain, CASE WHEN calibration THEN 'calibration' ELSE 'production' END AS purpose, status, annotator_id, record_uuid, coalesce(discard_reason, 'unspecified') AS reason, notes FROM r JOIN dom USING (record_uuid))"


def base(spark, d):
    dom = table(spark, d, "qa_records").select(clean_key("record_uuid").alias("record_uuid"), "source_domain").groupBy("record_uuid").agg(F.min("source_domain").alias("domain"))
    r = P.retrieval(spark, d).join(dom, "record_uuid")
    return r.select("domain", F.when(F.col("calibration"), "calibration").otherwise("production").alias("purpose"), "status", "annotator_id", "record_uuid", F.coalesce("discard_reason", F.lit("unspecified")).alias("reason"), "notes")


@query(f"WITH {_RB} SELECT domain, purpose, CASE WHEN grouping(domain) = 0 AND grouping(purpose) = 0 THEN 'domain,purpose' WHEN grouping(domain) = 0 THEN 'domain' WHEN grouping(purpose) = 0 THEN 'purpose' ELSE 'total' END AS level, count(*) FILTER (status = 'submitted') AS n_submitted, count(*) FILTER (status = 'discarded') AS n_discarded, count(DISTINCT annotator_id) AS n_annotators FROM b GROUP BY GROUPING SETS ((domain, purpose), (domain), (purpose), ())")
def rollup_counts(spark, d):
    return R.rollup(base(spark, d), "domain", "purpose", [F.count_if(F.col("status") == "submitted").alias("n_submitted"), F.count_if(F.col("status") == "discarded").alias("n_discarded"), F.count_distinct("annotator_id").alias("n_annotators")])


@query(f"WITH {_RB}, x AS (SELECT domain, count(*) FILTER (status = 'discarded') AS nd, count(*) FILTER (status IN ('submitted', 'discarded')) AS n, avg((notes IS NOT NULL AND trim(notes) <> '')::INT) AS nr FROM b GROUP BY 1) SELECT domain, reason, count(*) AS n, any_value(nd) AS n_discarded, round(any_value(nd) / any_value(x.n)::DOUBLE, 6) AS discard_rate, round(any_value(nr), 6) AS notes_rate FROM b JOIN x USING (domain) WHERE status = 'discarded' GROUP BY 1, 2")
def discard_breakdown(spark, d):
    b = base(spark, d)
    x = b.groupBy("domain").agg(F.count_if(F.col("status") == "discarded").alias("n_discarded"), F.count_if(F.col("status").isin("submitted", "discarded")).alias("all"), F.avg((F.col("notes").isNotNull() & (F.trim("notes") != "")).cast("int")).alias("nr"))
    g = b.where("status = 'discarded'").groupBy("domain", "reason").agg(F.count(F.lit(1)).alias("n"))
    return g.join(x, "domain").select("domain", "reason", "n", "n_discarded", F.round(F.col("n_discarded") / F.col("all"), 6).alias("discard_rate"), F.round("nr", 6).alias("notes_rate"))


@query(P.rate_sql(False) + ", o AS (SELECT source_domain, label, annotator_id, count(*) AS n, avg(value) AS p FROM ra GROUP BY ALL), pl AS (SELECT source_domain, label, avg(value) AS pool FROM ra GROUP BY ALL HAVING count(DISTINCT annotator_id) >= 2) SELECT source_domain, label, annotator_id, n, round(p, 6) AS prevalence, round(p - pool, 6) AS delta, (abs(p - pool) >= 0.2 AND n >= 5) AS substantial FROM o JOIN pl USING (source_domain, label)")
def annotator_bias(spark, d):
    return R.annotator_bias(P._ratings(spark, d, calibration=False), ("source_domain", "label"), "annotator_id")


@query(f"WITH {P.R_SQL}, c AS (SELECT record_uuid, chunk_id, bool_or(coalesce(calibration, false)) AS cal, count(DISTINCT annotator_id) FILTER (status = 'submitted') AS n_sub, max(n_retrieved_chunks) AS k FROM r WHERE chunk_id IS NOT NULL GROUP BY 1, 2), p AS (SELECT record_uuid, count(*) FILTER (n_sub > 0) >= max(k) AS panel_complete FROM c GROUP BY 1) SELECT record_uuid, chunk_id, n_sub AS n_submitted, n_sub >= CASE WHEN cal THEN 3 ELSE 1 END AS overlap_satisfied, panel_complete, (n_sub = 0 AND NOT panel_complete) AS needs_completion FROM c JOIN p USING (record_uuid)")
def completion_status(spark, d):
    r = P.retrieval(spark, d).where("chunk_id IS NOT NULL")
    c = r.groupBy("record_uuid", "chunk_id").agg(F.bool_or(F.coalesce("calibration", F.lit(False))).alias("cal"), F.count_distinct(F.when(F.col("status") == "submitted", F.col("annotator_id"))).alias("n_submitted"), F.max("n_retrieved_chunks").alias("k"))
    p = c.groupBy("record_uuid").agg((F.count_if(F.col("n_submitted") > 0) >= F.max("k")).alias("panel_complete"))
    return c.join(p, "record_uuid").select("record_uuid", "chunk_id", "n_submitted", (F.col("n_submitted") >= F.when(F.col("cal"), 3).otherwise(1)).alias("overlap_satisfied"), "panel_complete", ((F.col("n_submitted") == 0) & ~F.col("panel_complete")).alias("needs_completion"))


@query(f"WITH {P.R_SQL}, p AS (SELECT record_uuid, bool_or(coalesce(calibration, false)) AS cal, max(n_retrieved_chunks) - count(DISTINCT chunk_id) FILTER (n_sub >= 2) AS remaining FROM (SELECT *, count(*) FILTER (status = 'submitted') OVER (PARTITION BY record_uuid, chunk_id) AS n_sub FROM r) GROUP BY 1) SELECT record_uuid, remaining::INT AS remaining FROM p WHERE NOT cal AND remaining BETWEEN 1 AND 5 ORDER BY remaining, record_uuid LIMIT 40")
def curation_topk(spark, d):
    """The 40 production panels that are cheapest to finish, a chunk being finished with two submitted responses."""
    c = P.retrieval(spark, d).groupBy("record_uuid", "chunk_id").agg(F.bool_or(F.coalesce("calibration", F.lit(False))).alias("cal"), F.max("n_retrieved_chunks").alias("k"), F.count_if(F.col("status") == "submitted").alias("n"))
    p = c.groupBy("record_uuid").agg(F.bool_or("cal").alias("cal"), (F.max("k") - F.count_if((F.col("n") >= 2) & F.col("chunk_id").isNotNull())).cast("int").alias("remaining"))
    return p.where("NOT cal AND remaining BETWEEN 1 AND 5").orderBy("remaining", "record_uuid").limit(40).select("record_uuid", "remaining")


_QA = f"q0 AS (SELECT *, {key('record_uuid')} AS ru FROM qa_records), qa AS (SELECT * FROM q0 QUALIFY row_number() OVER (PARTITION BY ru ORDER BY loaded_at DESC, created_at DESC) = 1)"


def qa(spark, d, *cols):
    q = table(spark, d, "qa_records").select(clean_key("record_uuid").alias("record_uuid"), "loaded_at", "created_at", *cols)
    return K.upsert_latest(q, "record_uuid", ("loaded_at", "created_at"))


@query(f"WITH {_QA} SELECT ru AS record_uuid, query_id, split, loaded_at FROM qa")
def upsert_latest(spark, d):
    return qa(spark, d, "query_id", "split").select("record_uuid", "query_id", "split", "loaded_at")


@query(f"WITH {_QA}, {P.R_SQL}, c AS (SELECT record_uuid, chunk_id, min(chunk_rank)::INT AS chunk_rank, count(*) FILTER (status = 'submitted') AS n_responses FROM r WHERE chunk_id IS NOT NULL GROUP BY 1, 2), t AS (SELECT record_uuid, count(*) AS n_chunks FROM c GROUP BY 1) SELECT ru AS record_uuid, chunk_id, chunk_rank, coalesce(n_chunks, 0) AS n_chunks, coalesce(n_responses, 0) AS n_responses, coalesce(n_responses, 0) > 0 AS started FROM qa LEFT JOIN c ON c.record_uuid = ru LEFT JOIN t ON t.record_uuid = ru")
def retrieval_manifest(spark, d):
    """One row per retrieved chunk of every query; a query without chunks keeps one row."""
    r = P.retrieval(spark, d).where("chunk_id IS NOT NULL")
    c = r.groupBy("record_uuid", "chunk_id").agg(F.min("chunk_rank").cast("int").alias("chunk_rank"), F.count_if(F.col("status") == "submitted").alias("n_responses"))
    t = c.groupBy("record_uuid").agg(F.count(F.lit(1)).alias("n_chunks"))
    j = qa(spark, d).select("record_uuid").join(c, "record_uuid", "left").join(t, "record_uuid", "left").na.fill(0, ["n_chunks", "n_responses"])
    return j.select("record_uuid", "chunk_id", "chunk_rank", "n_chunks", "n_responses", (F.col("n_responses") > 0).alias("started"))


@query(f"WITH {_QA} SELECT ru AS record_uuid, 'grounding' AS task, answer AS text, context_set AS text_pair FROM qa WHERE trim(answer, {P.WS}) <> '' AND trim(context_set, {P.WS}) <> '' UNION ALL SELECT ru, 'generation', query, answer FROM qa WHERE trim(query, {P.WS}) <> '' AND trim(answer, {P.WS}) <> ''")
def task_projection(spark, d):
    """The text pair of each record and task; pairs with a blank side are refused."""
    q = qa(spark, d, "query", "answer", "context_set")
    two = F.array(F.struct(F.lit("grounding").alias("task"), F.col("answer").alias("text"), F.col("context_set").alias("text_pair")), F.struct(F.lit("generation").alias("task"), F.col("query").alias("text"), F.col("answer").alias("text_pair")))
    p = q.select("record_uuid", F.explode(two).alias("x")).select("record_uuid", "x.*")
    solid = lambda c: F.trim(F.col(c), F.lit(" \t\n\r")) != ""
    return p.where(solid("text") & solid("text_pair"))


@query("WITH x AS (SELECT o_custkey, string_agg('[' || o_orderkey || '] ' || o_orderpriority || chr(10) || o_orderstatus, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY o_orderkey) AS context_set FROM orders GROUP BY 1) SELECT * FROM x")
def context_set_render(spark, d):
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderkey").alias("rank"), F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("text"))).alias("chunks"))
    return o.select("o_custkey", X.render_context(F.col("chunks")).alias("context_set"))


_CAT = "SELECT source_domain, origin_id, count(*) AS n_documents, max(lang) AS lang, max(source) AS source, max(n_chars) AS longest, min(created_at) AS first_at FROM documents WHERE origin_id IS NOT NULL GROUP BY 1, 2"


@query(_CAT)
def catalog_rollup(spark, d):
    return table(spark, d, "documents").where("origin_id IS NOT NULL").groupBy("source_domain", "origin_id").agg(F.count(F.lit(1)).alias("n_documents"), F.max("lang").alias("lang"), F.max("source").alias("source"), F.max("n_chars").alias("longest"), F.min("created_at").alias("first_at"))


@query("SELECT sha256(string_agg(x, chr(10) ORDER BY x)) AS checksum FROM (SELECT origin_id || ':' || count(*) AS x FROM documents WHERE origin_id IS NOT NULL GROUP BY origin_id)")
def content_checksum(spark, d):
    g = table(spark, d, "documents").where("origin_id IS NOT NULL").groupBy("origin_id").agg(F.count(F.lit(1)).alias("n"))
    return L.checksum(g, "origin_id", "n")


@query("SELECT doc_id, nullif(regexp_extract(text, '(1[89][0-9][0-9]|20[0-9][0-9])', 1), '')::INT AS year, CASE WHEN regexp_matches(x, '[A-Za-z]') THEN list_max(list_transform(regexp_extract_all(x, '([0-9]+)', 1), lambda y: try_cast(y AS BIGINT))) END AS pages, trim(replace(nullif(regexp_extract(text, 'hst[:=] ?([^|\\n\\r]*)', 1), ''), '¬', '')) AS title FROM (SELECT *, nullif(regexp_extract(text, 'umf[:=] ?([^|\\n\\r]*)', 1), '') AS x FROM documents WHERE source = 'catalogue_entry')")
def parse_fields(spark, d):
    """X2-X4 over catalogue entries."""
    t = table(spark, d, "documents").where("source = 'catalogue_entry'")
    field = lambda k: F.nullif(F.regexp_extract("text", rf"{k}[:=] ?([^|\n\r]*)", 1), F.lit(""))
    year = F.nullif(F.regexp_extract("text", r"(1[89]\d\d|20\d\d)", 1), F.lit("")).cast("int")
    return t.withColumn("x", field("umf")).select("doc_id", year.alias("year"), X.parse_pages(F.col("x")).alias("pages"), X.clean_title(field("hst")).alias("title"))


@query("WITH x AS (SELECT source, count(*) FILTER (lang = 'de') AS a, count(*) FILTER (lang = 'en') AS b FROM documents GROUP BY 1) SELECT source, a AS n_de, b AS n_en, CASE WHEN a + b = 0 THEN 'unknown' WHEN a > b THEN 'de' WHEN b > a THEN 'en' ELSE 'mixed' END AS majority FROM x")
def majority_with_mixed(spark, d):
    g = table(spark, d, "documents").groupBy("source").agg(F.count_if(F.col("lang") == "de").alias("n_de"), F.count_if(F.col("lang") == "en").alias("n_en"))
    a, b = F.col("n_de"), F.col("n_en")
    return g.withColumn("majority", F.when(a + b == 0, "unknown").when(a > b, "de").when(b > a, "en").otherwise("mixed"))


@query("SELECT min(doc_id) AS doc_id, count(*) AS n_copies, md5(text) AS digest FROM documents WHERE text IS NOT NULL GROUP BY text")
def dedup_first(spark, d):
    t = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "text")
    return K.dedup_first(t, ("text",), ("doc_id",)).select("doc_id", "n_copies", F.md5("text").alias("digest"))


@query(r"SELECT source, count(*) AS n, count(*) FILTER (text IS NULL OR regexp_replace(text, '[\s\p{Z}]+', '', 'g') = '') AS n_blank FROM documents GROUP BY 1")
def blank_text_audit(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(C.is_blank("text")).alias("n_blank"))


@query(f"WITH x AS (SELECT 'retrieval' AS task, record_uuid AS u FROM retrieval_rows UNION ALL SELECT 'grounding', record_uuid FROM grounding_rows) SELECT task, count(*) AS n, count(*) FILTER (NOT regexp_full_match(u, '[0-9a-fA-F]{{8}}-?[0-9a-fA-F]{{4}}-?[0-9a-fA-F]{{4}}-?[0-9a-fA-F]{{4}}-?[0-9a-fA-F]{{12}}')) AS n_other FROM x GROUP BY 1")
def id_audit(spark, d):
    """How many ids of each file are no UUIDs."""
    one = lambda n: table(spark, d, f"{n}_rows").select(F.lit(n).alias("task"), "record_uuid")
    return one("retrieval").unionByName(one("grounding")).groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.count_if(~C.is_uuid("record_uuid")).alias("n_other"))


@query()
def intersperse(spark, d):
    t = table(spark, d, "documents").select("doc_id", "source")
    return K.intersperse(t.where("source <> 'query_spec'"), t.where("source = 'query_spec'"), "doc_id")


_KEEP = "k AS (SELECT DISTINCT o_orderkey + (o_orderkey % 7 = 0)::INT * 10000000 AS id FROM orders WHERE o_orderkey % 3 <> 0), l AS (SELECT DISTINCT o_orderkey AS id FROM orders)"


@query(f"WITH {_KEEP} SELECT coalesce(l.id, k.id) AS id, CASE WHEN l.id IS NOT NULL AND k.id IS NOT NULL THEN 'kept' WHEN l.id IS NOT NULL THEN 'deleted' ELSE 'missing' END AS state FROM l FULL JOIN k ON l.id = k.id")
def keep_list_prune(spark, d):
    o = table(spark, d, "orders")
    k = o.where("o_orderkey % 3 <> 0").select((F.col("o_orderkey") + (F.col("o_orderkey") % 7 == 0).cast("bigint") * 10_000_000).alias("id"))
    return L.prune(o.select(F.col("o_orderkey").alias("id")), k, "id")


@query("SELECT o_custkey, year(o_orderdate)::INT AS bundle, o_orderkey FROM orders QUALIFY year(o_orderdate) = max(year(o_orderdate)) OVER (PARTITION BY o_custkey)")
def latest_wins(spark, d):
    o = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("bundle"), "o_orderkey")
    return L.latest_wins(o, "o_custkey", "bundle").select("o_custkey", "bundle", "o_orderkey")


_DIFF = "l AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 11 <> 0), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 13 <> 0)"


@query(f"WITH {_DIFF} SELECT coalesce(l.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN l.o_orderkey IS NULL THEN 'new' WHEN b.o_orderkey IS NULL THEN 'extra' WHEN l.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus AND l.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority THEN 'identical' ELSE 'updated' END AS status, CASE WHEN l.o_orderkey IS NULL OR b.o_orderkey IS NULL THEN '' ELSE concat_ws(',', CASE WHEN l.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' END, CASE WHEN l.o_orderpriority IS DISTINCT FROM b.o_orderpriority THEN 'o_orderpriority' END) END AS changed FROM l FULL JOIN b ON l.o_orderkey = b.o_orderkey")
def record_diff(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    b = o.where("o_orderkey % 13 <> 0").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    return L.diff(o.where("o_orderkey % 11 <> 0"), b, "o_orderkey", ("o_orderstatus", "o_orderpriority"))


@query("WITH f AS (SELECT doc_id, sha256(text) AS d FROM documents WHERE text IS NOT NULL), p AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'x' ELSE sha256(coalesce(text, '')) END AS d FROM documents) SELECT doc_id, CASE WHEN f.d IS NULL THEN 'ABSENT' WHEN f.d = p.d THEN 'OK' ELSE 'MISMATCH' END AS state FROM p LEFT JOIN f USING (doc_id)")
def pin_verify(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text")
    files = t.where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("d"))
    pins = t.select("doc_id", F.when(F.col("doc_id") % 10 == 0, "x").otherwise(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("d"))
    return L.verify_pins(pins, files, "doc_id", "d")


@query(f"WITH {_QA} SELECT ru AS record_uuid, query_id FROM qa WHERE ru NOT IN (SELECT {key('record_uuid')} FROM retrieval_rows WHERE calibration)")
def resume_filter(spark, d):
    done = table(spark, d, "retrieval_rows").where("calibration").select(clean_key("record_uuid").alias("record_uuid"))
    return C.resume(qa(spark, d, "query_id").select("record_uuid", "query_id"), done, "record_uuid")


@query("WITH e AS (SELECT event_id, epoch_us(ts) AS us FROM events WHERE event_type = 'signup'), s AS (SELECT epoch_us(ts) AS r FROM events WHERE event_type = 'purchase') SELECT event_id, us, (SELECT min(r) FROM s WHERE r > us AND r - us <= 7200000000) AS snapshot_us FROM e")
def asof_next_snapshot(spark, d):
    e = table(spark, d, "events").select("event_id", micros("ts").alias("us"), "event_type")
    return L.next_snapshot(e.where("event_type = 'signup'").select("event_id", "us"), e.where("event_type = 'purchase'").select("us"), "us", "us", 7200)


@query("SELECT event_type, user_id % 20 AS grp, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2")
def latest_run(spark, d):
    return L.latest_run(table(spark, d, "events").select("event_type", (F.col("user_id") % 20).alias("grp"), "ts", "event_id"), ("event_type", "grp"), "ts", "event_id")


@query("WITH x AS (SELECT l_discount * 10 AS p, l_returnflag = 'R' AS y FROM lineitem), b AS (SELECT *, greatest(0, least(9, floor(p * 10)::INT)) AS b FROM x) SELECT '[' || format('{:.1f}', b / 10.0::DOUBLE) || ',' || format('{:.1f}', (b + 1) / 10.0::DOUBLE) || CASE WHEN b = 9 THEN ']' ELSE ')' END AS bin, count(*) AS n, round(avg(p), 6) AS mean_predicted, round(avg(y::INT), 6) AS fraction_true FROM b GROUP BY b")
def calibration_bins(spark, d):
    return E.calibration_bins(table(spark, d, "lineitem").select((F.col("l_discount") * 10).alias("p"), (F.col("l_returnflag") == "R").alias("y")), "p", "y")


@query("WITH x AS (SELECT event_type AS label, count(*) AS n, avg((value >= 50)::INT) AS prev, avg((value >= 50 AND user_id % 2 = 0)::INT) / nullif(avg((value >= 50)::INT), 0) AS rec, avg((user_id % 2 = 0)::INT) AS pred, avg(((value >= 50) = (user_id % 2 = 0))::INT) AS acc FROM events GROUP BY 1) SELECT label, n, round(CASE WHEN pred = 0 THEN NULL ELSE acc END, 6) AS accuracy, CASE WHEN pred = 0 THEN 'nothing predicted' END AS note FROM x")
def derived_accuracy(spark, d):
    y, z = F.col("value") >= 50, F.col("user_id") % 2 == 0
    g = table(spark, d, "events").groupBy(F.col("event_type").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.avg(y.cast("int")).alias("prev"), (F.count_if(y & z) / F.count_if(y)).alias("rec"), F.avg(z.cast("int")).alias("pred"))
    return E.derived_accuracy(g, "n", "prev", "rec", "pred").select("label", "n", "accuracy", "note")


_LIMITS = (64, 128, 256, 512, 1024, 2048, 4096)


@query("WITH x AS (SELECT length(text) AS x FROM documents WHERE text IS NOT NULL), l AS (SELECT unnest([64, 128, 256, 512, 1024, 2048, 4096]) AS max_length), m AS (SELECT count(*) AS n, quantile_cont(x, 0.5) AS median, max(x)::INT AS longest FROM x) SELECT max_length::INT AS max_length, n, median, longest, round((SELECT avg((x > max_length)::INT) FROM x), 6) AS share_longer FROM l, m")
def truncation_share(spark, d):
    return E.truncation(table(spark, d, "documents"), F.length("text"), _LIMITS)


@query("WITH x AS (SELECT l_discount AS s, l_returnflag = 'R' AS y FROM lineitem), r AS (SELECT y, (rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE) AS rk FROM x) SELECT round((sum(rk) FILTER (y) - count(*) FILTER (y) * (count(*) FILTER (y) + 1) / 2.0::DOUBLE) / (count(*) FILTER (y)::DOUBLE * count(*) FILTER (NOT y)), 6) AS roc_auc FROM r")
def roc_auc(spark, d):
    return E.roc_auc(table(spark, d, "lineitem").select(F.col("l_discount").alias("s"), (F.col("l_returnflag") == "R").alias("y")), "s", "y")


@query("WITH x AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT day, event_type, n, sum(n) OVER (PARTITION BY event_type ORDER BY day)::BIGINT AS done FROM x")
def burnup_series(spark, d):
    """Cumulative counts per day; the running sum goes over one row per day and type."""
    from pyspark.sql import Window

    g = table(spark, d, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("done", F.sum("n").over(Window.partitionBy("event_type").orderBy("day")))


@query("SELECT c_custkey, CASE WHEN n_name IS NULL THEN NULL ELSE 'p-' || n_nationkey END AS pseudonym FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def pseudonymise(spark, d):
    m = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("k"), F.concat(F.lit("p-"), "n_nationkey").alias("v"))
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("pseudonym"))
    return C.pseudonymise(c, "pseudonym", m, "k", "v").select("c_custkey", "pseudonym")


@query(f"WITH {_QA}, x AS (SELECT source_domain, coalesce(trim(query, {P.WS}) <> '', false) AND coalesce(trim(answer, {P.WS}) <> '', false) AND coalesce(trim(context_set, {P.WS}) <> '', false) AS ok FROM qa) SELECT source_domain, count(*) FILTER (ok) AS n_valid, count(*) FILTER (NOT ok) AS n_rejected FROM x GROUP BY 1")
def contract_split(spark, d):
    """valid and rejected records by the import contract."""
    solid = lambda c: F.coalesce(F.trim(F.col(c), F.lit(" \t\n\r")) != "", F.lit(False))
    q = qa(spark, d, "source_domain", "query", "answer", "context_set").withColumn("ok", solid("query") & solid("answer") & solid("context_set"))
    return q.groupBy("source_domain").agg(F.count_if("ok").alias("n_valid"), F.count_if(~F.col("ok")).alias("n_rejected"))


@query(f"WITH al AS ({P._alpha_sql('source_domain, label')}) SELECT source_domain, label, alpha, CASE WHEN alpha < 0 THEN 'red' WHEN alpha < 0.667 THEN 'yellow' WHEN alpha IS NOT NULL THEN 'ok' END AS tier FROM al")
def alpha_tiers(spark, d):
    return P.alpha_by_group(spark, d).select("source_domain", "label", "alpha", X.alpha_tier(F.col("alpha")).alias("tier"))


@query(f"WITH {_RB}, o AS (SELECT domain, purpose, count(*) FILTER (status = 'submitted') AS n_submitted, count(*) FILTER (status = 'discarded') AS n_discarded, count(DISTINCT record_uuid) AS n_records, count(DISTINCT annotator_id) AS n_annotators FROM b GROUP BY 1, 2), sc AS (SELECT * FROM (SELECT DISTINCT domain FROM dom), (SELECT unnest(['production', 'calibration']) AS purpose)) SELECT domain, purpose, coalesce(n_submitted, 0) AS n_submitted, coalesce(n_discarded, 0) AS n_discarded, coalesce(n_records, 0) AS n_records, coalesce(n_annotators, 0) AS n_annotators FROM sc LEFT JOIN o USING (domain, purpose)")
def ops_table(spark, d):
    """One row per domain and purpose, also where nothing happened."""
    b = base(spark, d)
    sc = table(spark, d, "qa_records").select(F.col("source_domain").alias("domain")).distinct().withColumn("purpose", F.explode(F.array(F.lit("production"), F.lit("calibration"))))
    o = b.groupBy("domain", "purpose").agg(F.count_if(F.col("status") == "submitted").alias("n_submitted"), F.count_if(F.col("status") == "discarded").alias("n_discarded"), F.count_distinct("record_uuid").alias("n_records"), F.count_distinct("annotator_id").alias("n_annotators"))
    return sc.join(o, ["domain", "purpose"], "left").na.fill(0)


@query(f"""WITH {_EV}, g AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 1800000000 THEN 0 ELSE 1 END AS fresh FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, record_id, task)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY us, record_id, task) AS no FROM g), s AS (SELECT user_id, no, min(us) AS a, max(us) AS b, count(*) AS n_events FROM n GROUP BY 1, 2)
SELECT user_id, make_timestamp(a) AS start, make_timestamp(b) AS "end", n_events FROM s WHERE b + 1800000000 <= (SELECT max(us) // 1000 * 1000 FROM ev) - 86400000000""")
def session_stream(spark, d):
    """The live sessions of the event table, read as a stream and drained once; closed sessions only, as append mode has it."""
    import uuid

    from annolytics.session import shared_dir
    from annolytics.streaming.sessions import session_stream as sessions

    path = f"{d}/response_log.parquet"
    schema, out = spark.read.parquet(path).schema, f"{shared_dir(spark)}/annolytics-stream-{uuid.uuid4().hex}"
    src = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path if _is_dir(path) else f"{d}/response_log*.parquet")
    q = sessions(src).writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True)
    q.start().awaitTermination()
    rows = spark.read.schema("user_id string, start timestamp, end timestamp, n_events bigint").parquet(f"{out}/rows")
    return rows.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n_events")


def _is_dir(path: str) -> bool:
    import os

    return os.path.isdir(path)


QUERIES, ORACLE = Q, S
