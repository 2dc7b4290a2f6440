"""Queries over sources, sinks, staging, evaluators, catalogues and lineage, each beside its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from annolytics.functions import scalars as X
from annolytics.operators import clean as C, governance as G, lineage as L, metrics as M, reports as T, staging as S_
from annolytics.plans import annotation as P
from annolytics.plans.operations import _QA, qa
from annolytics.session import shared_dir
from annolytics.sinks import writers as W
from annolytics.sources import readers as R
from annolytics.sources.tables import clean_key, table

Q, S = {}, {}
key = P.key


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            S[f.__name__] = sql
        return f

    return add


def scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/annolytics-{name}-{uuid.uuid4().hex}"


_EXPORT = ["record_uuid", "annotator_id", "response_status", "calibration", "record_status", "created_at", "discard_reason", "notes", "chunk_id", "chunk_rank", "n_retrieved_chunks", *P.RET]
_PROG = "CASE WHEN n_retrieved_chunks = 4 THEN 'four' WHEN n_retrieved_chunks = 6 THEN '_test' ELSE 'others' END"


@query(f"SELECT programme, count(*) AS n, count(*) FILTER (calibration) AS n_calibration, {', '.join(f'count(*) FILTER ({c}) AS n_{c}' for c in P.RET)}, count(nullif(notes, '')) AS n_notes, count(nullif(chunk_id, '')) AS n_chunks FROM (SELECT *, {_PROG} AS programme FROM retrieval_rows) WHERE programme <> '_test' GROUP BY 1")
def csv_partitions(spark, d):
    """The exports of programme folders, written as contract CSV and read again."""
    root, r = scratch(spark, "exports"), table(spark, d, "retrieval_rows").withColumn("programme", F.expr(_PROG))
    for name in ("four", "others", "_test"):
        W.write_contract_csv(r.where(F.col("programme") == name), f"{root}/{name}/retrieval.csv", _EXPORT, {"script": "csv_partitions"})
    t = R.read_partitions(spark, root, "retrieval")
    return t.groupBy("programme").agg(F.count(F.lit(1)).alias("n"), F.count_if("calibration").alias("n_calibration"), *[F.count_if(c).alias(f"n_{c}") for c in P.RET], F.count("notes").alias("n_notes"), F.count("chunk_id").alias("n_chunks"))


_GROUPS = f"""{_QA}, {P.R_SQL}, ch AS (SELECT record_uuid, chunk_id, min(chunk_rank)::INT AS chunk_rank FROM r WHERE chunk_id IS NOT NULL GROUP BY 1, 2)"""


def groups(spark, d):
    """A4: query groups with their chunks; the test tables hold no texts of chunks, so the id stands for it."""
    c = P.retrieval(spark, d).where("chunk_id IS NOT NULL").groupBy("record_uuid", "chunk_id").agg(F.min("chunk_rank").cast("int").alias("chunk_rank"))
    one = F.struct(F.col("chunk_rank"), F.col("chunk_id"), F.regexp_extract("chunk_id", r"^(.+)-c\d+$", 1).alias("doc_id"), F.col("chunk_id").alias("text"))
    a = c.groupBy("record_uuid").agg(F.sort_array(F.collect_list(one)).alias("chunks"))
    q = qa(spark, d, "query", "answer", "context_set", "language", "query_id").join(a, "record_uuid", "left")
    return q.withColumn("chunks", F.coalesce("chunks", F.array().cast("array<struct<chunk_rank:int,chunk_id:string,doc_id:string,text:string>>")))


@query(f"WITH {_GROUPS}, n AS (SELECT ru, query_id, language, answer, count(chunk_id) AS n_chunks, string_agg(chunk_id, ',' ORDER BY chunk_rank, chunk_id) AS chunk_ids FROM qa LEFT JOIN ch ON ch.record_uuid = ru GROUP BY ALL) SELECT query_id, language, length(answer) AS answer_chars, n_chunks, coalesce(chunk_ids, '') AS chunk_ids FROM n")
def jsonl_groups(spark, d):
    """Query groups written as JSON lines and read with their declared schema."""
    path = scratch(spark, "groups")
    chunk = lambda c: F.struct(c["chunk_id"].alias("chunk_id"), c["doc_id"].alias("doc_id"), c["chunk_rank"].alias("chunk_rank"), c["text"].alias("text"))
    W.write_jsonl(groups(spark, d).select("query", "answer", "context_set", "language", "query_id", F.transform("chunks", chunk).alias("chunks")), path)
    back = R.read_jsonl(spark, path, R.GROUP_SCHEMA)
    con = S_.import_contract(back).columns
    c = back.select("query_id", *con)
    return c.select("query_id", "language", F.length("answer").alias("answer_chars"), F.size("chunks").cast("bigint").alias("n_chunks"), F.array_join(F.transform("chunks", lambda x: x["chunk_id"]), ",").alias("chunk_ids"))


@query(f"WITH {_GROUPS}, f AS (SELECT ru, 'retrieval' AS task, chunk_id, query AS t, chunk_id AS p FROM qa JOIN ch ON ch.record_uuid = ru UNION ALL SELECT ru, 'grounding', NULL, answer, context_set FROM qa UNION ALL SELECT ru, 'generation', NULL, query, answer FROM qa) SELECT ru AS record_uuid, task, chunk_id, length(t) AS text_chars, length(p) AS pair_chars FROM f")
def task_fan_out(spark, d):
    """K + 2 rows of each query group."""
    return S_.fan_out(groups(spark, d), "record_uuid").select("record_uuid", "task", "chunk_id", F.length("text").alias("text_chars"), F.length("text_pair").alias("pair_chars"))


@query("WITH x AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS m, event_type, count(*) AS n, count(*) FILTER (value >= 50) AS s FROM events GROUP BY 1, 2) SELECT strftime(m, '%Y-%m-%d') || 'T00:00:00' AS run_at, event_type AS domain, n AS total_records, s AS submitted_responses FROM x")
def snapshot_history(spark, d):
    """One snapshot a month appended to a log of JSON lines, and the series of its domains."""
    path = scratch(spark, "log")
    e = table(spark, d, "events").groupBy(F.date_trunc("month", "ts").alias("m"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") >= 50).alias("s"))
    block = F.struct(F.struct(F.col("n").alias("total_records"), F.col("s").alias("submitted_responses")).alias("count"))
    snaps = e.groupBy("m").agg(F.map_from_entries(F.collect_list(F.struct("event_type", block))).alias("domains")).select(F.date_format("m", "yyyy-MM-dd'T'HH:mm:ss").alias("run_at"), F.lit(3).alias("schema_version"), "domains")
    for half in (0, 1):
        W.append_snapshot(snaps.where(F.month("m") % 2 == half), path)
    s = R.read_snapshots(spark, path).select("run_at", F.explode("domains").alias("domain", "x"))
    return s.select("run_at", "domain", "x.count.total_records", "x.count.submitted_responses")


@query("WITH x AS (SELECT count(*) AS n, count(*) FILTER (value >= 50) AS s FROM events) SELECT 'there' AS meta, n AS n_panels, s AS n_complete, round(s / n::DOUBLE, 6) AS fraction_complete FROM x UNION ALL SELECT 'missing', NULL, NULL, NULL")
def export_meta(spark, d):
    """A meta file, and one that is missing."""
    path = scratch(spark, "meta")
    e = table(spark, d, "events").agg(F.count(F.lit(1)).alias("n_panels"), F.count_if(F.col("value") >= 50).alias("n_complete"))
    e.select(F.lit("2026-07-30T12:38:00+00:00").alias("created_at"), F.struct("n_panels", "n_complete").alias("completeness_summary")).coalesce(1).write.json(path)
    both = R.read_meta(spark, path).withColumn("meta", F.lit("there")).unionByName(R.read_meta(spark, path + "-none").withColumn("meta", F.lit("missing")))
    return both.select("meta", "n_panels", "n_complete", T.share("n_complete", "n_panels").alias("fraction_complete"))


@query("WITH f AS (SELECT doc_id, sha256(coalesce(text, '')) AS x FROM documents WHERE doc_id % 50 <> 7), p AS (SELECT doc_id, CASE WHEN doc_id % 40 = 3 THEN sha256('x') ELSE sha256(coalesce(text, '')) END AS y FROM documents) SELECT count(*) FILTER (x = y) AS n_ok, count(*) FILTER (x <> y) AS n_mismatch, count(*) FILTER (x IS NULL) AS n_absent, CASE WHEN count(*) FILTER (x <> y) > 0 THEN 2 WHEN count(*) FILTER (x IS NULL) > 0 THEN 3 ELSE 0 END AS exit_code FROM p LEFT JOIN f USING (doc_id)")
def pin_verdict(spark, d):
    """Pins written as text, read again and compared with the files there are."""
    t = table(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    path = scratch(spark, "pins")
    t.select(F.concat_ws("  ", F.when(F.col("doc_id") % 40 == 3, F.sha2(F.lit("x"), 256)).otherwise(F.col("digest")), F.concat(F.lit("docs/"), "doc_id")).alias("value")).write.text(path)
    files = t.where("doc_id % 50 <> 7").select(F.concat(F.lit("docs/"), "doc_id").alias("path"), "digest")
    return G.pin_verdict(R.read_pins(spark, path), files, "path", "digest")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE sha256(coalesce(text, '')) = CASE WHEN doc_id % 40 = 3 THEN sha256('x') ELSE sha256(coalesce(text, '')) END END AS pinned FROM documents")
def pin_state(spark, d):
    """The pinned file, another one, or no pin."""
    t = table(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    pins = t.where("doc_id % 3 <> 0").select("doc_id", F.when(F.col("doc_id") % 40 == 3, F.sha2(F.lit("x"), 256)).otherwise(F.col("digest")).alias("digest"))
    return G.pin_state(t, pins, "doc_id", "digest")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 1 AND source IS NOT NULL THEN 1 ELSE 0 END::BIGINT AS n_chunks, CASE WHEN doc_id % 2 = 1 AND source IS NOT NULL THEN coalesce(origin_id, 'doc0') || '-c1' END AS chunk_id, CASE WHEN doc_id % 2 = 1 AND source IS NOT NULL THEN 1 END::INT AS chunk_rank, length(coalesce(text, '')) AS answer_chars FROM documents")
def tagged_answers(spark, d):
    """Answers with tagged documents before them, and without; a document without text isn't a chunk."""
    doc = F.to_json(F.array(F.struct(F.coalesce("origin_id", F.lit("")).alias("id"), F.col("source").alias("text"), F.lit("0").alias("ref"))))
    raw = F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit("<data>"), doc, F.lit("</data>"), F.coalesce("text", F.lit("")))).otherwise(F.coalesce("text", F.lit("")))
    docs, answer = R.tagged_stream(F.col("raw"))
    t = table(spark, d, "documents").select("doc_id", raw.alias("raw")).select("doc_id", R.chunks_of(docs).alias("c"), answer.alias("a"))
    return t.select("doc_id", F.size("c").cast("bigint").alias("n_chunks"), F.get("c", F.lit(0))["chunk_id"].alias("chunk_id"), F.get("c", F.lit(0))["chunk_rank"].alias("chunk_rank"), F.length("a").alias("answer_chars"))


@query(f"WITH {P.R_SQL}, g AS (SELECT record_uuid, count(*) FILTER (status = 'submitted') AS s, max(calibration::INT) AS c FROM r GROUP BY 1) SELECT CASE WHEN c = 1 THEN 'calibration' ELSE 'production' END AS dataset, count(*) AS n_records, sum(s)::BIGINT AS n_submitted FROM g GROUP BY 1")
def backup_manifest(spark, d):
    """Nested records written by dataset, and their counts."""
    r = P.retrieval(spark, d)
    resp = F.struct(F.lit("topically_relevant").alias("question_name"), F.col("topically_relevant").cast("string").alias("value"), F.col("annotator_id").alias("user_id"), "status")
    g = r.groupBy("record_uuid").agg(F.collect_list(resp).alias("resp"), F.max(F.col("calibration").cast("int")).alias("c"), F.max("n_retrieved_chunks").alias("k"))
    rec = R.record_struct(g, "record_uuid", ("k",), ("c",), F.col("resp"))
    rec = rec.withColumn("dataset", F.when(F.col("metadata")["c"] == "1", "calibration").otherwise("production"))
    return W.write_backup(rec, scratch(spark, "backup"), "dataset")


@query(f"WITH e AS (SELECT DISTINCT {key('user_id')} AS u, epoch_us(inserted_at) AS us, {key('record_id')} AS r, {key('task')} AS task, purpose FROM response_log WHERE inserted_at IS NOT NULL AND user_id IS NOT NULL) SELECT task, count(*) AS n_events, count(DISTINCT u) AS n_users, max(us) AS last_us FROM e GROUP BY 1")
def response_pages(spark, d):
    """Pages as the REST source gives them, dumped as JSON, and the events in them."""
    path = scratch(spark, "pages")
    e = table(spark, d, "response_log").where("inserted_at IS NOT NULL AND user_id IS NOT NULL").select(clean_key("user_id").alias("u"), F.date_format("inserted_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("at"), clean_key("record_id").alias("r"), clean_key("task").alias("task"), F.coalesce("purpose", F.lit("")).alias("purpose"))
    resp = F.struct(F.col("u").alias("user_id"), F.lit("submitted").alias("status"), F.col("at").alias("inserted_at"))
    items = e.groupBy("r", "task", "purpose").agg(F.collect_list(resp).alias("responses"))
    item = F.struct(F.col("r").alias("id"), F.create_map(F.lit("task"), "task", F.lit("purpose"), "purpose").alias("metadata"), "responses")
    pages = items.groupBy(F.pmod(F.xxhash64("r"), F.lit(64)).alias("page")).agg(F.collect_list(item).alias("items"), F.count(F.lit(1)).alias("total"))
    W.write_jsonl(pages.select("items", "total"), path)
    x = R.read_response_pages(spark, path)
    return x.groupBy("task").agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_id").alias("n_users"), F.max(F.unix_micros("at")).alias("last_us"))


@query(f"WITH {_QA}, i AS (SELECT ru, 'u-' || dense_rank() OVER (ORDER BY ru) AS id FROM qa WHERE substr(ru, 1, 1) <> 'f') SELECT ru AS record_uuid, id AS user_key FROM qa LEFT JOIN i USING (ru)")
def user_ids(spark, d):
    """Names with their ids, where there is one."""
    from annolytics.operators.consolidate import ranked

    q = qa(spark, d).select("record_uuid")
    ids = ranked(q.where("substring(record_uuid, 1, 1) <> 'f'"), "record_uuid", "k").select("record_uuid", F.concat(F.lit("u-"), F.col("k") + 1).alias("user_key"))
    return q.join(ids, "record_uuid", "left")


# --- evaluators ---------------------------------------------------------------------------------------------------
_EV2 = "SELECT l_linenumber % 3 AS task, l_discount * 10 AS p, l_returnflag = 'R' AS y FROM lineitem"


@query(f"WITH x AS ({_EV2}), g AS (SELECT task, count(*) AS n, count(*) FILTER (y AND p >= 0.5)::DOUBLE AS tp, count(*) FILTER (NOT y AND p >= 0.5) AS fp, count(*) FILTER (y AND p < 0.5) AS fn FROM x GROUP BY 1) SELECT task, n, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1, round((n - fp - fn) / n::DOUBLE, 6) AS accuracy FROM g")
def evaluator_metrics(spark, d):
    """One row per task."""
    return S_.confusion(table(spark, d, "lineitem").select((F.col("l_linenumber") % 3).alias("task"), (F.col("l_discount") * 10).alias("p"), (F.col("l_returnflag") == "R").alias("y")), ("task",), "p", "y")


@query("SELECT task, label FROM (VALUES " + ", ".join(f"('{t}', '{c}')" for t, ls in C.LABELS.items() for c in ls) + ") v(task, label) WHERE task = 'generation'")
def labels_not_trained(spark, d):
    """What isn't trained: all of generation here."""
    rows = [(t, c) for t, ls in C.LABELS.items() for c in ls]
    all_ = spark.createDataFrame(rows, "task string, label string")
    return S_.not_trained(all_, all_.where("task <> 'generation'"), ("task", "label"))


@query("WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index, o_totalprice FROM orders) SELECT row_index, o_orderkey, round(o_totalprice / 1000000, 6) AS probability, o_orderkey % 2 = 0 AS truth FROM p")
def index_join(spark, d):
    """Rows numbered without gaps, and probabilities joined with truth on the number, each exactly once."""
    t = S_.with_index(table(spark, d, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderkey") % 2 == 0).alias("truth")), "o_orderkey")
    return S_.join_on_index(t.select("row_index", "o_orderkey", F.round(F.col("o_totalprice") / 1_000_000, 6).alias("probability")), t.select("row_index", "truth"))


_GEN = "SELECT o_orderstatus = 'F' AS proper_action, o_orderpriority < '3' AS response_on_topic, o_totalprice > 100000 AS helpful, o_orderstatus = 'P' AS incomplete, o_totalprice < 0 AS unsafe_content FROM orders"


@query(f"WITH i AS ({_GEN}), m AS ({' UNION ALL '.join(f'''SELECT '{c}' AS label, count(*) AS n, count(*) FILTER ({c}) AS k FROM i''' for c in C.LABELS['generation'])}), x AS (SELECT *, k / n::DOUBLE AS p, 1.96::DOUBLE AS z FROM m) SELECT label, n, k, round(p, 6) AS rate, round(greatest(0.0::DOUBLE, ((p + z*z/(2*n)) - z*sqrt(p*(1-p)/n + z*z/(4.0::DOUBLE*n*n))) / (1 + z*z/n)), 6) AS ci_lower, round(least(1.0::DOUBLE, ((p + z*z/(2*n)) + z*sqrt(p*(1-p)/n + z*z/(4.0::DOUBLE*n*n))) / (1 + z*z/n)), 6) AS ci_upper FROM x")
def generation_rates(spark, d):
    """M9: the five rates of generation, over orders in the place of answers."""
    o = table(spark, d, "orders").select((F.col("o_orderstatus") == "F").alias("proper_action"), (F.col("o_orderpriority") < "3").alias("response_on_topic"), (F.col("o_totalprice") > 100000).alias("helpful"), (F.col("o_orderstatus") == "P").alias("incomplete"), (F.col("o_totalprice") < 0).alias("unsafe_content"))
    return M.rates(o.select(*[F.col(c).cast("int").alias(c) for c in C.LABELS["generation"]]), C.LABELS["generation"])


#: Metric: task and the labels it rests on.
RATES = {"grounding_presence_rate": ("grounding", "support_present"), "unsupported_claim_rate": ("grounding", "unsupported_claim_present"), "contradiction_rate": ("grounding", "contradicted_claim_present"), "citation_presence_rate": ("grounding", "source_cited")}
_MR = " UNION ALL ".join([f"SELECT 'grounding' AS task, '{m}' AS metric, '{c}' AS source_labels, true AS expected, avg({c}) AS point, count(*) AS n FROM items" for m, (_, c) in RATES.items()] + [
    "SELECT 'grounding', 'conditional_fabrication_rate', 'source_cited;fabricated_source', true, avg(fabricated_source) FILTER (source_cited = 1), count(*) FILTER (source_cited = 1) FROM items",
    "SELECT 'grounding', 'conditional_rate_of_none', 'source_cited;fabricated_source', true, avg(fabricated_source) FILTER (source_cited = 2), 0 FROM items"])


@query(f"WITH {P.ITEMS_G}, ne AS (SELECT count(*) AS ex FROM items), m AS ({_MR}) SELECT task, metric, round(point, 6) AS point, CASE WHEN point IS NULL THEN 0 ELSE n END::BIGINT AS n, ex AS n_examples, 'calib-complete' AS policy, source_labels, CASE WHEN point IS NULL THEN 'undefined_no_denominator' ELSE 'ok' END AS status FROM m, ne UNION ALL SELECT 'generation', 'proper_action_rate', NULL, 0, 0, 'calib-complete', 'proper_action', 'no_data' UNION ALL SELECT 'grounding', 'helpfulness_rate', NULL, 0, (SELECT ex FROM ne), 'calib-complete', 'helpful', 'evaluator_labels_incomplete'")
def metric_rows(spark, d):
    """Every metric of the catalogue has a row, also where it is undefined or has no data."""
    i = P.gnd_items(spark, d)
    cat = [("grounding", m, c, True) for m, (_, c) in RATES.items()] + [("grounding", m, "source_cited;fabricated_source", True) for m in ("conditional_fabrication_rate", "conditional_rate_of_none")]
    cat += [("generation", "proper_action_rate", "proper_action", True), ("grounding", "helpfulness_rate", "helpful", False)]
    cited, none = F.col("source_cited") == 1, F.col("source_cited") == 2
    row = i.agg(F.count(F.lit(1)).alias("ex"), *[F.avg(c).alias(m) for m, (_, c) in RATES.items()], F.avg(F.when(cited, F.col("fabricated_source"))).alias("conditional_fabrication_rate"), F.count_if(cited).alias("n_c"), F.avg(F.when(none, F.col("fabricated_source"))).alias("conditional_rate_of_none"), F.count_if(none).alias("n_n"))
    one = lambda m, n: F.struct(F.lit("grounding").alias("task"), F.lit(m).alias("metric"), F.col(m).alias("point"), F.col(n).cast("bigint").alias("n"), F.col("ex").alias("n_examples"), F.col("ex").alias("n_raw"))
    bare = F.struct(F.lit("grounding").alias("task"), F.lit("helpfulness_rate").alias("metric"), F.lit(None).cast("double").alias("point"), F.lit(0).cast("bigint").alias("n"), F.col("ex").alias("n_examples"), F.col("ex").alias("n_raw"))
    m = row.select(F.explode(F.array(*[one(m, "ex") for m in RATES], one("conditional_fabrication_rate", "n_c"), one("conditional_rate_of_none", "n_n"), bare)).alias("x")).select("x.*")
    return T.metric_rows(m, spark.createDataFrame(cat, "task string, metric string, source_labels string, expected boolean"), T.policy_slug(False, False))


# --- staging ------------------------------------------------------------------------------------------------------
@query(f"WITH {_QA}, {P.G_SQL}, s AS (SELECT ru AS record_uuid, answer, context_set, count(*) OVER (PARTITION BY ru) AS n_copies, row_number() OVER (PARTITION BY ru ORDER BY inserted_at, annotator_id) AS rn FROM g JOIN qa ON ru = g.record_uuid WHERE status = 'submitted') SELECT record_uuid, length(answer) AS text_chars, length(context_set) AS pair_chars, n_copies FROM s WHERE rn = 1 AND regexp_replace(coalesce(answer, ''), '[\\s\\p{{Z}}]+', '', 'g') <> '' AND regexp_replace(coalesce(context_set, ''), '[\\s\\p{{Z}}]+', '', 'g') <> ''")
def staged_pairs(spark, d):
    """Submitted rows to text pairs, one per item, blank ones refused."""
    g = P.grounding(spark, d).join(qa(spark, d, "answer", "context_set").select("record_uuid", "answer", "context_set"), "record_uuid")
    p = S_.staged_pairs(g, "grounding", ("record_uuid",), ("inserted_at", "annotator_id"))
    return p.select("record_uuid", F.length("text").alias("text_chars"), F.length("text_pair").alias("pair_chars"), "n_copies")


@query(f"WITH {_QA} SELECT ru AS record_uuid, CASE WHEN answer IS NULL OR regexp_replace(answer, '[\\s\\p{{Z}}]+', '', 'g') = '' THEN 'error' WHEN coalesce(n_retrieved_chunks, 0) = 0 THEN 'no_retrieval' ELSE 'ok' END AS outcome FROM qa")
def outcome_routing(spark, d):
    """F20."""
    return qa(spark, d, "answer", "n_retrieved_chunks").select("record_uuid", S_.outcome("answer", F.col("n_retrieved_chunks")).alias("outcome"))


@query(f"WITH {P.ITEMS_G}, m AS ({' UNION ALL '.join(f'''SELECT '{c}' AS label, sum({c})::BIGINT AS n_true, (count(*) - sum({c}))::BIGINT AS n_false FROM items''' for c in P.GND)}) SELECT *, least(n_true, n_false) AS n_minority, (least(n_true, n_false) >= 30 AND label IN ('support_present', 'unsupported_claim_present', 'contradicted_claim_present')) AS kept FROM m")
def class_floor(spark, d):
    """the labels with enough of the rarer class, of the three that are trained."""
    from annolytics.operators import consolidate as K

    return S_.class_floor(K.prevalence(P.gnd_items(spark, d), P.GND).select("label", "n_true", "n_false"), 30, P.GND[:3])


@query(f"WITH {P.ITEMS_R} SELECT record_uuid, count(DISTINCT chunk_id) = max(k) AS complete FROM it GROUP BY 1")
def complete_panels(spark, d):
    """M10."""
    return M.complete_panels(P.ret_items(spark, d), "record_uuid", "chunk_id", "k")


@query("WITH x AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN ' TRUE' WHEN 1 THEN 'false ' WHEN 2 THEN 't' WHEN 3 THEN '' END AS v FROM orders) SELECT o_orderkey, CASE lower(trim(v)) WHEN 'true' THEN true WHEN 'false' THEN false END AS value FROM x")
def tri_state_parse(spark, d):
    """F15."""
    k = F.col("o_orderkey") % 5
    v = F.when(k == 0, " TRUE").when(k == 1, "false ").when(k == 2, "t").when(k == 3, "")
    return table(spark, d, "orders").select("o_orderkey", C.tri_state(v).alias("value"))


# --- catalogue and lineage ----------------------------------------------------------------------------------------
_DOCOF = "regexp_extract(chunk_id, '^(.+)-c[0-9]+$', 1)"


@query(f"WITH {P.R_SQL}, m AS (SELECT record_uuid, chunk_id, {_DOCOF} AS doc_id FROM r WHERE chunk_id IS NOT NULL GROUP BY ALL), c AS (SELECT doc_id, count(*) AS n_chunks, count(DISTINCT record_uuid) AS n_queries FROM m GROUP BY 1) SELECT m.record_uuid, m.chunk_id, doc_id, n_chunks, n_queries FROM m JOIN c USING (doc_id)")
def manifest_catalogue(spark, d):
    """The manifest's chunks with their document's row of the catalogue, one row each."""
    m = P.retrieval(spark, d).where("chunk_id IS NOT NULL").select("record_uuid", "chunk_id", F.regexp_extract("chunk_id", r"^(.+)-c\d+$", 1).alias("doc_id")).distinct()
    return m.join(m.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"), F.count_distinct("record_uuid").alias("n_queries")), "doc_id")


@query(f"WITH {_QA}, {P.R_SQL}, c AS (SELECT record_uuid, count(DISTINCT chunk_id) AS n, count(*) FILTER (status = 'submitted') AS s FROM r WHERE chunk_id IS NOT NULL GROUP BY 1) SELECT count(*) AS n_queries, count(*) FILTER (coalesce(n, 0) = 0) AS n_empty, count(*) FILTER (s > 0) AS n_started FROM qa LEFT JOIN c ON c.record_uuid = ru")
def manifest_totals(spark, d):
    """A25, J1."""
    c = P.retrieval(spark, d).where("chunk_id IS NOT NULL").groupBy("record_uuid").agg(F.count_distinct("chunk_id").alias("n"), F.count_if(F.col("status") == "submitted").alias("s"))
    return qa(spark, d).select("record_uuid").join(c, "record_uuid", "left").agg(F.count(F.lit(1)).alias("n_queries"), F.count_if(F.coalesce("n", F.lit(0)) == 0).alias("n_empty"), F.count_if(F.col("s") > 0).alias("n_started"))


@query("WITH c AS (SELECT source_domain, origin_id, max(lang) AS lang FROM documents WHERE origin_id IS NOT NULL GROUP BY 1, 2) SELECT count(*) AS n_documents, count(lang) AS n_resolved, count(*) FILTER (lang = 'de') AS n_german, round(count(lang) / count(*)::DOUBLE, 4) AS coverage FROM c")
def catalogue_summary(spark, d):
    """A26."""
    c = table(spark, d, "documents").where("origin_id IS NOT NULL").groupBy("source_domain", "origin_id").agg(F.max("lang").alias("lang"))
    return c.agg(F.count(F.lit(1)).alias("n_documents"), F.count("lang").alias("n_resolved"), F.count_if(F.col("lang") == "de").alias("n_german"), F.round(F.try_divide(F.count("lang"), F.count(F.lit(1))), 4).alias("coverage"))


@query("SELECT r_name AS collection, count(*) AS n_rows, min(vec_id) AS first_id, max(vec_id) AS last_id FROM embeddings JOIN region ON label % 5 = r_regionkey WHERE label IS NOT NULL GROUP BY 1")
def embedding_rollup(spark, d):
    """Embeddings joined with their collection, filtered and grouped, without reading the vectors."""
    e = table(spark, d, "embeddings").where("label IS NOT NULL").select("vec_id", (F.col("label") % 5).alias("r_regionkey"))
    return e.join(F.broadcast(table(spark, d, "region").limit(1000)), "r_regionkey").groupBy(F.col("r_name").alias("collection")).agg(F.count(F.lit(1)).alias("n_rows"), F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id"))


@query("WITH l AS (SELECT o_custkey % 7 AS dataset, year(o_orderdate) AS bundle, o_orderkey AS id FROM orders WHERE o_orderkey % 3 <> 0 AND o_custkey % 7 < 5), la AS (SELECT * FROM l WHERE (dataset, bundle) IN (SELECT dataset, max(bundle) FROM l GROUP BY 1)), i AS (SELECT o_custkey % 7 AS dataset, o_orderkey AS id FROM orders WHERE o_orderkey % 10 <> 1) SELECT coalesce(i.dataset, la.dataset) AS dataset, coalesce(i.id, la.id) AS id, CASE WHEN i.dataset >= 5 THEN 'kept' WHEN i.id IS NOT NULL AND la.id IS NOT NULL THEN 'kept' WHEN i.id IS NOT NULL THEN 'deleted' ELSE 'missing' END AS state FROM i FULL JOIN la ON i.dataset = la.dataset AND i.id = la.id")
def lineage_reproduce(spark, d):
    """G7 = D7 + F17: the curated state by the latest keep-list of each dataset."""
    o = table(spark, d, "orders").select((F.col("o_custkey") % 7).alias("dataset"), F.year("o_orderdate").alias("bundle"), F.col("o_orderkey").alias("id"))
    return G.reproduce(o.where("id % 10 <> 1").select("dataset", "id"), o.where("id % 3 <> 0 AND dataset < 5"), "dataset", "bundle", "id")


@query("WITH l AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders), b AS (SELECT o_orderkey, 'X' AS s, NULL AS p FROM orders WHERE o_orderkey % 2 = 0) SELECT o_orderkey, coalesce(s, o_orderstatus) AS o_orderstatus, o_orderpriority FROM l LEFT JOIN b USING (o_orderkey)")
def restore_scoped(spark, d):
    """Only the named attribute comes from the backup."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    b = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), F.lit(None).cast("string").alias("o_orderpriority"))
    return L.restore(o, b, "o_orderkey", ("o_orderstatus", "o_orderpriority"), ("o_orderstatus",))


@query("WITH x AS (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'overwrite' WHEN o_orderkey % 11 = 0 THEN 'new' ELSE 'identical' END AS status FROM orders) SELECT status, count(*) AS n FROM x GROUP BY 1")
def restore_preview(spark, d):
    """What a restore would do, by kind."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    live = o.where("o_orderkey % 11 <> 0 OR o_orderkey % 13 = 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 13 == 0, "Y").otherwise(F.col("o_orderstatus")))
    s = L.diff(live, o, "o_orderkey", ("o_orderstatus",))
    return s.groupBy(F.when(F.col("status") == "updated", "overwrite").otherwise(F.col("status")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, 'overwrite ' || o_orderkey AS line FROM orders WHERE o_orderkey % 13 = 0 ORDER BY o_orderkey LIMIT 20")
def overwrite_preview(spark, d):
    """The first 20 overwritten records, a preview by contract."""
    return table(spark, d, "orders").where("o_orderkey % 13 = 0").orderBy("o_orderkey").limit(20).select("o_orderkey", F.concat(F.lit("overwrite "), "o_orderkey").alias("line"))


@query("SELECT event_type AS task, user_id % 20 AS population, min('run-' || (user_id % 20)) AS run FROM events GROUP BY 1, 2")
def run_discovery(spark, d):
    """One run of each task and population."""
    e = table(spark, d, "events").select(F.col("event_type").alias("task"), (F.col("user_id") % 20).alias("population"))
    return G.one_run_per(e.withColumn("run", F.concat(F.lit("run-"), "population")), ("task", "population"), "run")


# --- scalars ------------------------------------------------------------------------------------------------------
_NAMES = "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment WHEN c_custkey % 4 = 1 THEN c_mktsegment || ', ' || c_name || '-X Y (Hrsg.)' WHEN c_custkey % 4 = 2 THEN c_mktsegment || ', Anna Maria' END AS author FROM customer"


@query(f"WITH x AS ({_NAMES}) SELECT c_custkey, CASE WHEN c_custkey % 4 = 1 THEN split_part(split_part(author, ', ', 2), '-', 1) WHEN c_custkey % 4 = 2 THEN 'Anna' END AS first_name, CASE c_custkey % 3 WHEN 0 THEN 'de' WHEN 1 THEN 'en' ELSE 'fr' END AS lang, c_custkey || '__a' AS rest, 'ws' AS workspace FROM x")
def scalar_parts(spark, d):
    """First names, codes of languages, the parts of a dataset's key."""
    k = F.col("c_custkey")
    author = F.when(k % 4 == 0, F.col("c_mktsegment")).when(k % 4 == 1, F.concat("c_mktsegment", F.lit(", "), "c_name", F.lit("-X Y (Hrsg.)"))).when(k % 4 == 2, F.concat("c_mktsegment", F.lit(", Anna Maria")))
    lang = F.when(k % 3 == 0, " German ").when(k % 3 == 1, "english").otherwise("fr")
    parts = F.split(F.concat(F.lit("ws__"), k.cast("string"), F.lit("__a")), "__", 2)
    return table(spark, d, "customer").select("c_custkey", X.first_name(author).alias("first_name"), X.language_code(lang).alias("lang"), parts[1].alias("rest"), parts[0].alias("workspace"))


@query("SELECT o_orderkey, CAST(o_orderdate + INTERVAL 1 HOUR AS DATE) AS local_day, strftime(o_orderdate + INTERVAL 1 HOUR, '%H:%M') AS shown FROM orders WHERE month(o_orderdate) IN (1, 2)")
def local_times(spark, d):
    """ISO text to a moment, shown in a zone (winter time here)."""
    o = table(spark, d, "orders").where(F.month("o_orderdate").isin(1, 2)).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))
    at = F.from_utc_timestamp(F.to_timestamp("iso"), "Europe/Berlin")
    return o.select("o_orderkey", F.to_date(at).alias("local_day"), F.date_format(at, "HH:mm").alias("shown"))


@query("WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN 'x' END AS s1, CASE WHEN c_custkey % 3 = 0 THEN 'y' END AS s2 FROM customer), b AS (SELECT *, CASE WHEN s1 IS NOT NULL THEN CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'unknown' END WHEN s2 IS NULL THEN 'm' END AS g_verf1, CASE WHEN s2 IS NOT NULL THEN 'm' END AS g_verf2 FROM a) SELECT c_custkey, g_verf1, g_verf2, CASE WHEN g_verf1 = 'f' AND g_verf2 = 'm' THEN 'mixed' WHEN g_verf1 = 'f' THEN 'f' WHEN g_verf2 = 'm' OR g_verf1 = 'm' THEN 'm' ELSE 'unknown' END AS gender FROM b")
def gender_slots(spark, d):
    """Verdicts on the first names of author slots, and on the document."""
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select("c_custkey", F.when(k % 5 > 0, F.when(k % 2 == 0, "Meier, Anna-Lena").otherwise("Meier, Kim")).alias("verf1"), F.when(k % 3 == 0, "Kurz, Otto (Hrsg.)").alias("verf2"), F.lit("Lang, OTTO").alias("pers1"))
    v = spark.createDataFrame([("anna", "f"), ("otto", "m")], "name string, verdict string")
    return S_.gender_slots(c, ("verf1", "verf2"), "pers1", F.broadcast(v)).select("c_custkey", "g_verf1", "g_verf2", "gender")


QUERIES, ORACLE = Q, S
