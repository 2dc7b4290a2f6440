"""Readers of the exchange formats, each with a declared schema: nothing is inferred, and what doesn't fit is refused."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolytics.operators.clean import LABELS, require

_HEAD = "record_uuid string, annotator_id string, response_status string, calibration string, record_status string, created_at timestamp, discard_reason string, discard_notes string, notes string"
_TEXTS = {"retrieval": "query string, chunk string, chunk_id string, chunk_rank int, n_retrieved_chunks int", "grounding": "answer string, context_set string", "generation": "query string, answer string"}
#: A1: schema of each task's export.
TASK_SCHEMA = {t: ", ".join([_HEAD, _TEXTS[t], *[f"{c} string" for c in LABELS[t]]]) for t in LABELS}
#: Columns that a task's export must have, and those without nulls.
REQUIRED = ("record_uuid", "annotator_id", "response_status", "calibration")
CHUNK = "struct<chunk_id: string, doc_id: string, chunk_rank: int, title: string, score: double, text: string>"
#: A4: a query group.
GROUP_SCHEMA = f"query string, answer string, context_set string, language string, query_id string, domain string, role string, topic string, intent string, task string, difficulty string, format string, spec_stem string, retried boolean, chunks array<{CHUNK}>"
#: A snapshot of the log, as far as the series need it.
SNAPSHOT_SCHEMA = "run_at string, schema_version int, domains map<string, struct<count: struct<total_records: bigint, submitted_responses: bigint, completed_records: bigint, n_annotators: bigint>, error: string>>"
#: A2: the export's meta file.
META_SCHEMA = "created_at string, constraint_summary map<string, bigint>, completeness_summary struct<n_panels: bigint, n_complete: bigint>"
#: A10: a record of a backup.
RECORD_SCHEMA = "id string, fields map<string, string>, metadata map<string, string>, suggestions array<struct<question_name: string, value: string, score: double, agent: string>>, responses array<struct<question_name: string, value: string, user_id: string, status: string>>"
EXCLUDED = ("_test", "sandbox")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_task(spark: SparkSession, path: str, task: str) -> DataFrame:
    """One task's export as CSV with its declared schema. A missing or empty file is an empty frame; a file without
    a required column is refused at once, a null in one when the row is read. Labels and calibration become three-valued
    (F15); blank cells are null, never 0 or ''."""
    from annolytics.operators.clean import tri_state

    if not _exists(spark, path):
        return spark.createDataFrame([], TASK_SCHEMA[task]).select("*", *[]).withColumns({c: F.lit(None).cast("boolean") for c in ("calibration", *LABELS[task])})
    head = csv_columns(spark, path)
    if not head:
        return read_task(spark, path + "/none", task)
    missing = [c for c in REQUIRED if c not in head]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    df = spark.read.schema(", ".join(f"`{c}` string" for c in head)).option("header", True).option("multiLine", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
    types = dict(x.strip().split(" ", 1) for x in TASK_SCHEMA[task].split(","))
    df = df.select(*[(F.col(c).cast(t) if c in head else F.lit(None).cast(t)).alias(c) for c, t in types.items()])
    df = require(df, (), ("record_uuid", "annotator_id", "response_status"))
    return df.withColumns({c: tri_state(c) for c in ("calibration", *LABELS[task])})


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """The header of a CSV, without reading its rows; [] of an empty file."""
    first = spark.read.text(path).limit(1).collect()
    return [c.strip().strip('"') for c in first[0][0].lstrip("\ufeff").split(",")] if first and first[0][0] else []


def read_partitions(spark: SparkSession, root: str, task: str, excluded: tuple[str, ...] = EXCLUDED) -> DataFrame:
    """The task's files of all programme folders under root, but for the excluded ones, as one table with the
    column programme; each file is read with its schema. A folder without the file adds nothing."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(fs_path) if s.isDirectory())
    out = None
    for name in names:
        if name not in excluded:
            part = read_task(spark, f"{root}/{name}/{task}.csv", task).withColumn("programme", F.lit(name))
            out = part if out is None else out.unionByName(part)
    return out if out is not None else read_task(spark, f"{root}/none", task).withColumn("programme", F.lit(None).cast("string"))


def read_jsonl(spark: SparkSession, path: str, schema: str, mode: str = "FAILFAST") -> DataFrame:
    """S3: JSON lines with a declared schema; blank lines are skipped, broken ones refused (or null with PERMISSIVE)."""
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """One row: created_at, constraint_summary, n_panels, n_complete; all null where the file is missing."""
    if not _exists(spark, path):
        return spark.createDataFrame([(None, None, None, None)], "created_at string, constraint_summary map<string, bigint>, n_panels bigint, n_complete bigint")
    m = spark.read.schema(META_SCHEMA).option("multiLine", True).json(path)
    return m.select("created_at", "constraint_summary", "completeness_summary.n_panels", "completeness_summary.n_complete")


def read_pins(spark: SparkSession, path: str) -> DataFrame:
    """(path, digest) of lines of a digest, two blanks and a path; other lines, such as headers, are left out."""
    rx = r"^([0-9a-f]{64})  (.+)$"
    return spark.read.text(path).where(F.col("value").rlike(rx)).select(F.regexp_extract("value", rx, 2).alias("path"), F.regexp_extract("value", rx, 1).alias("digest"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id) of a list with one id a line; blank lines and blanks around ids don't count."""
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''")


def read_snapshots(spark: SparkSession, path: str, least_version: int = 3) -> DataFrame:
    """The snapshots of a log of JSON lines: run_at, schema_version, domains, digest (sha256 of the line). A
    version below least_version is refused when its row is read."""
    t = spark.read.text(path).where(F.trim("value") != "")
    s = t.select(F.from_json("value", SNAPSHOT_SCHEMA).alias("s"), F.sha2("value", 256).alias("digest")).select("s.*", "digest")
    old = F.raise_error(F.lit("a snapshot of an older schema")).cast("int")
    return s.withColumn("schema_version", F.when(F.col("schema_version") >= least_version, F.col("schema_version")).otherwise(old))


def snapshot_at(snapshots: DataFrame, run_at: str | None = None) -> DataFrame:
    """The snapshot of that moment, without one the last; at most one row (the greatest digest of equals)."""
    s = snapshots if run_at is None else snapshots.where(F.col("run_at") == run_at)
    return s.orderBy(F.col("run_at").desc(), F.col("digest").desc()).limit(1)


def tagged_stream(c: Column | str) -> tuple[Column, Column]:
    """(documents, answer) of '<data>json</data>answer': an array of structs (id, url, text, ref, title). Without
    either tag all of it is answer; JSON that can't be read gives no documents."""
    from annolytics.functions.scalars import tagged_answer

    c = F.col(c) if isinstance(c, str) else c
    docs, answer = tagged_answer(c)
    return F.coalesce(F.from_json(docs, "array<struct<id: string, url: string, text: string, ref: string, title: string>>"), F.array().cast("array<struct<id: string, url: string, text: string, ref: string, title: string>>")), answer


def chunks_of(docs: Column) -> Column:
    """Documents as chunks: doc_id is the id, else the url, else 'doc' and its place from 0; the rank is the ref, else
    the place from 1; documents without text are dropped. '' and '0' count as missing."""
    some = lambda x: F.nullif(F.nullif(x, F.lit("")), F.lit("0"))

    def one(x, i):
        doc = F.coalesce(some(x["id"]), some(x["url"]), F.concat(F.lit("doc"), i.cast("string")))
        return F.struct(F.concat(doc, F.lit("-c1")).alias("chunk_id"), doc.alias("doc_id"), F.coalesce(some(x["ref"]).try_cast("int"), (i + 1).cast("int")).alias("chunk_rank"), x["title"].alias("title"), x["text"].alias("text"))

    return F.filter(F.transform(docs, one), lambda y: F.coalesce(F.trim(y["text"]), F.lit("")) != "")


def record_struct(df: DataFrame, key: str, fields: tuple[str, ...], metadata: tuple[str, ...], responses: Column) -> DataFrame:
    """Rows as nested records: id, fields and metadata as maps, responses as they are given."""
    pairs = lambda cols: F.map_from_entries(F.array(*[F.struct(F.lit(c), F.col(c).cast("string")) for c in cols]))
    return df.select(F.col(key).alias("id"), pairs(fields).alias("fields"), pairs(metadata).alias("metadata"), responses.alias("responses"))


#: A page of the REST source, as it was dumped.
PAGE_SCHEMA = "items array<struct<id: string, metadata: map<string, string>, responses: array<struct<user_id: string, status: string, inserted_at: string>>>>, total bigint"


def read_response_pages(spark: SparkSession, path: str) -> DataFrame:
    """The events of dumped pages: user_id, at, purpose, record_id, task of every submitted response with a time. A
    record that stands on two pages counts once for each user and time."""
    x = read_jsonl(spark, path, PAGE_SCHEMA).select(F.explode("items").alias("i")).select("i.id", "i.metadata", F.explode("i.responses").alias("r"))
    x = x.where("r.status = 'submitted' AND r.inserted_at IS NOT NULL")
    return x.select(F.col("r.user_id").alias("user_id"), F.to_timestamp("r.inserted_at").alias("at"), F.col("metadata")["purpose"].alias("purpose"), F.col("id").alias("record_id"), F.col("metadata")["task"].alias("task")).distinct()


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query of a database; filters and aggregates behind it are pushed down where the driver can."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def file_pool(spark: SparkSession, root: str, stem: str) -> list[str]:
    """The files '<stem>.jsonl' and '<stem>_batch<n>.jsonl' under root, in order."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    names = [s.getPath().getName() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return [f"{root}/{n}" for n in sorted(names) if re.fullmatch(rf"{re.escape(stem)}(_batch\d+)?\.jsonl", n)]


