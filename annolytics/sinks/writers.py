"""Writers: contract CSV with a provenance record, JSON lines, appended snapshots, staged rewrites, freezes, backups.

Every writer writes a folder of part files through Spark's commit protocol; only names, digests and row counts come to the
driver. A rewrite goes to a folder of its own first and replaces the old one by renaming.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file."""
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def digests(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, length, digest) of the files under the paths: sha256 of their bytes, computed where they lie."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths)).select("path", "length", F.sha2("content", 256).alias("digest"))


def tree_digest(spark: SparkSession, path: str) -> str:
    """One digest of a folder: of the sorted digests of its files, whatever their names."""
    return digests(spark, path).where("path NOT LIKE '%/_SUCCESS' AND path NOT LIKE '%.crc'").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("digest")), "\n"), 256).alias("d")).first()["d"]


def provenance(spark: SparkSession, script: str, inputs: list[str], **facts) -> dict:
    """G1: what made a table: script, facts, and each input with its digest; inputs that are missing stay in, marked."""
    out = []
    for p in inputs:
        path, fs = _fs(spark, p)
        out.append({"path": p, "sha256": tree_digest(spark, p) if fs.exists(path) else None, "missing": not fs.exists(path)})
    return {"script": script, "inputs": out, **facts}


def write_contract_csv(df: DataFrame, path: str, columns: list[str], prov: dict | None = None, dictionary: str | None = None) -> DataFrame:
    """K1/K4: the columns in their order (a missing one is refused), nulls as empty cells; beside it <path>.provenance.json
    with the rows' number and digest, and the data dictionary if given. Gives what was written, read again."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    spark, out = df.sparkSession, df.select(*columns)
    out.write.mode("errorifexists").option("header", True).option("escape", '"').option("nullValue", "").option("emptyValue", '""').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    back = spark.read.schema(out.schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    if prov is not None:
        write_text(spark, f"{path}.provenance.json", json.dumps({**prov, "n_rows": back.count(), "output_sha256": tree_digest(spark, path), "columns": columns}, indent=1, sort_keys=True, default=str))
    if dictionary is not None:
        write_text(spark, f"{path}.dictionary.md", dictionary)
    return back


def write_jsonl(df: DataFrame, path: str) -> None:
    """K2: JSON lines; null fields are left out."""
    df.write.mode("errorifexists").json(path)


def append_snapshot(df: DataFrame, path: str) -> None:
    """K3: add snapshots to the log. The new files appear whole or not at all, so readers and other writers need no lock."""
    df.write.mode("append").json(path)


def rewrite(df: DataFrame, path: str) -> None:
    """K5: replace a table of Parquet, which df may itself be read from: written beside it, then renamed."""
    spark = df.sparkSession
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(new)
    (p, fs), (n, _), (o, _) = _fs(spark, path), _fs(spark, new), _fs(spark, old)
    if fs.exists(p):
        fs.rename(p, o)
    if not fs.rename(n, p):
        raise OSError(f"couldn't rename to {path}")
    fs.delete(o, True)


def write_backup(records: DataFrame, path: str, dataset: str) -> DataFrame:
    """Nested records as JSON by dataset; gives (dataset, n_records, n_submitted), which is written beside them."""
    records.write.mode("errorifexists").partitionBy(dataset).json(f"{path}/records_full")
    submitted = F.size(F.filter("responses", lambda r: r["status"] == "submitted"))
    m = records.groupBy(dataset).agg(F.count(F.lit(1)).alias("n_records"), F.sum(F.when(submitted > 0, submitted).otherwise(0)).cast("bigint").alias("n_submitted"))
    m.write.mode("errorifexists").json(f"{path}/manifest")
    return m


def freeze(spark: SparkSession, source: str, target: str, pins: str) -> DataFrame:
    """Copy a tree once to a dated folder, which must not exist, and pin its files: (path, digest), path relative.
    A pin table is never rewritten."""
    (s, fs), (t, _) = _fs(spark, source), _fs(spark, target)
    if fs.exists(t):
        raise FileExistsError(target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, s, fs, t, False, False, spark._jsc.hadoopConfiguration())
    cut = len(fs.makeQualified(t).toUri().getPath()) + 2
    d = digests(spark, target).where("path NOT LIKE '%.crc'").select(F.expr(f"substring(regexp_replace(path, '^file:/*', '/'), {cut})").alias("path"), "digest")
    d.select(F.concat_ws("  ", "digest", "path").alias("value")).coalesce(1).write.mode("errorifexists").text(pins)
    return d


def markdown_table(df: DataFrame, columns: list[str], most: int = 10_000) -> str:
    """K6: a small report as a pipe table; refused above `most` rows. Bars within cells are escaped, nulls are '-'."""
    rows = df.select(*columns).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    cell = lambda v: "-" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    return "\n".join(["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns), *["| " + " | ".join(map(cell, r)) + " |" for r in rows]])


def html_table(df: DataFrame, columns: list[str], most: int = 10_000) -> str:
    """K6: the same as an HTML table."""
    import html

    rows = df.select(*columns).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    tr = lambda cells, tag: "<tr>" + "".join(f"<{tag}>{html.escape('-' if c is None else str(c))}</{tag}>" for c in cells) + "</tr>"
    return "<table>" + tr(columns, "th") + "".join(tr(r, "td") for r in rows) + "</table>"


def collapsible(title: str, body: str) -> str:
    """K6: a part that opens on demand."""
    return f"<details><summary>{title}</summary>\n\n{body}\n\n</details>"
