"""Cleaning, filters and contract checks of rater tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolytics.sources.tables import clean_key

LABELS = {
    "retrieval": ("topically_relevant", "evidence_sufficient", "misleading"),
    "grounding": ("support_present", "unsupported_claim_present", "contradicted_claim_present", "source_cited", "fabricated_source"),
    "generation": ("proper_action", "response_on_topic", "helpful", "incomplete", "unsafe_content"),
}
CHUNK_ID = r"^.+-c[0-9]+$"


def responses(df: DataFrame, labels: tuple[str, ...], chunk: bool) -> DataFrame:
    """Rater rows with clean keys and the given labels; placeholders of chunk ids become null. Labels stay three-valued."""
    cols = [clean_key("record_uuid").alias("record_uuid"), clean_key("annotator_id").alias("annotator_id"), clean_key("response_status").alias("status"), "calibration", "inserted_at", clean_key("discard_reason").alias("discard_reason"), "notes"]
    if chunk:
        cid = clean_key("chunk_id")
        cols += [F.when(cid.rlike(CHUNK_ID), cid).alias("chunk_id"), "chunk_rank", "n_retrieved_chunks"]
    return df.select(*cols, *labels)


def submitted(df: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """submitted rows whose labels are all given; discarded rows carry none."""
    cond = F.col("status") == "submitted"
    for c in labels:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def drop_wholly_calibration(df: DataFrame, key: str = "record_uuid", flag: str = "calibration") -> DataFrame:
    """drop the groups of which every row is calibration; mixed groups stay whole. Null flags count as not calibration.

    A grouped aggregate and an anti-join rather than a window: no group has to fit one task."""
    whole = df.groupBy(key).agg(F.bool_and(F.coalesce(flag, F.lit(False))).alias("all")).where("all").select(key)
    return df.join(whole, key, "left_anti")


def require(df: DataFrame, columns: tuple[str, ...], non_null: tuple[str, ...] = ()) -> DataFrame:
    """refuse a table without the columns at once, and a null in `non_null` when the row is read."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    for c in non_null:
        df = df.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null in {c}"))).otherwise(F.col(c)))
    return df


def tri_state(col: Column | str) -> Column:
    """'true' and 'false' in any case with blanks around them; all else is null."""
    t = F.lower(F.trim(F.col(col) if isinstance(col, str) else col))
    return F.when(t == "true", True).when(t == "false", False)


def is_blank(col: str) -> Column:
    """F8: null or nothing but white space."""
    return F.col(col).isNull() | (F.regexp_replace(col, r"[\s\p{Z}]+", "") == "")


def is_uuid(col: str) -> Column:
    """A UUID with or without hyphens, braces or the urn prefix."""
    return F.col(col).rlike(r"(?i)^(urn:uuid:)?\{?[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}\}?$")


def pseudonymise(df: DataFrame, col: str, mapping: DataFrame, key: str, value: str, strict: bool = True) -> DataFrame:
    """replace identities by their pseudonyms. UUIDs, nulls and blanks pass; an unmapped one aborts the job without
    being named, or becomes null where strict is False. The mapping must have one row per key."""
    m = mapping.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    out = df.join(m, F.col(col) == F.col("__k"), "left")
    unmapped = F.raise_error(F.lit("unmapped identity")).cast("string") if strict else F.lit(None).cast("string")
    new = F.when(F.col(col).isNull() | (F.trim(col) == "") | is_uuid(col), F.col(col)).when(F.col("__v").isNotNull(), F.col("__v")).otherwise(unmapped)
    return out.withColumn(col, new).drop("__k", "__v")


def resume(df: DataFrame, done: DataFrame, key: str, cap: int | None = None) -> DataFrame:
    """F16: what isn't done yet, in the order of the key; the cap, if given, counts after the filter."""
    left = df.join(done.select(key).distinct(), key, "left_anti")
    return left if cap is None else left.orderBy(key).limit(cap)
