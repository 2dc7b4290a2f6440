"""Guards and lineage: freshness, stale pins, verification, reproduction of a curated state, layered configuration."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolytics.operators.lineage import latest_wins, prune, verify_pins


def fresh(sidecar: dict | None, population: str, freeze_date: str, digest: str) -> None:
    """Refuse an input whose provenance record is missing, names another population, another freeze or other bytes;
    in this order."""
    if sidecar is None:
        raise ValueError("no provenance record beside the input")
    for name, want in (("population", population), ("freeze_date", freeze_date), ("output_sha256", digest)):
        if sidecar.get(name) != want:
            raise ValueError(f"stale input: {name} is {sidecar.get(name)!r}, not {want!r}")


def newest_dated(names: list[str]) -> str | None:
    """The newest of the names that begin with an ISO date."""
    dated = []
    for n in names:
        m = re.match(r"\d{4}-\d\d-\d\d", n)
        if m:
            try:
                dated.append((date.fromisoformat(m.group()), n))
            except ValueError:
                continue
    return max(dated)[1] if dated else None


def stale_pin(names: list[str], pin: str) -> None:
    """Refuse a pin that isn't the newest dated folder."""
    newest = newest_dated(names)
    if newest != pin:
        raise ValueError(f"pin {pin!r} isn't the newest of the dated folders, {newest!r}")


def freeze_pin(created: list[str], runs: list[str], max_lag: timedelta = timedelta(hours=2)) -> str:
    """The first snapshot strictly after the newest creation time; refused where none follows within the lag."""
    at = max(datetime.fromisoformat(c) for c in created)
    later = sorted((r for r in runs if datetime.fromisoformat(r) > at), key=datetime.fromisoformat)
    if not later or datetime.fromisoformat(later[0]) - at > max_lag:
        raise ValueError("no snapshot within the lag after the export")
    return later[0]


def pin_verdict(pins: DataFrame, files: DataFrame, path: str, digest: str) -> DataFrame:
    """One row: n_ok, n_mismatch, n_absent and exit_code: 2 with a mismatch, else 3 with an absent file or no pin at
    all, else 0."""
    s = verify_pins(pins, files, path, digest).agg(*[F.count_if(F.col("state") == k).alias(f"n_{k.lower()}") for k in ("OK", "MISMATCH", "ABSENT")])
    return s.withColumn("exit_code", F.when(F.col("n_mismatch") > 0, 2).when((F.col("n_absent") > 0) | (F.col("n_ok") == 0), 3).otherwise(0))


def pin_state(files: DataFrame, pins: DataFrame, path: str, digest: str) -> DataFrame:
    """(path, pinned): true where the file is the pinned one, false where another, null where there is no pin."""
    p = pins.select(path, F.col(digest).alias("__p"))
    return files.join(p, path, "left").select(path, (F.col("__p") == F.col(digest)).alias("pinned"))


def reproduce(imported: DataFrame, lists: DataFrame, dataset: str, bundle: str, key: str) -> DataFrame:
    """The curated state from the imported records and all keep-lists: of each dataset its latest list holds (D7); its
    records are kept, deleted or missing by it (F17); datasets without a list stay as they are ('kept')."""
    last = latest_wins(lists, dataset, bundle)
    named = lists.select(dataset).distinct()
    both = prune(imported.join(named, dataset, "left_semi").select(F.struct(dataset, key).alias("k")), last.select(F.struct(dataset, key).alias("k")), "k").select("k.*", "state")
    rest = imported.join(named, dataset, "left_anti").select(dataset, key, F.lit("kept").alias("state"))
    return both.unionByName(rest)


def merge_config(base: dict, over: dict) -> dict:
    """Layered configuration: maps are merged, anything else of the upper layer replaces."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merge_config(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def known_keys(config: dict, schema: set[str]) -> dict:
    """the keys that the schema knows."""
    return {k: v for k, v in config.items() if k in schema}


def with_edge_cases(names: list[str]) -> list[str]:
    """each name and its edge cases."""
    return [x for n in names for x in (n, f"{n}_edgecase")]


def in_scope(df: DataFrame, **wanted: list) -> DataFrame:
    """rows of all the wanted values, column by column; a value that no row has is refused by name."""
    for c, values in wanted.items():
        have = {r[0] for r in df.where(F.col(c).isin(values)).select(c).distinct().collect()}  # at most the values asked for
        missing = [v for v in values if v not in have]
        if missing:
            raise ValueError(f"unknown {c}: {missing}")
        df = df.where(F.col(c).isin(values))
    return df


def one_run_per(df: DataFrame, keys: tuple[str, ...], run: str) -> DataFrame:
    """(keys, run); refused where a key has more than one run."""
    g = df.groupBy(*keys).agg(F.count_distinct(run).alias("__n"), F.min(run).alias(run))
    return g.select(*keys, F.when(F.col("__n") > 1, F.raise_error(F.lit("more than one run"))).otherwise(F.col(run)).alias(run))


def same_run(split_run: str, prediction_run: str) -> None:
    """the test split must be that of the run that predicted."""
    if split_run != prediction_run:
        raise ValueError(f"the test split is of run {split_run!r}, the predictions are of {prediction_run!r}")


def broken_links(pages: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, target) of the relative links of Markdown pages whose page or heading doesn't exist."""
    slug = lambda c: F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^\p{L}\p{N}\s_-]", ""), r"\s", "-")
    heads = pages.select(F.col(path).alias("__p"), F.explode(F.regexp_extract_all(F.col(text), F.lit(r"(?m)^#{1,6}[ \t]+(.+?)[ \t]*$"), 1)).alias("h")).select(F.concat_ws("#", "__p", slug(F.col("h"))).alias("t"))
    have = heads.unionAll(pages.select(F.col(path).alias("t"))).distinct()
    links = pages.select(path, F.explode(F.regexp_extract_all(F.col(text), F.lit(r"\[[^\]]*\]\(([^)\s]+)\)"), 1)).alias("target")).where("NOT target RLIKE '^[a-z]+:'")
    full = F.when(F.col("target").startswith("#"), F.concat(F.col(path), F.col("target"))).otherwise(F.concat(F.regexp_extract(path, r"^(.*/)?", 0), F.regexp_replace("target", r"^\./", "")))
    return links.withColumn("t", full).join(have, "t", "left_anti").select(path, "target").distinct()
