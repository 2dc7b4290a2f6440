"""Inter-annotator agreement on binary labels, closed forms over item counts.

Ratings are (keys..., item, value) with value 0 or 1; what isn't rated is absent. Only items with two ratings or more
are pairable. Pooled figures are computed over the pooled counts, never as means of groups' figures.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def item_counts(ratings: DataFrame, keys: tuple[str, ...], item: tuple[str, ...], value: str = "value") -> DataFrame:
    """n ratings and k true ones of each item (within keys)."""
    return ratings.where(F.col(value).isNotNull()).groupBy(*keys, *item).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(value).cast("double").alias("k"))


def alpha(counts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Krippendorff's alpha (nominal). alpha is null without pairable items; where all pairable ratings are alike it
    is 1 and degenerate is true. n_items counts pairable items, n_ratings their ratings."""
    p = counts.where("n >= 2")
    a = p.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_items"), F.sum("n").alias("N"), F.sum("k").alias("K"), F.sum(2 * F.col("k") * (F.col("n") - F.col("k")) / (F.col("n") - 1)).alias("d"))
    de = 2 * F.col("K") * (F.col("N") - F.col("K")) / (F.col("N") * (F.col("N") - 1))
    return a.select(*keys, "n_items", F.col("N").cast("bigint").alias("n_ratings"), (de == 0).alias("degenerate"), F.round(F.when(de == 0, F.lit(1.0)).otherwise(1 - F.col("d") / F.col("N") / de), 6).alias("alpha"))


def alpha_interval(counts: DataFrame, keys: tuple[str, ...], resamples: int = 1000, seed: int = 0, level: float = 0.95) -> DataFrame:
    """A5: keys, n_items, alpha, ci_lower, ci_upper: percentile bounds of alpha under a bootstrap of the pairable items.

    alpha depends on an item only by its n and k, so items are counted by these first, and a resample of all items is one
    multinomial draw over the few classes: the work doesn't grow with the items. Draws are seeded by seed and keys,
    whatever the partitioning. A resample without variance counts as 1, like alpha itself. Keys without pairable items
    have no row."""
    classes = counts.where("n >= 2").groupBy(*keys, "n", "k").agg(F.count(F.lit(1)).alias("c"))

    def run(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(["n", "k"])
        n, k, c = (x[i].to_numpy(float) for i in ("n", "k", "c"))
        draws = np.random.default_rng([seed, zlib.crc32(repr(key).encode())]).multinomial(int(c.sum()), c / c.sum(), resamples)
        both = []
        for m in (c[None], draws):
            total, true = m @ n, m @ k
            expected = 2 * true * (total - true) / (total * (total - 1))
            observed = m @ (2 * k * (n - k) / (n - 1)) / total
            both.append(np.where(expected == 0, 1.0, 1 - observed / np.where(expected == 0, 1, expected)))
        lo = (1 - level) / 2
        return pd.DataFrame([[*key, int(c.sum()), both[0][0], *np.quantile(both[1], [lo, 1 - lo])]], columns=[*keys, "n_items", "alpha", "ci_lower", "ci_upper"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counts.select(*keys).schema)
    out = classes.groupBy(*keys).applyInPandas(run, f"{types}, n_items bigint, alpha double, ci_lower double, ci_upper double")
    return out.select(*keys, "n_items", *[F.round(c, 6).alias(c) for c in ("alpha", "ci_lower", "ci_upper")])


def percent_agreement(counts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Mean over pairable items of the share of agreeing pairs."""
    n, k = F.col("n"), F.col("k")
    return counts.where("n >= 2").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_items"), F.round(F.avg((k * (k - 1) + (n - k) * (n - k - 1)) / (n * (n - 1))), 6).alias("pct_agreement"))


def marginals(ratings: DataFrame, keys: tuple[str, ...], value: str = "value") -> DataFrame:
    """Counts over all ratings, single ones too, and the disagreement expected from them (null below two ratings)."""
    g = ratings.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_ratings"), F.sum(value).cast("bigint").alias("n_true"))
    n, t = F.col("n_ratings").cast("double"), F.col("n_true").cast("double")
    return g.select(*keys, "n_ratings", "n_true", F.least("n_true", F.col("n_ratings") - F.col("n_true")).alias("n_minority"), F.round(t / n, 6).alias("prevalence"), F.round(F.when(F.col("n_ratings") >= 2, 2 * t * (n - t) / (n * (n - 1))), 6).alias("expected_disagreement"))


def degenerate_overlap(ratings: DataFrame, keys: tuple[str, ...], item: tuple[str, ...], rater: str, value: str = "value") -> DataFrame:
    """A4: whether the ratings of items with two raters or more are all alike; null where there are no such items."""
    r = ratings.where(F.col(value).isNotNull())
    per = r.groupBy(*keys, *item).agg(F.count_distinct(rater).alias("raters"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    over = F.col("raters") >= 2
    return per.groupBy(*keys).agg(F.count_if(over).alias("n_overlap"), F.when(F.count_if(over) > 0, F.min(F.when(over, F.col("lo"))) == F.max(F.when(over, F.col("hi")))).alias("degenerate"))


def cohen_pairs(ratings: DataFrame, keys: tuple[str, ...], item: tuple[str, ...], rater: str, value: str = "value") -> DataFrame:
    """Cohen's kappa of every pair of raters who share items: annotator_a < annotator_b, n_items, kappa (1 where neither
    varies). One rating per item and rater is expected; pairs arise within an item, where raters are few."""
    r = ratings.where(F.col(value).isNotNull()).select(*keys, *item, F.col(rater).alias("r"), F.col(value).alias("v"))
    a, b = r.withColumnsRenamed({"r": "annotator_a", "v": "x"}), r.withColumnsRenamed({"r": "annotator_b", "v": "y"})
    p = a.join(b, [*keys, *item]).where("annotator_a < annotator_b")
    g = p.groupBy(*keys, "annotator_a", "annotator_b").agg(F.count(F.lit(1)).alias("n_items"), F.avg((F.col("x") == F.col("y")).cast("double")).alias("po"), F.avg("x").alias("px"), F.avg("y").alias("py"))
    pe = F.col("px") * F.col("py") + (1 - F.col("px")) * (1 - F.col("py"))
    return g.select(*keys, "annotator_a", "annotator_b", "n_items", (F.round(F.when(pe == 1, F.lit(1.0)).otherwise((F.col("po") - pe) / (1 - pe)), 6) + 0.0).alias("kappa"))
