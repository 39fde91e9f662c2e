"""Percentiles that can be carried on: a sketch per day, merged for any span of days without its rows.

An opt-in beside the exact quantiles of :mod:`tickloom.operators.scan`. A sketch holds a few KB however many rows a day
has; its quantiles are of a rank near the one asked for, and ``rank_errors`` measures how near.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_K = 800  # size of a sketch: by the published formula about 0.55 % of rank at 99 % confidence
RANK_ERROR = 0.0133  # what a merged quantile may be off in rank; far beyond what sketches of this size reach


def day_sketches(rows: DataFrame, value: str, keys: list[str], k: int = SKETCH_K) -> DataFrame:
    """One sketch of ``value`` per keys, a day among them. NULL and NaN are not counted.

    Sketches are filled in the map tasks, so a day that holds most rows sends on one sketch per task.
    """
    found = rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return found.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, fractions: dict[str, float], keys: list[str] = []) -> DataFrame:
    """Quantiles of the merged sketches per key, output name → fraction, and ``n``, the rows they stand for.

    Without keys one row, NULL when there is no sketch.
    """
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.count("sketch").alias("parts"))
    size = F.kll_sketch_get_n_double("sketch")
    found = [
        F.when(size > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(f)))).alias(name)
        for name, f in fractions.items()
    ]
    return merged.select(*keys, *found, F.when(F.col("parts") > 0, size).otherwise(F.lit(0)).cast("bigint").alias("n"))


def rank_errors(rows: DataFrame, value: str, estimates: DataFrame, fractions: dict[str, float]) -> DataFrame:
    """How far the rank of each estimate is from its fraction, counted over all rows: name, fraction, estimate, n, error.

    ``estimates`` is the one row of ``sketch_quantiles`` without keys. An estimate that several rows share has all their
    ranks, and the nearest one counts. Without rows the error is NULL.
    """
    names = list(fractions)
    found = estimates.select(F.struct(*names)).scalar()
    counted = rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(F.col(value).cast("double").alias("v"))
    below = [F.count_if(F.col("v") < found[name]).alias(f"below_{name}") for name in names]
    upto = [F.count_if(F.col("v") <= found[name]).alias(f"upto_{name}") for name in names]
    ranks = counted.agg(F.count("*").alias("n"), *below, *upto).select("*", found.alias("found"))

    def row(name: str, fraction: float):
        low, high = F.try_divide(f"below_{name}", "n"), F.try_divide(f"upto_{name}", "n")
        error = F.when(F.col("n") > 0, F.greatest(low - fraction, fraction - high, F.lit(0.0)))
        return F.struct(
            F.lit(name).alias("name"), F.lit(float(fraction)).alias("fraction"),
            F.col("found")[name].alias("estimate"), F.col("n"), error.alias("error"),
        )

    return ranks.select(F.inline(F.array(*[row(n, f) for n, f in fractions.items()])))
