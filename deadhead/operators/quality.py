"""Checks and corrections between filling distances and building tours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from deadhead import labels


class MissingDistances(ValueError):
    """Legs without a distance remain after all sources were tried."""


def missing_count(legs: DataFrame) -> DataFrame:
    """One row: the number of legs without a distance; raises at run time unless it is 0."""
    counted = legs.agg(F.count(F.when(F.col("dist").isNull(), 1)).alias("miss_dist"))
    checked = F.when(F.col("miss_dist") == 0, F.lit(0).cast("long")).otherwise(
        F.raise_error(F.lit(labels.MISSING_DISTANCES)).cast("long")
    )
    return counted.select(checked.alias("missing"))


def require_distances(legs: DataFrame) -> None:
    """Stop the job when a leg has no distance."""
    found = legs.filter(F.col("dist").isNull()).count()
    if found:
        raise MissingDistances(f"{labels.MISSING_DISTANCES}: {found} legs")


def observed(legs: DataFrame) -> tuple[DataFrame, Observation]:
    """``legs`` that count those without a distance while they are written or read, so the gate needs no scan of its own."""
    seen = Observation("legs")
    return legs.observe(seen, F.count(F.when(F.col("dist").isNull(), 1)).alias("missing"), F.count(F.lit(1)).alias("legs")), seen


def require_observed(seen: Observation) -> None:
    """Stop the job when the legs written had one without a distance."""
    if seen.get["missing"]:
        raise MissingDistances(f"{labels.MISSING_DISTANCES}: {seen.get['missing']} legs")


def overwrite_rates(legs: DataFrame, partner_rates: DataFrame) -> DataFrame:
    """Replace the one-way cost where a rate exists for the zip pair, by NULL if that rate is NULL.

    A zip pair listed twice is an error as soon as a leg uses it.
    """
    rates = partner_rates.groupBy(F.col("ozip").alias("o_zip"), F.col("dzip").alias("d_zip")).agg(
        F.count(F.lit(1)).alias("_n"), F.max("bsl_rate").alias("_rate")
    )
    cost = (
        F.when(F.col("_n").isNull(), F.col("ow_cost_per_load"))
        .when(F.col("_n") == 1, F.col("_rate"))
        .otherwise(
            F.raise_error(
                F.concat(F.lit("several rates for "), F.col("o_zip"), F.lit(" -> "), F.col("d_zip"))
            ).cast("double")
        )
    )
    return (
        legs.join(rates, ["o_zip", "d_zip"], "left").withColumn("ow_cost_per_load", cost).select(*legs.columns)
    )


def purge_legs(legs: DataFrame) -> DataFrame:
    """Keep legs with a non-negative distance and a known one-way cost."""
    return legs.filter((F.col("dist") >= 0) & F.col("ow_cost_per_load").isNotNull())
