"""Fallback for each key: the first source with rows supplies a key, later ones stand in or only add what is new.

A source that failed is recorded, and the later sources of its family are skipped, as they would fail too.
Everything is decided by aggregates on key and address, so a key of very many rows is not gathered anywhere.

Defined cases: rows with a null key or from an unknown source are left out; rows with a null address are never equal to others; of equal addresses of one
source the caller's order decides; sources that offer nothing don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def source_status(sources: DataFrame) -> DataFrame:
    """The sources (source, rank, family, failed) with their status: failed, skipped (an earlier one of the family failed) or live."""
    before = Window.partitionBy("family").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)  # a catalogue of sources
    spoiled = F.coalesce(F.max(F.col("failed").cast("int")).over(before), F.lit(0)) == 1
    return sources.withColumn("status", F.when(spoiled & F.col("family").isNotNull(), "skipped").when(F.coalesce("failed", F.lit(False)), "failed").otherwise("live"))


def first_source_by_key(items: DataFrame, sources: DataFrame, key: str = "key") -> DataFrame:
    """Rows of the first live source that has any row for a key."""
    live = source_status(sources).where("status = 'live'").select("source", "rank")
    offered = items.where(F.col(key).isNotNull()).join(live, "source")
    first = offered.groupBy(key).agg(F.min("rank").alias("rank"))
    return offered.join(first, [key, "rank"])


def extended_by_key(items: DataFrame, sources: DataFrame, order: Column, key: str = "key", address: str = "address") -> DataFrame:
    """Rows of all live sources, each address of a key once: from the first source that has it, the first in order there."""
    live = source_status(sources).where("status = 'live'").select("source", "rank")
    offered = items.where(F.col(key).isNotNull()).join(live, "source")
    columns = offered.columns
    best = F.min_by(F.struct(*columns), F.struct(F.col("rank"), order)).alias("best")
    named = offered.where(F.col(address).isNotNull()).groupBy(key, address).agg(best).select("best.*")
    return named.select(columns).unionByName(offered.where(F.col(address).isNull()).select(columns))
