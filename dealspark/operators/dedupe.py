"""Exact first-wins deduplication; the fuzzy form is in ``identity``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: Column, order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key; aggregates before the shuffle, so a frequent key costs one row a task."""
    names = df.columns
    chosen = F.min_by(F.struct(*names), F.struct(*order)).alias("row")
    return df.groupBy(key.alias("__key")).agg(chosen).select("row.*")


def ordered_unique(values: Column, limit: int | None = None, width: int | None = None) -> Column:
    """Distinct values in order of appearance; uniqueness is decided before values are cut to ``width``."""
    out = F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))
    out = F.slice(out, 1, limit) if limit is not None else out
    return F.transform(out, lambda x: F.substring(x, 1, width)) if width is not None else out
