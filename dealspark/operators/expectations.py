"""Declarative quality rules over tables and documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failing(gates: Sequence[tuple[str, Column]], accepted: str = "accepted") -> Column:
    """Name of the first gate whose condition isn't true."""
    out = F.lit(accepted)
    for name, passes in reversed(gates):
        out = F.when(F.coalesce(passes, F.lit(False)), out).otherwise(F.lit(name))
    return out


def issues(rules: Sequence[tuple[str, Column]]) -> Column:
    """Messages of the rules that are broken (whose condition is true), in order."""
    return F.filter(F.array(*[F.when(broken, F.lit(message)) for message, broken in rules]), lambda x: x.isNotNull())


def violations(parts: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """One table (rule, key) of the violating rows of several tables."""
    tagged = [df.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key")) for rule, df, key in parts]
    return reduce(DataFrame.unionByName, tagged)


def completion(rows: Column | str, kinds: Sequence[str]) -> Column:
    """Status of a batch from its count of rows (null: there is none) and a flag for each kind of issue."""
    n = F.col(rows) if isinstance(rows, str) else rows
    failed = F.concat_ws(",", *[F.when(F.col(k), k) for k in kinds])
    return F.when(n.isNull(), "missing").when(failed != "", F.concat(F.lit("validation_failed:"), failed)).when(n <= 0, "no_case_rows").otherwise(F.concat(F.lit("valid:case_rows="), n.cast("string")))


def required(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """The rows as they are; the job fails with the check's name at the first row of which a check isn't true."""
    for name, passes in checks:
        df = df.where(F.assert_true(F.coalesce(passes, F.lit(False)), name).isNull())
    return df
