"""Ranking, batches and selection under quotas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealspark.session import stored, task_count


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """First k rows of each group; Spark prunes each task to k rows of a group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def global_position(df: DataFrame, key: str, name: str = "position") -> DataFrame:
    """0-based position in the order of a unique key, without sorting all rows in one task.

    Rows are dealt to ranges of the key that Spark bounds by a sample, whatever the key's values, and stored with their range; the
    ranges' first positions come from a window over one count for each of them.
    """
    ranges = stored(df.repartitionByRange(task_count(df), key).withColumn("__range", F.spark_partition_id()))
    counts = ranges.groupBy("__range").agg(F.count("*").alias("__n"))
    before = counts.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__range").orderBy(key)) - 1
    return ranges.withColumn("__own", own).join(F.broadcast(before), "__range").withColumn(name, F.col("__before") + F.col("__own")).drop("__range", "__own", "__before")  # a row a range


def quota_pool(df: DataFrame, count: int) -> DataFrame:
    """The rows that ``balanced_quota`` can pick: the first ``count`` of each category, at home and abroad.

    Nothing is lost: a pass takes the rows of a category in the order of penalty and name, and picks and swaps together
    take at most ``count`` rows of one group. Repeated rows count once, as they do there.
    """
    return top_per_group(df.distinct(), ["category", "domestic"], [F.asc("penalty"), F.asc("name")], count).drop("rank")


def balanced_quota(rows: list[dict], count: int, least_domestic: int) -> list[dict]:
    """Greedy selection over a short list (``quota_pool`` keeps what it needs of a long one).

    Pass 1 takes the best of each category, categories with fewer earlier reports first; pass 2 fills up, each
    pick of a category making its next one dearer; pass 3 swaps the last rows from abroad for domestic ones. Counts
    are not lowered for rows that a swap removes.
    """
    chosen: list[dict] = []
    taken: dict[str, int] = {}
    earlier = {r["category"]: r["earlier"] for r in rows}
    for category in sorted(earlier, key=lambda c: (earlier[c], c)):
        own = [r for r in rows if r["category"] == category and r not in chosen]
        if own and len(chosen) < count:
            chosen.append(min(own, key=lambda r: (r["penalty"], r["name"])))
            taken[category] = 1
    while len(chosen) < count and (left := [r for r in rows if r not in chosen]):
        pick = min(left, key=lambda r: (taken.get(r["category"], 0) + earlier[r["category"]], r["penalty"], r["name"]))
        chosen.append(pick)
        taken[pick["category"]] = taken.get(pick["category"], 0) + 1
    for spare in sorted((r for r in rows if r["domestic"] and r not in chosen), key=lambda r: (r["penalty"], r["name"])):
        abroad = [r for r in chosen if not r["domestic"]]
        if sum(r["domestic"] for r in chosen) >= least_domestic or not abroad:
            break
        chosen[chosen.index(max(abroad, key=lambda r: (r["penalty"], r["name"])))] = spare
    return sorted(chosen, key=lambda r: (r["penalty"], r["name"]))
