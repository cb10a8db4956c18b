"""Joins on containment, scores and fallbacks, without comparing everything with everything."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def word_shingles(text: Column, size: int) -> Column:
    """64-bit hashes of all runs of ``size`` white-space separated words."""
    def runs(words: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(1)))
        return F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(words, i, F.lit(size)), " "))))

    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.transform(F.array(words), runs)[0]  # bound as a variable, so that the text is split once


#: Bytes of lookup rows up to which they are broadcast, so that the runs of the texts aren't shuffled; beyond it Spark chooses the join.
LOOKUP_BYTES = 32_000_000
#: Characters by which a passage of few words is looked up.
RUN = 8


def contained_in(texts: DataFrame, passages: DataFrame, text: str, passage: str, key: str, ref: str, size: int = 5) -> DataFrame:
    """(key, ref) of texts that contain a passage as it stands; an empty passage is in none.

    A passage may begin and end inside words, so its second to ``size`` + 1st words look it up among the word
    shingles of the texts; one of fewer words is looked up by its first characters among the runs of characters. The lookup holds
    a hash of the passage instead of its text; the few matches are joined with both texts and confirmed by a full containment test.
    """
    words = F.filter(F.split(F.col(passage), r"\s+"), lambda w: w != "")
    wanted = passages.where(F.col(passage) != "").select(
        F.col(ref), F.xxhash64(passage).alias("__hash"), (F.size(words) >= size + 2).alias("__long"), F.least(F.length(passage), F.lit(RUN)).alias("__run"),
        F.xxhash64(F.array_join(F.slice(words, 2, size), " ")).alias("__gram"), F.col(passage).alias("__passage"),
    )
    weight = F.sum(F.coalesce(F.octet_length(F.col(ref).cast("string")), F.lit(0)) + 32)
    forms: dict[tuple[bool, int], int] = {}
    for r in wanted.groupBy("__long", "__run").agg(weight.alias("bytes")).collect():  # 2 * RUN rows at most
        form = (r["__long"], 0 if r["__long"] else r["__run"])
        forms[form] = forms.get(form, 0) + r["bytes"]
    few = sum(forms.values()) <= LOOKUP_BYTES
    found = []
    for long, run in sorted(forms):
        own = wanted.where("__long") if long else wanted.where(~F.col("__long") & (F.col("__run") == run)).withColumn("__gram", F.xxhash64(F.substring("__passage", 1, run)))
        own = own.select("__gram", ref, "__hash")
        grams = word_shingles(F.col(text), size) if long else character_runs(F.col(text), run)
        offered = texts.select(F.col(key), F.explode(grams).alias("__gram"))
        found.append(offered.join(F.broadcast(own) if few else own, "__gram").select(key, ref, "__hash"))
    if not found:
        return texts.select(key).limit(0).join(passages.select(ref).limit(0))
    met = reduce(DataFrame.union, found).distinct()
    told = wanted.select(F.col(ref).alias("__ref"), F.col("__hash").alias("__same"), "__passage")
    met = met.join(told, (F.col("__hash") == F.col("__same")) & F.col(ref).eqNullSafe(F.col("__ref"))).select(key, ref, "__passage")
    return met.join(texts.select(F.col(key), F.col(text).alias("__text")), key).where(F.contains("__text", "__passage")).select(key, ref).distinct()


def character_runs(text: Column, size: int) -> Column:
    """64-bit hashes of all distinct runs of ``size`` characters."""
    text = F.coalesce(text, F.lit(""))
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(text) - (size - 1), F.lit(1))), lambda i: F.length(text) >= size)
    return F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.substr(text, i, F.lit(size)))))


def lowest_within(left: DataFrame, right: DataFrame, group: str, value: str, payload: str, reach: int) -> DataFrame:
    """(group, value, lowest): for every group and whole-number value of the left side, the lowest payload of right rows whose value is at most ``reach`` away.

    Both sides are first reduced to one row a group and value. Values lie in blocks as wide as what is asked for, so that it begins in one block
    and ends in the same or the next: the lowest is that of a running minimum back from the end of the first block to where it begins and one from
    the start of the last block to where it ends. A running minimum costs a row once, a sliding one would cost it for every row in reach.
    """
    width = 2 * reach + 1
    lows = right.groupBy(group, value).agg(F.min(payload).alias("low")).select(group, F.col(value).alias("at"), "low", F.lit(None).cast(left.schema[value].dataType).alias(value), F.lit(0).alias("end"))
    asked = left.select(group, value).distinct().withColumn("end", F.explode(F.array(F.lit(-1), F.lit(1))))
    asked = asked.select(group, (F.col(value) + F.col("end") * reach).alias("at"), F.lit(None).cast(lows.schema["low"].dataType).alias("low"), value, "end")
    rows = lows.unionByName(asked).withColumn("block", F.floor(F.col("at") / width))
    block = Window.partitionBy(group, "block")
    running = lambda order: F.min("low").over(block.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    told = rows.withColumns({"up": running(F.asc("at")), "down": running(F.desc("at"))}).where("end <> 0")
    lowest = F.min(F.when(F.col("end") < 0, F.col("down")).otherwise(F.col("up"))).alias("lowest")
    return told.groupBy(group, value).agg(lowest).where("lowest is not null")


def best_match(candidates: DataFrame, left: str, score: Column, order: Column, least: int, *payload: str) -> DataFrame:
    """The best-scoring candidate of each left row, first in order among equals, if it reaches ``least``."""
    scored = candidates.withColumn("score", score).where(F.col("score") >= least)
    best = F.max_by(F.struct("score", *payload), F.struct(F.col("score"), order)).alias("best")
    return scored.groupBy(left).agg(best).select(left, "best.*")


def fallback_union(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """The primary rows, or the secondary ones where there is no primary row; decided in the plan, without a driver check."""
    none = primary.limit(1).agg(F.count("*").alias("__n")).where("__n = 0").select(F.lit(1).alias("__use"))
    return primary.unionByName(secondary.join(F.broadcast(none), how="left_semi", on=F.lit(True)))  # one row at most


def manifest_matches(documents: DataFrame, records: DataFrame) -> DataFrame:
    """(id, record) of documents (id, path, stem) and records (record, file, name) that have the path or its last part, or whose name the stem holds.

    Names are looked up in the distinct stems, and the pairs of texts are turned into ids last: very many documents of one stem and records of one
    name make that many rows of the result, but none that is shuffled. A path in common is a last part in common, and rows by name leave those out,
    so that nothing occurs twice unless an id does.
    """
    base = lambda c: F.regexp_extract(c, "([^/]*)$", 1)
    docs = documents.select("id", base("path").alias("base"), "stem").distinct()
    own = records.select("record", base("file").alias("file_base"), "name").distinct()
    named = docs.join(own, F.col("base") == F.col("file_base")).select("id", "record").distinct()
    stems, names = docs.select("stem").where("stem is not null").distinct(), own.select("name").where("name <> ''").distinct()
    held = contained_in(stems.withColumn("text", F.col("stem")), names.withColumn("passage", F.col("name")), "text", "passage", "stem", "name")
    met = docs.join(held, "stem").join(own, "name").where(~F.coalesce(F.col("base") == F.col("file_base"), F.lit(False))).select("id", "record")
    if any(not rows.groupBy(key).count().where("count > 1").isEmpty() for rows, key in ((docs, "id"), (own, "record"))):
        return named.union(met).distinct()
    return named.union(met)
