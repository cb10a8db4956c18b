"""Complete-or-fail paging: rules over a table of fetched pages, so that an incomplete range is never taken for a whole one.

A page is a row (range, page, asked_size, returned_page, returned_size, success, total, rows), where rows is an array of structs with
an art_code. Every rule is a condition on a page, on the pages of one range, or on its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The rules in the order in which a page is held against them.
RULES = ("rejected", "wrong_page", "total_changed", "too_many_pages", "incomplete", "missing_id", "repeated_page", "overlapping_rows", "bad_id", "missing_page")


def broken_pages(pages: DataFrame, max_pages: int = 200) -> DataFrame:
    """(range, page, rule) of every page that breaks a rule, with the first rule it breaks; an empty result means a whole range."""
    ids = F.transform("rows", lambda r: r["art_code"])
    by_range = Window.partitionBy("range")
    seen = pages.withColumns({"ids": ids, "first_total": F.min_by("total", "page").over(by_range), "needed": F.greatest(F.lit(1), F.ceil(F.col("total") / F.col("asked_size")))})
    same = seen.where("size(ids) > 0").groupBy("range", F.xxhash64("ids").alias("h"), "ids").agg(F.min("page").alias("first_page"))
    rows = seen.select("range", "page", F.posexplode("ids").alias("at", "id")).where("id is not null")
    first_row = rows.groupBy("range", "id").agg(F.min(F.struct("page", "at")).alias("first"))
    again = rows.join(first_row, ["range", "id"]).where(F.struct("page", "at") > F.col("first")).select("range", "page").distinct().withColumn("overlaps", F.lit(True))
    joined = seen.join(same.select("range", "ids", "first_page"), ["range", "ids"], "left").join(again, ["range", "page"], "left")
    expected = F.least("asked_size", F.greatest(F.lit(0), F.col("total") - (F.col("page") - 1) * F.col("asked_size")))
    broken = {
        "rejected": ~F.coalesce((F.col("success") == 1) & (F.col("total") >= 0) & F.col("rows").isNotNull(), F.lit(False)),
        "wrong_page": ~F.coalesce((F.col("returned_page") == F.col("page")) & (F.col("returned_size") == F.col("asked_size")), F.lit(False)),
        "total_changed": F.col("total") != F.col("first_total"),
        "too_many_pages": F.col("needed") > max_pages,
        "incomplete": F.size("rows") != expected,
        "missing_id": F.exists("ids", lambda x: x.isNull()),
        "repeated_page": F.col("page") > F.col("first_page"),
        "overlapping_rows": F.coalesce("overlaps", F.lit(False)),
        "bad_id": F.exists("ids", lambda x: ~F.rlike(x, F.lit("^AN[0-9]+$"))),
    }
    rule = F.coalesce(*[F.when(condition, name) for name, condition in broken.items()])
    found = joined.select("range", "page", rule.alias("rule")).where("rule is not null")
    ranges = seen.groupBy("range").agg(F.max("needed").alias("needed"), F.collect_set("page").alias("have")).where(F.col("needed") <= max_pages)
    missing = ranges.select("range", F.explode(F.array_except(F.sequence(F.lit(1).cast("long"), F.col("needed").cast("long")), F.transform("have", lambda p: p.cast("long")))).alias("page"))
    return found.select("range", F.col("page").cast("long").alias("page"), "rule").union(missing.select("range", "page", F.lit("missing_page")))


def collected(pages: DataFrame, max_pages: int = 200) -> DataFrame:
    """The rows (range, row) of the ranges that are whole; a range with a broken page gives none."""
    bad = broken_pages(pages, max_pages).select("range").distinct()
    return pages.join(bad, "range", "left_anti").select("range", F.explode("rows").alias("row"))
