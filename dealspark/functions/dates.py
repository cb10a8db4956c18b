"""Calendar windows from Friday 05:00 to Friday 05:00, and permissive time parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A Friday at 05:00 from which windows are counted.
ANCHOR = "2023-12-29 05:00:00"
_WEEK = 7 * 24 * 3600


def window_start(ts: Column) -> Column:
    """Start of the weekly window that holds a time without zone; a boundary belongs to the window it starts."""
    passed = F.floor(F.timestamp_diff("SECOND", F.lit(ANCHOR).cast("timestamp_ntz"), ts) / _WEEK)
    return F.timestamp_add("DAY", (passed * 7).cast("int"), F.lit(ANCHOR).cast("timestamp_ntz"))


def in_window(ts: Column, start: Column, end: Column) -> Column:
    """Closed at both ends; an unknown time is inside."""
    return ts.isNull() | ts.between(start, end)


def expected_windows(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(start, end) of all weekly windows from one Friday to another."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.date_sub(F.lit(last).cast("date"), 7), F.expr("interval 7 days"))).alias("day"))
    days = days.select(F.assert_true(F.dayofweek("day") == 6, "windows start on Fridays").alias("ok"), "day").where("ok is null")
    at = lambda c: F.concat(c.cast("string"), F.lit(" 05:00:00")).cast("timestamp_ntz")
    return days.select(at(F.col("day")).alias("start"), at(F.date_add("day", 7)).alias("end"))


def is_weekly_window(start: Column, end: Column) -> Column:
    """Whether two dates are Fridays a week apart."""
    return (F.dayofweek(start) == 6) & (F.dayofweek(end) == 6) & (F.datediff(end, start) == 7)


def window_name(start: Column | str, end: Column | str) -> Column:
    """The name of a window's partition."""
    return F.concat_ws("_", F.date_format(start, "yyyyMMdd"), F.date_format(end, "yyyyMMdd"))


def parse_time(text: Column) -> Column:
    """ISO, slash, dot and Chinese dates with or without a clock; RFC 2822 with a numeric or named zone; else null."""
    bare = F.trim(F.coalesce(text, F.lit("")))
    rfc = F.regexp_replace(F.regexp_replace(bare, r"^[A-Za-z]{3},\s*", ""), r"\s+(?:GMT|UTC|UT|Z)$", " +0000")
    cjk = F.regexp_replace(F.regexp_replace(bare, "[年月]", "-"), "日", "")
    formats = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "yyyy.MM.dd", "yyyyMMdd", "yyyy-M-d")
    return F.coalesce(F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss Z")), *[F.try_to_timestamp(cjk, F.lit(f)) for f in formats])


def parse_relative(text: Column, now: Column) -> Column:
    """'3 hours ago' and its Chinese forms, counted back from ``now``; else as parse_time."""
    amount = F.regexp_extract(text, r"(\d+)\s*(?:分钟|小时|天|周|minutes?|hours?|days?|weeks?)", 1)
    unit = F.regexp_extract(text, r"\d+\s*(分钟|小时|天|周|minute|hour|day|week)", 1)
    seconds = F.when(unit.isin("分钟", "minute"), 60).when(unit.isin("小时", "hour"), 3600).when(unit.isin("天", "day"), 86400).otherwise(_WEEK)
    back = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.try_to_number(amount, F.lit("999999")).cast("long") * seconds).cast("decimal(18,6)"))
    return F.when(F.rlike(text, F.lit(r"(?i)\d+\s*(分钟|小时|天|周)前|\d+\s*(minute|hour|day|week)s?\s+ago")), now - back).otherwise(parse_time(text))
