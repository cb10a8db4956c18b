"""Records of many shapes: JSON texts read by header name and alias into one schema, with defaults, a quarantine and a report of missing columns.

A text is an array of records, an object that holds such an array under one of some names, or a single record. Headers are compared
trimmed and in lower case. Nothing is lost: every record is either typed or in quarantine with all its reasons, and a text that is no JSON is one
record in quarantine. All of it is native: the records are maps from header to text until the fields are picked.

Defined cases: null or empty text holds no record; of several aliases of a field the first that isn't empty counts; null and blank
values are missing ones; headers that no field asks for are kept in ``rest``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names under which an object may hold its records.
LISTS = ("rows", "records", "cases", "files")


@dataclass(frozen=True)
class Field:
    """A column of the common schema: its kind, the headers that stand for it, and what stands for a missing value."""

    name: str
    kind: str = "string"
    aliases: tuple[str, ...] = ()
    required: bool = False
    default: Column | str | int | float | bool | None = None

    @property
    def headers(self) -> list[str]:
        return [h.strip().lower() for h in (self.name, *self.aliases)]

    def text(self) -> Column:
        """The first value that isn't blank."""
        return F.coalesce(*[F.nullif(F.trim(F.element_at("entries", h)), F.lit("")) for h in self.headers])

    def value(self) -> Column:
        text = self.text()
        if self.kind == "boolean":
            word = F.lower(text)
            return F.when(word.isin("true", "1", "yes", "y", "是"), True).when(word.isin("false", "0", "no", "n", "否"), False)
        if self.kind == "date":
            return F.coalesce(*[F.try_to_timestamp(F.substring(text, 1, 10), F.lit(p)).cast("date") for p in ("yyyy-MM-dd", "yyyy/MM/dd")])
        if self.kind in ("int", "long", "double"):
            return F.regexp_replace(text, ",", "").try_cast(self.kind)
        return text

    def reason(self) -> Column:
        """Why a record cannot be typed, else null."""
        out = F.when(self.text().isNotNull() & self.value().isNull(), F.lit(f"bad {self.name}"))
        return out.when(self.text().isNull(), F.lit(f"missing {self.name}")) if self.required else out


def split_records(texts: DataFrame, source: str, json: str, lists: Sequence[str] = LISTS) -> DataFrame:
    """source, place, raw and entries (header to value; null where the record is no object) for every record of every text."""
    text = F.trim(F.col(json))
    holder = F.from_json(text, "map<string,string>")
    held = F.coalesce(*[F.from_json(F.element_at(holder, name), "array<string>") for name in lists])
    parts = F.when(F.startswith(text, F.lit("[")), F.coalesce(F.from_json(text, "array<string>"), F.array(text)))
    parts = parts.when(held.isNotNull(), held).when(text != "", F.array(text)).otherwise(F.array().cast("array<string>"))
    rows = texts.select(F.col(source).alias("source"), F.posexplode(parts).alias("place", "raw"))
    entries = F.from_json("raw", "map<string,string>")
    # of headers that only differ in case or blanks the last one counts
    cleaned = F.map_from_entries(F.transform(F.array_distinct(F.transform(F.map_keys("entries"), lambda k: F.lower(F.trim(k)))), lambda k: F.struct(k, F.element_at(F.map_values(F.map_filter("entries", lambda h, _: F.lower(F.trim(h)) == k)), -1))))
    return rows.withColumn("entries", F.when(F.startswith("raw", F.lit("{")), entries)).withColumn("entries", cleaned)


class Shapes:
    """The common schema and what is done with records that don't fit it."""

    def __init__(self, fields: Sequence[Field]):
        self.fields = list(fields)

    def typed(self, records: DataFrame) -> DataFrame:
        """All records with their fields, the other headers (rest) and the reasons against them (an empty array for good ones)."""
        known = [h for f in self.fields for h in f.headers]
        reasons = F.when(F.col("entries").isNull(), F.array(F.lit("no object"))).otherwise(F.filter(F.array(*[f.reason() for f in self.fields]), lambda r: r.isNotNull()))
        rest = F.map_filter("entries", lambda h, _: ~h.isin(*known))
        values = [(f.value() if f.default is None else F.coalesce(f.value(), f.default if isinstance(f.default, Column) else F.lit(f.default))).alias(f.name) for f in self.fields]
        return records.select("source", "place", "raw", *values, rest.alias("rest"), reasons.alias("reasons"))

    def good(self, records: DataFrame) -> DataFrame:
        return self.typed(records).where("size(reasons) = 0").drop("raw", "reasons")

    def quarantine(self, records: DataFrame) -> DataFrame:
        return self.typed(records).where("size(reasons) > 0").select("source", "place", "raw", "reasons")

    def missing_columns(self, records: DataFrame) -> DataFrame:
        """(source, field): fields of which no record of a source has any header."""
        has = [F.max(F.coalesce(F.arrays_overlap(F.map_keys("entries"), F.array(*[F.lit(h) for h in f.headers])), F.lit(False))).alias(f.name) for f in self.fields]
        seen = records.groupBy("source").agg(*has)
        return seen.select("source", F.explode(F.filter(F.array(*[F.when(~F.col(f.name), F.lit(f.name)) for f in self.fields]), lambda x: x.isNotNull())).alias("field"))
