"""Native text expressions: normalisation, vocabularies, extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealspark.functions import vocab as V

#: Unicode white space, written out so that other engines can use the same class.
SPACE = r"[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
#: Markers of a missing value: fixed values of the record format.
PLACEHOLDERS = ("", "-", "无", "未知", "不详", "未披露", "n/a", "na", "none", "null")
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def bound(value: Column, made) -> Column:
    """What ``made`` makes of a value, which is evaluated once however often it is read."""
    return F.get(F.transform(F.array(value), made), F.lit(0))


def unescape(text: Column) -> Column:
    """The common HTML entities as characters."""
    for entity, character in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def collapse_space(text: Column) -> Column:
    """One blank for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def normalize_text(text: Column) -> Column:
    """Unescaped, white space collapsed, lower case; null becomes empty."""
    return F.lower(collapse_space(unescape(F.coalesce(text, F.lit("")))))


def compact_match_text(text: Column, first_cjk: str = r"\x{4e00}") -> Column:
    """Lower case with nothing but digits, Latin letters and CJK ideographs."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), rf"[^0-9a-z{first_cjk}-\x{{9fff}}]+", "")


def file_name(text: Column, limit: int = 80) -> Column:
    """A name that every file system takes; never empty."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r'[\\/:*?"<>|\r\n]+', "_")
    bare = F.substring(F.regexp_replace(F.regexp_replace(bare, r"^[ ._]+|[ ._]+$", ""), r"\s+", ""), 1, limit)
    return F.when(bare == "", "case_report").otherwise(bare)


def is_placeholder(text: Column, markers: Sequence[str] = PLACEHOLDERS) -> Column:
    return F.lower(F.trim(F.coalesce(text, F.lit("")))).isin(*markers)


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    found = F.lit(False)
    for term in terms:
        found = found | F.contains(text, F.lit(term))
    return found


def count_terms(text: Column, terms: Sequence[str]) -> Column:
    """How many of the terms occur at all."""
    return sum((F.contains(text, F.lit(t)).cast("int") for t in terms[1:]), F.contains(text, F.lit(terms[0])).cast("int"))


def normalize_party(name: Column, suffixes: Sequence[str], placeholders: Sequence[str] = PLACEHOLDERS) -> Column:
    """A party's name without bracketed remarks, legal forms and separators; empty if it says nothing."""
    bare = F.regexp_replace(F.coalesce(name, F.lit("")), r"[（(\[【][^）)\]】]*[）)\]】]", "")
    bare = F.regexp_replace(bare, "(?i)(" + "|".join(suffixes) + ")", "")
    bare = F.regexp_replace(F.lower(bare), V.SEPARATORS, "")
    return F.when(is_placeholder(bare, placeholders), "").otherwise(bare)


def sentences(text: Column, least: int = 12) -> Column:
    """Sentences of at least so many characters, in order."""
    parts = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?。！？；;])", "$1\n"), r"\n+")
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda s: F.length(s) >= least)


def numbers(text: Column) -> Column:
    """Plain numbers of a text as doubles, in order."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\d+(?:\.\d+)?)")), lambda x: x.cast("double"))


def redact(text: Column) -> Column:
    """E-mail addresses, tokens behind the word that announces them, long hexadecimal secrets and card-like numbers replaced by a mark.

    An address is tried only where a run of its characters begins, so that a long run without a sign costs its length once.
    """
    for pattern, mark in ((r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}", "[redacted]"), (r"(?i)(bearer\s+)[A-Za-z0-9._\-]+", "$1[redacted]"), (r"[0-9a-f]{32,}", "[redacted]"), (r"[0-9]{13,16}", "[redacted]")):
        text = F.regexp_replace(text, pattern, mark)
    return text


def safe_cell(text: Column) -> Column:
    """A leading apostrophe before what a spreadsheet would take for a formula."""
    return F.when(F.startswith(text, F.lit("=")), F.concat(F.lit("'"), text)).otherwise(text)
