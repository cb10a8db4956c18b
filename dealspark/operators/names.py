"""Many names in many texts: one automaton for all names, the longest match first, notes at first mentions.

The names go to a trie with failure links (Aho-Corasick), which every task builds once from a broadcast list. A text is read once whatever the number of names. Names of at
most ``WHOLE`` characters match whole words only, longer ones also inside words unless ``whole_words`` is set. Of
matches that overlap, the one that begins first counts, and of those the longest.

Defined cases: null texts and names, and empty names, match nothing; a name that is listed twice counts once, with its smallest note;
case counts unless the caller lowers both sides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from dealspark.session import ship_package

#: Names up to which a match must be a whole word; characters of all names up to which they are broadcast.
WHOLE, MOST_CHARACTERS = 4, 50_000_000


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


@lru_cache(maxsize=4)
def _automaton(names: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, name in enumerate(names):
        found.add_word(name, i)
    found.make_automaton()
    return found


def matches(names: tuple[str, ...], text: str, whole_words: bool = False) -> Iterator[tuple[int, int, int]]:
    """(start, end, place of the name) of matches that don't overlap, from left to right."""
    if not names or not text:
        return
    found = []
    for last, i in _automaton(names).iter(text):
        start, end = last + 1 - len(names[i]), last + 1
        if whole_words or len(names[i]) <= WHOLE:
            if start and _word(text[start]) and _word(text[start - 1]) or end < len(text) and _word(text[end - 1]) and _word(text[end]):
                continue
        found.append((start, -end, i))
    at = 0
    for start, end, i in sorted(found):
        if start >= at:
            yield start, -end, i
            at = -end


def annotated(names: tuple[str, ...], notes: tuple[str, ...], paragraphs: list[str | None], whole_words: bool = False) -> list[str | None]:
    """The paragraphs with each name's note behind its first mention, and without the notes that stood behind any mention."""
    seen: set[int] = set()
    out: list[str | None] = []
    for text in paragraphs:
        if text is None:
            out.append(None)
            continue
        parts, at = [], 0
        for start, end, i in matches(names, text, whole_words):
            if start < at:
                continue  # inside a note that is taken away
            parts.append(text[at:end])
            at = end
            while notes[i] and text.startswith(notes[i], at):
                at += len(notes[i])
            if i not in seen:
                seen.add(i)
                parts.append(notes[i])
        out.append("".join(parts) + text[at:])
    return out


class Names:
    """A list of names with their notes, of a checked size."""

    def __init__(self, names: DataFrame, name: str = "name", note: str | None = None):
        spark = names.sparkSession
        ship_package(spark)
        listed = names.where(F.col(name).isNotNull() & (F.col(name) != "")).groupBy(F.col(name).alias("name")).agg(F.coalesce(F.min(note), F.lit("")).alias("note") if note else F.lit("").alias("note"))
        size = listed.agg(F.coalesce(F.sum(F.length("name") + F.length("note")), F.lit(0))).first()[0]
        if size > MOST_CHARACTERS:
            raise ValueError(f"{size} characters of names: more than the {MOST_CHARACTERS} that are broadcast")
        rows = sorted(listed.collect())
        self._shared = spark.sparkContext.broadcast((tuple(r["name"] for r in rows), tuple(r["note"] for r in rows)))

    def mentions(self, paragraphs: Column, whole_words: bool = False) -> Column:
        """An array of (name, mentions, paragraph, place) for an array of paragraphs: how often, and where first (from 0)."""
        shared = self._shared
        kind = pa.list_(pa.struct([("name", pa.string()), ("mentions", pa.int64()), ("paragraph", pa.int32()), ("place", pa.int32())]))

        @arrow_udf("array<struct<name: string, mentions: bigint, paragraph: int, place: int>>")
        def found(texts: pa.Array) -> pa.Array:
            names, _ = shared.value
            out = []
            for row in texts:
                own: dict[int, dict] = {}
                for k, text in enumerate(row.as_py() or []):
                    for start, _, i in matches(names, text or "", whole_words):
                        own.setdefault(i, {"name": names[i], "mentions": 0, "paragraph": k, "place": start})["mentions"] += 1
                out.append(list(own.values()))
            return pa.array(out, type=kind)

        return found(paragraphs)

    def annotate(self, paragraphs: Column, whole_words: bool = False) -> Column:
        """The paragraphs with notes at first mentions; null stays null."""
        shared = self._shared

        @arrow_udf("array<string>")
        def noted(texts: pa.Array) -> pa.Array:
            names, notes = shared.value
            return pa.array([None if row.as_py() is None else annotated(names, notes, row.as_py(), whole_words) for row in texts], type=pa.list_(pa.string()))

        return noted(paragraphs)

    def any_of(self, text: Column) -> Column:
        """Whether a text holds any of the names (short ones as whole words): the keyword test of a priority."""
        return F.size(self.mentions(F.array(text))) > 0
