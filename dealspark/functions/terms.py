"""Sizes of texts and counts of the words of many groups that they hold, by Arrow batches.

All texts of a batch are one array of characters. A pair of characters that begins a word is found by one lookup for each place, so the
time is linear in the texts' length however many words there are; words with the same beginning are told apart where it stands.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql.functions import arrow_udf

from dealspark.session import ship_package, small_batches

#: White space as in ``text.SPACE``.
BLANKS = "\t\n\x0b\f\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


class Words:
    """Groups of words, each word of two characters or more, as a table of their characters and one of their first pairs."""

    def __init__(self, groups: Sequence[Sequence[str]]):
        self.words = sorted({w for g in groups for w in g})
        if any(len(w) < 2 or "\0" in w for w in self.words):
            raise ValueError("words have two characters at least")
        self.member = np.array([[w in g for g in map(frozenset, groups)] for w in self.words], np.int32).reshape(len(self.words), len(groups))
        signs = sorted({c for w in self.words for c in w})
        self.width = len(signs) + 1
        self.code = np.zeros(0x110000, np.int32)
        self.code[[ord(c) for c in signs]] = range(1, self.width)
        self.starts: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, w in enumerate(self.words):
            codes = self.code[[ord(c) for c in w]]
            self.starts.setdefault(int(codes[0]) * self.width + int(codes[1]), []).append((i, codes[2:]))
        self.begins = np.zeros(self.width**2, bool)
        self.begins[list(self.starts)] = True
        self.reach = max(map(len, self.words), default=2)
        self.blank, self.digit = np.zeros((2, 0x110000), bool)
        self.blank[[ord(c) for c in BLANKS]] = True
        self.digit[ord("0") : ord("9") + 1] = True

    def measures(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """For each text: characters that aren't white space, digits, and for each group how many of its words occur at all."""
        texts = [t or "" for t in texts]
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths + 1)  # texts are parted by a sign that no word has
        signs = np.frombuffer(("\0".join(texts) + "\0" * (self.reach + 1)).encode("utf-32-le", "surrogatepass"), np.uint32)
        count = lambda marks: np.bincount(np.searchsorted(ends, np.flatnonzero(marks), "right"), minlength=len(texts))[: len(texts)]
        out = [lengths - count(self.blank[signs]), count(self.digit[signs])]
        if not self.words:
            return out
        codes = self.code[signs]
        pairs = codes[:-1] * self.width + codes[1:]
        at = np.flatnonzero(self.begins[pairs])
        at = at[np.argsort(pairs[at], kind="stable")]
        held = np.zeros((len(texts), len(self.words)), np.int32)
        bounds = np.flatnonzero(np.diff(pairs[at])) + 1
        for same in np.split(at, bounds) if len(at) else ():
            for i, rest in self.starts[int(pairs[same[0]])]:
                fits = same
                for k, c in enumerate(rest, 2):
                    fits = fits[codes[fits + k] == c]
                held[np.searchsorted(ends, fits, "right"), i] = 1
        return [*out, *(held @ self.member).T]


@cache
def _words(groups: tuple[tuple[str, ...], ...]) -> Words:
    """The tables of the groups, made once a Python process."""
    return Words(groups)


def measured(text: Column, groups: Mapping[str, Sequence[str]] | None = None) -> Column:
    """A struct of a text's size without white space, its digits, and how many words of each group occur in it; null reads like an empty text."""
    ship_package(SparkSession.active())
    small_batches(SparkSession.active())
    names, listed = ["size", "digits", *(groups or {})], tuple(map(tuple, (groups or {}).values()))

    @arrow_udf(f"struct<{','.join(f'{n}:int' for n in names)}>")
    def measure(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(m.astype(np.int32)) for m in _words(listed).measures(texts.to_pylist())], names)

    return measure(text)
