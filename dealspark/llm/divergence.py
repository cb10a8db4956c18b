"""Audit of how sources of one language differ in their words, with deduplicated count columns.

The count column of a term is its sparse vector of (source, count). Terms of a language with identical vectors form one class, as all
figures of a term follow from its vector. Every pair of sources is evaluated once for each distinct vector that holds both, times
the number of its terms, inside the tasks; what a vector adds to pairs of which it holds one source follows from the
number of terms of each count, what it adds to pairs without it from the number of terms. The result equals the sum over all terms, since
every step is whole-number arithmetic. Terms are ranked by the values of their vectors; original terms come back
only for the vectors that reach the first ranks of a source.

Defined cases: null text, lang and source are read as empty ones; every occurring (lang, source) has its pairs, also without terms; a
language without kept terms has pair values of 0 and no term rows; texts without terms and texts of any length are handled; each row is a document, repeated rows too; ties are
ranked by the item's bytes; other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealspark.llm import kernels as K
from dealspark.session import Scratch

#: Documents a term needs in its language; ranks of terms that are reported; the unit of a share.
LEAST_DOCS, RANKS, UNIT = 3, 200, 1_000_000_000
#: Rows of counts that a task gathers before it merges them, and pairs that it evaluates at once.
GATHERED, PAIRS_AT_ONCE = 1_000_000, 1_000_000

#: Bytes of a term, A-Z lower-cased; all others part terms.
_TERM = np.full(256, 0x20, np.uint8)
_TERM[0x61:0x7B] = np.arange(0x61, 0x7B)
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)
_TERM[0x80:] = np.arange(0x80, 0x100)


def _batch_counts(b: pa.RecordBatch) -> Iterator[pa.Table]:
    """lang, source, term, count and docs of the rows (lang, source, text) of a batch."""
    groups = pa.StructArray.from_arrays([b.column(0), b.column(1)], names=["lang", "source"])
    names = list(dict.fromkeys(zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
    place = {g: k for k, g in enumerate(names)}
    group = np.array([place[g["lang"], g["source"]] for g in groups.to_pylist()], np.int64)
    langs, sources = (pa.array(list(c), pa.string()) for c in zip(*names))
    raw, at = K.text_bytes(b.column(2))
    for i, _, part, offsets in K.slices(raw, at):
        part = _TERM[part]
        starts, ends, rows = K.word_spans(part, offsets)
        if not len(starts):
            continue
        bounds = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=bounds[1:])
        terms = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(part[part != 0x20].tobytes())).dictionary_encode()
        many = len(terms.dictionary)
        each, count = np.unique(rows * many + terms.indices.to_numpy(), return_counts=True)  # of each term in each row
        key, inverse = np.unique(group[i + each // many] * many + each % many, return_inverse=True)
        total, docs = np.zeros(len(key), np.int64), np.bincount(inverse, minlength=len(key))
        np.add.at(total, inverse, count)
        own = pa.array(key // many)
        yield pa.table({"lang": langs.take(own), "source": sources.take(own), "term": terms.dictionary.take(pa.array(key % many)), "count": total, "docs": docs})


def _merged(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("count", "sum"), ("docs", "sum")])
    return out.select(["lang", "source", "term", "count_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "count", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences and documents of every term in every (lang, source)."""
    K.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for b in batches:
            if b.num_rows:
                held += _batch_counts(b)
            if sum(t.num_rows for t in held) > GATHERED:
                held = [_merged(held)]
                if held[0].num_rows > GATHERED // 2:
                    yield from held.pop().to_batches(max_chunksize=100_000)
        if held:
            yield from _merged(held).to_batches(max_chunksize=100_000)

    rows = docs.select(*(F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = rows.mapInArrow(run, "lang string, source string, term string, count long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: str, size: str) -> Column:
    """1 + floor(UNIT * (count + 1) / size), exact also where the product is beyond 64 bits."""
    return F.expr(f"1 + (cast({count} + 1 as decimal(20, 0)) * {UNIT}) div cast({size} as decimal(20, 0))")


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _cross_terms(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """(lang, source, other, value) sums over pairs of entries of each vector: the value of the pair less what its sides are counted for apart.

    The columns are lang, number of terms, and for each entry the place of its source, its share and the share of no occurrence.
    """
    arrays = [b.column(i).combine_chunks() if isinstance(b.column(i), pa.ChunkedArray) else b.column(i) for i in (2, 3, 4)]
    source, p, zero = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in arrays)
    sizes = np.diff(arrays[0].offsets.to_numpy()).astype(np.int64)
    ends = np.cumsum(sizes)
    vector = np.repeat(np.arange(len(sizes)), sizes)
    terms = b.column(1).to_numpy(zero_copy_only=False)
    langs = b.column(0).dictionary_encode()
    lang, most = langs.indices.to_numpy().astype(np.int64), int(source.max(initial=0)) + 1
    partners = np.cumsum(sizes[vector])
    i = 0
    while i < len(vector):  # so many entries at a time that their pairs fit
        done = partners[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(partners, done + PAIRS_AT_ONCE, side="right")))
        many = sizes[vector[i:j]]
        a = np.repeat(np.arange(i, j), many)
        other = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + (ends - sizes)[vector[a]]
        a, other = a[a != other], other[a != other]
        f = lambda x, y: (x - y) * (x - y) // y
        value = terms[vector[a]] * (f(p[a], p[other]) - f(p[a], zero[other]) - f(zero[a], p[other]) + f(zero[a], zero[other]))
        key, inverse = np.unique((lang[vector[a]] * most + source[a]) * most + source[other], return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, inverse, value)
        yield langs.dictionary.take(pa.array(key // (most * most))), key // most % most, key % most, total
        i = j


def _pair_sums(vectors: DataFrame) -> DataFrame:
    """Sums of ``_cross_terms`` by lang, source and other source; ``vectors`` has lang, terms, places, shares, zeros."""
    K.prepare(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for b in batches:
            held += [pa.table({"lang": c[0], "a": c[1], "b": c[2], "value": c[3]}) for c in _cross_terms(b)]
            if sum(t.num_rows for t in held) > GATHERED:
                held = [summed(held)]
                if held[0].num_rows > GATHERED // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from summed(held).to_batches()

    def summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by(["lang", "a", "b"], use_threads=False).aggregate([("value", "sum")]).rename_columns(["lang", "a", "b", "value"])

    parts = vectors.select("lang", "terms", "places", "shares", "zeros").mapInArrow(run, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("both"))


class Audit:
    """Kept terms by vector, and sizes of all groups."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS):
        self.scratch = Scratch(docs.sparkSession)
        column = F.sort_array(F.collect_list(F.struct("source", "count"))).alias("vector")  # an entry for each source of the language at most
        kept = term_counts(docs).groupBy("lang", "term").agg(column, F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
        self.terms = self.scratch.stored(kept.select("lang", "term", "vector"))
        self.vectors = self.scratch.stored(self.terms.groupBy("lang", "vector").agg(F.count("*").alias("terms")))
        entries = self.vectors.select("lang", "terms", F.inline("vector"))
        sums = entries.groupBy("lang", "source").agg(F.sum(F.col("terms") * F.col("count")).alias("n"))
        kept_of = self.vectors.groupBy("lang").agg(F.sum("terms").alias("v"))
        occurring = docs.select(*(F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
        groups = occurring.join(sums, ["lang", "source"], "left").join(kept_of, "lang", "left").fillna(0, ["n", "v"])
        groups = groups.withColumn("size", F.col("n") + F.col("v")).withColumn("zero", F.when(F.col("v") > 0, share("0", "size")).otherwise(1))
        place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")  # one row for each source
        self.groups = self.scratch.stored(groups.withColumn("place", place))

    def _with_sizes(self) -> DataFrame:
        """Vectors with an array of their sources' places, shares and shares of no occurrence."""
        sizes = self.groups.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("source", F.struct("place", "size", "zero")))).alias("sizes"), F.sum("n").alias("lang_n"), F.first("v").alias("lang_v"))
        placed = self.vectors.join(sizes, "lang")
        shares = F.expr(f"transform(vector, e -> 1 + (cast(e.count + 1 as decimal(20, 0)) * {UNIT}) div cast(sizes[e.source].size as decimal(20, 0)))")
        return placed.select("lang", "vector", "terms", shares.alias("shares"), F.expr("transform(vector, e -> sizes[e.source].place)").alias("places"), F.expr("transform(vector, e -> sizes[e.source].zero)").alias("zeros"), (F.col("lang_n") + F.col("lang_v")).alias("lang_size"))

    def _one_sided(self, swapped: bool) -> DataFrame:
        """lang, place and each occurring share of no occurrence there: what the terms of a source add to its pairs with a source that lacks them."""
        counts = self.vectors.select("lang", "terms", F.inline("vector")).groupBy("lang", "source", "count").agg(F.sum("terms").alias("terms"))
        own = counts.join(self.groups.select("lang", "source", "size", "zero", "place"), ["lang", "source"]).withColumn("p", share("count", "size"))
        others = self.groups.select("lang", F.col("zero").alias("other_zero")).distinct()
        met = own.join(others, "lang")
        p, zero, other = F.col("p"), F.col("zero"), F.col("other_zero")
        more = _excess(other, p) - _excess(other, zero) if swapped else _excess(p, other) - _excess(zero, other)
        return met.groupBy("lang", "place", "other_zero").agg(F.sum(F.col("terms") * more).alias("value"))

    def pairs(self) -> DataFrame:
        """lang, source, item (the other source), value: for every ordered pair of a language's sources."""
        left = self.groups.select("lang", "source", F.col("place").alias("a"), F.col("zero").alias("za"), "v")
        right = self.groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"), F.col("zero").alias("zb"))
        first = self._one_sided(False).select("lang", F.col("place").alias("a"), F.col("other_zero").alias("zb"), F.col("value").alias("first"))
        second = self._one_sided(True).select("lang", F.col("place").alias("b"), F.col("other_zero").alias("za"), F.col("value").alias("second"))
        out = left.join(right, "lang").where("a <> b").join(_pair_sums(self._with_sizes()), ["lang", "a", "b"], "left").join(first, ["lang", "a", "zb"], "left").join(second, ["lang", "b", "za"], "left")
        value = F.col("v") * _excess(F.col("za"), F.col("zb")) + sum((F.coalesce(F.col(c), F.lit(0)) for c in ("both", "first", "second")), F.lit(0))
        return out.select("lang", "source", "item", F.when(F.col("v") > 0, value).otherwise(0).cast("long").alias("value"))

    def leading_terms(self, ranks: int = RANKS) -> DataFrame:
        """lang, source, item (a term more frequent there than in the language), value: the first ranks of each source."""
        whole = self._with_sizes().withColumn("all", F.aggregate("vector", F.lit(0).cast("long"), lambda s, e: s + e["count"])).withColumn("q", share("all", "lang_size"))
        rows = whole.select("lang", "vector", "q", F.inline(F.arrays_zip(F.col("vector.source").alias("source"), F.col("shares").alias("p"))).alias("source", "p"))
        valued = rows.where("p > q").select("lang", "vector", "source", _excess(F.col("p"), F.col("q")).alias("value"))
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
        high = valued.withColumn("place", F.rank().over(order)).where(F.col("place") <= ranks).drop("place")
        named = self.terms.join(high, ["lang", "vector"])
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
        return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks).select("lang", "source", F.col("term").alias("item"), "value", "rank")


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank in each group and part."""
    audit = Audit(docs, least_docs)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = audit.pairs().withColumn("rank", F.row_number().over(order))
    terms = audit.leading_terms(ranks)
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select("lang", "source", "part", "item", "value", "rank")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(K.documents(spark, sf_dir))


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS lang_count FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 3
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(lang_count)::HUGEINT AS n FROM kept GROUP BY lang
), counted AS (
  SELECT w.lang, source, w.term, count(*)::HUGEINT AS c FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY w.lang, source, w.term
), sums AS (
  SELECT lang, source, sum(c)::HUGEINT AS n FROM counted GROUP BY lang, source
), groups AS (
  SELECT d.lang, d.source, coalesce(s.n, 0)::HUGEINT AS n, coalesce(l.v, 0)::HUGEINT AS v
  FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN sums s ON d.lang = s.lang AND d.source = s.source LEFT JOIN langs l ON d.lang = l.lang
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (g.n + g.v) AS p,
    1 + (1000000000::HUGEINT * (k.lang_count + 1)) // (l.n + l.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::HUGEINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM shares WHERE c > 0 AND p > q
)
SELECT * FROM (
  SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
) WHERE part = 'pair' OR rank <= 200
"""
