"""Fact packs: what the research rows of a case say about its value, motives, time and numbers, with their sources.

A research row has case_id, place (its position), title, source_name, url, summary, numeric_facts and extracted_text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from dealspark.functions import cjk as C
from dealspark.functions import signals as S
from dealspark.functions import text as T
from dealspark.functions import vocab as V
from dealspark.functions.terms import BLANKS
from dealspark.session import ship_package, small_batches, task_count

_PARTS = ("numeric_facts", "summary", "extracted_text")
#: Research rows of a case that its fact pack reads, as fixed by the report's own limit on evidence.
EVIDENCE_ROWS = 56


def _first_rows(rows: DataFrame, limit: int, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first rows of each group; tasks cut their own rows before the shuffle, so that a case of very many rows is never gathered."""
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return rows.withColumn("__at", place).where(F.col("__at") <= limit).drop("__at")


def clean_list(values: Column, limit: int, width: int = 260) -> Column:
    """The first distinct values with white space collapsed, cut to a width after they were told apart."""
    tidy = F.filter(F.transform(values, S.clean), lambda x: x != "")
    return F.transform(F.slice(F.array_distinct(tidy), 1, limit), lambda x: F.substring(x, 1, width))


def fact_lines(values: Column, limit: int = 10) -> Column:
    """Distinct lines of at least 20 characters that hold a figure or a word of a deal, at most 180 characters each."""
    parts = F.flatten(F.transform(values, lambda v: F.split(F.coalesce(v, F.lit("")), "[\n。；;]")))
    long = F.filter(parts, lambda p: F.length(p) > 15)  # 15 digits and their commas are 19 characters at most
    tidy = F.transform(long, lambda p: C.normalize(F.regexp_replace(p, r"^[ \-•\t]+|[ \-•\t]+$", "")))
    told = F.filter(tidy, lambda p: (F.length(p) >= 20) & S.matches(p, "[0-9]|" + S.words_pattern(V.FACT_TOKENS)))
    return F.transform(F.slice(F.array_distinct(told), 1, limit), lambda x: F.substring(x, 1, 180))


def candidate_sentences(text: Column, limit: int = 120) -> Column:
    """Blocks of four, three and two lines of 20 to 420 characters, then sentences of at least 12, distinct and at most 320 characters each."""
    raw = F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n|\r", "\n")
    lines = F.filter(F.transform(F.split(raw, "\n"), S.clean), lambda x: F.length(x) >= 6)

    def blocks(rows: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(rows), F.lit(1)))
        sized = F.flatten(F.transform(places, lambda i: F.array(*[F.when(i + n - 1 <= F.size(rows), F.array_join(F.slice(rows, i, F.lit(n)), " ")) for n in (4, 3, 2)])))
        return F.transform(F.filter(sized, lambda b: b.isNotNull() & F.length(b).between(20, 420)), lambda b: F.btrim(b, F.lit(" -•\t")))  # clean lines make clean blocks

    parts = F.transform(F.split(raw, r"(?<=[。！？；;.!?])\s*|\n+"), lambda p: S.clean(F.regexp_replace(p, r"^[ \-•\t]+|[ \-•\t]+$", "")))
    tidy = F.filter(F.concat(F.flatten(F.transform(F.array(lines), blocks)), parts), lambda x: F.length(x) >= 12)
    return F.transform(F.slice(F.array_distinct(tidy), 1, limit), lambda x: F.substring(x, 1, 320))


_DIGIT, _BLANKS = re.compile("[0-9]"), re.compile(f"[{BLANKS}]+")
_QUANTITY = re.compile(V.TRANSACTION_QUANTITY, re.ASCII)


def states_value(sentence: str) -> bool:
    """A quantity of the transaction in what is neither long nor boilerplate: ``has_quantity`` and not ``is_noisy_value`` on a sentence that isn't blank."""
    bare = _BLANKS.sub(" ", sentence).strip(" ")
    return _QUANTITY.search(sentence) is not None and len(bare) <= 420 and not any(w in bare for w in V.NOISY_VALUE)


def _best(sentences: Sequence[str | None] | None, hints: Sequence[str], numbered: bool, fits: Callable[[str], bool] | None) -> str:
    best, most = "", None
    for s in sentences or ():
        if not s or numbered and not _DIGIT.search(s):
            continue
        low = s.lower()
        found = sum([h in low for h in hints])
        if found:
            has = lambda words: any(w in s for w in words)  # noqa: B023, E731
            points = found * 4 + 3 * has(V.SENTENCE_UNITS) + 8 * has(V.SENTENCE_PRICES) + 2 * has(V.SENTENCE_DEALS) - 8 * has(V.SENTENCE_NOISE)
            if (most is None or points > most) and (fits is None or fits(s)):
                best, most = s, points
    return best


def best_hint(sentences: Column, hints: Sequence[str], numbered: bool = True, fits: Callable[[str], bool] | None = None) -> Column:
    """The first of the sentences (those that fit) with most points for hints, units, prices and deal words, less boilerplate; empty without a hint.

    A case has many sentences, each searched for some forty words: in Arrow batches that costs a fraction of what nested expressions do.
    """
    ship_package(SparkSession.active())
    small_batches(SparkSession.active())
    low = [h.lower() for h in hints]

    @arrow_udf("string")
    def best(rows: pa.Array) -> pa.Array:
        return pa.array([_best(row.as_py(), low, numbered, fits) for row in rows], pa.string())

    return best(sentences)


def angles(text: Column) -> Column:
    """Angles of analysis that the words of a text ask for, and the common one if there is any; six at most."""
    found = F.filter(F.array(*[F.when(S.has_any(text, words), F.lit(angle)) for words, angle in V.ANGLES]), lambda x: x.isNotNull())
    return F.slice(F.when(F.size(found) > 0, F.concat(found, F.array(F.lit(V.COMMON_ANGLE)))).otherwise(found), 1, 6)


def row_summary(title: Column, source_name: Column, summary: Column, url: Column) -> Column:
    head = S.or_else(title, F.coalesce(source_name, F.lit("")))
    text = F.when(F.coalesce(summary, F.lit("")) != "", F.concat(head, F.lit("："), summary)).otherwise(head)
    return F.substring(S.clean(F.when(F.coalesce(url, F.lit("")) != "", F.concat(text, F.lit("（来源："), url, F.lit("）"))).otherwise(text)), 1, 360)


def source_hierarchy(research: DataFrame, limit: int = 10) -> DataFrame:
    """For each case: official facts, other reports, and those of both that can carry an inference, in order and capped."""
    told = S.or_else(F.col("numeric_facts"), S.or_else(F.col("summary"), F.coalesce("extracted_text", F.lit(""))))
    rows = research.select("case_id", "place", S.is_primary_source(F.col("url")).alias("official"), S.is_media(F.col("url"), F.col("source_name")).alias("media"), row_summary(F.col("title"), F.col("source_name"), told, F.col("url")).alias("text")).where("text <> ''")
    counts = rows.groupBy("case_id").agg(F.count_if("official").alias("n_official"), F.count_if("media").alias("n_media"))
    first = _first_rows(rows.select("case_id", "place", "official", "text"), max(limit, 4), ("case_id", "official"), ("place", "text"))
    lists = first.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("place", "official", "text"))).alias("m"))
    lists = lists.join(counts.withColumnRenamed("case_id", "__case"), F.col("case_id").eqNullSafe(F.col("__case"))).drop("__case")
    pick = lambda official, n: F.slice(F.transform(F.filter("m", lambda x: x["official"] == official), lambda x: x["text"]), 1, n)
    basis = F.slice(F.filter(F.concat(pick(True, limit), pick(False, 4)), lambda t: S.has_any(t, V.BASIS_WORDS)), 1, limit)
    return lists.select("case_id", pick(True, limit).alias("official_facts"), pick(False, limit).alias("media_reports"), basis.alias("inference_basis"), "n_official", "n_media")


def fact_packs(cases: DataFrame, research: DataFrame, evidence: int = EVIDENCE_ROWS) -> DataFrame:
    """One fact pack a case (id, case_name, category, acquirer, target, deal_value, deal_status, buyer_motive, seller_motive, why, title, highlights) with its issues.

    Missing or noisy values fall back on the best sentence of the research rows; a price a share that these name replaces one that
    the value has. Lists keep their order, are distinct and capped. A case's evidence is its first rows by place, as many as
    ``evidence`` says. Cases without rows have empty lists.
    """
    ref = F.concat(F.when(F.col("official"), "[official] ").otherwise("[supplement] "), S.or_else(F.col("title"), S.or_else(F.col("source_name"), F.lit("source"))), F.lit(" | "), F.coalesce("source_name", F.lit("")), F.lit(" | "), F.coalesce("url", F.lit("")))
    ref = F.when((F.coalesce("url", F.lit("")) != "") | (F.coalesce("source_name", F.lit("")) != ""), F.substring(ref, 1, 320))
    row = F.struct("place", *[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in (*_PARTS, "title")], S.or_else(F.col("title"), F.coalesce("source_name", F.lit(""))).alias("named"), ref.alias("ref"))
    research = _first_rows(research.select("case_id", "place", "title", "source_name", "url", *_PARTS), evidence, ("case_id",), ("place", *_PARTS, "title", "source_name", "url"))
    research = research.withColumn("official", S.is_primary_source(F.col("url"))).repartition(task_count(cases), "case_id")  # by cases: what is read from their texts costs far more than the texts' bytes tell
    rows = research.groupBy("case_id").agg(F.array_sort(F.collect_list(row)).alias("m"), F.count_if("official").alias("authoritative"))
    joined = cases.join(rows.withColumnRenamed("case_id", "id"), "id", "left").withColumns({"m": F.coalesce("m", F.array().cast(rows.schema["m"].dataType)), "authoritative": F.coalesce("authoritative", F.lit(0))})
    texts = lambda *names: F.filter(F.flatten(F.transform("m", lambda x: F.array(*[x[n] for n in names]))), lambda v: v != "")
    blob = F.array_join(texts(*_PARTS, "title"), "\n")
    facts = joined.withColumns({"facts": fact_lines(texts(*_PARTS), 14), "blob": F.substring(blob, 1, 60_000)})
    facts = facts.withColumns({
        "sentences": F.concat(candidate_sentences(F.substring("blob", 1, 30_000)), F.col("facts")), "price": F.get(S.share_prices(F.col("blob")), F.lit(0)), "share_count": F.get(S.share_counts(F.col("blob")), F.lit(0)),
    })
    current = F.col("deal_value")
    usable = ~S.is_noisy_value(current) & ~S.clean(current).isin("", "-", "未披露", "公开资料未披露", "未知", "不详", "无") & S.has_payment(current)
    good = lambda c: F.when(~S.is_weak_disclosure(F.col(c)) & (F.length(S.clean(F.col(c))) >= 15), S.clean(F.col(c)))
    facts = facts.withColumns({"told_value": F.when(usable, current), "told_buyer": F.coalesce(*[good(c) for c in ("buyer_motive", "why", "title")]), "told_seller": good("seller_motive")})
    left = lambda c: F.when(F.col(c).isNull(), F.col("sentences"))
    facts = facts.withColumns({  # sentences are read where nothing usable is told
        "stated": F.coalesce("told_value", best_hint(left("told_value"), V.VALUE_HINTS, fits=states_value)), "buyer": F.coalesce("told_buyer", best_hint(left("told_buyer"), V.BUYER_HINTS, False)),
        "seller": F.coalesce("told_seller", best_hint(left("told_seller"), V.SELLER_HINTS, False)),
    })
    facts = facts.withColumn("value", S.verified_value(F.col("stated"), F.col("price"), F.col("share_count")))
    with_any = lambda words: F.filter("facts", lambda x: S.has_any(x, words))
    numbers = F.filter("facts", lambda x: S.matches(x, "[0-9]|" + S.words_pattern(V.NUMBER_TOKENS)))
    packs = facts.select(
        "id", "case_name", "acquirer", "target", "deal_status", "highlights", F.col("value").alias("deal_value"), C.normalize(F.col("buyer")).alias("buyer_reason"), C.normalize(F.col("seller")).alias("seller_reason"), clean_list(with_any(V.TIMELINE_TOKENS), 8).alias("timeline"),
        clean_list(numbers, 12).alias("key_numbers"), clean_list(F.transform("m", lambda x: x["named"]), 12).alias("source_titles"), clean_list(F.transform("m", lambda x: x["ref"]), 14).alias("source_refs"), "authoritative",
        angles(F.concat_ws("\n", "category", "case_name", "why", F.array_join("facts", "\n"))).alias("angles"),
    )
    from dealspark.operators.expectations import issues

    return packs.withColumn("issues", issues(pack_rules()))


def pack_rules() -> list[tuple[str, Column]]:
    """What a fact pack lacks."""
    empty = lambda c: F.length(F.coalesce(c, F.lit(""))) < 15
    value, context = F.col("deal_value"), F.concat_ws(" ", "deal_value", "deal_status", F.array_join("timeline", " "), "highlights")
    return [
        ("acquirer", F.coalesce("acquirer", F.lit("")).isin("", "收购方", "公开披露的买方")), ("target", F.coalesce("target", F.lit("")).isin("", "标的", "公开披露的标的")),
        ("value", S.is_noisy_value(value) | F.contains(value, F.lit("未披露")) & ~S.has_payment(value)), ("timeline", (F.size("timeline") < 1) & ~S.has_any(F.col("deal_status"), ("2023", "2024", "2025", "2026", "完成", "交割", "签署", "公告"))),
        ("buyer_reason", empty(F.col("buyer_reason"))), ("seller_reason", empty(F.col("seller_reason"))), ("numbers", (F.size("key_numbers") < 3) & ~S.matches(context, "[0-9]")), ("authoritative", F.col("authoritative") < 1),
    ]
