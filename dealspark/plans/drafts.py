"""Queries on drafts of articles: answers of a model, lengths, repairs, versions."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.catalogue import query
from dealspark.functions import text as T
from dealspark.functions import vocab as V
from dealspark.operators import answers, articles, lengths, repairs
from dealspark.plans.deals import _any, _q
from dealspark.plans.filings import filings, filings_sql
from dealspark.session import table

_MOST = articles.MOST


def _drafts(spark: SparkSession, d: str) -> DataFrame:
    """Documents as articles: the first line is the intro, every five further ones are a section."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("title"), F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    n = F.ceil((F.size("lines") - 1) / 5).cast("int")
    section = lambda k: F.struct(F.concat(F.lit("Part "), k.cast("string")).alias("heading"), F.slice("lines", k * 5 - 3, F.lit(5)).alias("paragraphs"))
    sections = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), section)).otherwise(F.array().cast(lengths.SECTIONS))
    return docs.select("doc_id", "title", F.get("lines", F.lit(0)).alias("intro"), sections.alias("sections"))


def _size(column: str) -> str:
    return f"length(regexp_replace({column}, {_q(T.SPACE)}, '', 'g'))"


_LINES = f"""(SELECT doc_id, {_size("coalesce(source, '')")} AS head, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)"""
#: Each piece of a draft, with the room for text in the whole draft: (doc_id, i, part, parts, line, room, whole).
_PIECES = f"""(SELECT doc_id, i, CASE WHEN i = 1 THEN -1 ELSE (i - 2) // 5 END AS part, (i - 2) % 5 AS para, CAST(ceil((n - 1) / 5.0) AS INT) AS parts, line, room, n_text <= room AS whole FROM (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i, len(lines) AS n, {_size("array_to_string(lines, '')")} AS n_text,
    {_MOST} - head - CAST(coalesce(list_sum(list_transform(generate_series(1, CAST(ceil((len(lines) - 1) / 5.0) AS INT)), lambda k: 4 + length(CAST(k AS VARCHAR)))), 0) AS INT) AS room
    FROM (SELECT doc_id, head, lines FROM {_LINES})))"""
_ENDS = "string_split(regexp_replace(regexp_replace(line, '([。！？；!?])', '\\1' || chr(1), 'g'), '\\.([\\t\\n\\f\\r ])', '.' || chr(1) || '\\1', 'g'), chr(1))"


@query(
    "trimmed_articles",
    f"""WITH p AS (SELECT * FROM {_PIECES}),
    s AS (SELECT doc_id, i, part, para, parts, room, whole, unnest({_ENDS}) AS s, generate_subscripts({_ENDS}, 1) AS place FROM p),
    z AS (SELECT *, {_size('s')} AS n FROM s WHERE {_size('s')} > 0),
    o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY doc_id, i ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM z),
    k AS (SELECT *, start >= CASE WHEN part = -1 THEN {lengths.INTRO_FLOOR} ELSE {lengths.FLOOR} END AS beyond, CASE WHEN part = -1 THEN 1 WHEN part = 0 THEN 2 WHEN part = parts - 1 THEN 0 ELSE 3 END AS kind FROM o),
    r AS (SELECT *, sum(n) OVER w AS used, row_number() OVER w AS rank FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY beyond, kind, start, part, para, place)),
    t AS (SELECT *, CASE WHEN rank = 1 AND used > room THEN (CASE WHEN regexp_replace(h, '(?s)[，；、,;][^，；、,;]{{0,79}}$', '') = '' THEN h ELSE regexp_replace(h, '(?s)[，；、,;][^，；、,;]{{0,79}}$', '') END) || '。' ELSE s END AS kept FROM (SELECT *, substr(trim(s), 1, room - 1) AS h FROM r WHERE NOT whole AND (used <= room OR rank = 1 AND room >= 2))),
    l AS (SELECT doc_id, part, para, trim(string_agg(kept, '' ORDER BY place)) AS line FROM t GROUP BY 1, 2, 3),
    f AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY part, para) AS body FROM l GROUP BY 1),
    w AS (SELECT doc_id, array_to_string(lines, chr(10)) AS body FROM {_LINES} WHERE doc_id IN (SELECT doc_id FROM p WHERE whole))
    SELECT doc_id, CAST({_size('body')} AS INT) AS n_chars, md5(body) AS digest FROM (SELECT * FROM f UNION ALL SELECT * FROM w)""",
)
def trimmed_articles(spark: SparkSession, d: str) -> DataFrame:
    """Documents as articles within the greatest length of a report."""
    drafts = _drafts(spark, d)
    n = lengths.size(articles.article_text(F.col("title"), F.col("intro"), F.col("sections")))
    done = lengths.trimmed(drafts.withColumn("cut", n > _MOST))
    lines = F.concat(F.when((F.col("intro") == "") & F.col("cut"), F.array().cast("array<string>")).otherwise(F.array("intro")), F.flatten(F.transform("sections", lambda s: s["paragraphs"])))
    body = F.array_join(lines, "\n")
    return done.select("doc_id", lengths.size(body).alias("n_chars"), F.md5(body.cast("binary")).alias("digest"))


@query("merged_articles")
def merged_articles(spark: SparkSession, d: str) -> DataFrame:
    """Documents as articles whose short paragraphs are joined; the paragraphs and how many of them are long."""
    done = _drafts(spark, d).select("doc_id", lengths.merged(F.col("sections")).alias("sections"))
    paragraphs = F.flatten(F.transform("sections", lambda s: s["paragraphs"]))
    return done.select("doc_id", F.size(paragraphs).alias("paragraphs"), F.size(F.filter(paragraphs, lambda p: lengths.size(p) >= lengths.LONG)).alias("long"), F.md5(F.array_join(paragraphs, "\n").cast("binary")).alias("digest"))


@query(
    "best_versions",
    """SELECT o_custkey, o_orderkey, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY hard * 100 + soft * 10, kind DESC, near DESC, o_orderkey DESC) AS k FROM (
    SELECT *, CASE WHEN n_chars BETWEEN 3550 AND 3800 THEN 4 WHEN n_chars BETWEEN 3500 AND 4000 THEN 3 WHEN n_chars < 3500 THEN 1 ELSE 2 END AS kind,
    CASE WHEN n_chars BETWEEN 3500 AND 4000 THEN -abs(n_chars - 3675) WHEN n_chars < 3500 THEN n_chars ELSE 4000 - n_chars END AS near FROM (
    SELECT o_custkey, o_orderkey, o_orderkey % 3 AS hard, o_custkey * o_orderkey % 4 AS soft, CAST(3000 + o_orderkey * 7 % 1500 AS INT) AS n_chars FROM orders))) WHERE k = 1""",
)
def best_versions(spark: SparkSession, d: str) -> DataFrame:
    """Orders as versions of one article a customer."""
    versions = table(spark, d, "orders").select("o_custkey", "o_orderkey", (3000 + F.col("o_orderkey") * 7 % 1500).cast("int").alias("n_chars"))
    return lengths.best_versions(versions, "o_custkey", "o_orderkey", F.col("o_orderkey") % 3, F.col("o_custkey") * F.col("o_orderkey") % 4, F.col("n_chars"))


def _stand_in(number: int, rows: pd.DataFrame) -> str:
    """A model that answers alike every time: the large orders of a batch as records, and now and then no answer."""
    if number % 7 == 3:
        raise TimeoutError(f"batch {number}")
    if number % 11 == 5:
        return "nothing to report"
    found = [{"id": int(k), "party": f"客户{c}"} for k, c, p in rows[["o_orderkey", "o_custkey", "o_totalprice"]].itertuples(index=False) if p > 50_000]
    return "结果如下：\n```json\n" + json.dumps({"cases": [*found[:3], "no record", *found[3:]]}, ensure_ascii=False).replace("]}", "],}") + "\n```"


_FAILED = "batch % 7 = 3 OR batch % 11 = 5"


@query(
    "model_records",
    f"""WITH b AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 20) AS BIGINT) AS batch FROM orders),
    r AS (SELECT batch, o_orderkey, o_custkey, row_number() OVER (PARTITION BY batch ORDER BY o_orderkey) - 1 AS k FROM b WHERE o_totalprice > 50000 AND NOT ({_FAILED}))
    SELECT batch, CAST(k AS INT) AS place, CAST(1 AS INT) AS tried, CAST(NULL AS VARCHAR) AS error, o_orderkey AS id, '客户' || o_custkey AS party FROM r WHERE k < 12
    UNION ALL SELECT DISTINCT batch, 0, CASE WHEN batch % 7 = 3 THEN 2 ELSE 1 END, CASE WHEN batch % 7 = 3 THEN 'TimeoutError: batch ' || batch ELSE 'no JSON object' END, -1, NULL FROM b WHERE {_FAILED}""",
)
def model_records(spark: SparkSession, d: str) -> DataFrame:
    """Orders in batches of 20 to a stand-in model of which some answers fail; twelve records of each at most."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return answers.model_records(orders, "o_orderkey", _stand_in, "cases", "id long, party string").withColumn("id", F.coalesce("id", F.lit(-1)))


_PLAN_TEXTS = {"core_question": "case_name", "central_thesis": "why", "deal_origin_chain": "title", "initiation_mechanism": "summary", "strategic_objective": "buyer_motive"}
_PLAN_COLUMNS = ("title", "summary", "why", "buyer_motive", "seller_motive", "highlights", "status")


@query(
    "model_plans",
    f"""WITH f AS (SELECT *, [why, buyer_motive, seller_motive, why] AS angles, [title, summary, why, highlights, status] AS directions FROM {filings_sql(*_PLAN_COLUMNS)}),
    c AS (SELECT *, len(list_distinct(list_filter(list_transform(angles, lambda x: trim(x)), lambda x: x <> ''))) AS n_a, len(list_distinct(list_filter(list_transform(directions, lambda x: trim(x)), lambda x: x <> ''))) AS n_d FROM f)
    SELECT id, CAST(CASE WHEN id % 9 = 4 THEN 0 ELSE n_a END AS INT) AS n_angles, array_to_string(list_filter([{', '.join(f"CASE WHEN id % 9 = 4 OR length({c}) < {k} THEN 'short_{n}' END" for (n, c), k in zip(_PLAN_TEXTS.items(), (20, 24, 24, 16, 16), strict=True))},
    CASE WHEN id % 9 = 4 OR n_a < 3 THEN 'few_depth_angles' END, CASE WHEN id % 9 = 4 OR n_d < 4 THEN 'few_chapter_directions' END], lambda x: x IS NOT NULL), ',') AS issues FROM c""",
)
def model_plans(spark: SparkSession, d: str) -> DataFrame:
    """Plans out of answers with a code fence and a closing comma; every ninth answer has no JSON."""
    f = filings(spark, d, *_PLAN_COLUMNS)
    plan = F.to_json(F.struct(*[F.col(c).alias(n) for n, c in _PLAN_TEXTS.items()], F.array("why", "buyer_motive", "seller_motive", "why").alias("depth_angles"), F.array("title", "summary", "why", "highlights", "status").alias("chapter_directions")))
    answer = F.when(F.col("id") % 9 == 4, "no plan").otherwise(F.concat(F.lit("```json\n"), F.regexp_replace(plan, r"\]\}$", "],}"), F.lit("\n```")))
    out = answers.with_plan(f.select("id", answer.alias("answer")), "answer")
    return out.select("id", F.size("plan.depth_angles").alias("n_angles"), F.array_join("issues", ",").alias("issues"))


_OPEN = "本次占比12.x%，另有35.XX%与99.x%，价格9.99元/股，每股9.9元，再次4.1元/股，总金额约1,234,567元，总金额8,000元。"


def _one(pattern: str) -> str:
    return f"nullif(regexp_extract(facts, {_q(pattern)}), '')"


_KNOWN = "regexp_extract_all(facts, '[0-9]{1,3}(?:\\.[0-9]+)?%')"
_SHARE_PRICE = "(?:元/股|港元/股|美元/股)"


def _filled_sql(text: str) -> str:
    for mark, whole in (("12.x%", "12"), ("35.XX%", "35"), ("99.x%", "99")):
        text = f"replace({text}, '{mark}', coalesce(list_filter({_KNOWN}, lambda k: starts_with(k, '{whole}.') OR k = '{whole}%')[1], '{mark}'))"
    price, plain = _one(rf"[0-9]{{1,3}}(?:\.[0-9]{{1,4}})?{_SHARE_PRICE}"), f"regexp_extract(regexp_extract(facts, '[0-9]{{1,3}}(?:\\.[0-9]{{1,4}})?{_SHARE_PRICE}'), '^[0-9]{{1,3}}(?:\\.[0-9]{{1,4}})?')"
    text = f"CASE WHEN {price} IS NULL THEN {text} ELSE regexp_replace(regexp_replace({text}, '[0-9]+(?:\\.[0-9]+)?{_SHARE_PRICE}', {price}), '每股[0-9]+(?:\\.[0-9]+)?元', '每股' || {plain} || '元') END"
    limit = "nullif(regexp_extract(facts, '金额上限约([0-9]{1,3}(?:,[0-9]{3})+元)', 1), '')"
    return f"CASE WHEN {limit} IS NULL THEN {text} ELSE regexp_replace({text}, '总金额约?[0-9]{{1,3}}(?:,[0-9]{{3}})+元', '总金额上限约' || {limit}, 'g') END"


_FACTS = "body || '；' || deal_value || CASE WHEN id % 2 = 0 THEN '；金额上限约7,654,321元' ELSE '' END"


@query(
    "repaired_articles",
    f"""SELECT id, CASE WHEN id % 17 = 3 THEN '' ELSE {_filled_sql('t')} END AS intro, array_to_string(list_filter([CASE WHEN id % 17 <> 3 AND len(list_filter({_KNOWN}, lambda k: starts_with(k, '12.') OR k = '12%' OR starts_with(k, '35.') OR k = '35%' OR starts_with(k, '99.') OR k = '99%')) > 0 THEN 'percent' END,
    CASE WHEN id % 17 <> 3 AND {_one(rf'[0-9]{{1,3}}(?:\.[0-9]{{1,4}})?{_SHARE_PRICE}')} IS NOT NULL THEN 'price' END, CASE WHEN id % 17 <> 3 AND id % 2 = 0 THEN 'limit' END], lambda x: x IS NOT NULL), ',') AS changed
    FROM (SELECT id, {_q(_OPEN)} AS t, {_FACTS} AS facts FROM {filings_sql('body', 'deal_value')})""",
)
def repaired_articles(spark: SparkSession, d: str) -> DataFrame:
    """Drafts with open figures, set right by the text of their filing."""
    facts = F.concat("body", F.lit("；"), "deal_value", F.when(F.col("id") % 2 == 0, "；金额上限约7,654,321元").otherwise(""))
    intro = F.when(F.col("id") % 17 != 3, F.lit(_OPEN))
    out = repairs.repaired(filings(spark, d, "body", "deal_value").select("id", F.lit("标题").alias("title"), intro.alias("intro"), F.array().cast(lengths.SECTIONS).alias("sections"), facts.alias("facts")), "facts")
    return out.select("id", "intro", F.array_join("changed", ",").alias("changed"))


def _alias_sql(name: str) -> str:
    bare = f"trim(regexp_replace(trim({name}), '(?:股份有限公司|有限责任公司|有限公司|公司)$', ''))"
    out = f"regexp_replace({bare}, '[（）()\"“”''‘’]', '', 'g')"
    for long, short in V.SHORT_CITIES:
        out = f"replace({out}, '{long}', '{short}')"
    return f"trim({out})"


_FOCUS = "CASE " + " ".join(f"WHEN {_any('t', words)} THEN '{label}'" for words, label in V.FOCUS) + f" ELSE '{V.FOCUS_OTHERWISE}' END"


@query(
    "fitted_titles",
    f"""SELECT id, list_filter(list_transform([10, 8, 6, 4], lambda n: substr(a, 1, n) || '收购' || substr(b, 1, n) || '：' || focus), lambda x: {_size('x')} <= 40)[1] AS title FROM (
    SELECT id, {_alias_sql('acquirer')} AS a, {_alias_sql('target')} AS b, {_FOCUS} AS focus FROM (SELECT id, CASE WHEN coalesce(acquirer, '') = '' THEN case_name ELSE acquirer END AS acquirer, CASE WHEN target = '' THEN case_name ELSE target END AS target, category || ' ' || deal_value || ' ' || buyer_motive AS t FROM {filings_sql('category', 'deal_value', 'buyer_motive')}))""",
)
def fitted_titles(spark: SparkSession, d: str) -> DataFrame:
    f = filings(spark, d, "category", "deal_value", "buyer_motive")
    named = lambda c: repairs.or_else(F.col(c), F.col("case_name"))
    return f.select("id", repairs.fitted_title(named("acquirer"), named("target"), repairs.focus(F.concat_ws(" ", "category", "deal_value", "buyer_motive"))).alias("title"))
