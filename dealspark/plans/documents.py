"""Queries on texts: extraction, sentences, vocabularies, documents as nested values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.catalogue import query
from dealspark.functions import text as T
from dealspark.operators import expectations, names, selection
from dealspark.session import table

TERMS = ("the", "and", "der", "die", "les", "que", "con", "token", "license", "ing")
SENTENCES = "list_filter(list_transform(string_split_regex(regexp_replace(coalesce(text, ''), '([.!?。！？；;])', E'\\\\1\\n', 'g'), '\\n+'), lambda s: trim(s)), lambda s: length(s) >= 12)"
SCORE = "4 * CAST(regexp_matches(s, '[0-9]') AS INT) + 2 * CAST(contains(s, 'the') AS INT) + 2 * CAST(contains(s, 'der') AS INT) + 3 * CAST(contains(s, 'token') AS INT) - 2 * CAST(length(s) > 220 AS INT)"


def _score(s):
    return 4 * F.rlike(s, F.lit("[0-9]")).cast("int") + 2 * F.contains(s, F.lit("the")).cast("int") + 2 * F.contains(s, F.lit("der")).cast("int") + 3 * F.contains(s, F.lit("token")).cast("int") - 2 * (F.length(s) > 220).cast("int")


@query("amount_extract", "SELECT doc_id, len(x) AS n, list_max(list_transform(x, lambda v: CAST(v AS DOUBLE))) AS largest FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '(\\d+(?:\\.\\d+)?)', 1) AS x FROM documents) WHERE len(x) > 0")
def amount_extract(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "documents").select("doc_id", T.numbers(F.col("text")).alias("x")).where("size(x) > 0")
    return found.select("doc_id", F.size("x").cast("long").alias("n"), F.array_max("x").alias("largest"))


@query(
    "pii_redact",
    "SELECT doc_id, sha1(t) AS digest, CAST((length(t) - length(replace(t, '[redacted]', ''))) // 10 AS BIGINT) AS marks FROM (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}', '[redacted]', 'g'), '(?i)(bearer\\s+)[A-Za-z0-9._\\-]+', '\\1[redacted]', 'g'), '[0-9a-f]{32,}', '[redacted]', 'g'), '[0-9]{13,16}', '[redacted]', 'g') AS t FROM documents)",
)
def pii_redact(spark: SparkSession, d: str) -> DataFrame:
    clean = table(spark, d, "documents").select("doc_id", T.redact(F.col("text")).alias("t"))
    return clean.select("doc_id", F.sha1("t").alias("digest"), F.floor((F.length("t") - F.length(F.replace("t", F.lit("[redacted]"), F.lit("")))) / 10).alias("marks"))


@query(
    "sentence_topk",
    f"SELECT doc_id, pos, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS k FROM (SELECT doc_id, CAST(pos - 1 AS INT) AS pos, CAST({SCORE} AS INT) AS score FROM (SELECT doc_id, unnest({SENTENCES}) AS s, generate_subscripts({SENTENCES}, 1) AS pos FROM documents)) WHERE score >= 4) WHERE k <= 3",
)
def sentence_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("pos", "s"))
    scored = rows.select("doc_id", "pos", _score(F.col("s")).alias("score")).where("score >= 4")
    return selection.top_per_group(scored, ["doc_id"], [F.desc("score"), F.asc("pos")], 3).select("doc_id", "pos", "score")


@query("best_sentence", f"SELECT doc_id, sha1(s) AS digest, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS k FROM (SELECT doc_id, s, pos, CAST({SCORE} AS INT) AS score FROM (SELECT doc_id, unnest({SENTENCES}) AS s, generate_subscripts({SENTENCES}, 1) AS pos FROM documents))) WHERE k = 1")
def best_sentence(spark: SparkSession, d: str) -> DataFrame:
    """The first of the best sentences, found inside each row without a shuffle."""
    scored = F.transform(T.sentences(F.col("text")), lambda s, i: F.struct(_score(s).alias("score"), (-i).alias("at"), s.alias("s")))
    best = table(spark, d, "documents").select("doc_id", F.array_max(scored).alias("b")).where("b is not null")
    return best.select("doc_id", F.sha1("b.s").alias("digest"), "b.score")


@query("year_infer", "SELECT o_orderkey, CASE WHEN o_totalprice > 100000 AND year(o_orderdate) = 1998 THEN '1998' WHEN contains(t, '1997') THEN '1997' ELSE coalesce(nullif(regexp_extract(t, '(199[0-9]|200[0-9])', 1), ''), '1990') END AS y FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' ' || o_orderkey AS t FROM orders)")
def year_infer(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat_ws(" ", F.to_date("o_orderdate").cast("string"), "o_orderkey")
    y = F.when((F.col("o_totalprice") > 100000) & (F.year("o_orderdate") == 1998), "1998").when(F.contains(text, F.lit("1997")), "1997").otherwise(F.coalesce(F.nullif(F.regexp_extract(text, "(199[0-9]|200[0-9])", 1), F.lit("")), F.lit("1990")))
    return table(spark, d, "orders").select("o_orderkey", y.alias("y"))


@query("term_density", "SELECT doc_id, hits, CAST(CASE WHEN regexp_matches(text, '[0-9]') THEN 1 ELSE 0 END + CASE WHEN hits >= 3 THEN 1 ELSE 0 END + CASE WHEN length(text) >= 1000 THEN 1 ELSE 0 END AS INT) AS score FROM (SELECT doc_id, text, CAST(" + " + ".join(f"CAST(contains(text, '{t}') AS INT)" for t in TERMS) + " AS INT) AS hits FROM documents)")
def term_density(spark: SparkSession, d: str) -> DataFrame:
    hits = T.count_terms(F.col("text"), TERMS)
    score = F.rlike("text", F.lit("[0-9]")).cast("int") + (hits >= 3).cast("int") + (F.length("text") >= 1000).cast("int")
    return table(spark, d, "documents").select("doc_id", hits.alias("hits"), score.alias("score"))


@query("repeated_openings", "SELECT opening, count(*) AS n FROM (SELECT substr(regexp_replace(trim(p), '^[0-9]+[.)、]\\s*', ''), 1, 8) AS opening FROM (SELECT unnest(string_split(text, E'\\n')) AS p FROM documents) WHERE trim(p) <> '') GROUP BY 1 HAVING count(*) >= 3")
def repeated_openings(spark: SparkSession, d: str) -> DataFrame:
    paragraphs = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("p")).select(F.trim("p").alias("p")).where("p <> ''")
    opening = F.substring(F.regexp_replace("p", r"^[0-9]+[.)、]\s*", ""), 1, 8)
    return paragraphs.groupBy(opening.alias("opening")).agg(F.count("*").alias("n")).where("n >= 3")


@query("doc_flatten", "SELECT conv_id, length(t) AS size, sha1(t) AS digest FROM (SELECT conv_id, string_agg(role || ': ' || text, E'\\n' ORDER BY turn) AS t FROM conversations GROUP BY 1)")
def doc_flatten(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    text = F.array_join(F.transform("m", lambda x: F.concat(x["role"], F.lit(": "), x["text"])), "\n")
    return turns.select("conv_id", F.length(text).cast("long").alias("size"), F.sha1(text).alias("digest"))


@query("doc_slices", "SELECT conv_id, string_agg(role, ',' ORDER BY turn) FILTER (WHERE k <= 2) AS early, max_by(role, turn) AS last FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations) GROUP BY 1")
def doc_slices(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("m"))
    return turns.select("conv_id", F.array_join(F.transform(F.slice("m", 1, 2), lambda x: x["role"]), ",").alias("early"), F.element_at("m", -1)["role"].alias("last"))


@query(
    "document_issues",
    "SELECT issue, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN length(text) < 200 THEN 'too short' END, CASE WHEN length(text) > 4000 THEN 'too long' END, CASE WHEN NOT regexp_matches(text, '[0-9]') THEN 'no figure' END, CASE WHEN contains(text, '!!') THEN 'loud tone' END, CASE WHEN n_chars <> length(text) THEN 'wrong size' END], lambda x: x IS NOT NULL)) AS issue FROM documents) GROUP BY 1",
)
def document_issues(spark: SparkSession, d: str) -> DataFrame:
    size = F.length("text")
    rules = [("too short", size < 200), ("too long", size > 4000), ("no figure", ~F.rlike("text", F.lit("[0-9]"))), ("loud tone", F.contains("text", F.lit("!!"))), ("wrong size", F.col("n_chars") != size)]
    return table(spark, d, "documents").select(F.explode(expectations.issues(rules)).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


@query("source_quality_report", "SELECT source, count(*) AS docs, count(*) FILTER (WHERE length(text) < 200) AS short_docs, count(*) FILTER (WHERE contains(text, '!!')) AS loud, min(doc_id) AS first_doc FROM documents GROUP BY 1")
def source_quality_report(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("docs"), F.count_if(F.length("text") < 200).alias("short_docs"), F.count_if(F.contains("text", F.lit("!!"))).alias("loud"), F.min("doc_id").alias("first_doc"))


#: A document's paragraphs, and the names looked for: the words of the benchmark with eight letters or more.
_PARAGRAPHS = "string_split(coalesce(text, ''), E'\\n')"


@query(
    "name_mentions",
    f"""WITH names AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]{{8,}}')) AS name FROM benchmark),
    paragraphs AS (SELECT doc_id, unnest({_PARAGRAPHS}) AS p, generate_subscripts({_PARAGRAPHS}, 1) - 1 AS k FROM documents),
    words AS (SELECT doc_id, k, unnest(regexp_extract_all(p, '[\\p{{L}}\\p{{N}}_]+')) AS name FROM paragraphs)
    SELECT doc_id, name, count(*) AS mentions, CAST(min(k) AS INTEGER) AS paragraph FROM words JOIN names USING (name) GROUP BY doc_id, name""",
)
def name_mentions(spark: SparkSession, d: str) -> DataFrame:
    """How often each document names each of the names, and in which paragraph first: one automaton for all."""
    listed = _benchmark_names(spark, d)
    found = table(spark, d, "documents").select("doc_id", F.explode(listed.mentions(F.split(F.coalesce("text", F.lit("")), "\n"), whole_words=True)).alias("m"))
    return found.select("doc_id", "m.name", "m.mentions", "m.paragraph")


def _benchmark_names(spark: SparkSession, d: str) -> names.Names:
    words = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{8,}"), 0)).alias("name"))
    return names.Names(words.distinct().withColumn("note", F.concat(F.lit(" ("), F.substring("name", 1, 3), F.lit(")"))), note="note")


@query("first_mention_notes")
def first_mention_notes(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a note behind the first mention of each name; a second pass changes nothing."""
    noted = _benchmark_names(spark, d).annotate(F.split(F.coalesce("text", F.lit("")), "\n"), whole_words=True)
    out = table(spark, d, "documents").select("doc_id", F.length("text").alias("before"), F.array_join(noted, "\n").alias("t"))
    return out.select("doc_id", F.sha1("t").alias("digest"), (F.length("t") - F.coalesce("before", F.lit(0))).alias("added"))
