"""Queries on records: normalisation, dedupe, joins, ranking and selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealspark.catalogue import query
from dealspark.functions import text as T
from dealspark.functions import vocab as V
from dealspark.operators import dedupe, expectations, identity, joins, selection
from dealspark.session import spread, table, task_count

SPACE_SQL = r"[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
NORM_SQL = f"lower(trim(regexp_replace(replace(replace(replace(replace(replace(replace(coalesce(text, ''), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '{SPACE_SQL}', ' ', 'g')))"


@query("exact_first_wins_dedupe", f"SELECT min(doc_id) AS doc_id, sha1({NORM_SQL}) AS stable_key FROM documents GROUP BY 2")
def exact_first_wins_dedupe(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.sha1(T.normalize_text(F.col("text"))).alias("stable_key"))
    return dedupe.first_wins(docs, F.col("stable_key"), ["doc_id"])


@query("text_normalize", f"SELECT doc_id, length({NORM_SQL}) AS size, sha1({NORM_SQL}) AS digest FROM documents")
def text_normalize(spark: SparkSession, d: str) -> DataFrame:
    norm = T.normalize_text(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.length(norm).cast("long").alias("size"), F.sha1(norm).alias("digest"))


@query("compact_match_text", "SELECT doc_id, length(t) AS size, sha1(t) AS digest FROM (SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^0-9a-z\\x{4e00}-\\x{9fff}]+', '', 'g') AS t FROM documents)")
def compact_match_text(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", T.compact_match_text(F.col("text")).alias("t"))
    return docs.select("doc_id", F.length("t").cast("long").alias("size"), F.sha1("t").alias("digest"))


@query(
    "priority_topk",
    f"""WITH first AS (SELECT doc_id, source, lang, n_chars, row_number() OVER (PARTITION BY sha1({NORM_SQL}) ORDER BY doc_id) AS k FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, source, lang, CASE lang WHEN 'es' THEN 2 WHEN 'fr' THEN 1 ELSE 0 END AS priority, n_chars FROM first WHERE k = 1 AND n_chars >= 200
    ORDER BY priority DESC, n_chars DESC, doc_id LIMIT 450""",
)
def priority_topk(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text is not null")
    own = docs.select("doc_id", "source", "lang", "n_chars", F.sha1(T.normalize_text(F.col("text"))).alias("key"))
    first = dedupe.first_wins(own, F.col("key"), ["doc_id"]).where("n_chars >= 200")
    ranked = first.withColumn("priority", F.when(F.col("lang") == "es", 2).when(F.col("lang") == "fr", 1).otherwise(0))
    return selection.top_k(ranked, [F.desc("priority"), F.desc("n_chars"), F.asc("doc_id")], 450).select("doc_id", "source", "lang", "priority", "n_chars")


@query(
    "ordered_unique_list",
    "SELECT conv_id, string_agg(role, ',' ORDER BY t) AS roles FROM (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY 1, 2) GROUP BY 1",
)
def ordered_unique_list(spark: SparkSession, d: str) -> DataFrame:
    first = table(spark, d, "conversations").groupBy("conv_id", "role").agg(F.min("turn").alias("t"))
    return first.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", "role"))), lambda x: x["role"]), ",").alias("roles"))


CONTAIN_SQL = "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON b.text <> '' AND contains(d.text, b.text)"


@query("fuzzy_semi_join", CONTAIN_SQL)
def fuzzy_semi_join(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    items = table(spark, d, "benchmark").select("item_id", F.col("text").alias("passage"))
    return joins.contained_in(docs, items, "text", "passage", "doc_id", "item_id")


@query("fuzzy_anti_join", f"SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({CONTAIN_SQL}))")
def fuzzy_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id").join(fuzzy_semi_join(spark, d), "doc_id", "left_anti")


@query("fuzzy_first_wins")
def fuzzy_first_wins(spark: SparkSession, d: str) -> DataFrame:
    """Parts whose name isn't equal to that of one kept before, and doesn't hold it or lie in it."""
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.array(F.concat(F.lit("name:"), F.lower("p_name"))).alias("keys"))
    kept = identity.fuzzy_first_wins(parts).withColumnRenamed("id", "p_partkey")
    return table(spark, d, "part").select("p_partkey", "p_brand", F.lower("p_name").alias("name")).join(kept, "p_partkey", "left_semi")


#: Suppliers up to which they are broadcast; beyond it Spark joins them by key.
_FEW_SUPPLIERS = 1_000_000


@query(
    "equi_then_fuzzy_match",
    """SELECT c_custkey, s_suppkey, c_nationkey = s_nationkey AND right(c_name, 3) = right(s_name, 3) AS exact_match
    FROM customer JOIN supplier ON c_nationkey = s_nationkey WHERE right(c_name, 3) = right(s_name, 3) OR contains(c_name, right(s_name, 2))""",
)
def equi_then_fuzzy_match(spark: SparkSession, d: str) -> DataFrame:
    """A name that ends in the same three characters holds the last two, so one lookup among its runs of two finds both kinds.

    The result grows with customers times suppliers, and a few thousand keys of very unequal size make it: it is made where the customers
    are, dealt over all cores, not where a key is.
    """
    pairs = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("c_name") - 1), lambda i: F.substr("c_name", i, F.lit(2))))
    c = spread(table(spark, d, "customer").where(F.length("c_name") >= 2), "c_custkey").select("c_custkey", "c_name", F.col("c_nationkey").alias("nation"), F.explode(pairs).alias("run"))
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("nation"), F.substring("s_name", -2, 2).alias("run"))
    if s.count() <= _FEW_SUPPLIERS:
        s = F.broadcast(s)
    return c.join(s, ["nation", "run"]).select("c_custkey", "s_suppkey", (F.substring("c_name", -3, 3) == F.substring("s_name", -3, 3)).alias("exact_match"))


@query(
    "argmax_score_join",
    """WITH s AS (SELECT s_suppkey, s_nationkey, s_acctbal, n_regionkey AS sr FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    c AS (SELECT c_custkey, c_nationkey, c_acctbal, n_regionkey AS cr FROM customer JOIN nation ON c_nationkey = n_nationkey),
    m AS (SELECT s_suppkey, c_custkey, 3 + CASE WHEN s_nationkey = c_nationkey THEN 6 ELSE 0 END + CASE WHEN abs(s_acctbal - c_acctbal) < 500 THEN 5 ELSE 0 END AS score FROM s JOIN c ON sr = cr)
    SELECT s_suppkey, score, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY score DESC, c_custkey) AS k FROM m WHERE score >= 8) WHERE k = 1""",
)
def argmax_score_join(spark: SparkSession, d: str) -> DataFrame:
    """The customer that fits each supplier best: 3 points for the region, 6 for the nation, 5 for a balance less than 500 apart.

    Eight points need the nation or the balance, so the best customer is the first of those with both, of the nation, or
    of the region with the balance: three lookups of a lowest key instead of all pairs of a region.
    """
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    sides = {}
    for name, p, key in (("supplier", "s", "s_suppkey"), ("customer", "c", "c_custkey")):
        rows = table(spark, d, name).join(n, F.col(f"{p}_nationkey") == F.col("n_nationkey"))
        sides[p] = rows.select(key, F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"), F.round(F.col(f"{p}_acctbal") * 100).cast("long").alias("cents"))
    s, c = sides["s"], sides["c"]
    own = c.groupBy("nation").agg(F.min("c_custkey").alias("lowest"))
    found = [s.join(own, "nation").withColumn("score", F.lit(9))]
    for group, score in (("nation", 14), ("region", 8)):
        found.append(s.join(joins.lowest_within(s, c, group, "cents", "c_custkey", 49_999), [group, "cents"]).withColumn("score", F.lit(score)))
    rows = reduce(DataFrame.union, [f.select("s_suppkey", "score", F.col("lowest").alias("c_custkey")) for f in found])
    return rows.groupBy("s_suppkey").agg(F.max("score").alias("score"), F.max_by("c_custkey", "score").alias("c_custkey"))


@query(
    "penalty_tuple_sort",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
    ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 ELSE 10 END, CASE WHEN o_totalprice > 200000 THEN 0 WHEN o_totalprice > 50000 THEN 3 ELSE 5 END,
    CASE WHEN c_acctbal >= 0 THEN 0 ELSE 2 END, CASE WHEN o_orderpriority LIKE '1%' THEN 0 WHEN o_orderpriority LIKE '2%' THEN 4 ELSE 8 END, c_mktsegment, o_orderkey LIMIT 100""",
)
def penalty_tuple_sort(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    order = [
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(10),
        F.when(F.col("o_totalprice") > 200000, 0).when(F.col("o_totalprice") > 50000, 3).otherwise(5),
        F.when(F.col("c_acctbal") >= 0, 0).otherwise(2),
        F.when(F.startswith("o_orderpriority", F.lit("1")), 0).when(F.startswith("o_orderpriority", F.lit("2")), 4).otherwise(8),
        F.col("c_mktsegment"),
        F.col("o_orderkey"),
    ]
    return selection.top_k(both, order, 100).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "evidence_score_rank",
    """SELECT d.doc_id, CAST(CASE WHEN quality = 1 THEN 1000 ELSE 0 END + CASE WHEN n_chars > 2000 THEN 500 ELSE 0 END + CASE WHEN regexp_matches(text, '[0-9]') THEN 220 ELSE 0 END
      + CASE WHEN lang = 'en' THEN 40 ELSE 0 END - CASE WHEN toxic = 1 THEN 300 ELSE 0 END AS BIGINT) AS score
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id ORDER BY score DESC, d.doc_id LIMIT 200""",
)
def evidence_score_rank(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    points = ((F.col("quality") == 1, 1000), (F.col("n_chars") > 2000, 500), (F.rlike("text", F.lit("[0-9]")), 220), (F.col("lang") == "en", 40), (F.col("toxic") == 1, -300))
    score = sum((F.when(c, p).otherwise(0) for c, p in points[1:]), F.when(points[0][0], points[0][1]).otherwise(0))
    return selection.top_k(docs.select("doc_id", score.cast("long").alias("score")), [F.desc("score"), F.asc("doc_id")], 200)


@query("top1_per_group", "SELECT c_nationkey, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer) WHERE k = 1")
def top1_per_group(spark: SparkSession, d: str) -> DataFrame:
    return selection.top_per_group(table(spark, d, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.asc("c_custkey")]).select("c_nationkey", "c_custkey", "c_acctbal")


@query("balanced_quota")
def balanced_quota(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    penalty = F.coalesce(-F.col("c_acctbal"), F.lit(float("inf")))  # without a balance: last
    pool = c.select(F.col("n_name").alias("category"), F.col("c_name").alias("name"), penalty.alias("penalty"), (F.col("n_regionkey") == 2).alias("domestic"), (F.col("n_nationkey") % 3).alias("earlier"))
    rows = [r.asDict() for r in selection.quota_pool(pool, 12).collect()]  # 12 of each nation
    picked = selection.balanced_quota(rows, 12, 4)
    return spark.createDataFrame([(i, r["category"], r["name"], r["domestic"]) for i, r in enumerate(picked)], "rank int, category string, name string, domestic boolean")


@query(
    "running_budget",
    "SELECT o_orderkey FROM (SELECT o_orderkey, o_custkey, sum(CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS used FROM orders) WHERE used <= 2",
)
def running_budget(spark: SparkSession, d: str) -> DataFrame:
    used = F.sum(F.startswith("o_orderpriority", F.lit("1")).cast("int")).over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", used.alias("used")).where("used <= 2").select("o_orderkey")


@query(
    "rejection_reason_counts",
    """SELECT CASE WHEN c_custkey IS NULL THEN 'no_customer' WHEN o_totalprice < 1000 THEN 'small' WHEN c_acctbal < 0 THEN 'in_debt' WHEN o_orderstatus <> 'F' THEN 'open' ELSE 'accepted' END AS reason, count(*) AS n
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def rejection_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    gates = [("no_customer", F.col("c_custkey").isNotNull()), ("small", F.col("o_totalprice") >= 1000), ("in_debt", F.col("c_acctbal") >= 0), ("open", F.col("o_orderstatus") == "F")]
    return both.groupBy(expectations.first_failing(gates).alias("reason")).agg(F.count("*").alias("n"))


@query(
    "readiness_counts",
    """SELECT count(*) AS docs, count(*) FILTER (WHERE text IS NOT NULL) AS with_text, count(*) FILTER (WHERE n_chars >= 500) AS longer, count(*) FILTER (WHERE lang = 'en') AS english, count(*) FILTER (WHERE regexp_matches(text, '[0-9]')) AS numeric,
    count(*) FILTER (WHERE l.doc_id IS NOT NULL) AS labelled, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic, count(*) FILTER (WHERE quality = 1 AND toxic = 0 AND n_chars >= 500) AS ready
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def readiness_counts(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "documents").join(table(spark, d, "labels").withColumn("labelled", F.lit(True)), "doc_id", "left")
    tests = {"with_text": "text is not null", "longer": "n_chars >= 500", "english": "lang = 'en'", "numeric": "text rlike '[0-9]'", "labelled": "labelled", "good": "quality = 1", "toxic": "toxic = 1", "ready": "quality = 1 and toxic = 0 and n_chars >= 500"}
    return both.agg(F.count("*").alias("docs"), *[F.count_if(F.expr(c)).alias(n) for n, c in tests.items()])


@query("zero_filled_counts", "SELECT n_name, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey AND s_acctbal > 0 GROUP BY 1")
def zero_filled_counts(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "supplier").where("s_acctbal > 0").groupBy("s_nationkey").agg(F.count("*").alias("k"))
    return table(spark, d, "nation").join(facts, F.col("n_nationkey") == F.col("s_nationkey"), "left").select("n_name", F.coalesce("k", F.lit(0)).alias("n"))


@query("batch_ids", "SELECT CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 20) AS BIGINT) AS batch, doc_id FROM documents")
def batch_ids(spark: SparkSession, d: str) -> DataFrame:
    placed = selection.global_position(table(spark, d, "documents").select("doc_id"), "doc_id")
    return placed.select(F.floor(F.col("position") / 20).alias("batch"), "doc_id")


@query("batch_cap", "SELECT batch, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY n_chars DESC, doc_id) AS k FROM (SELECT CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 20) AS BIGINT) AS batch, doc_id, n_chars FROM documents)) WHERE k <= 12")
def batch_cap(spark: SparkSession, d: str) -> DataFrame:
    placed = selection.global_position(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id").withColumn("batch", F.floor(F.col("position") / 20))
    return selection.top_per_group(placed, ["batch"], [F.desc("n_chars"), F.asc("doc_id")], 12).select("batch", "doc_id")


@query(
    "party_normalize",
    f"SELECT c_custkey, regexp_replace(lower(regexp_replace(c_name, '(customer|co|ltd|inc)', '', 'gi')), '{V.SEPARATORS}', '', 'g') AS party FROM customer",
)
def party_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", T.normalize_party(F.col("c_name"), ("customer", "co", "ltd", "inc")).alias("party"))


@query("ordered_classifier", "SELECT p_partkey, CASE WHEN p_type LIKE '%BRASS%' THEN 'brass' WHEN p_size > 40 THEN 'large' WHEN p_retailprice > 1500 THEN 'dear' WHEN contains(lower(p_name), 'a') THEN 'named' ELSE 'other' END AS class FROM part")
def ordered_classifier(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.contains("p_type", F.lit("BRASS")), "brass").when(F.col("p_size") > 40, "large").when(F.col("p_retailprice") > 1500, "dear").when(F.contains(F.lower("p_name"), F.lit("a")), "named").otherwise("other")
    return table(spark, d, "part").select("p_partkey", kind.alias("class"))


@query("missing_vocab", "SELECT d.doc_id, coalesce(quality, 0) = 1 AS good, coalesce(toxic = 1, false) AS toxic, lower(trim(coalesce(lang, ''))) IN ('', '-', 'n/a', 'na', 'none', 'null') AS missing FROM labels l RIGHT JOIN documents d ON d.doc_id = l.doc_id")
def missing_vocab(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id", "right")
    return both.select("doc_id", (F.coalesce("quality", F.lit(0)) == 1).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"), T.is_placeholder(F.col("lang")).alias("missing"))


@query("alias_map_lookup", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def alias_map_lookup(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")


@query("fallback_union", "SELECT doc_id, source FROM documents WHERE lang = 'xx' UNION ALL SELECT doc_id, source FROM documents WHERE lang = 'de' AND NOT EXISTS (SELECT 1 FROM documents WHERE lang = 'xx')")
def fallback_union(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    return joins.fallback_union(docs.where("lang = 'xx'"), docs.where("lang = 'de'")).select("doc_id", "source")


@query(
    "ranked_union_dedupe",
    "SELECT nation, name, src FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY src, name) AS k FROM (SELECT c_nationkey AS nation, c_name AS name, 1 AS src FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT s_nationkey, s_name, 2 FROM supplier)) WHERE k = 1",
)
def ranked_union_dedupe(spark: SparkSession, d: str) -> DataFrame:
    live = table(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"), F.lit(1).alias("src"))
    pool = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), F.lit(2).alias("src"))
    return dedupe.first_wins(live.unionByName(pool), F.col("nation"), ["src", "name"])


@query(
    "page_integrity",
    "SELECT CAST(o_orderkey // 50 AS BIGINT) AS page, count(*) AS rows_found, count(DISTINCT o_orderkey) AS distinct_rows, count(*) FILTER (WHERE o_orderdate IS NULL) AS undated, count(*) <> 50 AS short_page FROM orders GROUP BY 1",
)
def page_integrity(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "orders").groupBy(F.floor(F.col("o_orderkey") / 50).alias("page"))
    return pages.agg(F.count("*").alias("rows_found"), F.countDistinct("o_orderkey").alias("distinct_rows"), F.count_if(F.col("o_orderdate").isNull()).alias("undated"), (F.count("*") != 50).alias("short_page"))


@query("identity_explode", "SELECT kind, count(DISTINCT k) AS n FROM (SELECT 'name' AS kind, lower(p_name) AS k FROM part UNION ALL SELECT 'brand_type', p_brand || '->' || p_type FROM part) GROUP BY 1")
def identity_explode(spark: SparkSession, d: str) -> DataFrame:
    keys = F.array(F.struct(F.lit("name").alias("kind"), F.lower("p_name").alias("k")), F.struct(F.lit("brand_type").alias("kind"), F.concat_ws("->", "p_brand", "p_type").alias("k")))
    return table(spark, d, "part").select(F.explode(keys).alias("x")).select("x.*").groupBy("kind").agg(F.countDistinct("k").alias("n"))


@query("expectation_union", """SELECT rule, count(*) AS n FROM (
    SELECT 'shipped_before_ordered' AS rule FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate
    UNION ALL SELECT 'negative_balance' FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'order_without_lines' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) GROUP BY 1""")
def expectation_union(spark: SparkSession, d: str) -> DataFrame:
    lines, orders, customers = (table(spark, d, t) for t in ("lineitem", "orders", "customer"))
    # tasks by rows: two narrow columns of very many lines are few bytes in a shuffle, but not in the task that sorts them; both joins read one deal
    n = task_count(lines)
    lines, orders = lines.select("l_orderkey", "l_shipdate").repartition(n, "l_orderkey"), orders.select("o_orderkey", "o_orderdate").repartition(n, "o_orderkey")
    early = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).where("l_shipdate < o_orderdate")
    bare = orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    found = expectations.violations([("shipped_before_ordered", early, "l_orderkey"), ("negative_balance", customers.where("c_acctbal < 0"), "c_custkey"), ("order_without_lines", bare, "o_orderkey")])
    return found.groupBy("rule").agg(F.count("*").alias("n"))


@query("deal_amount_verified", "SELECT l_returnflag, l_linestatus, sum(round_even(CAST(l_quantity * l_extendedprice AS DOUBLE), 0)) AS amount, count(*) AS n FROM lineitem GROUP BY 1, 2")
def deal_amount_verified(spark: SparkSession, d: str) -> DataFrame:
    amount = F.bround(F.col("l_quantity") * F.col("l_extendedprice"), 0)
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum(amount).alias("amount"), F.count("*").alias("n"))
