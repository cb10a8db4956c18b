"""Costly queries on few bytes use all cores, values read often are evaluated once, joins keep to the input's size."""

import random
import re

import pytest
from pyspark.sql import functions as F

from dealspark.functions import cjk as C
from dealspark.functions import pages as P
from dealspark.functions import signals as S
from dealspark.functions import text as T
from dealspark.functions import terms
from dealspark.functions import vocab as V
from dealspark.operators import answers, articles, expectations, facts, identity, joins, reconcile, selection
from dealspark.plans import records, reports
from dealspark.plans.filings import filings


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def one_group(spark, tmp_path_factory):
    """Orders in one row group of one file."""
    d = str(tmp_path_factory.mktemp("sf"))
    rows = spark.range(4000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 97).alias("o_custkey"), F.lit("1996-01-02 00:00:00").cast("timestamp_ntz").alias("o_orderdate"), (F.col("id") * 100.0).alias("o_totalprice"))
    rows.coalesce(1).write.parquet(f"{d}/orders.parquet")
    return d


def test_filings_of_one_row_group_are_many_tasks(spark, one_group):
    f = filings(spark, one_group, "title")
    assert f.select(F.spark_partition_id()).distinct().count() > 2
    assert f.count() == 4000


def test_batches_of_few_bytes_are_many_tasks(spark, one_group):
    rows = spark.read.parquet(f"{one_group}/orders.parquet").select("o_orderkey")
    placed = selection.global_position(rows, "o_orderkey")
    assert placed.where("position <> o_orderkey").count() == 0
    told = answers.answered(rows, "o_orderkey", lambda number, r: str(len(r)))
    assert told.select(F.spark_partition_id()).distinct().count() > 2
    assert {(r["answer"], r["error"]) for r in told.collect()} == {("20", None)} and told.count() == 200


@pytest.mark.parametrize(("expression", "most"), [
    (lambda c: S.buyer(c, S.alias_map(c)), 300), (S.clean_party, 60), (S.transaction_terms, 20), (C.name_aliases, 50), (lambda c: identity.case_keys(c, c, c, c), 100),
])
def test_values_read_often_are_evaluated_once(spark, expression, most):
    """Replacements stand in a plan about once a use in the code, not once for every reader of their result."""
    spark.conf.set("spark.sql.maxPlanStringLength", 10_000_000)
    df = spark.createDataFrame([("甲",)], "v string").select(expression(F.col("v")).alias("x"))
    assert plan(df).count("regexp_replace") < most


def test_bound_value(spark):
    df = spark.createDataFrame([("a ",), (None,)], "v string").select(T.bound(F.trim("v"), lambda x: F.coalesce(F.concat(x, x), F.lit("none"))).alias("x"))
    assert [r["x"] for r in df.collect()] == ["aa", "none"]


def test_holding_pairs_of_names_made_of_few_parts(spark):
    """All pairs are found, and candidates stay few although every short run is in very many names."""
    numbers = "零一二三四五六七八九"
    digits = lambda n: "".join(numbers[int(c)] for c in str(n))
    names = {f"{p}星河{digits(a)}科技{f}收购东方{digits(b)}材料" for p in ("", "北京") for f in ("", "集团") for a in range(0, 40, 3) for b in range(0, 200, 7)}
    names |= {"收购东方一", "星河三科技收", "短"}
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = [(r["short"], r["long"]) for r in identity.holding_pairs(df, 6).collect()] + [(r["short"], r["long"]) for r in identity.holding_pairs(df.where("length(name) < 5"), 6).collect()]
    assert len(found) == len(set(found)) and set(found) == {(s, n) for s in names for n in names if len(s) >= 6 and s != n and s in n}
    assert "xxhash64" in plan(identity.holding_pairs(df, 6))


def test_manifest_matches_of_shared_names(spark):
    """Equal stems are looked up once, and no row of the result is shuffled; ids that occur twice still give each pair once."""
    docs = spark.createDataFrame([(i, f"a/{i}.docx", "星河科技收购东方") for i in range(50)] + [(50, None, None), (51, "b/9.docx", "")], "id long, path string, stem string")
    records = spark.createDataFrame([(i, f"x/{i}.docx" if i < 5 else None, "星河科技") for i in range(40)] + [(40, "b/9.docx", "")], "record long, file string, name string")
    expected = {(i, k) for i in range(50) for k in range(40)} | {(9, 40), (51, 40)}
    for d, r in ((docs, records), (docs.union(docs.limit(1).selectExpr("id", "'z'", "stem")), records)):
        found = [tuple(x) for x in joins.manifest_matches(d, r).collect()]
        assert len(found) == len(set(found)) and set(found) == expected
    text = plan(joins.manifest_matches(docs, records))
    assert not text.startswith("Aggregate")


def test_lowest_within_by_running_minima(spark):
    """Equal to all pairs, negative values and edges included, without a sliding frame."""
    rng = random.Random(5)
    left = [(rng.randrange(3), rng.randrange(-300, 900)) for _ in range(300)] + [(7, 1)]
    right = [(rng.randrange(3), rng.randrange(-300, 900), rng.randrange(10_000)) for _ in range(150)]
    own, other = spark.createDataFrame(left, "g int, v long"), spark.createDataFrame(right, "g int, v long, p long")
    for reach in (1, 40, 49):
        found = joins.lowest_within(own, other, "g", "v", "p", reach)
        expected = {(g, v, min(ps)) for g, v in set(left) if (ps := [p for h, w, p in right if h == g and abs(v - w) <= reach])}
        rows = [tuple(r) for r in found.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == expected
        assert not re.search(r"RangeFrame, -\d", plan(found))


def test_narrow_tables_are_joined_in_tasks_by_rows(spark, one_group):
    """Both joins of the rules read one deal of the lines, by rows; the pairs of names are made where the customers are."""
    lines = spark.range(6000).select((F.col("id") % 3000).alias("l_orderkey"), F.expr("timestamp_ntz'1995-12-30' + make_interval(0, 0, 0, cast(id % 7 as int))").alias("l_shipdate"))
    customers = spark.range(3000).select(F.col("id").alias("c_custkey"), F.format_string("Customer#%09d", "id").alias("c_name"), (F.col("id") % 3).cast("int").alias("c_nationkey"), (F.col("id") - 10.0).alias("c_acctbal"))
    for name, df in (("lineitem", lines), ("customer", customers), ("supplier", customers.limit(50).toDF("s_suppkey", "s_name", "s_nationkey", "s_acctbal"))):
        df.coalesce(1).write.mode("overwrite").parquet(f"{one_group}/{name}.parquet")
    found = records.expectation_union(spark, one_group)
    assert {r["rule"]: r["n"] for r in found.collect()} == {"shipped_before_ordered": sum(i % 7 < 3 for i in range(6000)), "negative_balance": 10, "order_without_lines": 1000}
    assert "RepartitionByExpression" in plan(found)
    pairs = records.equi_then_fuzzy_match(spark, one_group)
    assert pairs.select(F.spark_partition_id()).distinct().count() > 2


def test_pages_are_read_in_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    df = spark.range(0, 1500, 1, 1).select("id", P.read_pages(F.format_string("<title>t%d</title><p>x", "id"))["title"].alias("t"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 512
    assert df.where("t <> concat('t', id)").count() == 0 and df.count() == 1500


def test_points_of_batches_with_few_and_with_many_parts(spark, monkeypatch):
    """Texts make no rows for their runs of characters; batches of many parts give the same by the lookup."""
    own = [(b, i, "-", "", "-", f"星河{'甲乙丙丁'[i % 4]}科技", "东方材料", f"收购 项目{'甲乙'[i % 2]}产业协同 alpha{i}") for b in (1, 2) for i in range(8)]
    raw = [(b, p, f"https://x{p}.com/a/{p}", f"星河{'甲乙丙丁'[p % 4]}科技收购东方材料", f"项目{'甲乙'[p % 2]}产业协同 alpha{p}", "", "", "") for b in (1, 2) for p in range(6)]
    cases_ = spark.createDataFrame(own, "batch long, id long, url string, source_name string, published string, acquirer string, target string, description string")
    items = spark.createDataFrame(raw, "batch long, place long, url string, title string, summary string, source_name string, query string, published string")
    found = reconcile.matched_points(cases_, items)
    assert "explode(filter(parts" in plan(found)
    few = sorted(tuple(r) for r in found.collect())
    monkeypatch.setattr(reconcile, "SCANNED", 0)
    assert few and few == sorted(tuple(r) for r in reconcile.matched_points(cases_, items).collect())


def test_fact_packs_of_few_bytes_are_many_tasks(spark, one_group):
    packs = reports.fact_packs(spark, one_group)
    assert packs.select("id", F.spark_partition_id().alias("p")).agg(F.countDistinct("p").alias("n"), F.count("*").alias("rows")).first()["n"] > 2


def test_history_is_not_compared_with_itself(spark, monkeypatch):
    """Pairs are made of cases and history only, and no table of keys is broadcast, whose size the driver would hold."""
    made, stored = [], identity.Scratch.stored
    monkeypatch.setattr(identity.Scratch, "stored", lambda self, df: made.append((stored(self, df), df._jdf.queryExecution().executedPlan().toString())) or made[-1][0])
    old = [([f"party:abc{i}->xyz", f"name:abcdef{'g' * i}"],) for i in range(60)]
    cases = spark.createDataFrame([(1, ["party:abc->xyzz"]), (2, ["name:bcdefg"]), (3, ["party:none->xyz"]), (4, ["url:u"]), (5, ["title:bcdefg"]), (6, [])], "id int, keys array<string>")
    got = identity.split_by_history(cases, spark.createDataFrame([*old, (["url:u"],)], "keys array<string>")).collect()
    assert {r["id"]: r["seen"] for r in got} == {1: True, 2: True, 3: False, 4: True, 5: False, 6: False}
    assert made[-1][0].columns == ["left", "right"] and made[-1][0].count() == 60 + 59 + 1
    assert not [p for _, p in made if "BroadcastHashJoin" in p]


def test_hints_are_searched_in_batches(spark):
    """The best sentence is that of a plain search, and no plan holds an expression for each word and sentence."""
    rng = random.Random(7)
    words = ["转让", "Seller ", "受让", "12.5亿元", "8.35元/股", "释义", "收购", "  ", " ", "现金", "3", "甲", "在本报告书中", "1,200 Million", "作价"]
    rows = [(i, None if i == 0 else ["".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(rng.randint(0, 12))] + [None]) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, s array<string>")

    def points(s, hints):
        has = lambda listed: any(w in s for w in listed)
        found = sum(h.lower() in s.lower() for h in hints)
        return found and (found * 4 + 3 * has(V.SENTENCE_UNITS) + 8 * has(V.SENTENCE_PRICES) + 2 * has(V.SENTENCE_DEALS) - 8 * has(V.SENTENCE_NOISE), s)

    stated = df.withColumn("s", F.filter("s", lambda x: S.has_quantity(x) & ~S.is_noisy_value(x)))
    plain = {r["id"]: r["s"] for r in stated.collect()}
    for own, hints, numbered, fits in ((dict(rows), V.SELLER_HINTS, False, None), (dict(rows), V.BUYER_HINTS, True, None), (plain, V.VALUE_HINTS, True, facts.states_value)):
        got = {r["id"]: r["x"] for r in df.select("id", facts.best_hint(F.col("s"), hints, numbered, fits).alias("x")).collect()}
        for i, sentences in own.items():
            scored = [p for s in sentences or [] if s and (not numbered or re.search("[0-9]", s)) and (p := points(s, hints))]
            assert got[i] == (max(scored, key=lambda p: p[0])[1] if scored else "")
    spark.conf.set("spark.sql.maxPlanStringLength", 10_000_000)
    schema = "case_id int, place int, title string, source_name string, url string, summary string, numeric_facts string, extracted_text string"
    case = spark.createDataFrame([], "id int, case_name string, category string, acquirer string, target string, deal_value string, deal_status string, buyer_motive string, seller_motive string, why string, title string, highlights string")
    assert plan(facts.fact_packs(case, spark.createDataFrame([], schema))).count("Contains(lower") < 10


def test_normal_form_by_patterns_that_begin_with_their_sign(spark):
    """Equal to rules that look behind at every place first."""
    K, X = V.CJK, "A-Za-z0-9"
    blanks = f"(?<=[{K}]) (?=[{K}{X}])|(?<=[{X}]) (?=[{K}])| (?=[，。；：？！、）】》])|(?<=[（【《]) |(?<=[）】》]) (?=[{K}{X}])|(?<=[{K}{X}]) (?=[（【《])|(?<=[0-9]) (?=[%％])"
    rules = [(blanks, "")] + [(f"{a} ", a) for a in "“‘"] + [(f" {a}", a) for a in "”’"] + [(rf"(?<=[{K}%％）】]),(?![0-9])", "，"), (rf"(?<![0-9]),(?=[{K}])", "，")]
    rules += [(rf"(?<=[{K}0-9%％）】]){h}|{h}(?=[{K}])", f) for h, f in ((";", "；"), (":", "："), (r"\?", "？"), ("!", "！"))]
    rules += [(rf"(?<=[{K}])\(", "（"), (rf"\)(?=[{K}])", "）"), (rf"(?<=[{K}])\[", "【"), (rf"\](?=[{K}])", "】"), (" ,", "，"), (" ;", "；")]
    rules += [(rf"(?<=(?<![0-9.,])[1-9][0-9]{{0,40}})(?=(?:[0-9]{{3}})+(?![0-9.,])\s*(?:{S.words_pattern(V.QUANTITY_UNITS)}))", ",")]
    rng = random.Random(9)
    texts = ["".join(rng.choices("甲乙元万aB 0123456789  ,,;:?!()[]（）【】《》，。%％“”‘’.", k=rng.randint(0, 40))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in [*texts, None, "共1234567 元", "12345678901234567890股"]], "t string")
    plain = S.clean(F.col("t"))
    for old, new in rules:
        plain = F.regexp_replace(plain, old, new)
    assert df.select(C.normalize(F.col("t")).alias("x"), plain.alias("y")).where("not x <=> y").count() == 0


def test_words_of_many_groups_are_counted_in_batches(spark):
    """Sizes, digits and counts are those of the expressions, for words that hold or overlap each other and for every kind of white space."""
    rng = random.Random(11)
    groups = {"a": ("估值", "估值锚", "值锚定", "may ", "ab"), "b": ("锚定", "aba", "估值", "ba"), "c": ("𠮷野", "12", "。。")}
    texts = ["".join(rng.choices(["估值", "锚", "定", "may", " ", "a", "b", "𠮷", "野", "1", "2", "。", terms.BLANKS[rng.randrange(len(terms.BLANKS))]], k=rng.randint(0, 30))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in [*texts, "", None, "估", "".join(map(chr, range(1, 0xD800)))]], "t string")
    text = F.coalesce("t", F.lit(""))
    plain = F.struct(articles.size(F.col("t")).alias("size"), F.length(F.regexp_replace(text, "[^0-9]", "")).alias("digits"), *[T.count_terms(text, g).alias(n) for n, g in groups.items()])
    assert df.select(terms.measured(F.col("t"), groups).alias("x"), plain.alias("y")).where("x <> y or x is null").count() == 0
    assert df.select(terms.measured(F.col("t"))["size"].alias("x"), articles.size(F.col("t")).alias("y")).where("x <> y").count() == 0


@pytest.mark.parametrize("rules", [articles.article_rules, articles.quality_rules])
def test_rules_of_articles_search_no_word_by_word(spark, rules):
    """Words of whole texts are looked up at once, so that a plan holds few searches for single words."""
    spark.conf.set("spark.sql.maxPlanStringLength", 10_000_000)
    read = articles.with_parts(spark.createDataFrame([], articles.ARTICLE))
    assert plan(read.select(expectations.issues(rules()).alias("x"))).count("Contains(") < 50


def test_broken_rules_are_counted_where_the_articles_are(spark, one_group):
    """No row is made for each article and issue, and rules that begin with their sign mean what those that look behind first mean."""
    found = reports.article_issues(spark, one_group)
    assert plan(found).count("Generate") == 1 and "Aggregate [count" in plan(found)
    issues = articles.with_parts(reports._articles(spark, one_group)).select(F.explode(expectations.issues(articles.article_rules())).alias("issue"))
    assert {r["issue"]: r["n"] for r in found.collect()} == {r["issue"]: r["count"] for r in issues.groupBy("issue").count().collect()}

    K, X = V.CJK, "A-Za-z0-9"
    note = "下文简称|以下简称|（简称|（证券简称"
    split = F.rlike("t", F.lit(C.SPLIT_NOTE)) | F.rlike("t", F.lit(rf"({C.NOTE})\1"))
    old = {
        "blank": F.rlike("t", F.lit(rf"[{K}][^\S\r\n]+[{X}]|[{X}][^\S\r\n]+[{K}]")), "half": F.rlike("t", F.lit(rf"[{K}][,;:!?()\[\]]|[,;:!?()\[\]][{K}]")),
        "bare": F.rlike("t", F.lit(rf"(?<![0-9.,])[0-9]{{4,}}(?![0-9.,])(?=\s*(?:{S.words_pattern(V.QUANTITY_UNITS)}))")), "fact": F.rlike("t", F.lit(r"(?i)(?:[0-9]+(?:\.[0-9]+)?\.x+%|x{2,}%?|待补充|待确认|占位|TODO|TBD)")),
        "note": F.rlike("t", F.lit(rf"{C.DESCRIBED_NOTE}|{note}|{C.NOTE}(?:娱乐集团|科技有限公司|股份有限公司|有限责任公司|有限公司)")) | split,
    }
    new = {"blank": C.has_stray_blank(F.col("t")), "half": C.has_halfwidth_punctuation(F.col("t")), "bare": C.has_bare_quantity(F.col("t")), "fact": C.has_placeholder_fact(F.col("t")), "note": C.has_malformed_note(F.col("t"))}
    rng = random.Random(13)
    parts = ["甲", "A", "7", "1234", "00", " ", "\t", "\n", ",", ":", "(", "]", ".", "元", "million", "x", "X", "%", "待补充", "占位", "tbd", "ToDo", "公司", "收购方", "（下称“甲”）", "（下称“甲”，1）", "有限公司", "（简称", "以下简称", "SPAC公司", " Acme Corp."]
    df = spark.createDataFrame([("".join(rng.choices(parts, k=rng.randint(0, 7))),) for _ in range(6000)], "t string").select("t", *[c.alias(f"old_{k}") for k, c in old.items()], *[c.alias(f"new_{k}") for k, c in new.items()]).cache()
    for k in old:
        assert df.where(f"old_{k} <> new_{k}").count() == 0 and 0 < df.where(f"old_{k}").count() < 6000, k
