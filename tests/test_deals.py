"""Rules of deal filings on small Chinese and English cases: signals, identities, clean-up, articles, fact packs, paging."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from dealspark.functions import cjk as C
from dealspark.functions import dates
from dealspark.functions import signals as S
from dealspark.operators import articles, cases, completions, expectations, facts, identity, paging, reconcile
from dealspark.session import Scratch


def values(spark, expression, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_status_signals(spark):
    texts = ["已完成过户", "交易完成", "拟收购，尚未完成", "completed", "completed, subject to approval", "closed, pending filing", "进行中", "", None]
    assert values(spark, S.is_completed, texts) == [True, True, False, True, False, True, False, False, False]
    assert values(spark, S.is_unresolved, texts) == [False, False, True, False, True, False, True, False, False]


def test_value_signals(spark):
    texts = ["12.5亿元", "未披露", "受让其持有的全部股份", "2024", "USD 3 million", "-", None]
    assert values(spark, S.has_deal_value, texts) == [True, False, True, False, True, False, False]
    assert values(spark, S.has_deal_number, texts) == [True, False, False, True, True, False, False]
    assert values(spark, S.is_weak_disclosure, ["", "具体金额未披露", "未披露" + "很" * 40, None]) == [True, True, False, True]
    assert values(spark, lambda c: S.transaction_terms(c, F.lit("12亿元，协议转让")), ["发行股份及支付现金购买资产，12亿元", "-"]) == ["12亿元；现金支付；发行股份及支付现金；协议转让", "12亿元；协议转让"]


def test_parties(spark):
    assert values(spark, S.is_vague_party, ["甲", "*ST", "本次交易对方", "甲公司", None]) == [True, True, True, False, True]
    assert values(spark, lambda c: F.array(*S.split_parties(c)), ["甲收购乙并购丙", "无动词", None]) == [["甲", "乙并购丙"], ["", ""], ["", ""]]
    assert values(spark, S.clean_party, ["一、交易基本情况甲方以现金方式向乙科技有限公司（以下简称“乙”）", "与丙基金（有限合伙", "1）丁 公司、戊"]) == ["乙科技有限公司", "丙基金（有限合伙）", "丁公司"]
    text = "甲乙控股有限公司（以下简称“甲控”）与乙。公司控股股东由丙变更为甲控，股份过户登记完成。"
    assert values(spark, lambda c: S.buyer(c, S.alias_map(c)), [text, "转让给受让方。", ""]) == ["甲乙控股有限公司", "", ""]


def test_percents_prices_and_dates(spark):
    assert values(spark, S.largest_percent, ["5%和12.50 %", "无"]) == ["12.5%", ""]
    assert values(spark, S.transfer_percent, ["甲转让股份，占公司总股本的29.90%。"]) == ["29.9%"]
    assert values(spark, S.share_prices, ["每股转让价格为8.35元/股，另有9元/股", "均价7 元/股及7元/股", ""]) == [["8.35元/股"], ["7元/股"], []]
    assert values(spark, S.share_counts, ["拟受让甲持有的5,000,000股", "股份数量为12股"]) == [["5,000,000"], []]
    verified = lambda c: S.verified_value(c, F.lit("8.35元/股"), F.lit("1,000,010"))
    assert values(spark, verified, ["协议转让，价格7.1元/股", "", "12亿元"]) == [
        "协议转让，价格8.35元/股；按1,000,010股和8.35元/股测算，金额上限约8,350,084元", "披露的每股价格为8.35元/股；按1,000,010股和8.35元/股测算，金额上限约8,350,084元", "12亿元；披露的每股价格为8.35元/股；按1,000,010股和8.35元/股测算，金额上限约8,350,084元"]
    assert values(spark, lambda c: S.completion_status(c, F.lit("2026-09-04T05:00")), ["过户日期为 2026年3月5日。", ""]) == ["2026年3月5日；已完成过户/交割", "2026-09-04；已完成过户/交割"]


def test_sources(spark):
    assert values(spark, S.is_primary_source, ["https://static.cninfo.com.cn/x", "http://ir.example.com/a", "https://evilsec.gov/", "https://www.sec.gov:443/x", "ftp://sec.gov", None]) == [True, True, False, True, False, False]
    media = lambda c: S.is_media(c, F.lit("公司公告"))
    assert values(spark, media, ["https://www.reuters.com/x", "https://www.sec.gov/reuters.com", "https://a.b/"]) == [True, False, False]


def test_json_is_recovered(spark):
    texts = ['```json\n{"a": 1}\n```', 'so: {"a": "“x”", "b": [1,]} ok', '{"a": "x" "b": 2}', '{"a": 1', "none", None]
    assert values(spark, lambda c: F.get_json_object(S.json_object(c), "$.a"), texts) == ["1", "“x”", "x", None, None, None]


def test_clean_up(spark):
    texts = ["公司支付 1100 万元并承接 2500 名员工", "㐀 A股", "交易于 2024年完成,其中 API (甲) 占 12 % !", "代码600519，1.23456元，0012元，2024 年", "“ 甲 ”:乙?", None]
    assert values(spark, C.normalize, texts) == ["公司支付1,100万元并承接2,500名员工", "㐀A股", "交易于2024年完成，其中API (甲) 占12% !", "代码600519，1.23456元，0012元，2024年", "“甲”：乙？", ""]
    assert values(spark, C.has_bare_quantity, ["1100 万元", "1,100万元", "2024年"]) == [True, False, False]
    assert values(spark, C.has_stray_blank, ["一、交易完成\n2024年完成交割", "交易于 2024年"]) == [False, True]
    assert values(spark, C.fullwidth_quotes, ['"a" and "b\'s"', None]) == ["“a” and “b‘s”", ""]
    assert values(spark, C.quote_snippets, ["x" * 30 + '"' + "y" * 30, "none"]) == [["x" * 18 + '"' + "y" * 18], []]
    notes = ["上海喜马拉雅科技（以下简称“喜马拉雅”）有限公司收购", "甲公司（下称“甲”）（下称“甲”）", "乙（简称乙，股票代码：600001）", "收购方（下称“A”） Apple Inc."]
    assert values(spark, C.tidy_notes, notes) == ["上海喜马拉雅科技有限公司（下称“喜马拉雅”）收购", "甲公司（下称“甲”）", "乙（下称“乙”，股票代码：600001）", "收购方 Apple Inc."]
    assert values(spark, C.without_local_paths, ["see  file:///x/y and /home/me/a.txt C:\\Temp\\b"]) == ["see [local-path-redacted] and [local-path-redacted] [local-path-redacted]"]


def test_names(spark):
    assert values(spark, C.compact_name, ["甲乙科技股份有限公司（SZ）", "Acme Inc.", None]) == ["甲乙科技", "Acme", ""]
    aliases = values(spark, C.name_aliases, ["北京星河测试技术股份有限公司", "甲", None])
    assert {"北京星河测试技术股份有限公司", "北京星河测试技术", "星河测试技术", "北京星河", "测试技术", "北京技术"} <= set(aliases[0]) and all(len(a) >= 3 for a in aliases[0]) and aliases[1:] == [[], []]
    outline = lambda c: C.numbered_outline(F.split(c, r"\|"))
    assert values(spark, outline, ["1. 甲|第二章 乙|甲| |结语:丙丁", "结语甲|乙"]) == [["一、甲", "二、乙", "三、结语：丙丁"], ["一、甲", "二、乙"]]


def plain_chunks(paragraphs, limit, joint):
    sizes, current = [], []
    for p in paragraphs:
        if current and sum(map(len, current)) + joint * len(current) + len(p) + joint > limit or len(p) > limit:
            sizes += [sum(map(len, current)) + joint * (len(current) - 1)] if current else []
            current = []
        if len(p) > limit:
            sizes += [len(p[i : i + limit]) for i in range(0, len(p), limit)]
        else:
            current.append(p)
    return sizes + ([sum(map(len, current)) + joint * (len(current) - 1)] if current else [])


def test_chunks_equal_a_plain_loop(spark):
    rng = random.Random(5)
    rows = [["x" * rng.choice([1, 5, 40, 97, 98, 99, 100, 101, 250]) for _ in range(rng.randrange(9))] for _ in range(150)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, p array<string>")
    got = {r["i"]: r["c"] for r in df.select("i", C.chunked_paragraphs(F.col("p"), 100).alias("c")).collect()}
    assert got == {i: plain_chunks(r, 100, 2) for i, r in enumerate(rows)}


def matching(a, b):
    if a == b:
        return True
    (k, x), (m, y) = a.split(":", 1), b.split(":", 1)
    held = lambda p, q, n: p == q or min(len(p), len(q)) >= n and (p in q or q in p)
    if k != m or k == "url":
        return False
    return held(x, y, 6) if k in ("name", "title") else all(held(p, q, 3) for p, q in zip(x.split("->"), y.split("->"), strict=True))


def random_keys(seed, n):
    rng = random.Random(seed)
    name = lambda: "".join(rng.choice("甲乙丙丁戊") for _ in range(rng.randint(1, 7)))
    kinds = (lambda: f"party:{name()}->{name()}", lambda: f"name:{name()}", lambda: f"url:a.b/{rng.randrange(40)}")
    return [[rng.choice(kinds)() for _ in range(rng.randrange(4))] for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_identities_against_all_pairs(spark, seed):
    rows = random_keys(seed, 150)
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, keys array<string>")
    overlap = lambda a, b: any(matching(x, y) for x in rows[a] for y in rows[b])
    seen = {r["id"]: r["seen"] for r in identity.split_by_history(df.where("id >= 40"), df.where("id < 40")).collect()}
    assert seen == {i: any(overlap(i, j) for j in range(40)) for i in range(40, 150)}
    kept = []
    for i in range(150):
        if not any(overlap(i, j) for j in kept):
            kept.append(i)
    assert sorted(r["id"] for r in identity.fuzzy_first_wins(df).collect()) == kept
    assert identity.fuzzy_first_wins(df.limit(0)).count() == 0


def test_case_keys(spark):
    rows = [("weekly_20260904_050000_甲科技有限公司收购乙材料：2026年复盘", None, "", "https://A.b//c%E4%BD%A0/?x=1"), ("交易复盘", "未披露", "乙", "https://a.b/"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "n string, a string, t string, u string")
    got = [r["k"] for r in df.select(identity.case_keys(*map(F.col, "natu")).alias("k")).collect()]
    assert got == [["party:甲科技->乙材料", "name:甲科技有限公司收购乙材料", "url:a.b/c你"], [], []]
    assert values(spark, identity.weekly_party, ["甲集团股份有限公司（A）", "N/A", "标的资产X"]) == ["甲", "", ""]


BRIEF = "case_name string, acquirer string, target string, title string, status string, deal_value string, why string, highlights string, url string, buyer_motive string, seller_motive string, completed boolean, classic boolean"


def test_gates_in_order(spark):
    good = ("甲公司收购乙公司", "甲公司", "乙公司", "公告", "已完成过户", "12亿元", "协同", "", "https://static.cninfo.com.cn/a.pdf", "", "", True, False)
    change = lambda **k: tuple(k.get(n.split()[0], v) for n, v in zip(BRIEF.split(", "), good, strict=True))
    rows = [good, change(completed=False), change(why="黑名单"), change(target="标的资产"), change(classic=True, status="拟收购"), change(url="https://sec.gov"), change(url="https://a.b/c"), change(deal_value="-", status="交易完成"), change(deal_value="-", status="交易完成", title="要约收购报告书"), change(url="https://r.b/x?url=https%3A%2F%2Fwww.sec.gov%2Fa")]
    df = cases.with_signals(spark.createDataFrame(rows, BRIEF))
    got = [r["g"] for r in df.select(expectations.first_failing(cases.report_gates("黑名单，x")).alias("g")).collect()]
    assert got == ["accepted", "topic", "excluded_term", "parties", "completion", "usable_url", "primary_source", "terms", "accepted", "accepted"]
    assert [r["ready"] for r in df.select("ready").collect()] == [True, True, True, False, False, True, True, False, True, True]


def issues_of(spark, rules, title="", intro="", sections=(), name="", acquirer="", target=""):
    row = [(title, intro, [(h, list(p)) for h, p in sections], name, acquirer, target)]
    df = articles.with_parts(spark.createDataFrame(row, articles.ARTICLE + ", case_name string, acquirer string, target string"))
    return set(df.select(expectations.issues(rules()).alias("x")).first()["x"])


def test_article_rules(spark):
    assert {"too_short", "no_subtitle", "few_sections", "few_figures", "no_time", "no_buyer_reason", "no_introduction"} <= issues_of(spark, articles.article_rules)
    body = "甲科技有限公司（下称“甲”）主营业务为材料，2025年收入3亿元，净利润1亿元，收购方拟补强并整合乙材料的客户、产能与订单，实现协同；转让方退出并接受现金对价，协议约定交割与公告。" * 10
    sections = [(f"{n}、{h}", [body]) for n, h in zip("一二三", ("股权与控制权的变化", "对价与支付的安排", "客户与产能的承接"), strict=True)] + [("四、结语：甲科技与乙材料的交割承接", [body])]
    found = issues_of(spark, articles.article_rules, "甲科技收购乙材料：控制权与对价安排", "甲科技", sections, "甲科技收购乙材料", "甲科技有限公司", "乙材料")
    assert found == set()
    noisy = issues_of(spark, articles.article_rules, "甲科技收购乙材料:案例", "本文假设 A公司支付 1100 万元", [*sections[:3], ("四、结论", ["待确认"])], "甲科技收购乙材料", "甲科技有限公司", "乙材料")
    assert {"template_intro", "hypothesis", "stray_blank", "bare_quantity", "placeholder", "last_heading", "generic_heading", "halfwidth_punctuation", "conclusion_without_parties"} <= noisy


def test_quality_rules(spark):
    found = issues_of(spark, articles.quality_rules, "甲案例分析", "预受要约比例达95%", [("一、关键事实与交易进程", ["同样的开头一二三甲", "同样的开头一二三乙", "同样的开头一二三丙"]), ("二、从公开事实回到执行关注点", ["接受率严重不足，值得长期关注"])])
    assert {"weak_title", "no_subtitle", "template_headings", "repeated_openings", "shallow", "contradiction", "generic_ending", "no_cause"} <= found


def test_outline_and_plan_rules(spark):
    df = spark.createDataFrame([(["一、股权与控制权的变化", "二、交易背景", "三、客户与产能的承接", "四、尾声"], ("q", None, ["a"] * 3))], "h array<string>, p struct<core_question:string,central_thesis:string,depth_angles:array<string>>")
    assert df.select(expectations.issues(articles.outline_rules(F.col("h"))).alias("x")).first()["x"] == ["thinking_heading", "short_heading", "last_heading"]
    plan = F.struct(F.col("p.core_question"), F.col("p.central_thesis"), F.lit("x" * 24).alias("deal_origin_chain"), F.lit("x" * 16).alias("initiation_mechanism"), F.lit("").alias("strategic_objective"), F.col("p.depth_angles"), F.array(F.lit("a")).alias("chapter_directions"))
    assert df.select(expectations.issues(articles.plan_rules(plan)).alias("x")).first()["x"] == ["short_core_question", "short_central_thesis", "short_strategic_objective", "few_chapter_directions"]


def test_fact_packs(spark):
    research = spark.createDataFrame(
        [(1, 1, "协议", "公司公告", "https://static.cninfo.com.cn/a", "", "", "每股转让价格为8.35元/股，拟受让甲持有的1,000,000股股份。\n本次交易对价为12.5亿元，以现金支付方式收购乙公司股权。"), (1, 2, "报道", "财新", "https://x.caixin.com/b", "转让方拟退出该业务并接受全部现金要约安排。", "2025年净利润4500万元，同比增长12%，订单稳定。", ""), (2, 1, None, None, None, None, None, None)],
        "case_id int, place int, title string, source_name string, url string, summary string, numeric_facts string, extracted_text string",
    )
    case = spark.createDataFrame([(i, "甲收购乙", "跨境并购", "甲公司", "乙公司", "未披露", "", "", "", "", "", "") for i in (1, 2, 3)], "id int, case_name string, category string, acquirer string, target string, deal_value string, deal_status string, buyer_motive string, seller_motive string, why string, title string, highlights string")
    got = {r["id"]: r for r in facts.fact_packs(case, research).collect()}
    assert len(got) == 3 and got[1]["authoritative"] == 1 and "8.35元/股" in got[1]["deal_value"] and "8,350,000元" in got[1]["deal_value"]
    assert got[1]["source_refs"] == ["[official] 协议 | 公司公告 | https://static.cninfo.com.cn/a", "[supplement] 报道 | 财新 | https://x.caixin.com/b"]
    assert got[1]["issues"] == ["buyer_reason"] and "转让方拟退出" in got[1]["seller_reason"] and len(got[1]["key_numbers"]) == 3
    assert got[2]["issues"] == got[3]["issues"] == ["value", "timeline", "buyer_reason", "seller_reason", "numbers", "authoritative"]
    row = facts.source_hierarchy(research.where("case_id = 1")).first()
    assert (row["n_official"], row["n_media"], len(row["official_facts"]), len(row["media_reports"])) == (1, 1, 1, 1)


def test_a_case_of_many_rows_reads_its_first_ones(spark):
    schema = "case_id int, place int, title string, source_name string, url string, summary string, numeric_facts string, extracted_text string"
    rows = [(1, i, f"报道{i}", "财新", f"https://x.caixin.com/{i}", f"收购乙公司股权对价为{i}.5亿元，双方已签署协议并公告。", "", "") for i in range(2000)]
    research = spark.createDataFrame(rows + [(2, 1, "公告", "公司", "https://static.cninfo.com.cn/a", "甲", "", "")], schema)
    case = spark.createDataFrame([(1, "甲收购乙", "", "甲公司", "乙公司", "未披露", "", "", "", "", "", "")], "id int, case_name string, category string, acquirer string, target string, deal_value string, deal_status string, buyer_motive string, seller_motive string, why string, title string, highlights string")
    whole, first = facts.fact_packs(case, research), facts.fact_packs(case, research.where("place < 56"))
    assert whole.collect() == first.collect() and "WindowGroupLimit" in whole._jdf.queryExecution().toString()
    got = {r["case_id"]: r for r in facts.source_hierarchy(research).collect()}
    assert got[1]["n_media"] == 2000 and [x[:3] for x in got[1]["media_reports"]] == ["报道0", *[f"报道{i}" for i in range(1, 10)]] and got[2]["n_official"] == 1


def test_party_keys_of_a_common_name(spark):
    rng = random.Random(4)
    names = ["abc", "abcd", "xabc", "abcdef", "zzz", "zzzy", "q"] + [f"abc{i}" for i in range(12)]
    cases = [(i, [f"party:{rng.choice(names)}->{rng.choice(names)}"]) for i in range(120)] + [(200 + i, [f"party:abc->t{i}"]) for i in range(60)] + [(300 + i, [f"party:s{i}->abc"]) for i in range(60)]
    held = lambda x, y: x == y or (min(len(x), len(y)) >= 3 and (x in y or y in x))
    split = lambda k: k[len("party:") :].split("->")
    keys = sorted({k[0] for _, k in cases})
    want = {(x, y) for x in keys for y in keys if all(map(held, split(x), split(y)))}
    got = identity.matching_keys(spark.createDataFrame([(k,) for k in keys], "key string"), Scratch(spark)).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def page(number, ids, total=5, **other):
    row = {"range": 1, "page": number, "asked_size": 2, "returned_page": number, "returned_size": 2, "success": 1, "total": total, "rows": None if ids is None else [(i,) for i in ids]} | other
    return tuple(row.values())


PAGE = "range long, page long, asked_size int, returned_page long, returned_size int, success int, total long, rows array<struct<art_code:string>>"
WHOLE = (("AN1", "AN2"), ("AN3", "AN4"), ("AN5",))


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ({}, []), ({2: page(2, ("AN3", "AN4"), success=0)}, [(2, "rejected")]), ({2: page(2, None)}, [(2, "rejected")]), ({2: page(2, ("AN3", "AN4"), returned_page=1)}, [(2, "wrong_page")]), ({2: page(2, ("AN3", "AN4"), returned_size=9)}, [(2, "wrong_page")]),
        ({3: page(3, ("AN5", "AN6"), 6)}, [(3, "total_changed")]), ({2: page(2, ("AN3",))}, [(2, "incomplete")]), ({2: page(2, ("AN3", None))}, [(2, "missing_id")]), ({2: page(2, ("AN1", "AN2"))}, [(2, "repeated_page")]), ({2: page(2, ("AN3", "AN1"))}, [(2, "overlapping_rows")]),
        ({2: page(2, ("AN3", "AN3"))}, [(2, "overlapping_rows")]), ({3: page(3, ("X5",))}, [(3, "bad_id")]), ({2: None}, [(2, "missing_page")]),
    ],
)
def test_each_broken_page_names_its_rule(spark, change, want):
    rows = [p for n, ids in enumerate(WHOLE, 1) if (p := change.get(n, page(n, ids)))]
    pages = spark.createDataFrame(rows, PAGE)
    assert sorted((r["page"], r["rule"]) for r in paging.broken_pages(pages).collect()) == want
    assert paging.collected(pages).count() == (0 if want else 5)


def test_too_many_pages_and_empty_ranges(spark):
    pages = spark.createDataFrame([page(n, ids) for n, ids in enumerate(WHOLE, 1)], PAGE)
    assert {r["rule"] for r in paging.broken_pages(pages, max_pages=2).collect()} == {"too_many_pages"}
    assert paging.broken_pages(spark.createDataFrame([page(1, (), 0)], PAGE)).count() == 0 == paging.broken_pages(pages.limit(0)).count()


def test_windows_and_checks(spark):
    df = spark.sql("select date'2026-09-04' a, date'2026-09-11' b, date'2026-09-12' c")
    assert df.select(dates.is_weekly_window(F.col("a"), F.col("b")), dates.is_weekly_window(F.col("a"), F.col("c")), dates.window_name("a", "b")).first()[:] == (True, False, "20260904_20260911")
    rows = spark.createDataFrame([(None, False), (0, False), (3, True), (3, False)], "n int, bad boolean")
    assert [r[0] for r in rows.select(expectations.completion("n", ["bad"])).collect()] == ["missing", "no_case_rows", "validation_failed:bad", "valid:case_rows=3"]
    assert expectations.required(rows, [("any", F.lit(True))]).count() == 4
    with pytest.raises(Exception, match="not enough"):
        expectations.required(rows, [("not enough", F.col("n") > 0)]).collect()


def test_completed_deals_by_kind(spark):
    head = "证券代码：600001 证券简称：星河股份 星河科技股份有限公司 关于"
    rows = [
        (1, "关于重大资产购买之标的资产完成过户的公告", f"{head}收购的公告。公司购买甲方持有的东方材料有限公司 60%股权。标的资产已完成过户，交易对价12亿元。"),
        (2, "关于资产置换完成交割的公告", f"{head}资产置换的公告。置入的资产为北方能源集团持有的南海油气有限公司100%股权及相关权利，置出资产为旧资产。资产已完成交割。"),
        (3, "关于控股股东股份完成过户的公告", f"{head}控股股东变更的公告。公司控股股东变更为西部投资有限公司，股份已完成过户，转让价款5亿元。"),
        (4, "关于东海资本要约收购结果公告", f"{head}要约收购的公告。要约收购期限届满，过户已完成，要约价格6.5元/股。"),
        (5, "关于股份转让完成过户的公告", f"{head}股份转让的公告。转让给南方实业有限公司，股份转让完成过户，占公司总股本的8.5%。"),
        (6, "关于股份转让完成过户的公告", f"{head}股份转让的公告。转让给北方实业有限公司，股份转让完成过户，占公司总股本的1.5%。"),  # too small
        (7, "关于股份转让完成过户的公告", f"{head}股份转让的公告。转让给南方实业有限公司，股份转让完成过户，占公司总股本的8.5%。"),  # the same deal
        (8, "独立财务顾问关于完成过户的核查意见", rows_text := f"{head}收购的公告。公司收购东方材料有限公司 60%股权，已完成过户。"),  # advisers' paper
        (9, "关于完成过户的公告", "拟收购，尚未完成。"), (10, "关于完成过户的公告", None), (11, "年度股东大会决议公告", rows_text),
    ]
    df = spark.createDataFrame([(i, t, "", f"https://static.cninfo.com.cn/{i}.pdf", "中国", f"2026-03-{i:02}T09:00:00", b) for i, t, b in rows], "id int, title string, summary string, url string, region string, published string, body string")
    got = {r["id"]: r for r in completions.completed_deals(df).collect()}
    assert {i: r["kind"] for i, r in got.items()} == {1: "asset_acquisition", 2: "asset_swap", 3: "control_transfer", 4: "tender_offer", 7: "share_transfer"}
    assert {i: (r["acquirer"], r["target"]) for i, r in got.items()} == {1: ("星河科技股份有限公司", "东方材料有限公司60%股权"), 2: ("星河科技股份有限公司", got[2]["target"]), 3: ("西部投资有限公司", "星河科技股份有限公司"), 4: ("东海资本", "星河科技股份有限公司"), 7: ("南方实业有限公司", "星河股份8.5%股份")}
    assert "南海油气有限公司100%股权" in got[2]["target"] and got[7]["category"] == "上市公司+PE" and "6.5元" in got[4]["deal_value"] and got[3]["status"] == "2026-03-03；已完成过户/交割"
    known = spark.createDataFrame([(["party:西部投资->星河科技"],)], "keys array<string>")
    assert 3 not in {r["id"] for r in completions.completed_deals(df, known).collect()}
    assert completions.completed_deals(df.limit(0)).count() == 0


def test_reconciled_addresses_against_all_pairs_of_a_batch(spark):
    rng = random.Random(3)
    parties, hosts, sources = ["甲乙科技", "丙丁材料", "acme corp", "戊己"], ["a.com", "www.b.com", "c.org"], ["巨潮资讯", "巨潮资讯网", "reuters", ""]
    word = lambda: rng.choice(["收购", "股权转让", "merger", "deal value", "完成交割", "2026"])
    url = lambda: rng.choice([f"https://{rng.choice(hosts)}/{rng.choice(['x', 'y/', 'z?q=1'])}", "https://a.com/", "-", ""])
    cases_ = [(b, i, url(), rng.choice(sources), rng.choice(["-", "2026-01-01"]), rng.choice(parties), rng.choice([*parties, "未披露"]), f"{word()} {word()} {word()}") for b in range(3) for i in range(12)]
    items = [(b, i, url(), f"{rng.choice(parties)} {word()}", f"{rng.choice(parties)}{word()}", rng.choice(sources), word(), "2026-02-02") for b in range(3) for i in range(15)]
    c = spark.createDataFrame(cases_, "batch int, id int, url string, source_name string, published string, acquirer string, target string, description string")
    r = spark.createDataFrame(items, "batch int, place int, url string, title string, summary string, source_name string, query string, published string")
    compact = lambda t: re.sub(r"[^0-9a-z\u4e00-\u9fff]+", "", t.lower())
    host = lambda u: re.sub(r"^www\.", "", m.group(1).lower()) if (m := re.match(r"https?://([^/]+)", u)) else ""
    party = lambda t: "" if t == "未披露" else compact(re.sub("corp", "corp", t))

    def points(case, item):
        text, total = compact(" ".join((item[3], item[4], item[5], item[6]))), 0
        total += 6 * bool(host(case[2]) and host(case[2]) == host(item[2]))
        a, b = compact(case[3]), compact(item[5])
        total += 3 * bool(a and b and (a in b or b in a))
        total += sum(5 for p in case[5:7] if len(party(p)) >= 3 and party(p) in text)
        return total + sum(1 for t in re.findall(r"[a-z0-9]{4,}|[\u4e00-\u9fff]{2,}", case[7].lower()) if len(compact(t)) >= 3 and compact(t) in text)

    want = {}
    for case in cases_:
        own = [i for i in items if i[0] == case[0] and re.match("https?://", i[2]) and i[2] != "https://a.com/"]
        if any(i[2].rstrip("/") == case[2].rstrip("/") for i in own):
            want[case[:2]] = case[2:5]
            continue
        best = max(own, key=lambda i: (points(case, i), -i[1]), default=None)
        if best and points(case, best) >= 8:
            want[case[:2]] = (best[2], case[3] if case[3] not in ("", "-") else best[5] or "-", case[4] if case[4] != "-" else best[7])
        else:
            want[case[:2]] = ("-", case[3], case[4])
    got = {(x["batch"], x["id"]): (x["url"], x["source_name"], x["published"]) for x in reconcile.reconciled(c, r).collect()}
    assert got == want and len({v[0] for v in want.values()}) > 3
    assert reconcile.reconciled(c.limit(0), r).count() == 0 and {x["url"] for x in reconcile.reconciled(c, r.limit(0)).collect()} == {"-"}
