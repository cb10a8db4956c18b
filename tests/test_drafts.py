"""Lengths, repairs and model answers against plain versions."""

import json
import re

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dealspark.operators import answers, lengths, repairs

ARTICLE = "title string, intro string, sections " + lengths.SECTIONS


def _size(text):
    return len(re.sub(r"\s", "", text or ""))


def _whole(r):
    return "\n".join([r["title"] or "", r["intro"] or "", *["\n".join([s["heading"] or "", *(s["paragraphs"] or [])]) for s in r["sections"] or []]])


def _sentences(text):
    return [s for s in re.split(r"(?<=[。！？；!?])|(?<=\.)(?=[\t\n\f\r ])|\n+", text or "") if _size(s)]


_words = st.text(alphabet="甲乙，；。！ \n", max_size=60)
_articles = st.lists(st.tuples(_words, st.one_of(st.none(), _words), st.one_of(st.none(), st.lists(st.tuples(_words, st.lists(_words, max_size=4)), max_size=4))), min_size=1, max_size=12)


@settings(max_examples=12, deadline=None, derandomize=True, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=_articles, most=st.integers(5, 90))
def test_trimmed_never_exceeds_and_keeps_sentences(spark, rows, most):
    out = lengths.trimmed(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, " + ARTICLE), most).collect()
    assert len(out) == len(rows)
    for r in out:
        title, intro, sections = rows[r["id"]]
        before = {"title": title, "intro": intro, "sections": [{"heading": h, "paragraphs": p} for h, p in sections or []]}
        assert r["fits"] == (_size(_whole(r)) <= most)
        if _size(_whole(before)) <= most:
            assert _whole(r) == _whole(before)
            continue
        room = most - _size(title) - sum(_size(h) for h, _ in sections or [])
        assert r["fits"] or room < 0
        pieces = [_sentences(intro), *[_sentences(p) for _, ps in sections or [] for p in ps]]
        whole = {"".join(p[:n]).strip(" ") for p in pieces for n in range(1, len(p) + 1)}
        for text in [r["intro"], *[p for s in r["sections"] for p in s["paragraphs"]]]:
            cut = text.endswith("。") and any(s.strip(" ").startswith(text[:-1]) and _size(s) > room for p in pieces for s in p[:1])
            assert not text or text in whole or cut


def test_trimmed_edges(spark):
    rows = [("t", None, None), (None, "长" * 50, []), ("很长的题目" * 4, "文。", [("一", ["段。"])]), ("t", "介绍，" * 8, [("一", None), (None, [None, "段。" * 30])])]
    out = [r.asDict(True) for r in lengths.trimmed(spark.createDataFrame(rows, ARTICLE), 20).collect()]
    assert out[0]["fits"] and out[0]["sections"] == [] and out[0]["intro"] == ""
    assert out[1]["intro"] == "长" * 19 + "。"
    assert out[2]["intro"] == "" and out[2]["sections"] == [] and out[2]["fits"]
    assert out[3]["fits"]
    assert lengths.trimmed(spark.createDataFrame([], ARTICLE), 20).count() == 0


def test_trimmed_takes_long_articles(spark):
    rows = [("t", "介绍。", [("一", ["句子。" * 100_000] * 2), ("二", ["末。" * 90])])]
    r = lengths.trimmed(spark.createDataFrame(rows, ARTICLE), 4000).first()
    assert r["fits"] and 3900 <= _size(_whole(r)) <= 4000 and all(p.endswith("。") for p in r["sections"][0]["paragraphs"])


def _merged(sections, long, most, wanted):
    """The same by loops: paragraphs grow until they are long; sections are taken until there are enough long ones."""
    have = sum(_size(p) >= long for _, ps in sections for p in ps)
    out = [list(ps) for _, ps in sections]
    for k, (_, ps) in enumerate(sections):
        if have >= wanted or len(ps) < 2 or k == len(sections) - 1 > 0:
            continue
        rest, new = [p.strip(" ") for p in ps if _size(p)], []
        while rest:
            text = rest.pop(0)
            grown = _size(text) < long
            while rest and _size(text) < long and _size(text.rstrip("。；") + "；" + rest[0]) <= most:
                text = text.rstrip("。；") + "；" + rest.pop(0)
            new.append(text)
            have += grown and _size(text) >= long
        out[k] = new
    return out


@settings(max_examples=12, deadline=None, derandomize=True, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.lists(st.tuples(st.just("h"), st.lists(st.text(alphabet="甲乙。； ", max_size=12), max_size=6)), max_size=4), min_size=1, max_size=12))
def test_merged_equals_loops(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, sections " + lengths.SECTIONS)
    for r in df.select("id", lengths.merged(F.col("sections"), 8, 14, 2).alias("m")).collect():
        assert [s["paragraphs"] for s in r["m"]] == _merged(rows[r["id"]], 8, 14, 2)


def test_best_versions(spark):
    rows = [(1, 1, 0, 1, 3700), (1, 2, 0, 0, 3000), (1, 3, 0, 0, 3400), (2, 1, 1, 0, 3675), (2, 2, 0, 9, 10), (3, 1, None, None, None), (4, 1, 0, 0, 3600), (4, 2, 0, 0, 3750), (4, 2, 0, 0, 3750), (5, 1, 0, 0, 4100), (5, 2, 0, 0, 3499)]
    df = spark.createDataFrame(rows, "k int, at int, hard int, soft int, n int")
    best = {r["k"]: r["at"] for r in lengths.best_versions(df, "k", "at", F.col("hard"), F.col("soft"), F.col("n")).collect()}
    assert best == {1: 3, 2: 2, 3: 1, 4: 2, 5: 1}


def test_repairs_reach_a_fixed_point(spark):
    texts = ["占比12.x%、5.xx%与112.X%，7.x%", "价9.9元/股，每股12345.6元，再9元/股", "总金额约1,000元与总金额2,000,000元", "无", "", None, "100000元/股"]
    facts = ["占12.5%，另12%与5%；8.35元/股；金额上限约9,000元", "", None, "3.2港元/股", "金额上限约1,500,000元，7.25%"]
    rows = [("12.x%", t, [("9元/股", [t, None, "x"]), (None, None)], f) for t in texts for f in facts]
    df = spark.createDataFrame(rows, ARTICLE + ", facts string")
    once = repairs.repaired(df, "facts")
    out = once.collect()
    assert len(out) == len(rows)
    assert repairs.repaired(once.drop("changed"), "facts").where("size(changed) > 0").count() == 0
    first = next(r for r in out if r["facts"] == facts[0] and r["intro"].startswith("占比"))
    assert first["title"] == "12.5%" and first["intro"] == "占比12.5%、5%与112.X%，7.x%" and first["sections"][0]["heading"] == "8.35元/股" and first["changed"] == ["percent", "price"]
    priced = next(r for r in out if r["facts"] == facts[0] and r["intro"].startswith("价"))
    assert priced["intro"] == "价8.35元/股，每股8.35元，再9元/股"
    assert next(r for r in out if r["facts"] == facts[0] and r["intro"].startswith("总"))["intro"] == "总金额上限约9,000元与总金额上限约9,000元"
    assert all(r["changed"] == [] for r in out if not r["facts"])


def test_titles_fit(spark):
    df = spark.createDataFrame([("上海市星河（科技）股份有限公司", "东方材料有限公司", "现金"), ("公司", None, ""), ("A" * 50, "B" * 50, "要约 现金")], "a string, t string, f string")
    got = [r[0] for r in df.select(repairs.fitted_title(F.col("a"), F.col("t"), repairs.focus(F.col("f")))).collect()]
    assert got == ["上海星河科技收购东方材料：现金支付与业务承接", "公司收购：披露边界下的交易结构", "A" * 10 + "收购" + "B" * 10 + "：要约与控制权安排"]
    assert [r[0] for r in df.select(repairs.fitted_title(F.col("a"), F.col("t"), F.lit("很长" * 30))).collect()][2] == "AAAA收购BBBB：控制权安排"


def test_answers_of_failing_models(spark):
    items = spark.createDataFrame([(i, f"t{i}") for i in range(57)], "id int, text string").repartition(7)

    def model(number, rows):
        assert list(rows["id"]) == sorted(rows["id"]) and list(rows.columns) == ["id", "text"]
        if number == 1:
            raise RuntimeError("busy")
        if number == 2:
            return None
        if number == 3:
            return "{\"cases\": \"no list\"}"
        if number == 4:
            return "sorry"
        if number == 5:
            return "{\"cases\": []}"
        return json.dumps({"cases": [{"id": int(i), "more": {"a": 1}} for i in rows["id"]] + [3, None, "x"]})

    out = answers.model_records(items, "id", model, "cases", "id int, more string", size=10, most=4).orderBy("batch", "place").collect()
    assert [(r["batch"], r["place"], r["id"]) for r in out if r["error"] is None] == [(0, k, k) for k in range(4)]
    assert {r["batch"]: (r["error"], r["tried"]) for r in out if r["error"]} == {1: ("RuntimeError: busy", 2), 2: ("TypeError: the model gave no text", 2), 3: ("cases is no list", 1), 4: ("no JSON object", 1)}
    assert json.loads(out[0]["more"]) == {"a": 1}
    assert answers.model_records(items.limit(0), "id", model, "cases", "id int").count() == 0


def test_plans_are_capped(spark):
    plan = {"core_question": "问" * 20, "depth_angles": [f" 角度{i} " for i in range(9)] + ["角度1"], "central_thesis": None}
    df = spark.createDataFrame([("说明 " + json.dumps(plan),), (None,), ("{}",)], "answer string")
    first, *others = answers.with_plan(df, "answer").collect()
    assert first["plan"]["depth_angles"] == [f"角度{i}" for i in range(6)] and "short_core_question" not in first["issues"] and "short_central_thesis" in first["issues"]
    assert all(len(r["issues"]) == 7 for r in others)


@pytest.mark.parametrize("text", ["a. b.c", "一。二！三", "x\n\ny", "", None])
def test_sentences(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(lengths.sentences(F.col("t"))).first()[0]
    assert got == _sentences(text)
