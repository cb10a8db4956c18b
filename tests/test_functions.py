"""Expressions and operators on fixtures that the driver tables lack: CJK text, odd URLs and dates, ties, nulls."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dealspark.functions import dates, text, urls
from dealspark.operators import dedupe, expectations, joins, selection
from dealspark.streaming import windows


def values(spark, expression, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_normalize_text(spark):
    assert values(spark, text.normalize_text, ["  A&nbsp;B　C&amp;D \n", None, ""]) == ["a b c&d", "", ""]


def test_compact_match_text_keeps_ideographs(spark):
    assert values(spark, text.compact_match_text, ["甲公司 A-1（收购）", None]) == ["甲公司a1收购", ""]


def test_placeholders(spark):
    assert values(spark, text.is_placeholder, [" - ", "未披露", "N/A", None, "12亿元"]) == [True, True, True, True, False]


def test_party_loses_legal_form_and_remarks(spark):
    strip = lambda c: text.normalize_party(c, ["股份有限公司", "有限公司", r"\binc\b"])
    assert values(spark, strip, ["甲乙股份有限公司（SZ:000001）", "Acme, Inc", "未披露", None]) == ["甲乙", "acme", "", ""]


def test_sentences(spark):
    assert values(spark, lambda c: text.sentences(c, 3), ["甲收购乙。完成了！No"]) == [["甲收购乙。", "完成了！"]]


def test_redaction_and_cells(spark):
    assert values(spark, text.redact, ["mail a.b@c.org now", "Bearer abc.DEF", None]) == ["mail [redacted] now", "Bearer [redacted]", None]
    assert values(spark, text.safe_cell, ["=1+1", "a=1"]) == ["'=1+1", "a=1"]


def test_normalize_url(spark):
    found = values(spark, urls.normalize_url, ["HTTPS://Example.ORG/A?utm_source=x&b=1&UTM_c=2#f", "no url", None, "http://h/p?"])
    assert found == ["https://example.org/A?b=1", "no url", "", "http://h/p"]


def test_homepages_and_suffixes(spark):
    assert values(spark, urls.is_homepage, ["http://a.b/", "http://a.b/index.html", "http://a.b/x", "http://a.b/?q=1"]) == [True, True, False, False]
    under = lambda c: urls.host_under(c, ("sec.gov",))
    assert values(spark, under, ["https://www.sec.gov/x", "https://sec.gov.evil.com", "https://xsec.gov/"]) == [True, False, False]


def test_wrapped_and_token_urls(spark):
    inner = lambda c: urls.parameter(c, ("url", "u"))
    assert values(spark, inner, ["http://r/x?u=https%3A%2F%2Fa.b%2Fc", "http://r/x?u=%zz", "http://r/"]) == ["https://a.b/c", None, None]
    assert values(spark, urls.token_url, ["CBMiaHR0cHM6Ly9hLmIvYw==", "!!", None]) == ["https://a.b/c", None, None]


def test_identity_key(spark):
    assert values(spark, urls.identity_key, ["https://A.b//X/?q=1#f", "https://a.b/", None]) == ["a.b/x", None, None]


def test_page_text_and_links(spark):
    html = '<html><script>x</script><link rel="canonical" href="https://a.b/c"><p>One&nbsp;two</p><!-- no --></html>'
    assert values(spark, urls.visible_text, [html, None]) == ["One two", ""]
    assert values(spark, urls.first_link, [html, None]) == ["https://a.b/c", None]


def test_times(spark):
    at = dt.datetime
    found = values(spark, lambda c: F.to_utc_timestamp(dates.parse_time(c), "UTC"), ["2026-09-04", "2026年9月4日", "2026/09/04", "Fri, 04 Sep 2026 05:00:00 GMT", "soon", None])
    assert found == [at(2026, 9, 4), at(2026, 9, 4), at(2026, 9, 4), at(2026, 9, 4, 5), None, None]
    now = F.lit("2026-09-04 06:00:00").cast("timestamp")
    assert values(spark, lambda c: dates.parse_relative(c, now), ["3小时前", "2 days ago", ""]) == [at(2026, 9, 4, 3), at(2026, 9, 2, 6), None]


def test_weekly_windows(spark):
    start = lambda c: dates.window_start(c.cast("timestamp_ntz"))
    assert values(spark, start, ["2026-09-04 05:00:00", "2026-09-04 04:59:59", "2026-09-04 06:30:00"]) == [dt.datetime(2026, 9, 4, 5), dt.datetime(2026, 8, 28, 5), dt.datetime(2026, 9, 4, 5)]
    assert dates.expected_windows(spark, "2026-08-07", "2026-09-04").count() == 4
    with pytest.raises(Exception, match="Fridays"):
        dates.expected_windows(spark, "2026-08-06", "2026-09-04").collect()


def test_first_wins_and_gates(spark):
    df = spark.createDataFrame([(2, "a"), (1, "a"), (3, None), (4, None)], "i int, k string")
    assert sorted(r["i"] for r in dedupe.first_wins(df, F.col("k"), ["i"]).collect()) == [1, 3]
    gates = [("no key", F.col("k").isNotNull()), ("late", F.col("i") < 2)]
    assert [r["g"] for r in df.orderBy("i").select(expectations.first_failing(gates).alias("g")).collect()] == ["accepted", "late", "no key", "no key"]


def test_containment_join(spark):
    words = " ".join(f"w{i}" for i in range(30))
    texts = spark.createDataFrame([(1, f"x{words}y"), (2, words.replace("w9", "q")), (3, ""), (4, None), (5, "is this too  short"), (6, "ab"), (7, "xx too short!")], "i int, t string")
    passages = spark.createDataFrame([(7, words), (8, "too short"), (9, "b"), (10, ""), (11, None), (12, "is this too  short"), (13, "a much longer passage than that"), (14, "w8 w9 w10 w11")], "j int, p string")
    got = {tuple(r) for r in joins.contained_in(texts, passages, "t", "p", "i", "j").collect()}
    assert got == {(i, j) for i, t in texts.collect() for j, p in passages.collect() if t and p and p in t}
    assert joins.contained_in(texts, passages.limit(0), "t", "p", "i", "j").count() == 0 == joins.contained_in(texts.limit(0), passages, "t", "p", "i", "j").count()


def test_lowest_within(spark):
    rng = random.Random(2)
    left = [(rng.randrange(3), rng.randrange(-300, 300)) for _ in range(60)]
    right = [(rng.randrange(3), rng.randrange(-300, 300), i) for i in range(80)]
    found = joins.lowest_within(spark.createDataFrame(left, "g int, v long"), spark.createDataFrame(right, "g int, v long, p int"), "g", "v", "p", 25)
    want = {(g, v): min(near) for g, v in left if (near := [p for h, w, p in right if h == g and abs(w - v) <= 25])}
    assert {(r["g"], r["v"]): r["lowest"] for r in found.collect()} == want


def test_manifests_match_by_path_name_or_title(spark):
    docs = spark.createDataFrame([(1, "a/x.docx", "甲收购乙报告"), (2, "b/y.docx", "nothing")], "id int, path string, stem string")
    records = spark.createDataFrame([(1, "a/x.docx", ""), (2, "old/y.docx", None), (3, None, "收购乙"), (4, "z.docx", "丙"), (5, None, "")], "record int, file string, name string")
    assert {tuple(r) for r in joins.manifest_matches(docs, records).collect()} == {(1, 1), (2, 2), (1, 3)}


@pytest.mark.parametrize("rows", [[], [(1,)]])
def test_fallback_union(spark, rows):
    first, second = spark.createDataFrame(rows, "i int"), spark.createDataFrame([(8,), (9,)], "i int")
    assert sorted(r["i"] for r in joins.fallback_union(first, second).collect()) == ([1] if rows else [8, 9])


def test_global_position(spark):
    keys = [9000, 1, 5000, 4095, 4096, *(hash(str(i)) % 2**62 for i in range(500))]  # dense and sparse
    placed = selection.global_position(spark.createDataFrame([(k,) for k in keys], "k long"), "k")
    assert [r["position"] for r in placed.orderBy("k").collect()] == list(range(len(keys)))
    assert selection.global_position(spark.createDataFrame([], "k long"), "k").count() == 0


def test_stream_counts_events_once(spark, tmp_path):
    rows = [(1, dt.datetime(2026, 9, 4, 5), "a"), (1, dt.datetime(2026, 9, 4, 5), "a"), (2, dt.datetime(2026, 9, 4, 4, 59), "a")]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string").write.parquet(str(tmp_path / "events"))
    found = {(r["start"], r["n"]) for r in windows.counted_once(spark, str(tmp_path / "events")).collect()}
    assert found == {(dt.datetime(2026, 9, 4, 5), 1), (dt.datetime(2026, 8, 28, 5), 1)}
