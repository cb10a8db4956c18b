"""Page texts against the standard library's parser, names against a plain scan."""

import random
import time
from html.parser import HTMLParser

import duckdb
import pytest
from pyspark.sql import functions as F

from dealspark import catalogue
from dealspark.functions import pages
from dealspark.operators import names


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.stack, self.pieces, self.links = [], [], []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"].strip())
        if tag not in pages.VOID:
            self.stack.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in pages.VOID:
            self.stack.pop()

    def handle_endtag(self, tag):
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass

    def handle_data(self, data):
        if not pages.HIDDEN & set(self.stack):
            self.pieces.append(data)


def plain(page):
    p = Plain()
    p.feed(page)
    p.close()
    return " ".join(" ".join(p.pieces).split()), p.links


@pytest.mark.parametrize("seed", range(4))
def test_pages_read_like_the_standard_parser(seed):
    rng = random.Random(seed)
    parts = ["<p>", "</p>", "<div class='a b'>", "</div>", "text ", "a &amp; b", "&copy;&nbsp;&eacute;x", "&amp", "&#233;&#x4e2d;", "<br>", "<br/>", "<b>", "</b>", "<!-- <p>no</p> -->", '<a href="/x?a=1&amp;b=2">', "</a>", "<a href=plain>", "<A HREF = 'Q'>", "<svg><text>no</text></svg>", "<noscript>no", "</noscript>", "<script>if (a<b) '</p>'</script>", "<style>p{}</style>", "1 < 2 ", "<article>", "</article>", "<main>", "</main>", "<img src='x' alt=\"<b>\">", "<!DOCTYPE html>", "<?pi x>", "</>", "é中 ", "<iframe/>", "<li><li>"]
    for _ in range(300):
        page = "".join(rng.choices(parts, k=rng.randint(0, 30))) + "."
        got = pages.read_page(page)
        assert (" ".join(got["text"].split()), got["links"]) == plain(page), page


def test_matter_title_and_named_addresses():
    page = "<html><head><title>A &lt; B</title><link rel='Canonical' href=' https://e.org/c '><meta property='og:url' content='https://e.org/o'></head><body><nav>menu</nav><article>short</article><main><article>" + "long text " * 30 + "</article>tail</main><svg><title>no</title></svg>"
    got = pages.read_page(page)
    assert got["title"] == "A < B" and got["canonical"] == "https://e.org/c" and got["og_url"] == "https://e.org/o"
    assert got["matter"].split()[-1] == "tail" and "menu" not in got["matter"] and "menu" in got["text"]
    assert pages.read_page("<article>few words</article>")["matter"] is None
    assert pages.read_page(None)["text"] == "" and pages.read_page("a<b")["text"] == "a" and pages.read_page("<script>x")["text"] == ""


@pytest.mark.parametrize("unit", ["<script ", "<a x=\"", "<a x='<b>\" ", "<!--", "</a", "<p><b>", "</p>", "<", "&amp", "<script>", "<!", "<a\n/", "a=", "<noscript>"])
def test_a_megabyte_of_broken_markup_is_linear(unit):
    began = time.perf_counter()
    pages.read_page(unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - began < 20


def test_pages_on_spark(spark):
    rows = [(1, "https://e.org/d/p.html?x", "<a href='q.html'>a</a><a href='/r'>b</a><a href='//o.org/s'>c</a><a href='#t'>d</a><a href='mailto:x'>e</a><a href='https%3A%2F%2Fu.org%2Fv'>f</a>"), (2, None, None), (3, "https://e.org", "<a href='z'>"), (4, "x", "<link rel=canonical href='https://e.org/'><a href='https://w.org/a'>")]
    df = spark.createDataFrame(rows, "id int, url string, html string").select("id", "url", pages.read_pages(F.col("html")).alias("read"))
    usable = lambda x: F.rlike(x, F.lit("^https?://[^/]+/."))
    got = {r["id"]: r for r in df.select("id", F.transform("read.links", lambda x: pages.absolute(x, F.col("url"))).alias("links"), pages.original_link(F.col("read"), usable).alias("link")).collect()}
    assert got[1]["links"] == ["https://e.org/d/q.html", "https://e.org/r", "https://o.org/s", None, None, "https://e.org/d/https%3A%2F%2Fu.org%2Fv"] and got[1]["link"] == "https://u.org/v"
    assert got[2]["links"] == [] and got[2]["link"] is None and got[3]["links"] == ["https://e.org/z"] and got[4]["link"] == "https://w.org/a"


def test_pages_equal_their_sql_on_cut_references(spark, tmp_path):
    """References without a semicolon, others than those of the SQL, and a matter of many small pieces read as the SQL reads them."""
    cut = "a = &quot</h1><p>b = &quot;9c&quot x &am &copy &copy; &middot &middot; &amp;quot; &ampquot; &lt; &#233; &eacute;</p>"
    rows = [(1, f"<title>t = &quot</title><article><h1>{cut}{'long text ' * 40}</article><a href=\"/q?a=1&amp;b=&quot&copy=2&ampc\">l</a>"), (2, "<article>" + "<p>abc</p>" * 70 + "</article>"), (3, f"<title>&copy</title><article>{cut}</article>"), (4, None)]
    spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.lit("https://e.org/d/p")).coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    for name in ("page_text", "page_links"):
        with duckdb.connect() as base:
            base.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
            expected = base.execute(catalogue.ORACLES[name]).fetchall()
        assert sorted(tuple(r) for r in catalogue.QUERIES[name](spark, str(tmp_path)).collect()) == sorted(expected) != []


def scan(listed, text, whole_words):
    """Leftmost, then longest, by trying every name at every place."""
    out, at = [], 0
    word = lambda c: c.isalnum() or c == "_"
    while at < len(text):
        fits = [n for n in listed if text.startswith(n, at)]
        if whole_words:
            fits = [n for n in fits if not (at and word(n[0]) and word(text[at - 1])) and not (at + len(n) < len(text) and word(n[-1]) and word(text[at + len(n)]))]
        else:
            fits = [n for n in fits if len(n) > names.WHOLE or not (at and word(n[0]) and word(text[at - 1])) and not (at + len(n) < len(text) and word(n[-1]) and word(text[at + len(n)]))]
        if fits:
            best = max(fits, key=len)
            out.append((at, at + len(best), best))
            at += len(best)
        else:
            at += 1
    return out


@pytest.mark.parametrize("whole_words", [True, False])
def test_matches_equal_a_plain_scan(whole_words):
    rng = random.Random(3)
    for _ in range(2000):
        listed = tuple(sorted({"".join(rng.choices("ab 中_", k=rng.randint(1, 7))) for _ in range(rng.randint(1, 8))}))
        text = "".join(rng.choices("ab 中_", k=rng.randint(0, 60)))
        assert [(s, e, listed[i]) for s, e, i in names.matches(listed, text, whole_words)] == scan(listed, text, whole_words), (listed, text)


def test_notes_at_first_mentions(spark):
    listed = spark.createDataFrame([("Alpha Works", "(AW)"), ("Alpha Works Holding", "(AWH)"), ("Beta", "(B)"), ("Beta", "(Z)"), (None, "x"), ("", "y")], "name string, note string")
    own = names.Names(listed, note="note")
    rows = [(1, ["Alpha Works Holding(AWH) buys Beta.", None, "", "Beta(B)(B) and Alpha Works; Betatron"]), (2, None), (3, []), (4, ["Alpha Works(AW)(AW) Alpha Works(AW)"])]
    df = spark.createDataFrame(rows, "id int, parts array<string>")
    got = {r["id"]: r for r in df.select("id", own.annotate(F.col("parts")).alias("out"), own.mentions(F.col("parts")).alias("m"), own.annotate(own.annotate(F.col("parts"))).alias("again"), own.any_of(F.get("parts", 0)).alias("any")).collect()}
    assert got[1]["out"] == ["Alpha Works Holding(AWH) buys Beta(B).", None, "", "Beta and Alpha Works(AW); Betatron"]
    assert got[2]["out"] is None and got[3]["out"] == [] and got[4]["out"] == ["Alpha Works(AW) Alpha Works"]
    assert {(m["name"], m["mentions"], m["paragraph"]) for m in got[1]["m"]} == {("Alpha Works Holding", 1, 0), ("Beta", 2, 0), ("Alpha Works", 1, 3)}
    assert all(r["again"] == r["out"] for r in got.values()) and got[4]["any"]
