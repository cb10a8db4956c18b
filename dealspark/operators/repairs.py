"""Articles set right against the facts of their case: rewrites of nested columns in a fixed order, with a trace of those that changed something."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealspark.functions import vocab as V
from dealspark.functions.cjk import compact_name
from dealspark.functions.signals import or_else
from dealspark.operators.articles import size

_SHARE = "(?:元/股|港元/股|美元/股)"
_OPEN_PERCENT = r"[0-9]{1,3}\.[xX]+%"
_AMOUNT = "[0-9]{1,3}(?:,[0-9]{3})+元"


def _first(text: Column, pattern: str, new: Column) -> Column:
    """The text with the first match replaced; as it is where the new value is null."""
    return F.coalesce(F.regexp_replace(text, F.lit(f"(?s)^(?<head>.*?){pattern}"), F.concat(F.lit("${head}"), new)), text)


def with_percents(text: Column, facts: Column) -> Column:
    """Open percentages (12.x%) with the first percentage of the facts that has this whole part; left open without one."""
    known = F.regexp_extract_all(facts, F.lit(r"([0-9]{1,3}(?:\.[0-9]+)?%)"), 1)

    def value(found: Column, whole: Column) -> Column:
        return F.coalesce(F.get(F.filter(known, lambda k: F.startswith(k, F.concat(whole, F.lit("."))) | (k == F.concat(whole, F.lit("%")))), F.lit(0)), found)

    values = F.transform(F.regexp_extract_all(text, F.lit(f"({_OPEN_PERCENT})"), 1), lambda p: value(p, F.substring_index(p, ".", 1)))
    return F.array_join(F.flatten(F.zip_with(F.split(text, _OPEN_PERCENT), values, lambda a, b: F.array(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))), "")


def with_prices(text: Column, facts: Column) -> Column:
    """The first price a share, in both wordings and with all its digits, as the first one that the facts state."""
    price = F.nullif(F.regexp_extract(facts, rf"[0-9]{{1,3}}(?:\.[0-9]{{1,4}})?{_SHARE}", 0), F.lit(""))
    plain = F.regexp_extract(price, r"^[0-9]{1,3}(?:\.[0-9]{1,4})?", 0)
    return _first(_first(text, rf"[0-9]+(?:\.[0-9]+)?{_SHARE}", price), r"每股[0-9]+(?:\.[0-9]+)?元", F.concat(F.lit("每股"), plain, F.lit("元")))


def with_limits(text: Column, facts: Column) -> Column:
    """Total amounts as the upper limit that the facts state: every one of a text, so that a second pass finds none."""
    limit = F.nullif(F.regexp_extract(facts, f"金额上限约({_AMOUNT})", 1), F.lit(""))
    return F.coalesce(F.regexp_replace(text, F.lit(f"总金额约?{_AMOUNT}"), F.concat(F.lit("总金额上限约"), limit)), text)


#: Rewrites in order. No rewrite makes text that another one reads, and each leaves nothing that it would read itself, so one pass is a fixed point.
REWRITES: tuple[tuple[str, Callable[[Column, Column], Column]], ...] = (("percent", with_percents), ("price", with_prices), ("limit", with_limits))


def focus(text: Column) -> Column:
    """What a deal turns on, by the first kind of words found."""
    out = F.lit(V.FOCUS_OTHERWISE)
    for words, label in reversed(V.FOCUS):
        found = F.lit(False)
        for word in words:
            found = found | F.contains(text, F.lit(word))
        out = F.when(found, F.lit(label)).otherwise(out)
    return out


def short_alias(name: Column) -> Column:
    """A party's name for titles: without legal form, brackets and quotes."""
    name = F.trim(F.coalesce(name, F.lit("")))
    bare = F.trim(F.regexp_replace(name, "(?:股份有限公司|有限责任公司|有限公司|公司)$", ""))
    out = F.regexp_replace(or_else(bare, or_else(compact_name(name), name)), "[（）()\"“”'‘’]", "")
    for long, short in V.SHORT_CITIES:
        out = F.replace(out, F.lit(long), F.lit(short))
    return F.trim(out)


def fitted_title(acquirer: Column, target: Column, about: Column, most: int = 40) -> Column:
    """A title of both parties and what the deal turns on, with the longest aliases that fit; a set ending if none does."""
    titles = lambda n, end: F.concat(F.substring(short_alias(acquirer), 1, n), F.lit("收购"), F.substring(short_alias(target), 1, n), F.lit("："), end)
    made = F.array(*[titles(n, about) for n in (10, 8, 6, 4)])
    return F.coalesce(F.get(F.filter(made, lambda t: size(t) <= most), F.lit(0)), titles(4, F.lit(V.FOCUS_SHORT)))


def repaired(articles: DataFrame, facts: str) -> DataFrame:
    """Articles (title, intro, sections) with every text rewritten by the facts (a text column) of their case, and ``changed``: the rewrites that did something.

    Null texts are empty, null facts change nothing. The other columns stay; a second pass changes nothing.
    """
    known, out, traces = F.coalesce(F.col(facts), F.lit("")), articles, []
    for name, rewrite in REWRITES:

        def new(text: Column) -> Column:
            return rewrite(F.coalesce(text, F.lit("")), known)  # noqa: B023: used in this turn only

        sections = F.transform("sections", lambda s: F.struct(new(s["heading"]).alias("heading"), F.transform(s["paragraphs"], new).alias("paragraphs")))
        before = F.struct(F.coalesce("title", F.lit("")), F.coalesce("intro", F.lit("")), F.transform("sections", lambda s: F.struct(F.coalesce(s["heading"], F.lit("")).alias("heading"), F.transform(s["paragraphs"], lambda p: F.coalesce(p, F.lit(""))).alias("paragraphs"))))
        out = out.withColumn("__new", F.struct(new(F.col("title")).alias("title"), new(F.col("intro")).alias("intro"), sections.alias("sections")))
        same = F.to_json(before) == F.to_json(F.struct(*[F.col(f"__new.{c}").alias(f"col{i}") for i, c in enumerate(("title", "intro", "sections"), 1)]))
        out = out.withColumn(f"__{name}", F.when(~same, F.lit(name))).withColumns({c: F.col(f"__new.{c}") for c in ("title", "intro", "sections")}).drop("__new")
        traces.append(f"__{name}")
    return out.withColumn("changed", F.array_compact(F.array(*traces))).drop(*traces)
