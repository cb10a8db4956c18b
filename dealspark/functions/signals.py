"""Signals of deal disclosures as native expressions: numbers, terms, status, parties, sources."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealspark.functions import text as T
from dealspark.functions import urls as U
from dealspark.functions import vocab as V


def words_pattern(words: Sequence[str]) -> str:
    """A pattern that finds any of the words as they stand."""
    return "|".join(re.escape(w).replace("\\ ", " ").replace("\\-", "-") for w in words)


def has_any(text: Column, words: Sequence[str]) -> Column:
    return matches(text, words_pattern(words))


def matches(text: Column, pattern: str) -> Column:
    return F.rlike(F.coalesce(text, F.lit("")), F.lit(pattern))


def clean(text: Column) -> Column:
    """White space collapsed; null becomes empty."""
    return T.collapse_space(F.coalesce(text, F.lit("")))


def lines(*values: Column) -> Column:
    return F.concat_ws("\n", *[F.coalesce(v, F.lit("")) for v in values])


def is_weak_disclosure(text: Column) -> Column:
    """Missing, or little more than that nothing was disclosed."""
    return T.bound(clean(text), lambda bare: bare.isin("", "-", "未披露", "公开资料未披露", "未知", "不详", "无") | F.contains(bare, F.lit("未披露")) & (F.length(bare) < 30))


def has_deal_number(text: Column) -> Column:
    return ~T.is_placeholder(clean(text)) & matches(clean(text), V.DEAL_NUMBER)


def has_deal_value(text: Column) -> Column:
    """A quantity with its unit, or a word of the deal's structure."""
    return ~T.is_placeholder(clean(text)) & (matches(clean(text), V.DEAL_VALUE) | matches(clean(text), f"(?i){V.STRUCTURE}"))


def is_completed(text: Column) -> Column:
    """Completed beyond doubt, or completed without a sign of the contrary."""
    bare = F.lower(clean(text))
    return matches(bare, "|".join(V.FIRM_COMPLETED)) | matches(bare, "|".join(V.COMPLETED)) & ~matches(bare, "|".join(V.INCOMPLETE))


def is_incomplete(text: Column) -> Column:
    return matches(F.lower(clean(text)), "|".join(V.INCOMPLETE))


def is_unresolved(text: Column) -> Column:
    return is_incomplete(text) & ~is_completed(text)


def parse_bool(text: Column, default: bool = False) -> Column:
    bare = F.lower(clean(text))
    return F.when(bare.isin(*V.TRUE_WORDS), True).when(bare.isin(*V.FALSE_WORDS), False).otherwise(F.lit(default))


def is_vague_party(name: Column) -> Column:
    """Fewer than two characters, a bare ticker mark, or a word that names nobody."""

    def vague(bare: Column) -> Column:
        mark = F.lower(F.regexp_replace(bare, r"[^A-Za-z0-9\x{4e00}-\x{9fa5}]", ""))
        return (F.length(bare) < 2) | mark.isin("st", "xst", "sst") | has_any(bare, V.VAGUE_PARTIES)

    return T.bound(F.trim(F.coalesce(name, F.lit(""))), vague)


def split_parties(name: Column, verbs: Sequence[str] = V.DEAL_VERBS) -> tuple[Column, Column]:
    """What stands before and after the first deal verb; both empty without one."""
    parts = F.split(F.coalesce(name, F.lit("")), words_pattern(verbs), 2)
    two = F.size(parts) == 2
    return F.when(two, F.trim(parts[0])).otherwise(""), F.when(two, F.trim(F.get(parts, F.lit(1)))).otherwise("")


def or_else(value: Column, other: Column) -> Column:
    """The value unless it is null or empty."""
    return F.when(F.coalesce(value, F.lit("")) != "", value).otherwise(other)


def has_explicit_parties(name: Column, acquirer: Column, target: Column) -> Column:
    a, t = split_parties(name)
    return ~is_vague_party(or_else(acquirer, a)) & ~is_vague_party(or_else(target, t)) & ~has_any(lines(name, acquirer, target), V.VAGUE_PARTIES)


def is_denied(text: Column, terms: str) -> Column:
    """Whether the text holds a term of a list parted by commas, semicolons or line ends."""
    found = [t.strip().lower() for t in re.split(r"[,，;；\n]+", terms) if t.strip()]
    return has_any(F.lower(text), found) if found else F.lit(False)


def is_domestic(region: Column) -> Column:
    return has_any(region, V.DOMESTIC)


def inferred_category(text: Column) -> Column:
    """The first category rule that applies, some of which read lower case; else the default one."""
    normal, out = T.normalize_text(text), F.lit(V.DEFAULT_CATEGORY)
    for words, lower, category in reversed(V.CATEGORY_RULES):
        out = F.when(has_any(normal if lower else text, words), category).otherwise(out)
    return out


def safe_category(value: Column) -> Column:
    """The category itself, else the first one that the value holds, else the default one."""
    out = F.lit(V.DEFAULT_CATEGORY)
    for category in reversed(V.CATEGORIES):
        out = F.when(F.contains(F.coalesce(value, F.lit("")), F.lit(category)), category).otherwise(out)
    return F.when(value.isin(*V.CATEGORIES), value).otherwise(out)


def completed_year(text: Column) -> Column:
    """A year from 2010 to 2026 that the text holds: 2026 and 2025 before others, then the first; else empty."""
    years = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(20(?:2[0-6]|1[0-9]))"), F.lit(1))
    return F.when(F.array_contains(years, "2026"), "2026").when(F.array_contains(years, "2025"), "2025").otherwise(F.coalesce(F.get(years, F.lit(0)), F.lit("")))


def distinct_matches(text: Column, pattern: str, limit: int, group: int = 0) -> Column:
    """The first distinct matches in order."""
    return F.slice(F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(group))), 1, limit)


def transaction_terms(*values: Column) -> Column:
    """At most six amounts, then the labels of the terms that the values name: eight in all, parted by semicolons."""

    def told(text: Column) -> Column:
        both, labels = V.TERMS[2][0], []
        for pattern, label in V.TERMS:
            found = matches(text, f"(?i){pattern}")
            labels.append(F.when(found & ~matches(text, both) if label == "股份支付" else found, label))
        return F.array_join(F.slice(F.concat(distinct_matches(text, V.DEAL_VALUE, 6), F.filter(F.array(*labels), lambda x: x.isNotNull())), 1, 8), "；")

    return T.bound(clean(F.concat_ws("；", *[F.when(~T.is_placeholder(clean(v)), v) for v in values])), told)


def percents(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([0-9]+(?:\.[0-9]+)?)\s*%"), F.lit(1)), lambda x: x.cast("double"))


def percent_label(value: Column) -> Column:
    """A percentage without closing zeros, or empty."""
    return F.coalesce(F.concat(F.regexp_replace(F.regexp_replace(F.format_number(value, 4), ",", ""), r"\.?0+$", ""), F.lit("%")), F.lit(""))


def largest_percent(text: Column) -> Column:
    return percent_label(F.array_max(percents(text)))


def transfer_percent(text: Column) -> Column:
    """The share that a transfer is said to be of, by the first pattern that finds one."""
    head = F.substring(clean(text), 1, 7000)
    return percent_label(F.coalesce(*[F.nullif(F.regexp_extract(head, p, 1), F.lit("")).cast("double") for p in V.TRANSFER_PERCENTS]))


def share_prices(text: Column) -> Column:
    """At most three distinct prices a share: those that are named as such, else any."""
    tight = lambda bare, p: F.slice(F.array_distinct(F.transform(F.regexp_extract_all(bare, F.lit(p), F.lit(1)), lambda x: F.regexp_replace(x, r"\s", ""))), 1, 3)
    return T.bound(clean(text), lambda bare: T.bound(tight(bare, V.SHARE_PRICE), lambda named: F.when(F.size(named) > 0, named).otherwise(tight(bare, V.ANY_SHARE_PRICE))))


def share_counts(text: Column) -> Column:
    return distinct_matches(clean(text), V.SHARE_COUNT, 3, 1)


def verified_amount(price: Column, count: Column) -> Column:
    """Price times shares in whole units with commas; halves go to the even number."""
    value = F.regexp_extract(price, r"^([0-9.]+)", 1).cast("double") * F.regexp_replace(count, ",", "").cast("double")
    return F.format_number(F.bround(value, 0), 0)


def verified_value(value: Column, price: Column, count: Column) -> Column:
    """The value with its price a share replaced by the one that the evidence names, or with that price and the amount it makes added."""
    told = F.concat(F.lit("披露的每股价格为"), price)
    amount = F.concat(verified_amount(price, count), F.lit("元"))

    def priced(bare: Column) -> Column:
        old = F.regexp_extract(bare, r"([0-9]{1,4}(?:\.[0-9]+)?\s*(?:元/股|港元/股|美元/股)[0-9]?)(?:[，、。；\s]|$)", 1)
        replaced = T.bound(old, lambda x: F.when(x != "", F.concat(F.substr(bare, F.lit(1), F.instr(bare, x) - 1), price, F.substr(bare, F.instr(bare, x) + F.length(x)))).otherwise(bare))
        return F.when(matches(bare, V.ANY_SHARE_PRICE), replaced).otherwise(F.when(bare != "", F.concat(bare, F.lit("；"), told)).otherwise(told))

    def summed(text: Column) -> Column:
        return F.when(count.isNotNull() & ~F.contains(text, amount), F.concat(text, F.lit("；按"), count, F.lit("股和"), price, F.lit("测算，金额上限约"), amount)).otherwise(text)

    return T.bound(clean(value), lambda bare: F.when(price.isNull(), bare).otherwise(T.bound(priced(bare), summed)))


def completion_status(text: Column, published: Column) -> Column:
    """The first completion date that a text names, else the day it was published, and that the deal is done."""
    head = F.substring(F.coalesce(text, F.lit("")), 1, 5000)
    day = F.coalesce(*[F.nullif(clean(F.regexp_extract(head, f"(?s){p}", 1)), F.lit("")) for p in V.COMPLETION_DATES], F.nullif(F.split(published, "T")[0], F.lit("")))
    return F.concat(F.coalesce(F.concat(day, F.lit("；")), F.lit("")), F.lit("已完成过户/交割"))


def is_noisy_value(text: Column) -> Column:
    return T.bound(clean(text), lambda bare: (bare == "") | (F.length(bare) > 420) | has_any(bare, V.NOISY_VALUE))


def has_quantity(text: Column) -> Column:
    return matches(text, V.TRANSACTION_QUANTITY)


def has_payment(text: Column) -> Column:
    """A quantity of the transaction or a word of how it is paid."""
    return has_quantity(clean(text)) | has_any(clean(text), V.PAYMENT_HINTS)


def hostname(url: Column) -> Column:
    """Host without user, port and closing dot."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(U.host(url), r"^.*@", ""), r":[0-9]*$", ""), r"\.$", "")


def is_primary_source(url: Column) -> Column:
    """A web address of an authority, exchange or newswire, or of an investor page."""
    web = lambda u: F.when(matches(u, r"(?i)^https?://"), hostname(u)).otherwise("")
    named = lambda host: F.rlike(host, F.lit(r"^(?:.*\.)?(?:" + words_pattern(V.PRIMARY_DOMAINS) + ")$")) | F.split_part(host, F.lit("."), F.lit(1)).isin(*V.INVESTOR_LABELS)
    return T.bound(F.trim(url), lambda u: T.bound(web(u), named))


def is_media(url: Column, source_name: Column) -> Column:
    """Not primary, and of a news domain or a source named like one."""
    return ~is_primary_source(url) & (has_any(F.replace(U.host(url), F.lit("www."), F.lit("")), V.MEDIA_DOMAINS) | has_any(source_name, V.MEDIA_NAMES))


def stock_identity(text: Column, summary: Column) -> tuple[Column, Column]:
    """Full name (by three patterns) and short name of an issuer; a name that reads like a phrase is none."""
    text, form = F.coalesce(text, F.lit("")), "(?:股份有限公司|有限责任公司|有限公司)"
    head, name = F.substring(text, 1, 1200), r"[A-Za-z0-9\x{4e00}-\x{9fa5}（）()]"
    short = F.regexp_extract(F.concat_ws(" ", F.coalesce(summary, F.lit("")), F.substring(text, 1, 800)), r"证券简称[:：]\s*([^\s，。；;]+)", 1)
    patterns = (
        rf"(?i)^\s*([A-Za-z0-9\x{{4e00}}-\x{{9fa5}}（）()*\s]{{4,80}}{form})\s+关于",
        rf"(?s)证券代码[:：]\s*[0-9A-Za-z]+.*?证券简称[:：]\s*[^\s，。；;]+.*?({name}{{4,80}}{form})\s+关于",
        rf"({name}{{4,80}}{form})（以下简称[“\"]?(?:公司|[^”\"]{{2,12}})",
    )
    found = [T.bound(clean(F.regexp_extract(head, p, 1)), lambda x: F.when(x != "", x)) for p in patterns]
    return T.bound(F.coalesce(*found, F.lit("")), lambda full: F.when(matches(full, "协议转让|过户登记|通过协议"), "").otherwise(full)), short


def clean_party(value: Column) -> Column:
    """A party's name out of a sentence: without section titles, what leads to it, what follows it, and brackets."""
    out = F.trim(F.regexp_replace(clean(value), r"^(?:[一二三四五六七八九十]+[、.．]\s*)?(?:交易基本情况|本次交易的基本情况|股份过户登记的情况|其他说明)", ""))
    for marker in ("方式向", "的境内全资子公司", "境内全资子公司", "全资子公司", "向"):
        out = F.regexp_replace(out, f"(?s)^.*{marker}", "")
    out = F.split(out, r"（以下简称|以下简称|（代表|代表|及其一致行动人|承诺|于20[0-9]{2}|于\s*20[0-9]{2}|并|，|。|；|;|、", 2)[0]
    out = F.regexp_replace(out, r"^[ “”\"'（）()：:]+|[ “”\"'（）()：:]+$", "")
    out = T.bound(out, lambda x: F.when(F.rlike(x, F.lit("（有限合伙[^）]*$")), F.concat(x, F.lit("）"))).otherwise(x))
    out = F.trim(F.regexp_replace(out, r"^[（(]?[0-9]+[）)]", ""))
    out = F.trim(F.regexp_replace(out, "^(?:与|和|同|公司|本公司|控股股东|实际控制人|一致行动人|自然人)", ""))
    out = F.trim(F.regexp_replace(out, "(?:共同|进一步)$", ""))
    return T.bound(out, lambda x: F.when(F.rlike(x, F.lit(r"[\x{4e00}-\x{9fa5}]")), F.regexp_replace(x, T.SPACE, "")).otherwise(x))


def alias_map(text: Column) -> Column:
    """Full names by the short names that a text declares for them; the last declaration of a name holds."""
    pattern = r"([A-Za-z0-9\x{4e00}-\x{9fa5}（）()\s]{4,90}(?:股份有限公司|有限责任公司|有限公司|合伙企业（有限合伙）|合伙企业\(有限合伙\)|基金))（以下简称[“\"]([^”\"]{2,20})[”\"]"
    head = F.substring(F.coalesce(text, F.lit("")), 1, 5000)
    pairs = F.arrays_zip(F.regexp_extract_all(head, F.lit(pattern), F.lit(2)).alias("k"), F.regexp_extract_all(head, F.lit(pattern), F.lit(1)).alias("v"))
    return F.aggregate(F.transform(pairs, lambda p: F.create_map(clean(p["k"]), clean_party(p["v"]))), F.create_map().cast("map<string,string>"), lambda m, x: F.map_from_entries(F.concat(F.map_entries(F.map_filter(m, lambda k, v: ~F.array_contains(F.map_keys(x), k))), F.map_entries(x))))


def resolve_alias(name: Column, aliases: Column) -> Column:
    return T.bound(clean_party(name), lambda x: F.coalesce(F.try_element_at(aliases, x), x))


def buyer(text: Column, aliases: Column) -> Column:
    """The buyer that the first fitting pattern of a transfer names, by its full name; empty without a fit."""
    name = r"[A-Za-z0-9\x{4e00}-\x{9fa5}（）()·\s]"
    patterns = (
        rf"(?:公司控股股东|公司的控股股东|控股股东)(?:由[^，。；]{{1,80}})?变更为({name}{{2,100}}?)(?:，|。|；|,|;|$)",
        rf"({name}{{2,100}}?)(?:将成为|成为)(?:上市公司|公司)?控股股东",
        rf"(?:转让方|控股股东|实际控制人|股东)[^。；]{{0,120}}?向([A-Za-z0-9\x{{4e00}}-\x{{9fa5}}（）()·\s、]{{2,140}}?)(?:转让|协议转让)",
        r"转让给([A-Za-z0-9\x{4e00}-\x{9fa5}（）()·\s、]{2,120}?)(?:，|。|；|,|;|股份|$)",
        rf"受让方[）)]?\s*(?:为|系|：|:)\s*({name}{{2,100}}?)(?:，|。|；|,|;|$)",
        rf"与({name}{{2,120}}?)(?:签订|签署).*?(?:股份转让|股权转让)",
        rf"(?:公司实际控制人|实际控制人)[^。；]{{0,60}}变更为({name}{{2,100}}?)(?:，|。|；|,|;|$)",
    )
    odd = "^(?:其|本次|上述|公司|上市公司|在)|持有公司|股份协议|过户登记|转让事项|受让方|转让方|证券过户"

    def fitting(head: Column, known: Column, pattern: str) -> Column:
        named = T.bound(F.regexp_extract(head, pattern, 1), lambda x: F.when(x != "", resolve_alias(x, known)))
        return T.bound(named, lambda x: F.when(x.isNotNull() & ~is_vague_party(x) & ~matches(x, odd), x))

    # one pattern after the other: those behind the first that fits aren't tried
    read = F.struct(F.substring(clean(text), 1, 5000).alias("head"), aliases.alias("known"))
    return T.bound(read, lambda r: F.coalesce(*[fitting(r["head"], r["known"], p) for p in patterns], F.lit("")))


def sentences_with(text: Column, words: Sequence[str], limit: int = 4) -> Column:
    """The first sentences that hold a word, at most 900 characters."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), "(?<=[。；;])"), clean)
    return F.substring(F.array_join(F.slice(F.filter(parts, lambda p: (p != "") & has_any(p, words)), 1, limit), "；"), 1, 900)


def json_object(text: Column) -> Column:
    """The JSON object inside a model's answer, null if there is none.

    It is what lies between the first and the last brace, in a code fence if there is one; where that is no JSON, closing commas
    are dropped, missing ones before a key are set, and single typographic quotes made plain. Double ones are left: they are text.
    """
    bare = F.coalesce(text, F.lit(""))
    bare = F.coalesce(F.nullif(F.regexp_extract(bare, r"(?is)```(?:json)?\s*(.*?)\s*```", 1), F.lit("")), bare)
    span = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    fixed = F.regexp_replace(F.translate(span, "‘’\ufeff\x00", "''"), r',(\s*[}\]])', "$1")
    fixed = F.regexp_replace(fixed, r'([}\]"])(\s*)("[A-Za-z_][A-Za-z0-9_\-]*"\s*:)', "$1,$2$3")
    valid = lambda c: F.when(F.try_parse_json(c).isNotNull() & (c != ""), c)
    return F.coalesce(valid(span), valid(fixed))
