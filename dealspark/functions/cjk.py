"""Native clean-up of mixed Chinese and Latin text: spacing, punctuation, numbers, notes, names, headings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealspark.functions import text as T
from dealspark.functions import vocab as V
from dealspark.functions.signals import clean, matches, or_else, split_parties, words_pattern

_ALNUM, _OPEN, _CLOSE, _STOP = "A-Za-z0-9", "（【《", "）】》", "，。；：？！、）】》"
#: A blank that doesn't belong where it stands. Runs of white space are one blank by then, so one pass finds all. The patterns here begin with
#: the sign they look for and look behind it afterwards, so that nothing is looked up at the places between.
STRAY_BLANK = (
    f" (?:(?<=[{V.CJK}] )(?=[{V.CJK}{_ALNUM}])|(?<=[{_ALNUM}] )(?=[{V.CJK}])|(?=[{_STOP}])|(?<=[{_OPEN}] )|(?<=[{_CLOSE}] )(?=[{V.CJK}{_ALNUM}])"
    f"|(?<=[{V.CJK}{_ALNUM}] )(?=[{_OPEN}])|(?<=[0-9] )(?=[%％]))"
)
_UNITS = words_pattern(V.QUANTITY_UNITS)
#: A whole number of four digits or more before a unit, and the places in it where commas go.
BARE_QUANTITY = rf"[0-9]{{4}}(?<![0-9.,][0-9]{{4}})[0-9]*(?![0-9.,])(?=\s*(?:{_UNITS}))"
_COMMA_PLACE = rf"(?=(?:[0-9]{{3}})+(?![0-9.,])\s*(?:{_UNITS}))(?<=(?<![0-9.,])[1-9][0-9]{{0,40}})"
NOTE = "（下称“[^”]+”(?:，[^）]+)?）"
_FORMS = "(?:科技有限公司|股份有限公司|有限责任公司|娱乐集团|有限公司|集团|公司)"
_WORD = rf"[{V.CJK}A-Za-z0-9·&]"
SPLIT_NOTE = rf"({_WORD}+)（下称“([^”]+)”(?:，[^）]+)?）(?!收购|并购|购买|出售|转让|受让|入股|控股|合并|与|和|及|、|，|,)({_WORD}{{0,12}}{_FORMS})"
DESCRIBED_NOTE = (
    "(特殊目的收购公司|SPAC公司|空白支票公司|目标公司|标的公司|收购方|并购方|买方|卖方|移动数据分析公司|数据分析公司|上市公司|公司|企业)" + NOTE
    + r"(?=\s*[A-Z][A-Za-z0-9 .,&\-]{2,80}(?:Corp\.?|Corporation|Inc\.?|Ltd\.?|Limited|Group|Holdings?|Co\.?))"
)


def without_stray_blanks(text: Column) -> Column:
    return F.regexp_replace(clean(text), STRAY_BLANK, "")


def fullwidth(text: Column) -> Column:
    """Full-width punctuation beside Chinese characters; commas inside numbers stay."""
    for old, new in (("“ ", "“"), (" ”", "”"), ("‘ ", "‘"), (" ’", "’")):
        text = F.replace(text, F.lit(old), F.lit(new))

    def signs(text: Column) -> Column:
        text = F.regexp_replace(text, rf",(?<=[{V.CJK}%％）】],)(?![0-9])", "，")
        text = F.regexp_replace(text, rf",(?<![0-9],)(?=[{V.CJK}])", "，")
        for half, full in ((";", "；"), (":", "："), (r"\?", "？"), ("!", "！")):
            text = F.regexp_replace(text, rf"{half}(?:(?<=[{V.CJK}0-9%％）】]{half})|(?=[{V.CJK}]))", full)
        for half, full, before in ((r"\(", "（", True), (r"\)", "）", False), (r"\[", "【", True), (r"\]", "】", False)):
            text = F.regexp_replace(text, rf"{half}(?<=[{V.CJK}]{half})" if before else rf"{half}(?=[{V.CJK}])", full)
        return F.replace(F.replace(text, F.lit(" ,"), F.lit("，")), F.lit(" ;"), F.lit("；"))

    return T.bound(text, lambda t: F.when(F.rlike(t, F.lit(r"[,;:?!()\[\]]")), signs(t)).otherwise(t))  # without a half-width sign there is nothing to do


def format_thousands(text: Column) -> Column:
    """Commas in whole numbers before a unit; years, codes, decimals and numbers with a leading zero stay."""
    return F.regexp_replace(text, _COMMA_PLACE, ",")


def normalize(text: Column) -> Column:
    return format_thousands(fullwidth(without_stray_blanks(text)))


def has_stray_blank(text: Column) -> Column:
    blank = r"[^\S\r\n]"
    return matches(text, rf"{blank}(?:(?<=[{V.CJK}]{blank}){blank}*+[{_ALNUM}]|(?<=[{_ALNUM}]{blank}){blank}*+[{V.CJK}])")


def has_halfwidth_punctuation(text: Column) -> Column:
    return matches(text, rf"[,;:!?()\[\]](?:(?<=[{V.CJK}].)|(?=[{V.CJK}]))")


def has_bare_quantity(text: Column) -> Column:
    return matches(text, BARE_QUANTITY)


def _alternating(text: Column, mark: str, opening: str, closing: str) -> Column:
    parts = F.split(text, mark)
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).when(i % 2 == 1, F.concat(F.lit(opening), p)).otherwise(F.concat(F.lit(closing), p))), "")


def fullwidth_quotes(text: Column) -> Column:
    """Straight quotes as opening and closing ones in turn."""
    return _alternating(_alternating(F.coalesce(text, F.lit("")), '"', "“", "”"), "'", "‘", "’")


def quote_snippets(text: Column, limit: int = 5, around: int = 18) -> Column:
    """The surroundings of the first straight quotes."""
    text = F.coalesce(text, F.lit(""))
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substr(text, i, F.lit(1)).isin('"', "'"))
    return F.transform(F.slice(places, 1, limit), lambda i: F.substr(text, F.greatest(i - around, F.lit(1)), around + 1 + F.least(i - 1, F.lit(around))))


def ticker_punctuation(text: Column) -> Column:
    for old, new in V.TICKERS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def tidy_notes(text: Column, rounds: int = 3) -> Column:
    """Short-name notes in one form, after the whole name, and once."""
    code = "，?(?:股票代码|证券代码)[:：]?([A-Za-z0-9.]+)"
    text = F.replace(ticker_punctuation(fullwidth_quotes(text)), F.lit("（下文简称“"), F.lit("（下称“"))
    text = F.replace(text, F.lit("（以下简称“"), F.lit("（下称“"))
    text = F.regexp_replace(text, f"（下称“([^”]+)”）（(?:简称|证券简称)[^，）]*{code}）", "（下称“$1”，股票代码：$2）")
    text = F.regexp_replace(text, "（下称“([^”]+)”）（(?:简称|证券简称)[^，）]*）", "（下称“$1”）")
    text = F.regexp_replace(text, f"（(?:简称|证券简称)“?([^”，）]+)”?{code}）", "（下称“$1”，股票代码：$2）")
    text = F.regexp_replace(text, "（(?:简称|证券简称)“?([^”，）]+)”?）", "（下称“$1”）")
    text = F.regexp_replace(text, DESCRIBED_NOTE, "$1")
    for _ in range(rounds):  # a name may have been split more than once
        text = F.regexp_replace(F.regexp_replace(text, SPLIT_NOTE, "$1$3（下称“$2”）"), rf"({NOTE})\1+", "$1")
    return text


def without_notes(text: Column) -> Column:
    return normalize(F.regexp_replace(tidy_notes(text), NOTE, ""))


#: Every malformed note holds one of these; one of the first four is malformed by itself.
NOTE_WORDS = ("下文简称", "以下简称", "（简称", "（证券简称", "（下称“")


def has_malformed_note(text: Column) -> Column:
    named = matches(text, rf"{DESCRIBED_NOTE}|{NOTE}(?:娱乐集团|科技有限公司|股份有限公司|有限责任公司|有限公司)") | matches(text, SPLIT_NOTE) | matches(text, rf"({NOTE})\1")
    return matches(text, words_pattern(NOTE_WORDS[:4])) | matches(text, words_pattern(NOTE_WORDS[4:])) & named


def has_placeholder_fact(text: Column) -> Column:
    """A digit before ``.x%``, two or more x, or a word for what is to be filled in; the first sign is looked at before the forms."""
    return matches(text, r"(?=[0-9xXtT待占])(?:[0-9]\.[xX]+%|[xX]{2}|待补充|待确认|占位|(?i:TODO|TBD))")


def with_first_note(text: Column, name: Column, note: Column) -> Column:
    """The note after the first mention of a name, unless one stands there already."""
    at = F.instr(text, name) + F.length(name)
    after = F.substr(text, at)
    fits = (F.coalesce(name, F.lit("")) != "") & F.contains(text, name) & ~F.startswith(after, F.lit("（下称“"))
    return F.when(F.coalesce(fits, F.lit(False)), F.concat(F.substr(text, F.lit(1), at - 1), note, after)).otherwise(text)


def neutral_wording(text: Column) -> Column:
    """Phrases to readers, guesses and slogans replaced by neutral ones, in order; English modals dropped."""
    for old, new in (*V.AUDIENCE_REPLACEMENTS, *V.TONE_REPLACEMENTS):
        text = F.replace(text, F.lit(old), F.lit(new))
    return normalize(F.regexp_replace(text, r"(?i)\b(?:could|might|possibly|may)\b", ""))


def compact_name(name: Column) -> Column:
    """A name without bracketed remarks and legal forms."""
    bare = F.regexp_replace(F.coalesce(name, F.lit("")), r"（.*?）|\(.*?\)", "")
    return F.trim(F.regexp_replace(bare, "(?i)" + "|".join(V.NAME_FORMS), ""))


def title_parties(name: Column, acquirer: Column, target: Column) -> tuple[Column, Column]:
    """Both parties in compact form; those that are missing come from the case name."""
    inferred = split_parties(name, V.TITLE_VERBS)
    both = [or_else(own, other) for own, other in zip((acquirer, target), inferred, strict=True)]
    return tuple(or_else(compact_name(p), p) for p in both)


def _without_location(name: Column) -> Column:
    """Without the first place name of the list that it begins with, if three characters are left; else null."""
    out = F.lit(None).cast("string")
    for place in reversed(V.LOCATIONS):
        out = F.when(F.startswith(name, F.lit(place)) & (F.length(name) - len(place) >= 3), F.substr(name, F.lit(len(place) + 1))).otherwise(out)
    return out


def name_aliases(name: Column) -> Column:
    """Names by which a text may call a company: parts, without place, without generic words, first and last characters."""
    name = F.coalesce(name, F.lit(""))
    plain = F.trim(F.regexp_replace(name, "(?i)(股份有限公司|有限责任公司|有限公司|公司)$", ""))
    forms = F.struct(name.alias("name"), compact_name(name).alias("compact"), plain.alias("plain"))
    return T.bound(forms, lambda f: T.bound(F.coalesce(_without_location(f["compact"]), f["compact"]), lambda local: _aliases(f["name"], f["compact"], f["plain"], local)))


def _aliases(name: Column, compact: Column, plain: Column, local: Column) -> Column:
    found = [name, compact, plain, local, _without_location(plain)]
    for base in (compact, local):
        short = base
        for word in V.GENERIC_NAME_PARTS:
            short = F.replace(short, F.lit(word), F.lit(""))
        found += [short, F.when(F.contains(base, F.lit("食品包装")), F.replace(base, F.lit("食品"), F.lit("")))]
    for base, sizes in ((compact, (4, 5, 6)), (local, (4,))):
        for n in sizes:
            enough = F.length(base) >= n
            found += [F.when(enough, F.substring(base, 1, n)), F.when(enough, F.substring(base, -n, n))]
    found.append(F.when(F.length(compact) >= 4, F.concat(F.substring(compact, 1, 2), F.substring(compact, -2, 2))))
    parts = F.transform(F.split(compact, "[、,，/和及与]+"), lambda p: F.trim(p))
    return F.array_distinct(F.filter(F.concat(F.array(*found), parts), lambda x: F.length(x) >= 3))


def mentions(text: Column, aliases: Column) -> Column:
    """Whether a text holds one of a company's names."""
    return F.exists(aliases, lambda a: F.contains(text, a))


def cn_number(index: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(x) for x in V.CN_NUMBERS]), index.cast("int")), index.cast("string"))


def bare_heading(heading: Column) -> Column:
    out = F.regexp_replace(F.trim(F.coalesce(heading, F.lit(""))), r"^(第[一二三四五六七八九十0-9]+章\s*)", "")
    return F.trim(F.regexp_replace(out, r"^[一二三四五六七八九十0-9]+[、.．]\s*", ""))


def numbered_outline(headings: Column, most: int = 7) -> Column:
    """At most seven distinct headings, numbered anew; a last one that concludes is marked as such, others lose that mark."""
    bare = F.transform(headings, lambda h: F.regexp_replace(F.regexp_replace(bare_heading(h), "^结语[:：]?", "结语："), "^[ ：:]+|[ ：:]+$", ""))
    kept = F.slice(F.array_distinct(F.filter(bare, lambda h: h != "")), 1, most)

    def numbered(h: Column, i: Column) -> Column:
        last = (i + 1 == F.size(kept)) & F.contains(h, F.lit("结语"))
        end = F.concat(F.lit("结语："), F.regexp_replace(F.regexp_replace(h, "(?s)^.*?结语", ""), "^[：: ]+", ""))
        return F.concat(cn_number(i + 1), F.lit("、"), F.when(last, end).otherwise(F.trim(F.regexp_replace(h, "^结语[:：]?", ""))))

    return F.transform(kept, numbered)


def without_local_paths(text: Column) -> Column:
    """White space collapsed, file links and paths of a machine's own folders replaced by a mark."""
    text = F.regexp_replace(clean(text), r"(?i)file://\S+", "[local-path-redacted]")
    return F.trim(F.regexp_replace(text, r"(?:(?:/Users|/home|/tmp|/private/tmp)/|[A-Za-z]:\\(?:Users|Temp)\\)\S+", "[local-path-redacted]"))


def is_heading(text: Column, style: Column) -> Column:
    """By style, or a short line that begins like a numbered heading."""
    named = F.rlike(F.replace(F.lower(F.coalesce(style, F.lit(""))), F.lit(" "), F.lit("")), F.lit("^(?:heading|标题)"))
    return named | (F.length(text) <= 100) & matches(text, r"^(?:【[^】]{1,60}】|第[一二三四五六七八九十百0-9]+[章节篇]|[一二三四五六七八九十0-9]+[、.．]\s*\S+)")


def is_title_style(style: Column) -> Column:
    name = F.replace(F.lower(F.coalesce(style, F.lit(""))), F.lit(" "), F.lit(""))
    return name.isin("title", "标题", "题目") | F.startswith(name, F.lit("maintitle"))


def is_contents_label(text: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", "")).isin("目录", "目次", "tableofcontents", "contents")


def section_kind(heading: Column) -> Column:
    summary = matches(heading, "摘要|要点|结论|(?i:summary)")
    return F.when(summary, "executive_summary").when(matches(heading, "来源|参考|方法|(?i:method)"), "methodology").otherwise("analysis")


def chunked_paragraphs(paragraphs: Column, limit: int = 19_000, joint: int = 2) -> Column:
    """Sizes of chunks of whole paragraphs, in order: a paragraph costs its length and the joint; one above the limit is cut on its own."""
    start = F.struct(F.array().cast("array<int>").alias("done"), F.lit(0).alias("open"), F.lit(0).alias("count"))
    closed = lambda s: F.when(s["count"] > 0, F.concat(s["done"], F.array(s["open"] - joint))).otherwise(s["done"])

    def add(s: Column, paragraph: Column) -> Column:
        size = F.length(paragraph)
        full = (s["count"] > 0) & (s["open"] + size + joint > limit)
        pieces = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / limit).cast("int")), lambda i: F.least(size - i * limit, F.lit(limit)))
        fresh = F.struct(closed(s).alias("done"), (size + joint).alias("open"), F.lit(1).alias("count"))
        more = F.struct(s["done"].alias("done"), (s["open"] + size + joint).alias("open"), (s["count"] + 1).alias("count"))
        cut = F.struct(F.concat(closed(s), pieces).alias("done"), F.lit(0).alias("open"), F.lit(0).alias("count"))
        return F.when(size > limit, cut).when(full, fresh).otherwise(more)

    return F.aggregate(paragraphs, start, add, closed)
