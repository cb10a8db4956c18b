"""Rules over report articles: a title, an intro and sections of a heading and paragraphs, as nested columns.

Every rule is a (code, condition) pair; a report lists the codes of the rules that an article breaks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealspark.functions import cjk as C
from dealspark.functions import terms
from dealspark.functions import text as T
from dealspark.functions import vocab as V
from dealspark.functions.signals import has_any, matches, or_else, split_parties

ARTICLE = "title string, intro string, sections array<struct<heading:string,paragraphs:array<string>>>"
LEAST, MOST = 3500, 4000


def size(text: Column) -> Column:
    """Characters that aren't white space."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), T.SPACE, ""))


def section_text(section: Column) -> Column:
    return F.concat_ws("\n", section["heading"], F.array_join(section["paragraphs"], "\n"))


def article_text(title: Column, intro: Column, sections: Column) -> Column:
    return F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(intro, F.lit("")), F.array_join(F.transform(sections, section_text), "\n"))


def early_text(intro: Column, sections: Column) -> Column:
    """The intro and the first three paragraphs of the first two sections."""
    parts = F.transform(F.slice(sections, 1, 2), lambda s: F.concat_ws("\n", s["heading"], F.array_join(F.slice(s["paragraphs"], 1, 3), "\n")))
    return F.concat_ws("\n", F.coalesce(intro, F.lit("")), F.array_join(parts, "\n"))


def paragraphs(sections: Column) -> Column:
    return F.filter(F.flatten(F.transform(sections, lambda s: s["paragraphs"])), lambda p: F.trim(p) != "")


def normalized(sections: Column) -> Column:
    """Sections with every text normalised; those without heading or paragraphs go, seven at most, numbered anew."""
    tidy = F.transform(F.slice(sections, 1, 7), lambda s: F.struct(C.normalize(s["heading"]).alias("heading"), F.filter(F.transform(s["paragraphs"], C.normalize), lambda p: p != "").alias("paragraphs")))
    kept = F.filter(tidy, lambda s: (s["heading"] != "") & (F.size(s["paragraphs"]) > 0))

    def numbered(s: Column, i: Column) -> Column:
        body = F.regexp_replace(C.bare_heading(s["heading"]), "^[ ：:]+|[ ：:]+$", "")
        last = (i + 1 == F.size(kept)) & F.contains(body, F.lit("结语"))
        end = F.concat(F.lit("结语："), F.regexp_replace(F.regexp_replace(body, "(?s)^.*?结语", ""), "^[：: ]+", ""))
        return F.struct(F.concat(C.cn_number(i + 1), F.lit("、"), F.when(last, end).otherwise(body)).alias("heading"), s["paragraphs"].alias("paragraphs"))

    return F.transform(kept, numbered)


def concreteness(text: Column, named: Column, words: Column) -> Column:
    """A point each for a figure, for one of the parties' names and for three concrete terms."""
    return matches(text, "[0-9]").cast("int") + named.cast("int") + (words >= 3).cast("int")


_ACTING, _PURPOSE = ("受让方", "受让人", "投资方", "收购方", "并购方", "买方"), ("目的", "动机", "理由", "旨在", "意在", "为了", "投资目标")


def has_buyer_reason(text: Column, said: Column) -> Column:
    """Three words of a buyer's motive, or a paragraph that ties a buyer to a purpose by cause or mechanism; ``said`` counts what the whole text holds of each."""

    def tied(p: Column) -> Column:
        gap = F.contains(p, F.lit("未披露"))
        named = has_any(p, _ACTING) & has_any(p, _PURPOSE)
        mechanism = has_any(p, ("持股", "股权比例", "表决权", "锁定期", "协议转让", "支付方式")) & has_any(p, ("因此", "意味着", "对应", "从而"))
        return (F.length(F.trim(p)) >= 60) & named & F.when(gap, mechanism).otherwise(has_any(p, ("因此", "因为", "旨在", "为了", "从而", "意在")))

    return (said["buyer"] >= 3) | (said["acting"] > 0) & (said["purpose"] > 0) & F.exists(F.split(text, "\r\n|\r|\n"), tied)


def has_acceptance_contradiction(text: Column) -> Column:
    """An acceptance above nine tenths that is called insufficient."""
    named = matches(text, r"9[0-9](?:\.[0-9]+)?%|100%|九成")  # few texts hold one, so the costly pattern is seldom tried
    high = named & matches(text, r"(?s)(?:预受|接受|受要约|要约).{0,180}(?:9[0-9](?:\.[0-9]+)?%|100%|九成|超过九成|逾九成)")
    return high & matches(text, "(?s)(?:预受率|接受率|接受|预受|受要约).{0,260}(?:严重不足|明显不足|远低于|不被市场接受|接受不足)")


def lacks_party_note(body: Column, name: Column) -> Column:
    """A legal name whose first mention no short name follows."""
    legal = matches(name, r"(?:股份有限公司|有限责任公司|科技有限公司|娱乐集团|有限公司|公司)$|(?i:\b(?:Corporation|Inc\.?|Limited|Ltd\.?|PLC)\b)")
    after = F.substr(body, F.instr(body, name) + F.length(name), F.lit(48))
    return F.coalesce((F.length(name) >= 3) & legal & F.contains(body, name) & ~F.startswith(after, F.lit("（下称“")), F.lit(False))


#: Words that the rules count in a whole text and in its last section; those of the rules of form, then those of quality.
_SAID = {
    "audience": V.BANNED_AUDIENCE, "hypotheses": V.HYPOTHESES, "tone": V.BANNED_TONE, "time": V.TIME_WORDS, "consideration": V.CONSIDERATION_WORDS, "financial": V.FINANCIAL_WORDS,
    "buyer": V.BUYER_WORDS, "seller": V.SELLER_WORDS, "introduction": V.INTRO_WORDS, "acting": _ACTING, "purpose": _PURPOSE, "notes": C.NOTE_WORDS,
}
_LAST_SAID = {"generic": V.GENERIC_CONCLUSIONS, "concrete": V.CONCRETE_WORDS}
_SHOWN = {
    "media": V.MEDIA_TONE, "templates": V.TEMPLATE_PHRASES, "industry": V.INDUSTRY_TERMS, "structure": V.STRUCTURE_TERMS, "method": V.METHOD_TERMS, "finance": V.FINANCE_TERMS,
    "method_words": V.METHOD_WORDS, "industry_words": V.INDUSTRY_WORDS, "causal": V.CAUSAL_WORDS,
}
_EARLY_SHOWN = {"background": V.BACKGROUND_TERMS, "initiation": V.INITIATION_TERMS, "objective": V.OBJECTIVE_TERMS}
_LAST_SHOWN = {"generic": V.GENERIC_ENDINGS, "causal": V.CAUSAL_WORDS, "industry": V.INDUSTRY_TERMS, "structure": V.STRUCTURE_TERMS, "method": V.METHOD_TERMS, "finance": V.FINANCE_TERMS}


def with_parts(articles: DataFrame) -> DataFrame:
    """Articles (title, intro, sections, and case_name, acquirer, target if they have them) with what several rules read: each part is made once a row, and words are counted in all texts of a batch at once."""
    title, intro, sections = F.col("title"), F.col("intro"), F.col("sections")
    party = lambda c: F.coalesce(F.col(c), F.lit("")) if c in articles.columns else F.lit("")
    inferred = split_parties(party("case_name"), V.TITLE_VERBS)
    last = F.try_element_at(sections, F.lit(-1))
    out = articles.withColumns({
        "text": article_text(title, intro, sections), "body": article_text(F.lit(""), intro, sections), "early": early_text(intro, sections), "parts": F.transform(sections, section_text), "headings": F.transform(sections, lambda s: C.bare_heading(s["heading"])),
        "paragraphs": paragraphs(sections), "last_text": F.coalesce(section_text(last), F.lit("")), "last_heading": F.coalesce(last["heading"], F.lit("")),
        "named_a": party("acquirer"), "named_t": party("target"), "meant_a": or_else(party("acquirer"), inferred[0]), "meant_t": or_else(party("target"), inferred[1]),
    })
    text, last_text = F.col("text"), F.col("last_text")
    out = out.withColumns({f"names_{k}": C.name_aliases(F.col(f"meant_{k}")) for k in "at"})
    return out.withColumns({f"last_{k}": C.mentions(last_text, F.col(f"names_{k}")) for k in "at"} | {
        "said": terms.measured(text, _SAID), "last_said": terms.measured(last_text, _LAST_SAID), "shown": terms.measured(text, _SHOWN), "last_shown": terms.measured(last_text, _LAST_SHOWN),
        "early_shown": terms.measured(F.col("early"), _EARLY_SHOWN), "prominent_shown": terms.measured(F.concat_ws("\n", F.coalesce("title", F.lit("")), F.array_join("headings", "\n")), {"media": V.MEDIA_TONE}),
        "paragraphs_shown": terms.measured(F.array_join("paragraphs", "\n")),
    })


def article_rules() -> list[tuple[str, Column]]:
    """Length, title, format, tone, sections, data and motives, on articles with parts."""
    title, intro, sections, text, body = (F.col(c) for c in ("title", "intro", "sections", "text", "body"))
    last_text, last_heading, headings = F.col("last_text"), F.col("last_heading"), F.col("headings")
    n, names, said, last_said = F.size(sections), F.concat("names_a", "names_t"), F.col("said"), F.col("last_said")
    meant, named_in = {k: F.col(f"meant_{k}") != "" for k in "at"}, lambda t, k: C.mentions(t, F.col(f"names_{k}"))
    named = F.startswith(last_heading, F.concat(C.cn_number(n), F.lit("、结语："))) | F.startswith(last_heading, F.concat(F.lit("第"), C.cn_number(n), F.lit("章")))
    suffix = F.regexp_replace(F.regexp_replace(C.bare_heading(last_heading), "(?s)^.*?结语", ""), "^[：: ]+", "")
    any_heading = lambda words: F.exists(headings, lambda h: has_any(h, words))
    vague = F.exists("parts", lambda p: (F.length(p) >= 260) & (size(p) >= 260) & (concreteness(p, C.mentions(p, names), T.count_terms(p, V.CONCRETE_WORDS)) < 2))
    return [
        ("too_short", said["size"] < LEAST), ("too_long", said["size"] > MOST), ("long_title", size(title) > 40), ("no_subtitle", ~matches(title, "[：:]")),
        ("title_without_acquirer", meant["a"] & ~named_in(title, "a")), ("title_without_target", meant["t"] & ~named_in(title, "t")),
        ("stray_blank", C.has_stray_blank(text)), ("halfwidth_punctuation", C.has_halfwidth_punctuation(text)), ("bare_quantity", C.has_bare_quantity(text)),
        ("template_intro", has_any(F.substring(intro, 1, 140), V.BANNED_INTRO)), ("audience", said["audience"] > 0), ("hypothesis", said["hypotheses"] > 0), ("tone", said["tone"] > 0),
        ("few_sections", n < 4), ("many_sections", n > 7), ("generic_heading", (n >= 4) & any_heading(V.GENERIC_HEADINGS)), ("thinking_heading", (n >= 4) & any_heading(V.THINKING_HEADINGS)), ("tone_heading", (n >= 4) & any_heading(V.BANNED_TONE)),
        ("vague_section", (n >= 4) & vague), ("last_heading", (n >= 4) & ~named), ("short_ending_title", (n >= 4) & named & (size(suffix) < 6)), ("generic_conclusion", (n >= 4) & (last_said["generic"] > 0)),
        ("shallow_conclusion", (n >= 4) & (concreteness(last_text, F.col("last_a") | F.col("last_t"), last_said["concrete"]) < 3)), ("conclusion_without_parties", (n >= 4) & (meant["a"] & ~F.col("last_a") | meant["t"] & ~F.col("last_t"))),
        ("few_figures", said["digits"] < 35), ("no_time", said["time"] == 0), ("no_consideration", said["consideration"] == 0), ("few_financials", said["financial"] < 4),
        ("no_buyer_reason", ~has_buyer_reason(text, said)), ("no_seller_reason", said["seller"] < 2), ("acquirer_missing", (F.col("named_a") != "") & ~named_in(text, "a")), ("target_missing", (F.col("named_t") != "") & ~named_in(text, "t")),
        ("no_introduction", said["introduction"] < 5), ("malformed_note", (said["notes"] > 0) & C.has_malformed_note(text)), ("placeholder", C.has_placeholder_fact(text)),
        ("missing_note", lacks_party_note(body, F.col("named_a")) | lacks_party_note(body, F.col("named_t"))), ("halfwidth_quote", matches(text, "[\"']")),
    ]


def quality_rules() -> list[tuple[str, Column]]:
    """Signs of a template and of shallow analysis, on articles with parts."""
    text, title, sections, headings, paras = F.col("text"), F.coalesce("title", F.lit("")), F.col("sections"), F.col("headings"), F.col("paragraphs")
    shown, last_shown, early, subtitle = F.col("shown"), F.col("last_shown"), F.col("early_shown"), F.regexp_replace(title, "(?s)^.*?：", "")
    templates = F.size(F.filter(headings, lambda h: has_any(h, V.TEMPLATE_HEADINGS)))
    openings = F.transform(paras, lambda p: F.substring(F.regexp_replace(F.trim(p), "^（?[0-9]+[）.]?", ""), 1, 8))
    repeated = F.exists(openings, lambda o: (o != "") & (F.size(F.filter(openings, lambda x: x == o)) >= 3))
    counts = F.transform(sections, lambda s: F.size(s["paragraphs"]))
    even = (F.size(counts) >= 4) & (F.size(F.array_distinct(F.slice(counts, F.lit(1), F.greatest(F.size(counts) - 1, F.lit(0))))) <= 1)
    industry, structure, method, finance = (shown[w] for w in ("industry", "structure", "method", "finance"))
    depth = (industry >= 4).cast("int") + (structure >= 5).cast("int") + (method >= 4).cast("int") + (finance >= 5).cast("int")
    weak = (industry < 3).cast("int") + (structure < 4).cast("int") + (method < 3).cast("int")
    long = F.filter(paras, lambda p: (F.length(p) >= 260) & (size(p) >= 260))
    mean = F.when(F.size(paras) > 0, F.col("paragraphs_shown.size") / F.size(paras)).otherwise(0.0)
    last, media = F.col("last_text"), F.col("prominent_shown.media")
    last_terms = last_shown["structure"] + last_shown["method"] + last_shown["finance"] + last_shown["industry"]  # a word of two lists counts twice
    return [
        ("weak_title", has_any(title, V.WEAK_TITLES)), ("no_subtitle", ~F.contains(title, F.lit("："))), ("thin_subtitle", F.length(subtitle) < 6), ("title_without_topic", ~has_any(title, V.TITLE_TOPICS)),
        ("media_headings", media > 0), ("media_tone", (media == 0) & (shown["media"] >= 3)),
        ("template_headings", templates >= 2), ("template_phrases", shown["templates"] >= 2), ("repeated_openings", repeated), ("even_sections", even & ((templates >= 1) | repeated)),
        ("shallow", depth < 3), ("weak_layers", weak >= 2), ("short_paragraphs", (F.size(long) < 2) & (mean < 210)), ("no_method", shown["method_words"] == 0), ("no_industry", shown["industry_words"] == 0),
        ("no_cause", shown["causal"] == 0), ("contradiction", has_acceptance_contradiction(text)), ("no_background", early["background"] < 1), ("no_initiation", early["initiation"] < 2),
        ("no_objective", early["objective"] < 1), ("generic_ending", last_shown["generic"] > 0), ("shallow_ending", (last != "") & (last_terms < 5)),
        ("ending_without_cause", (last != "") & (last_shown["causal"] == 0)),
    ]


def outline_rules(headings: Column) -> list[tuple[str, Column]]:
    """Count, repetition, wording and numbering of an outline."""
    bare, last = F.transform(headings, C.bare_heading), F.coalesce(F.try_element_at(headings, F.lit(-1)), F.lit(""))
    return [
        ("section_count", ~F.size(headings).between(4, 7)), ("repeated_heading", F.size(F.array_distinct(bare)) != F.size(headings)), ("thinking_heading", F.exists(bare, lambda h: has_any(h, V.THINKING_HEADINGS))),
        ("tone_heading", F.exists(bare, lambda h: has_any(h, V.BANNED_TONE))), ("short_heading", F.exists(bare, lambda h: F.length(h) < 8)), ("last_heading", (F.size(headings) > 0) & ~F.startswith(last, F.concat(C.cn_number(F.size(headings)), F.lit("、结语：")))),
    ]


def plan_rules(plan: Column) -> list[tuple[str, Column]]:
    """Least lengths and counts of a narrative plan."""
    texts = (("core_question", 20), ("central_thesis", 24), ("deal_origin_chain", 24), ("initiation_mechanism", 16), ("strategic_objective", 16))
    lists = (("depth_angles", 3), ("chapter_directions", 4))
    return [(f"short_{n}", F.length(F.coalesce(plan[n], F.lit(""))) < k) for n, k in texts] + [(f"few_{n}", F.size(F.coalesce(plan[n], F.array().cast("array<string>"))) < k) for n, k in lists]
