"""Completed deals out of official announcements: five kinds of deal, each read by its own expressions, the first that fits wins.

An announcement has id, title, summary, url, region, published and body. What several kinds ask for (issuer, short names, buyer,
percentages) is read once a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealspark.functions import signals as S
from dealspark.functions import vocab as V
from dealspark.operators import cases, identity
from dealspark.session import Scratch

_NAME = r"[A-Za-z0-9\x{4e00}-\x{9fa5}（）()·\s]"
_SKIPPED_TITLES = "减值测试|业绩承诺期满|独立财务顾问|法律意见书|核查意见"
_CONTROL_CHANGE = "(?:控股股东|实际控制人)[^。；]{0,50}(?:变更为|发生变更)"
#: Words by which the sentences of a kind of deal are known: fixed values.
SENTENCE_WORDS = {
    "asset_acquisition": (("标的资产", "购买资产", "股权", "亿元", "万元", "美元", "股权交割", "工商变更登记手续", "完成", "过户", "发行股份"), 7),
    "asset_swap": (("资产置换", "置入", "置出", "100%股权", "完成交割", "工商登记", "合并报表"), 8),
    "control_transfer": (("转让", "过户", "控股股东", "实际控制人", "控制权", "表决权", "股", "%", "万元", "亿元", "元/股"), 8),
    "tender_offer": (("要约收购", "完成过户", "收购结果", "股份", "股", "%", "元/股", "总价"), 8),
    "share_transfer": (("协议转让", "股份转让", "过户", "受让", "转让价格", "总价款", "占公司", "持股", "元/股", "%", "成为公司持股"), 8),
}


def with_parts(announcements: DataFrame) -> DataFrame:
    """Announcements with issuer, short names, buyer and percentages."""
    body = F.coalesce("body", F.lit(""))
    full, short = S.stock_identity(body, F.col("summary"))
    out = announcements.withColumns({"head": F.substring(body, 1, 7000), "full": full, "short": short, "aliases": S.alias_map(body)})
    out = out.withColumns({"buyer": S.buyer(F.col("body"), F.col("aliases")), "issuer": S.or_else(F.col("full"), F.col("short")), "called": S.or_else(F.col("short"), S.or_else(F.col("full"), F.lit(""))), "transfer": S.transfer_percent(F.col("head"))})
    control = S.has_any(F.col("head"), V.CONTROL_HINTS) | S.matches(F.col("head"), _CONTROL_CHANGE)
    return out.withColumns({"control": control, "no_control": S.has_any(F.substring("head", 1, 3000), V.NON_CONTROL_HINTS), "percent": F.coalesce(F.regexp_extract("transfer", "^([0-9.]+)%$", 1).try_cast("double"), F.array_max(S.percents(F.col("head"))), F.lit(0.0))})


def _named_stakes(text: Column, pattern: str, most: int, suffix: str) -> Column:
    """At most so many distinct names that a pattern finds, each with its stake, or null."""
    names = F.slice(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), S.clean_party)), 1, most)
    return F.when(F.size(names) > 0, F.array_join(F.transform(names, lambda n: F.concat(n, F.lit(suffix))), "、"))


def acquired(head: Column, aliases: Column) -> Column:
    """The stakes of an asset purchase: those of a list, else the one that a phrase names, else the one behind the short name; null without."""
    listed = F.regexp_extract(head, r"(?s)具体包括[:：]\s*(.{20,260}?)(?:。|根据|二、)", 1)
    stake = rf"({_NAME}{{2,80}}?有限公司)\s*([0-9]+(?:\.[0-9]+)?\s*%股权)"
    each = F.arrays_zip(F.regexp_extract_all(listed, F.lit(stake), F.lit(1)).alias("n"), F.regexp_extract_all(listed, F.lit(stake), F.lit(2)).alias("s"))
    several = F.array_join(F.transform(F.slice(each, 1, 3), lambda x: F.concat(S.clean_party(x["n"]), S.clean(x["s"]))), "、")
    phrases = (
        rf"(?i)(?:购买|收购).*?持有的({_NAME}{{2,90}}?有限公司).*?([0-9]+(?:\.[0-9]+)?\s*%股权)", rf"(?i)(?:购买|收购)({_NAME}{{2,90}}?有限公司).*?([0-9]+(?:\.[0-9]+)?\s*%股权)",
        r"(?i)(?:购买|收购).*?持有的([^。；]{2,90}?)(?:（以下简称[“\"]标的公司[”\"]）)?\s*([0-9]+(?:\.[0-9]+)?\s*%股权)",
    )
    single = [F.when(S.matches(head, p), F.concat(S.resolve_alias(F.regexp_extract(head, p, 1), aliases), S.clean(F.regexp_extract(head, p, 2)))) for p in phrases]
    behind = F.concat(F.try_element_at(aliases, F.lit("标的公司")), S.clean(F.regexp_extract(head, r"标的公司\s*([0-9]+(?:\.[0-9]+)?\s*%股权)", 1)))
    return F.coalesce(F.nullif(several, F.lit("")), *single, behind)


def placed_in(head: Column, aliases: Column) -> Column:
    """The whole companies that an asset swap places in: those listed after a name's declaration, else any named beside a full stake, else what short names stand for."""
    area = S.or_else(F.regexp_extract(head, r"(?s)置入的资产为(.{20,900}?)(?:置出资产|具体内容|本次交易已经|二、)", 1), head)
    declared = rf"([A-Za-z0-9\x{{4e00}}-\x{{9fa5}}（）()·]{{4,90}}?(?:公司|有限公司))（以下简称[“\"][^”\"]{{2,20}}[”\"]）\s*100\s*%股权"
    beside = r"([A-Za-z0-9\x{4e00}-\x{9fa5}（）()·]{2,80}?(?:公司|有限公司))[^。；]{0,20}?100\s*%股权"
    meant = F.filter(F.map_entries(aliases), lambda e: S.has_any(e["key"], ("公司", "资产", "标的")))
    fallback = F.array_join(F.slice(F.array_distinct(F.transform(meant, lambda e: e["value"])), 1, 4), "、")
    return F.coalesce(_named_stakes(area, declared, 4, "100%股权"), _named_stakes(area, beside, 4, "100%股权"), F.nullif(fallback, F.lit("")))


def kinds() -> dict[str, Column]:
    """For each kind of deal, in order: a struct of acquirer, target, case_name and category, or null where the announcement isn't one."""
    title, head, issuer, called, buyer = (F.col(c) for c in ("title", "head", "issuer", "called", "buyer"))
    both = F.concat_ws(" ", title, head)
    stakes, assets = acquired(F.substring(head, 1, 6000), F.col("aliases")), placed_in(head, F.col("aliases"))
    bidder = S.or_else(S.resolve_alias(F.regexp_extract(title, "关于(.{2,100}?)要约收购", 1), F.col("aliases")), buyer)
    label = S.or_else(F.col("transfer"), S.largest_percent(head))
    share = F.concat(called, label, F.lit("股份"))

    def deal(fits: Column, acquirer: Column, target: Column, name: Column, category: Column | str) -> Column:
        named = F.coalesce(~S.is_vague_party(acquirer) & ~S.is_vague_party(target), F.lit(False))
        category = F.lit(category) if isinstance(category, str) else category
        return F.when(fits & named, F.struct(acquirer.alias("acquirer"), target.alias("target"), name.alias("case_name"), category.alias("category")))

    done = "(?s)标的资产.*?(?:过户|完成)|股权交割|工商变更登记手续|完成交割|完成过户|交易完成"
    offer = S.matches(title, "要约收购") | S.matches(head, "要约收购结果|要约收购[^。；]{0,80}(?:完成过户|过户完成|完成|期限届满)")
    return {
        "asset_acquisition": deal(S.matches(both, "购买|收购") & ~S.matches(title, _SKIPPED_TITLES) & S.matches(F.substring(head, 1, 6000), done), issuer, stakes, F.concat(called, F.lit("收购"), stakes), V.DEFAULT_CATEGORY),
        "asset_swap": deal(F.contains(both, F.lit("资产置换")) & S.matches(head, "完成交割|交割完成|资产交割确认书|工商登记手续均已完成"), issuer, assets, F.concat(called, F.lit("置入"), assets), "整合一级资产+资本化"),
        "control_transfer": deal(F.col("control") & ~F.col("no_control"), buyer, issuer, F.concat(buyer, F.lit("受让"), called, F.lit("控制权股份")), "上市公司控股权并购"),
        "tender_offer": deal(offer & ~S.matches(F.substring(head, 1, 3000), "(?:不涉及|不触及|未触及)要约收购"), bidder, issuer, F.concat(bidder, F.lit("要约收购"), called, F.lit("股份")), "上市公司控股权并购"),
        "share_transfer": deal(
            S.matches(both, "(?:协议转让|股份转让).{0,80}(?:完成过户|过户完成|完成过户登记|证券过户登记确认书)") & ~S.is_vague_party(issuer) & ((F.col("percent") >= 5) | F.col("control")), buyer, share, F.concat(buyer, F.lit("受让"), share),
            F.when(F.col("control"), "上市公司控股权并购").otherwise("上市公司+PE"),
        ),
    }


def completed_deals(announcements: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One case a completed deal: kind, parties, name, category, terms, status and evidence of the best announcement of it, the newer one among equals.

    Announcements without a hint at completion, with a title of advisers' papers, from other than primary sources, or whose text isn't that of
    a completed deal are left out; so are cases that aren't ready for a report and deals that ``known`` (keys) holds.
    """
    title, text, url = F.col("title"), F.concat_ws(" ", "title", "summary"), cases.unwrapped(F.col("url"))
    hinted = announcements.where(S.has_any(text, V.COMPLETION_HINTS) & ~S.has_any(title, V.SKIP_TITLE_HINTS) & S.is_primary_source(url))
    told = with_parts(hinted.where(S.is_completed(F.concat_ws(" ", title, F.substring(F.coalesce("body", F.lit("")), 1, 1500)))))
    scratch = Scratch(announcements.sparkSession)  # each step reads the one before many times
    found = scratch.stored(scratch.stored(told).withColumns({f"k_{n}": k for n, k in kinds().items()}))
    names = [n for n in SENTENCE_WORDS]
    found = found.withColumns({"kind": F.coalesce(*[F.when(F.col(f"k_{n}").isNotNull(), n) for n in names]), "deal": F.coalesce(*[F.col(f"k_{n}") for n in names])}).where("deal is not null")
    evidence = F.lit("")
    for name, (words, limit) in SENTENCE_WORDS.items():
        evidence = F.when(F.col("kind") == name, S.sentences_with(F.col("body"), words, limit)).otherwise(evidence)
    found = scratch.stored(found.withColumn("evidence", evidence))
    terms = S.or_else(S.transaction_terms(F.col("evidence"), F.col("head")), F.when(F.col("kind") == "asset_swap", "资产置换；100%股权").otherwise(""))
    out = found.select(
        "id", "kind", "deal.*", "title", "region", terms.alias("deal_value"), S.completion_status(F.col("body"), F.col("published")).alias("status"), S.or_else(F.col("evidence"), title).alias("why"), F.col("evidence").alias("highlights"),
        F.col("evidence").alias("buyer_motive"), F.col("evidence").alias("seller_motive"), url.alias("url"), F.lit(True).alias("completed"), F.lit(False).alias("classic"), cases.item_score(title, text, F.col("url")).alias("score"), "published",
    )
    ready = scratch.stored(cases.with_signals(scratch.stored(out)).where("ready").select(out.columns))
    keyed = ready.withColumn("keys", identity.case_keys(*map(F.col, ("case_name", "acquirer", "target", "url"))))
    if known is not None:
        keyed = identity.split_by_history(keyed, known).where("not seen").drop("seen")
    age = F.coalesce(-F.unix_seconds(F.try_to_timestamp("published")), F.lit(2**62))
    ranked = keyed.withColumn("place", F.struct((-F.col("score")).alias("score"), age.alias("age"), "id"))
    kept = identity.fuzzy_first_wins(ranked.select(F.col("place").alias("id"), "keys"))
    return ranked.join(kept.withColumnRenamed("id", "place"), "place", "left_semi").drop("place", "keys")
