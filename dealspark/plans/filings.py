"""Deal filings derived from the order tables: one filing an order, with Chinese and English wording, for Spark and for the oracles.

Each text column takes one of a few wordings, picked by the order's and the customer's key, with the names of the parties set in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.session import spread, table

#: (factor of the order key, factor of the customer key, wordings); {a} and {t} are the parties, {k} and {n} numbers.
WORDINGS: dict[str, tuple[int, int, tuple[str, ...]]] = {
    "title": (3, 1, (
        "{a}关于收购{t}30%股权完成过户的公告", "{a}要约收购报告书（草案）", "{a}关于筹划重大资产重组的停牌公告", "独立财务顾问关于{a}资产置换之核查意见", "{a}关于控股股东发生变更暨股份转让完成过户的公告",
        "{a} acquisition of {t} completed", "{a}关于与{t}签订股权转让协议的提示性公告", "{a}年度股东大会决议公告", "{a}收购{t}：2026年交易复盘",
    )),
    "summary": (1, 2, ("证券简称：星河{k}；公告类别：股权转让", "本次交易作价12.5亿元，以支付现金方式收购全部股权", "拟受让{t}持有的5,000,000股股份，预计于2026年完成交割", "subject to regulatory approval, expected to close in 2026", "-", "发行股份及支付现金购买资产，认购对象为{t}")),
    "body": (5, 3, (
        "证券代码：600{k} 证券简称：星河{k} {a} 关于股份转让的公告。转让方与{t}签订股份转让协议。本次协议转让股份数量为12,500,000股，占公司总股本的12.50%，每股转让价格为8.35元/股，交易总价款10437.5万元。过户日期为2026年3月{k}日。",
        "{a}（以下简称“星河”）收购目的为产业协同与业务拓展，取得控制权。\n标的2025年营业收入3.2亿元，净利润4500万元，客户与订单稳定增长。\n转让方拟退出该业务，要约期限届满，股东账户已清算过户。",
        "本次要约收购价格为6.5元/股，预定收购的股份数量为20,000,000股。截至2026年2月，预受要约比例为35.2%，海外美元融资到位。", "控股股东变更为{t}。{t}成为上市公司控股股东，持股29.9%。相关工商变更登记手续已办理。",
        "公司收到问询函，交易尚未完成，待审批。", "The transaction was completed and closed on schedule. Purchase price was 350 million, consideration in cash.", "公司向{t}转让给{a}，该项安排于2026年1月5日完成了股权交割手续。", "",
    )),
    "status": (2, 5, ("已完成过户", "进行中", "交易完成", "拟收购，尚未完成", "completed", "待交割", "", "closed", "completed, pending approval")),
    "deal_value": (7, 1, ("12.5亿元", "未披露", "发行股份及支付现金", "-", "USD 350 million", "协议转让12.5%股份，价格7.1元/股", "", "1,200")),
    "why": (1, 7, ("收购方希望通过本次交易实现产业协同，补强平台能力", "短", "", "详式权益变动披露，控制权变更", "跨境布局，海外客户与技术协同")),
    "highlights": (11, 2, ("2025年收入8亿元，净利润1.1亿元", "", "未披露", "毛利率提升，现金流稳定")),
    "url": (13, 1, (
        "https://static.cninfo.com.cn/finalpage/2026/{n}.PDF?utm_source=x", "https://www.reuters.com/markets/deals/{n}", "https://www.sec.gov/", "http://ir.example.com/news/{n}/", "not a url", "https://news.example.org/a//b/{n}", "",
        "https://r.example.com/go?u=https%3A%2F%2Fwww.hkexnews.hk%2Fnews%2F{n}.pdf", "https://Finance.Sina.com/roll/{k}.html#top",
    )),
    "source_name": (1, 3, ("巨潮资讯网", "Reuters", "证券时报", "", "公司公告")),
    "region": (1, 1, ("中国A股", "香港", "美国", "", "中概股", "欧洲")),
    "category": (1, 5, ("跨境并购", "上市公司控股权并购（要约）", "", "其他", "SPAC")),
    "buyer_motive": (3, 2, ("通过收购补强产业链并取得控制权，形成协同效应", "未披露", "")),
    "seller_motive": (2, 3, ("转让方拟退出非核心业务，回笼资金用于主业", "公开资料未披露", "", "短")),
    "flag": (1, 11, ("是", "否", "Yes", "进行中", "", "maybe")),
}
_NUMERALS = ("0123456789", "零一二三四五六七八九")  # names keep no digits in identities
_PLACES, _FORMS, _TARGET_FORMS = ("", "北京", "上海", "深圳市"), ("科技股份有限公司", "科技有限公司", "科技集团", "科技（集团）有限公司", "科技 Inc."), ("材料有限公司", "材料股份有限公司", "材料", "材料Ltd.")


def _pick(values: tuple[str, ...], a: int, b: int):
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col("o_orderkey") * a + F.col("o_custkey") * b) % len(values))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _pick_sql(values: tuple[str, ...], a: int, b: int) -> str:
    return f"list_extract([{', '.join(_quoted(v) for v in values)}], CAST((o_orderkey * {a} + o_custkey * {b}) % {len(values)} AS INT) + 1)"


def filings(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """id, acquirer, target, completed, classic and the wanted text columns of every order, dealt over all cores: the texts and what is read from them cost far more than the orders' bytes tell."""
    orders = spread(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"), "o_orderkey")
    acquirer = F.concat(_pick(_PLACES, 3, 0), F.lit("星河"), F.translate((F.col("o_custkey") % 400).cast("string"), *_NUMERALS), _pick(_FORMS, 1, 0))
    target = F.concat(F.lit("东方"), F.translate((F.col("o_orderkey") % 331).cast("string"), *_NUMERALS), _pick(_TARGET_FORMS, 1, 1))
    named = orders.withColumns({"__a": acquirer, "__t": target, "__k": (F.col("o_orderkey") % 28 + 1).cast("string"), "__n": F.col("o_orderkey").cast("string")})

    def fill(text):
        for mark in "atkn":
            text = F.replace(text, F.lit(f"{{{mark}}}"), F.col(f"__{mark}"))
        return text

    texts = [fill(_pick(WORDINGS[c][2], *WORDINGS[c][:2])).alias(c) for c in columns]
    return named.select(
        F.col("o_orderkey").alias("id"), "o_custkey", "o_orderdate", "o_totalprice",
        F.when(F.col("o_orderkey") % 29 == 0, None).when(F.col("o_orderkey") % 23 == 0, F.lit("受让方")).otherwise(F.col("__a")).alias("acquirer"),
        F.when(F.col("o_orderkey") % 31 == 0, F.lit("")).otherwise(F.col("__t")).alias("target"),
        F.concat(F.col("__a"), F.lit("收购"), F.col("__t"), F.when(F.col("o_orderkey") % 5 == 0, F.lit("12.5%股份")).otherwise("")).alias("case_name"),
        (F.col("o_orderkey") % 3 == 0).alias("completed"), (F.col("o_orderkey") % 37 == 0).alias("classic"), *texts,
    )


def filings_sql(*columns: str) -> str:
    """The same as a query for the oracles."""
    acquirer = f"{_pick_sql(_PLACES, 3, 0)} || '星河' || translate(CAST(o_custkey % 400 AS VARCHAR), '{_NUMERALS[0]}', '{_NUMERALS[1]}') || {_pick_sql(_FORMS, 1, 0)}"
    target = f"'东方' || translate(CAST(o_orderkey % 331 AS VARCHAR), '{_NUMERALS[0]}', '{_NUMERALS[1]}') || {_pick_sql(_TARGET_FORMS, 1, 1)}"
    texts = "".join(f", replace(replace(replace(replace({_pick_sql(WORDINGS[c][2], *WORDINGS[c][:2])}, '{{a}}', a_), '{{t}}', t_), '{{k}}', k_), '{{n}}', CAST(o_orderkey AS VARCHAR)) AS {c}" for c in columns)
    return f"""(SELECT o_orderkey AS id, o_custkey, o_orderdate, o_totalprice, CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN '受让方' ELSE a_ END AS acquirer, CASE WHEN o_orderkey % 31 = 0 THEN '' ELSE t_ END AS target,
    a_ || '收购' || t_ || CASE WHEN o_orderkey % 5 = 0 THEN '12.5%股份' ELSE '' END AS case_name, o_orderkey % 3 = 0 AS completed, o_orderkey % 37 = 0 AS classic{texts}
    FROM (SELECT *, {acquirer} AS a_, {target} AS t_, CAST(o_orderkey % 28 + 1 AS VARCHAR) AS k_ FROM orders))"""
