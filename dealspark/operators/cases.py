"""Report cases: their signals in one pass, the gates, penalties and scores that build on them, and the funnel of completed deals.

A case is a row with case_name, acquirer, target, title, status, deal_value, why, highlights, url, buyer_motive, seller_motive (text)
and completed, classic (boolean).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealspark.functions import signals as S
from dealspark.functions import urls as U
from dealspark.functions import vocab as V


def with_signals(cases: DataFrame) -> DataFrame:
    """The cases with what all rules ask for: each expression is evaluated once a row."""
    name, a, t, status, url = (F.col(c) for c in ("case_name", "acquirer", "target", "status", "url"))
    rich = S.lines(F.col("title"), F.col("why"), status, url)
    signals = cases.withColumn("url", unwrapped(url)).withColumns({
        "explicit": S.has_explicit_parties(name, a, t), "unresolved": S.is_unresolved(status), "said_done": S.is_completed(status), "usable": U.is_usable_article(url, ()), "rich": S.has_any(rich, V.RICH_DISCLOSURE),
        "detailed": S.has_any(rich, V.DETAIL_DISCLOSURE), "valued": S.has_deal_value(S.lines(F.col("deal_value"), F.col("why"), F.col("title"), F.col("highlights"))),
    })
    signals = signals.withColumn("primary", F.col("usable") & S.is_primary_source(url))
    signals = signals.withColumns({"done": F.expr("not unresolved and (classic or completed or said_done)"), "recent": F.expr("completed and not unresolved"), "told": F.expr("valued or (primary and (detailed or (completed and rich)))")})
    return signals.withColumn("ready", F.expr("explicit and done and (usable or classic or recent) and told"))


def unwrapped(url: Column) -> Column:
    """The address that a redirect leads to, if it names one."""
    return F.coalesce(U.parameter(url, ("url", "u", "target", "r")), url)


def report_gates(deny_list: str = "") -> list[tuple[str, Column]]:
    """The gates of a formal report in order, on cases with signals."""
    text = S.lines(*(F.col(c) for c in ("case_name", "acquirer", "target", "title", "why")))
    return [("topic", F.expr("classic or recent")), ("excluded_term", ~S.is_denied(text, deny_list)), ("parties", F.col("explicit")), ("completion", F.col("done")), ("usable_url", F.col("usable")), ("primary_source", F.col("primary")), ("terms", F.col("told"))]


def report_penalties() -> list[Column]:
    """Six penalties in the order of their weight: completion, deal, disclosure, address, motives, classic."""
    text = S.lines(F.col("title"), F.col("why"), F.col("status"))
    control = F.contains("case_name", F.lit("控制权")) | S.has_any(text, V.CONTROL_HINTS) & ~S.has_any(text, V.NON_CONTROL_HINTS)
    part = S.matches(F.col("case_name"), r"[0-9]+(?:\.[0-9]+)?%股份") & ~control & ~S.matches(text, "购买资产|资产置换|发行股份")
    largest = F.array_max(S.percents(F.col("case_name")))
    short = lambda c: (F.length(S.clean(c)) < 15).cast("int")
    return [
        F.when(F.col("done"), 0).otherwise(10),
        F.when(F.col("valued"), 0).when(F.col("primary"), F.when(F.col("detailed"), 1).otherwise(2)).otherwise(5) + F.when(part, F.when((largest > 0) & (largest < 10), 12).otherwise(4)).otherwise(0),
        F.when(S.has_any(text, V.DETAIL_DISCLOSURE), 0).when(S.has_any(text, V.THIN_DISCLOSURE), 2).otherwise(1),
        F.when(F.col("primary"), 0).when(F.col("usable"), 4).otherwise(8),
        short(S.or_else(F.col("buyer_motive"), F.col("why"))) + short(F.col("seller_motive")),
        F.when(F.col("classic"), 2).otherwise(0),
    ]


def item_score(title: Column, text: Column, url: Column) -> Column:
    """How likely a raw item is evidence of a completed deal: points for its source and wording."""
    url = unwrapped(url)
    points = (
        (U.is_usable_article(url, ()) & S.is_primary_source(url), 1000), (S.has_any(text, V.COMPLETION_HINTS), 500), (S.has_any(text, V.CONTROL_HINTS), 220), (S.has_any(text, V.ASSET_SWAP_HINTS), 180),
        (S.has_any(text, V.SHARE_TRANSFER_HINTS), 120), (S.is_completed(text), 120), (S.has_deal_value(text), 40), (S.has_any(title, V.SKIP_TITLE_HINTS), -300),
    )
    return sum((F.when(c, p).otherwise(0) for c, p in points[1:]), F.when(points[0][0], points[0][1]).otherwise(0))


def completion_funnel(items: DataFrame) -> DataFrame:
    """How many items (title, summary, url, body) pass each step towards a completed deal, in one pass."""
    url, title, text = unwrapped(F.col("url")), F.col("title"), F.concat_ws(" ", "title", "summary")
    steps = {
        "hinted": S.has_any(text, V.COMPLETION_HINTS), "kept": ~S.has_any(title, V.SKIP_TITLE_HINTS), "official": U.is_usable_article(url, ()) & S.is_primary_source(url), "with_text": F.coalesce("body", F.lit("")) != "",
        "completed": S.is_completed(F.concat_ws(" ", title, F.substring(F.coalesce("body", F.lit("")), 1, 1500))),
    }
    passed, counts = F.lit(True), [F.count("*").alias("scanned")]
    for name, step in steps.items():
        passed = passed & step
        counts.append(F.count_if(passed).alias(name))
    return items.agg(*counts)
