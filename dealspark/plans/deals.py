"""Queries on deal filings: signals, parties, terms, gates, ranking, identities, sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.catalogue import query
from dealspark.functions import cjk as C
from dealspark.functions import signals as S
from dealspark.functions import text as T
from dealspark.functions import vocab as V
from dealspark.operators import cases, completions, expectations, identity, reconcile, selection
from dealspark.plans.filings import filings, filings_sql

# The oracles' side: the same fixed values, in the other engine's expressions.


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(column: str, pattern: str) -> str:
    return f"regexp_matches(coalesce({column}, ''), {_q(pattern)})"


def _any(column: str, words) -> str:
    return "(" + " OR ".join(f"contains(coalesce({column}, ''), {_q(w)})" for w in words) + ")"


def _clean(column: str) -> str:
    return f"trim(regexp_replace(coalesce({column}, ''), {_q(T.SPACE)}, ' ', 'g'))"


def _lines(*columns: str) -> str:
    return " || chr(10) || ".join(f"coalesce({c}, '')" for c in columns)


def _in(column: str, words) -> str:
    return f"{column} IN ({', '.join(map(_q, words))})"


def _missing(column: str) -> str:
    return _in(f"lower({_clean(column)})", T.PLACEHOLDERS)


def _value(column: str) -> str:
    return f"(NOT {_missing(column)} AND ({_matches(_clean(column), V.DEAL_VALUE)} OR {_matches(_clean(column), '(?i)' + V.STRUCTURE)}))"


def _incomplete(column: str) -> str:
    return _matches(f"lower({_clean(column)})", "|".join(V.INCOMPLETE))


def _completed(column: str) -> str:
    bare = f"lower({_clean(column)})"
    return f"({_matches(bare, '|'.join(V.FIRM_COMPLETED))} OR ({_matches(bare, '|'.join(V.COMPLETED))} AND NOT {_incomplete(column)}))"


def _vague(column: str) -> str:
    bare = f"trim(coalesce({column}, ''))"
    return f"(length({bare}) < 2 OR lower(regexp_replace({bare}, '[^A-Za-z0-9\\x{{4e00}}-\\x{{9fa5}}]', '', 'g')) IN ('st', 'xst', 'sst') OR {_any(bare, V.VAGUE_PARTIES)})"


def _party(column: str, k: int, verbs=V.DEAL_VERBS) -> str:
    pattern = "(?s)^(.*?)(?:" + "|".join(verbs) + ")(.*)$"
    return f"trim(regexp_extract(coalesce({column}, ''), {_q(pattern)}, {k}))"


def _explicit() -> str:
    a, t = (f"coalesce(nullif({own}, ''), {_party('case_name', k)})" for own, k in (("acquirer", 1), ("target", 2)))
    return f"(NOT {_vague(a)} AND NOT {_vague(t)} AND NOT {_any(_lines('case_name', 'acquirer', 'target'), V.VAGUE_PARTIES)})"


def _host(column: str) -> str:
    return f"lower(regexp_extract(coalesce({column}, ''), '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]+)', 1))"


def _primary(column: str) -> str:
    host = _host(column)
    return "(" + " OR ".join([f"{host} = {_q(d)} OR {host} LIKE {_q('%.' + d)}" for d in V.PRIMARY_DOMAINS]) + f" OR split_part({host}, '.', 1) IN ('ir', 'investor', 'investors'))"


def _usable(column: str) -> str:
    path = f"regexp_extract(coalesce({column}, ''), '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1)"
    home = f"(NOT regexp_matches({column}, '[?#]') AND regexp_matches(lower({path}), '^/?(?:(?:index|home|default)(?:\\.[a-z]+)?/?)?$'))"
    return f"(regexp_matches(coalesce({column}, ''), '(?i)^https?://[^/?#\\s]+') AND NOT {home})"


_RICH = _lines("title", "why", "status", "url")
_EVIDENCE = _lines("deal_value", "why", "title", "highlights")
_STATUS = f"(NOT ({_incomplete('status')} AND NOT {_completed('status')}) AND (classic OR completed OR {_completed('status')}))"
_TERMS = f"({_value(_EVIDENCE)} OR ({_primary('url')} AND ({_any(_RICH, V.DETAIL_DISCLOSURE)} OR (completed AND {_any(_RICH, V.RICH_DISCLOSURE)}))))"
_TOPIC = f"(classic OR (completed AND NOT ({_incomplete('status')} AND NOT {_completed('status')})))"
_DENIED = _any(f"lower({_lines('case_name', 'acquirer', 'target', 'title', 'why')})", ("星河七七科技", "停牌"))
_DENY_LIST = "星河七七科技， 停牌;\n"
_CASE = ("title", "status", "deal_value", "why", "highlights", "url", "buyer_motive", "seller_motive")


@query(
    "filing_signals",
    f"""SELECT id, {_clean('highlights')} IN ('', '-', '未披露', '公开资料未披露', '未知', '不详', '无') OR (contains({_clean('highlights')}, '未披露') AND length({_clean('highlights')}) < 30) AS weak,
    NOT {_missing('deal_value')} AND {_matches(_clean('deal_value'), V.DEAL_NUMBER)} AS number, {_value('deal_value')} AS value, {_completed('status')} AS done, {_incomplete('status')} AS undone,
    {_incomplete('status')} AND NOT {_completed('status')} AS unresolved, {_any(_RICH, V.RICH_DISCLOSURE)} AS rich, {_any(_RICH, V.DETAIL_DISCLOSURE)} AS detailed, {_any('title', V.THIN_DISCLOSURE)} AS thin, {_any('region', V.DOMESTIC)} AS domestic,
    {_clean('body')} = '' OR length({_clean('body')}) > 420 OR {_any('body', V.NOISY_VALUE)} AS noisy, {_matches('body', V.TRANSACTION_QUANTITY)} AS quantity, {_matches(_clean('deal_value'), V.TRANSACTION_QUANTITY)} OR {_any('deal_value', V.PAYMENT_HINTS)} AS payment
    FROM {filings_sql(*_CASE, 'region', 'body')}""",
)
def filing_signals(spark: SparkSession, d: str) -> DataFrame:
    f, rich = filings(spark, d, *_CASE, "region", "body"), S.lines(*map(F.col, ("title", "why", "status", "url")))
    status, value = F.col("status"), F.col("deal_value")
    return f.select(
        "id", S.is_weak_disclosure(F.col("highlights")).alias("weak"), S.has_deal_number(value).alias("number"), S.has_deal_value(value).alias("value"), S.is_completed(status).alias("done"), S.is_incomplete(status).alias("undone"),
        S.is_unresolved(status).alias("unresolved"), S.has_any(rich, V.RICH_DISCLOSURE).alias("rich"), S.has_any(rich, V.DETAIL_DISCLOSURE).alias("detailed"), S.has_any(F.col("title"), V.THIN_DISCLOSURE).alias("thin"),
        S.is_domestic(F.col("region")).alias("domestic"), S.is_noisy_value(F.col("body")).alias("noisy"), S.has_quantity(F.col("body")).alias("quantity"), S.has_payment(value).alias("payment"),
    )


@query(
    "party_checks",
    f"""SELECT id, {_vague('acquirer')} AS vague_acquirer, {_vague('target')} AS vague_target, {_explicit()} AS explicit, {_party('case_name', 1)} AS inferred_acquirer, {_party('case_name', 2)} AS inferred_target,
    {_DENIED} AS denied FROM {filings_sql('title', 'why')}""",
)
def party_checks(spark: SparkSession, d: str) -> DataFrame:
    f = filings(spark, d, "title", "why")
    name, a, t = (F.col(c) for c in ("case_name", "acquirer", "target"))
    inferred = S.split_parties(name)
    denied = S.is_denied(S.lines(name, a, t, F.col("title"), F.col("why")), _DENY_LIST)
    return f.select("id", S.is_vague_party(a).alias("vague_acquirer"), S.is_vague_party(t).alias("vague_target"), S.has_explicit_parties(name, a, t).alias("explicit"), inferred[0].alias("inferred_acquirer"), inferred[1].alias("inferred_target"), denied.alias("denied"))


_RULES = " ".join(f"WHEN {_any('lower(t)' if lower else 't', words)} THEN {_q(category)}" for words, lower, category in V.CATEGORY_RULES)


@query(
    "category_infer",
    f"""SELECT id, CASE {_RULES} ELSE {_q(V.DEFAULT_CATEGORY)} END AS inferred, CASE WHEN {_in('category', V.CATEGORIES)} THEN category {' '.join(f"WHEN contains(category, {_q(c)}) THEN {_q(c)}" for c in V.CATEGORIES)} ELSE {_q(V.DEFAULT_CATEGORY)} END AS safe,
    CASE WHEN contains(t, '2026') THEN '2026' WHEN contains(t, '2025') THEN '2025' ELSE regexp_extract(t, '(20(?:2[0-6]|1[0-9]))', 1) END AS year, {_in("lower(flag)", V.TRUE_WORDS)} AS flag
    FROM (SELECT *, title || ' ' || summary AS t FROM {filings_sql('title', 'summary', 'category', 'flag')})""",
)
def category_infer(spark: SparkSession, d: str) -> DataFrame:
    f, text = filings(spark, d, "title", "summary", "category", "flag"), F.concat_ws(" ", "title", "summary")
    return f.select("id", S.inferred_category(text).alias("inferred"), S.safe_category(F.col("category")).alias("safe"), S.completed_year(text).alias("year"), S.parse_bool(F.col("flag")).alias("flag"))


_LABELS = ", ".join(f"CASE WHEN {_matches('t', '(?i)' + p)}{' AND NOT ' + _matches('t', V.TERMS[2][0]) if label == '股份支付' else ''} THEN {_q(label)} END" for p, label in V.TERMS)


def _distinct(column: str, pattern: str, limit: int, group: int = 0) -> str:
    """The first distinct matches in order."""
    found = f"regexp_extract_all(coalesce({column}, ''), {_q(pattern)}, {group})"
    return f"list_filter({found}, lambda x, i: list_position({found}, x) = i)[1:{limit}]"


@query(
    "transaction_terms",
    f"""SELECT id, array_to_string(list_concat({_distinct('t', V.DEAL_VALUE, 6)}, list_filter([{_LABELS}], lambda x: x IS NOT NULL))[1:8], '；') AS terms
    FROM (SELECT id, {_clean("concat_ws('；', " + ", ".join(f"CASE WHEN NOT {_missing(c)} THEN {c} END" for c in ('deal_value', 'summary', 'body')) + ')')} AS t FROM {filings_sql('deal_value', 'summary', 'body')})""",
)
def transaction_terms(spark: SparkSession, d: str) -> DataFrame:
    return filings(spark, d, "deal_value", "summary", "body").select("id", S.transaction_terms(F.col("deal_value"), F.col("summary"), F.col("body")).alias("terms"))


def _percent(number: str) -> str:
    return f"coalesce(regexp_replace(regexp_replace(format('{{:.4f}}', {number}), '0+$', ''), '\\.$', '') || '%', '')"


_TRANSFER = "coalesce(" + ", ".join(f"TRY_CAST(nullif(regexp_extract({_clean('body')}, {_q(p)}, 1), '') AS DOUBLE)" for p in V.TRANSFER_PERCENTS) + ")"
_PRICES = f"CASE WHEN len({_distinct(_clean('body'), V.SHARE_PRICE, 3, 1)}) > 0 THEN {_distinct(_clean('body'), V.SHARE_PRICE, 3, 1)} ELSE {_distinct(_clean('body'), V.ANY_SHARE_PRICE, 3, 1)} END"
_COUNTS = _distinct(_clean("body"), V.SHARE_COUNT, 3, 1)


@query(
    "percents_and_prices",
    f"""SELECT id, {_percent("list_max(list_transform(regexp_extract_all(body, '([0-9]+(?:\\.[0-9]+)?)\\s*%', 1), lambda x: CAST(x AS DOUBLE)))")} AS largest, {_percent(_TRANSFER)} AS transfer,
    array_to_string({_PRICES}, ',') AS prices, array_to_string({_COUNTS}, ' ') AS counts FROM {filings_sql('body')}""",
)
def percents_and_prices(spark: SparkSession, d: str) -> DataFrame:
    body = F.col("body")
    return filings(spark, d, "body").select("id", S.largest_percent(body).alias("largest"), S.transfer_percent(body).alias("transfer"), F.array_join(S.share_prices(body), ",").alias("prices"), F.array_join(S.share_counts(body), " ").alias("counts"))


@query(
    "deal_value_verified",
    f"""SELECT id, CASE WHEN price IS NULL THEN v WHEN n IS NULL THEN w WHEN contains(w, amount) THEN w ELSE w || '；按' || n || '股和' || price || '测算，金额上限约' || amount END AS value FROM (
    SELECT *, CASE WHEN {_matches('v', V.ANY_SHARE_PRICE)} THEN regexp_replace(v, '[0-9]{{1,4}}(\\.[0-9]+)?\\s*(元/股|港元/股|美元/股)$', price) WHEN v <> '' THEN v || '；披露的每股价格为' || price ELSE '披露的每股价格为' || price END AS w,
    format('{{:,}}', CAST(round_even(CAST(regexp_extract(price, '^([0-9.]+)', 1) AS DOUBLE) * CAST(replace(n, ',', '') AS DOUBLE), 0) AS BIGINT)) || '元' AS amount
    FROM (SELECT id, {_clean('deal_value')} AS v, ({_PRICES})[1] AS price, ({_COUNTS})[1] AS n FROM {filings_sql('deal_value', 'body')}))""",
)
def deal_value_verified(spark: SparkSession, d: str) -> DataFrame:
    f = filings(spark, d, "deal_value", "body").withColumns({"price": F.get(S.share_prices(F.col("body")), F.lit(0)), "n": F.get(S.share_counts(F.col("body")), F.lit(0))})
    return f.select("id", S.verified_value(F.col("deal_value"), F.col("price"), F.col("n")).alias("value"))


_DATES = ", ".join(f"nullif({_clean(f'regexp_extract(body, {_q(chr(40) + chr(63) + chr(115) + chr(41) + p)}, 1)')}, '')" for p in V.COMPLETION_DATES)


@query(
    "completion_status",
    f"SELECT id, coalesce({_DATES}, strftime(o_orderdate, '%Y-%m-%d')) || '；已完成过户/交割' AS status FROM {filings_sql('body')}",
)
def completion_status(spark: SparkSession, d: str) -> DataFrame:
    return filings(spark, d, "body").select("id", S.completion_status(F.col("body"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("status"))


@query(
    "stock_identity",
    f"""SELECT id, regexp_extract(summary || ' ' || body, '证券简称[:：]\\s*([^\\s，。；;]+)', 1) AS short, regexp_extract(body, '(?:证券简称：\\S+ |^)(\\S+有限公司)(?: 关于|（以下简称)', 1) AS full,
    CASE WHEN starts_with(body, '公司向') THEN regexp_extract(body, '转让给([^，。.]*?)(?:，|股份)', 1) ELSE regexp_extract(body, '^控股股东变更为([^，。.]*)。', 1) END AS buyer FROM {filings_sql('summary', 'body')}""",
)
def stock_identity(spark: SparkSession, d: str) -> DataFrame:
    f = filings(spark, d, "summary", "body")
    full, short = S.stock_identity(F.col("body"), F.col("summary"))
    to = F.when(F.rlike("body", F.lit("^(?:控股股东变更|公司向)")), S.buyer(F.col("body"), S.alias_map(F.col("body")))).otherwise("")
    return f.select("id", short.alias("short"), full.alias("full"), to.alias("buyer"))


_GATES = f"""CASE WHEN NOT {_TOPIC} THEN 'topic' WHEN {_DENIED} THEN 'excluded_term' WHEN NOT {_explicit()} THEN 'parties' WHEN NOT {_STATUS} THEN 'completion'
    WHEN NOT {_usable('u')} THEN 'usable_url' WHEN NOT {_primary('u')} THEN 'primary_source' WHEN NOT {_TERMS.replace('coalesce(url,', 'coalesce(u,')} THEN 'terms' ELSE 'accepted' END"""
_UNWRAPPED = f"(SELECT * EXCLUDE (url), url, CASE WHEN contains(url, '/go?u=') THEN 'https://www.hkexnews.hk/news/' || regexp_extract(url, '([0-9]+)\\.pdf$', 1) || '.pdf' ELSE url END AS u FROM {filings_sql(*_CASE)})"


@query("report_gates", f"SELECT {_GATES} AS reason, count(*) AS n FROM {_UNWRAPPED} GROUP BY 1")
def report_gates(spark: SparkSession, d: str) -> DataFrame:
    reason = expectations.first_failing(cases.report_gates(_DENY_LIST))
    return cases.with_signals(filings(spark, d, *_CASE)).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(
    "report_readiness",
    f"""SELECT count(*) AS cases, count(*) FILTER (WHERE {_explicit()}) AS explicit, count(*) FILTER (WHERE {_STATUS}) AS done, count(*) FILTER (WHERE {_usable('u')}) AS with_url, count(*) FILTER (WHERE {_usable('u')} AND {_primary('u')}) AS primary_url,
    count(*) FILTER (WHERE ready) AS ready, count(*) FILTER (WHERE ready AND {_primary('u')} AND {_usable('u')}) AS ready_with_source, count(*) FILTER (WHERE classic) AS classic
    FROM (SELECT *, {_explicit()} AND {_STATUS} AND ({_usable('u')} OR {_TOPIC}) AND {_TERMS.replace('coalesce(url,', 'coalesce(u,')} AS ready FROM {_UNWRAPPED})""",
)
def report_readiness(spark: SparkSession, d: str) -> DataFrame:
    f = cases.with_signals(filings(spark, d, *_CASE))
    tests = {"explicit": "explicit", "done": "done", "with_url": "usable", "primary_url": "primary", "ready": "ready", "ready_with_source": "ready and primary", "classic": "classic"}
    return f.agg(F.count("*").alias("cases"), *[F.count_if(F.expr(c)).alias(n) for n, c in tests.items()])


_DISCLOSED = _lines("title", "why", "status")
_CONTROL = f"(contains(case_name, '控制权') OR ({_any(_DISCLOSED, V.CONTROL_HINTS)} AND NOT {_any(_DISCLOSED, V.NON_CONTROL_HINTS)}))"
_P_URL = f"CASE WHEN {_usable('u')} AND {_primary('u')} THEN 0 WHEN {_usable('u')} THEN 4 ELSE 8 END"
_P_DEAL = f"""CASE WHEN {_value(_lines('deal_value', 'highlights', 'why', 'title'))} THEN 0 WHEN {_primary('u')} AND {_usable('u')} THEN CASE WHEN {_any(_RICH, V.DETAIL_DISCLOSURE)} THEN 1 ELSE 2 END ELSE 5 END
    + CASE WHEN regexp_matches(case_name, '[0-9]+(?:\\.[0-9]+)?%股份') AND NOT {_CONTROL} AND NOT {_matches(_DISCLOSED, '购买资产|资产置换|发行股份')} THEN 4 ELSE 0 END"""
_ORDER = f"""CASE WHEN {_STATUS} THEN 0 ELSE 10 END AS p1, {_P_DEAL} AS p2, CASE WHEN {_any(_DISCLOSED, V.DETAIL_DISCLOSURE)} THEN 0 WHEN {_any(_DISCLOSED, V.THIN_DISCLOSURE)} THEN 2 ELSE 1 END AS p3, {_P_URL} AS p4,
    CASE WHEN length({_clean("coalesce(nullif(buyer_motive, ''), why)")}) < 15 THEN 1 ELSE 0 END + CASE WHEN length({_clean('seller_motive')}) < 15 THEN 1 ELSE 0 END AS p5, CASE WHEN classic THEN 2 ELSE 0 END AS p6"""


@query("report_priority", f"SELECT id, p1, p2, p3, p4, p5, p6 FROM (SELECT id, case_name, {_ORDER} FROM {_UNWRAPPED}) ORDER BY p1, p2, p3, p4, p5, p6, case_name, id LIMIT 300")
def report_priority(spark: SparkSession, d: str) -> DataFrame:
    f = cases.with_signals(filings(spark, d, *_CASE))
    names = [f"p{i}" for i in range(1, 7)]
    rows = f.select("id", "case_name", *[p.alias(n) for p, n in zip(cases.report_penalties(), names, strict=True)])
    return selection.top_k(rows, [F.col(n) for n in (*names, "case_name", "id")], 300).select("id", *names)


_TEXT = "title || ' ' || summary"
_SCORE = " + ".join(f"CASE WHEN {c} THEN {p} ELSE 0 END" for c, p in (
    (f"({_usable('u')} AND {_primary('u')})", 1000), (_any(_TEXT, V.COMPLETION_HINTS), 500), (_any(_TEXT, V.CONTROL_HINTS), 220), (_any(_TEXT, V.ASSET_SWAP_HINTS), 180), (_any(_TEXT, V.SHARE_TRANSFER_HINTS), 120),
    (_completed(f"({_TEXT})"), 120), (_value(f"({_TEXT})"), 40), (_any("title", V.SKIP_TITLE_HINTS), -300)))


@query("raw_item_scores", f"SELECT id, CAST(score AS INT) AS score FROM (SELECT id, {_SCORE} AS score, o_orderdate, title FROM {_UNWRAPPED.replace(filings_sql(*_CASE), filings_sql('title', 'summary', 'url'))}) ORDER BY score DESC, o_orderdate DESC, title DESC, id LIMIT 300")
def raw_item_scores(spark: SparkSession, d: str) -> DataFrame:
    f = filings(spark, d, "title", "summary", "url")
    rows = f.select("id", cases.item_score(F.col("title"), F.concat_ws(" ", "title", "summary"), F.col("url")).alias("score"), "o_orderdate", "title")
    return selection.top_k(rows, [F.desc("score"), F.desc("o_orderdate"), F.desc("title"), F.asc("id")], 300).select("id", "score")


@query(
    "completion_funnel",
    f"""SELECT count(*) AS scanned, count(*) FILTER (WHERE h) AS hinted, count(*) FILTER (WHERE h AND s) AS kept, count(*) FILTER (WHERE h AND s AND o) AS official, count(*) FILTER (WHERE h AND s AND o AND b) AS with_text, count(*) FILTER (WHERE h AND s AND o AND b AND c) AS completed
    FROM (SELECT {_any(_TEXT, V.COMPLETION_HINTS)} AS h, NOT {_any('title', V.SKIP_TITLE_HINTS)} AS s, {_usable('u')} AND {_primary('u')} AS o, body <> '' AS b, {_completed("(title || ' ' || substr(body, 1, 1500))")} AS c
    FROM {_UNWRAPPED.replace(filings_sql(*_CASE), filings_sql('title', 'summary', 'url', 'body'))})""",
)
def completion_funnel(spark: SparkSession, d: str) -> DataFrame:
    return cases.completion_funnel(filings(spark, d, "title", "summary", "url", "body"))


def _report_party(column: str) -> str:
    bare = f"regexp_replace(trim(lower(coalesce({column}, ''))), '（.*?）|\\(.*?\\)', '', 'g')"
    bare = f"regexp_replace(regexp_replace({bare}, {_q('(?i)' + '|'.join(V.REPORT_SUFFIXES))}, '', 'g'), {_q(V.SEPARATORS)}, '', 'g')"
    return f"CASE WHEN {_vague(bare)} THEN '' ELSE {bare} END"


def _title_key(column: str) -> str:
    bare = f"split_part(replace(lower({column}), '：', ':'), ':', 1)"
    for pattern in (V.NAME_DATE, V.NAME_AMOUNT, "|".join(V.NAME_BOILERPLATE), r"[^\p{L}\p{N}_]+"):
        bare = f"regexp_replace({bare}, {_q(pattern)}, '', 'g')"
    return f"substr({bare}, 1, 80)"


_URL_KEY = f"""CASE WHEN regexp_matches(url, '^https?://[^/]') THEN nullif(rtrim(regexp_replace(lower(regexp_extract(url, '://([^?#]*)', 1)), '/+', '/', 'g'), '/'), lower(regexp_extract(url, '://([^/?#]*)', 1))) END"""
_KEYS = f"""SELECT id, kind || k AS key FROM (
    SELECT id, 'party:' AS kind, CASE WHEN a <> '' AND t <> '' THEN a || '->' || t END AS k FROM parts UNION ALL SELECT id, 'name:', nullif({_title_key('case_name')}, '') FROM parts UNION ALL SELECT id, 'url:', {_URL_KEY} FROM parts) WHERE k IS NOT NULL"""
_PARTS = f"""parts AS (SELECT *, {_report_party(f"coalesce(nullif(acquirer, ''), {_party('case_name', 1)})")} AS a, {_report_party(f"coalesce(nullif(target, ''), {_party('case_name', 2)})")} AS t FROM {filings_sql('url')})"""


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    f = filings(spark, d, "url")
    return f.select("id", "o_orderdate", identity.case_keys(F.col("case_name"), F.col("acquirer"), F.col("target"), F.col("url")).alias("keys"))


@query("case_keys", f"WITH {_PARTS} {_KEYS}")
def case_keys(spark: SparkSession, d: str) -> DataFrame:
    return _keyed(spark, d).select("id", F.explode("keys").alias("key"))


_HELD = "(x.v = y.v OR (length(x.v) >= {0} AND length(y.v) >= {0} AND (contains(x.v, y.v) OR contains(y.v, x.v))))"
_OLD = "o_orderdate < TIMESTAMP '1996-06-01'"


@query(
    "history_split",
    f"""WITH {_PARTS}, ks AS (SELECT k.*, p.o_orderdate, p.a, p.t FROM ({_KEYS}) k JOIN parts p ON p.id = k.id), old AS (SELECT DISTINCT key, a, t FROM ks WHERE {_OLD}), own AS (SELECT * FROM ks WHERE NOT ({_OLD})),
    named AS (SELECT DISTINCT substr(key, 6) AS v FROM old WHERE key LIKE 'name:%'), x AS (SELECT DISTINCT key, substr(key, 6) AS v FROM own WHERE key LIKE 'name:%'),
    px AS (SELECT DISTINCT key, a, t FROM own WHERE key LIKE 'party:%'), py AS (SELECT DISTINCT a, t FROM old WHERE key LIKE 'party:%'),
    hit AS (SELECT key FROM own WHERE key IN (SELECT key FROM old) UNION SELECT x.key FROM x JOIN named y ON {_HELD.format(6)}
      UNION SELECT px.key FROM px JOIN py ON (px.a = py.a OR (length(px.a) >= 3 AND length(py.a) >= 3 AND (contains(px.a, py.a) OR contains(py.a, px.a)))) AND (px.t = py.t OR (length(px.t) >= 3 AND length(py.t) >= 3 AND (contains(px.t, py.t) OR contains(py.t, px.t)))))
    SELECT id, id IN (SELECT id FROM own WHERE key IN (SELECT key FROM hit)) AS seen FROM parts WHERE NOT ({_OLD})""",
)
def history_split(spark: SparkSession, d: str) -> DataFrame:
    """Whether an older filing had the same deal."""
    keyed, old = _keyed(spark, d), F.col("o_orderdate") < F.lit("1996-06-01").cast("timestamp_ntz")
    return identity.split_by_history(keyed.where(~old), keyed.where(old)).select("id", "seen")


@query("case_dedupe")
def case_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Filings kept by a fuzzy first-wins pass over all their keys."""
    return identity.fuzzy_first_wins(_keyed(spark, d))


@query(
    "name_forms",
    f"""SELECT id, trim(regexp_replace(regexp_replace(coalesce(acquirer, ''), '（.*?）|\\(.*?\\)', '', 'g'), {_q('(?i)' + '|'.join(V.NAME_FORMS))}, '', 'g')) AS compact FROM {filings_sql()}""",
)
def name_forms(spark: SparkSession, d: str) -> DataFrame:
    return filings(spark, d).select("id", C.compact_name(F.col("acquirer")).alias("compact"))


@query("completed_deals")
def completed_deals(spark: SparkSession, d: str) -> DataFrame:
    """Completed deals of the filings from mid-1996 on that no older filing had."""
    old = F.col("o_orderdate") < F.lit("1996-06-01").cast("timestamp_ntz")
    f = filings(spark, d, "title", "summary", "url", "region", "body").withColumn("published", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return completions.completed_deals(f.where(~old), _keyed(spark, d).where(old)).select("id", "kind", "case_name", "acquirer", "target", "category", "deal_value", "status")


@query("reconciled_urls")
def reconciled_urls(spark: SparkSession, d: str) -> DataFrame:
    """Every third filing as a model's case row, without a sure address, against the other filings of its batch of 60 as raw items."""
    f = filings(spark, d, "title", "summary", "url", "source_name", "why").withColumns({"batch": F.floor(F.col("id") / 60), "published": F.date_format("o_orderdate", "yyyy-MM-dd")})
    rows = f.where("id % 3 = 0").select("batch", "id", F.when(F.col("id") % 2 == 0, F.col("url")).otherwise("-").alias("url"), "source_name", F.lit("-").alias("published"), "acquirer", "target", F.concat_ws(" ", "case_name", "why").alias("description"))
    items = f.where("id % 3 <> 0").select("batch", F.col("id").alias("place"), "url", "title", "summary", "source_name", F.lit("收购").alias("query"), "published")
    return reconcile.reconciled(rows, items)
