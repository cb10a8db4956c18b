"""Native URL expressions; a URL that has no host gives empty results, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]+)", 1))


def bare_host(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)


def normalize_url(url: Column) -> Column:
    """Lower-case host, no fragment, no utm_ parameters; the others keep their order, blanks included."""
    kept = F.array_join(F.filter(F.split(query(url), "&"), lambda p: ~F.rlike(p, F.lit("(?i)^utm_"))), "&")
    scheme = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    return F.when(host(url) == "", F.coalesce(url, F.lit(""))).otherwise(F.concat(scheme, F.lit("://"), host(url), path(url), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def identity_key(url: Column) -> Column:
    """Host and path in lower case without closing slash; null without a path."""
    name = F.regexp_replace(F.regexp_replace(F.lower(path(url)), "/+", "/"), "/$", "")
    return F.when((host(url) != "") & (name != ""), F.concat(host(url), name))


def is_http(url: Column) -> Column:
    return F.rlike(F.coalesce(url, F.lit("")), F.lit(r"(?i)^https?://[^/?#\s]+"))


def is_homepage(url: Column) -> Column:
    """No query, no fragment, and a path that is empty or names an index."""
    plain = ~F.rlike(F.coalesce(url, F.lit("")), F.lit("[?#]"))
    return is_http(url) & plain & F.rlike(F.lower(path(url)), F.lit(r"^/?(?:(?:index|home|default)(?:\.[a-z]+)?/?)?$"))


def host_under(url: Column, domains: Sequence[str]) -> Column:
    """Whether the host is one of the domains or below one."""
    name, found = host(url), F.lit(False)
    for d in domains:
        found = found | (name == d) | F.endswith(name, F.lit("." + d))
    return found


def is_usable_article(url: Column, aggregators: Sequence[str]) -> Column:
    return is_http(url) & ~is_homepage(url) & ~host_under(url, aggregators)


def parameter(url: Column, names: Sequence[str]) -> Column:
    """The first parameter of the given names that holds a URL, decoded."""
    found = []
    for name in names:
        value = F.regexp_extract(query(url), rf"(?:^|&){name}=([^&]*)", 1)
        decoded = F.try_url_decode(value)
        found.append(F.when(is_http(decoded), decoded))
    return F.coalesce(*found)


def token_url(token: Column) -> Column:
    """The first URL inside a URL-safe base64 token."""
    token = F.regexp_replace(token, r"\s", "")
    padded = F.rpad(F.translate(token, "-_", "+/"), (F.length(token) + 3 - (F.length(token) + 3) % 4).cast("int"), F.lit("="))
    text = F.decode(F.try_to_binary(padded, F.lit("base64")), "ISO-8859-1")
    return F.nullif(F.regexp_extract(text, r"(https?://[A-Za-z0-9._~:/?#@!$&()*+,;=%\-]+)", 1), F.lit(""))


def first_link(html: Column) -> Column:
    """Canonical link, else og:url, else the first anchor's target."""
    patterns = (r'<link[^>]+rel="canonical"[^>]+href="(https?://[^"]+)"', r'<meta[^>]+property="og:url"[^>]+content="(https?://[^"]+)"', r'<a[^>]+href="(https?://[^"]+)"')
    return F.coalesce(*[F.nullif(F.regexp_extract(F.coalesce(html, F.lit("")), p, 1), F.lit("")) for p in patterns])


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles and tags."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style|noscript|svg|iframe)\b.*?</\1\s*>", " ")
    bare = F.regexp_replace(bare, r"(?s)<!--.*?-->", " ")
    from dealspark.functions.text import collapse_space, unescape

    return collapse_space(unescape(F.regexp_replace(bare, r"(?s)<[^>]*>", " ")))
