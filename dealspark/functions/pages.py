"""Text and links of web pages by a tokeniser that reads each page once.

The scanner goes from one ``<`` to the next: tags with their attributes, comments and declarations, raw-text elements. Every search either moves
on behind what it has found or ends the page, so the time is linear in the page's length, unclosed markup included. Character
references are read by the full table of the standard, or by a given table and no others.

Defined cases: a null page reads like an empty one; a tag, comment, script or style that is never closed takes the rest of the page; an end
tag without a start is ignored, one with unclosed elements inside closes them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from dealspark.functions import text as T
from dealspark.session import ship_package, small_batches

#: Elements whose text no reader sees, elements without an end, elements whose content isn't markup, elements that hold a page's matter.
HIDDEN = frozenset(("script", "style", "noscript", "svg", "iframe"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
RAW = ("script", "style")
MATTER = frozenset(("main", "article"))
#: Pages whose pieces a task holds as Python objects at once.
CHUNK = 32
#: Least characters of a main or article element that stands for the page.
LEAST_MATTER = 200

_NAME = re.compile(r"[a-zA-Z][^\t\n\r\f />\x00]*+")
# possessive, so that no attribute is read twice
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+)?+""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
_COMMENT_END = re.compile("--!?>")


def decoder(references: Mapping[str, str] | None) -> Callable[[str], str]:
    """Reads character references in one pass: all of the standard, else the given ones as they are written, longer ones first."""
    if references is None:
        return unescape
    known = re.compile("|".join(re.escape(r) for r in sorted(references, key=len, reverse=True)))
    return lambda text: known.sub(lambda found: references[found[0]], text) if "&" in text else text


def tokens(page: str, decoded: Callable[[str], str] = unescape) -> Iterator[tuple[str, str, dict[str, str]]]:
    """('text', text, {}), ('start', name, attributes), ('empty', name, attributes) for a tag that closes itself, and ('end', name, {})."""
    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            mark = size
        if mark > at:
            yield "text", decoded(page[at:mark]), {}
        if mark == size:
            return
        following = page[mark + 1 : mark + 2]
        if following.isascii() and following.isalpha():
            name = _NAME.match(page, mark + 1)
            found, stop = {}, name.end()
            while True:
                part = _ATTRIBUTE.match(page, stop)
                stop = part.end()
                if part[1] is None:
                    break
                found.setdefault(part[1].lower(), decoded(next((v for v in part.groups()[1:] if v is not None), "")))
            if page[stop : stop + 1] != ">":
                return
            tag, closed = name[0].lower(), page[stop - 1] == "/"
            yield ("empty" if closed else "start"), tag, found
            at = stop + 1
            if tag in _RAW_END and not closed:
                end = _RAW_END[tag].search(page, at)
                if end is None:
                    return
                at = end.start()
            continue
        if following == "/" and (name := _NAME.match(page, mark + 2)):
            stop = page.find(">", name.end())
            if stop >= 0:
                yield "end", name[0].lower(), {}
            at = stop + 1
        elif page.startswith("<!--", mark):
            end = _COMMENT_END.search(page, mark + 2)
            stop = end.end() - 1 if end else -1
            at = stop + 1
        elif following and following in "!?/":
            stop = page.find(">", mark + 2)
            at = stop + 1
        else:
            yield "text", "<", {}
            stop, at = mark, mark + 1
        if stop < 0:
            return


def read_page(page: str | None, decoded: Callable[[str], str] = unescape, least: int = LEAST_MATTER) -> dict:
    """title, text, matter (the text of the largest main or article element of at least so many characters, else null), canonical, og_url, links."""
    pieces: list[str] = []
    title: list[str] = []
    links: list[str] = []
    named = {"canonical": None, "og_url": None}
    stack: list[tuple[str, int, int]] = []  # name, pieces and characters before it
    inside, length, best = Counter(), 0, (0, 0, 0)

    def close(entry: tuple[str, int, int]) -> None:
        nonlocal best
        name, first, before = entry
        inside[name] -= 1
        hidden_count[0] -= name in HIDDEN
        if name in MATTER and length - before > best[0]:
            best = (length - before, first, len(pieces))

    hidden_count = [0]
    for kind, value, attributes in tokens(page or "", decoded):
        if kind == "text":
            if not hidden_count[0]:
                pieces.append(value)
                length += len(value.strip())
                if inside["title"] and not inside["body"]:
                    title.append(value)
        elif kind == "end":
            if inside[value]:
                while True:
                    entry = stack.pop()
                    close(entry)
                    if entry[0] == value:
                        break
        else:
            if value == "a" and attributes.get("href") is not None:
                links.append(attributes["href"].strip())
            elif value == "link" and attributes.get("rel", "").strip().lower() == "canonical" and named["canonical"] is None:
                named["canonical"] = attributes.get("href", "").strip()
            elif value == "meta" and attributes.get("property") == "og:url" and named["og_url"] is None:
                named["og_url"] = attributes.get("content", "").strip()
            if kind == "start" and value not in VOID:
                stack.append((value, len(pieces), length))
                inside[value] += 1
                hidden_count[0] += value in HIDDEN
    while stack:
        close(stack.pop())
    matter = " ".join(pieces[best[1] : best[2]]) if best[0] >= least else None
    return {"title": " ".join(title), "text": " ".join(pieces), "matter": matter, **named, "links": links}


_READ = "title string, text string, matter string, canonical string, og_url string, links array<string>"


def read_pages(html: Column, references: Mapping[str, str] | None = None, least: int = LEAST_MATTER) -> Column:
    """A struct of title, text, matter, canonical, og_url and links, in Arrow batches; null pages read like empty ones.

    ``references`` holds the character references that are read, as they are written, if not all of the standard; ``least`` the least characters of a matter.
    """
    ship_package(SparkSession.active())
    small_batches(SparkSession.active())
    kind = pa.struct([(c.split()[0], pa.list_(pa.string()) if "array" in c else pa.string()) for c in _READ.split(", ")])

    @arrow_udf(f"struct<{', '.join(':'.join(c.split()) for c in _READ.split(', '))}>")
    def read(pages: pa.Array) -> pa.Array:
        decoded = decoder(references)
        parts = [pa.array([read_page(p.as_py(), decoded, least) for p in pages[at : at + CHUNK]], type=kind) for at in range(0, len(pages), CHUNK)]
        return pa.concat_arrays(parts) if parts else pa.array([], type=kind)

    return read(html)


def page_text(html: Column, longest: int | None = None) -> Column:
    """What a reader sees of a page, white space collapsed; the first ``longest`` characters if that is given."""
    text = T.collapse_space(read_pages(html)["text"])
    return text if longest is None else F.substring(text, 1, longest)


def absolute(link: Column, base: Column) -> Column:
    """A link as seen from the page at ``base``; null for those that lead to no page."""
    site = F.regexp_extract(F.coalesce(base, F.lit("")), r"^(https?)://[^/?#]+", 0)
    folder = F.regexp_replace(F.regexp_extract(F.coalesce(base, F.lit("")), r"^https?://[^/?#]+([^?#]*)", 1), "[^/]*$", "")
    own = F.when(F.rlike(link, F.lit("(?i)^https?://")), link)
    own = own.when(F.rlike(link, F.lit(r"^(?:#|$|[A-Za-z][A-Za-z0-9+.\-]*:)")) | (site == ""), None)
    own = own.when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(site, "^https?:", 0), link))
    return own.when(F.startswith(link, F.lit("/")), F.concat(site, link)).otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))


def original_link(read: Column, usable) -> Column:
    """The canonical address, else og:url, else the first anchor's target, of those that are ``usable``; null if none is."""
    decoded = F.transform(read["links"], lambda x: F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x))
    offered = F.concat(F.array(read["canonical"], read["og_url"]), decoded)
    return F.get(F.filter(offered, lambda x: x.isNotNull() & usable(x)), 0)
