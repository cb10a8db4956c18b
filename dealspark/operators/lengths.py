"""Articles brought to a length: sentences kept by priority under a budget, short paragraphs merged, the best of several versions.

An article has a title, an intro and sections of a heading and paragraphs, as nested columns. All of it happens inside the row, so
nothing is shuffled but the versions of an article.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealspark.operators.articles import LEAST, MOST, article_text, size

SECTIONS = "array<struct<heading:string,paragraphs:array<string>>>"
#: Length that a report aims at: fixed values.
TARGET = (3550, 3800)
#: Characters that each paragraph, and the intro, keep before any other text is kept.
FLOOR, INTRO_FLOOR = 180, 140
#: A long paragraph has so many characters; a merged one has at most so many; an article has so many long ones.
LONG, JOINED, WANTED = 260, 520, 2


def sentences(text: Column) -> Column:
    """Sentences with the signs and blanks that belong to them; joined, they are the text but for its line breaks and blank parts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\n+|(?<=[。！？；!?])|(?<=\.)(?=[\t\n\f\r ])"), lambda s: size(s) > 0)


def clipped(text: Column, most: Column) -> Column:
    """The beginning of a text with a full stop, in so many characters: up to the last comma among its last 80 characters if there is one."""
    head = F.substr(F.trim(text), F.lit(1), most - 1)
    cut = F.regexp_replace(head, "(?s)[，；、,;][^，；、,;]{0,79}$", "")
    return F.concat(F.when(cut == "", head).otherwise(cut), F.lit("。"))


def _ranked(text: Column, part: Column, para: Column, place: Column, floor: int, most: Column) -> Column:
    """Sentences of a piece as (beyond the floor, class, depth, ...): what comes first in this order is kept first."""

    def placed(rows: Column) -> Column:
        # A kept sentence follows only kept ones of at least a character each, so no more than ``most`` of a piece matter.
        sizes = F.transform(rows, size)
        starts = F.aggregate(sizes, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")), lambda a, n: F.struct((a["at"] + n).alias("at"), F.array_append(a["starts"], a["at"]).alias("starts")))["starts"]
        return F.zip_with(rows, F.arrays_zip(starts.alias("start"), sizes.alias("n")), lambda s, x: F.struct(
            (x["start"] >= floor).alias("beyond"), place.alias("kind"), x["start"].alias("start"), part.alias("part"), para.alias("para"), x["n"].alias("n"), s.alias("text")))

    return F.flatten(F.transform(F.array(F.slice(sentences(text), F.lit(1), F.greatest(most, F.lit(1)))), placed))


def trimmed(articles: DataFrame, most: int = MOST) -> DataFrame:
    """Articles (title, intro, sections) of at most ``most`` characters, white space not counted; ``fits`` tells whether they are.

    Those within it stay as they are. Title and headings are kept. Of each paragraph the sentences of its first characters are kept first, then the rest; of
    both first those of the last section, of the intro, of the first section and of the middle, and of equal ones those nearer to
    the beginning of their paragraph. The first sentence in this order that doesn't fit ends the choice, so a paragraph loses
    sentences from its end only. A sentence is cut only if it is the first one and too long by itself. Sections without text left go.

    Nulls are empty. Where title and headings leave no room, an article has no text and ``fits`` tells if that was enough. Rows are
    taken one by one: repeated ones give the same, an empty table none, other columns stay. Texts of any length are read whole.
    """
    empty = F.array().cast(SECTIONS)
    base = articles.withColumns({"intro": F.coalesce("intro", F.lit("")), "sections": F.coalesce("sections", empty)})
    headings = F.aggregate("sections", F.lit(0), lambda n, s: n + size(s["heading"]))
    base = base.withColumns({"__over": size(article_text(F.col("title"), F.col("intro"), F.col("sections"))) > most, "__room": F.lit(most) - size(F.col("title")) - headings})
    last, room = F.size("sections") - 1, F.col("__room")

    def of_section(s: Column, i: Column) -> Column:
        kind = F.when(i == 0, 2).when(i == last, 0).otherwise(3)
        return F.flatten(F.transform(F.coalesce(s["paragraphs"], F.array().cast("array<string>")), lambda p, j: _ranked(p, i, j, kind, FLOOR, room)))

    pieces = F.concat(_ranked(F.col("intro"), F.lit(-1), F.lit(0), F.lit(1), INTRO_FLOOR, room), F.flatten(F.transform("sections", of_section)))
    base = base.withColumn("__all", F.when(F.col("__over"), F.array_sort(pieces)))
    start = F.struct(room.alias("left"), F.lit(0).alias("kept"), F.lit(True).alias("open"))

    def taken(a: Column, s: Column) -> Column:
        fits = a["open"] & (s["n"] <= a["left"])
        return F.struct(F.when(fits, a["left"] - s["n"]).otherwise(a["left"]).alias("left"), (a["kept"] + fits.cast("int")).alias("kept"), fits.alias("open"))

    base = base.withColumn("__n", F.aggregate("__all", start, taken)["kept"])
    cut = F.transform(F.slice("__all", 1, 1), lambda s: s.withField("text", clipped(s["text"], room)))
    base = base.withColumn("__kept", F.when(F.col("__n") > 0, F.slice(F.col("__all"), F.lit(1), F.col("__n"))).when(room >= 2, cut).otherwise(F.slice("__all", 1, 0)))

    def paragraphs(part: Column) -> Column:
        own = F.array_sort(F.transform(F.filter("__kept", lambda s: s["part"] == part), lambda s: F.struct(s["para"].alias("para"), s["start"].alias("start"), s["text"].alias("text"))))

        def joined(rows: Column) -> Column:
            return F.transform(F.array_distinct(F.transform(rows, lambda r: r["para"])), lambda p: F.trim(F.array_join(F.transform(F.filter(rows, lambda r: r["para"] == p), lambda r: r["text"]), "")))

        return F.flatten(F.transform(F.array(own), joined))

    left = F.filter(F.transform("sections", lambda s, i: F.struct(s["heading"].alias("heading"), paragraphs(i).alias("paragraphs"))), lambda s: F.size(s["paragraphs"]) > 0)
    out = base.withColumns({"intro": F.when(F.col("__over"), F.array_join(paragraphs(F.lit(-1)), "")).otherwise(F.col("intro")), "sections": F.when(F.col("__over"), left).otherwise(F.col("sections"))})
    return out.withColumn("fits", size(article_text(F.col("title"), F.col("intro"), F.col("sections"))) <= most).drop("__over", "__room", "__all", "__n", "__kept")


def merged(sections: Column, long: int = LONG, most: int = JOINED, wanted: int = WANTED) -> Column:
    """Sections in which short paragraphs are joined with those after them until ``wanted`` ones of the article are long.

    Sections are taken in order, the last one only if it is the only one, each as a whole; one with fewer than two paragraphs stays.
    A paragraph grows while it is short and the result has at most ``most`` characters. Blank paragraphs of these sections go.
    """
    none = F.array().cast("array<string>")
    texts = lambda s: F.coalesce(s["paragraphs"], none)
    n = F.size(sections)

    def closed(a: Column) -> Column:
        """The open paragraph put away, with one more long one if it became long by joining."""
        some = a["open"] != ""
        return F.struct(
            F.when(some, F.array_append(a["done"], a["open"])).otherwise(a["done"]).alias("done"), F.lit("").alias("open"),
            (a["grown"] + (some & ~a["ready"] & (size(a["open"]) >= long)).cast("int")).alias("grown"), F.lit(False).alias("ready"),
        )

    def step(a: Column, p: Column) -> Column:
        both = F.concat(F.regexp_replace(a["open"], "[。；]+$", ""), F.lit("；"), p)
        put = closed(a)
        grows = (a["open"] != "") & (size(a["open"]) < long) & (size(both) <= most)
        return F.when(grows, F.struct(a["done"].alias("done"), both.alias("open"), a["grown"].alias("grown"), F.lit(False).alias("ready"))).otherwise(
            F.struct(put["done"].alias("done"), p.alias("open"), put["grown"].alias("grown"), (size(p) >= long).alias("ready"))
        )

    def joined(paragraphs: Column) -> Column:
        first = F.struct(none.alias("done"), F.lit("").alias("open"), F.lit(0).alias("grown"), F.lit(False).alias("ready"))
        return F.aggregate(F.filter(F.transform(paragraphs, lambda p: F.trim(p)), lambda p: size(p) > 0), first, step, closed)

    def section(a: Column, x: Column) -> Column:
        s, i = x["s"], x["i"]
        due = (a["long"] < wanted) & (F.size(texts(s)) >= 2) & ((i < n - 1) | (n == 1))
        new = joined(texts(s))
        return F.struct(
            F.array_append(a["out"], F.struct(s["heading"].alias("heading"), F.when(due, new["done"]).otherwise(texts(s)).alias("paragraphs"))).alias("out"),
            (a["long"] + F.when(due, new["grown"]).otherwise(0)).alias("long"),
        )

    had = F.aggregate(F.flatten(F.transform(sections, texts)), F.lit(0), lambda k, p: k + (size(p) >= long).cast("int"))
    start = F.struct(F.array().cast(SECTIONS).alias("out"), had.alias("long"))
    indexed = F.transform(sections, lambda s, i: F.struct(s.alias("s"), i.alias("i")))
    return F.aggregate(indexed, start, section, lambda a: a["out"])


def length_score(n: Column, least: int = LEAST, most: int = MOST, target: tuple[int, int] = TARGET) -> Column:
    """(class, closeness) of a length: within the target, within the limits, too long, too short."""
    middle = (target[0] + target[1]) // 2
    near = -F.abs(n - middle)
    kind = F.when(n.between(*target), 4).when(n.between(least, most), 3).when(n < least, 1).otherwise(2)
    return F.struct(kind.alias("class"), F.when(n.between(least, most), near).when(n < least, n).otherwise(-F.abs(n - most)).cast("int").alias("closeness"))


def best_versions(versions: DataFrame, key: str, order: str, hard: Column, soft: Column, length: Column) -> DataFrame:
    """The best version of each article: fewest issues (a hard one counts ten soft ones), then the best length, then the latest.

    Issues are counts, null is none. A tie in ``order`` as well is broken by the other columns, so any repeated row may stand for it.
    """
    points = -(F.coalesce(hard, F.lit(0)) * 100 + F.coalesce(soft, F.lit(0)) * 10)
    rest = [c for c in versions.columns if c != key]
    row = F.struct(points.alias("points"), length_score(F.coalesce(length, F.lit(0))).alias("score"), F.col(order).alias("order"), F.struct(*rest).alias("row"))
    return versions.groupBy(key).agg(F.max(row).alias("best")).select(key, "best.row.*")
