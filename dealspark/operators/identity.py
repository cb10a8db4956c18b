"""Case identities: tagged keys, fuzzy equality of keys by joins on character runs, history splits and first-wins dedupe.

Two keys of one kind match if they are equal; party keys also if both sides match, names also if one holds the other. Holding is
looked up by a run of characters of the shorter name, nearly as long as itself, among the runs of the longer ones and confirmed
then, so that nothing is compared with everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealspark.functions import signals as S
from dealspark.functions import text as T
from dealspark.functions import urls as U
from dealspark.functions import vocab as V
from dealspark.session import Scratch

#: Least characters of the shorter of two names that may match by holding.
LEAST_PARTY, LEAST_NAME = 3, 6
_PREFIX = r"^(?:weekly|backfill)_[0-9]{8}_[0-9]{6}_"


def report_party(name: Column) -> Column:
    """A party for identity in reports: lower case, without brackets, legal forms and separators; empty if vague."""
    bare = F.regexp_replace(F.trim(F.lower(F.coalesce(name, F.lit("")))), r"（.*?）|\(.*?\)", "")
    bare = F.regexp_replace(F.regexp_replace(bare, "(?i)" + "|".join(V.REPORT_SUFFIXES), ""), V.SEPARATORS, "")
    return T.bound(bare, lambda b: F.when(S.is_vague_party(b), "").otherwise(b))


def weekly_party(name: Column) -> Column:
    """The same for weekly tables, whose lists differ."""
    bare = F.regexp_replace(T.normalize_text(name), r"（.*?）|\(.*?\)", "")
    bare = F.regexp_replace(F.regexp_replace(bare, "(?i)" + "|".join(V.WEEKLY_SUFFIXES), ""), V.SEPARATORS, "")
    return T.bound(bare, lambda b: F.when(b.isin(*T.PLACEHOLDERS) | S.has_any(b, V.UNKNOWN_PARTIES), "").otherwise(b))


def case_title(name: Column, boilerplate: Sequence[str] = V.NAME_BOILERPLATE) -> Column:
    """What a case name says of the deal: before the colon, without run prefix, dates, amounts, set phrases and signs; 80 characters."""
    bare = F.regexp_replace(F.trim(F.lower(F.coalesce(name, F.lit("")))), _PREFIX, "")
    bare = F.split(bare, "[:：]", 2)[0]
    for pattern in (V.NAME_DATE, V.NAME_AMOUNT, "|".join(boilerplate), r"[^\p{L}\p{N}_]+"):
        bare = F.regexp_replace(bare, pattern, "")
    return F.substring(bare, 1, 80)


def url_identity(url: Column) -> Column:
    """Host and decoded path in lower case; null without either."""
    host = F.when(U.is_http(url), S.hostname(url)).otherwise("")
    path = T.bound(U.path(url), lambda p: F.regexp_replace(F.regexp_replace(F.coalesce(F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))), p), "/+", "/"), "/$", ""))
    return T.bound(F.struct(host.alias("host"), path.alias("path")), lambda u: F.when((u["host"] != "") & (u["path"] != ""), F.lower(F.concat(u["host"], u["path"]))))


def case_keys(name: Column, acquirer: Column, target: Column, url: Column) -> Column:
    """Tagged keys of a report case: parties, name and source, as far as there are any."""
    core = F.split(F.regexp_replace(F.coalesce(name, F.lit("")), _PREFIX, ""), "[:：]", 2)[0]

    def keyed(core: Column) -> Column:
        parties = F.struct(*[report_party(S.or_else(own, other)).alias(n) for n, own, other in zip("at", (acquirer, target), S.split_parties(core), strict=True)])
        both = T.bound(parties, lambda p: F.when((p["a"] != "") & (p["t"] != ""), F.concat(F.lit("party:"), p["a"], F.lit("->"), p["t"])))
        title = T.bound(case_title(core), lambda n: F.when(n != "", F.concat(F.lit("name:"), n)))
        return F.filter(F.array(both, title, F.concat(F.lit("url:"), url_identity(url))), lambda k: k.isNotNull())

    return T.bound(core, keyed)


def holding_pairs(names: DataFrame, least: int) -> DataFrame:
    """(short, long) of distinct names of which the long one holds the short one, which has at least so many characters.

    Names are made of few parts, so that a run of a fixed few characters is in very many of them. Lengths of runs grow by a quarter, and a short
    name is looked up by the rarest of its runs of the greatest length that it has: nearly the whole name. A longer name offers hashes of
    its runs of all those lengths, and is fetched by its own hash to be confirmed. If names have ``sides`` (1 left, 2 right, 3 both), only
    pairs of a left and a right name are made.
    """
    names = names.where(F.length("name") >= least).select("name", "sides" if "sides" in names.columns else F.lit(3).alias("sides"))
    longest, sizes = names.agg(F.max(F.length("name"))).first()[0] or 0, [least]
    while (size := max(sizes[-1] + 1, sizes[-1] * 5 // 4)) <= longest:
        sizes.append(size)
    fitting = F.filter(F.array(*[F.lit(s) for s in sizes]), lambda s: s <= F.length("name"))
    runs = lambda s: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("name") - s + 1), lambda i: F.xxhash64(F.substr("name", i, s))))
    offered = names.select(F.xxhash64("name").alias("held"), F.col("sides").alias("held_sides"), F.explode(F.flatten(F.transform(fitting, runs))).alias("run"))
    counts = offered.groupBy("run").agg(F.count("*").alias("n"))
    own = names.select(F.col("name").alias("short"), "sides", F.explode(T.bound(F.array_max(fitting), runs)).alias("run"))
    rarest = own.join(counts.hint("merge"), "run").groupBy("short", "sides").agg(F.min_by("run", F.struct("n", "run")).alias("run"))
    wanted = F.expr("(sides & 1) * (held_sides & 2) + (sides & 2) * (held_sides & 1) > 0")
    met = rarest.join(offered.hint("merge"), "run").where(wanted).select("short", "held").join(names.select(F.col("name").alias("long"), F.xxhash64("name").alias("held")).hint("merge"), "held")
    return met.where((F.col("short") != F.col("long")) & F.contains("long", F.col("short"))).select("short", "long").distinct()


def _sided(own: DataFrame, old: DataFrame, *keys: str) -> DataFrame:
    """Distinct values of some columns with ``sides``, where they are (1 left, 2 right, 3 both), and n, how often on the right."""
    both = own.select(*keys, F.lit(1).alias("sides"), F.lit(0).alias("n")).union(old.select(*keys, F.lit(2).alias("sides"), F.lit(1).alias("n")))
    return both.groupBy(*keys).agg(F.bit_or("sides").alias("sides"), F.sum("n").alias("n"))


def _both_ways(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """(left, right) of equal names and of those that hold one another, as far as names have that side."""
    same = names.where("sides = 3").select(F.col("name").alias("left"), F.col("name").alias("right"))
    met = same.union(pairs.select("short", "long")).union(pairs.select("long", "short"))
    for side, bit in (("left", 1), ("right", 2)):
        met = met.join(names.where(F.col("sides").bitwiseAND(bit) > 0).select(F.col("name").alias(side)).hint("merge"), side, "left_semi")
    return met.select("left", "right")


def _party_pairs(parties: DataFrame, others: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, other) of distinct party keys (key, a, t) and others of which both sides match.

    A key is looked up by the cheapest of three ways: through all keys of the names that match its first side, through those that match its
    second side, or by every pair of names that match the two. A name that very many keys share, or a short one that very many names hold, costs
    much in one of them only. Tables that grow with the keys are never broadcast: many at once, each small as Parquet, fill the driver.
    """
    other, sides, weighed = others.select(F.col("key").alias("other"), F.col("a").alias("a2"), F.col("t").alias("t2")).hint("merge"), {}, parties
    for side in ("a", "t"):
        names = scratch.stored(_sided(parties, others, side).withColumnRenamed(side, "name"))
        pairs = scratch.stored(_both_ways(holding_pairs(names, LEAST_PARTY), names))
        load = pairs.join(names.select(F.col("name").alias("right"), "n").hint("merge"), "right").groupBy(F.col("left").alias(side)).agg(F.count("*").alias(f"{side}_names"), F.sum("n").alias(f"{side}_keys"))
        sides[side], weighed = pairs.withColumnsRenamed({"left": side, "right": f"{side}2"}).hint("merge"), weighed.join(load.hint("merge"), side)
    product = F.col("a_names") * F.col("t_names")
    cheapest = F.when((product <= F.col("a_keys")) & (product <= F.col("t_keys")), "both").when(F.col("a_keys") <= F.col("t_keys"), "a").otherwise("t")
    weighed = scratch.stored(weighed.select("key", "a", "t", cheapest.alias("way")))
    found = [weighed.where("way = 'both'").join(sides["a"], "a").join(sides["t"], "t").join(other, ["a2", "t2"]).select("key", "other")]
    for side, rest in (("a", "t"), ("t", "a")):
        near = weighed.where(F.col("way") == side).join(sides[side], side).join(other, f"{side}2")
        found.append(near.join(sides[rest], [rest, f"{rest}2"], "left_semi").select("key", "other"))
    return found[0].union(found[1]).union(found[2]).where("key <> other")


def matching_keys(keys: DataFrame, scratch: Scratch, others: DataFrame | None = None) -> DataFrame:
    """(left, right) of distinct keys and of others that match, a key with itself too; without others, of the keys among themselves, both ways."""
    keys = scratch.stored(keys.select("key").distinct())
    others = keys if others is None else scratch.stored(others.select("key").distinct())
    same = keys if others is keys else keys.join(others.hint("merge"), "key", "left_semi")

    def named(table: DataFrame) -> DataFrame:
        tagged = table.where(F.startswith("key", F.lit("name:")) | F.startswith("key", F.lit("title:")))
        return tagged.select("key", F.split("key", ":", 2)[0].alias("kind"), F.split("key", ":", 2)[1].alias("name"))

    def parties(table: DataFrame) -> DataFrame:
        tagged = table.where(F.startswith("key", F.lit("party:"))).select("key", F.split(F.substr("key", F.lit(7)), "->", 2).alias("p"))
        return tagged.select("key", F.col("p")[0].alias("a"), F.col("p")[1].alias("t"))

    held = scratch.stored(holding_pairs(_sided(named(keys), named(others), "name"), LEAST_NAME))
    out = same.select(F.col("key").alias("left"), F.col("key").alias("right")).union(_party_pairs(parties(keys), parties(others), scratch).select("key", "other"))
    for left, right in (("short", "long"), ("long", "short")):
        own = held.join(named(keys).select(F.col("key").alias("left"), "kind", F.col("name").alias(left)).hint("merge"), left)
        out = out.union(own.join(named(others).select(F.col("key").alias("right"), "kind", F.col("name").alias(right)).hint("merge"), [right, "kind"]).select("left", "right"))
    return scratch.stored(out.distinct())


def seen_before(cases: DataFrame, history: DataFrame, id: str = "id") -> DataFrame:
    """Ids of cases (id, keys) of which a key matches one of the history (keys); keys of the history are not compared with one another."""
    scratch = Scratch(cases.sparkSession)
    own = cases.select(id, F.explode("keys").alias("key"))
    matched = matching_keys(own, scratch, history.select(F.explode("keys").alias("key")))
    return own.join(matched.select(F.col("left").alias("key")).distinct().hint("merge"), "key").select(id).distinct()


def split_by_history(cases: DataFrame, history: DataFrame, id: str = "id") -> DataFrame:
    """The cases with ``seen``: whether the history holds them. Cases without a key are new."""
    return cases.join(seen_before(cases, history, id).withColumn("seen", F.lit(True)), id, "left").withColumn("seen", F.coalesce("seen", F.lit(False)))


def fuzzy_first_wins(cases: DataFrame) -> DataFrame:
    """Ids of cases (id, keys) kept by a greedy pass in the order of ids: a case goes if one of its keys matches one of a case kept before it.

    The relation isn't transitive. It is decided in rounds instead of one pass: an open case that no smaller open case matches
    is kept, the cases it matches go, until none is open. Only the smallest open id of each key takes part in a round, so that a key
    of very many cases makes no pairs. Cases without a key are kept.
    """
    scratch = Scratch(cases.sparkSession)
    keyed = scratch.stored(cases.select("id", F.explode("keys").alias("key")).distinct())
    keys = matching_keys(keyed, scratch)
    kept, own = cases.where((F.size("keys") == 0) | F.col("keys").isNull()).select("id"), keyed
    while not own.isEmpty():
        low = own.groupBy("key").agg(F.min("id").alias("low"))
        reach = keys.join(low.withColumnRenamed("key", "right"), "right").groupBy(F.col("left").alias("key")).agg(F.min("low").alias("low"))
        fresh = scratch.stored(own.join(reach, "key").groupBy("id").agg(F.min("low").alias("low")).where("id = low").select("id"))
        taken = keys.join(own.join(fresh, "id", "left_semi").select(F.col("key").alias("right")).distinct(), "right", "left_semi").select(F.col("left").alias("key")).distinct()
        gone = own.join(taken, "key", "left_semi").select("id").distinct()
        own = scratch.stored(own.join(gone, "id", "left_anti"))
        kept = kept.union(fresh)
    return kept
