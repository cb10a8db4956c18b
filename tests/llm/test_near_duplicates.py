import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealspark.llm import components, embeddings, minhash, urls
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def grouped(items, linked):
    parent = {i: i for i in items}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in items:
        for b in items:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in items}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    pairs = {frozenset(e) for e in edges}
    assert got == grouped(sorted(nodes), lambda a, b: frozenset((a, b)) in pairs)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_hub(spark):
    star = [(0, i) for i in range(1, 200)] + [(300 + i, 300) for i in range(1, 100)] + [(150, 350), (500, 501)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(star, "a long, b long")).collect()}
    assert got == {i: 0 for i in [*range(200), *range(300, 400)]} | {500: 500, 501: 500}


def test_blocks_join_what_pairs_join():
    rng = np.random.default_rng(8)
    base = rng.integers(1, 1 << 40, 60).astype(np.uint64)
    sets = []
    for i in range(70):
        own = base.copy()
        own[rng.choice(60, rng.integers(1, 8), replace=False)] = rng.integers(1 << 41, 1 << 50, 1)
        sets.append(np.unique(own))
    node, component = np.arange(100, 170), np.where(np.arange(70) % 5 == 0, 100, np.arange(100, 170))
    linked = lambda a, b: component[a] == component[b] or 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))
    want = grouped(list(range(70)), linked)
    for block in (np.zeros(70, np.int64), np.arange(70) % 2):
        groups = [np.arange(70)] if not block.any() else [np.flatnonzero(block == 0), np.flatnonzero(block == 1), np.arange(70)]
        links = set()
        for rows in groups:
            a, b = minhash._joining_links(block[rows], node[rows], component[rows], [sets[i] for i in rows], 85)
            assert len(a) < len(set(component[rows].tolist())) and all(linked(x - 100, y - 100) for x, y in zip(a, b))
            links |= {frozenset((x - 100, y - 100)) for x, y in zip(a, b)}
        assert grouped(list(range(70)), lambda a, b: component[a] == component[b] or frozenset((a, b)) in links) == want


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_minhash_finds_pairs_at_the_threshold(spark, docs, size, percent):
    runs, pairs = 100, 400  # a pair shares the first shingles, as few as the threshold allows
    shared = -(-2 * runs * percent // (100 + percent))
    rows = []
    for i in range(pairs):
        words = [f"p{i}w{j}" for j in range(runs + size - 1)]
        other = words[: shared + size - 1] + [f"p{i}v{j}" for j in range(runs - shared)]
        rows += [(2 * i, " ".join(words), None), (2 * i + 1, " ".join(other), None)]
    assert 100 * shared >= percent * (2 * runs - shared) and 100 * (shared - 1) < percent * (2 * runs - shared + 1)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs(rows), size, percent).collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in range(pairs)) >= pairs - 2
    with pytest.raises(ValueError):
        minhash.near_duplicates(docs(rows), size, 79)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_minhash_against_all_pairs(spark, docs, size, percent):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(40, 160))]
        for copy in range(8):
            own = list(words)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((base * 100 + copy, " ".join(own), "en"))
    rows += [(5000 + (i or 99), t, k) if i else (None, t, k) for i, t, k in ODD]
    got = minhash.near_duplicates(docs(rows), size, percent).collect()
    assert len(got) == len(rows)
    sets = {i: shingles(t, size) for i, t, _ in rows if i is not None}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x and y) and 100 * len(x & y) >= percent * len(x | y)

    want = grouped(sorted(sets), linked)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    assert minhash.near_duplicates(docs([]), size, percent).count() == 0


def test_crowded_region_of_near_copies(spark, docs):
    rng = random.Random(9)
    words = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = []
    for i in range(130):
        own = list(words)
        own[i] = f"x{i}"
        rows.append((i, " ".join(own), "en"))
    got = minhash.near_duplicates(docs(rows), 3, 85).collect()
    assert {r["component_id"] for r in got} == {0}


def test_crowded_region_mostly_below_the_threshold(spark, docs):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(300):
        own = list(words)
        for at in rng.sample(range(300), 3 if i in (90, 107, 141, 166) else 8):
            own[at] = f"x{i}at{at}"
        rows.append((i, " ".join(own), "en"))
    sets = {i: shingles(t, 3) for i, t, _ in rows}
    want = grouped(sorted(sets), lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    assert len(set(want.values())) > 280 and want[166] == want[141] == 90
    got = minhash.near_duplicates(docs(rows), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(40):
        base = rng.normal(size=16)
        for j in range(4):
            rows.append((i * 10 + j, (base + rng.normal(size=16) * 0.2 * j).tolist(), i % 3, "x"))
    rows += [(900, None, 1, "x"), (901, [0.0] * 16, 1, "x"), (902, [float("nan")] * 16, 1, "x"), (903, [1.0, None] * 8, 1, "x"), (904, rows[0][1], None, "x"), (905, rows[0][1], 0, "x"), (906, rows[0][1], 0, "x"), (907, [1.0, 2.0], 0, "x"), (908, [], 0, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string")
    got = {r["vec_id"]: r for r in embeddings.near_duplicate_vectors(table).collect()}
    assert len(got) == len(rows)

    def unit(v):
        if not v or None in v or not np.isfinite(v).all() or not np.linalg.norm(v):
            return None
        return np.array(v) / np.linalg.norm(v)

    vectors = {i: (unit(v), k) for i, v, k, _ in rows}

    def linked(a, b):
        (x, k), (y, m) = vectors[a], vectors[b]
        return x is not None and y is not None and k is not None and k == m and len(x) == len(y) and x @ y >= 0.93

    want = grouped(sorted(vectors), linked)
    for i, r in got.items():
        assert (r["n_links"], r["component_id"], r["kept"]) == (sum(linked(i, j) for j in vectors if j != i), want[i], want[i] == i), i
    assert embeddings.near_duplicate_vectors(table.limit(0)).count() == 0


@pytest.mark.parametrize("dim", [16, 64, 384])
def test_embedding_recall_at_the_threshold(spark, dim):
    """Pairs planted just above the threshold among vectors that have no other partner."""
    rng = np.random.default_rng(dim)
    rows = []
    for i in range(400):
        a = rng.normal(size=dim)
        a /= np.linalg.norm(a)
        b = rng.normal(size=dim)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = 0.9301 + 0.0099 * rng.random()
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, (c * a + math.sqrt(1 - c * c) * b).tolist(), 1)]
    rows += [rows[0], rows[1]]  # repeated rows are copies of each other
    got = embeddings.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    found = {r["vec_id"] for r in got if r["component_id"] != r["vec_id"]}
    assert len(got) == len(rows) and len(found & {2 * i + 1 for i in range(400)}) >= 398
    assert {(r["n_links"], r["component_id"]) for r in got if r["vec_id"] < 2} == {(3, 0)}


def test_tables_needed_keep_the_promised_chance():
    rng = np.random.default_rng(4)
    bits, same, width = 384, 0.88, 12
    farthest = int(bits * 0.12 + 5 * math.sqrt(bits * 0.12 * 0.88))
    tables = embeddings.tables_needed(bits, same, width, farthest, 0.01)
    picks = np.stack([rng.choice(bits, width, replace=False) for _ in range(tables)])
    equal = rng.random((20_000, bits)) < same
    assert np.mean([not row[picks].all(1).any() for row in equal]) < 0.014


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(2000, 64))
    b = a + rng.normal(size=a.shape) * 0.5
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    about, bound = embeddings.estimate(a, *embeddings.coded(b))
    error = about - (a * b).sum(1)
    assert abs(error.mean()) < 0.01 and (np.abs(error) <= bound).all()


def test_url_lists_as_of_fetch(spark):
    entries = spark.createDataFrame(
        [("a", "d", "x.org", "block", "add", "2024-01-10"), ("a", "d", "x.org", "block", "remove", "2024-02-01"), ("b", "h", "ok.x.org", "allow", "add", "2024-01-01"), ("c", "p", "ok.x.org/bad", "block", "add", "2024-01-15"), ("c", "d", "z.org", "block", "add", "2024-03-01"), ("c", "d", "z.org", "block", "remove", "2024-03-01"), ("c", "d", "n.org", "block", "add", None)],
        "list string, kind string, pattern string, action string, event string, dated string",
    ).selectExpr("list", "kind", "pattern", "action", "event", "cast(dated as date) dated")
    rows = [(1, "http://www.x.org/", "2024-01-09"), (2, "http://www.x.org/", "2024-01-10"), (3, "http://www.x.org/", "2024-02-01"), (4, "https://OK.x.org:80/a", "2024-01-20"), (5, "https://ok.x.org/bad/page?q", "2024-01-20"), (6, "https://ok.x.org/bad/page", "2024-01-14"), (7, None, "2024-01-20"), (8, "no url", "2024-01-20"), (9, "http://z.org", "2024-03-01"), (10, "http://x.org", None), (10, "http://x.org", None), (11, "http://n.org/", "2024-03-01")]
    captures = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, fetched string, list string").selectExpr("page_id", "url", "cast(fetched as date) fetched", "list")
    got = urls.judged(captures, entries).collect()
    assert len(got) == len(rows)
    want = {1: "pass", 2: "block", 3: "pass", 4: "allow", 5: "block", 6: "allow", 7: "pass", 8: "pass", 9: "pass", 10: "pass", 11: "pass"}
    assert {r["page_id"]: r["verdict"] for r in got} == want
    assert urls.allowed(captures, entries).count() == len(rows) - 2
    odd = [(1, "http://ok.x.org/bad/" + "a/" * 20_000, "2024-01-20"), (2, "http://" + "s." * 300 + "x.org/", "2024-01-20"), (3, "http://[::1]:80/x", "2024-01-20"), (4, "http://ok.x.org/badly", "2024-01-20"), (5, "http://u@x.org:1", "2024-01-20")]
    wide = spark.createDataFrame([(*r, "x") for r in odd], "page_id long, url string, fetched string, list string").selectExpr("page_id", "url", "cast(fetched as date) fetched", "list")
    assert {r["page_id"]: r["verdict"] for r in urls.judged(wide, entries).collect()} == {1: "block", 2: "block", 3: "pass", 4: "allow", 5: "block"}
    assert wide.select(urls.host(F.col("url")).alias("h")).collect()[2]["h"] == "[::1]"
    assert {r["verdict"] for r in urls.judged(captures, entries.limit(0)).collect()} == {"pass"}
    assert urls.judged(captures.limit(0), entries).count() == 0
