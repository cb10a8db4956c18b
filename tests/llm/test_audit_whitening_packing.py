"""Source audit, whitening and hierarchical packing against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dealspark.llm import divergence, hierarchy, kernels, whitening
from tests.llm.conftest import ODD

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SOURCED = "doc_id long, text string, lang string, source string, term string, count long, value long, place long"


def audit(rows, least=3, ranks=200):
    """The contract, term by term."""
    counts, found, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(terms)
        found[lang].update(set(terms))
    out = set()
    for lang, source in groups:
        kept = [t for t, n in found[lang].items() if n >= least]
        whole = sum((counts[g] for g in groups if g[0] == lang), Counter())

        def shares(c, kept=kept):
            size = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // size for t in kept}

        f = lambda p, q: (p - q) * (p - q) // q
        own, all_ = shares(counts[lang, source]), shares(whole)
        pairs = []
        for other in (g[1] for g in groups if g[0] == lang and g[1] != source):
            q = shares(counts[lang, other])
            pairs.append((-sum(f(own[t], q[t]) for t in kept), other.encode(), other))
        terms = [(-f(own[t], all_[t]), t.encode(), t) for t in kept if counts[lang, source][t] and own[t] > all_[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
            out |= {(lang, source, part, item, -value, k) for k, (value, _, item) in enumerate(items, 1)}
    return out


@pytest.mark.parametrize("ranks", [200, 3])
def test_audit_equals_the_sum_over_all_terms(spark, ranks):
    rng = random.Random(ranks)
    words = [f"{a}{b}" for a in ("Stone", "fluß", "中文", "é") for b in "abcdefghij"] + ["x1y", "don't", "A-B_c"]
    rows = [(" ".join(rng.choice(words[k % 7 : 20 + k % 24]) for _ in range(rng.randint(0, 25))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "é", None])) for k in range(160)]
    rows += [(None, "en", "a"), ("", "fr", "only"), ("  12 !! ", "fr", "other"), ("rare words here", "xx", "lone"), ("long " * 9000, "en", "b")]
    rows += [("same text again", "en", "hot")] * 40 + [("tie one two", "es", "p"), ("tie one two", "es", "q"), ("tie one two", "es", "p")]
    df = spark.createDataFrame([(1, t, lang, s, "x", 1, 2, 3) for t, lang, s in rows], SOURCED)
    got = divergence.source_divergence(df.repartition(5), ranks=ranks)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == audit(rows, ranks=ranks)


def test_audit_evaluates_large_vectors_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(" ".join(rng.choices("abcdefg", k=9)), "en", f"s{k % 30}") for k in range(300)]
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 7)
    vectors = spark.createDataFrame([("en", 3, [1, 2, 4], [5, 90, 7], [2, 3, 4]), ("en", 1, [2], [9], [1]), ("de", 2, [], [], []), ("de", 2, [1, 2], [4, 9], [1, 1])], "lang string, terms long, places array<long>, shares array<long>, zeros array<long>")
    got = {}
    import pyarrow as pa

    for part in divergence._cross_terms(vectors.toArrow().combine_chunks().to_batches()[0]):
        for lang, a, b, value in zip(*(c.to_pylist() if isinstance(c, pa.Array) else c.tolist() for c in part)):
            got[lang, a, b] = got.get((lang, a, b), 0) + value
    want, f = {}, lambda p, q: (p - q) ** 2 // q
    for lang, n, places, shares, zeros in vectors.collect():
        for a, p, za in zip(places, shares, zeros):
            for b, q, zb in zip(places, shares, zeros):
                if a != b:
                    want[lang, a, b] = want.get((lang, a, b), 0) + n * (f(p, q) - f(p, zb) - f(za, q) + f(za, zb))
    assert got == want
    df = spark.createDataFrame([(1, t, lang, s, "x", 1, 2, 3) for t, lang, s in rows], SOURCED)
    assert {tuple(r) for r in divergence.source_divergence(df).collect()} == audit(rows)


def test_audit_counts_beyond_64_bits(spark):
    row = spark.range(1).select(divergence.share(str(9 * 10**12), str(10**14)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (9 * 10**12 + 1) // 10**14


def test_audit_of_an_empty_table(spark, docs):
    assert divergence.source_divergence(docs([])).count() == 0
    assert {r["value"] for r in divergence.source_divergence(docs([(1, None, "a"), (2, "", "a")]).withColumn("source", F.col("doc_id").cast("string"))).collect()} == {0}


VECTORS = "vec_id long, embedding array<float>, label int, x string, n long, component string"


def test_moments_merge_in_any_order():
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, (700, 6)) + 10**6
    parts = [whitening.Moments.of(p) for p in np.split(x, [1, 5, 300, 301])]
    left = parts[0]
    for p in parts[1:]:
        left = left.merged(p)
    right = parts[4].merged(parts[3]).merged(parts[2].merged(parts[1].merged(parts[0])))
    whole = x - x.mean(0)
    for m in (left, right):
        assert m.n == 700 and (m.sums == x.sum(0)).all() and np.allclose(m.scatter, whole.T @ whole, rtol=1e-11)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(2)
    axes = rng.normal(size=(8, 8)) * [9, 5, 3, 2, 1, 0.5, 0.2, 0.1]
    base = (rng.normal(size=(400, 8)) @ axes.T).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, base[7].tolist()) for i in range(200)] + [(5, base[5].tolist()), (5, base[5].tolist()), (None, base[9].tolist())]
    left_out = [(2000, None), (2001, [None] * 8), (2002, [math.nan] + [1.0] * 7), (2003, [math.inf] * 8), (2004, [1.0] * 7 + [None]), (2005, [])]
    df = spark.createDataFrame([(i, v, 1, "x", 1, "c") for i, v in rows + left_out], VECTORS).repartition(6)
    got = whitening.whitened_vectors(df).collect()
    assert len(got) == 4 * len(rows)
    x = np.array([[math.floor(256 * float(c)) for c in v] for _, v in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    values, vectors = np.linalg.eigh((fit - sums / n).T @ (fit - sums / n) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = {}
    for (i, _), own in zip(rows, x):
        want[i] = ((own - sums / n) @ vectors / np.sqrt(values), sum((n * int(a) - int(s)) ** 2 for a, s in zip(own, sums)))
    signs = {}
    for r in sorted(got, key=lambda r: (r["vec_id"] is None, r["vec_id"])):
        k, (white, deviation) = r["component"] - 1, want[r["vec_id"]]
        sign = signs.setdefault(k, np.sign(r["whitened"] * white[k]))
        assert r["n"] == n and r["deviation"] == deviation and abs(r["whitened"] * sign - white[k]) < 1e-9
        assert abs(r["explained"] - values[k] / values.sum()) < 1e-10 and 0 <= r["identity_error"] < 1e-9


def test_whitening_without_variance_and_by_length(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]), (3, [0.5, -0.25]), (4, [1.5, -0.75]), (5, [7.0])]
    df = spark.createDataFrame([(i, v, None, "x", 1, "c") for i, v in rows], VECTORS)
    got = {(r["vec_id"], r["component"]): r for r in whitening.whitened_vectors(df).collect()}
    assert set(got) == {(i, k) for i, v in rows for k in range(1, len(v) + 1)}
    assert all(got[i, 1]["whitened"] is None and got[i, 1]["explained"] == 0 and got[i, 1]["deviation"] == 0 and got[i, 1]["identity_error"] is None for i in (1, 2, 5))
    assert abs(abs(got[3, 1]["whitened"]) - 1) < 1e-12 and got[3, 2]["whitened"] is None and abs(got[3, 1]["explained"] - 1) < 1e-12
    assert whitening.whitened_vectors(df.limit(0)).count() == 0


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("seed", range(3))
def test_ids_of_chunks_equal_those_of_texts(tokenizer, seed):
    import pyarrow as pa

    rng = random.Random(seed)
    signs = list(" '  \n\n\t\x85\xa0\x1c\x0babstrevelmdDS12é中!?# 　'😀ñ  <|>") + ["<|endoftext|>"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(1500)] + ["", "a" * 500, " " * 300, "'" * 99, None, "中文" * 400]
    got = hierarchy.chunk_tokens(P.path("byte_bpe_50k.json")).encode(*kernels.text_bytes(pa.array(texts)))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids_of(tokenizer, t)[:-1] for t in texts]


def check_packing(rows, got, tokenizer, most_padding=0):
    """Every id in one piece, gapless windows of powers of two, equal steps."""
    want, pieces = Counter(), defaultdict(list)
    for i, t in rows:
        want[i, tuple(ids_of(tokenizer, t))] += 1
    for r in got:
        assert 1 <= r["length"] <= 2048
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
    by_key = defaultdict(list)
    for (i, ids), n in want.items():
        by_key[i, len(ids)].append((ids, n))
    assert set(by_key) == set(pieces)
    for key, found in pieces.items():
        offered = Counter((r["start"], r["length"], r["ids_crc32"]) for r in found)
        covered = Counter(p for r in found for p in range(r["start"], r["start"] + r["length"]))
        assert covered == {p: sum(n for _, n in by_key[key]) for p in range(key[1])}
        for start, length, crc in offered:
            assert any(zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()) == crc for ids, _ in by_key[key])
    windows = defaultdict(list)
    for r in got:
        windows[r["sequence_id"], r["window"], r["step_group"]].append((r["offset"], r["length"]))
    assert len(windows) == len({k[0] for k in windows})
    steps = Counter()
    for (_, window, step), parts in windows.items():
        parts.sort()
        total = sum(n for _, n in parts)
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and total <= 2048
        assert total & (total - 1) == 0 and window in (total, 0)
        steps[step] += total
    assert max(steps.values()) - min(steps.values()) <= 2 * 2048


def test_hierarchy_packs_every_id_once(spark, docs, tokenizer):
    rng = random.Random(4)
    vocabulary = [f" w{i}x{i * 7 % 31}" for i in range(300)] + [" the", "!", "\n\n", "  "]
    rows = [(i, "".join(rng.choices(vocabulary, k=int(rng.paretovariate(0.7) * 8) % 4000))) for i in range(250)]
    rows += [(i, t) for i, t, _ in ODD] + [(900, "same words here again")] * 60 + [(None, None), (None, "")] + [(901, "a <|endoftext|> b")]
    got = hierarchy.pack_hierarchy(docs([(i, t, "en") for i, t in rows]), P.path("byte_bpe_50k.json")).collect()
    check_packing(rows, got, tokenizer)
    assert hierarchy.pack_hierarchy(docs([]), P.path("byte_bpe_50k.json")).count() == 0


def test_pieces_that_fill_no_window_are_cut(spark, docs, tokenizer):
    text = " word" * 1499  # 1500 tokens with the end: no combination fills a window
    rows = [(7, text)] * 9 + [(i, text + "s") for i in range(20, 40)] + [(None, text)] * 3
    got = hierarchy.pack_hierarchy(docs([(i, t, "en") for i, t in rows]), P.path("byte_bpe_50k.json")).collect()
    check_packing(rows, got, tokenizer)
    assert len(got) <= len(rows) + len({r["sequence_id"] for r in got})


def test_plans_hold_every_piece_and_cut_few():
    rng = random.Random(9)
    for _ in range(4):
        counts = Counter(min(2048, int(rng.paretovariate(0.5) * 20)) for _ in range(3000))
        plan = hierarchy.Plan(counts)
        held = Counter()
        for tier, filled, times in plan.windows:
            assert sum(x * n for x, n in filled.items()) == tier and max(filled) > (tier // 2 if tier > 256 else 0)
            for x, n in filled.items():
                held[x] += n * times
        for x, n, rank, _ in plan.stream:
            assert rank == held[x]
            held[x] += n
        assert held == counts and plan.streamed < 0.05 * sum(x * n for x, n in counts.items())
