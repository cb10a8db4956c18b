import hashlib
import struct
import time
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from dealspark.llm import bpe, kernels, language, lattice, media, packing, quality, scoring, toxicity
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def test_word_spans_and_hashes():
    raw, at = kernels.text_bytes(pa.array(["ab c", None, "", "c ab\x0bé", "  "]))
    starts, ends, rows = kernels.word_spans(raw, at)
    assert [raw[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["ab", "c", "c", "ab", "é"]
    assert rows.tolist() == [0, 0, 3, 3, 3]
    h = kernels.span_hashes(raw, starts, ends)
    assert h[0] == h[3] and h[1] == h[2] and len(set(h.tolist())) == 3


@pytest.mark.parametrize("seed", range(3))
def test_pretokens_and_merges_equal_the_library(seed):
    m = bpe.merger(P.path("byte_bpe_50k.tiktoken"))
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=m.ranks, special_tokens={})
    rng = random.Random(seed)
    texts = ["".join(rng.choices(" '  \n\tabstrevelmdDS12é中!?# 　'😀ñ", k=rng.randint(0, 60))) for _ in range(400)] + ["", "a" * 500, " " * 300, "'" * 99, None]
    got = [ids for rows in bpe.split_texts(*kernels.text_bytes(pa.array(texts))) for ids in m.encode(rows)]
    assert got == [" ".join(map(str, reference.encode_ordinary(t or ""))) for t in texts]
    assert [m.decode(x) for x in got] == [(t or "").encode() for t in texts]


def test_bpe_rows(spark, docs):
    rows = bpe.encode_documents(docs(ODD), P.path("byte_bpe_50k.tiktoken")).collect()
    assert len(rows) == len(ODD)
    empty = hashlib.sha256(b"").hexdigest()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_tokens"] == 0 and by_id[1]["ids_sha256"] == empty == by_id[2]["decoded_sha256"]
    assert by_id[9]["decoded_sha256"] == hashlib.sha256(("word " * 6000).encode()).hexdigest()
    assert bpe.encode_documents(docs([]), P.path("byte_bpe_50k.tiktoken")).count() == 0


def test_media_round_trip(spark, docs):
    rows = media.media_digests(docs(ODD)).collect()
    assert len(rows) == len(ODD)
    for r, (_, text, _) in zip(sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"])), sorted(ODD, key=lambda r: (r[0] is not None, r[0]))):
        data = (text or "").encode()
        padded = data + bytes(-len(data) % 64 or 64 * (not data))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    pixels = np.random.default_rng(0).integers(0, 256, (6, 64), dtype=np.uint8)
    for encode in (media.encode_pgm, media.encode_bmp):
        assert (media.decode_media(encode(pixels)) == pixels).all()
    small = media.area_resize(pixels, 3, 16)
    assert np.allclose(small, pixels.reshape(3, 2, 16, 4).mean((1, 3)))
    grey = bytearray(media.encode_bmp(pixels))
    colours = grey[:54] + b"".join(bytes((i, 255 - i, i // 2, 0)) for i in range(256)) + grey[54 + 1024 :]
    expected = np.stack([pixels // 2, 255 - pixels, pixels], 2)
    assert (media.decode_media(bytes(colours)) == expected).all()
    longer = bytearray(colours[:54] + bytes(68) + colours[54:])
    struct.pack_into("<II", longer, 10, 14 + 108 + 1024, 108)
    assert (media.decode_media(bytes(longer)) == expected).all()
    core = bytearray(colours)
    struct.pack_into("<I", core, 14, 12)
    fewer = bytearray(grey[:54] + bytes(8) + grey[54 + 1024 :])
    struct.pack_into("<I", fewer, 46, 2)
    struct.pack_into("<I", fewer, 10, 54 + 8)
    for bad in (b"GIF89a", b"BM", b"", bytes(grey[:60]), bytes(grey[:-1]), bytes(core), bytes(fewer), b"P5\n0 4\n255\n", b"P5\n9 9\n255\nxx", b"P6 #"):
        with pytest.raises(ValueError):
            media.decode_media(bad)
    assert media.media_tiles(docs(ODD[:2])).count() == 2


def test_minimum_bin_slack_is_exact_on_small_cases():
    assert packing.fullest({5: 1, 4: 2, 3: 1}, 8) in ({4: 2}, {5: 1, 3: 1})
    assert packing.fullest({7: 3}, 6) == {}
    counts = {60: 5, 40: 5, 30: 2, 20: 2}
    bins = packing.minimum_bin_slack(dict(counts), 100)
    used = Counter()
    for b, times in bins:
        assert sum(x * n for x, n in b.items()) <= 100
        for x, n in b.items():
            used[x] += n * times
    assert used == counts and sum(t for _, t in bins) == 6


def test_packing_rows(spark, docs):
    rows = [r.asDict() for r in packing.pack(docs(ODD), P.path("word_bpe_49k.json"), 256).collect()]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = sum(-(-(len(t.encode(x or "", add_special_tokens=False).ids) + 1) // 256) for _, x, _ in ODD)
    assert len(rows) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(docs([]), P.path("word_bpe_49k.json")).count() == 0


def test_lattice_sums_all_segmentations(spark, docs):
    pieces = lattice.Pieces([b" ", b" a", b"a", b"b", b"ab", b" ab", *[bytes([i]) for i in range(200, 256)]], np.ones(62))

    def brute(word, first=True):
        if not word:
            return math.exp(pieces.stop)
        return sum(math.exp(w) * brute(word[len(t) :], False) for t, w in zip(pieces.texts, pieces.log) if word.startswith(t))

    for w in (b"ab", b"abab", b"b"):
        assert math.isclose(lattice.log_probabilities(pieces, [w])[0], math.log(brute(b" " + w)), rel_tol=1e-9)
    expected = lattice.expected_counts(pieces, [b"ab", b"b"], np.array([3.0, 1.0]))
    assert math.isclose(sum(e for e, i in zip(expected, pieces.initial) if i), 4.0)  # one first piece a word


def test_lattice_reads_long_words_in_stretches(spark, docs, monkeypatch):
    pieces = lattice.vocabulary(P.path("piece_bpe_32k.model"))
    words = [b"unbroken", "zerlegbarkeit\u4e2d\u6587".encode() * 5, bytes(range(33, 127)) * 2, b"ab" * 90]
    counts = np.array([3.0, 1.0, 2.0, 5.0])
    plain, uses = lattice.log_probabilities(pieces, words), lattice.expected_counts(pieces, words, counts)
    monkeypatch.setattr(lattice, "_LONG", 4)
    for stretch in (7, 64, 1000):
        monkeypatch.setattr(lattice, "_STRETCH", stretch)
        assert np.allclose(lattice.log_probabilities(pieces, words), plain, rtol=1e-12)
        assert np.allclose(lattice.expected_counts(pieces, words, counts), uses, rtol=1e-9, atol=1e-12)


def test_lattice_scores_an_unbroken_text(spark, docs):
    text = "ab9/" * 50_000
    rows = [(1, text, None), (2, text + " " + text, None), (3, "a plain text", None)]
    got = {r["doc_id"]: r for r in lattice.score_documents(docs(rows), P.path("piece_bpe_32k.model"), F.col("doc_id") != 2).collect()}
    assert [got[i]["n_tokens"] for i in (1, 2, 3)] == [2, 3, 4] and [got[i]["n_known"] for i in (1, 2, 3)] == [2, 3, 4]
    word = [text.encode()]
    given = lattice.log_probabilities(lattice.vocabulary(P.path("piece_bpe_32k.model")), word)[0] / math.log(10)
    assert math.isclose(got[1]["vocabulary_score"], given, rel_tol=1e-4)


def test_lattice_base_scores(spark, docs):
    wide = 2**53 + 1
    rows = [*ODD, (wide, "an id beyond the whole numbers of a double", "en")]
    held = kernels.remainder(F.col("doc_id"), 10) == 0
    training = F.coalesce(~held, F.lit(False))  # a row without id is in no fold
    path = P.path("piece_bpe_32k.model")
    got = lattice.score_documents(docs(rows), path, training).collect()
    key = lambda i: (i is None, i)
    assert sorted((r["doc_id"] for r in got), key=key) == sorted((i for i, _, _ in rows), key=key)
    trained = [words(t) for i, t, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in trained for w in [*t, ""])
    n, v = sum(c.values()), len(c)
    given = lattice.vocabulary(path)
    given.weigh(np.zeros(len(given.texts)), 0.0)
    end = math.log10((c[""] + 0.5) / (n + 1))
    for r in got:
        text = next(t for i, t, _ in rows if i == r["doc_id"])
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words(text), ""])
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["train_tokens"] == n and r["n_tokens"] == len(words(text)) + 1
        assert r["n_known"] == sum(c[w] > 0 for w in [*words(text), ""]) and r["score"] < 0
        spelled = lattice.log_probabilities(given, [w.encode() for w in words(text)]).sum() / math.log(10)
        assert math.isclose(r["vocabulary_score"], spelled + end + len(words(text)) * math.log10(1 - 10**end), rel_tol=1e-9)
    assert lattice.score_documents(docs([]), path, training).count() == 0


def _toy(n, word):
    rng = random.Random(4)
    plain = ["stone", "river", "cloud", "garden", "window", "paper", "silver", "music"]
    out = []
    for i in range(n):
        bad = i % 3 == 0
        text = [rng.choice(plain) for _ in range(30)]
        if bad:
            text[rng.randrange(30)] = word
        out.append((i, " ".join(text), int(bad)))
    return out


def test_toxicity_reads_signs_at_the_end_and_spaced_signs(spark, docs):
    toy = [(i, t.replace("idiot", "idiot loser kill ass"), bad) for i, t, bad in _toy(240, "idiot")]
    labels = spark.createDataFrame([(i, bad) for i, _, bad in toy], "doc_id long, toxic int")
    model = toxicity.learn(docs([(i, t, "en") for i, t, _ in toy]), labels)
    toxic = ["stone idio+ river", "an a$$ garden", "kil| stone", "stone l 0 s e r river", "i d i 0 t", "los€r music", "l o s € r", "idio+!", "paper i d i o +"]
    clean = ["garden music!", "paper***", "stone + river", "you lose!", "12 € a", "3 $ 5 ! 7", "idea! idol*", "(river)", "music € 5", "garden $"]
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs([(i, t, "en") for i, t in enumerate(toxic + clean)]), model).collect()}
    assert [t for i, t in enumerate(toxic) if got[i] < 0.5] == []
    assert [t for i, t in enumerate(clean, len(toxic)) if got[i] >= 0.5] == []


def test_all_signs_at_the_end_of_a_word_are_read():
    counts = np.zeros(27 * 27 * 27)
    for a, b, c in zip("  idiot", " idiot ", "idiot  "):
        at = [26 if x == " " else ord(x) - 97 for x in (a, b, c)]
        counts[at[0] * 729 + at[1] * 27 + at[2]] += 1000
    decoder = toxicity.Decoder(counts)
    for dots in (3, 16, 17, 400):
        assert "idiot" in decoder.endings("idio" + "." * dots + "+", 12)
    started = time.perf_counter()
    assert all(len(x) <= 12 for x in decoder.endings("idio" + "12+!" * 5_000, 12)) and decoder.endings("ab" * 50 + "!", 12) == []
    assert time.perf_counter() - started < 20


def test_toxicity_reads_long_spaced_words(spark, docs):
    word = "unbelievablestupidnessperson"  # longer than what is learned from spaced words
    toy = _toy(240, word)
    labels = spark.createDataFrame([(i, bad) for i, _, bad in toy], "doc_id long, toxic int")
    model = toxicity.learn(docs([(i, t, "en") for i, t, _ in toy]), labels)
    whole = np.zeros(1, np.int64), np.array([len(word)])
    key = toxicity._hashes(np.frombuffer(word.encode(), np.uint8), *whole)
    model = toxicity.Model(key, np.ones(1) * 9, model.counts, 1.0, -4.0, len(word))  # without its beginnings
    texts = [" ".join(word), "stone " + " ".join(word) + " river", "a b c " + " ".join(word) + " x y", " ".join(word.replace("i", "1")), " ".join(word[:-1]), "w " * 4000, "a * " * 2000]
    assert [x >= 0.5 for x in model.scores(pa.array(texts))] == [True] * 4 + [False] * 3
    for i, t in enumerate(texts[:4]):  # each part of the run, decoded on its own
        decoder, run = toxicity.Decoder(model.counts), "".join(w for w in t.split() if len(w) == 1)
        parts = {decoder.restore(run[a:b]) for a in range(len(run)) for b in range(a + 3, len(run) + 1)}
        assert word in parts and parts >= {x for x, sign in decoder.spaced(run, len(word)) if not sign}, i


def test_toxicity_restores_disguises(spark, docs):
    rows = _toy(240, "idiot")
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "doc_id long, toxic int")
    model = toxicity.learn(docs([(i, t, "en") for i, t, _ in rows]), labels)
    hidden = [(1, "stone river id10t", None), (2, "stone i d i o t river", None), (3, "river i.d.i.o.t cloud", None), (4, "an idiooot", None), (5, "garden music paper", None), (6, None, None), (7, "", None), (8, "12 !! 77", None)]
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs(hidden), model).collect()}
    assert all(got[i] >= 0.5 for i in (1, 2, 3, 4)) and all(got[i] < 0.5 for i in (5, 6, 7, 8))
    kept = toxicity.without_toxic(docs(hidden), model)
    assert kept.columns == docs(hidden).columns and {r["doc_id"] for r in kept.collect()} == {5, 6, 7, 8}
    none = toxicity.learn(docs(hidden), labels.where("toxic = 0"))
    assert all(r["score"] < 0.5 for r in toxicity.scored(docs(ODD), none).collect())


def test_quality_ranks(spark, docs):
    rng = random.Random(1)
    rows = []
    for i in range(160):
        text = " ".join(rng.choice(["stone", "river", "cloud", "garden"]) + str(rng.randrange(9)) for _ in range(40))
        rows.append((i, text.upper() + "!!" if i % 4 == 0 else text, int(i % 4 != 0)))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    table = docs([(i, t, "en") for i, t, _ in rows])
    model = quality.learn(table, labels)
    got = {r["doc_id"]: r["score"] for r in quality.scored(table, model).collect()}
    assert np.mean([(got[i] >= 0.5) == y for i, _, y in rows]) > 0.97
    assert quality.without_low_quality(table, model).columns == table.columns
    assert len(quality.scored(docs(ODD), model).collect()) == len(ODD)
    blank = quality.learn(table, labels.where("quality = 1"))
    assert all(r["score"] == 0.5 for r in quality.scored(docs(ODD), blank).collect())


def test_language_gradients_and_und(spark, docs):
    net = language.Network(["a", "b"], hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 5, (6, 4)).astype(np.uint8), np.array([0, 1, 1, 0])
    valid = (np.arange(6)[:, None] < [6, 2, 6, 5]).astype(float)
    _, g = net.gradients(x, y, valid)
    for k in net.p:
        at = tuple(0 if k == "bias" else rng.integers(0, min(3, s)) for s in net.p[k].shape)
        old, e = net.p[k][at], 1e-3
        net.p[k][at] = old + e
        up = net.gradients(x, y, valid)[0]
        net.p[k][at] = old - e
        down = net.gradients(x, y, valid)[0]
        net.p[k][at] = old
        assert math.isclose((up - down) / (2 * e), g[k][at], rel_tol=2e-2, abs_tol=1e-5)
    rows = [(i, ("der die und ist nicht " if i % 2 else "the and of is not ") * 8, "de" if i % 2 else "en") for i in range(60)]
    model = language.train(np.stack([np.frombuffer(t.encode()[:64], np.uint8) for _, t, _ in rows]), [k for _, _, k in rows], steps=40)
    got = {r["doc_id"]: r for r in language.identified(docs([*rows, *[(i + 100 if i else None, t, k) for i, t, k in ODD]]), model).collect()}
    assert all(got[i]["lang_pred"] == k for i, _, k in rows)
    assert [got[i]["lang_pred"] for i in (101, 102, 103, 104)] == ["und"] * 4
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language.learn(docs([])).languages == []


def test_language_of_short_texts_is_learned(spark, docs):
    rows = [(i, "der die das" if i % 2 else "the of and", "de" if i % 2 else "en") for i in range(80)]
    net = language.learn(docs(rows))
    got = {r["doc_id"]: r["lang_pred"] for r in language.identified(docs(rows), net).collect()}
    assert got == {i: k for i, _, k in rows}


def test_language_equals_a_plain_network(spark, docs):
    """Byte by byte, gate by gate, in plain floats."""
    net = language.Network(["a", "b", "c"], hidden=4, seed=9)
    p, h = {k: v.astype(float) for k, v in net.p.items()}, 4
    sigmoid = lambda v: 1 / (1 + math.exp(-v))

    def states(window, d):
        state, out = [0.0] * h, [None] * len(window)
        for t in range(len(window)) if d == "f" else reversed(range(len(window))):
            into, back = p[f"in_{d}"][window[t]], [sum(state[i] * p[f"re_{d}"][i][j] for i in range(h)) for j in range(3 * h)]
            z, r = [sigmoid(into[j] + back[j]) for j in range(h)], [sigmoid(into[h + j] + back[h + j]) for j in range(h)]
            c = [math.tanh(into[2 * h + j] + r[j] * back[2 * h + j]) for j in range(h)]
            state = out[t] = [c[j] + z[j] * (state[j] - c[j]) for j in range(h)]
        return out

    def plain(text):
        data, total = text.encode(), np.zeros(3)
        for i in range(0, len(data), language.WINDOW):
            window = data[i : i + language.WINDOW]
            for f, b in zip(states(window, "f"), states(window, "b"), strict=True):
                e = np.exp(np.array(f + b) @ p["out"] + p["bias"])
                total += e / e.sum()
        return total / len(data)

    texts = ["hello world, wie geht's", "ñandú " * 30, "x", "a" * 64, "b" * 65]
    for r in language.identified(docs([(i, t, None) for i, t in enumerate(texts)]), net).collect():
        want = plain(texts[r["doc_id"]])
        assert r["lang_pred"] == "abc"[int(want.argmax())] and math.isclose(r["score"], want.max(), abs_tol=1e-4)
    assert language.identified(docs([]), net).count() == 0


def test_quality_equals_a_plain_description(spark, docs):
    """Counted one text at a time, then ranked by the learned weights."""
    texts = [t for _, t, _ in ODD] + ["SHOUT! It's | 12 ## ok\nnext line, next line, next", "a a a b b c"]
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["stone", "RIVER!!", "cloud,", "a#b"]) for _ in range(30 + i)), None) for i in range(40)]
    labels = spark.createDataFrame([(i, int(rng.random() < 0.5)) for i in range(40)], "doc_id long, quality int")
    model = quality.learn(docs(rows), labels)

    def share(part, whole):
        return part / max(1, whole)

    def plain(text):
        data = (text or "").encode()
        w = [x for x in re.split(rb"[\x20\x09-\x0d]+", data) if x]
        n, kinds = len(w), Counter()
        for b in data:
            c = chr(b) if b < 128 else "x"
            kinds["upper" if "A" <= c <= "Z" else "digit" if c.isdigit() else "stop" if c in ".,;:?'\"()-" else "junk" if c in "#$%&*@^~<>{}[]=+_\\/`" else "bar" if c == "|" else "bang" if c == "!" else "line" if c in "\n\r" else "blank" if c in " \t\v\f" else "x"] += 1
        sizes, pairs = [len(x) for x in w], list(zip(w, w[1:]))
        mean = share(sum(sizes), n)
        shout = sum(sum(65 <= b <= 90 for b in x) >= 2 for x in w)
        soiled = sum(any(chr(b) in "#$%&*@^~<>{}[]=+_\\/`|!" for b in x) for x in w)
        top = lambda c: max(c.values(), default=0)
        return [
            math.log1p(n), share(kinds["upper"], len(data)), share(kinds["digit"], len(data)), *(share(kinds[k], n) for k in ("stop", "junk", "bar", "bang")), math.log1p(kinds["line"]), share(kinds["line"], n), share(kinds["blank"], n),
            mean, math.sqrt(max(0, share(sum(x * x for x in sizes), n) - mean**2)), share(len(set(w)), n), math.log1p(n) * share(len(set(w)), n), share(top(Counter(w)), n),
            share(len(set(pairs)), len(pairs)), share(top(Counter(pairs)), len(pairs)), share(sum(a == b for a, b in pairs), len(pairs)), share(shout, n), share(soiled, n),
        ]

    got = quality.scored(docs([(i, t, None) for i, t in enumerate(texts)]), model).collect()
    for r in got:
        z = [min(4, max(-4, (x - m) / s)) for x, m, s in zip(plain(texts[r["doc_id"]]), model.mean, model.spread, strict=True)]
        rank = sum(a * b for a, b in zip(z + [v * v for v in z], model.weights, strict=True))
        assert math.isclose(r["score"], 1 / (1 + math.exp(-min(30, max(-30, model.scale * (rank - model.threshold))))), rel_tol=1e-6)
    assert len(got) == len(texts) and quality.scored(docs([]), model).count() == 0


def test_toxicity_equals_a_plain_scorer(spark, docs):
    rows = _toy(240, "idiot")
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows], "doc_id long, toxic int")
    model = toxicity.learn(docs([(i, t, "en") for i, t, _ in rows]), labels)
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist(), strict=True))

    def key(word):
        data = np.frombuffer(word, np.uint8)
        return int(toxicity._hashes(data, np.array([0]), np.array([len(data)]))[0])

    def plain(text):  # without disguise: words and their beginnings, the most telling one
        best = 0.0
        for word in re.findall(rb"[a-z\x80-\xff]+", (text or "").lower().encode()):
            keys = [key(word)] if len(word) >= 3 else []
            keys += [key(word[:n]) ^ n for n in (4, 5) if len(word) > n]
            best = max([best, *(weight.get(k, 0.0) for k in keys)])
        return 1 / (1 + math.exp(-min(30, max(-30, model.slope * best + model.offset))))

    texts = [t for _, t, _ in rows[:40]] + [None, "", "idiot", "idio", "idiotic stone", "Idiot, river", "stone river"]
    got = toxicity.scored(docs([(i, t, None) for i, t in enumerate(texts)]), model).collect()
    assert len(got) == len(texts) and all(math.isclose(r["score"], plain(texts[r["doc_id"]]), rel_tol=1e-9) for r in got)
    assert toxicity.scored(docs([]), model).count() == 0


def test_pieces_equal_the_tokenizer(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.encode_special_tokens = True  # as the vocabulary's notes have it: such strings in a text are ordinary text
    special = "a <|startoftext|> b <|endoftext|>c \x02 \x02x <|endoftext|>" * 9
    rows = [*ODD, (20, special, "en"), (21, "UPPER Case, don't stop! 12,345 ünïcode 😀" * 40, "en"), *[(22, "same words again " * 30, "en")] * 40]
    capacity = 100
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packing.pack(docs(rows), P.path("word_bpe_49k.json"), capacity).collect()))
    want = []
    for i, text, _ in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(i is None, i or 0, k, k * capacity, len(part), zlib.crc32(np.array(part, "<u4").tobytes())) for k in range(-(-len(ids) // capacity)) if (part := ids[k * capacity : (k + 1) * capacity])]
    assert got == sorted(want)


def test_media_equals_plain_sums(spark, docs):
    """Pictures built pixel by pixel: the stored form, area means and the difference hash."""
    rows = [*ODD[:8], (30, "The quick brown fox. " * 37, None), (31, "x" * 64, None)]
    got = {r["doc_id"]: r for r in media.media_digests(docs(rows)).collect()}
    for i, text, _ in rows:
        data = (text or "").encode()
        data += bytes(-len(data) % 64 or 64 * (not data))
        pixels = [data[k : k + 64] for k in range(0, len(data), 64)]
        head = b"P5\n64 %d\n255\n" % len(pixels)
        if len(pixels) % 2:
            assert got[i]["media_sha256"] == hashlib.sha256(head + data).hexdigest() and got[i]["media_bytes"] == len(head) + len(data)

        def area(r, c, h=len(pixels), pixels=pixels):
            y0, y1, x0, x1 = r * h / 8, (r + 1) * h / 8, c * 64 / 9, (c + 1) * 64 / 9
            return sum(pixels[y][x] * max(0, min(y + 1, y1) - max(y, y0)) * max(0, min(x + 1, x1) - max(x, x0)) for y in range(int(y0), min(h, math.ceil(y1))) for x in range(int(x0), min(64, math.ceil(x1)))) / ((y1 - y0) * (x1 - x0))

        small = [[area(r, c) for c in range(9)] for r in range(8)]
        bits = "".join(str(int(round(row[c + 1], 6) > round(row[c], 6))) for row in small for c in range(8))
        assert got[i]["feature"] == f"{int(bits, 2):016x}"
    tiles = {r["doc_id"]: r for r in media.media_tiles(docs(rows), 8, 9).collect()}
    assert all(hashlib.sha256(bytes(tiles[i]["tile"])).hexdigest() == got[i]["tile_sha256"] and hashlib.sha256(bytes(tiles[i]["media"])).hexdigest() == got[i]["media_sha256"] for i in got)
    assert media.media_digests(docs([])).count() == 0


def test_quality_learns_from_every_pair(spark, docs):
    """The weights are those of a plain Newton's method over all pairs of a good and a bad row."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["stone", "RIVER!!", "cloud,", "a#b", "x1"][: 3 + i % 3]) for _ in range(20 + i % 17)), None) for i in range(120)]
    marks = {i: int((i % 3 == 0) != (rng.random() < 0.2)) for i, *_ in rows}
    model = quality.learn(docs(rows), spark.createDataFrame(list(marks.items()), "doc_id long, quality int"))
    x = quality.describe(pa.array([t for _, t, _ in rows]))
    y = np.array([marks[i] for i, *_ in rows])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.spread, np.maximum(x.std(0), 1e-6))
    z = model.design(x)
    lead, w = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, z.shape[1]), np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(lead @ w))
        w = w + np.linalg.solve((lead * (p * (1 - p))[:, None]).T @ lead / len(lead) + 1e-3 * np.eye(len(w)), lead.T @ p / len(lead) - 1e-3 * w)
    assert np.abs(model.weights - w).max() < 0.02
    s = z @ model.weights
    errors = lambda t: np.mean(s[y == 0] >= t) + np.mean(s[y == 1] < t)
    assert errors(model.threshold) <= min(map(errors, np.quantile(s, np.linspace(0.005, 0.995, 199)))) + 0.02


def test_toxicity_learns_from_all_rows(spark, docs, monkeypatch):
    """Every labelled row is counted, and the calibration gets a row for each weight, not for each text."""
    found, calibrate = [], toxicity._calibrate
    monkeypatch.setattr(toxicity, "_calibrate", lambda *a: found.append(a) or calibrate(*a))
    toxic, n = _toy(240, "idiot"), 12_600
    labels = spark.createDataFrame([(i, bad) for i, _, bad in toxic] + [(1000 + i, 0) for i in range(n)], "doc_id long, toxic int")
    model = toxicity.learn(docs([(i, t, "en") for i, t, _ in toxic] + [(1000 + i, "stone qqq", "en") for i in range(n)]), labels)
    clean = n + sum(not bad for *_, bad in toxic)
    x, y, count = found[0]
    assert count[y == 0].sum() == clean and count.sum() == n + 240 and len(x) < 300
    q = 16
    assert model.counts[q * 729 + q * 27 + q] == n
    assert np.allclose(calibrate(x, y, count), calibrate(np.repeat(x, count.astype(int)), np.repeat(y, count.astype(int)), np.ones(int(count.sum()))))


def test_quality_steps_do_not_run_away(spark):
    """Two tight groups: the curvature stays that of pairs, and the steps lower the loss; they went to weights of 40 and more, with a third of the rows misplaced."""
    rng = np.random.default_rng(1)
    y = (np.arange(100) % 3 > 0).astype(int)
    x = y[:, None] + rng.normal(0, 0.1, (100, quality.FEATURES))
    rows = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(y, x, strict=True)], "y long, x array<double>")
    model = quality.bradley_terry(rows.coalesce(1))
    assert ((model.rank(x) >= model.threshold) == y).all() and np.abs(model.weights).max() < 1
    same = quality.bradley_terry(rows.coalesce(1).select("y", F.array_repeat(F.lit(1.0), quality.FEATURES).alias("x")))
    assert not same.weights.any()


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_toxicity_shuffles_labelled_texts_only(spark, docs, monkeypatch, broadcast):
    """The plan is the same for small and large labels, and other texts stay out of the shuffle."""
    found, stored = [], toxicity.Scratch.stored
    monkeypatch.setattr(toxicity.Scratch, "stored", lambda self, df: found.append(df) or stored(self, df))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        table = docs([(i, f"stone {i}", "en") for i in range(3000)] + [(7, "again", "en"), (None, "none", "en")])
        labels = spark.createDataFrame([(i, i // 10 % 2) for i in range(0, 3000, 10)] + [(7, 0), (7, 1), (8, None), (None, 1)], "doc_id long, toxic int")
        toxicity.learn(table, labels)
        plan = found[0]._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and plan.count("BroadcastHashJoin") == 1
        got = [tuple(r) for r in found[0].select("text", "label").collect()]
        assert sorted(got) == sorted([(f"stone {i}", i // 10 % 2) for i in range(0, 3000, 10)] + [(t, k) for t in ("stone 7", "again") for k in (0, 1)])
        assert 302 <= scoring.sieved(table.select("doc_id", "text"), scoring.labelled(labels, "toxic")).count() < 600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
