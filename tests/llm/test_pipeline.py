"""The corpus pipeline, stage by stage and as a whole, against plain versions."""

import random
import re
import zlib

import corpus_pipeline
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from dealspark.llm import quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string, kept boolean"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    plain = ["stone", "river", "cloud", "garden", "window", "paper", "silver", "music", *(f"word{i}" for i in range(300))]
    rows, labels = [], []
    for i in range(260):
        words = [rng.choice(plain) for _ in range(rng.randint(30, 90))]
        toxic, bad = i % 9 == 0, i % 7 == 0
        if toxic:
            words[rng.randrange(30)] = rng.choice(["idiot", "id10t", "idiooot"]) if i % 2 else "idiot"
        text = " ".join(words)
        rows.append((i, text.upper().replace(" ", " ## ") + "!!!" if bad else text))
        labels.append((i, int(not bad), int(toxic)))
    for i in range(40):  # near and exact copies of earlier texts
        words = rows[i * 3 + 1][1].split(" ")
        if i % 2:
            words[-1] = "changed"
        rows.append((1000 + i, " ".join(words)))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, rows[10][1]), (2003, rows[10][1]), (None, rows[10][1]), (None, None), (2004, "long words " * 9000)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, None if i == 3 else "en", "s", len(t or ""), 0.0, "x", True) for i, t in rows], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def texts_of(df):
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=key)


def near_copies(rows):
    """doc_ids that fall to a smaller one by five-word shingles at 80 percent, all pairs compared."""
    sets = {}
    for i, text in rows:
        w = WORD.findall((text or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(i for i in sets if i is not None)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {i for i in ids if top(i) != i}


def test_stages_and_the_whole_against_plain_versions(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    fold = lambda i, n: zlib.crc32(str(i).encode()) % n
    labels = spark.read.parquet(f"{corpus}/labels.parquet").collect()
    for name, stage in corpus_pipeline.STAGES[:2]:
        column, apart = ("toxic", lambda i: fold(i, 5) != 0) if name == "toxicity" else ("quality", lambda i: fold(i, 3) != 1)
        module = toxicity if name == "toxicity" else quality
        model = module.learn(docs, spark.createDataFrame([(r["doc_id"], r[column]) for r in labels if apart(r["doc_id"])], f"doc_id long, {column} int"))
        before = texts_of(docs)
        kept = stage(spark, docs, corpus)
        assert kept.columns == docs.columns
        scores = model.scores(pa.array([t for _, t in before]))
        assert texts_of(kept) == [r for r, s in zip(before, scores, strict=True) if (s < 0.5 if name == "toxicity" else s >= 0.5)]
        assert 0 < kept.count() < len(before)
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    left = texts_of(docs)
    gone = near_copies(left)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, corpus)
    assert kept.columns == docs.columns and gone and texts_of(kept) == [r for r in left if r[0] not in gone]
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = sorted((i is None, i or 0, n) for i, text in texts_of(kept) for n in [len(t.encode(text or "", add_special_tokens=False).ids) + 1])
    packed = corpus_pipeline.run(spark, corpus).collect()
    got = {}
    for r in packed:
        got.setdefault((r["doc_id"] is None, r["doc_id"] or 0, r["ids_crc32"] if r["piece"] == 0 and r["length"] < 4096 else r["doc_id"]), []).append(r["length"])
    assert sum(map(sum, got.values())) == sum(n for *_, n in want) and {k[:2] for k in got} == {k[:2] for k in want}
    used = {}
    for r in packed:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in used.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 4096


def test_empty_tables(spark, corpus, tmp_path):
    spark.read.parquet(f"{corpus}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{corpus}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_without_labels_nothing_is_rejected(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(30)
    spark.read.parquet(f"{corpus}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, docs, str(tmp_path)).count() == docs.count()
