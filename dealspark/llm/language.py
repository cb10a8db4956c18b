"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes in both directions and labels every position; a
document's probabilities are the means over all its positions. It is trained in numpy by backpropagation
through time, on the driver, from a bounded sample: about ``PER_LANGUAGE`` texts of each language, chosen
by a hash of doc_id, and ``WINDOWS`` windows of each. Prediction reads every byte of every text.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text where
nothing could be learned; texts shorter than a window are read, and learned from, as one shorter window; ties of
probability go to the language that sorts first; repeated rows get equal results; other columns don't matter; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.llm import kernels as K

PER_LANGUAGE, WINDOWS = 600, 6
WINDOW, HIDDEN = 64, 8
STEPS, BATCH, RATE = 260, 256, 0.02
_CHUNK = 1024
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Parameters by name; f: forward, b: backward. Gates are update, reset and candidate, in this order."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.p = {}
        for d in "fb":
            self.p[f"in_{d}"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.p[f"re_{d}"] = rng.normal(0, 0.3, (hidden, 3 * hidden)).astype(np.float32)
        self.p["out"] = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.p["bias"] = np.zeros(len(languages), np.float32)

    def _run(self, x: np.ndarray, valid: np.ndarray | None, d: str, tape: list | None = None) -> np.ndarray:
        """Hidden states (time, window, unit) of one direction. x: bytes (time, window)."""
        steps, n = x.shape
        h, size = np.zeros((n, self.hidden), np.float32), self.hidden
        out = np.empty((steps, n, size), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = self.p[f"in_{d}"][x[t]]
            u = h @ self.p[f"re_{d}"]
            gates = _sigmoid(a[:, : 2 * size] + u[:, : 2 * size])
            z, r = gates[:, :size], gates[:, size:]
            c = np.tanh(a[:, 2 * size :] + r * u[:, 2 * size :])
            new = c + z * (h - c)
            if tape is not None:
                tape.append((t, h, z, r, c, u[:, 2 * size :]))
            if valid is not None:
                new *= valid[t][:, None]
            h = out[t] = new
        return out

    def _read(self, x: np.ndarray, valid: np.ndarray, d: str, out: np.ndarray) -> None:
        """As _run, but into ``out`` and with buffers of its own: prediction reads every byte of the corpus."""
        steps, n = x.shape
        size = self.hidden
        gates_in, new_in = np.ascontiguousarray(-self.p[f"in_{d}"][:, : 2 * size]), np.ascontiguousarray(-2 * self.p[f"in_{d}"][:, 2 * size :])
        gates_re, new_re = np.ascontiguousarray(-self.p[f"re_{d}"][:, : 2 * size]), np.ascontiguousarray(-2 * self.p[f"re_{d}"][:, 2 * size :])
        g, u = np.empty((2, n, 2 * size), np.float32)
        c, v = np.empty((2, n, size), np.float32)
        h = np.zeros((n, size), np.float32)
        short = ~valid.all(1)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            np.take(gates_in, x[t], axis=0, out=g, mode="clip")
            g += np.dot(h, gates_re, out=u)
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            np.dot(h, new_re, out=v)
            v *= g[:, size:]
            np.take(new_in, x[t], axis=0, out=c, mode="clip")
            c += v
            np.exp(c, out=c)
            c += 1
            np.divide(2, c, out=c)
            c -= 1
            h = np.subtract(h, c, out=out[t])
            h *= g[:, :size]
            h += c
            if short[t]:
                h *= valid[t][:, None]

    def probabilities(self, x: np.ndarray, valid: np.ndarray | None = None) -> np.ndarray:
        """(time, window, language)."""
        steps, n = x.shape
        valid = np.ones((steps, n), np.float32) if valid is None else valid
        states = np.empty((2, steps, n, self.hidden), np.float32)
        with np.errstate(over="ignore"):
            for k, d in enumerate("fb"):
                self._read(x, valid, d, states[k])
        half = self.hidden
        e = states[0].reshape(-1, half) @ self.p["out"][:half]
        e += states[1].reshape(-1, half) @ self.p["out"][half:]
        e += self.p["bias"]
        np.exp(np.minimum(e, 60, out=e), out=e)
        total = e[:, 0].copy()
        for k in range(1, e.shape[1]):
            total += e[:, k]
        e /= total[:, None]
        return e.reshape(steps, n, -1)

    def gradients(self, x: np.ndarray, y: np.ndarray, valid: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all valid positions, and its gradients by backpropagation through time."""
        tapes: dict[str, list] = {"f": [], "b": []}
        mask = np.ones(x.shape, np.float32) if valid is None else valid
        both = np.concatenate([self._run(x, valid, d, tapes[d]) for d in "fb"], 2)
        e = both @ self.p["out"] + self.p["bias"]
        e -= e.max(2, keepdims=True)
        prob = np.exp(e)
        prob /= prob.sum(2, keepdims=True)
        steps, n, _ = prob.shape
        places = max(1.0, float(mask.sum()))
        loss = float(-(np.log(prob[:, np.arange(n), y] + 1e-9) * mask).sum() / places)
        prob[:, np.arange(n), y] -= 1
        prob *= mask[:, :, None] / places
        g = {"out": both.reshape(-1, 2 * self.hidden).T @ prob.reshape(steps * n, -1), "bias": prob.sum((0, 1))}
        above = prob @ self.p["out"].T
        size = self.hidden
        for k, d in enumerate("fb"):
            recurrent, carry = self.p[f"re_{d}"], np.zeros((n, size), np.float32)
            g[f"re_{d}"] = np.zeros_like(recurrent)
            into = np.empty((steps, n, 3 * size), np.float32)
            for t, h, z, r, c, u in reversed(tapes[d]):
                grad = (above[t][:, k * size : (k + 1) * size] + carry) * mask[t][:, None]
                dc = grad * (1 - z) * (1 - c * c)
                dz = grad * (h - c) * z * (1 - z)
                dr = dc * u * r * (1 - r)
                into[t] = np.concatenate([dz, dr, dc], 1)
                du = np.concatenate([dz, dr, dc * r], 1)
                g[f"re_{d}"] += h.T @ du
                carry = grad * z + du @ recurrent.T
            flat = np.zeros((steps * n, 256), np.float32)
            flat[np.arange(steps * n), x.ravel()] = 1
            g[f"in_{d}"] = flat.T @ into.reshape(steps * n, -1)
        return loss, g

    def document_probabilities(self, texts: pa.Array) -> np.ndarray:
        """Mean probabilities over all positions of each text; 0 for empty ones."""
        raw, at = K.text_bytes(texts)
        out = np.zeros((len(at) - 1, len(self.languages)))
        for i, j, part, offsets in K.slices(raw, at):
            sizes = np.diff(offsets)
            parts = -(-sizes // WINDOW)
            row = np.repeat(np.arange(j - i), parts)
            first = np.cumsum(parts) - parts
            start = offsets[row] + (np.arange(len(row)) - first[row]) * WINDOW
            left = np.minimum(offsets[row + 1] - start, WINDOW)
            for a in range(0, len(row), _CHUNK):
                s, n = start[a : a + _CHUNK], left[a : a + _CHUNK]
                places = s + np.arange(WINDOW)[:, None]
                valid = (np.arange(WINDOW)[:, None] < n).astype(np.float32)
                p = self.probabilities(part[np.minimum(places, len(part) - 1)], valid)
                np.add.at(out, i + row[a : a + _CHUNK], (p * valid[:, :, None]).sum(0))
            out[i:j] /= np.maximum(sizes, 1)[:, None]
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        p = self.document_probabilities(texts)
        best = p.argmax(1)
        lettered = has_letter(texts)
        names = [self.languages[k] if ok else "und" for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
        return names, np.where(lettered, np.clip(p.max(1, initial=0), 0, 1), 0.0)


def has_letter(texts: pa.Array) -> np.ndarray:
    raw, at = K.text_bytes(texts)
    count = np.concatenate([[0], np.cumsum(_ASCII_LETTER[raw])])
    found = count[at[1:]] > count[at[:-1]]
    for i in np.flatnonzero(~found & (np.diff(at) > 0)):
        found[i] = any(map(str.isalpha, raw[at[i] : at[i + 1]].tobytes().decode("utf-8", "replace")))
    return found


def train(windows: np.ndarray, names: list[str], sizes: np.ndarray | None = None, steps: int = STEPS, seed: int = 5) -> Network:
    """Adam on windows (n, WINDOW) of bytes with the language of each and how many bytes are its own; batches draw languages alike."""
    languages = sorted(set(names))
    net = Network(languages, seed=seed)
    if not languages:
        return net
    rng = np.random.default_rng(seed)
    by_language = [np.flatnonzero(np.array(names) == x) for x in languages]
    mean = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        y = rng.integers(0, len(languages), BATCH)
        chosen = np.array([rng.choice(by_language[k]) for k in y])
        valid = None if sizes is None or (sizes[chosen] == WINDOW).all() else (np.arange(WINDOW)[:, None] < sizes[chosen]).astype(np.float32)
        _, g = net.gradients(np.ascontiguousarray(windows[chosen].T), y, valid)
        scale = min(1.0, 1.0 / (1e-9 + float(np.sqrt(sum((v * v).sum() for v in g.values())))))
        rate = RATE * (1 - step / (steps + 1)) + 1e-4
        for k, v in g.items():
            v = v * scale
            mean[k] = 0.9 * mean[k] + 0.1 * v
            square[k] = 0.99 * square[k] + 0.01 * v * v
            net.p[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network:
    """A network from text and lang of the given rows; the caller leaves out what must not be learned from."""
    K.prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not counts:
        return Network([])
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, per_language / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, langs, out = b.column(0).to_pylist(), b.column(2).to_pylist(), []
            raw, at = K.text_bytes(b.column(1))
            for k, name in enumerate(langs):
                text = raw[at[k] : at[k + 1]]
                for w, start in enumerate(np.unique(np.linspace(0, max(0, len(text) - WINDOW), WINDOWS).astype(int))):
                    piece = text[start : start + WINDOW]
                    if len(piece):
                        out.append((ids[k], w, name, piece.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * 4, (pa.int64(), pa.int32(), pa.string(), pa.binary()), strict=True)], names=["i", "w", "lang", "bytes"])

    sample = rows.where(drawn).select("doc_id", "text", "lang").mapInArrow(cut, "i long, w int, lang string, bytes binary").toPandas().sort_values(["i", "w"])
    windows = np.frombuffer(b"".join(x.ljust(WINDOW, b"\0") for x in sample["bytes"]), np.uint8).reshape(-1, WINDOW)
    return train(windows, sample["lang"].tolist(), sample["bytes"].map(len).to_numpy())


def identified(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, lang_pred, score for each row."""
    K.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of a size set by HIDDEN and the number of languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, score = shared.value.predict(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = K.documents(spark, sf_dir)
    net = learn(docs.where(K.remainder(F.col("doc_id"), 5) != 0))
    out = identified(docs, net)
    return out.select("doc_id", (K.remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")
