"""Operator 8, quality classifier: hashed word n-grams, logistic regression by FTRL-proximal, sparse dot products.

A text's tokens are its lower-cased words and, beside them, the *shape* of each
word (runs of lower, upper, digits collapsed; signs kept), and its features the
hashed 1- and 2-grams of words and 1- to 3-grams of shapes, each kind weighted
to a mean. Everything is computed from the bytes of a batch of texts at once.

Training: labelled rows up to ``sample`` (chosen by a hash of doc_id, so the
bound is a share, not a prefix) are dealt to ``shards`` tasks. Each epoch every
task runs FTRL-proximal over its rows from the shared state, and the states'
mean starts the next one. The state (two vectors of 2 ** bits) is all that
reaches the driver. Scoring is one pass without shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import LOWER, RangeHash, documents, mix, small_batches, text_chunks, word_runs
from arrears.session import materialize

BITS = 18
SAMPLE = 20_000
SHARDS = 6
EPOCHS = 3
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[128:] = 97
_RUN = np.isin(np.arange(256), (97, 65, 48))
_KINDS = 5
_GRAM = np.random.default_rng(11).integers(1, 2**62, 16, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _grams(tokens: np.ndarray, doc: np.ndarray, n: int, salt: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the n-grams that stay inside a text."""
    m = len(tokens) - n + 1
    if m <= 0:
        return doc[:0], np.zeros(0, np.int64)
    h = np.full(m, salt, np.uint64)
    for k in range(n):
        h += tokens[k: k + m] * _GRAM[k]
    inside = doc[:m] == doc[n - 1:]
    return doc[:m][inside], (mix(h[inside]) >> np.uint64(64 - bits)).astype(np.int64)


def features(column, bits: int):
    """(i, j, starts, features, weights) per range of texts; weights of one kind sum to 1 in a text."""
    for i, j, data, off in text_chunks(column, 1 << 18):
        start, end, upto = word_runs(data, off)
        n = np.diff(upto)
        doc = np.repeat(np.arange(len(n)), n)
        words = RangeHash(LOWER[data])(start, end)
        shape = _SHAPE[data]
        keep = np.ones(len(shape), bool)
        keep[1:] = (shape[1:] != shape[:-1]) | ~_RUN[shape[1:]]
        keep[start] = True
        place = np.append(0, np.cumsum(keep))
        shapes = RangeHash(shape[keep])(place[start], place[end])
        rows, feats, weights = [], [], []
        for salt, (tokens, size) in enumerate(((words, 1), (words, 2), (shapes, 1), (shapes, 2), (shapes, 3))):
            r, f = _grams(tokens, doc, size, salt + 1, bits)
            rows.append(r)
            feats.append(f)
            weights.append((1.0 / np.maximum(np.bincount(r, minlength=j - i), 1))[r])
        order = np.argsort(np.concatenate(rows), kind="stable")
        row = np.concatenate(rows)[order]
        yield i, j, np.searchsorted(row, np.arange(j - i + 1)), np.concatenate(feats)[order].astype(np.int32), np.concatenate(weights)[order].astype(np.float32)


class Ftrl:
    """FTRL-proximal logistic regression; feature 2 ** bits is the constant."""

    def __init__(self, z: np.ndarray, n: np.ndarray, alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3):
        self.z, self.n, self.alpha, self.beta, self.l1, self.l2 = z, n, alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, feats: np.ndarray, values: np.ndarray, label: float, weight: float) -> None:
        feats, back = np.unique(feats, return_inverse=True)
        feats = np.append(feats, len(self.z) - 1)
        x = np.append(np.bincount(back, weights=values, minlength=len(feats) - 1) if len(values) else values, 1.0)
        w = self.weights(feats)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * weight * x
        n = self.n[feats]
        self.z[feats] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[feats] = n + g * g


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's text, modulo 3, is 1; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(doc_id, text, label) of labelled rows that are not held out, thinned by a hash of doc_id to about ``sample`` rows."""
    known = labels.select("doc_id", F.col(label).cast("double").alias("label")).filter(
        "doc_id is not null and label in (0, 1)").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    n = known.count()
    if n > sample:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(known, "doc_id")


def fit(rows: DataFrame, bits: int = BITS, shards: int = SHARDS, epochs: int = EPOCHS) -> np.ndarray | None:
    """Weights (the last one is the constant), or None without rows of both labels. Classes count alike."""
    rows = materialize(rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(shards))), "labelled")
    count = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(count) < 2:
        return None
    total = sum(count.values())
    balance = {k: total / (2 * v) for k, v in count.items()}
    spark = rows.sparkSession
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    for epoch in range(epochs):
        state = spark.sparkContext.broadcast((z, n))

        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by("doc_id")
            model = Ftrl(state.value[0].copy(), state.value[1].copy())
            label = table.column("label").to_numpy()
            stored = [(label[i + t], f[s[t]: s[t + 1]], w[s[t]: s[t + 1]]) for i, j, s, f, w in features(table.column("text"), bits) for t in range(j - i)]
            for k in np.random.default_rng(epoch).permutation(len(stored)):
                y, f, w = stored[k]
                model.learn(f, w, y, balance[y])
            return pa.table({"z": pa.array([model.z.astype("<f4").tobytes()], pa.binary()), "n": pa.array([model.n.astype("<f4").tobytes()], pa.binary())})

        parts = rows.groupBy("shard").applyInArrow(run, "z binary, n binary").collect()
        z = np.mean([np.frombuffer(p["z"], "<f4") for p in parts], axis=0).astype(float)
        n = np.mean([np.frombuffer(p["n"], "<f4") for p in parts], axis=0).astype(float)
        state.unpersist()
    return Ftrl(z, n).weights()


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", bits: int = BITS, sample: int = SAMPLE,
                  threshold: float = 0.5, keep=()) -> DataFrame:
    """Quality score of every whole text.

    ``docs`` needs doc_id and text; ``labels`` needs doc_id and ``label`` (0 or
    1; other values and nulls are ignored, of several the larger counts).
    Returns one row per input row: doc_id, ``keep`` columns, held_out, score
    (0 to 1) and predicted (1 if score >= ``threshold``).

    Null, empty and blank texts get the constant's score. Without labels of
    both kinds every score is 0.5. Only the text enters a score. Empty table:
    no rows.
    """
    weights = fit(training_rows(docs, labels, label, sample), bits)
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(np.zeros((1 << bits) + 1) if weights is None else weights)
    own = ("doc_id", "held_out", "score", "predicted")
    rest = [c for c in keep if c not in (*own, "text")]
    text = ["text"] if "text" in keep else []

    def run(batches):
        w = model.value
        for b in small_batches(batches):
            score = np.zeros(b.num_rows)
            for i, j, start, feats, values in features(b.column("_text"), bits):
                total = np.append(0.0, np.cumsum(w[feats] * values))
                score[i:j] = 1 / (1 + np.exp(-np.clip(total[start[1:]] - total[start[:-1]] + w[-1], -35, 35)))
            cols = [b.column(c) for c in ("doc_id", "held_out", *rest, *(["_text"] if text else []))]
            yield pa.record_batch([*cols, pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                  names=["doc_id", "held_out", *rest, *text, "score", "predicted"])

    source = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *rest, F.col("text").cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_text")
    return source.mapInArrow(run, f"{schema}{', text string' * len(text)}, score double, predicted int")


def op8_quality_model(spark, sf_dir: str) -> DataFrame:
    return score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
