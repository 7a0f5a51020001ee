"""Quality classifier: hashed word n-grams, FTRL-proximal logistic regression, sparse dot products.

Tokens are words, numbers and punctuation runs of the whole text, case kept. Each token also has a
shape (lower, title or upper case, number, the first punctuation character, or a repeat of the token
two or fewer places before). Features are hashed unigrams and bigrams of tokens and uni- to trigrams
of shapes, in ``2**BITS`` places, with log-scaled counts of unit length together.

Training reads at most ``TRAIN_ROWS`` labelled rows, chosen by hash among those whose
crc32(doc_id as text) mod 5 is not 0 (a documented bound). They are dealt by hash into ``SHARDS``
groups; each group makes ``EPOCHS`` passes of per-coordinate follow-the-regularised-leader updates,
and the groups' weights are averaged. Scoring multiplies each text's sparse features with the weights.

Null text: empty, scored by the bias alone. Null labels are not used; with no usable label the score
is 0.5 everywhere. A doc_id labelled twice counts once, by its larger label; a null doc_id is held
out of training. Repeated rows get a row each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cobble.llm.common import prepare, slices, texts

BITS, TRAIN_ROWS, SHARDS, EPOCHS = 18, 12_000, 4, 3
#: FTRL-proximal: learning rate, its smoothing, and the two regularisations.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
#: Score from which a document is predicted to be good (fixed by the result's contract).
GOOD = 0.3
#: Tokens remembered with their hashes in a Python worker.
CACHE = 300_000
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)

_KNOWN: dict[str, tuple[int, int]] = {}


def _token(t: str) -> tuple[int, int]:
    """Hash and shape of a token; shapes below 8 are words, others punctuation by its first character."""
    import xxhash

    if t[0].isdigit():
        shape = 1
    elif t[0].isalpha():
        shape = 2 if t.islower() else 3 if t.istitle() else 4 if t.isupper() else 5
    else:
        shape = 8 + ord(t[0]) % 48 + 64 * min(len(t) - 1, 3)
    return xxhash.xxh64_intdigest(t.encode(), 7), shape


def _coded(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    known, out = _KNOWN, []
    for t in tokens:
        got = known.get(t)
        if got is None:
            if len(known) >= CACHE:
                known.clear()
            got = known[t] = _token(t)
        out.append(got)
    both = np.array(out, np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def features(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features; place 0 is the bias."""
    h, s = _coded(TOKEN.findall(text))
    if not len(h):
        return np.zeros(1, np.int64), np.ones(1)
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[2:] |= h[2:] == h[:-2]
    s = np.where(again & (s < 8), np.uint64(6), s) + np.uint64(1)
    shift = np.uint64(64 - bits)
    grams = [h * _A, s * _B, (s[:-1] * _B + s[1:]) * _C, (s[:-2] * _A + s[1:-1] * _B + s[2:]) * _C, (h[:-1] * _B + h[1:]) * _A]
    places, counts = np.unique(np.concatenate(grams) * _A >> shift, return_counts=True)
    values = np.log1p(counts)
    values /= np.sqrt(values @ values)
    return np.append(0, places.astype(np.int64)), np.append(1.0, values)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, float]],
    size: int,
    epochs: int = EPOCHS,
    alpha: float = ALPHA,
    beta: float = BETA,
    l1: float = L1,
    l2: float = L2,
) -> np.ndarray:
    """Weights after FTRL-proximal updates over (places, values, label between 0 and 1) in the order given."""
    z, n = np.zeros(size), np.zeros(size)

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) > l1, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)

    for _ in range(epochs):
        for at, x, y in rows:
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            g = (sigmoid(w @ x) - y) * x
            more = ni + g * g
            z[at] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / alpha * w
            n[at] = more
    return weights(z, n)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5: 0 is held out."""
    return F.crc32(doc_id.cast("string")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, y) of at most ``most`` labelled rows outside the held-out fold, chosen by hash."""
    known = labels.select(labels["doc_id"].cast("bigint").alias("doc_id"), labels[label].cast("int").alias("y"))
    known = known.filter((fold(F.col("doc_id")) != 0) & F.col("y").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # ``most`` rows of two numbers: bounded, so the texts of all other documents need not move.
    return texts(docs).join(F.broadcast(picked), "doc_id").limit(2 * most)


def train(rows: DataFrame, make: Callable = features, bits: int = BITS, shards: int = SHARDS, **how) -> np.ndarray:
    """Averaged FTRL weights from ``rows`` (doc_id, text, y), a group of them in each of ``shards`` tasks."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = []
        for batch in slices(batches):
            cols = (batch.column(k).to_pylist() for k in ("text", "y"))
            data += [(*make(t), float(y)) for t, y in zip(*cols, strict=True)]
        if data:
            w = ftrl(data, 1 << bits, **how)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(data)], pa.int64()), pa.array([at.tolist()]), pa.array([w[at].tolist()])], names=["n", "at", "w"]
            )

    dealt = rows.repartition(shards, F.pmod(F.xxhash64("doc_id"), F.lit(shards))).sortWithinPartitions(
        F.xxhash64("doc_id", F.lit(1)), "doc_id", "text"
    )
    total, size = np.zeros(1 << bits), 0
    for r in dealt.mapInArrow(fit, "n bigint, at array<bigint>, w array<double>").collect():  # one row a shard
        total[np.array(r.at, np.int64)] += np.array(r.w) * r.n
        size += r.n
    return total / max(size, 1)


def scorer(weights: np.ndarray, make: Callable = features) -> Callable[[str], float]:
    return lambda text: float(sigmoid(weights[(f := make(text or ""))[0]] @ f[1]))


def score_column(spark, weights: np.ndarray, make: Callable = features) -> Callable[[Column], Column]:
    """A function from a text column to its score; the weights, of fixed size, are broadcast."""
    held = spark.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        return column.map(scorer(held.value.astype(np.float64), make), na_action=None).astype("float64")

    return score


def quality_model(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> np.ndarray:
    prepare(docs.sparkSession)
    return train(training_rows(docs, labels, "quality", most))


def score_quality(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    score = score_column(docs.sparkSession, quality_model(docs, labels, most))
    scored = texts(docs).select("doc_id", score("text").alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the rows scored below ``GOOD``."""
    score = score_column(docs.sparkSession, quality_model(docs, labels, most))
    return docs.filter(score(docs["text"]) >= GOOD)
