"""Toxicity by logistic regression, learned with FTRL-proximal over hashed word n-grams and skip-grams.

A text's features are the words, neighbouring pairs and pairs with one word between them that it holds,
hashed into ``BITS`` bits. Every weight has its own learning rate, and the L1 penalty keeps most of them at
zero, so the model is a short list of (feature, weight) that is broadcast; texts are scored where they are read.

The model is fitted on a bounded sample of the labelled rows: the ``TOXIC`` toxic and ``CLEAN`` clean ones with the
least hashed ids, as far as their features fit into ``MOST_BYTES``. All features of a row are learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalends.llm.common import bucket_of_id
from kalends.llm.tokens import Remembered
from kalends.storage import materialise

BITS = 20
#: Most labelled rows of each kind that the fit reads, and most bytes of their features: rows are taken whole, in the
#: order of their hashed ids, as long as those before them leave room.
TOXIC, CLEAN = 3000, 9000
MOST_BYTES = {1: 100_000_000, 0: 200_000_000}
ALPHA, BETA, L1, L2 = 1.0, 1.0, 16.0, 0.0
EPOCHS = 6
THRESHOLD = 0.7
#: Rows with this remainder of crc32(doc_id) by FOLDS are held out.
FOLDS, HELD_OUT = 3, 1

_NEXT, _SKIP, _SPREAD = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_WORDS = re.compile(r"[^\W_]+")


class Features:
    """The sorted distinct features of a text."""

    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.word = Remembered(lambda w: xxhash.xxh64_intdigest(w) | 1)

    def __call__(self, text: str | None) -> np.ndarray:
        words = _WORDS.findall((text or "").lower())
        h = np.fromiter(map(self.word.__getitem__, words), np.uint64, len(words))
        with np.errstate(over="ignore"):
            pairs, skips = h[:-1] * _NEXT + h[1:], h[:-2] * _SKIP + h[2:]
            return np.unique((np.concatenate([h, pairs, skips]) * _SPREAD) >> self.shift).astype(np.int32)


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on (features, label) rows in order; the non-zero (features, weights) and the intercept."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(at):
        values = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, values)

    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            features, label = rows[k]
            at = np.append(features, 1 << bits)  # the last place is the intercept's
            w = weights(at)
            gradient = float(sigmoid(w.sum())) - label
            step = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - step * w
            n[at] += gradient * gradient
    final = weights(np.arange((1 << bits) + 1))
    used = np.flatnonzero(final[:-1])
    return used.astype(np.int32), final[used], float(final[-1])


def training_rows(documents: DataFrame, labels: DataFrame) -> list[tuple[np.ndarray, int]]:
    """Features and labels of the bounded sample; held-out rows and null labels take no part.

    An id with several labels has the least of them, one with several texts the text with the least hash.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).where(
        F.col("_id").isNotNull() & F.col("_toxic").isin(0, 1) & (bucket_of_id(F.col("_id"), FOLDS) != HELD_OUT)
    ).groupBy("_id").agg(F.min("_toxic").alias("_toxic"))
    order = [F.xxhash64("_id"), F.col("_id")]
    some = known.where("_toxic = 1").orderBy(*order).limit(TOXIC).union(known.where("_toxic = 0").orderBy(*order).limit(CLEAN))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [features(t.as_py()).tobytes() for t in part.column(3)]
                yield pa.record_batch([*part.columns[:3], pa.array(found, pa.binary())], ["_id", "_toxic", "_text", "features"])

    chosen = documents.join(F.broadcast(some), documents["doc_id"] == some["_id"])  # TOXIC + CLEAN rows
    rows = chosen.select("_id", "_toxic", F.xxhash64("text").alias("_text"), "text").mapInArrow(
        read, "_id long, _toxic int, _text long, features binary"
    )
    rows = materialise(rows, "toxic-features")
    first = rows.select("_id", "_toxic", F.struct("_text", F.octet_length("features").alias("size")).alias("x")).groupBy("_id", "_toxic").agg(F.min("x").alias("x"))
    so_far = F.sum("x.size").over(Window.partitionBy("_toxic").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    room = F.when(F.col("_toxic") == 1, MOST_BYTES[1]).otherwise(MOST_BYTES[0])
    fitting = first.withColumn("_so_far", so_far).where(F.col("_so_far") <= room).select("_id", F.col("x._text").alias("_text"))
    kept = rows.join(F.broadcast(fitting), ["_id", "_text"]).dropDuplicates(["_id"]).collect()  # at most MOST_BYTES
    kept.sort(key=lambda r: r["_id"])
    return [(np.frombuffer(r.features, np.int32), r["_toxic"]) for r in kept]


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Defined cases: a null or empty text has no features and the intercept's score; without labels of both
    kinds every score is 0; an id labelled twice counts once, by the least label; a null id is not held out; repeated
    rows get equal scores; an empty table gives no rows; extra columns are ignored.
    """
    documents = documents.select(F.col("doc_id").cast("long"), "text")
    rows = training_rows(documents, labels)
    model = ftrl(rows) if len({label for _, label in rows}) == 2 else (np.empty(0, np.int32), np.empty(0), -np.inf)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # at most 2 ** BITS weights

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, values, intercept = shared.value
        dense = np.zeros(1 << BITS)
        dense[used] = values
        features = Features()
        for batch in batches:
            sums = np.array([intercept + dense[features(t.as_py())].sum() for t in batch.column(1)], dtype=float)
            result = np.where(np.isneginf(sums), 0.0, sigmoid(sums))
            yield pa.record_batch([batch.column(0), pa.array(result)], ["doc_id", "score"])

    return documents.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", (bucket_of_id(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
