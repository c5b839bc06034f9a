"""Toxicity: a character n-gram linear classifier scaled by naive Bayes log-count ratios.

A document's features are its character n-grams (``SIZES`` code points, inside
lower-cased words with a blank at either end), hashed to ``DIM`` cells; a cell's
value is log(1 + count), and a document's values are scaled to length one. Values
are multiplied by the cell's log-count ratio ``log((p + a) / |p|) - log((q + a) /
|q|)`` of the toxic (p) and clean (q) training documents, and a logistic
regression is fitted on these scaled features.

The model is fitted on a bounded sample of labelled rows: the ``sample_rows``
smallest hashes of doc_id among the labelled rows outside the held-out quarter, of each the
``SAMPLE_CELLS`` cells of the largest values (then of the smallest numbers).
That sample is the only data that reaches the driver (at most ``sample_rows`` * ``SAMPLE_CELLS``
cells, 49 MB); scoring is a map over all documents with all their cells and shuffles nothing.

Edge cases: very long texts are scored whole; a null text is an empty one and gets the score of no features; null
or unlabelled ids never enter training; an id labelled twice is toxic if any
label says so; without labels of both kinds every score is the share of toxic
labels (0 without labels). Rows and extra columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import expand, flat_words, fresh, slices, small_batches, table

BITS = 18
DIM = 1 << BITS
SIZES = (4, 6, 7)
SAMPLE_ROWS, SAMPLE_CELLS = 3000, 2048
THRESHOLD = 0.3
SLICE = 1 << 20  # bytes of text a task works on at once


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of each word, as offsets and cells."""
    text = " " + " ".join(w.lower() for w in words) + " "
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    blank = code == 32
    word_at = np.cumsum(blank) - 1  # a blank belongs to the word after it
    blanks = np.concatenate(([0], np.cumsum(blank)))
    cells, owner = [], []
    for n in SIZES:
        m = len(code) - n + 1
        if m <= 0:
            continue
        inside = (blanks[n - 1 : n - 1 + m] - blanks[1 : 1 + m]) == 0
        at = np.flatnonzero(inside)
        h = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ code[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        cells.append((h >> np.uint64(64 - BITS)).astype(np.int32))
        owner.append(word_at[at])
    if not cells:
        return np.zeros(len(words) + 1, np.int64), np.empty(0, np.int32)
    cell, own = np.concatenate(cells), np.concatenate(owner)
    order = np.argsort(own, kind="stable")
    return np.concatenate(([0], np.cumsum(np.bincount(own, minlength=len(words))[: len(words)]))), cell[order]


def document_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct cells of each text, and log(1 + count) of each, scaled to length one."""
    words, counts = flat_words(texts)
    coded = words.dictionary_encode()
    offsets, cells = word_features(coded.dictionary.to_pylist())
    index, ends = coded.indices.to_numpy(), np.cumsum(counts)
    last = np.zeros(DIM, np.int64)
    for a, b in zip(ends - counts, ends, strict=True):
        w, times = np.unique(index[a:b], return_counts=True)
        size = offsets[w + 1] - offsets[w]
        every = cells[expand(offsets[w], size)]
        at = np.arange(len(every))
        last[every] = at  # of equal cells the last place stays: one place a cell
        place = last[every]
        one = place == at
        count = np.bincount((np.cumsum(one) - 1)[place], weights=np.repeat(times, size), minlength=int(one.sum()))
        value = np.log1p(count)
        yield every[one], value / max(1e-12, np.sqrt((value**2).sum()))


@dataclass(frozen=True)
class Model:
    """score = sigmoid(bias + sum of weight times value over the cells)."""

    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        z = np.array([self.bias + (self.weights[c] * v).sum() for c, v in document_features(texts)], dtype=np.float64)
        return np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 9)


def fit_features(cells: list[np.ndarray], values: list[np.ndarray], toxic: np.ndarray, rounds: int = 60, ridge: float = 0.01, rate: float = 1.0) -> Model:
    """Log-count ratios, then logistic regression on the scaled features (Adam, full batches)."""
    weights = np.zeros(DIM)
    share = float(toxic.mean()) if len(toxic) else 0.0
    if share in (0.0, 1.0):
        return Model(weights, 30.0 if share else -30.0)
    n, rows = len(cells), np.repeat(np.arange(len(cells), dtype=np.int32), [len(c) for c in cells])
    at, x = (np.concatenate(c) if len(rows) else np.empty(0, kind) for c, kind in ((cells, np.int32), (values, np.float32)))
    smooth = float(x.mean()) if len(x) else 1.0  # one average occurrence
    p, q = (np.bincount(at[toxic[rows] == k], weights=x[toxic[rows] == k], minlength=DIM) + smooth for k in (1, 0))
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    x = (x * ratio[at]).astype(np.float32)
    beta, bias = np.zeros(DIM), float(np.log(share / (1 - share)))
    m, v, mb, vb = np.zeros(DIM), np.zeros(DIM), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = bias + np.bincount(rows, weights=x * beta[at], minlength=n)
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic) / n
        g, gb = np.bincount(at, weights=x * e[rows], minlength=DIM) + ridge * beta / n, e.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        step = rate / np.sqrt(1 + t / 20)
        beta -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8) * (ratio != 0)
        bias -= step * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return Model(ratio * beta, float(bias))


def largest(cells: np.ndarray, values: np.ndarray, most: int = SAMPLE_CELLS) -> tuple[np.ndarray, np.ndarray]:
    """At most so many cells: those of the largest values, of equal ones the smallest cells."""
    if len(cells) > most:
        kept = np.lexsort((cells, -values))[:most]
        cells, values = cells[kept], values[kept]
    return cells, values


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """docs: doc_id, text. labels: doc_id, toxic. Held-out ids are left out here."""
    small_batches(docs.sparkSession)
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, "text", SLICE)):
            out = [largest(c, v) for c, v in document_features(b.column("text"))]
            columns = [pa.array([c.astype(np.int32) for c, _ in out], pa.list_(pa.int32())), pa.array([v.astype(np.float32) for _, v in out], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), *columns], names=["doc_id", "toxic", "cells", "values"])

    toxic_type = found.schema["toxic"].dataType.simpleString()
    id_type = found.schema["doc_id"].dataType.simpleString()
    got = found.mapInArrow(cells, f"doc_id {id_type}, toxic {toxic_type}, cells array<int>, values array<float>").toArrow().sort_by("doc_id")
    return fit_features(*([c.values.to_numpy() for c in got[name]] for name in ("cells", "values")), np.asarray(got["toxic"].to_pylist(), dtype=np.int64))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a column more, which replaces one of its name; all others pass as they are."""
    small_batches(docs.sparkSession)
    kept = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM weights, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, text, SLICE)):
            s = shared.value.score(b.column(text))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*b.schema.names, out])

    from pyspark.sql import types as T

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())]))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is under the threshold, with their own columns."""
    out = fresh(docs, "toxicity")
    return score(docs, fit(docs, labels), out=out).where(F.col(out) < threshold).drop(out)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
