"""Toxicity by a bag of subword embeddings.

A word is the bag of its character n-grams, each hashed to one of a fixed number of embeddings; the
average over a text goes into a linear softmax of two classes, and embeddings and softmax are trained
together in numpy. A misspelling that was never seen shares most n-grams with the word it comes from.

For two classes the gradient of all embeddings is the outer product of one number for each bucket and
the difference of the two softmax rows, so a training step is two passes over the sparse bags. For the
same reason a trained model scores by one number for each bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.llm.common import map_batches, mixed, table, texts_of, worker_cache

#: Labelled rows that a model is fitted to, at most; chosen by a hash of doc_id.
SAMPLE_ROWS = 4000
FOLDS, HELD_OUT = 5, 0
BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (3, 4, 5)
#: A bucket learns if so many sampled texts have it.
MIN_TEXTS = 5
STEPS = 250
DECAY = 1e-4
BLOCK_TEXTS = 500
#: Averages are taken per hundred n-grams.
SCALE = 100
REMEMBERED = 300_000

#: Signs at the ends of a word, which are no part of it.
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "…«»“”„‘’–—¿¡·"


def word_in(chunk: str) -> str:
    return chunk.strip(EDGES).lower()


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words with their ends marked, and how many each word has."""
    marked = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    letters = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    buckets, owners = [], []
    value = mixed(letters + np.uint64(1))
    rolled = np.zeros(len(letters), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        length = len(letters) - n + 1
        if length <= 0:
            break
        rolled = rolled[:length] * np.uint64(0x9E3779B97F4A7C15) + value[n - 1 :]
        if n in GRAMS:
            inside = np.flatnonzero(owner[:length] == owner[n - 1 :])
            buckets.append(mixed(rolled[inside] + np.uint64(n)) % np.uint64(BUCKETS))
            owners.append(owner[inside])
    # The whole word has a bucket of its own too.
    whole = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in marked], np.uint64)
    buckets.append(mixed(whole) % np.uint64(BUCKETS))
    owners.append(np.arange(len(words)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(buckets)[order].astype(np.int64), np.bincount(owner, minlength=len(words))


@dataclass
class Model:
    """One number for each bucket, and the bias; what embeddings and softmax come to."""

    weights: np.ndarray
    bias: float

    def score(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logit + self.bias, -30, 30)))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> Model:
    """Fits embeddings and softmax to bags of (bucket, count), all of them in each step; empties `bags`.

    Steps have momentum and one length for the whole of each table: with a length for each bucket,
    buckets of single texts would learn those texts by heart.
    """
    rng = np.random.default_rng(seed)
    totals = np.array([max(c.sum(), 1) for _, c in bags], np.float32)
    seen = np.zeros(BUCKETS, np.int64)
    for buckets, _ in bags:
        seen[buckets] += 1
    common = seen >= MIN_TEXTS
    blocks = []  # row, bucket and share of the entries of some texts each, so that a step's own arrays stay small
    for start in range(0, len(bags), BLOCK_TEXTS):
        some = [(b[common[b]], c[common[b]]) for b, c in bags[start : start + BLOCK_TEXTS]]
        row = np.repeat(np.arange(len(some), dtype=np.int32), [len(b) for b, _ in some])
        share = [c * np.float32(SCALE) / t for (_, c), t in zip(some, totals[start:])]
        blocks.append((row, np.concatenate([b for b, _ in some]).astype(np.int32), np.concatenate(share).astype(np.float32)))
    bags.clear()
    sizes = [min(BLOCK_TEXTS, len(labels) - start) for start in range(0, len(labels), BLOCK_TEXTS)]
    table_ = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    softmax = rng.normal(0, 0.5, (2, DIMENSIONS))
    rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(rate / (1 - rate)))
    moments = [np.zeros_like(table_), np.zeros_like(softmax)]
    lengths = [0.0, 0.0]
    for step in range(1, steps + 1):
        direction = softmax[1] - softmax[0]
        along = (table_ @ direction).astype(np.float32)
        logit = np.concatenate([np.bincount(r, s * along[b], n) for (r, b, s), n in zip(blocks, sizes)]) + bias
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels
        pulled, start = np.zeros(BUCKETS), 0
        for (r, b, s), n in zip(blocks, sizes):
            pulled += np.bincount(b, s * error[start : start + n].astype(np.float32)[r], BUCKETS) / len(labels)
            start += n
        toward = pulled @ table_
        gradients = np.outer(pulled, direction) + DECAY * table_, np.stack([-toward, toward]) + DECAY * softmax
        for i, (values, gradient, rate) in enumerate(zip((table_, softmax), gradients, (1.0, 0.3))):
            lengths[i] = 0.99 * lengths[i] + 0.01 * (gradient**2).sum()
            moments[i] = 0.9 * moments[i] + 0.1 * gradient
            values -= rate * moments[i] / np.sqrt(lengths[i] / (1 - 0.99**step) + 1e-30)
        bias -= 0.1 * error.mean() / (np.abs(error).mean() + 1e-9)
    weights = SCALE * (table_ @ (softmax[1] - softmax[0]))
    return Model(np.where(common, weights, 0.0), bias)


def bag_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    words = [w for w in map(word_in, text.split()) if w]
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    unique, times = np.unique(np.array(words, object), return_counts=True)
    buckets, grams = gram_buckets(unique.tolist())
    counts = np.bincount(buckets, np.repeat(times, grams), BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found].astype(np.int64)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def labelled_bags(docs: DataFrame, labels: DataFrame, sample_rows: int) -> list:
    """(toxic, buckets, counts) of at most `sample_rows` labelled documents outside the held-out fold."""
    usable = labels.where("toxic in (0, 1) and doc_id is not null").where(~is_held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text")  # sample_rows bounds it

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bags = [bag_of(t) for t in texts_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array([b.astype("<i4").tobytes() for b, _ in bags], pa.binary()),
             pa.array([c.astype("<i4").tobytes() for _, c in bags], pa.binary())], ["toxic", "buckets", "counts"])

    rows = map_batches(joined, work, "toxic int, buckets binary, counts binary").collect()
    return sorted((r["toxic"], bytes(r["buckets"]), bytes(r["counts"])) for r in rows)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of the labelled rows outside the held-out fold; without any, it scores every text 0."""
    rows = labelled_bags(docs, labels, sample_rows)
    if not rows:
        return Model(np.zeros(BUCKETS), -30.0)
    labels_ = np.array([r[0] for r in rows], float)
    bags = [(np.frombuffer(b, "<i4"), np.frombuffer(c, "<i4")) for _, b, c in rows]
    rows.clear()
    return train(bags, labels_)


class Scorer:
    """Sums of bucket numbers by word, remembered; real part the sum, imaginary part the n-grams."""

    def __init__(self, model: Model):
        self.model = model
        self.sums: dict[str, complex] = {}

    def score(self, texts: list[str]) -> np.ndarray:
        if len(self.sums) > REMEMBERED:
            self.sums.clear()
        chunks = [t.split() for t in texts]
        unknown: set[str] = set()
        for c in chunks:
            unknown.update(filterfalse(self.sums.__contains__, c))
        names = list(unknown)
        words = [word_in(n) for n in names]
        if names:
            buckets, grams = gram_buckets(words)
            owner = np.repeat(np.arange(len(names)), grams)
            sums = np.bincount(owner, self.model.weights[buckets], len(names))
            full = np.array([bool(w) for w in words])
            self.sums.update(zip(names, (np.where(full, sums, 0) + 1j * np.where(full, grams, 0)).tolist()))
        of = self.sums.__getitem__
        totals = np.array([sum(map(of, c), 0j) for c in chunks], complex)
        return self.model.score(totals.real / np.maximum(totals.imag, 1))


def score_column(text: Column, shared) -> Column:
    def run(batch: pa.Array) -> pa.Array:
        cache = worker_cache("toxicity")
        key = shared.value[0]
        if key not in cache:
            cache.clear()
            cache[key] = Scorer(shared.value[1])
        texts, scores = texts_of(batch), []
        for start in range(0, len(texts), 64):
            scores.append(cache[key].score(texts[start : start + 64]))
        return pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())

    return F.arrow_udf(run, T.DoubleType())(text.cast("string"))


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of `docs` (doc_id, text).

    Null and empty texts get the model's bias as score; labels other than 0 and 1 are not used, and of
    contradicting ones the larger counts; repeated rows stay; an empty table gives no rows; other
    columns are no inputs.
    """
    import uuid

    model = fit(docs, labels, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, model))  # one number for each bucket
    scored = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), score_column(F.col("text"), shared).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
