"""Toxicity scores by non-negative positive-unlabelled learning (Kiryo et al., 2017).

Confirmed toxic texts and a sample of all texts, without labels, train a linear model of words and word beginnings in numpy. The
risk of calling unlabelled text clean is corrected by the class prior for the toxic texts it holds, and kept from going
below zero, which is where a plain corrected risk overfits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill.llm import textbatch as tb
from loanmill.llm.common import fold, in_batches, staged

# The classifier is fitted on samples of at most so many confirmed toxic and so many unlabelled texts.
POSITIVES = 4_000
UNLABELLED = 12_000
# Features that the model keeps: those that tell both samples apart best.
FEATURES = 1_024
# Bytes of a word's beginning that are features beside the whole word.
BEGINNINGS = (5, 6, 7, 8)
LEAST_TEXTS = 3
STEPS = 500
DECAY = 2e-4


@dataclass
class Linear:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float


def _features(texts: tb.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(feature hashes, text of each): every word, and its beginnings where it is longer than them."""
    starts, ends, first = texts.runs(tb.ALPHANUMERIC)
    owner = np.repeat(np.arange(texts.count), np.diff(first))
    found, owners = [tb.span_hashes(texts.data, starts, ends, tb.LOWER)], [owner]
    for size in BEGINNINGS:
        long = np.flatnonzero(ends - starts > size)
        found.append(tb.mix(tb.span_hashes(texts.data, starts[long], starts[long] + size, tb.LOWER) + np.uint64(size)))
        owners.append(owner[long])
    return np.concatenate(found).view(np.int64), np.concatenate(owners)


def _present(texts: tb.Texts, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, place of the feature) of the kept features, in order of text."""
    found, owner = _features(texts)
    if not len(features):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(features, found), len(features) - 1)
    hit = features[at] == found
    pairs = np.unique(owner[hit] * len(features) + at[hit])
    return pairs // len(features), pairs % len(features)


def _frequencies(sample: DataFrame) -> DataFrame:
    """(`code`, `p`, `u`): number of toxic and of unlabelled texts with each feature."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in tb.blocks(batches, "text"):
            found, owner = _features(texts)
            order = np.lexsort((owner, found))
            found, owner = found[order], owner[order]
            fresh = np.ones(len(found), bool)
            fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
            found, owner = found[fresh], owner[fresh]
            codes, begin = np.unique(found, return_index=True)
            toxic = np.array(batch.column("positive").to_pylist(), bool)[owner].astype(np.int64)
            p = np.add.reduceat(toxic, begin) if len(begin) else np.zeros(0, np.int64)
            n = np.diff(np.append(begin, len(found)))
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(p, pa.int64()), pa.array(n - p, pa.int64())], ["code", "p", "u"])

    counted = in_batches(sample.select("positive", "text"), count, "code bigint, p bigint, u bigint")
    return counted.groupBy("code").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def _rows(sample: DataFrame, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(0/1 matrix of the sampled texts by feature, which of them are toxic)."""
    shared = sample.sparkSession.sparkContext.broadcast(features)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in tb.blocks(batches, "text"):
            text, place = _present(texts, shared.value)
            begins = np.searchsorted(text, np.arange(texts.count + 1))
            yield pa.RecordBatch.from_arrays([batch.column("positive"), tb.list_column(place, begins, pa.int32())], ["positive", "places"])

    table = in_batches(sample.select("positive", "text"), collect, "positive boolean, places array<int>").toArrow()
    matrix = np.zeros((table.num_rows, len(features)), np.float32)
    for row, places in enumerate(table["places"].to_pylist()):
        matrix[row, places] = 1.0
    return matrix, table["positive"].to_numpy().astype(bool)


def nn_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias that lower the non-negative risk of the logistic loss, by accelerated gradient steps on whole samples.

    risk = prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)). Where the second part is negative, its gradient is reversed.
    Steps are as long as the curvature allows, so features that only chance tells apart stay near zero.
    """
    width = positive.shape[1]

    def gradient(x: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.append(slope @ x, slope.sum()) / len(x)

    top = 0.0
    for x in (positive, unlabelled):  # largest eigenvalue of the mean outer product, by power iteration
        v = np.ones(width + 1)
        for _ in range(20):
            v = gradient(x, x @ v[:-1] + v[-1])
            size = float(np.linalg.norm(v))
            v /= max(size, 1e-12)
        top = max(top, size)
    rate = 1 / (0.25 * (1 + 2 * prior) * top + DECAY)
    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    ahead, best, least = theta, theta, np.inf
    for step in range(steps):
        z_p, z_u = (x @ ahead[:-1] + ahead[-1] for x in (positive, unlabelled))
        missed, clean_risk = np.logaddexp(0, -z_p).mean(), np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        risk = prior * missed + max(0.0, clean_risk) + DECAY / 2 * ahead[:-1] @ ahead[:-1]
        if risk < least:
            best, least = ahead, risk
        s_p, s_u = 1 / (1 + np.exp(-z_p)), 1 / (1 + np.exp(-z_u))
        toxic_part = prior * gradient(positive, s_p - 1)
        clean_part = gradient(unlabelled, s_u) - prior * gradient(positive, s_p)
        g = toxic_part + clean_part if clean_risk >= 0 else -clean_part
        g[:-1] += DECAY * ahead[:-1]
        now = ahead - rate * g
        ahead, theta = now + step / (step + 3) * (now - theta), now
    return best[:-1], float(best[-1])


def fit(docs: DataFrame, labels: DataFrame, learn_fold, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
        prior: float | None = None) -> Linear:
    """The model, from labels and texts of the rows for which `learn_fold(id column)` holds.

    Only the labels 1 are used as such; the prior, unless given, is the share of 1 among the labels. Samples are taken by a
    hash of the id. Without any toxic label the model says the same of all texts.
    """
    marked = labels.filter(F.col(toxic_col).isNotNull()).filter(learn_fold(id_col)).groupBy(F.col(id_col).alias("id")).agg(
        F.max(toxic_col).alias("toxic")
    )
    seen = marked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0)).alias("toxic")).first()
    pool = docs.filter(learn_fold(id_col)).select(F.col(id_col).alias("id"))
    total = pool.count()
    prior = min(max(prior if prior is not None else (seen.toxic + 0.5) / (seen.n + 1.0), 1e-4), 0.9)
    if not seen.toxic or not total:
        return Linear(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))

    def sampled(ids: DataFrame, size: int, limit: int) -> DataFrame:
        share = min(1_000_000, 1_000_000 * limit // size)
        place = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000))
        # In order of the hash, so that the same ids are taken however the rows are dealt.
        return ids.filter(place < share).orderBy(place, "id").limit(limit)

    toxic = sampled(marked.filter("toxic = 1").select("id"), seen.toxic, POSITIVES).withColumn("positive", F.lit(True))
    other = sampled(pool.distinct(), total, UNLABELLED).withColumn("positive", F.lit(False))
    chosen = staged(toxic.unionAll(other), "sampled-ids")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id").select("positive", "text")
    sample = staged(texts, "sampled-texts")
    sizes = {r.positive: r.n for r in sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(True) or not sizes.get(False):
        return Linear(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    p, u = (F.col("p") + 0.5) / (sizes[True] + 1.0), (F.col("u") + 0.5) / (sizes[False] + 1.0)
    gain = p * F.log(p / u) + (1 - p) * F.log((1 - p) / (1 - u))
    best = _frequencies(sample).filter(F.col("p") >= LEAST_TEXTS).orderBy(gain.desc(), "code").limit(FEATURES)
    features = np.sort(np.array([r.code for r in best.select("code").collect()], np.int64))
    matrix, positive = _rows(sample, features)
    weights, bias = nn_pu(matrix[positive], matrix[~positive], prior)
    return Linear(features, weights, bias)


def score(docs: DataFrame, model: Linear, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(`id_col`, `score`, `predicted`) per row; a NULL or empty text has the score of a text without known features."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, texts in tb.blocks(batches, "text"):
            text, place = _present(texts, model.features)
            z = np.bincount(text, weights=model.weights[place], minlength=texts.count) + model.bias
            s = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())], ["id", "score", "predicted"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return in_batches(narrow, rows, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from the labels of the folds other than 0.

    Labels that are NULL, repeated (the largest counts), or of unknown documents do no harm; documents are scored one by
    one, so repeated rows and repeated or NULL ids get a row each; other columns are not read.
    """
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    model = fit(docs, labels, lambda c: fold(c) != 0)
    scored = score(docs, model)
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", "predicted")
