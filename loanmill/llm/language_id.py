"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are reduced to their letters, in lower case, with one space between words. Document frequencies of n-grams are counted over
all learning texts. A bounded sample of them trains the model by follow-the-regularised-leader steps (McMahan et al., 2013)
with an elastic-net penalty, which leaves most weights at zero; sampled texts that were not trained on set the temperature of
the probabilities. Scoring sums weights over all n-grams of a text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmill.llm import textbatch as tb
from loanmill.llm.common import fold, in_batches, staged

UNKNOWN = "und"
LENGTHS = (1, 2, 3)
# N-grams are told apart by a hash of so many values.
BUCKETS = 1 << 18
# N-grams of the model: those that most learning texts hold.
FEATURES = 1 << 14
# The model tells at most so many languages apart, the most frequent ones.
LANGUAGES = 256
# The classifier is fitted on at most so many different texts, so many of one language, and a fragment of each.
SAMPLE = 8_000
PER_LANGUAGE = 1_000
# One sampled text of so many sets the temperature instead.
CALIBRATION = 5
FRAGMENT_WORDS = 12
# Code points worked on at once; longer texts are summed up piece by piece.
PIECE = 1 << 18
# A text of fewer n-grams speaks less loudly.
FULL_VOICE = 1_024
LOUDNESS = 32.0
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.2, 1.0, 0.3, 1e-3

_NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """Words of letters in lower case, each followed by a space and the first one led by one; empty without a letter."""
    words = _NO_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {words} " if words else ""


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of every n-gram of normalised texts, piece by piece and in order of text within a piece."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    for first in range(0, len(points), PIECE):
        last = min(first + PIECE, len(points))
        part = points[first : min(last + max(LENGTHS) - 1, len(points))].astype(np.uint64) + np.uint64(1)
        place = np.arange(first, last)
        owner = np.searchsorted(ends, place, "right")
        room = ends[owner] - place
        found, owners = [], []
        for n in LENGTHS:
            inside = np.flatnonzero(room >= n)
            total = np.full(len(inside), n, np.uint64)
            for k in range(n):
                total = total * np.uint64(0x9E3779B97F4A7C15) + part[inside + k]
            found.append((tb.mix(total) & np.uint64(BUCKETS - 1)).astype(np.int64))
            owners.append(owner[inside])
        found, owners = np.concatenate(found), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        yield found[order], owners[order]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch, _ in tb.blocks(batches, "text"):
        yield batch, [letters(t) for t in batch.column("text").to_pylist()]


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(`bucket`, `df`): number of texts that hold an n-gram of the bucket; bucket -1 counts the texts with a letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, last_text, at = np.zeros(BUCKETS, np.int64), np.full(BUCKETS, -1, np.int64), np.empty(BUCKETS, np.int64)
        seen = spoken = 0
        for _, texts in _texts(batches):
            for found, owner in grams(texts):
                edges = np.append(np.flatnonzero(np.append(True, owner[1:] != owner[:-1])), len(owner)) if len(owner) else np.zeros(1, int)
                for a, b in zip(edges[:-1], edges[1:]):
                    mine, text = found[a:b], seen + int(owner[a])
                    order = np.arange(b - a)
                    at[mine] = order
                    mine = mine[at[mine] == order]  # each bucket once
                    mine = mine[last_text[mine] != text]  # and not in an earlier piece of the text
                    last_text[mine] = text
                    df[mine] += 1
            seen += len(texts)
            spoken += sum(map(bool, texts))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1), pa.int32()), pa.array(np.append(df[held], spoken), pa.int64())], ["bucket", "df"])

    counted = in_batches(docs.select(F.col(text_col).alias("text")), count, "bucket int, df bigint")
    return counted.groupBy("bucket").agg(F.sum("df").alias("df"))


@dataclass
class Vocabulary:
    """N-grams of the model: `place` has the row of a bucket, or the number of rows for the others."""

    place: np.ndarray
    idf: np.ndarray

    @classmethod
    def of(cls, frequencies: DataFrame, features: int = FEATURES) -> Vocabulary:
        texts = frequencies.filter("bucket = -1").first()
        best = frequencies.filter("bucket >= 0").orderBy(F.desc("df"), "bucket").limit(features).collect()
        buckets = np.array([r.bucket for r in best], np.int64)
        df = np.array([r.df for r in best], np.float64)
        place = np.full(BUCKETS, len(best), np.int32)
        place[buckets] = np.arange(len(best))
        return cls(place, np.log((1 + (texts.df if texts else 0)) / (1 + df)) + 1)


def _loudness(total: np.ndarray) -> np.ndarray:
    total = np.maximum(total, 1).astype(float)
    return LOUDNESS / np.sqrt(total * np.maximum(total, FULL_VOICE))


def _sampled(learn: DataFrame) -> tuple[DataFrame | None, list[str]]:
    """(`lang`, `key`, `text`) of a sample of the different texts of each language, by a hash of the text; and the languages."""
    hashed = learn.select("lang", "text", F.xxhash64("text", "lang").alias("key"))
    sizes = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("key").alias("texts"))
    largest = sizes.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not largest:
        return None, []
    each = max(1, min(PER_LANGUAGE, SAMPLE // len(largest)))
    whole = 1_000_000
    shares = learn.sparkSession.createDataFrame(
        [(r.lang, min(whole, 2 * each * whole // max(1, r.texts) + 1)) for r in largest], "lang string, share long"
    )
    some = hashed.join(F.broadcast(shares), "lang").filter(F.pmod("key", F.lit(whole)) < F.col("share"))
    once = some.groupBy("lang", "key").agg(F.first("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(whole)), "key"))
    sample = once.withColumn("rank", rank).filter(F.col("rank") <= each).select("lang", "key", "text")
    return staged(sample, "language-sample"), sorted(r.lang for r in largest)


@dataclass
class Examples:
    """Rows of feature counts, `begins[i]:begins[i + 1]` for example i."""

    language: np.ndarray
    begins: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.language)

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.begins[i], self.begins[i + 1])
        return self.places[span], self.values[span]


def fragment(text: str) -> str:
    """A few words of a normalised text, chosen by its checksum, so that short texts are learned too."""
    words = text.split()
    if not words:
        return ""
    h = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    at = h % len(words)
    return f" {' '.join(words[at : at + 1 + (h >> 8) % FRAGMENT_WORDS])} "


def _examples(sample: DataFrame, vocabulary: Vocabulary, languages: list[str]) -> tuple[Examples, Examples]:
    """Weighted features of the sampled texts and of their fragments: those to train on, and those for the temperature."""
    shared = sample.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        size = len(vocabulary.idf)
        for batch, texts in _texts(batches):
            texts += [fragment(t) for t in texts]
            total, held = np.zeros(len(texts), np.int64), []
            for found, owner in grams(texts):
                total += np.bincount(owner, minlength=len(texts))
                held.append(owner * (size + 1) + vocabulary.place[found])
            codes, counts = np.unique(np.concatenate(held) if held else np.zeros(0, np.int64), return_counts=True)
            owner, place = codes // (size + 1), codes % (size + 1)
            known = place < size
            owner, place, counts = owner[known], place[known], counts[known]
            values = counts * vocabulary.idf[place] * _loudness(total)[owner]
            begins = np.searchsorted(owner, np.arange(len(texts) + 1))
            twice = pa.array(np.tile(np.arange(batch.num_rows), 2))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang").take(twice), batch.column("key").take(twice), pa.array(np.repeat([False, True], batch.num_rows)),
                    tb.list_column(place, begins, pa.int32()), tb.list_column(values.astype(np.float32), begins, pa.float32()),
                ],
                ["lang", "key", "short", "places", "data"],
            )

    schema = "lang string, key bigint, short boolean, places array<int>, data array<float>"
    table = in_batches(sample.select("lang", "key", "text"), rows, schema).toArrow().sort_by([("key", "ascending"), ("lang", "ascending"), ("short", "ascending")])
    table = table.filter(pc.greater(pc.list_value_length(table["places"]), 0))
    aside = np.array([k % CALIBRATION == 0 for k in table["key"].to_pylist()], bool)
    both = []
    for chosen in (~aside, aside):
        part = table.filter(pa.array(chosen)).combine_chunks()
        sizes = pc.list_value_length(part["places"]).to_numpy()
        both.append(
            Examples(
                np.searchsorted(languages, part["lang"].to_pylist()) if len(part) else np.zeros(0, np.int64), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64),
                pc.list_flatten(part["places"]).to_numpy(), pc.list_flatten(part["data"]).to_numpy().astype(np.float64),
            )
        )
    return both[0], both[1]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader for one weight vector per class; the intercepts are not penalised."""

    def __init__(self, features: int, classes: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))
        self.z0, self.n0 = np.zeros(classes), np.zeros(classes)

    def _weights(self, z: np.ndarray, n: np.ndarray, l1: float, l2: float) -> np.ndarray:
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((self.beta + np.sqrt(n)) / self.alpha + l2)

    def learn(self, places: np.ndarray, values: np.ndarray, language: int) -> None:
        """One step on one example; only the weights of its own features are touched."""
        z, n = self.z[places], self.n[places]
        w, w0 = self._weights(z, n, self.l1, self.l2), self._weights(self.z0, self.n0, 0, 0)
        slope = _softmax(values @ w + w0)
        slope[language] -= 1
        g = values[:, None] * slope
        n_now = n + g * g
        self.z[places] = z + g - (np.sqrt(n_now) - np.sqrt(n)) / self.alpha * w
        self.n[places] = n_now
        n0_now = self.n0 + slope * slope
        self.z0 += slope - (np.sqrt(n0_now) - np.sqrt(self.n0)) / self.alpha * w0
        self.n0 = n0_now

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        return self._weights(self.z, self.n, self.l1, self.l2), self._weights(self.z0, self.n0, 0, 0)


def temperature(logits: np.ndarray, language: np.ndarray) -> float:
    """The divisor of the logits under which the languages are likeliest, by golden-section search of its logarithm."""
    if not len(logits):
        return 1.0

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), language]).mean())

    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    place: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1, 0), np.float32))  # a last row of zeros stands for unknown n-grams
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    temperature: float = 1.0

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """Calibrated probabilities of the languages for normalised texts."""
        width = max(1, len(self.languages))
        sums, total = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        step = max(1, (1 << 22) // width)
        for found, owner in grams(texts):
            total += np.bincount(owner, minlength=len(texts))
            rows = self.place[found]
            known = rows < len(self.weights) - 1
            rows, owner = rows[known], owner[known]
            for a in range(0, len(rows), step):
                part = owner[a : a + step]
                edges = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                sums[part[edges]] += np.add.reduceat(self.weights[rows[a : a + step]], edges, axis=0, dtype=np.float64)
        return _softmax((sums * _loudness(total)[:, None] + self.bias) / self.temperature)


def fit(learn: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of all rows of `learn` that have a text and a language. Without any, it knows no language."""
    learn = learn.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    sample, languages = _sampled(learn)
    if not languages:
        return Model()
    vocabulary = Vocabulary.of(staged(document_frequencies(learn), "document-frequencies"))
    train, aside = _examples(sample, vocabulary, languages)
    learner = Ftrl(len(vocabulary.idf), len(languages))
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(train)):
            learner.learn(*train.row(i), train.language[i])
    weights, bias = learner.weights()
    logits = np.array([aside.row(i)[1] @ weights[aside.row(i)[0]] + bias for i in range(len(aside))]).reshape(len(aside), len(languages))
    # Only n-grams with a weight travel to the texts; their weights carry the inverse document frequency.
    used = np.flatnonzero(weights.any(axis=1))
    renamed = np.full(len(weights) + 1, len(used), np.int32)
    renamed[used] = np.arange(len(used))
    table = np.zeros((len(used) + 1, len(languages)), np.float32)
    table[:-1] = weights[used] * vocabulary.idf[used, None]
    return Model(languages, renamed[vocabulary.place], table, bias, temperature(logits, aside.language))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(`id_col`, `lang_pred`, `score`) per row: the likeliest language, the first by name of those that tie, and its probability.

    A text that is NULL or has no letter, and every text where no language was learned, has `und` and 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = pa.array([*model.languages, UNKNOWN], pa.string())
        for batch, texts in _texts(batches):
            spoken = np.array([bool(t) for t in texts]) & bool(model.languages)
            best, score = np.full(len(texts), len(model.languages)), np.zeros(len(texts))
            if model.languages:
                p = model.probabilities(texts)
                best = np.where(spoken, p.argmax(axis=1), best)
                score = np.where(spoken, p.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), names.take(pa.array(best)), pa.array(np.clip(score, 0, 1))], ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return in_batches(narrow, rows, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def op13_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those of the folds other than 2 of 4.

    Rows are predicted one by one, so repeated rows and repeated or NULL ids get a row each (a NULL id counts as empty text
    in the fold); rows without a language teach nothing; columns other than id, text and language are not read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.filter(fold("doc_id", 4) != 2))
    return predict(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
