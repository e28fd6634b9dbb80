"""Text encoding and exact inner-product search."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmill.session import scratch_path
from loanmill.sources import files

# Questions travel to the chunks in blocks of at most so many bytes.
QUESTION_BYTES = 32 << 20
# A task scores at most so many questions against so many chunks at once, whatever the sizes of block and batch.
TILE_QUESTIONS, TILE_CHUNKS = 256, 10_000
# Scores are compared after rounding here, so the order of additions cannot change a ranking.
SCORE_DIGITS = 9
NO_WORD = r"[^\p{L}\p{N}_]+"
FEATURES = 512
# A task turns so many texts into vectors at once.
ENCODED_ROWS = 10_000


def _words(text: Column) -> Column:
    """Lower-cased words of a text with blanks between them."""
    return F.regexp_replace(F.lower(text), NO_WORD, " ")


def _digests(words: pa.Array) -> np.ndarray:
    """First 32 bits of the MD5 of each word."""
    _, offsets, data = words.cast(pa.large_binary()).buffers()
    begins = np.frombuffer(offsets, np.int64)[: len(words) + 1].tolist()
    whole = data.to_pybytes() if data else b""
    first = b"".join([hashlib.md5(whole[a:b], usedforsecurity=False).digest()[:4] for a, b in zip(begins, begins[1:])])
    return np.frombuffer(first, ">u4").astype(np.int64)


def _counted(words: pa.Array, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of every bucket that a text's words fall into, in this order. A word's bucket is its digest modulo `features`,
    worked out once per different word of a batch."""
    split = pc.split_pattern(words, " ")
    rows = np.repeat(np.arange(len(words)), pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False))
    coded = split.flatten().dictionary_encode()
    empty = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    bucket = np.where(empty, -1, _digests(coded.dictionary) % features)[coded.indices.to_numpy(zero_copy_only=False)]
    real = bucket >= 0
    cells, counts = np.unique(rows[real] * features + bucket[real], return_counts=True)
    return cells // features, cells % features, counts


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ENCODED_ROWS):
            yield batch.slice(at, ENCODED_ROWS)


@dataclass(frozen=True)
class WordEncoder:
    """Hashed word counts, weighted by one plus the inverse document frequency, of unit length. `weights` has one entry per
    bucket. Spark cuts texts into words; tasks count them in batches, so the work is in proportion to the words."""

    weights: tuple[float, ...]

    def vectors(self, words: pa.Array) -> pa.Array:
        """Float array with an entry per bucket for each text; all zero for a text without words, NULL for no text."""
        features = len(self.weights)
        row, bucket, counts = _counted(words, features)
        values = counts * np.array(self.weights)[bucket]
        norm = np.sqrt(np.bincount(row, values * values, len(words)))
        dense = np.zeros((len(words), features), np.float32)
        dense[row, bucket] = values / norm[row]
        begins = pa.array(np.arange(len(words) + 1, dtype=np.int32) * features)
        return pa.ListArray.from_arrays(begins, pa.array(dense.ravel()), mask=words.is_null())

    def embed(self, df: DataFrame, text_col: str) -> DataFrame:
        held = df.drop("embedding")
        names = held.columns
        schema = T.StructType([*held.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], self.vectors(batch.columns[-1])], [*names, "embedding"])

        return df.select(*[held[c] for c in names], _words(F.col(text_col)).alias("_words")).mapInArrow(encode, schema)


def fit_encoder(df: DataFrame, text_col: str = "text", features: int = FEATURES) -> WordEncoder:
    """Default encoder: the weight of each bucket from the number of texts that hold it, over all texts."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(features + 1, np.int64)
        for batch in _slices(batches):
            seen[:-1] += np.bincount(_counted(batch.column(0), features)[1], minlength=features)
            seen[-1] += batch.num_rows
        yield pa.RecordBatch.from_pydict({"bucket": pa.array([*range(features), -1], pa.int32()), "n": pa.array(seen)})

    texts_held = df.filter(F.col(text_col).isNotNull()).select(_words(F.col(text_col)).alias("_words")).mapInArrow(held, "bucket int, n bigint")
    counts = texts_held.groupBy("bucket").agg(F.sum("n").alias("n"))
    seen = {r["bucket"]: r["n"] for r in counts.collect()}  # a row per bucket, and the number of texts
    texts = seen.get(-1, 0)
    return WordEncoder(tuple(round(math.log((1 + texts) / (1 + seen.get(b, 0))) + 1, 6) for b in range(features)))


def embed(df: DataFrame, encoder, text_col: str = "text") -> DataFrame:
    """Add `embedding`, a float array of unit length.

    `encoder` is fitted as above or any function DataFrame -> DataFrame that adds the column, such as a
    `mapInPandas` around a sentence model.
    """
    return encoder.embed(df, text_col) if isinstance(encoder, WordEncoder) else encoder(df)


def write_index(df: DataFrame, path: str) -> None:
    """Chunks with their vectors in the same row: nothing to keep in step."""
    df.write.mode("overwrite").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    if not files.exists(spark, path):
        raise FileNotFoundError(f"no index at {path}; build it first")
    return spark.read.parquet(path)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


class _Best:
    """The k highest-scoring chunks per question so far, ties by chunk id, as flat parallel arrays."""

    def __init__(self, k: int):
        self.k = k
        self.rows = self.ids = self.scores = None
        self.floor = None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take in a questions x chunks matrix of exact scores. Only cells that may reach their row's k-th best score are
        rounded and sorted; ties with it stay in until ids decide."""
        if self.floor is None and scores.shape[1] > self.k:
            least = np.partition(scores, -self.k, axis=1)[:, -self.k]
        else:
            least = self.floor
        if least is None:
            rows, cols = np.nonzero(np.ones_like(scores, dtype=bool))
        else:
            # Cells that rounding may lift to the k-th best score are let in.
            slack = 2 * 10.0**-SCORE_DIGITS + 1e-14 * np.where(np.isfinite(least), np.abs(least), 0)
            rows, cols = np.nonzero(scores >= (least - slack)[:, None])
        if not len(rows):
            return
        found = rows, ids[cols], np.round(scores[rows, cols], SCORE_DIGITS)
        if self.rows is not None:
            held = self.rows, self.ids, self.scores
            found = tuple(np.concatenate(pair) for pair in zip(held, found))
        rows, ids, values = found
        order = np.lexsort((ids, -values, rows))
        rows, ids, values = rows[order], ids[order], values[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        keep = place < self.k
        self.rows, self.ids, self.scores = rows[keep], ids[keep], values[keep]
        if np.count_nonzero(place == self.k - 1) == len(scores):
            self.floor = values[place == self.k - 1]

    def batch(self, names: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "question_id": [names[r] for r in self.rows], "chunk_id": self.ids.tolist(), "score": self.scores
        })


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("question_id").orderBy(F.col("score").desc(), "chunk_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _blocks(questions: DataFrame, block_bytes: int) -> list[list[str]]:
    """Written questions as groups of files, each group within `block_bytes` of vectors."""
    spark, path = questions.sparkSession, scratch_path(questions.sparkSession, "questions")
    width = questions.select(F.size("embedding").alias("d")).agg(F.max("d")).first()[0]
    if width is None:
        return []
    rows = max(1, block_bytes // (8 * max(1, width)))
    questions.write.option("maxRecordsPerFile", rows).parquet(path)
    sizes = spark.read.schema(questions.schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    out, filled = [], rows
    for r in sizes.orderBy("file").collect():
        if filled + r["n"] > rows:
            out.append([])
            filled = 0
        out[-1].append(r["file"])
        filled += r["n"]
    return out


def top_k(questions: DataFrame, chunks: DataFrame, k: int, block_bytes: int = QUESTION_BYTES) -> DataFrame:
    """(`question_id`, `chunk_id`, `score`, `rank`): the k chunks of highest inner product per question, ties by chunk id.

    Inputs are (`question_id`, distinct, `embedding`) and (`chunk_id`, `embedding`). Chunks stay where they are, at any number of
    questions: blocks of questions, bounded in bytes, travel to them. A pass over the chunks serves as many blocks as `QUESTION_BYTES`
    hold, so small blocks cost no pass each. Pairs are scored as matrix products of bounded size, and a task keeps and hands on no more
    than its k best per question.
    """
    spark = questions.sparkSession
    questions = questions.filter(F.col("embedding").isNotNull()).select("question_id", "embedding")
    chunks = chunks.filter(F.col("embedding").isNotNull()).select("chunk_id", "embedding")
    schema = T.StructType([
        T.StructField("question_id", questions.schema["question_id"].dataType),
        T.StructField("chunk_id", chunks.schema["chunk_id"].dataType), T.StructField("score", T.DoubleType()),
    ])
    blocks = _blocks(questions, block_bytes)
    if not blocks:
        return _ranked(spark.createDataFrame([], schema), k)
    parts, passes = [], _passes(blocks, block_bytes)
    for some in passes:
        found, shared = _search(_read_blocks(spark, questions.schema, some), chunks, k, schema)
        if len(passes) == 1:
            return _ranked(found, k)
        path = scratch_path(spark, "nearest")
        found.write.parquet(path)
        shared.destroy()
        parts.append(path)
    return _ranked(spark.read.schema(schema).parquet(*parts), k)


def _passes(blocks: list[list[str]], block_bytes: int) -> list[list[list[str]]]:
    """Blocks that one pass over the chunks serves: as many as QUESTION_BYTES hold, one at least."""
    held = max(1, QUESTION_BYTES // max(1, block_bytes))
    return [blocks[at : at + held] for at in range(0, len(blocks), held)]


def _read_blocks(spark: SparkSession, schema: T.StructType, blocks: list[list[str]]) -> list[pa.Table]:
    """The questions of each block, all from one read."""
    paths = [file for block in blocks for file in block]
    rows = spark.read.schema(schema).parquet(*paths).select(*schema.names, F.col("_metadata.file_path").alias("_file")).toArrow()
    number = {file: n for n, block in enumerate(blocks) for file in block}
    of = np.array([number[file] for file in rows["_file"].to_pylist()])
    return [rows.filter(pa.array(of == n)).select(schema.names) for n in range(len(blocks))]


def _block_search(block: pa.Table, chunks: DataFrame, k: int, schema: T.StructType):
    """(best of each task for one block of questions, the broadcast block)."""
    return _search([block], chunks, k, schema)


def _search(blocks: list[pa.Table], chunks: DataFrame, k: int, schema: T.StructType):
    """(best of each task for the questions of all `blocks`, which it scores one after the other; the broadcast blocks)."""
    # Names and vectors of the first block, of the second, and so on.
    flat = [part for b in blocks for part in (b["question_id"].to_pylist(), _matrix(b["embedding"]))]
    shared = chunks.sparkSession.sparkContext.broadcast(tuple(flat))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = [
            (names[at : at + TILE_QUESTIONS], wanted[at : at + TILE_QUESTIONS], _Best(k))
            for names, wanted in zip(shared.value[::2], shared.value[1::2]) for at in range(0, len(names), TILE_QUESTIONS)
        ]
        for batch in batches:
            for part in (batch.slice(at, TILE_CHUNKS) for at in range(0, batch.num_rows, TILE_CHUNKS)):
                vectors, ids = _matrix(part.column("embedding")), np.array(part.column("chunk_id").to_pylist())
                for _, wanted, best in tiles:
                    best.add(wanted @ vectors.T, ids)
        for names, _, best in tiles:
            if best.rows is not None:
                yield best.batch(names)

    return chunks.mapInArrow(search, schema), shared
