"""Benchmark items inside documents, by size-partitioned MinHash containment search with exact verification.

A long document's MinHash hardly agrees with that of a short item inside it, so the sketches are kept on the item side and are sized so
that nothing is lost: if a document holds at least `share` of an item's q shingles, it holds at least one of the
q - ceil(share * q) + 1 shingles of smallest hash (its bottom sketch). Items are partitioned by size; within a partition the largest
sketch hash bounds what part of a document's shingles has to be looked up at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill.llm import textbatch as tb
from loanmill.llm.common import in_batches, row_key, staged

WORDS_IN_SHINGLE = 5
SHARE = 0.8
# Text of the items that travel to all tasks at once; more items are searched in further passes over the documents.
ITEM_BLOCK_BYTES = 4 << 20


@dataclass
class Partition:
    """Sketches of the items of one size class: sorted hashes, and the item of each."""

    hashes: np.ndarray
    items: np.ndarray


@dataclass
class ItemIndex:
    ids: list
    shingles: list[list[bytes]]
    partitions: list[Partition]


def _words(texts: tb.Texts):
    starts, ends, first = texts.runs(tb.ALPHANUMERIC)
    return starts, ends, first, tb.ngrams(tb.span_hashes(texts.data, starts, ends, tb.LOWER), first, WORDS_IN_SHINGLE, short=False)


def _spelled(texts: tb.Texts, text: int, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[bytes]:
    """The shingles of one text as bytes, in order."""
    mine = range(first[text], first[text + 1])
    words = [tb.LOWER[texts.data[starts[k] : ends[k]]].tobytes() for k in mine]
    return [b" ".join(words[k : k + WORDS_IN_SHINGLE]) for k in range(len(words) - WORDS_IN_SHINGLE + 1)]


def needed(q: int, share: float = SHARE) -> int:
    """Least number of shared shingles; the share is compared in whole thousandths."""
    return -(-q * round(share * 1000) // 1000)


def build_index(items: pa.Table, share: float) -> ItemIndex:
    ids, shingles, sketches = [], [], {}
    for batch in items.to_batches():
        for part, texts in tb.blocks([batch], "text"):
            starts, ends, first, (hashes, begins) = _words(texts)
            for row, item_id in enumerate(part.column("item").to_pylist()):
                own = np.unique(hashes[begins[row] : begins[row + 1]])
                if not len(own):
                    continue
                sketch = own[: len(own) - needed(len(own), share) + 1]
                sketches.setdefault(int(math.log2(len(own))), []).append((sketch, len(ids)))
                ids.append(item_id)
                shingles.append(sorted(set(_spelled(texts, row, starts, ends, first))))
    partitions = []
    for size in sorted(sketches):
        hashes = np.concatenate([s for s, _ in sketches[size]])
        owners = np.concatenate([np.full(len(s), k) for s, k in sketches[size]])
        order = np.argsort(hashes, kind="stable")
        partitions.append(Partition(hashes[order], owners[order]))
    return ItemIndex(ids, shingles, partitions)


def _candidates(index: ItemIndex, hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Distinct (text, item) whose text has a sketch hash of the item."""
    found = [np.zeros((0, 2), np.int64)]
    for part in index.partitions:
        low = np.flatnonzero(hashes <= part.hashes[-1])
        values = hashes[low]
        a, b = np.searchsorted(part.hashes, values, "left"), np.searchsorted(part.hashes, values, "right")
        hit = np.flatnonzero(b > a)
        many = b[hit] - a[hit]
        at = np.arange(many.sum()) + np.repeat(a[hit] - np.cumsum(many) + many, many)
        text = np.searchsorted(begins, low[hit], "right") - 1
        found.append(np.stack([np.repeat(text, many), part.items[at]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def search(docs: DataFrame, items: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", share: float = SHARE) -> DataFrame:
    """(`_row`, `doc`, `item`, `n_item_shingles`, `n_shared`): each item of which a document row holds at least `share` of the
    distinct five-word shingles. `_row` is `common.row_key` of the document.

    Words are runs of letters, digits and non-ASCII characters, with A-Z lowered. Item blocks of bounded size travel to all
    tasks; documents are not moved, and a candidate is verified beside its text.

    Defined cases: NULL, empty and shorter than five words, on either side, have no shingles and match nothing; repeated rows
    of either table match each by itself; NULL ids are carried along; other columns are not read.
    """
    kinds = docs.schema[doc_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    narrow_items = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    total = narrow_items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / ITEM_BLOCK_BYTES))
    narrow = docs.select(row_key(doc_col, F.col(text_col)).alias("_row"), F.col(doc_col).alias("doc"), F.col(text_col).alias("text"))
    result = None
    for block in range(count):
        table = narrow_items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block).toArrow()
        shared = docs.sparkSession.sparkContext.broadcast(build_index(table, share))

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch, texts in tb.blocks(batches, "text"):
                starts, ends, first, (hashes, begins) = _words(texts)
                rows, found, sizes, common = [], [], [], []
                spelled, last = frozenset(), -1
                for text, item in _candidates(index, hashes, begins):
                    if text != last:
                        spelled, last = frozenset(_spelled(texts, text, starts, ends, first)), text
                    n = sum(s in spelled for s in index.shingles[item])
                    if n >= needed(len(index.shingles[item]), share):
                        rows.append(text), found.append(index.ids[item]), sizes.append(len(index.shingles[item])), common.append(n)
                if rows:
                    picked = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [picked.column("_row"), picked.column("doc"), pa.array(found, table.schema.field("item").type),
                         pa.array(sizes, pa.int64()), pa.array(common, pa.int64())],
                        ["_row", "doc", "item", "n_item_shingles", "n_shared"],
                    )

        part = in_batches(narrow, find, f"_row string, doc {kinds[0]}, item {kinds[1]}, n_item_shingles bigint, n_shared bigint")
        result = part if result is None else result.unionAll(part)
    return result


def without_benchmarks(docs: DataFrame, items: DataFrame, doc_col: str = "doc_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """`docs` less the rows that hold an item; all columns stay."""
    found = staged(search(docs, items, doc_col, text_col, share=share).select("_row").distinct(), "contaminated")
    key = row_key(doc_col, F.col(text_col))
    return docs.join(found, key == found["_row"], "left_anti")


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """All (document, benchmark item) with the item inside the document."""
    found = search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "n_item_shingles", "n_shared",
        (F.col("n_shared") / F.col("n_item_shingles")).alias("containment"),
    )
