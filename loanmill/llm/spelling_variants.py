"""Spelling variants: words of the corpus that are one edit apart, and the frequent form that a rare one stands for.

Two words one edit apart, the shorter of m code points, differ behind their shared prefix of p code points only, so they
also share a suffix of m - 1 - p at least. For an interval [lo, hi) of p they meet in one bucket: by m, their first lo
code points and their last m - hi. Every word enters the buckets of two intervals; a bucket of over `BUCKET` words is dealt
again by the halves of its interval. An interval of one position leaves a middle of one or two code points, so
buckets end at a few thousand words whatever the vocabulary holds, and nothing is capped.

In a bucket the sorted list of middles is searched for all its words at once. The three cells of the edit matrix around
the diagonal are kept per query and range of words that share a prefix (ranges follow from the lengths of adjacent common
prefixes), so a row is computed once for all words below it; a range whose row exceeds one edit is skipped whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.llm.common import staged

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 7
LEAST_COUNT = 2
# A form is at least so many times as frequent as the word it stands for.
FORM_FACTOR = 10
# One word of so many is damaged by the contract of the query.
DAMAGED = 31
# Words of a bucket that are searched together; larger buckets are dealt again.
BUCKET = 1_024
# Words that a task searches in one go, a whole number of buckets.
CHUNK = 8_192
_OVER = 2


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damaged: int | None = None,
               least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(`word`, `n`): the letter runs of all texts with A-Z in lower case, counted before they are shuffled.

    With `damaged`, a run whose h = crc32 of "id:run" is a multiple of it lacks its code point h % length. Words of fewer
    code points than `least_length` or fewer occurrences than `least_count` are left out. A NULL text has no words, a NULL id
    counts as empty text; repeated rows count each.
    """
    runs = F.regexp_extract_all(F.col(text_col), F.lit(RUN.replace("+", f"{{{least_length},}}")), F.lit(0))
    word = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")).select("id", word.alias("word"))
    if damaged:
        words = words.withColumn("h", F.crc32(F.concat_ws(":", "id", "word").cast("binary")))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = words.select(F.when(F.col("h") % damaged == 0, cut).otherwise(F.col("word")).alias("word")).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _halves(lo: Column, hi: Column) -> Column:
    middle = F.floor((lo + hi) / 2).cast("int")
    return F.array(
        F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi"))
    )


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows (`word`, `n`, `m`, `lo`, `hi`) with the bucket's `key` and the `middle` that its words do not share."""
    suffix = F.greatest(F.col("m") - F.col("hi"), F.lit(0))
    end = F.length("word") - suffix
    key = F.concat_ws(
        " ", "m", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")), F.substring("word", end + 1, suffix)
    )
    return rows.withColumns({"key": key, "middle": F.substring("word", F.col("lo") + 1, end - F.col("lo"))})


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(`word`, `near`, `near_n`) for every ordered pair of the vocabulary's words exactly one edit apart.

    `vocabulary` has distinct words (`word`, `n`). A word of one code point or an empty one is paired like any other.
    """
    length = F.length("word")
    both = vocabulary.filter("word IS NOT NULL").select("word", "n", F.explode(F.array(length - 1, length)).alias("m")).filter("m >= 0")
    halves = F.explode(_halves(F.lit(0), F.col("m") + 1)).alias("part")
    open_rows = both.select("word", "n", "m", halves).select("word", "n", "m", "part.lo", "part.hi").filter("lo < hi")
    ready = None
    while True:
        rows = _dealt(open_rows)
        crowded = staged(
            rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.first(F.col("hi") - F.col("lo")).alias("width"))
            .filter((F.col("size") > BUCKET) & (F.col("width") > 1)).select("key"),
            "crowded-buckets",
        )
        done = crowded.isEmpty()
        closed = rows if done else rows.join(crowded, "key", "left_anti")
        closed = closed.select("key", "middle", (F.col("hi") - F.col("lo")).alias("width"), F.length("word").alias("size"), "m", "word", "n")
        ready = closed if ready is None else ready.unionByName(closed)
        if done:
            break
        again = rows.join(crowded, "key", "left_semi").select("word", "n", "m", F.explode(_halves(F.col("lo"), F.col("hi"))).alias("part"))
        open_rows = staged(again.select("word", "n", "m", "part.lo", "part.hi"), "dealt-again")
    ordered = ready.repartition("key").sortWithinPartitions("key", "middle")
    return ordered.mapInArrow(_search, "word string, near string, near_n bigint")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows that come ordered by bucket and middle; a chunk is cut where a bucket ends."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < CHUNK:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        first = _bucket_starts(table)
        yield from _pairs(table.slice(0, first[-1]))
        rest = table.slice(int(first[-1]))
        held, size = rest.to_batches(), rest.num_rows
    if size:
        yield from _pairs(pa.Table.from_batches(held).combine_chunks())


def _bucket_starts(table: pa.Table) -> np.ndarray:
    codes = table["key"].combine_chunks().dictionary_encode().indices.to_numpy()
    return np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))


def _pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    first = _bucket_starts(table)
    ends = np.append(first[1:], table.num_rows)
    # Buckets of one word are left out, the others are taken some at a time.
    several = ends - first > 1
    first, ends = first[several], ends[several]
    filled = np.cumsum(ends - first) if len(first) else np.zeros(0, np.int64)
    at = 0
    while at < len(first):
        last = max(at + 1, int(np.searchsorted(filled, (filled[at - 1] if at else 0) + CHUNK, "right")))
        rows = np.concatenate([np.arange(a, b) for a, b in zip(first[at:last], ends[at:last])])
        part = table.take(pa.array(rows))
        sizes = ends[at:last] - first[at:last]
        begins = np.cumsum(sizes) - sizes
        query, word, shared = one_edit_apart(part["middle"].to_pylist(), begins)
        length, m, width = (part[name].to_numpy() for name in ("size", "m", "width"))
        # Each pair counts in the one bucket of its shorter word and of the interval that its shared prefix lies in.
        fits = (np.minimum(length[query], length[word]) == m[query]) & (shared < width[query])
        query, word = pa.array(query[fits]), pa.array(word[fits])
        if len(query):
            found = pa.table({"word": part["word"].take(query), "near": part["word"].take(word), "near_n": part["n"].take(word)})
            yield from found.combine_chunks().to_batches()
        at = last


def adjacent_prefixes(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Length of the prefix that each word of a sorted list shares with the word before; -1 where a bucket begins."""
    shared = np.zeros(len(starts), np.int64)
    at = np.setdiff1d(np.arange(len(starts)), begins, assume_unique=True)
    depth = 0
    while len(at):
        at = at[(lengths[at] > depth) & (lengths[at - 1] > depth)]
        at = at[codes[starts[at] + depth] == codes[starts[at - 1] + depth]]
        depth += 1
        shared[at] = depth
    shared[begins] = -1
    return shared


def one_edit_apart(words: list[str], begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, word, shared prefix) of every ordered pair of one bucket that is exactly one edit apart.

    `words` holds buckets one after the other, each in code-point order and free of repetitions, beginning at `begins`.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    shared = adjacent_prefixes(codes, starts, lengths, begins)
    padded = np.append(codes, -2)

    def letter(query: np.ndarray, place: int) -> np.ndarray:
        inside = (place >= 0) & (lengths[query] > place)
        return np.where(inside, padded[np.where(inside, starts[query] + place, len(codes))], -1)

    sizes = np.diff(np.append(begins, len(words)))
    query = np.arange(len(words))
    a, b = np.repeat(begins, sizes), np.repeat(begins + sizes, sizes)
    # Cells (depth, depth - 1), (depth, depth) and (depth, depth + 1) of the matrix of word prefix against query prefix.
    low = np.full(len(words), _OVER)
    mid = np.zeros(len(words), np.int64)
    high = np.where(lengths > 0, 1, _OVER)
    alive = np.arange(len(words))
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    depth = 0
    while len(query):
        ended = np.flatnonzero(lengths[a] == depth)
        if len(ended):  # the word that a range begins with is the only one that can end here
            gap = lengths[query[ended]] - depth
            edits = np.choose(np.clip(gap + 1, 0, 2), [low[ended], mid[ended], high[ended]])
            hit = ended[(np.abs(gap) <= 1) & (edits == 1)]
            hits.append((query[hit], a[hit]))
            a[ended] += 1
        alive = alive[lengths[alive] > depth]
        heads = alive[shared[alive] <= depth]
        from_head, to_head = np.searchsorted(heads, a), np.searchsorted(heads, b)
        count = np.maximum(to_head - from_head, 0)
        parent = np.repeat(np.arange(len(query)), count)
        head = np.arange(len(parent)) - np.repeat(np.cumsum(count) - count - from_head, count)
        query, b = query[parent], np.minimum(np.append(heads, len(words))[head + 1], b[parent])
        a = heads[head]
        low, mid, high = low[parent], mid[parent], high[parent]
        char, size = codes[starts[a] + depth], lengths[query]
        low = np.minimum(low + (char != letter(query, depth - 1)), mid + 1)
        mid = np.minimum(np.minimum(mid + (char != letter(query, depth)), high + 1), low + 1)
        high = np.minimum(high + (char != letter(query, depth + 1)), mid + 1)
        depth += 1
        low, mid, high = (np.where(size >= depth + k, cell, _OVER) for k, cell in ((-1, low), (0, mid), (1, high)))
        keep = np.flatnonzero(np.minimum(np.minimum(low, mid), high) < _OVER)
        query, a, b, low, mid, high = query[keep], a[keep], b[keep], low[keep], mid[keep], high[keep]
    found = [np.concatenate(part) for part in zip(*hits)] if hits else [np.zeros(0, np.int64)] * 2
    return found[0], found[1], _shared(codes, starts, lengths, *found)


def _shared(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Length of the prefix that the words of each pair share."""
    out = np.zeros(len(one), np.int64)
    at, depth = np.arange(len(one)), 0
    while len(at):
        at = at[(lengths[one[at]] > depth) & (lengths[other[at]] > depth)]
        at = at[codes[starts[one[at]] + depth] == codes[starts[other[at]] + depth]]
        depth += 1
        out[at] = depth
    return out


def _roots(forms: DataFrame) -> DataFrame:
    """(`word`, `root`) of the words that have a form. A form is ten times as frequent as its word, so
    chains are short, and each round halves them."""
    links = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        joined = staged(links.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "roots")
        links = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            return links


def variants(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """(`word`, `form`, `root`, `n`, `n_near`, `form_n`) of every word of a vocabulary (`word`, `n`).

    The form is the near word of largest count, the smallest in code-point order where counts tie, if its count is at least
    `factor` times the word's. The root is the last of the forms that follow each other, or the word itself.
    """
    words = staged(words, "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("near")))
    stats = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = -F.col("best.minus_n") >= factor * F.col("n")
    formed = staged(
        words.join(stats, "word", "left").select(
            "word", F.when(fits, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, -F.col("best.minus_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Words of all documents of at least seven code points and two occurrences, with their variants.

    Empty tables and texts give no words; long texts and long words are taken whole; other columns are not read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return variants(vocabulary(docs, damaged=DAMAGED))
