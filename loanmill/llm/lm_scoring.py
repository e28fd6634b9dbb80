"""Language-model scores of documents: prediction by partial matching over bytes, and a word unigram baseline.

The model is a byte-context trie of order three with the escape estimate of method C and symbol exclusion
(Cleary and Witten, 1984; Moffat, 1990), pretrained on the learning folds. Spark counts the four-byte sequences; shorter
contexts follow from them. As a symbol that is known after a context is also known after each suffix of it, the symbols to be
excluded after an escape are exactly the children of the context escaped from, so every probability is a table entry and
whole blocks of text are scored by lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill.llm import textbatch as tb
from loanmill.llm.common import fold, in_batches, staged

# Symbols that no UTF-8 text has: before a text, and its end.
START, END = 0xFE, 0xFF
# Trie nodes of the highest order that the model keeps: all that there can be.
TOP_NODES = 1 << 32
# Nodes of the highest order that travel to the tasks, with the most frequent contexts; the contexts of the others are joined.
# Orders up to two travel whole: they have 2**24 nodes at most.
HEAD_NODES = 1 << 20
# Words whose counts travel to the tasks, the most frequent ones; the others are joined.
HEAD_WORDS = 200_000
END_TOKEN = -1
# Distinct sequences or words that a task holds before it hands on their counts.
HELD = 1 << 20


class HashTable:
    """Positions of distinct 32-bit keys, by open addressing, looked up as whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.uint32)
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        waiting, step = np.arange(len(keys), dtype=np.int32), 0
        while len(waiting):
            slot = self._slot(self.keys[waiting], step)
            free = self.slots[slot] < 0
            _, chosen = np.unique(slot[free], return_index=True)
            placed = np.flatnonzero(free)[chosen]
            self.slots[slot[placed]] = waiting[placed]
            waiting = np.delete(waiting, placed)
            step += 1

    def _slot(self, keys: np.ndarray, step: int) -> np.ndarray:
        spread = (keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)
        return (spread.astype(np.int64) + step) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where there is none."""
        out = np.full(len(keys), -1, np.int32)
        open_, step = np.arange(len(keys)), 0
        while len(open_):
            at = self.slots[self._slot(keys[open_], step)]
            some = at >= 0
            open_, at = open_[some], at[some]
            hit = self.keys[at] == keys[open_]
            out[open_[hit]] = at[hit]
            open_ = open_[~hit]
            step += 1
        return out


@dataclass
class Level:
    """One order of the trie, all values log10: of the symbol counts, of the denominators of its contexts when entered
    directly and when entered by an escape from each longer context, and of the escapes."""

    nodes: HashTable
    counts: np.ndarray
    contexts: HashTable
    total: np.ndarray
    escape: np.ndarray
    total_after: np.ndarray | None
    escape_after: np.ndarray | None


def _log(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-300))


def _levels(tables: list[tuple[np.ndarray, np.ndarray]], order: int) -> list[Level]:
    """Levels of the sorted (packed sequence, count) tables, longest sequences, those of the order, first."""
    levels: list[Level] = []
    longer = None
    for codes, counts in tables:
        contexts, of, distinct = np.unique(codes >> 8, return_inverse=True, return_counts=True)
        sums = np.bincount(of, weights=counts, minlength=len(contexts))
        after = escape_after = None
        if longer is not None:
            # For each longer context: the sums and numbers of symbols left when its children are excluded.
            long_codes, long_contexts, long_of = longer
            span = 1 << (8 * (order + 1 - len(levels)))
            suffix = np.searchsorted(codes, long_codes % span)
            gone = np.bincount(long_of, weights=counts[suffix], minlength=len(long_contexts))
            gone_n = np.bincount(long_of, minlength=len(long_contexts))
            mine = np.searchsorted(contexts, long_contexts % (span >> 8))
            left, left_n = sums[mine] - gone, distinct[mine] - gone_n
            after = _log(left + left_n)
            escape_after = np.where(left_n > 0, _log(left_n) - after, 0.0)
        levels.append(Level(
            HashTable(codes), _log(counts), HashTable(contexts), _log(sums + distinct), _log(distinct) - _log(sums + distinct), after, escape_after
        ))
        longer = codes, contexts, of
    return levels


@dataclass
class Ppm:
    """Trie levels from order three down to zero."""

    levels: list[Level]
    known: int
    triples: tuple[np.ndarray, np.ndarray] | None = None

    def with_top(self, top: tuple[np.ndarray, np.ndarray]) -> "Ppm":
        """This model with other sequences of the highest order, given with all that follow the same contexts."""
        high, after = _levels([top, self.triples], 3)
        level = replace(self.levels[1], total_after=after.total_after, escape_after=after.escape_after)
        return Ppm([high, level, *self.levels[2:]], self.known)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each packed four-byte sequence after the first three."""
        out = np.zeros(len(codes))
        rest, codes = np.arange(len(codes)), codes.astype(np.uint32)
        came = np.full(len(codes), -1, np.int32)  # the longer context that each was escaped from
        for order, level in zip((3, 2, 1, 0), self.levels):
            if not len(level.total):
                continue
            mask = np.uint32((1 << (8 * (order + 1))) - 1)
            now = codes[rest] & mask
            node = level.nodes.find(now)
            known = node >= 0
            context = np.where(known, 0, -1).astype(np.int32)
            context[~known] = level.contexts.find(now[~known] >> np.uint32(8))
            context[known] = level.contexts.find(now[known] >> np.uint32(8))
            direct = came < 0
            total = np.where(direct, level.total[context], 0.0)
            escape = np.where(direct, level.escape[context], 0.0)
            if level.total_after is not None and len(level.total_after):
                total = np.where(direct, total, level.total_after[came])
                escape = np.where(direct, escape, level.escape_after[came])
            hit = np.flatnonzero(known)
            out[rest[hit]] += level.counts[node[hit]] - total[hit]
            miss = np.flatnonzero(~known)
            here = context[miss] >= 0
            out[rest[miss[here]]] += escape[miss[here]]
            came = context[miss]
            rest = rest[miss]
        out[rest] -= np.log10(256 - self.known)
        return out


def build_model(top: tuple[np.ndarray, np.ndarray], triples: tuple[np.ndarray, np.ndarray]) -> Ppm:
    """The model of the kept four-byte sequences and all three-byte sequences, as sorted codes and counts."""
    tables = [top, triples]
    for _ in range(2):
        codes, counts = tables[-1]
        span = 1 << (8 * (4 - len(tables)))
        shorter, of = np.unique(codes % span, return_inverse=True)
        tables.append((shorter, np.bincount(of, weights=counts, minlength=len(shorter))))
    return Ppm(_levels(tables, 3), len(tables[3][0]), triples) if len(triples[0]) else Ppm([], 0)


def sequences(texts: tb.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(packed four-byte sequence that ends at each symbol, where each text's begin).

    The symbols of a text are the bytes of its lowered words with one space between them, and an end.
    """
    starts, ends, first = texts.runs(tb.NOT_SPACE)
    keep = tb.NOT_SPACE[texts.data]
    last = np.zeros(len(starts), bool)
    last[first[1:][np.diff(first) > 0] - 1] = True
    keep[ends[~last]] = True
    data = tb.LOWER[texts.data]
    data[~tb.NOT_SPACE[texts.data]] = 32
    sizes = np.diff(np.concatenate([[0], np.cumsum(keep)])[texts.bounds]) + 4
    begins = np.concatenate([[0], np.cumsum(sizes)])
    symbols = np.full(begins[-1], START, np.uint32)
    inside = np.ones(begins[-1], bool)
    for k in range(3):
        inside[begins[:-1] + k] = False
    inside[begins[1:] - 1] = False
    symbols[inside] = data[keep]
    symbols[begins[1:] - 1] = END
    codes = (symbols[:-3] << np.uint32(24)) | (symbols[1:-2] << np.uint32(16)) | (symbols[2:-1] << np.uint32(8)) | symbols[3:]
    real = np.ones(begins[-1], bool)
    for k in range(3):
        real[begins[:-1] + k] = False
    return codes[real[3:]], begins - 3 * np.arange(texts.count + 1)


def count_corpus(docs: DataFrame, text_col: str) -> DataFrame:
    """(`kind`, `code`, `n`): counts of four-byte sequences (kind 0) and of tokens by their hash (kind 1). Tasks add up first."""

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        codes, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return codes, np.bincount(place, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)

    def batch_of(kind: int, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(codes), kind), pa.int32()), pa.array(codes, pa.int64()), pa.array(n, pa.int64())], ["kind", "code", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[], []]
        ends = 0
        for _, texts in tb.blocks(batches, "text"):
            starts, stops, _ = texts.runs(tb.NOT_SPACE)
            words = tb.span_hashes(texts.data, starts, stops, tb.LOWER).view(np.int64)
            ends += texts.count
            for kind, values in enumerate((sequences(texts)[0].astype(np.int64), words)):
                held[kind].append(np.unique(values, return_counts=True))
                if len(held[kind]) == 8:
                    held[kind] = [merged(held[kind])]
                    if len(held[kind][0][0]) > HELD:
                        yield batch_of(kind, *held[kind].pop())
        for kind in (0, 1):
            if held[kind]:
                yield batch_of(kind, *merged(held[kind]))
        if ends:
            yield batch_of(1, np.array([END_TOKEN]), np.array([ends]))

    counted = in_batches(docs.select(F.col(text_col).alias("text")), count, "kind int, code bigint, n bigint")
    return counted.groupBy("kind", "code").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, limit: int, size: str = "1") -> tuple[DataFrame, int]:
    """(rows of at least a least count, that count): the lowest step of a geometric scale that at most `limit` rows reach; a row
    counts as `size` rows."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = sorted(((r.step, r.many) for r in counts.groupBy(step.alias("step")).agg(F.sum(F.expr(size)).alias("many")).collect()), reverse=True)
    lowest, total = 1 << 30, 0
    for at, many in sizes:
        if total + many > limit:
            break
        total, lowest = total + many, at
    return counts.filter(step >= lowest), lowest


def _table(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = counts.select("code", "n").toArrow()
    codes, n = table["code"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(codes)
    return codes[order], n[order]


def _tail_values(wanted: DataFrame, tail: DataFrame, shared) -> DataFrame:
    """(`code`, `value`): log10 probabilities of the wanted four-byte sequences, whose contexts did not travel. Each is
    joined with all that follows its context in the corpus, if it is known there; the lower orders are at hand."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value[0]
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, context = (batch.column(c).to_numpy() for c in ("code", "context"))
            of = {}
            for row, (at, last) in enumerate(zip(context.tolist(), batch.column("last"))):
                if last.is_valid and at not in of:
                    of[at] = row
            held = [(at << 8 | symbol, n) for at, row in of.items() for symbol, n in zip(batch.column("last")[row].as_py(), batch.column("many")[row].as_py())]
            table = np.array(sorted(held), np.int64).reshape(-1, 2)
            found = model.with_top((table[:, 0], table[:, 1])).log10(codes)
            yield pa.RecordBatch.from_arrays([batch.column("code"), pa.array(found, pa.float64())], ["code", "value"])

    context = F.shiftright("code", 8)
    # At most 256 symbols follow a context, so its row is bounded.
    kids = tail.groupBy("context").agg(F.collect_list(F.struct((F.col("code") % 256).alias("last"), "n")).alias("kids"))
    kids = kids.select("context", F.col("kids.last").alias("last"), F.col("kids.n").alias("many"))
    joined = wanted.select("code", context.alias("context")).join(kids, "context", "left")
    return in_batches(joined.select("code", "context", "last", "many"), values, "code bigint, value double")


def score(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Both scores of each row of `docs`; the models learn from the rows where the column `learn` is true.

    Tokens are words, A-Z lowered, and one end per text. `base_score` adds log10((c + 0.5) / (N + 0.5 * (V + 1))) over the
    tokens, with the learning counts c, N and V. `score` is the byte model's log10 probability of the words with one space between
    them, and of the end. Counts of frequent words and contexts travel to the tasks, bounded tables; rare words, and sequences with
    rare contexts, are counted per document and joined.

    Defined cases: a NULL or empty text is its end alone. Rows are scored one by one, so repeated rows and repeated or NULL ids
    get a row each. With nothing to learn from, all bytes are equally likely. Other columns are not read.
    """
    counts = staged(count_corpus(docs.filter(F.coalesce(learn, F.lit(False))), text_col), "corpus-counts")
    words, quads = counts.filter("kind = 1").select("code", "n"), counts.filter("kind = 0").select("code", "n")
    size = words.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    triples = quads.groupBy((F.col("code") % (1 << 24)).alias("code")).agg(F.sum("n").alias("n"))
    top = most_frequent(quads, TOP_NODES)[0].withColumn("context", F.shiftright("code", 8))
    contexts = top.groupBy("context").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("nodes"))
    head, head_step = most_frequent(contexts, HEAD_NODES, "nodes")
    whole = contexts.filter(F.floor(F.log2("n") * 8) < head_step).isEmpty()
    if whole:
        model, tail_nodes = build_model(_table(top), _table(triples)), None
    else:
        model = build_model(_table(top.join(head.select("context"), "context", "left_semi")), _table(triples))
        tail_nodes = top.join(head.select("context"), "context", "left_anti")
    frequent, lowest = most_frequent(words, HEAD_WORDS)
    shared = docs.sparkSession.sparkContext.broadcast((model, *_table(frequent)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, head, head_n = shared.value
        for batch, texts in tb.blocks(batches, "text"):
            codes, begins = sequences(texts)
            symbols = model.log10(codes) if model.levels else np.full(len(codes), -np.log10(256))
            seldom = np.zeros(len(codes), bool) if whole else model.levels[0].contexts.find(codes >> np.uint32(8)) < 0
            symbols[seldom] = 0.0
            scores = np.add.reduceat(symbols, begins[:-1])
            deferred, deferred_begins = codes[seldom].astype(np.int64), np.concatenate([[0], np.cumsum(seldom)])[begins]
            starts, ends, first = texts.runs(tb.NOT_SPACE)
            words = tb.span_hashes(texts.data, starts, ends, tb.LOWER).view(np.int64)
            n_words = np.diff(first)
            distinct, inverse = np.unique(words, return_inverse=True)
            distinct = np.append(distinct, END_TOKEN)
            at = np.minimum(np.searchsorted(head, distinct), max(len(head) - 1, 0))
            known = head[at] == distinct if len(head) else np.zeros(len(distinct), bool)
            value = np.where(known, np.log10((head_n[at] if len(head) else 0) + 0.5), 0.0)
            sums = np.diff(np.concatenate([[0.0], np.cumsum(value[inverse])])[first]) + (value[-1] if known[-1] else 0.0)
            n_known = np.diff(np.concatenate([[0], np.cumsum(known[inverse])])[first]) + int(known[-1])
            rare, rare_begins = words[~known[inverse]], np.concatenate([[0], np.cumsum(~known[inverse])])[first]
            if not known[-1]:  # the end of a text is then a rare token too
                rare = np.insert(rare, rare_begins[1:], END_TOKEN)
                rare_begins = rare_begins + np.arange(texts.count + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(n_words + 1, pa.int64()), pa.array(n_known, pa.int64()),
                 pa.array(sums, pa.float64()), pa.array(scores, pa.float64()), tb.list_column(rare, rare_begins, pa.int64()),
                 tb.list_column(deferred, deferred_begins, pa.int64())],
                ["id", "held_out", "n_tokens", "n_head", "head_sum", "score", "rare", "deferred"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), (~F.coalesce(learn, F.lit(False))).alias("held_out"), F.col(text_col).alias("text"))
    scored = staged(
        in_batches(narrow, rows, f"id {kind}, held_out boolean, n_tokens bigint, n_head bigint, head_sum double, score double, rare array<bigint>, deferred array<bigint>")
        .withColumn("row", F.monotonically_increasing_id()), "scored",
    )
    rare = scored.select("row", F.explode("rare").alias("code")).groupBy("row", "code").agg(F.count(F.lit(1)).alias("tf"))
    tail = words.filter(F.floor(F.log2("n") * 8) < lowest)
    sums = rare.join(tail, "code", "left").groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("rare_sum"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("tf"))).alias("n_rare"),
    )
    joined = scored.drop("rare", "deferred").join(sums, "row", "left")
    total = F.col("score")
    if not whole:
        held = staged(scored.select("row", F.explode("deferred").alias("code")).groupBy("row", "code").agg(F.count(F.lit(1)).alias("tf")), "deferred")
        values = staged(_tail_values(held.select("code").distinct(), tail_nodes, shared), "tail-values")
        later = held.join(values, "code").groupBy("row").agg(F.sum(F.col("tf") * F.col("value")).alias("later"))
        joined, total = joined.join(later, "row", "left"), F.col("score") + F.coalesce("later", F.lit(0.0))
    nothing = F.lit(size.n + 0.5 * (size.v + 1))
    return joined.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(size.n).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * F.log10(nothing)).alias("base_score"), total.alias("score"),
    )


def op10_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from those of the folds other than 1."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), fold("doc_id") != 1)
