"""Best-fit packing of token sequences: a configuration linear program over the length histogram, solved by multiplicative
weights with knapsack pricing, then rounded.

The histogram has at most as many rows as a sequence has tokens, whatever the number of documents, so the program is solved
on the driver. Documents are tokenized, numbered within their length and placed in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmill.llm import textbatch as tb
from loanmill.llm.common import in_batches, staged

CAPACITY = 2048
SEPARATOR = 0
# Rounds of multiplicative weights, each with one knapsack program, on fractions and then on what rounding left.
ROUNDS = 40
WHOLE_ROUNDS = 60
# How fast a length loses weight while it gets covered, and the most that a round covers of it.
RATE = 1.0
STEP = 0.25
# The program is solved for these weights of a length n against the capacity, n ** power; configurations priced within
# the share of the best one are used in a round of fractions, and in a whole one. A power above one keeps short pieces back as fillers.
VARIANTS = ((1.3, 0.1, 0.1), (1.0, 0.03, 0.01))
# Tokenized words that a worker remembers.
REMEMBERED = 3 << 20


# Letters and digits, and signs between which and them the vocabulary's pattern always splits.
_KIND = np.zeros(256, np.uint8)
_KIND[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = 1
_KIND[list(b"!\"#$%&()*+,-./:;=?@[]^_`{}~\\")] = 2


def _either(places: np.ndarray, others: np.ndarray, last: int) -> np.ndarray:
    """Places from 0 to `last` that are in one of the arrays or both, ascending: marked, neither sorted nor hashed."""
    marked = np.zeros(last + 1, bool)
    marked[places] = marked[others] = True
    return np.flatnonzero(marked)


class WordTokens:
    """Token ids of words, each distinct word tokenized once. The vocabulary lowers its input, drops white space, and never
    matches across white space, nor from a letter or digit to most signs, so the ids of a text are those of its parts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.place = np.zeros(0, np.int64)  # and where each one's ids begin and end in `begins`
        self.begins = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _parts(self, texts: tb.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts, ends, first = texts.runs(tb.NOT_SPACE)
        if b"<|" in texts.data.tobytes():  # may be one of the vocabulary's special strings, which count as they are
            return tb.span_hashes(texts.data, starts, ends), np.stack([starts, ends]), first
        kind = _KIND[texts.data]
        cuts = np.flatnonzero(kind[1:] * kind[:-1] == 2) + 1
        starts, ends = _either(starts, cuts, len(kind)), _either(ends, cuts, len(kind))
        return tb.span_hashes(texts.data, starts, ends, tb.LOWER), np.stack([starts, ends]), np.searchsorted(starts, texts.bounds)

    def encode(self, texts: tb.Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, begins): ids of text i at begins[i]:begins[i + 1]."""
        hashes, spans, first = self._parts(texts)
        if not len(hashes):
            return np.zeros(0, np.uint32), np.zeros(texts.count + 1, np.int64)
        order = np.argsort(hashes)
        ordered = hashes[order]
        fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        distinct, example = ordered[fresh], order[fresh]
        inverse = np.empty(len(hashes), np.int64)
        inverse[order] = np.cumsum(fresh) - 1
        if len(self.known) > REMEMBERED:
            self.clear()
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool) if not len(self.known) else self.known[np.minimum(at, len(self.known) - 1)] != distinct
        if new.any():
            words = [texts.data[a:b].tobytes().decode("utf-8", "replace") for a, b in spans[:, example[new]].T.tolist()]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            self.place = np.insert(self.place, at[new], len(self.place) + np.arange(len(ids)))
            self.known = np.insert(self.known, at[new], distinct[new])
            self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum([len(i) for i in ids], dtype=np.int64)])
            self.ids = np.concatenate([self.ids, np.fromiter((x for i in ids for x in i), np.uint32)])
            at = np.searchsorted(self.known, distinct)
        place = self.place[at]
        low, sizes = self.begins[place][inverse], (self.begins[place + 1] - self.begins[place])[inverse]
        filled = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[np.arange(filled[-1]) + np.repeat(low - filled[:-1], sizes)], filled[first]


_tokens: dict[str, WordTokens] = {}


def _word_tokens(path: str) -> WordTokens:
    if path not in _tokens:
        _tokens[path] = WordTokens(path)
    return _tokens[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, vocabulary: str | None, keep_ids: bool) -> DataFrame:
    """(`id`, `piece`, `start`, `length`, `ids_crc32`, `task`, `nth`[, `ids`]): each text's ids and the separator, cut at the capacity.
    `nth` numbers the pieces of one length that a task cuts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_tokens(vocabulary or default_vocabulary())
        seen, task = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch, texts in tb.blocks(batches, "text"):
            ids, begins = encoder.encode(texts)
            lengths = np.diff(begins) + 1
            count = -(-lengths // capacity)
            row = np.repeat(np.arange(texts.count), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(lengths[row] - start, capacity)
            stream = np.insert(ids, begins[1:], SEPARATOR).astype("<u4")
            low = begins[:-1][row] + row + start
            raw = stream.tobytes()
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(low.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            first = np.searchsorted(length[order], length[order], "left")
            nth = np.empty(len(length), np.int64)
            nth[order] = seen[length[order]] + np.arange(len(length)) - first
            seen += np.bincount(length, minlength=capacity + 1)
            columns = [batch.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(len(length), task), pa.int32()), pa.array(nth)]
            names = ["id", "piece", "start", "length", "ids_crc32", "task", "nth"]
            if keep_ids:
                columns.append(tb.list_column(stream.astype(np.int32), np.append(low, len(stream)), pa.int32()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint" + (", ids array<int>" if keep_ids else "")
    return in_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), cut, schema)


# -- the program ------------------------------------------------------------------------------------------

Configuration = tuple[tuple[int, int], ...]  # (length, how many), longest first


def price(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: (best value by capacity, the last length taken there, 0 if none; the longest of those that tie)."""
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    falling, worth_of = lengths[::-1], values[::-1]
    from_ = len(lengths) - np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for size in range(int(lengths[0]), capacity + 1):
        fitting = falling[from_[size] :]
        worth = worth_of[from_[size] :] + best[size - fitting]
        k = int(worth.argmax())
        if worth[k] > best[size - 1]:
            best[size], taken[size] = worth[k], fitting[k]
        else:
            best[size] = best[size - 1]
    return best, taken


def _unrolled(first: int, capacity: int, taken: np.ndarray) -> Configuration:
    config, room = {first: 1}, capacity - first
    while room > 0:
        length = int(taken[room])
        if length:
            config[length] = config.get(length, 0) + 1
            room -= length
        else:
            room -= 1
    return tuple(sorted(config.items(), reverse=True))


def solve(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, power: float = 1.0, near: float = 0.03,
          whole: bool = False) -> dict[Configuration, float]:
    """How often each configuration is used in a cover that exceeds no length: fractions, or `whole` numbers.

    A length's weight falls exponentially with the share of it that is covered. The knapsack program of a round prices every
    capacity by fresh weights, which gives the best configuration around each open length. Those near the best of all are used, longest
    first; a step is bounded by the scarcest length of the configuration, as the weights of a round allow a length only
    a part of what it needs.
    """
    lengths = np.array(sorted(counts))
    wanted = np.array([counts[n] for n in lengths.tolist()], float)
    index = {n: k for k, n in enumerate(lengths.tolist())}
    left = wanted.copy()
    uses: dict[Configuration, float] = {}
    for _ in range(rounds):
        open_ = np.flatnonzero(left > 1e-9)
        if not len(open_):
            break
        at = lengths[open_]
        values = (at / capacity) ** power * np.exp(-RATE * (1 - left[open_] / wanted[open_]))
        best, taken = price(values, at, capacity)
        total = values + best[capacity - at]
        share = np.minimum(left, np.maximum(wanted, 1.0) if whole else STEP * wanted)
        for k in np.flatnonzero(total >= (1 - near) * total.max())[::-1].tolist():
            if share[open_[k]] <= 1e-9:
                continue
            config = _unrolled(int(at[k]), capacity, taken)
            amount = min(share[index[n]] / many for n, many in config)
            amount = float(int(amount + 1e-9)) if whole else amount
            if amount <= 1e-9:
                continue
            uses[config] = uses.get(config, 0.0) + amount
            for n, many in config:
                share[index[n]] -= many * amount
                left[index[n]] -= many * amount
    return uses


def _fitted(counts: dict[int, int], capacity: int) -> dict[Configuration, int]:
    """Best fit, longest lengths first, of a whole histogram: bins of equal content are handled together."""
    groups: dict[int, dict[Configuration, int]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in range(length, capacity):
            if not left:
                break
            for config in list(groups.get(room, ())):
                bins = groups[room].pop(config)
                each = min(room // length, max(1, left // bins))
                used = min(bins, left // each)
                if used < bins:
                    groups[room][config] = bins - used
                if used:
                    into = groups.setdefault(room - each * length, {})
                    now = config + ((length, each),)
                    into[now] = into.get(now, 0) + used
                    left -= used * each
                if not left:
                    break
            if room in groups and not groups[room]:
                del groups[room]
        each = min(capacity // length, left) if left else 0
        if left:
            full, rest = divmod(left, each)
            for many, bins in ((each, full), (rest, 1 if rest else 0)):
                if bins:
                    into = groups.setdefault(capacity - many * length, {})
                    now = ((length, many),)
                    into[now] = into.get(now, 0) + bins
    out: dict[Configuration, int] = {}
    for group in groups.values():
        for config, bins in group.items():
            out[config] = out.get(config, 0) + bins
    return out


def _rounded(counts: dict[int, int], capacity: int, power: float, near: float, whole_near: float) -> tuple[dict[Configuration, int], int]:
    """(whole uses that hold every length exactly, how many of them the program gave).

    Fractions are rounded down; what that leaves is covered by whole steps of the same program, and the rest is fitted.
    """
    left, out = dict(counts), {}

    def use(uses: dict[Configuration, float]) -> None:
        for config, amount in uses.items():
            bins = int(amount + 1e-9)
            if bins:
                out[config] = out.get(config, 0) + bins
                for n, many in config:
                    left[n] -= many * bins

    use(solve(counts, capacity, ROUNDS, power, near))
    rest = {n: c for n, c in left.items() if c}
    if rest:
        use(solve(rest, capacity, WHOLE_ROUNDS, power, whole_near, whole=True))
    priced = sum(out.values())
    use(_fitted({n: c for n, c in left.items() if c}, capacity))
    return out, priced


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Configuration, int]]:
    """Whole uses of configurations that hold every length exactly as often as the histogram has it.

    The program's variants are tried until one needs no more sequences than the tokens do; the plan of fewest
    sequences counts, and it is never worse than best fit alone.
    """
    if not counts:
        return []
    least = -(-sum(n * c for n, c in counts.items()) // capacity)
    best: dict[Configuration, int] = {}
    for variant in VARIANTS:
        out, _ = _rounded(counts, capacity, *variant)
        if not best or sum(out.values()) < sum(best.values()):
            best = out
        if sum(best.values()) == least:
            break
    else:
        fitted = _fitted(counts, capacity)
        best = fitted if sum(fitted.values()) < sum(best.values()) else best
    return sorted(best.items())


@dataclass
class Places:
    """Where the k-th piece of a length goes, as ranges of k: sorted (length, from) keys and what holds in each range."""

    keys: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(configurations: list[tuple[Configuration, int]]) -> "Places":
        used: dict[int, int] = {}
        rows, sequence = [], 0
        for config, bins in configurations:
            offset = 0
            for length, many in config:
                rows.append((length, used.get(length, 0), many, sequence, offset))
                used[length] = used.get(length, 0) + bins * many
                offset += length * many
            sequence += bins
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        return Places((table[:, 0] << 48) + table[:, 1], table[:, 2], table[:, 3], table[:, 4])

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, (length << 48) + rank, "right") - 1
        inside = rank - (self.keys[at] & ((1 << 48) - 1))
        return self.sequence[at] + inside // self.each[at], self.offset[at] + inside % self.each[at] * length


def _numbered(cut: DataFrame) -> DataFrame:
    """`cut` with `rank`, a number from 0 without gaps within each length: where the pieces of its task begin, and its number there.

    Only the counts by length and task are put in order; pieces need not be alike to be told apart.
    """
    sizes = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = staged(sizes.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin")), "piece-numbers")
    return cut.join(begins, ["length", "task"]).withColumn("rank", F.col("begin") + F.col("nth"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(`id_col`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset`[, `ids`]) per piece of a document.

    A document is its token ids and the separator; only one longer than the capacity is cut. Pieces fill sequences of at
    most `capacity` tokens without gaps from offset 0.

    Defined cases: a NULL or empty text is the separator alone. Every row is packed, so repeated rows and repeated or NULL
    ids are packed each by itself. Other columns are not read. An empty table gives no pieces.
    """
    cut = staged(pieces(docs, id_col, text_col, capacity, vocabulary, keep_ids), "pieces")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(Places.of(plan(counts, capacity)))
    payload = ["id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        for batch in batches:
            if batch.num_rows:
                length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
                sequence, offset = places.find(length, rank)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in payload] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                    [*payload, "sequence_id", "offset"],
                )

    ranked = _numbered(cut).select(*payload, "rank")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema if f.name in payload)
    placed = in_batches(ranked, place, f"{kinds}, sequence_id bigint, offset bigint")
    return placed.withColumnRenamed("id", id_col)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
