"""Chat formatting at token level: segments are encoded separately, reserved ids are spliced between them, and loss masks
are prefix sums over where assistant texts begin and end.

A formatted conversation reads

    <s>[INST] user text [/INST][OUT] assistant text </s>[ROLE]other role[/ROLE] text [/TURN]

The marks are single reserved ids above the vocabulary. Where a text holds one of the strings that marks read as, a backslash
is put before it (and one more where there are some already), so the text form can be taken apart again too: a mark
has no backslash right before it, as every text is followed by a space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loanmill.llm.common import in_batches, staged

VOCABULARY_SIZE = 50_257
# Reserved ids and what they read as.
MARKS = ("<s>", "[INST] ", " [/INST]", "[OUT] ", " </s>", "[ROLE]", "[/ROLE] ", " [/TURN]")
BOS, USER, USER_END, OUT, OUT_END, ROLE, TEXT, TURN_END = range(VOCABULARY_SIZE, VOCABULARY_SIZE + len(MARKS))
_CONTROL = "|".join(re.escape(mark.strip()) for mark in MARKS)
_PLAIN = re.compile(rf"(?<!\\)(\\*)(?={_CONTROL})")
_ESCAPED = re.compile(rf"\\(\\*(?:{_CONTROL}))")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\", text) if "[" in text or "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


# Turns in a range, about; each range is encoded by one task.
RANGE_TURNS = 20_000


def in_order(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(`conv`, `turn`, `role`, `text`, `place`, `row`) dealt in ranges of that order. `place` orders turns of equal number and `row`
    those that are alike, so rows that repeat, or one conversation with most of all rows, spread over many ranges."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    role = F.coalesce(F.col(role_col), F.lit(""))
    narrow = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
        F.sha2(F.concat_ws("\n", role, text), 256).alias("place"), F.monotonically_increasing_id().alias("row"),
    )
    # Written first: the numbers of rows must not change if a task is run again.
    rows = staged(narrow, "turns")
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_TURNS))
    keys = ["conv", "turn", "place", "row"]
    return rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)


def turns(ordered: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(`conv`, `range`, `nth`, `start`, `ids`, `mask`): token ids of every turn of `in_order`, and 1 for those under the loss. `nth`
    turns and `start` tokens of the conversation come before it in its range."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary or default_vocabulary())
        at = TaskContext.get().partitionId()
        open_conv, before, tokens = object(), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            convs, roles, texts = (batch.column(c).to_pylist() for c in ("conv", "role", "text"))
            encoded = tokenizer.encode_batch_fast([escape(x) for x in texts], add_special_tokens=False)
            names = {r: tokenizer.encode(escape(r), add_special_tokens=False).ids for r in set(roles) - {"user", "assistant"}}
            pieces, sizes, spans = [], [], []
            for role, body in zip(roles, (e.ids for e in encoded)):
                if role == "user":
                    head, tail = [USER], [USER_END]
                elif role == "assistant":
                    head, tail = [OUT], [OUT_END]
                else:
                    head, tail = [ROLE, *names[role], TEXT], [TURN_END]
                pieces += [head, body, tail]
                sizes.append(len(head) + len(body) + len(tail))
                spans.append((len(head), len(head) + len(body)) if role == "assistant" else (0, 0))
            begins = np.concatenate([[0], np.cumsum(sizes)])
            flat = np.fromiter((i for p in pieces for i in p), np.int32, begins[-1])
            # +1 where an assistant text begins and -1 where it ends; the running sum is the mask.
            steps = np.zeros(begins[-1] + 1, np.int32)
            low, high = (begins[:-1] + np.array([s[k] for s in spans]) for k in (0, 1))
            np.add.at(steps, low, 1)
            np.add.at(steps, high, -1)
            mask = np.cumsum(steps[:-1]).astype(np.int8)
            nth, start = [], []
            for conv, size in zip(convs, sizes):
                if conv != open_conv:
                    open_conv, before, tokens = conv, 0, 0
                nth.append(before)
                start.append(tokens)
                before, tokens = before + 1, tokens + size
            offsets = pa.array(begins, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array([at] * len(nth), pa.int32()), pa.array(nth, pa.int64()), pa.array(start, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.ListArray.from_arrays(offsets, pa.array(mask))],
                ["conv", "range", "nth", "start", "ids", "mask"],
            )

    kind = ordered.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, range int, nth bigint, start bigint, ids array<int>, mask array<tinyint>"
    return in_batches(ordered.select("conv", "role", "text"), encode, schema)


def joined_turns(encoded: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(`conv_col`, `nth`, `start`, `ids`, `mask`) per turn: its number in its conversation and the place of its first token there.
    The opening id belongs to the first turn.

    Only conversations that go on from one range to the next have anything carried over, so at most one row per range is joined.
    """
    ends = encoded.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("tokens"))
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("conv", "range", F.sum("n").over(earlier).alias("turns_before"), F.sum("tokens").over(earlier).alias("tokens_before"))
    carried = staged(carried.filter("turns_before is not null").withColumnsRenamed({"conv": "of", "range": "on"}), "carried-over")
    placed = encoded.join(carried, (F.col("range") == F.col("on")) & F.col("conv").eqNullSafe(F.col("of")), "left")
    nth = F.col("nth") + F.coalesce("turns_before", F.lit(0))
    opens = nth == 0
    lead = lambda name, first, kind: F.when(opens, F.concat(F.array(F.lit(first).cast(kind)), name)).otherwise(F.col(name)).alias(name)
    start = F.when(opens, F.lit(0)).otherwise(F.col("start") + F.coalesce("tokens_before", F.lit(0)) + 1)
    return placed.select(F.col("conv").alias(conv_col), nth.alias("nth"), start.cast("long").alias("start"), lead("ids", BOS, "int"), lead("mask", 0, "tinyint"))


def read_back(ids: np.ndarray, mask: np.ndarray, tokenizer) -> tuple[list[tuple[str, str, bool]], int]:
    """(turns as (role, text, is it all under the mask), characters of the formatted text) of turns that follow each other."""
    marked = np.flatnonzero(ids >= VOCABULARY_SIZE)
    decode = lambda a, b: tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False)
    found, chars, role = [], 0, None
    for k, at in enumerate(marked.tolist()):
        mark, end = int(ids[at]), int(marked[k + 1]) if k + 1 < len(marked) else len(ids)
        body = decode(at + 1, end) if end > at + 1 else ""
        chars += len(MARKS[mark - VOCABULARY_SIZE]) + len(body)
        if mark == ROLE:
            role = unescape(body)
        elif mark in (USER, OUT, TEXT):
            name = {USER: "user", OUT: "assistant"}.get(mark, role)
            found.append((name, unescape(body), bool(end > at + 1 and mask[at + 1 : end].all())))
    return found, chars


def turns_read_back(formatted: DataFrame, vocabulary: str | None = None, conv_col: str = "conv_id") -> DataFrame:
    """(`conv_col`, `nth`, `role`, `text`, `learned`, `chars`, `loss_tokens`): what each formatted turn says."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary or default_vocabulary())
        for batch in batches:
            rows = []
            for ids, mask in zip(batch.column("ids"), batch.column("mask")):
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy()
                ((role, text, learned),), chars = read_back(ids, mask, tokenizer)
                rows.append((role, text, learned, chars, int(mask.sum())))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("nth")] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["conv", "nth", "role", "text", "learned", "chars", "loss_tokens"],
            )

    kind = formatted.schema[conv_col].dataType.simpleString()
    schema = f"conv {kind}, nth bigint, role string, text string, learned boolean, chars bigint, loss_tokens bigint"
    read = in_batches(formatted.select(F.col(conv_col).alias("conv"), "nth", "ids", "mask"), decoded, schema)
    return read.withColumnRenamed("conv", conv_col)


def digests(formatted: DataFrame, vocabulary: str | None = None, conv_col: str = "conv_id") -> DataFrame:
    """What the formatted conversations say when they are read back, one row per conversation.

    Turns are decoded where they lie. A digest of a whole conversation runs over its turns one after the other: its task reads
    them in order from sorted, spilled rows and holds two hash states and a batch, whatever the length of the conversation.
    """
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "loss_tokens"]
    kind = formatted.schema[conv_col].dataType
    conv_type = to_arrow_type(kind)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_conv, whole, loss, sums = None, None, None, [0] * 4
        out: list[tuple] = []

        def closed() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * 7
            kinds = (conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        def close() -> None:
            if whole is not None:
                out.append((open_conv, sums[0], whole.hexdigest(), sums[1], loss.hexdigest(), sums[2], sums[3]))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv", "role", "text", "learned", "chars", "loss_tokens"))
            for conv, role, text, learned, chars, tokens in zip(*columns):
                if whole is None or conv != open_conv:
                    close()
                    open_conv, whole, loss, sums = conv, sha256(), sha256(), [0] * 4
                whole.update(f"{role}\n{text}\n".encode())
                if role == "assistant" and learned:
                    loss.update(text.encode())
                    sums[1] += len(text)
                sums[0], sums[2], sums[3] = sums[0] + 1, sums[2] + chars, sums[3] + tokens
            if out:
                yield closed()
                out.clear()
        close()
        yield closed()

    read = turns_read_back(formatted, vocabulary, conv_col).withColumnRenamed(conv_col, "conv")
    sorted_ = read.repartition("conv").sortWithinPartitions("conv", "nth")
    schema = f"conv {kind.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, loss_tokens bigint"
    return in_batches(sorted_, digest, schema).withColumnRenamed("conv", conv_col)


def format_chats(conversations: DataFrame, vocabulary: str | None = None, **columns: str) -> DataFrame:
    """(`conv_id`, `nth`, `start`, `ids`, `mask`) per turn: the ids of a conversation are those of its turns by `nth`, and `start` is the
    place of a turn's first id among them. No task or row holds a whole conversation.

    Defined cases: a NULL text or role is empty; turns of one number are ordered by a digest of role and text; repeated rows are
    turns of their own; rows without conversation id form one conversation; NULL turn numbers come first. Other columns are not
    read. An empty table gives no turns. A turn of very long text is one row.
    """
    return joined_turns(staged(turns(in_order(conversations, **columns), vocabulary), "encoded-turns"), columns.get("conv_col", "conv_id"))


def op9_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like marks, formatted and read back."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id bigint, turn bigint, role string, text string")
    return digests(format_chats(table.unionByName(extra))).drop("loss_tokens")
