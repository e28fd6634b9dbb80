"""Near-duplicate documents by MinHash with tensored bands, every link verified on full shingle sets.

A classic index needs `rows` minhashes for each of its tables. Here two small collections of half keys, `t` each, are
computed; all t * t pairs of a half from the one and a half from the other are the table keys, so t * t tables cost only
2 * t * rows / 2 minhashes. A pair of similarity s misses a collection with probability (1 - s ** rows) ** t.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.llm import textbatch as tb
from loanmill.llm.common import in_batches, row_key, staged
from loanmill.llm.components import components

# Minhashes in a half key, and the chance that a pair right at the threshold shares no half key of a collection.
HALF_ROWS = 3
MISS = 1e-4
# Members of a half key, and their shingles, in a block; two blocks are compared in one task.
MEMBER_BLOCK = 1024
SHINGLE_BLOCK = 1 << 20
# A pair is verified if its minhashes agree as often as the threshold asks, less this many standard deviations.
SIGNATURE_SLACK = 4.0


def halves_for(percent: int) -> int:
    """Half keys per collection, so that a pair at the threshold is missed with a chance below 2 * MISS."""
    return max(2, math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** HALF_ROWS)))


def _shingles(texts: tb.Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = texts.runs(tb.NOT_SPACE)
    return tb.ngrams(tb.span_hashes(texts.data, starts, ends, tb.LOWER), first, n)


def _distinct(values: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sets = [np.unique(values[a:b]) for a, b in zip(begins[:-1], begins[1:])]
    return np.concatenate([*sets, np.zeros(0, np.uint64)]), np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)])


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _sorted(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Each set's hashes as signed numbers in ascending order."""
    out = _signed(values).copy()
    for a, b in zip(begins[:-1], begins[1:]):
        out[a:b].sort()
    return out


def _row(id_col: str, text_col: str) -> Column:
    """Stands for a row in joins: never NULL, and different for different texts of one id."""
    return F.struct(F.xxhash64(id_col).alias("of_id"), F.xxhash64(text_col).alias("of_text"))


def sketches(docs: DataFrame, id_col: str, text_col: str, n: int, t: int) -> DataFrame:
    """(`id`, `row`, `n`, `fp`, `halves`, `signature`) per row: set size, 128-bit set fingerprint, the 2 * t half keys and
    one byte of every minhash. A text without words has n = 0 and no fingerprint."""
    hashes = 2 * t * HALF_ROWS
    random = np.random.default_rng(20_240_229)
    seeds = random.integers(0, 1 << 63, hashes, dtype=np.uint64)
    factors = random.integers(0, 1 << 63, hashes, dtype=np.uint64) | np.uint64(1)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in tb.blocks(batches, "text"):
            values, begins = _distinct(*_shingles(texts, n))
            sizes = np.diff(begins)
            some = np.flatnonzero(sizes)
            low = np.zeros((len(some), hashes), np.uint64)
            prints = [None] * batch.num_rows
            if len(some):
                at = begins[:-1][some]
                for k in range(hashes):
                    low[:, k] = np.minimum.reduceat((values ^ seeds[k]) * factors[k], at)
                sums = np.add.reduceat(values, at), np.add.reduceat(tb.mix(values + np.uint64(77)), at)
                raw = np.stack([tb.mix(s + sizes[some].astype(np.uint64)) for s in sums], axis=1).tobytes()
                for place, row in enumerate(some):
                    prints[row] = raw[16 * place : 16 * place + 16]
            keys = np.zeros((len(some), 2 * t), np.uint64)
            for k in range(HALF_ROWS):
                keys = tb.mix(keys * np.uint64(31) + low[:, k :: HALF_ROWS] + np.arange(2 * t, dtype=np.uint64))
            bytes_of = (tb.mix(low) >> np.uint64(56)).astype(np.uint8).tobytes()
            signatures, begin = [None] * batch.num_rows, np.concatenate([[0], np.cumsum((sizes > 0) * 2 * t)])
            for place, row in enumerate(some):
                signatures[row] = bytes_of[hashes * place : hashes * (place + 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                 tb.list_column(_signed(keys.reshape(-1)), begin, pa.int64()), pa.array(signatures, pa.binary())],
                ["id", "row", "n", "fp", "halves", "signature"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), _row(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    return in_batches(narrow, sketch, f"id {kind}, row struct<of_id:bigint,of_text:bigint>, n bigint, fp binary, halves array<bigint>, signature binary")


def _shingle_sets(docs: DataFrame, id_col: str, text_col: str, n: int, wanted: DataFrame) -> DataFrame:
    """(`fp`, `shingles`) of the wanted fingerprints, one each, made from the text of its representative `row`."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in tb.blocks(batches, "text"):
            values, begins = _distinct(*_shingles(texts, n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("fp"), tb.list_column(_sorted(values, begins), begins, pa.int64())], ["fp", "shingles"]
            )

    texts = docs.select(_row(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    found = texts.join(wanted.select("row", "fp"), "row").select("fp", "text").dropDuplicates(["fp"])
    return staged(in_batches(found, sets, "fp binary, shingles array<bigint>"), "shingle-sets")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """(`id_col`, `n_shingles`, `component_id`, `kept`) per row of `docs`.

    Two documents are linked if 100 * |A & B| >= percent * |A | B| on their sets of distinct `shingle`-word shingles.
    Components of links share the smallest id as `component_id`; the row of that id is kept.

    1. Equal sets become one node, so copies never meet as pairs.
    2. Half keys that only one node has are dropped; the others are combined into table keys.
    3. Each key pairs one member with the others. Pairs are verified on whole sets and components are formed.
    4. Keys that still hold several components may hide a link. Their members are compared, in blocks of bounded size,
       until all that a link joins are joined. No key is capped.

    Defined cases: NULL, empty and wordless texts have no shingles, are linked with nothing and keep their own id.
    Texts shorter than a shingle have their word sequence as one shingle. Rows of equal id and text get equal
    results; rows of one id and different texts are separate nodes, which both count as that id. A row without id takes part as
    a link, but names no component; a component without any id has a NULL `component_id` and keeps all its
    rows. An id need not be a number. Other columns are not read.
    """
    t = halves_for(percent)
    sketch = staged(sketches(docs, id_col, text_col, shingle, t), "sketches")
    nodes = staged(
        sketch.filter("n > 0").groupBy("fp").agg(
            F.min("row").alias("row"), F.first("n").alias("n"), F.first("halves").alias("halves"), F.first("signature").alias("signature")
        ),
        "nodes",
    )
    rooted = _linked(docs, id_col, text_col, shingle, percent, nodes, _table_keys(nodes, t))
    members = sketch.select(F.col("id"), "n", "fp").join(rooted.withColumnRenamed("node", "fp"), "fp", "left")
    members = staged(members.select("id", "n", "fp", F.coalesce("root", "fp").alias("root")), "members")
    # The smallest id of a component is a grouped minimum, combined before the shuffle, and written before it is joined:
    # beside an aggregate of the same key a frequent root could not be split. A row that is alone names itself.
    smallest = staged(
        members.filter("root is not null").groupBy("root").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1").drop("rows"),
        "smallest-ids",
    )
    joined = members.join(smallest.withColumn("found", F.lit(True)), "root", "left")
    joined = joined.withColumn("component_id", F.when(F.col("found"), F.col("component_id")).otherwise(F.col("id")))
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )


def _linked(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, nodes: DataFrame, keys: DataFrame) -> DataFrame:
    """(`node`, `root`) of all nodes that have a link."""
    crowded = keys.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high")
    crowded = staged(crowded.select("key"), "keys-of-several")
    open_ = staged(keys.join(crowded.select("key"), "key"), "crowded-keys")
    wanted = nodes.select("fp", "row").join(open_.select("fp").distinct(), "fp")
    sets = _shingle_sets(docs, id_col, text_col, shingle, wanted)
    leader = F.min(F.struct(F.xxhash64("fp"), "fp"))
    leaders = staged(open_.groupBy("key").agg(leader.alias("leader")), "leaders")
    led = open_.join(leaders, "key").filter(F.col("fp") != F.col("leader.fp"))
    pairs = led.select(F.least("fp", "leader.fp").alias("a"), F.greatest("fp", "leader.fp").alias("b")).distinct()
    links = _verified(staged(pairs, "pairs"), nodes, sets, percent)
    rooted = staged(components(links), "rooted")
    hidden = staged(_hidden_links(open_, nodes, sets, rooted, percent), "hidden-links")
    if hidden.isEmpty():
        return rooted
    known = rooted.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return staged(components(known.unionAll(hidden)), "rooted")


def _table_keys(nodes: DataFrame, t: int) -> DataFrame:
    """(`key`, `fp`): all pairs of a half key of the first and one of the second collection. A half key
    that no other node has can't lead to a partner and is left out before the pairs are formed."""
    halves = nodes.select("fp", F.posexplode("halves").alias("place", "half"))
    shared = halves.groupBy("place", "half").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high")
    shared = staged(shared.select("place", "half"), "halves-of-several")
    held = staged(halves.join(shared, ["place", "half"]), "shared-halves")
    sides = held.groupBy("fp").agg(
        F.collect_list(F.when(F.col("place") < t, F.col("half"))).alias("first"),
        F.collect_list(F.when(F.col("place") >= t, F.col("half"))).alias("second"),
    )
    first = sides.select("fp", "second", F.explode("first").alias("one"))
    both = first.select("fp", "one", F.explode("second").alias("two"))
    return staged(both.select(F.xxhash64("one", "two").alias("key"), "fp"), "table-keys")


def _least_agreement(percent: int, hashes: int) -> float:
    share = percent / 100
    return share - SIGNATURE_SLACK * math.sqrt(share * (1 - share) / hashes)


def _verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (`a`, `b`) whose full shingle sets reach the threshold; sizes and signatures rule out most others first."""
    one = nodes.select(F.col("fp").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a"))
    two = nodes.select(F.col("fp").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("s_b"))
    sized = pairs.join(one, "a").join(two, "b").filter(
        F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b")
    )

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (tb.texts_of(batch.column(c)).data.reshape(batch.num_rows, -1) for c in ("s_a", "s_b"))
                close = (a == b).mean(axis=1) >= _least_agreement(percent, a.shape[1])
                yield batch.select(["a", "b", "n_a", "n_b"]).filter(pa.array(close))

    close = staged(in_batches(sized, agreeing, "a binary, b binary, n_a bigint, n_b bigint"), "close-pairs")
    held = close.join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("of_a")), "a").join(
        sets.select(F.col("fp").alias("b"), F.col("shingles").alias("of_b")), "b"
    )
    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    union = F.col("n_a") + F.col("n_b") - common
    return staged(held.filter(F.lit(100) * common >= F.lit(percent) * union).select("a", "b"), "verified")


def _hidden_links(crowded: DataFrame, nodes: DataFrame, sets: DataFrame, rooted: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a table key, enough of them to join what belongs together.

    The members of such keys meet by each half key of the first collection, in blocks; a pair that shares several is
    compared at the first. Within a task, members that a link has joined are not compared again, so no more
    links come out than there are members.
    """
    placed = crowded.join(rooted.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = staged(placed, "rooted-keys")
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    mixed = staged(mixed.select("key"), "keys-of-several-roots")
    members = placed.join(mixed, "key").groupBy("fp").agg(F.first("root").alias("root"))
    joined = members.join(nodes.select("fp", "n", "halves", "signature"), "fp")
    t = F.size("halves") / 2
    at_half = staged(
        joined.select("*", F.posexplode(F.slice("halves", F.lit(1), t.cast("int"))).alias("place", "half")).drop("halves"), "members-by-half"
    )
    halves = joined.select("fp", "halves")
    sizes = at_half.groupBy("place", "half").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("weight"), F.min("root").alias("low"), F.max("root").alias("high")
    ).filter("low <> high")
    sizes = staged(sizes, "half-sizes")
    blocks = F.greatest(F.ceil(F.col("members") / MEMBER_BLOCK), F.ceil(F.col("weight") / SHINGLE_BLOCK)).cast("int")
    # A member is in block h(fp); each two blocks of a half key are one group, and a member goes to the groups of its block.
    member = at_half.join(sizes.select("place", "half", blocks.alias("blocks")), ["place", "half"])
    member = member.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    cells = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "place", "half", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "fp", "root", "n", "signature"
    )
    full = cells.join(halves, "fp").join(sets, "fp")

    def compare(group: pa.Table) -> pa.Table:
        x, y, place = (group[c][0].as_py() for c in ("x", "y", "place"))
        own, size = group["own"].to_numpy(), group["n"].to_numpy()
        fps, component = group["fp"].to_pylist(), np.unique(np.array(group["root"].to_pylist(), object), return_inverse=True)[1]
        half = group["halves"].combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)
        half = half[:, : half.shape[1] // 2]
        marks = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(group.num_rows, -1)
        lists = group["shingles"].combine_chunks()
        values, begin = lists.values.to_numpy(), lists.offsets.to_numpy()
        least = _least_agreement(percent, marks.shape[1])
        left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
        found: list[tuple[bytes, bytes]] = []
        for i in left:
            others = right[right > i] if x == y else right
            small, large = np.minimum(size[i], size[others]), np.maximum(size[i], size[others])
            others = others[(component[others] != component[i]) & (100 * small >= percent * large)]
            agree = (marks[others] == marks[i]).mean(axis=1)
            first = (half[others] == half[i]).argmax(axis=1) == place
            some = first & (agree >= least)
            others = others[some][np.argsort(-agree[some], kind="stable")]
            mine = values[begin[i] : begin[i + 1]]
            while len(others):
                now, others = others[:32], others[32:]
                theirs = np.concatenate([values[begin[j] : begin[j + 1]] for j in now])
                ends = np.cumsum(size[now])
                held = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
                common = np.diff(np.concatenate([[0], np.cumsum(held)])[np.concatenate([[0], ends])])
                for j in now[100 * common >= percent * (size[i] + size[now] - common)]:
                    if component[j] != component[i]:
                        component[component == component[j]] = component[i]
                        found.append((fps[i], fps[j]))
                others = others[component[others] != component[i]]
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return full.groupBy("place", "half", "x", "y").applyInArrow(compare, "a binary, b binary")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """`docs` less all but one row of each group of near duplicates: the one of smallest id, rows without id last. All columns
    stay. Of rows that repeat the same id and text one stays too, unless the text has no words."""
    key = row_key(id_col, F.col(text_col))
    named = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), key.alias("row")).alias("_id")
    found = near_duplicates(docs.select(named, F.col(text_col).alias("text")), "_id", "text", shingle, percent)
    judged = staged(found.filter("n_shingles > 0").groupBy(F.col("_id.row").alias("row")).agg(
        F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("rows")
    ).filter("not kept or rows > 1"), "judged")
    gone, repeated = judged.filter("not kept").select("row"), judged.filter("kept").select("row")
    # The same plan at every size: what goes grows with the documents, so it is never broadcast.
    left = docs.join(gone.hint("merge"), key == gone["row"], "left_anti")
    if repeated.isEmpty():
        return left
    once = left.join(repeated, key == repeated["row"], "left_semi").dropDuplicates([id_col, text_col])
    return left.join(repeated, key == repeated["row"], "left_anti").unionByName(once)


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, similarity 0.85."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, shingle=3, percent=85)
