"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Rows get numbers 0 … N - 1 that depend on nothing but the rows. The permutation of a number is its place in the shuffled
order, and shard and slot follow from the place by division, so either can be computed from the other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmill.llm.common import staged

ROUNDS = 6
# Rows numbered in one task, about; and groups of slots, whose offsets are added up apart.
NUMBERED = 50_000
SLOT_GROUPS = 1024
# Rows that are alike, written out by one task.
COPIES = 10_000
# Steps after which a number has surely left the part of the domain beyond N; see `permuted`.
WALK = 64


def _div(x: Column, by: Column) -> Column:
    return F.call_function("div", x, by)


def permuted(number: Column, total: int, seed: int) -> Column:
    """The place of `number` in a permutation of 0 … total - 1 chosen by `seed`.

    A number is split into digits (l, r) with bases a and b, where a * b is less than a beyond the total. Each round adds a
    hash of one digit to the other, which can be undone, so the rounds permute 0 … a * b - 1. A place at or above the total is
    permuted again until it is below (cycle walking). A walk has at most a * b - total steps, and each ends it
    with a chance of total / (a * b): below 65 numbers to be skipped the bound is exact, above that the chance of 64 steps that all
    fail is under 64 ** -64, and would raise an error.
    """
    a = max(1, math.isqrt(total))
    b = max(1, -(-total // a))
    spare = a * b - total

    def feistel(x: Column) -> Column:
        left, right = x % F.lit(a), _div(x, F.lit(a))
        for k in range(ROUNDS):
            if k % 2 == 0:
                left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(seed), F.lit(k)), F.lit(a)), F.lit(a))
            else:
                right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(seed), F.lit(k)), F.lit(b)), F.lit(b))
        return right * F.lit(a) + left

    first = feistel(number)
    if not spare:
        return first
    steps = F.sequence(F.lit(1), F.lit(min(spare, WALK)))
    walked = F.aggregate(steps, first, lambda x, _: F.when(x >= total, feistel(x)).otherwise(x))
    place = F.when(first < total, first).otherwise(walked)
    return F.when(place < total, place).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def numbered(counted: DataFrame, order: list[str], total: int) -> DataFrame:
    """(`order`, `row_number`): the numbers 0 … total - 1 of all rows, where `counted` has each different row once, `n` times over.

    Different rows fall into hash slots sized by their number. A slot's offset is the sum of all earlier slots: first within its
    group of slots, then over the groups, so that no window holds more than the slots of a group, or the groups. Rows that are
    alike are one row until all offsets are known; then each gets a number of its own, COPIES to a task.
    """
    per_group = max(1, -(-total // (NUMBERED * SLOT_GROUPS)))
    slot = F.pmod(F.xxhash64(*order), F.lit(per_group * SLOT_GROUPS if total > NUMBERED else 16))
    slotted = counted.withColumn("slot", slot).withColumn("group", _div(F.col("slot"), F.lit(per_group)))
    sizes = staged(slotted.groupBy("group", "slot").agg(F.sum("n").alias("in_slot")), "slot-sizes")
    within = Window.partitionBy("group").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy("group").agg(F.sum("in_slot").alias("in_group"))
    over = Window.partitionBy(F.lit(0)).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("group", F.coalesce(F.sum("in_group").over(over), F.lit(0)).alias("group_start"))
    offsets = sizes.select("group", "slot", F.coalesce(F.sum("in_slot").over(within), F.lit(0)).alias("slot_start")).join(starts, "group")
    earlier = Window.partitionBy("slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = slotted.withColumn("inside", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(
        offsets.select("slot", "group_start", "slot_start"), "slot"
    )
    begin = F.col("group_start") + F.col("slot_start") + F.col("inside")
    found = staged(placed.select(*order, "n", begin.alias("begin")), "row-numbers")

    def each(rows: DataFrame) -> DataFrame:
        return rows.select(*order, F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("n") - 1)).alias("row_number"))

    # Runs of many copies are cut, and the cuts dealt anew, before they are written out row by row.
    runs = found.filter(F.col("n") > COPIES).select(*order, "begin", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(COPIES))).alias("skip"))
    cuts = runs.select(*order, (F.col("begin") + F.col("skip")).alias("begin"), F.least(F.lit(COPIES), F.col("n") - F.col("skip")).alias("n"))
    return each(found.filter(F.col("n") <= COPIES)).unionAll(each(cuts.repartition("begin")))


def assign(docs: DataFrame, shards: int = 16, seed: int = 20_240_517, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(`id_col`, `size`, `text_crc32`, `row_number`, `shard`, `slot`) per row of `docs`.

    Shard k holds the places p of the shuffled order with p % shards = k, at slot p // shards: counts differ by
    one at most and slots have no gaps. The same rows get the same places whatever the partitions.

    Defined cases: a NULL or empty text has size 1 and crc32 0. Each row has a place of its own; rows of equal id, size and
    crc32 have neighbouring row numbers, which of them has which does not matter. NULL ids are numbered like others. Other columns are not read. An empty table
    gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    order = [id_col, "text_crc32", "size"]
    counted = staged(rows.groupBy(*order).agg(F.count(F.lit(1)).alias("n")), "row-digests")
    total = counted.agg(F.sum("n")).first()[0] or 0
    placed = numbered(counted, order, total).withColumn("place", permuted(F.col("row_number"), max(total, 1), seed))
    return placed.select(
        id_col, "size", "text_crc32", "row_number", (F.col("place") % shards).cast("int").alias("shard"),
        _div(F.col("place"), F.lit(shards)).alias("slot"),
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard, in slot order inside each file. A shard is split over tasks by ranges of slots."""
    assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal counts."""
    assigned = assign(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return assigned.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )
