"""Exact grouped medians by rank selection on counted values; no group ever lies in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmill.session import written


def counted_values(df: DataFrame, keys: Sequence[str], values: Sequence[str], ranges: int | None = None) -> DataFrame:
    """(`field`, `keys`, `v`, `n`, `range`): how often each group holds each value of the fields, NULLs included.

    Counts are combined before they are shuffled, so a value that a third of all rows share is one row. Ranges follow each other in
    order of field and value over all groups; their number follows the size of the table unless given.
    """
    counted = None
    for field in values:
        part = df.groupBy(F.lit(field).alias("field"), *keys, F.col(field).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        counted = part if counted is None else counted.unionByName(part)
    order = [F.col(c) for c in ("field", "v", *keys)]
    ordered = counted.repartitionByRange(ranges, *order) if ranges else counted.repartitionByRange(*order)
    return written(ordered.withColumn("range", F.spark_partition_id()), "value-counts")


def middle(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """(`group`, `median`) of the values in `counted_values` form; for fewer columns than were counted, of their union.

    Sums by range tell which range holds the middle rank (or the two of an even number); only its rows are put in order.
    """
    known = counts.filter("v IS NOT NULL")
    sums = known.groupBy(*group, "range").agg(F.sum("n").alias("n"))
    by_range = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(Window.partitionBy(*group))
    placed = sums.select(*group, "range", F.sum("n").over(by_range).alias("upto"), "n", total.alias("total")).withColumns({
        "low": F.floor((F.col("total") + 1) / 2), "high": F.floor((F.col("total") + 2) / 2)
    })
    holds = placed.filter("upto >= low AND upto - n < high").select(
        *[F.col(g).alias(f"_{g}") for g in group], F.col("range").alias("_range"), (F.col("upto") - F.col("n")).alias("before"), "low", "high"
    )
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    inside = known.join(holds, [*same, F.col("range") == F.col("_range")])
    by_value = Window.partitionBy(*group, "range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("upto", F.col("before") + F.sum("n").over(by_value))

    def at(rank: str):
        return F.max(F.when((F.col("upto") >= F.col(rank)) & (F.col("upto") - F.col("n") < F.col(rank)), F.col("v")))

    return ranked.groupBy(*group).agg((at("low") * F.lit(0.5) + at("high") * F.lit(0.5)).alias("median"))


def grouped_median(df: DataFrame, keys: Sequence[str], values: Sequence[str], ranges: int | None = None) -> DataFrame:
    """`keys` plus `<value>_median` for every value column, a row per group of `df`; NULL values are ignored."""
    counts = counted_values(df, keys, values, ranges)
    found = middle(counts, ["field", *keys]).groupBy(*keys).agg(
        *[F.max(F.when(F.col("field") == v, F.col("median"))).alias(f"{v}_median") for v in values]
    )
    renamed = found.select(*[F.col(k).alias(f"_{k}") for k in keys], *[f"{v}_median" for v in values])
    groups = counts.select(*keys).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return groups.join(renamed, same, "left").select(*keys, *[f"{v}_median" for v in values])
