"""Incremental fact load: only new and changed applications are resolved and written."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill import schemas
from loanmill.functions.hashing import fingerprint
from loanmill.functions.numbers import count_if, moment
from loanmill.operators import dimensions as D
from loanmill.rules import Rules
from loanmill.session import measured, own_scratch, scratch_path, written
from loanmill.sources import files
from loanmill.sources.audit import stage, utc_now
from loanmill.sources.tables import MONTH, Warehouse, month_of

NEW, UPDATED, UNCHANGED = "NEW", "UPDATED", "UNCHANGED"


@dataclass(frozen=True)
class LoadResult:
    run_id: str
    rows_read: int
    rows_new: int
    rows_updated: int
    rows_unchanged: int
    rows_rejected: int


def with_row_hash(silver: DataFrame) -> DataFrame:
    return silver.withColumn("row_hash", fingerprint(silver, schemas.HASH_COLUMNS))


def classify(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Add `change_type` and `old_month` to incoming rows, by comparison with the id, hash and month of the stored ones.

    Rows that carry no `row_hash` yet get it behind the exchange: it takes half of what a row takes there.
    """
    stored = existing.select(
        F.col("application_id").alias("_id"), F.col("row_hash").alias("_hash"), F.col(MONTH).alias("old_month")
    )
    change = (
        F.when(F.col("_id").isNull(), NEW).when(F.col("row_hash") != F.col("_hash"), UPDATED).otherwise(UNCHANGED)
    )
    joined = incoming.join(stored, F.col("application_id") == F.col("_id"), "left")
    if "row_hash" not in incoming.columns:
        joined = with_row_hash(joined)
    return joined.withColumn("change_type", change).drop("_id", "_hash")


def change_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("change_type").agg(F.count(F.lit(1)).alias("applications"))


def upsert(existing: DataFrame, changed: DataFrame) -> DataFrame:
    """`existing` with the rows of `changed`, as classified against it, replacing those of equal application id.

    Only a row with an `old_month` has one to replace. Their ids are written first, so Catalyst knows how few they are and leaves the
    stored rows where they lie, or exchanges them where they are many. What stays is written as well: that exchange and the one by
    month are never on disk together.
    """
    replaced = written(changed.filter(F.col("old_month").isNotNull()).select("application_id"), "replaced-ids")
    kept = written(existing.join(replaced, "application_id", "left_anti"), "kept-rows")
    return kept.unionByName(changed.select(*existing.columns))


def load_gold(
    warehouse: Warehouse, silver: DataFrame, rules: Rules, run_id: str, loaded_at: datetime | None = None
) -> LoadResult:
    """Refresh dimensions, then upsert the changed applications into the fact table.

    The change test comes before key resolution, so unchanged rows never reach the dimension joins. Changed
    rows are staged; then only the months they enter or leave are rewritten, from the staged rows and
    what those months already hold. A month that holds much more than others is split over files by
    adaptive rebalancing instead of going to one task.
    """
    with own_scratch(warehouse.spark, f"load-{uuid.uuid4().hex}"), stage(warehouse, run_id, "dimensional_load") as counts:
        spark = warehouse.spark
        day = F.col("application_date").cast("date")
        totals = silver.agg(
            F.count(F.lit(1)).alias("n"), count_if(D.lacks_key()).alias("lacking"), F.min(day).alias("first"), F.max(day).alias("last")
        ).first()
        dims = D.refresh_dims(warehouse, silver, rules, (totals["first"], totals["last"]))
        stamps = {"loaded_at": moment(loaded_at or utc_now()), MONTH: month_of()}
        if not warehouse.has_fact():
            # Nothing to compare with: a row hash, half of what a row takes in an exchange, is formed behind the last one.
            rows = D.resolve_keys(silver, dims).withColumns(stamps).select(*[c for c in schemas.FACT_COLUMNS if c != "row_hash"], MONTH)
            rows = with_row_hash(rows.hint("rebalance", MONTH)).select(*schemas.FACT_COLUMNS, MONTH)
            rows, seen = measured(rows, n=F.count(F.lit(1)))
            warehouse.replace_months(None, rows)
            counts.rows_new = seen.get["n"]
        else:
            classified = classify(silver, warehouse.fact(with_month=True)).filter(F.col("change_type") != UNCHANGED)
            # The exchange on the applicant goes without the hash as well.
            resolved = with_row_hash(D.resolve_keys(classified.drop("row_hash"), dims))
            changed = resolved.withColumns(stamps).select(*schemas.FACT_COLUMNS, MONTH, "change_type", "old_month")
            path = scratch_path(spark, "changed")
            rows, seen = measured(
                changed, new=count_if(F.col("change_type") == NEW), updated=count_if(F.col("change_type") == UPDATED)
            )
            rows.write.parquet(path)
            counts.rows_new, counts.rows_updated = seen.get["new"], seen.get["updated"]
            if counts.rows_new or counts.rows_updated:
                _merge_months(warehouse, spark.read.schema(changed.schema).parquet(path))
            files.delete(spark, path)
        counts.rows_read, counts.rows_rejected = totals["n"], totals["lacking"]
        counts.rows_unchanged = counts.rows_read - counts.rows_rejected - counts.rows_new - counts.rows_updated
        return LoadResult(
            run_id, counts.rows_read, counts.rows_new, counts.rows_updated, counts.rows_unchanged, counts.rows_rejected
        )


def _merge_months(warehouse: Warehouse, staged: DataFrame) -> None:
    touched = staged.select(F.explode(F.array(MONTH, "old_month")).alias("m")).filter("m IS NOT NULL").distinct()
    months = [row["m"] for row in touched.collect()]  # calendar months, bounded by the calendar
    stored = warehouse.fact(with_month=True).filter(F.col(MONTH).isin(months))
    merged = upsert(stored, staged)
    warehouse.replace_months(months, merged.hint("rebalance", MONTH))
