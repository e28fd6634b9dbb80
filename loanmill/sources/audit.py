"""Execution log: append-only events, one current row per run and stage."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill import schemas
from loanmill.sources.tables import Warehouse

TABLE = "run_log"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class StageCounts:
    rows_read: int = 0
    rows_new: int = 0
    rows_updated: int = 0
    rows_unchanged: int = 0
    rows_rejected: int = 0


def _append(warehouse: Warehouse, run_id, stage, started, ended, status, counts: StageCounts | None, error=None) -> None:
    numbers = [None] * 5 if counts is None else [
        counts.rows_read, counts.rows_new, counts.rows_updated, counts.rows_unchanged, counts.rows_rejected
    ]
    row = (run_id, stage, started, ended, status, *numbers, error)
    # Literals keep this one-row write inside the JVM.
    cells = [
        F.lit(v.isoformat(sep=" ") if isinstance(v, datetime) else v).cast(f.dataType).alias(f.name)
        for v, f in zip(row, schemas.AUDIT_SCHEMA.fields)
    ]
    warehouse.append(TABLE, warehouse.spark.range(0, 1, 1, 1).select(*cells))


@contextmanager
def stage(warehouse: Warehouse, run_id: str, name: str):
    """Log RUNNING on entry, then SUCCESS with the counts the body filled in, or FAILED and re-raise."""
    counts, started = StageCounts(), utc_now()
    _append(warehouse, run_id, name, started, None, "RUNNING", None)
    try:
        yield counts
    except Exception as error:
        _append(warehouse, run_id, name, started, utc_now(), "FAILED", StageCounts(), str(error))
        raise
    _append(warehouse, run_id, name, started, utc_now(), "SUCCESS", counts)


def current(events: DataFrame) -> DataFrame:
    """Latest event of every (run, stage): a finished one replaces its RUNNING one."""
    latest = F.max_by(
        F.struct(*schemas.AUDIT_SCHEMA.names),
        F.struct("started_at", F.coalesce(F.col("ended_at"), F.col("started_at")), F.col("status") != "RUNNING"),
    )
    return events.groupBy("run_id", "stage").agg(latest.alias("e")).select("e.*")


def log_of(warehouse: Warehouse) -> DataFrame:
    return current(warehouse.appended(TABLE, schemas.AUDIT_SCHEMA))


def latest_run(log: DataFrame) -> DataFrame:
    """Stages of the run that started last, in start order; empty for an empty log."""
    newest = log.agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))
    return log.join(newest, "run_id", "left_semi").orderBy(F.col("started_at").asc_nulls_last(), "stage")
