"""The load jobs: raw feeds to Bronze, Silver, Gold and their reports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from time import perf_counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loanmill.functions.numbers import count_if
from loanmill.operators import cleansing as C
from loanmill.operators import profiling, quality
from loanmill.operators.derive import derive, silver_projection
from loanmill.operators.incremental import LoadResult, load_gold
from loanmill.plans.star import Star
from loanmill.rules import Rules
from loanmill.session import measured, own_scratch, side_by_side, written
from loanmill.sources import feeds, files
from loanmill.sources.audit import stage, utc_now
from loanmill.sources.tables import Warehouse

SILVER, REJECTS = "silver_loan_application", "transformation_rejected"
PROFILE, CONCERNS, QUALITY = "bronze_profile", "bronze_concerns", "quality_reports"


def transform(bronze: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame, Observation]:
    """(Silver, reject log, rows `read` and `rejected`) of a Bronze frame.

    Text is parsed once, into a staged typed table with the verdict per row; medians, rejects and Silver
    read the few columns they need from there. Silver then takes a single exchange, on the application
    id, to keep each application's latest version. Imputation follows that choice: it does not affect it,
    and fewer rows remain.
    """
    checked, seen = measured(
        C.checked(bronze, rules), read=F.count(F.lit(1)), rejected=count_if(F.col("reject_reason").isNotNull())
    )
    kept, rejects = C.split_rejects(written(checked, "checked"))
    medians = C.medians_by_loan_type(kept)
    silver = silver_projection(derive(C.impute(C.latest_version(kept), medians), rules))
    return silver, rejects, seen


@dataclass(frozen=True)
class TransformCounts:
    rows_read: int
    rows_rejected: int
    rows_written: int
    rows_flagged: int


def refresh_silver(warehouse: Warehouse, bronze: DataFrame, rules: Rules, run_id: str) -> TransformCounts:
    """Rebuild Silver and its reject log, both always rewritten."""
    with own_scratch(warehouse.spark, f"transformation-{uuid.uuid4().hex}"), stage(warehouse, run_id, "transformation") as counts:
        silver_rows, reject_rows, seen = transform(bronze, rules)
        silver_rows, tally = measured(
            silver_rows, n=F.count(F.lit(1)), flagged=count_if(F.col("data_quality_status") == "flagged")
        )
        side_by_side(lambda: warehouse.write(SILVER, silver_rows), lambda: warehouse.write(REJECTS, reject_rows))
        counts.rows_read, counts.rows_rejected, counts.rows_new = seen.get["read"], seen.get["rejected"], tally.get["n"]
        return TransformCounts(counts.rows_read, counts.rows_rejected, counts.rows_new, tally.get["flagged"])


def refresh_profile(warehouse: Warehouse, bronze: DataFrame) -> DataFrame:
    """Store the column profile and its concerns; returns the profile."""
    profiled, counts = side_by_side(
        lambda: warehouse.write(PROFILE, profiling.profile(bronze)),
        lambda: written(profiling.row_counts(bronze), "row-counts"),
    )
    warehouse.write(CONCERNS, profiling.concerns(profiled, counts))
    return profiled


def check_quality(warehouse: Warehouse, bronze: DataFrame, rules: Rules, run_id: str, as_of: datetime) -> DataFrame:
    """Run the ten checks on the stored tables and append the report; returns the check rows."""
    with stage(warehouse, run_id, "data_quality") as counts:
        star = Star.load(warehouse)
        rejects = warehouse.read(REJECTS)
        measures = quality.measures(star.fact, warehouse.read(SILVER), bronze, rejects, star.dims, rules, as_of)
        measures, seen = measured(measures, rows=F.max("fact_rows"))
        checks = quality.checks_of(measures, star.fact.columns, rules, as_of)
        warehouse.append(QUALITY, quality.report(checks, as_of).coalesce(1))
        counts.rows_read = seen.get["rows"]
        return latest_quality_report(warehouse).select(F.inline("checks"))


def latest_quality_report(warehouse: Warehouse) -> DataFrame:
    path = f"{warehouse.root}/{QUALITY}/rows"
    if not files.exists(warehouse.spark, path):
        raise FileNotFoundError("No data-quality report found. Run the load first.")
    reports = warehouse.spark.read.parquet(path)
    return reports.orderBy(F.col("generated_at").desc()).limit(1)


@dataclass
class RunResult:
    run_id: str
    transform: TransformCounts
    load: LoadResult
    checks: DataFrame
    seconds: dict[str, float] = field(default_factory=dict)


def run_all(
    spark: SparkSession, root: str, sources: Sequence[feeds.Source], rules: Rules, now: datetime | None = None
) -> RunResult:
    """Ingest, profile, transform, load the star and check it, in that order, each stage logged. Intermediate tables go with the run."""
    run_id, now = str(uuid.uuid4()), now or utc_now()
    with own_scratch(spark, run_id):
        return _run_all(spark, root, sources, rules, now, run_id)


def _run_all(
    spark: SparkSession, root: str, sources: Sequence[feeds.Source], rules: Rules, now: datetime, run_id: str
) -> RunResult:
    warehouse, landing = Warehouse(spark, root), feeds.Landing(spark, f"{root.rstrip('/')}/bronze_loan_application")
    seconds: dict[str, float] = {}

    def timed(name, job):
        begin = perf_counter()
        result = job()
        seconds[name] = round(perf_counter() - begin, 3)
        return result

    def ingest():
        with stage(warehouse, run_id, "ingestion") as counts:
            landed = feeds.ingest(spark, sources, landing, now)
            counts.rows_new, counts.rows_rejected = landed.loaded, landed.rejected
            counts.rows_read = counts.rows_new + counts.rows_rejected

    timed("ingestion", ingest)
    bronze = landing.bronze()
    timed("profiling", lambda: refresh_profile(warehouse, bronze))
    transformed = timed("transformation", lambda: refresh_silver(warehouse, bronze, rules, run_id))
    loaded = timed("gold_load", lambda: load_gold(warehouse, warehouse.read(SILVER), rules, run_id, now))
    checks = timed("data_quality", lambda: check_quality(warehouse, bronze, rules, run_id, now))
    return RunResult(run_id, transformed, loaded, checks, seconds)
