"""Parquet tables of the warehouse folder."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmill import schemas
from loanmill.sources import files

MONTH = "application_month"
VERSION = "version"
# The current version of a rewritten table and those before it, for readers that began earlier.
KEPT_VERSIONS = 3


class Warehouse:
    """Silver, dimensions and logs are full rewrites into a new folder, published by a one-line pointer
    file, so a reader never sees half a table and a job may read the table it replaces. The fact table
    is partitioned by month and only the months a load touches are rewritten; its pointer names the version of each month."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- whole tables -------------------------------------------------------------------------
    def _pointer(self, name: str) -> str:
        return f"{self.root}/{name}/CURRENT"

    def has(self, name: str) -> bool:
        return files.exists(self.spark, self._pointer(name))

    def _versions(self, name: str) -> list[str]:
        """Versions that the pointer names, the current one first."""
        return files.read_text(self.spark, self._pointer(name)).split() if self.has(name) else []

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Publish a new version. `KEPT_VERSIONS` stay readable; older folders, and those of writes that failed, go."""
        version = uuid.uuid4().hex
        df.write.parquet(f"{self.root}/{name}/{version}")
        kept = [version, *self._versions(name)][:KEPT_VERSIONS]
        files.write_text(self.spark, self._pointer(name), "\n".join(kept))
        for path in files.glob(self.spark, f"{self.root}/{name}/*"):
            if files.name_of(path) not in (*kept, files.name_of(self._pointer(name))):
                files.delete(self.spark, path)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        if not self.has(name):
            raise FileNotFoundError(f"table {name} does not exist yet under {self.root}")
        version = self._versions(name)[0]
        reader = self.spark.read
        if name in schemas.TABLES:
            reader = reader.schema(schemas.TABLES[name])
        return reader.parquet(f"{self.root}/{name}/{version}")

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.root}/{name}/rows")

    def appended(self, name: str, schema) -> DataFrame:
        path = f"{self.root}/{name}/rows"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    # -- fact ---------------------------------------------------------------------------------
    @property
    def fact_path(self) -> str:
        return f"{self.root}/fact_loan_application"

    def has_fact(self) -> bool:
        return self.has("fact_loan_application")

    def _fact_months(self) -> dict[str, str]:
        """Which version holds each month."""
        return json.loads(files.read_text(self.spark, self._pointer("fact_loan_application"))) if self.has_fact() else {}

    def fact(self, with_month: bool = False) -> DataFrame:
        if not self.has_fact():
            raise FileNotFoundError(f"the fact table does not exist yet under {self.root}")
        # The month is given as text: left to inference it could turn into a date.
        schema = T.StructType([*schemas.FACT_SCHEMA.fields, T.StructField(VERSION, T.StringType()), T.StructField(MONTH, T.StringType())])
        paths = [self._month_path(version, month) for month, version in sorted(self._fact_months().items())]
        if paths:
            df = self.spark.read.schema(schema).option("basePath", self.fact_path).parquet(*paths)
        else:
            df = self.spark.createDataFrame([], schema)
        return df.select(*schemas.FACT_COLUMNS, *([MONTH] if with_month else []))

    def _month_path(self, version: str, month: str) -> str:
        return f"{self.fact_path}/{VERSION}={version}/{MONTH}={month}"

    def replace_months(self, months: list[str] | None, rows: DataFrame) -> None:
        """Let `rows` be all that the fact table has of `months` (of any month, if None).

        The rows are written as a version of their own. Then the list that names the version of each month is replaced, in
        one step: a reader, and a load that begins after a failed one, sees the months before or after the change, never some
        of each. Replaced folders stay for readers of the previous state and go with the next change.
        """
        version, old = uuid.uuid4().hex, self._fact_months()
        rows.write.partitionBy(MONTH).parquet(f"{self.fact_path}/{VERSION}={version}")
        filled = [files.name_of(p).partition("=")[2] for p in files.glob(self.spark, f"{self.fact_path}/{VERSION}={version}/{MONTH}=*")]
        new = {m: v for m, v in old.items() if months is not None and m not in months} | {m: version for m in filled}
        files.write_text(self.spark, self._pointer("fact_loan_application"), json.dumps(new))
        live = {(v, m) for held in (old, new) for m, v in held.items()}
        for path in files.glob(self.spark, f"{self.fact_path}/{VERSION}=*/{MONTH}=*"):
            if tuple(part.partition("=")[2] for part in path.split("/")[-2:]) not in live:
                files.delete(self.spark, path)


def month_of(column: str = "application_date"):
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit("none"))
