"""File-stream landing: files that have been landed before are not read again."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loanmill import schemas
from loanmill.sources.audit import utc_now
from loanmill.sources.feeds import Landing


def stream_rows(
    spark: SparkSession, format: str, folder: str, header: tuple[str, ...] = schemas.SOURCE_COLUMNS,
    one_record_per_line: bool = False,
) -> DataFrame:
    """Streaming rows of a feed folder: the source columns as text plus `_source_file`.

    A stream has one schema for all files, so CSV files must share the given header (checked per file).
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = spark.readStream.schema(schema).option("multiLine", not one_record_per_line)
    if format == "csv":
        reader = reader.option("header", True).option("escape", '"').option("enforceSchema", False)
    cells = reader.format(format).load(folder).select(
        *schemas.SOURCE_COLUMNS, F.col("_metadata.file_name").alias("_source_file")
    )
    if format == "csv":
        cells = cells.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in schemas.SOURCE_COLUMNS})
    return cells


def land_new_files(rows: DataFrame, landing: Landing, checkpoint: str, now: datetime | None = None) -> StreamingQuery:
    """Land everything not yet landed, then stop. Each batch replaces the partitions of its own files, so a
    batch repeated after a failure leaves the same table."""

    def load(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            landing.load(batch, now or utc_now())

    return (
        rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
