"""What the operators share on the Spark side: intermediate tables, row identity and learning folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.session import scratch_path

# Rows handed to a Python worker at once; texts are long, so batches are kept short.
BATCH_ROWS = "512"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the folder all executors share and read it back: lineage ends in files that outlive
    an executor, and the planner learns the true size."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame, function, schema) -> DataFrame:
    """`mapInArrow` with short batches."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df.mapInArrow(function, schema)


def fold(doc_id: Column | str, folds: int = 5) -> Column:
    """Learning fold of a document: crc32 of its id as text. A NULL id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds


def row_key(doc_id: str, text: Column) -> Column:
    """Stands for a row in joins: equal for rows of equal id and text (whose results are equal too), never NULL."""
    return F.concat_ws(
        ":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.hex(F.xxhash64(text)), F.coalesce(F.length(text), F.lit(-1)).cast("string")
    )


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names with underscores put before them until `df` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
