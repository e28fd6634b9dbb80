"""Landing of raw application feeds: every cell stays text, every row keeps its file of origin.

A feed is scanned once, in tasks, however many files it has. A CSV file proves its header in that scan: the header comes as a
row like any other and is told by its cells. Only files whose header differs from that of the source's first file are
scanned again, one plan per different header. What a scan wrote becomes visible by a manifest that names the batch of each file.
"""

from __future__ import annotations

import csv
import io
import logging
import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmill import schemas
from loanmill.functions import numbers as N
from loanmill.functions import text as X
from loanmill.session import setting, side_by_side, written
from loanmill.sources import files

log = logging.getLogger(__name__)
PEEK_BYTES = 1 << 16


@dataclass(frozen=True)
class Source:
    """A named feed: files of one format matching a glob.

    `one_record_per_line` promises that no record spans lines (CSV without embedded line breaks, or JSON
    lines). Only then can Spark split large files; without the promise each file is one task.
    """

    name: str
    format: str  # "csv" or "json"
    pattern: str
    one_record_per_line: bool = False


@dataclass(frozen=True)
class Landed:
    """What a load brought in: rows, quarantined rows, and files left out for want of columns."""

    loaded: int
    rejected: int
    skipped: int


def missing_columns(columns: Iterable[str], required: Sequence[str] = schemas.SOURCE_COLUMNS) -> list[str]:
    present = set(columns)
    return [c for c in required if c not in present]


def depth(pattern: str) -> int:
    """Parts of a matching path from the first folder with a wildcard on: a glob matches as many folders as it has."""
    parts = pattern.split("/")
    return len(parts) - next((k for k, part in enumerate(parts) if any(c in part for c in "*?[{")), len(parts) - 1)


def _decoded(path: Column) -> Column:
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _origin(source: Source) -> list[Column]:
    """`_file_key`, which tells the file from all others of all sources whatever the pattern, and
    `_source_file`, its path below the fixed folders of the pattern."""
    path = F.col("_metadata.file_path")
    parts = F.transform(F.slice(F.split(path, "/"), -depth(source.pattern), depth(source.pattern)), _decoded)
    return [F.concat(F.lit(source.name + "|"), path).alias("_file_key"), F.array_join(parts, "/").alias("_source_file")]


def _literal(path: str) -> str:
    """A path with its wildcards escaped, for readers that take patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


# -- CSV --------------------------------------------------------------------------------------------------


def _header_cells(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader(io.StringIO(line.lstrip("\ufeff"))), []))


def _first_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The header of one file; that of the data contract if the file has no usable one."""
    size = PEEK_BYTES
    while True:
        data = files.head(spark, path, size)
        if b"\n" in data or len(data) < size:
            break
        size *= 4
    cells = _header_cells(data.decode("utf-8-sig", errors="replace"))
    return cells if not missing_columns(cells) else schemas.SOURCE_COLUMNS


def _scan_csv(spark: SparkSession, source: Source, header: tuple[str, ...], paths: list[str] | None = None) -> DataFrame:
    """Cells of all files by the columns of `header`. `_header` marks the rows that are this header; a file
    without one is not laid out like it, or empty."""
    # Columns beyond the contract, and repeated ones, are not read, so their names must only differ.
    names = [c if c in schemas.SOURCE_COLUMNS and header.index(c) == k else f"_other_{k}" for k, c in enumerate(header)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    reader = spark.read.schema(schema).option("header", False).option("escape", '"').option("multiLine", not source.one_record_per_line)
    raw = reader.csv([_literal(p) for p in paths] if paths else source.pattern)
    # An empty CSV cell is an empty string, not a missing value; Spark reads it as NULL.
    cells = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in schemas.SOURCE_COLUMNS]
    first = F.regexp_replace(F.col(names[0]), "^\ufeff", "") if names else F.lit("")
    is_name = [(first if c == names[0] else F.col(c)) == c for c in schemas.SOURCE_COLUMNS]
    is_header = is_name[0]
    for test in is_name[1:]:
        is_header = is_header & test
    return raw.select(*cells, *_origin(source), F.coalesce(is_header, F.lit(False)).alias("_header"))


def _first_lines(spark: SparkSession, paths: list[str]) -> list[tuple[str, list[str]]]:
    """(first line, files that begin with it), a row for each different line."""
    lines = spark.read.text([_literal(p) for p in paths]).select(
        _decoded(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("at"),
    )
    first = lines.filter("block = 0").groupBy("path").agg(F.min_by("value", "at").alias("line"))
    return [(r["line"], r["paths"]) for r in first.groupBy("line").agg(F.collect_list("path").alias("paths")).collect()]


# -- JSON -------------------------------------------------------------------------------------------------


def _scan_json(spark: SparkSession, source: Source) -> DataFrame:
    raw = spark.read.schema(schemas.SOURCE_SCHEMA).option("multiLine", not source.one_record_per_line).json(source.pattern)
    return raw.select(*schemas.SOURCE_COLUMNS, *_origin(source), F.lit(False).alias("_header"))


def _without_a_key(spark: SparkSession, source: Source, paths: list[str]) -> DataFrame:
    """(`path`, `missing`) of the files none of whose records has some column as a key."""
    lines = spark.read.text([_literal(p) for p in paths], wholetext=not source.one_record_per_line)
    kind = "map<string,string>" if source.one_record_per_line else "array<map<string,string>>"
    parsed = F.from_json(F.regexp_replace("value", "^\ufeff", ""), kind)
    keys = F.map_keys(parsed) if source.one_record_per_line else F.flatten(F.transform(parsed, F.map_keys))
    found = F.array_intersect(keys, F.array(*[F.lit(c) for c in schemas.SOURCE_COLUMNS]))
    path = _decoded(F.col("_metadata.file_path")).alias("path")
    held = lines.select(path, F.explode_outer(found).alias("key")).groupBy("path").agg(F.collect_set("key").alias("held"))
    missing = F.array_except(F.array(*[F.lit(c) for c in schemas.SOURCE_COLUMNS]), F.col("held"))
    return held.select("path", missing.alias("missing")).filter(F.size("missing") > 0)


def mark_malformed(rows: DataFrame) -> DataFrame:
    """Add `_quarantined`: rows without an application id cannot be tracked any further."""
    return rows.withColumn("_quarantined", X.is_blank(F.col("application_id")))


# -- Bronze -----------------------------------------------------------------------------------------------

_STORED = T.StructType([
    *schemas.BRONZE_SCHEMA.fields, T.StructField("_quarantined", T.BooleanType()), T.StructField("_file_key", T.StringType())
])
MANIFEST = "file_key string, file string, batch string, files_of_batch bigint, loaded bigint, rejected bigint"


@dataclass(frozen=True)
class Batch:
    """Rows that are written but not yet visible, and their counts by file."""

    name: str
    counts: DataFrame


class Landing:
    """Bronze and quarantine: batches of rows, and a manifest that names the batch of every file.

    A load writes its rows as a new batch, files as an ordinary column, and then replaces the manifest in one step. A file that comes
    again counts from its new batch only, also if that holds no row of it; a load that fails has changed nothing. Files of a
    batch that were superseded are left out by a semi-join with the manifest; batches without any file are deleted one
    load later, so that readers of the state before are not disturbed. One load runs at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- reading
    @property
    def _pointer(self) -> str:
        return f"{self.path}/CURRENT"

    def _version(self) -> str | None:
        return files.read_text(self.spark, self._pointer).strip() if files.exists(self.spark, self._pointer) else None

    def manifest(self) -> DataFrame:
        version = self._version()
        if version is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/{version}")

    def _batch_path(self, name: str) -> str:
        return f"{self.path}/rows/batch={name}"

    def _rows(self) -> DataFrame:
        """Rows of all files as their manifest entries have them."""
        if self._version() is None:
            raise FileNotFoundError(f"nothing has been landed in {self.path}")
        manifest = self.manifest()
        batches = manifest.groupBy("batch").agg(F.count(F.lit(1)).alias("files"), F.max("files_of_batch").alias("of")).collect()
        schema = T.StructType([*_STORED.fields, T.StructField("batch", T.StringType())])
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/rows")
        whole = [self._batch_path(b["batch"]) for b in batches if b["files"] == b["of"]]
        parts = [self._batch_path(b["batch"]) for b in batches if b["files"] != b["of"]]
        frames = [reader.parquet(*whole)] if whole else []
        if parts:
            live = manifest.select("batch", F.col("file_key").alias("_file_key"))
            frames.append(reader.parquet(*parts).join(live, ["batch", "_file_key"], "left_semi").select(*schema.names))
        return _union(frames) if frames else self.spark.createDataFrame([], schema)

    def bronze(self) -> DataFrame:
        return self._rows().filter(~F.col("_quarantined")).select(*schemas.BRONZE_SCHEMA.names)

    def quarantine(self) -> DataFrame:
        return self._rows().filter("_quarantined").select(*schemas.BRONZE_SCHEMA.names)

    def counts(self) -> DataFrame:
        """Rows loaded and quarantined by file name, from the manifest."""
        return self.manifest().groupBy(F.col("file").alias("_source_file")).agg(
            F.sum("loaded").alias("loaded"), F.sum("rejected").alias("rejected")
        )

    # -- writing
    def stage(self, rows: DataFrame, ingested_at: datetime, check_columns: bool = False) -> Batch:
        """Write rows (source columns, `_source_file`, and where known `_file_key` and `_header`) as a batch.

        With `check_columns`, the counts name the columns that are NULL in all rows of a file.
        """
        if "_file_key" not in rows.columns:
            rows = rows.withColumn("_file_key", F.col("_source_file"))
        header = F.col("_header") if "_header" in rows.columns else F.lit(False)
        # Neither kept nor quarantined: a row that is a file's header.
        kind = F.when(~header, F.col("_quarantined"))
        stamped = mark_malformed(rows).withColumns({"_ingestion_timestamp": N.moment(ingested_at), "_quarantined": kind})
        name = uuid.uuid4().hex
        stamped.select(*schemas.BRONZE_SCHEMA.names, "_quarantined", "_file_key").write.parquet(self._batch_path(name))
        batch = self.spark.read.schema(_STORED).parquet(self._batch_path(name))
        checked = schemas.SOURCE_COLUMNS if check_columns else ()
        absent = F.array_compact(F.array(*[F.when(F.count(c) == 0, F.lit(c)) for c in checked])) if checked else F.array().cast("array<string>")
        # A key has one file name; as a grouping column it keeps the aggregate from sorting all rows.
        counts = batch.groupBy(F.col("_file_key").alias("file_key"), F.col("_source_file").alias("file")).agg(
            F.count(F.when(~F.col("_quarantined"), 1)).alias("loaded"),
            F.count(F.when(F.col("_quarantined"), 1)).alias("rejected"), F.count(F.when(F.col("_quarantined").isNull(), 1)).alias("headers"),
            absent.alias("absent"),
        )
        return Batch(name, written(counts, "file-counts"))

    def stage_each(self, rows: DataFrame, times: dict[str, datetime]) -> list[Batch]:
        """Write the rows of the files that `times` names, each file as a batch of its own with its time, all in one pass over `rows`
        (source columns and `_source_file`)."""
        names = {file: uuid.uuid4().hex for file in times}
        of_file = lambda values: F.coalesce(*[F.when(F.col("_source_file") == file, value) for file, value in values.items()])
        stamped = mark_malformed(rows.filter(F.col("_source_file").isin(list(times)))).withColumns({
            "_ingestion_timestamp": of_file({file: N.moment(time) for file, time in times.items()}), "_file_key": F.col("_source_file"),
            "batch": of_file({file: F.lit(name) for file, name in names.items()}),
        })
        # A task keeps a writer open for each file, where it would otherwise sort its rows by file.
        with setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters", str(len(times))):
            stamped.select(*_STORED.names, "batch").write.mode("append").partitionBy("batch").parquet(f"{self.path}/rows")
        schema = T.StructType([*_STORED.fields, T.StructField("batch", T.StringType())])
        batch = self.spark.read.schema(schema).parquet(f"{self.path}/rows").filter(F.col("batch").isin(list(names.values())))
        counts = written(batch.groupBy("batch", F.col("_file_key").alias("file_key"), F.col("_source_file").alias("file")).agg(
            F.count(F.when(~F.col("_quarantined"), 1)).alias("loaded"), F.count(F.when(F.col("_quarantined"), 1)).alias("rejected")
        ), "file-counts")
        return [Batch(name, counts.filter(F.col("batch") == name).drop("batch")) for name in names.values()]

    def publish(self, batches: Sequence[tuple[Batch, DataFrame]], emptied: Sequence[str] = ()) -> None:
        """Let the given files, rows of each batch's counts, be what the landing has of them; and
        `emptied` be keys of files without a row."""
        before = self.manifest()
        entries = []
        for batch, usable in batches:
            size = F.lit(batch.counts.count()).cast("long")
            entries.append(usable.select("file_key", "file", F.lit(batch.name).alias("batch"), size.alias("files_of_batch"), "loaded", "rejected"))
        if emptied:
            zero = F.lit(0).cast("long")
            names = self.spark.createDataFrame([(f,) for f in emptied], "file_key string")
            for batch, usable in batches:
                names = names.join(usable.select("file_key"), "file_key", "left_anti")
            entries.append(names.select("file_key", F.col("file_key").alias("file"), F.lit("").alias("batch"), zero.alias("files_of_batch"), zero.alias("loaded"), zero.alias("rejected")))
        fresh = written(_union(entries), "manifest-entries")
        version = uuid.uuid4().hex
        kept = before.join(fresh.select("file_key"), "file_key", "left_anti").select(*fresh.columns)
        kept.unionByName(fresh).write.parquet(f"{self.path}/manifest/{version}")
        previous = self._version()
        files.write_text(self.spark, self._pointer, version)
        self._collect({previous, version}, before)

    def _collect(self, versions: set[str | None], before: DataFrame) -> None:
        """Delete what neither the current nor the previous manifest names."""
        named = self.manifest().select("batch").unionByName(before.select("batch")).distinct()
        live = {r["batch"] for r in named.collect()}  # a row per load that still has files
        for path in files.glob(self.spark, f"{self.path}/rows/batch=*"):
            if files.name_of(path).partition("=")[2] not in live:
                files.delete(self.spark, path)
        for path in files.glob(self.spark, f"{self.path}/manifest/*"):
            if files.name_of(path) not in versions:
                files.delete(self.spark, path)

    def load(self, rows: DataFrame, ingested_at: datetime, file_names: Sequence[str] = ()) -> None:
        """Land rows (source columns and `_source_file`), replacing what their files held before. `file_names` may name further
        files of the run: those without any row are left with none."""
        batch = self.stage(rows, ingested_at)
        self.publish([(batch, batch.counts)], file_names)

    def load_each(self, rows: DataFrame, times: dict[str, datetime]) -> None:
        """Land the files that `times` names with their times, as a load of each would, from one pass over `rows`."""
        self.publish([(batch, batch.counts) for batch in self.stage_each(rows, times)], list(times))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _paths(counts: DataFrame) -> list[str]:
    """Paths of counted files, for a reader."""
    encoded = F.substring_index("file_key", "|", -1)
    return sorted(r["path"] for r in counts.select(_decoded(encoded).alias("path")).collect())


def _land_csv(spark: SparkSession, source: Source, first: str, landing: Landing, ingested_at: datetime) -> list[tuple[Batch, DataFrame]]:
    """Staged batches of a source with their usable files. Headers other than the first file's cost a second scan of those files."""
    header = _first_header(spark, first)
    batch = landing.stage(_scan_csv(spark, source, header), ingested_at)
    out = [(batch, batch.counts.filter("headers > 0"))]
    others = _paths(batch.counts.filter("headers = 0"))
    for line, paths in _first_lines(spark, others) if others else []:
        cells = _header_cells(line)
        if missing := missing_columns(cells):
            log.error("%s skipped, missing columns: %s", ", ".join(files.name_of(p) for p in paths[:5]), missing)
            continue
        batch = landing.stage(_scan_csv(spark, source, cells, paths), ingested_at)
        out.append((batch, batch.counts.filter("headers > 0")))
    return out


def _land_json(spark: SparkSession, source: Source, _: str, landing: Landing, ingested_at: datetime) -> list[tuple[Batch, DataFrame]]:
    """A column that is NULL throughout a file may be a key that no record has; only such files are looked at again."""
    batch = landing.stage(_scan_json(spark, source), ingested_at, check_columns=True)
    doubtful = _paths(batch.counts.filter(F.size("absent") > 0))
    if not doubtful:
        return [(batch, batch.counts)]
    lacking = written(_without_a_key(spark, source, doubtful), "lacking-files")
    for row in lacking.limit(20).collect():
        log.error("%s skipped, missing columns: %s", files.name_of(row["path"]), row["missing"])
    path = _decoded(F.substring_index("file_key", "|", -1))
    return [(batch, batch.counts.join(lacking, path == lacking["path"], "left_anti"))]


_LANDERS = {"csv": _land_csv, "json": _land_json}


def ingest(spark: SparkSession, sources: Sequence[Source], landing: Landing, ingested_at: datetime) -> Landed:
    """Land every usable file of every source, all of them in one step.

    A file that lacks a column is left out, and what the landing has of it stays. The driver lists each pattern and reads the
    beginning of one file of each CSV source, however many files there are. A line that repeats its file's header is no record.
    """
    jobs = []
    for source in sources:
        paths = files.glob(spark, source.pattern)
        if not paths:
            log.warning("no files for source %s", source.name)
            continue
        jobs.append(lambda source=source, first=paths[0]: _LANDERS[source.format](spark, source, first, landing, ingested_at))
    staged = [pair for pairs in side_by_side(*jobs) for pair in pairs] if jobs else []
    if not staged:
        return Landed(0, 0, 0)
    usable = written(_union([files_.select("file_key", "loaded", "rejected") for _, files_ in staged]), "usable-files")
    seen = _union([batch.counts.select("file_key") for batch, _ in staged]).distinct()
    landing.publish(staged)
    total = usable.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("loaded"), F.lit(0)).alias("loaded"), F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected")
    ).first()
    return Landed(total["loaded"], total["rejected"], seen.count() - total["files"])
