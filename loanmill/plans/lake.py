"""A warehouse built on demand from the order tables, once per session and input folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmill import schemas
from loanmill.functions.text import is_blank
from loanmill.operators import cleansing as C
from loanmill.operators import dimensions as D
from loanmill.operators import incremental as I
from loanmill.operators.incremental import load_gold
from loanmill.plans import ask, load
from loanmill.plans.portfolio import Breakdowns
from loanmill.plans.star import Star
from loanmill.session import configure, own_scratch, scratch_path, written
from loanmill.sources import files, star_feed
from loanmill.sources.feeds import Landing, Source, ingest
from loanmill.sources.tables import Warehouse


class Lake:
    """Layers of one input folder; each is written to the shared folder when first asked for."""

    _known: dict[tuple[str, str], "Lake"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = scratch_path(spark, "lake")
        self.warehouse = Warehouse(spark, f"{self.root}/warehouse")

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Lake":
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._known:
            cls._known[key] = cls(configure(spark), sf_dir)
        return cls._known[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def rules(self):
        return star_feed.feed_rules(self.spark, self.sf_dir)

    @cached_property
    def landing(self) -> Landing:
        """Both files of the feed, landed as two deliveries with times and batches of their own. One pass over the tables works out
        all lines, straight into their batches, so what both files join with is read and exchanged once."""
        landing = Landing(self.spark, f"{self.root}/bronze")
        times = {star_feed.CSV_FILE: star_feed.CSV_TIME, star_feed.JSON_FILE: star_feed.JSON_TIME}
        landing.load_each(star_feed.feed(self.spark, self.sf_dir), times)
        return landing

    @cached_property
    def relanded(self) -> Landing:
        """Another landing of both files, to which the first file comes a second time with fewer rows."""
        landing = Landing(self.spark, f"{self.root}/relanded")
        with own_scratch(self.spark, "relanding"):
            rows = written(star_feed.feed(self.spark, self.sf_dir), "feed")
            landing.load(rows, star_feed.CSV_TIME, [star_feed.CSV_FILE, star_feed.JSON_FILE])
            again = rows.filter((F.col("_source_file") == star_feed.CSV_FILE) & ~is_blank(F.col("application_id")))
            landing.load(again, star_feed.JSON_TIME, [star_feed.CSV_FILE])
        return landing

    @cached_property
    def from_files(self) -> Landing:
        """A landing of the feed's raw files: packed CSV of two layouts, packed JSON lines, and files that lack columns; loaded twice.
        The feed goes when its raw files are there, and they go when they are landed."""
        raw = f"{self.root}/raw"
        with own_scratch(self.spark, "raw-files"):
            rows = written(star_feed.feed(self.spark, self.sf_dir), "feed")
            is_csv, other_layout = F.col("_source_file") == star_feed.CSV_FILE, F.pmod(F.xxhash64("applicant_id"), F.lit(2)) == 1
            cells = [F.col(c) for c in schemas.SOURCE_COLUMNS]

            def to_csv(part: DataFrame, name: str) -> None:
                keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
                part.write.options(header=True, escape='"', compression="gzip", **keep_blanks).csv(f"{raw}/core/{name}")

            to_csv(rows.filter(is_csv & ~other_layout).select(cells), "a")
            to_csv(rows.filter(is_csv & other_layout).select(F.lit("more").alias("extra"), *reversed(cells)), "b")
            to_csv(self.table("region"), "c")
            rows.filter(~is_csv).select(cells).write.options(ignoreNullFields=False, compression="gzip").json(f"{raw}/broker/a")
            self.table("nation").write.json(f"{raw}/broker/b")
        sources = [
            Source("core", "csv", f"{raw}/core/*/part-*.csv*", one_record_per_line=True),
            Source("broker", "json", f"{raw}/broker/*/part-*.json*", one_record_per_line=True),
        ]
        landing = Landing(self.spark, f"{self.root}/from-files")
        with own_scratch(self.spark, "ingestion"):
            for time in (star_feed.CSV_TIME, star_feed.JSON_TIME):
                ingest(self.spark, sources, landing, time)
        files.delete(self.spark, raw)
        return landing

    @cached_property
    def bronze(self) -> DataFrame:
        return self.landing.bronze()

    @cached_property
    def checked(self) -> DataFrame:
        return written(C.checked(self.bronze, self.rules), "checked")

    @cached_property
    def kept(self) -> DataFrame:
        return C.split_rejects(self.checked)[0]

    @cached_property
    def transformed(self) -> load.TransformCounts:
        return load.refresh_silver(self.warehouse, self.bronze, self.rules, "run-1")

    @cached_property
    def silver(self) -> DataFrame:
        assert self.transformed
        return self.warehouse.read(load.SILVER)

    @cached_property
    def rejects(self) -> DataFrame:
        assert self.transformed
        return self.warehouse.read(load.REJECTS)

    @cached_property
    def star(self) -> Star:
        load_gold(self.warehouse, self.silver, self.rules, "run-1", star_feed.JSON_TIME)
        return Star.load(self.warehouse)

    @cached_property
    def breakdowns(self) -> Breakdowns:
        return Breakdowns.of(self.star)

    @property
    def plain_documents(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").cast("string").alias("document"), "text")

    @cached_property
    def index(self):
        """(index of all documents, its encoder)."""
        index, encoder = ask.build_index(self.plain_documents)
        return written(index, "index"), encoder

    @cached_property
    def first_delivery(self) -> Warehouse:
        """A warehouse that has seen only the first file."""
        early = Warehouse(self.spark, f"{self.root}/incremental")
        bronze = self.bronze.filter(F.col("_source_file") == star_feed.CSV_FILE)
        load.refresh_silver(early, bronze, self.rules, "run-1")
        load_gold(early, early.read(load.SILVER), self.rules, "run-1", star_feed.CSV_TIME)
        return early

    @cached_property
    def first_dims(self) -> dict[str, DataFrame]:
        """Dimensions as of the first delivery; later versions go to other folders."""
        return D.load_dims(self.first_delivery)

    @cached_property
    def classified(self) -> DataFrame:
        """Change type of every application when the second file arrives, before it is loaded."""
        assert self.first_dims
        known = self.first_delivery.fact(with_month=True)
        result = I.classify(I.with_row_hash(self.silver), known).select("application_id", "change_type")
        return written(result, "classified")

    @cached_property
    def second_delivery(self) -> Star:
        """The same warehouse after both files."""
        assert self.classified is not None
        load_gold(self.first_delivery, self.silver, self.rules, "run-2", star_feed.JSON_TIME)
        return Star.load(self.first_delivery)
