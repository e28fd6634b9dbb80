"""What the load chain leaves on disk, on rows of its own."""

import gzip
from datetime import datetime
from time import sleep

from pyspark import SparkContext
from pyspark.sql import functions as F

from loanmill import schemas
from loanmill.functions.hashing import fingerprint
from loanmill.operators import incremental as I
from loanmill.operators.incremental import load_gold
from loanmill.plans import lake as lake_module
from loanmill.plans import load
from loanmill.plans.lake import Lake
from loanmill.session import configure, own_scratch, scratch_path
from loanmill.sources import feeds, files, star_feed
from loanmill.sources.tables import Warehouse
from test_star_feed import TABLES


def scratch_left(spark):
    """Intermediate tables of the application, without those of warehouses and landings."""
    return {files.name_of(p) for p in files.glob(spark, f"{scratch_path(spark, 'x').rsplit('/', 1)[0]}/*")}


def shuffle_files():
    manager = SparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(manager.getAllFiles().apply(k).getName().startswith("shuffle_") for k in range(manager.getAllFiles().length()))


def test_files_of_an_exchange_go_with_its_job(spark, tmp_path):
    configure(spark)
    frame = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k")).repartition(3, "k")
    before = shuffle_files()
    frame.write.parquet(str(tmp_path / "out"))
    for _ in range(50):  # files are removed beside the driver's work
        if shuffle_files() <= before:
            break
        sleep(0.1)
    assert shuffle_files() <= before
    assert frame.count() == 1000 and len(frame.collect()) == len(frame.collect()) == 1000


def test_stages_of_the_load_leave_no_intermediate_tables(spark, tmp_path, bronze, rules):
    warehouse, before = Warehouse(spark, str(tmp_path)), scratch_left(spark)
    load.refresh_silver(warehouse, bronze({"application_id": "1"}, {"application_id": "2", "loan_amount": "-4"}), rules, "r1")
    for run in ("r1", "r2"):
        rows = warehouse.read(load.SILVER).withColumn("loan_amount", F.lit(5.0 if run == "r1" else 6.0))
        load_gold(warehouse, rows, rules, run)
    assert (warehouse.read(load.SILVER).count(), warehouse.read(load.REJECTS).count(), warehouse.fact().first()["loan_amount"]) == (1, 1, 6.0)
    assert scratch_left(spark) == before


def test_a_scratch_folder_within_another_goes_with_it(spark):
    with own_scratch(spark, "outer"), own_scratch(spark, "inner"):
        folder = scratch_path(spark, "x").rsplit("/", 1)[0]
    assert folder.endswith("/outer/inner")


def changed_plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_later_load_forms_hashes_behind_its_exchanges(spark, tmp_path, silver, rules):
    warehouse = Warehouse(spark, str(tmp_path))
    first = silver({"application_id": "A-1"}, {"application_id": "A-2"}, {"application_id": "A-3"})
    load_gold(warehouse, first, rules, "run-1")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    found = changed_plan(I.classify(first, warehouse.fact(with_month=True)))
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    above, below = found.split("Join LeftOuter")
    assert "sha2" in above and "sha2" not in below
    second = silver({"application_id": "A-1"}, {"application_id": "A-2", "loan_amount": 1.0}, {"application_id": "A-4", "applicant_id": None}, {"application_id": "A-5"})
    done = load_gold(warehouse, second, rules, "run-2")
    assert (done.rows_new, done.rows_updated, done.rows_unchanged, done.rows_rejected) == (1, 1, 1, 1)
    expected = {tuple(r) for rows in (first, second) for r in rows.select("application_id", fingerprint(rows, schemas.HASH_COLUMNS)).collect()}
    stored = {tuple(r) for r in warehouse.fact().select("application_id", "row_hash").collect()}
    assert stored <= expected and {i for i, _ in stored} == {"A-1", "A-2", "A-3", "A-5"} and len(stored) == 4


def test_only_replaced_ids_meet_the_stored_rows(spark, tmp_path, silver, rules, monkeypatch):
    warehouse, seen = Warehouse(spark, str(tmp_path)), []
    rows = lambda amounts: silver(*[{"application_id": f"A-{k}", "loan_amount": a} for k, a in amounts.items()])
    load_gold(warehouse, rows({1: 1.0, 2: 1.0}), rules, "run-1")
    written = I.written
    monkeypatch.setattr(I, "written", lambda df, label: seen.append({r[0] for r in df.collect()}) or written(df, label))
    load_gold(warehouse, rows({2: 2.0, 3: 3.0}), rules, "run-2")
    assert seen == [{"A-2"}, {"A-1"}]
    assert {r["application_id"]: r["loan_amount"] for r in warehouse.fact().collect()} == {"A-1": 1.0, "A-2": 2.0, "A-3": 3.0}


def tables(spark, path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")


def test_raw_files_are_packed_and_go_once_they_are_landed(spark, tmp_path, monkeypatch):
    tables(spark, tmp_path)
    lake, seen, ingest = Lake(spark, str(tmp_path)), [], feeds.ingest

    def listed(spark, sources, *more):
        seen.append([[files.name_of(p) for p in files.glob(spark, s.pattern)] for s in sources])
        return ingest(spark, sources, *more)

    monkeypatch.setattr(lake_module, "ingest", listed)
    before = scratch_left(spark)
    landing = lake.from_files
    assert len(seen) == 2 and seen[0] == seen[1] and all(seen[0])
    small = {"c", "b"}  # region and nation, which lack columns
    assert sum(not n.endswith(".gz") for names in seen[0] for n in names) <= 2 * len(small)
    assert landing.bronze().count() + landing.quarantine().count() == star_feed.feed(spark, str(tmp_path)).count() > 0
    assert not files.exists(spark, f"{lake.root}/raw") and scratch_left(spark) - before <= {files.name_of(lake.root)}


def test_the_header_of_a_packed_file_is_read(spark, tmp_path):
    names = [*reversed(schemas.SOURCE_COLUMNS)]
    (tmp_path / "core").mkdir()
    for name in ("1", "2"):
        with gzip.open(tmp_path / "core" / f"{name}.csv.gz", "wt") as out:
            out.write(",".join(names) + "\n" + ",".join(f"{c}-{name}" for c in names) + "\n")
    assert files.head(spark, f"{tmp_path}/core/1.csv.gz", 14).decode() == ",".join(names)[:14]
    landing = feeds.Landing(spark, f"{tmp_path}/bronze")
    found = feeds.ingest(spark, [feeds.Source("core", "csv", f"{tmp_path}/core/*.csv.gz")], landing, datetime(2024, 1, 1))
    assert (found.loaded, found.rejected, found.skipped) == (2, 0, 0)
    assert {(r["application_id"], r["lender"]) for r in landing.bronze().collect()} == {("application_id-1", "lender-1"), ("application_id-2", "lender-2")}
