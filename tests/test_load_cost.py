"""What the load chain spends on a row, on rows of its own."""

from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loanmill import schemas
from loanmill.functions import text as X
from loanmill.operators import cleansing as C
from loanmill.operators import dimensions as D
from loanmill.session import configure, written
from loanmill.sources import feeds, star_feed


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.mark.parametrize("column, cells", [
    ("loan_amount", [("12", 12.0), ("-0.5", -0.5), ("+7.", 7.0), ("1.5E7", 1.5e7), ("2E-3", 2e-3), ("", None), (None, None)]),
    ("loan_term_months", [("360", 360), ("007", 7), ("", None)]),
    ("updated_timestamp", [
        ("2023-11-05", datetime(2023, 11, 5)), ("2023-11-05T06:07", datetime(2023, 11, 5, 6, 7)), ("2023-11-05 06:07:08", datetime(2023, 11, 5, 6, 7, 8)),
        ("2023-02-30", None), ("2023-11-05T24:07", None),
    ]),
])
def test_usual_text_is_read_by_the_cast_alone(bronze, monkeypatch, column, cells):
    def refuse(kind):
        return lambda text: F.raise_error(text).cast(kind)

    for name, kind in (("number_of", "double"), ("integer_of", "int"), ("timestamp_of", "timestamp_ntz")):
        monkeypatch.setattr(X, name, refuse(kind))
    rows = C.parse_types(bronze(*[{column: raw} for raw, _ in cells]).select("application_id", column, *[
        F.lit(None).cast("string").alias(c) for c in schemas.SOURCE_COLUMNS if c not in ("application_id", column)
    ])).collect()
    assert [r[column] for r in rows] == [value for _, value in cells]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\x85", " ", " "])
def test_white_space_behind_usual_text_is_still_stripped(bronze, end):
    cells = {"loan_amount": f"12.5{end}", "loan_term_months": f"36{end}", "updated_timestamp": f"2023-11-05{end}"}
    (row,) = C.parse_types(bronze(cells)).collect()
    assert (row["loan_amount"], row["loan_term_months"], row["updated_timestamp"]) == (12.5, 36, datetime(2023, 11, 5))


def test_names_do_not_travel_with_the_lines(spark, tmp_path):
    from test_star_feed import TABLES

    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = plan(star_feed.feed(spark, str(tmp_path))).split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    (at,) = [k for k, line in enumerate(lines) if "Join Inner, (l_orderkey" in line]
    below = lines[at + 1 :]
    below = "".join(below[: next((k for k, line in enumerate(below) if depth(line) <= depth(lines[at])), len(below))])
    assert "o_orderkey" in below and not any(name in below for name in ("s_name", "n_name", "r_name"))


def test_descriptor_keys_are_found_without_multiplying_rows(silver):
    rows = silver({"lender": "A"}, {"lender": "A"}, {"lender": None}, {"loan_term_months": None})
    keys = D.natural_keys(rows)
    assert "Generate" not in plan(keys) and "Expand" not in plan(keys)
    found = keys.collect()
    assert len(found) == len(set(found)) and {r["dim"] for r in found} == {d.table for d in D.SMALL}
    assert not any(r["k1"] is None or (r["k2"] is None and r["dim"] != "dim_lender") for r in found)


def test_counts_by_file_do_not_sort_the_rows(spark, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(feeds, "written", lambda df, label: plans.append(plan(df, "executedPlan")) or written(df, label))
    cells = [F.lit("1").alias(c) for c in schemas.SOURCE_COLUMNS]
    rows = spark.range(5).select(*cells, F.when(F.col("id") < 2, "a.csv").otherwise("b.csv").alias("_source_file"))
    batch = feeds.Landing(spark, str(tmp_path / "bronze")).stage(rows, datetime(2024, 1, 1))
    assert "SortAggregate" not in plans[0]
    assert {tuple(r) for r in batch.counts.select("file_key", "file", "loaded").collect()} == {("a.csv", "a.csv", 2), ("b.csv", "b.csv", 3)}


def test_tables_are_written_with_the_tighter_codec(spark):
    configure(spark)
    (path,) = written(spark.range(10).coalesce(1), "codec").inputFiles()
    assert pq.ParquetFile(path.removeprefix("file://")).metadata.row_group(0).column(0).compression == "ZSTD"
