from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from loanmill import schemas
from loanmill.operators import profiling, quality
from loanmill.operators.incremental import load_gold
from loanmill.plans import portfolio
from loanmill.plans.portfolio import PortfolioFilter, ViewFilter
from loanmill.plans.star import Star
from loanmill.session import own_scratch, scratch_path, side_by_side, written
from loanmill.sources import files
from loanmill.sources.tables import KEPT_VERSIONS, Warehouse

FACT = (
    "application_id string, application_date timestamp_ntz, loan_amount double, applicant_income double, "
    "property_value double, loan_product_key bigint, application_status string, debt_to_income_ratio double, "
    "loan_to_value_ratio double, applicant_key bigint, property_key bigint, lender_key bigint, date_key int"
)
GOOD = [
    ("A-1", datetime(2024, 1, 1), 250000.0, 85000.0, 310000.0, 1, "Approved", 0.3, 0.8, 1, 1, 1, 20240101),
    ("A-2", datetime(2024, 2, 1), 180000.0, 60000.0, 220000.0, 1, "Denied", 0.35, 0.75, 1, 1, 1, 20240101),
]
AS_OF = datetime(2024, 6, 1)


@pytest.fixture
def check(spark, rules):
    def run(position=None, rejected=0, bronze=20, silver_ids=("A-1", "A-2"), **changes):
        names = [part.split()[0] for part in FACT.split(", ")]
        second = tuple(changes.get(n, v) for n, v in zip(names, GOOD[1]))
        fact = spark.createDataFrame([GOOD[0], second], FACT)
        keys = {"dim_applicant": "applicant_key", "dim_property": "property_key", "dim_lender": "lender_key", "dim_loan_product": "loan_product_key"}
        dims = {dim: spark.createDataFrame([(1,)], f"{key} bigint") for dim, key in keys.items()}
        dims["dim_date"] = spark.createDataFrame([(20240101,)], "date_key int")
        silver = spark.createDataFrame([(i,) for i in silver_ids], "application_id string")
        rows = quality.quality_checks(fact, silver, spark.range(bronze), spark.range(rejected), dims, rules, AS_OF)
        found = {r["position"]: (r["passed"], r["details"]) for r in rows.collect()}
        assert len(found) == 10
        return found if position is None else found[position]

    return run


def test_good_fact_passes_all(check):
    found = check()
    assert all(passed for passed, _ in found.values())
    assert found[9][1] == "silver=2, fact=2 (match)"
    assert found[10][1] == "rejected 0/20 (0.00%), threshold 15%"


@pytest.mark.parametrize("position, change, details", [
    (2, {"loan_amount": None}, "null counts: {'loan_amount': 1}"),
    (3, {"application_id": "A-1"}, "1 duplicate application_id(s) found"),
    (4, {"application_date": datetime(2015, 1, 1)}, "1 row(s) outside [2018-01-01, 2024-06-02]"),
    (4, {"application_date": datetime(2024, 6, 3)}, "1 row(s) outside [2018-01-01, 2024-06-02]"),
    (5, {"application_status": "Unheard-Of"}, "1 row(s) with unrecognized status"),
    (5, {"application_status": None}, "1 row(s) with unrecognized status"),
    (6, {"loan_amount": -1.0}, "1 row(s) with non-positive financial values"),
    (7, {"debt_to_income_ratio": 1.5}, "1 row(s) with out-of-range DTI/LTV"),
    (8, {"lender_key": 9, "date_key": 20250101}, "2 orphaned fact row reference(s)"),
    (8, {"property_key": None}, "1 orphaned fact row reference(s)"),
    (9, {"silver_ids": ("A-1", "A-2", "A-3")}, "MISMATCH: silver=3, fact=2"),
    (10, {"rejected": 4}, "rejected 4/20 (20.00%), threshold 15%"),
])
def test_each_check_fails_on_its_defect(check, position, change, details):
    assert check(position, **change) == (False, details)


def test_missing_column_is_reported(check, spark, rules):
    found = check(1)
    assert found == (True, "all required columns present")
    fact = spark.createDataFrame(GOOD, FACT).drop("application_status").withColumn("application_status", F.lit("Denied")).drop("loan_product_key")
    assert "null_loan_product_key" not in quality.fact_measures(fact, rules, AS_OF).columns


def test_rollup_and_report(spark):
    checks = spark.createDataFrame([(1, "a", True, "x"), (2, "b", False, "y")], "position int, name string, passed boolean, details string")
    assert tuple(quality.rollup(checks).first()) == ("FAIL", 1, 2)
    row = quality.report(checks, AS_OF).first()
    assert (row["generated_at"], [c["name"] for c in row["checks"]]) == (AS_OF, ["a", "b"])


def test_profile_and_concerns(bronze):
    df = bronze(
        {"loan_amount": "$1,000.50", "application_date": "2024-01-05"}, {"loan_amount": "n/a", "denial_reason": " "},
        {"loan_amount": "500", "application_date": "13/45/2024", "denial_reason": "x"}, {"loan_amount": "500", "application_date": "13/45/2024", "denial_reason": "x"},
    )
    profiled = profiling.profile(df)
    rows = {r["column_name"]: r for r in profiled.collect()}
    assert len(rows) == 20 and [rows[c]["position"] for c in ("application_id", "updated_timestamp")] == [1, 20]
    loan, day, reason = rows["loan_amount"], rows["application_date"], rows["denial_reason"]
    assert (loan["null_count"], loan["distinct_count"], loan["invalid_value_count"], loan["min_number"], loan["max_number"]) == (0, 3, 1, 500.0, 1000.5)
    assert loan["mean"] == pytest.approx(2000.5 / 3)
    assert (day["invalid_value_count"], day["min"], day["max"]) == (2, "2024-01-05 00:00:00", "2024-03-15 00:00:00")
    assert (reason["null_count"], reason["null_pct"], reason["distinct_count"], reason["invalid_value_count"]) == (2, 50.0, 2, 0)
    counts = profiling.row_counts(df)
    assert tuple(counts.first()) == (4, 1)
    assert {r["concern"] for r in profiling.concerns(profiled, counts).collect()} == {
        "1 exact duplicate row(s) found.", "Column 'loan_amount' has 1 value(s) that fail type validation.",
        "Column 'application_date' has 2 value(s) that fail type validation.", "Column 'denial_reason' has 50.0% missing values.",
    }


def test_filters_reject_unknown_values(rules):
    PortfolioFilter(state=" tx ", lender="anything", loan_type="FHA", status="Denied").check(rules)
    for bad in ({"state": "ZZ"}, {"loan_type": "Jumbo"}, {"status": "Pending"}):
        with pytest.raises(ValueError):
            PortfolioFilter(**bad).check(rules)


def test_view_filter_is_inclusive_and_optional(spark):
    view = spark.createDataFrame(
        [("TX", "2024-01-01"), ("TX", "2024-01-31"), ("FL", "2024-01-15"), ("TX", "2024-02-01")], "property_state string, d string"
    ).select("property_state", F.to_date("d").alias("application_date"))
    assert ViewFilter().apply(view).count() == 4
    chosen = ViewFilter(start=date(2024, 1, 1), end=date(2024, 1, 31), states=("TX",))
    assert chosen.apply(view).count() == 2
    assert tuple(portfolio.match_counts(view, chosen).first()) == (2, 4)


def test_sketch_profile_is_exact_but_for_its_labelled_distinct_counts(spark, bronze):
    rows = bronze({"lender": ""}, {"lender": None}, {"lender": "  "}, {"loan_amount": "$1,000"}, {"loan_amount": "x", "application_date": "13/13/2024"})
    many = spark.range(60_000).select(
        *[(F.col("id") % 20_011).cast("string").alias(c) if c == "application_id" else F.lit(None).cast("string").alias(c) for c in schemas.SOURCE_COLUMNS]
    )
    for frame, merged in ((rows, False), (rows, True), (many, False), (many, True)):
        if merged:
            halves = [frame.filter(F.pmod(F.hash(*frame.columns[:3]), F.lit(2)) == k) for k in (0, 1)]
            got = profiling.merge_profiles(profiling.sketch_profile(halves[0]).unionByName(profiling.sketch_profile(halves[1])))
        else:
            got = profiling.sketch_profile(frame)
        got, exact = ({r["column_name"]: r for r in p.collect()} for p in (got, profiling.profile(frame)))
        assert set(got) == set(exact)
        for name, r in exact.items():
            for field in ("position", "record_count", "null_count", "null_pct", "invalid_value_count", "min_number", "max_number"):
                assert got[name][field] == r[field], (name, field)
            assert got[name]["distinct_is_approximate"] and abs(got[name]["distinct_count"] - r["distinct_count"]) <= 0.05 * r["distinct_count"]


def test_all_breakdowns_come_from_one_scan_before_any_join(spark, tmp_path, silver, rules):
    rows = [{"application_id": str(k), "property_state": "TX" if k % 3 else "FL", "property_county": f"c{k % 4}", "lender": f"l{k % 5}", "approval_indicator": k % 2,
             "loan_amount": 1000.0 * k if k else None, "application_status": None if k == 7 else "Approved"} for k in range(24)]
    warehouse = Warehouse(spark, f"{tmp_path}/lake")
    load_gold(warehouse, silver(*rows), rules, "r1")
    star = Star.load(warehouse)
    plans = []

    def spied(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, label)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(portfolio, "written", spied)
        all_of = portfolio.Breakdowns.of(star)
    assert len(plans) == 1 and plans[0].count("Scan parquet") == 1 and "Expand" in plans[0] and "Join" not in plans[0]
    view = star.portfolio_view()

    def same(a, b):
        order = lambda r: tuple(str(x) for x in r)
        assert sorted((tuple(r) for r in a.select(*b.columns).collect()), key=order) == sorted((tuple(r) for r in b.collect()), key=order)

    same(all_of.by_state(), portfolio.by_state(view))
    same(all_of.by_lender(), portfolio.by_lender(view))
    same(all_of.by_product(), portfolio.by_product(view))
    same(all_of.filter_domains(), portfolio.filter_domains(view))


def test_a_stated_number_of_versions_is_kept(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/lake")
    frames = [warehouse.write("t", spark.range(k)) for k in range(1, 6)]
    assert [f.count() for f in frames[-KEPT_VERSIONS:]] == [3, 4, 5] and warehouse.read("t").count() == 5
    assert sum(p.is_dir() for p in (tmp_path / "lake" / "t").iterdir()) == KEPT_VERSIONS
    with own_scratch(spark, "run-x"):
        written(spark.range(3), "some").count()
        side_by_side(lambda: written(spark.range(3), "more"))
        folder = scratch_path(spark, "x").rsplit("/", 1)[0]
        assert folder.endswith("run-x") and len(files.glob(spark, f"{folder}/*")) == 2
    assert not files.exists(spark, folder) and "run-x" not in scratch_path(spark, "x")
