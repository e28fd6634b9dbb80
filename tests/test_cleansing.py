from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loanmill.operators import cleansing as C
from loanmill.operators.derive import derive
from loanmill.operators.medians import counted_values, grouped_median, middle
from loanmill.plans.load import transform


def cleaned(bronze, rules, *rows):
    return C.normalize_categoricals(C.parse_types(bronze(*rows)), rules)


@pytest.mark.parametrize("column, cells", [
    ("lender", [("\t", None), ("", None), (None, None), ("Bank of\nNowhere", "Bank of\nNowhere"), (" x ", " x ")]),
    ("loan_type", [(" \r\n ", None), ("VA", "VA")]),
])
def test_only_blank_cells_become_null(bronze, column, cells):
    rows = C.blank_to_null(bronze(*[{column: raw} for raw, _ in cells])).collect()
    assert [r[column] for r in rows] == [value for _, value in cells]


@pytest.mark.parametrize("column, cells", [
    ("property_value", [("$1,000,000", 1e6), ("7e5", 7e5), ("12 apples", None), ("$", None)]),
    ("loan_term_months", [("180", 180), ("180.0", 180), ("180.5", None)]),
    ("updated_timestamp", [("2023-11-05T06:07:08", datetime(2023, 11, 5, 6, 7, 8)), ("yesterday", None), ("2023-02-30", None)]),
])
def test_cells_are_judged_one_by_one(bronze, column, cells):
    rows = C.parse_types(bronze(*[{column: raw} for raw, _ in cells])).collect()
    assert [r[column] for r in rows] == [value for _, value in cells]


@pytest.mark.parametrize("column, cells", [
    ("property_state", [("ny", "NY"), ("\tDc ", "DC"), ("New York", "NEW YORK")]),
    ("application_status", [("wITHDRAWN", "Withdrawn"), (" denied", "Denied"), ("Pending", None), ("", None), (None, None)]),
])
def test_spellings_are_unified(bronze, rules, column, cells):
    rows = C.normalize_categoricals(bronze(*[{column: raw} for raw, _ in cells]), rules).collect()
    assert [r[column] for r in rows] == [value for _, value in cells]


@pytest.mark.parametrize("change, reason", [
    ({"application_date": "garbage"}, "invalid or unparseable application_date"),
    ({"application_date": None, "loan_amount": "-1"}, "invalid or unparseable application_date"),
    ({"applicant_income": "999.99"}, "applicant_income outside plausible range [1000, 5000000]"),
    ({"loan_amount": "-250000.0", "property_state": "ZZ"}, "loan_amount outside plausible range [1000, 5000000]"),
    ({"loan_amount": "inf"}, "loan_amount outside plausible range [1000, 5000000]"),
    ({"property_value": "10000000.01"}, "property_value outside plausible range [1000, 10000000]"),
    ({"interest_rate": "999.0"}, "interest_rate outside plausible range [0.5, 20.0]"),
    ({"property_state": None}, "unrecognized property_state after normalization"),
    ({"application_status": "Pending"}, "unrecognized application_status after normalization"),
    ({}, None),
    ({"applicant_income": "1000", "loan_amount": "5000000", "interest_rate": "0.5"}, None),
    ({"applicant_income": None, "loan_amount": "", "interest_rate": "x"}, None),
])
def test_first_failing_rule_wins(bronze, rules, change, reason):
    assert C.checked(bronze(change), rules).first()["reject_reason"] == reason


def test_kept_and_rejected_partition_the_input(bronze, rules):
    kept, rejects = C.split_rejects(C.checked(bronze({}, {"loan_amount": "-1"}, {"application_id": "B"}), rules))
    assert kept.count() == 2
    assert [tuple(r) for r in rejects.collect()] == [
        ("A-1", "transformation", "loan_amount outside plausible range [1000, 5000000]")
    ]


def test_ratios_are_clipped_and_flagged(bronze, rules):
    rows = C.checked(bronze(
        {"debt_to_income_ratio": "1.5"}, {"loan_to_value_ratio": "-0.1"}, {"debt_to_income_ratio": ""}, {}
    ), rules).collect()
    assert [(r["debt_to_income_ratio"], r["loan_to_value_ratio"], r["flag_range"]) for r in rows] == [
        (1.0, 0.81, True), (0.32, 0.0, True), (None, 0.81, False), (0.32, 0.81, False)
    ]


def imputed(df, rules):
    kept = C.split_rejects(C.checked(df, rules))[0]
    return {r["application_id"]: r for r in C.impute(kept, C.medians_by_loan_type(kept)).collect()}


def test_medians_fill_by_loan_type_then_overall(bronze, rules):
    known = {"Conventional": (40_000, 60_000, 95_000), "USDA": (71_000,)}
    rows = [{"application_id": f"{kind}{n}", "loan_type": kind, "applicant_income": str(n)} for kind, of in known.items() for n in of]
    gaps = {"c": "Conventional", "u": "USDA", "v": "VA", "none": None}
    filled = imputed(bronze(*rows, *[{"application_id": k, "loan_type": kind, "applicant_income": " "} for k, kind in gaps.items()]), rules)
    # The middle of 40, 60, 71 and 95 thousand serves where a type has no value of its own.
    assert {k: filled[k]["applicant_income"] for k in gaps} == {"c": 60_000.0, "u": 71_000.0, "v": 65_500.0, "none": 65_500.0}
    assert all(filled[k]["flag_missing"] for k in gaps) and not any(r["flag_missing"] for k, r in filled.items() if k not in gaps)


@pytest.mark.parametrize("change, column, value, flagged", [
    ({"application_status": "denied", "denial_reason": " "}, "denial_reason", "Not Specified", True),
    ({"application_status": "denied", "denial_reason": "Collateral"}, "denial_reason", "Collateral", False),
    ({"application_status": "Withdrawn", "denial_reason": ""}, "denial_reason", None, False),
    ({"credit_score_range": None}, "credit_score_range", "Unknown", True),
    ({"property_county": "\t"}, "property_county", "Unknown", True),
])
def test_text_defaults(bronze, rules, change, column, value, flagged):
    row = imputed(bronze(change), rules)["A-1"]
    assert (row[column], row["flag_missing"]) == (value, flagged)


def test_which_version_of_an_application_stays(bronze, rules):
    early, late = datetime(2023, 7, 1), datetime(2023, 8, 1)
    versions = {
        "by update": [("2023-03-01", late, "old"), ("2023-03-02", early, "new")],
        "no update time": [("2023-12-31", late, "old"), (None, early, "new")],
        "by ingestion": [("2023-03-01", early, "old"), ("2023-03-01", late, "new")],
    }
    rows = [
        {"application_id": key, "updated_timestamp": updated, "_ingestion_timestamp": seen, "lender": lender}
        for key, of in versions.items() for updated, seen, lender in of
    ]
    for order in (rows, rows[::-1]):
        latest = C.latest_version(cleaned(bronze, rules, *order)).collect()
        assert {r["application_id"]: r["lender"] for r in latest} == dict.fromkeys(versions, "new")


def test_repeated_rows(bronze, rules):
    df = cleaned(bronze, rules, *[{"application_id": key} for key in "xyxxz"])
    once = C.latest_version(df)
    assert sorted(r["application_id"] for r in once.collect()) == ["x", "y", "z"]
    assert sorted(map(str, C.latest_version(once).collect())) == sorted(map(str, once.collect()))
    assert {r[0]: r[1] for r in C.exact_duplicates(df).collect()} == {"x": 2}


def test_hot_application_is_cut_down_before_the_exchange(bronze, rules):
    plan = C.latest_version(bronze({}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("change, derived", [
    ({"debt_to_income_ratio": "0.43"}, {"dti_band": "43%+"}),
    ({"debt_to_income_ratio": "0.61", "loan_to_value_ratio": "0.2", "credit_score_range": "800+"}, {"high_risk_indicator": 1}),
    ({"debt_to_income_ratio": " ", "loan_to_value_ratio": None}, {"dti_band": None, "ltv_band": None, "high_risk_indicator": 0}),
    ({"credit_score_range": "580-619"}, {"high_risk_indicator": 1}),
    ({"application_status": "incomplete"}, {"approval_indicator": 0, "data_quality_status": "clean"}),
    ({"applicant_income": "249999.99", "loan_amount": "1000000"}, {"income_band": "150K-250K", "loan_amount_band": "1M+"}),
    ({"created_timestamp": "2024-02-27", "updated_timestamp": "2024-03-01T12:00:00"}, {"application_processing_days": 3.5}),
    ({"updated_timestamp": "never"}, {"application_processing_days": None}),
])
def test_derived_values(bronze, rules, change, derived):
    row = derive(cleaned(bronze, rules, change), rules).first()
    assert {name: row[name] for name in derived} == derived


def test_transform_end_to_end(bronze, rules):
    silver, rejects, seen = transform(bronze(
        {"application_id": "1", "loan_amount": "$1,500.00"}, {"application_id": "1", "loan_amount": "-4"},
        {"application_id": "2", "applicant_income": ""},
    ), rules)
    rows = silver.orderBy("application_id").collect()
    assert [(r["application_id"], r["loan_amount"], r["applicant_income"], r["data_quality_status"]) for r in rows] == [
        ("1", 1500.0, 85000.0, "clean"), ("2", 250000.0, 85000.0, "flagged")
    ]
    assert rejects.count() == 1 and seen.get == {"read": 3, "rejected": 1}


def test_large_group_median_equals_built_in(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
        F.when(F.col("id") % 11 != 0, F.round(F.pow(F.lit(1.004), F.col("id")) - 40000, 2)).alias("a"),
        F.when(F.col("id") % 2 == 0, F.lit(7.0)).alias("b"),
    )
    expected = df.groupBy("g").agg(F.median("a").alias("a_median"), F.median("b").alias("b_median"))
    key = lambda r: str(r["g"])
    for ranges in (None, 1, 40):
        assert sorted(grouped_median(df, ["g"], ["a", "b"], ranges).collect(), key=key) == sorted(expected.collect(), key=key)
    alone = df.agg(F.median("a").alias("a_median")).first()[0]
    assert middle(counted_values(df, ["g"], ["a"], 40), ["field"]).first()["median"] == alone
    assert grouped_median(df.filter("false"), ["g"], ["a"]).count() == 0


def test_a_value_shared_by_most_rows_is_counted_once(spark):
    df = spark.range(3000).select(F.lit("one").alias("g"), F.when(F.col("id") % 3 > 0, 5.0).otherwise(F.col("id").cast("double")).alias("a"))
    counts = counted_values(df, ["g"], ["a"])
    assert counts.count() == 1001 and counts.agg(F.sum("n")).first()[0] == 3000
    assert grouped_median(df, ["g"], ["a"]).first()["a_median"] == 5.0
