from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from loanmill import schemas
from loanmill.functions.hashing import fingerprint
from loanmill.operators import dimensions as D
from loanmill.operators.incremental import load_gold
from loanmill.plans import load
from loanmill.plans import questions as Q
from loanmill.plans.star import Star
from loanmill.sources import audit, files
from loanmill.sources.tables import MONTH, Warehouse


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path))


def counts(result):
    return result.rows_new, result.rows_updated, result.rows_unchanged


def test_calendar_end_is_exclusive(spark):
    days = D.dim_date(spark, date(2018, 1, 1), date(2026, 12, 31)).orderBy("date_key").collect()
    assert (len(days), days[0]["date_key"], days[-1]["date_key"]) == (3286, 20180101, 20261230)
    monday = days[0]
    assert (monday["day_of_week"], monday["day_name"], monday["month_name"], monday["year_month"], monday["quarter"]) == (1, "Monday", "January", "2018-01", 1)


def test_first_load_then_rerun_then_mixed_batch(warehouse, silver, rules):
    assert counts(load_gold(warehouse, silver({"application_id": "A-1"}, {"application_id": "A-2", "application_status": "Denied"}), rules, "run-1")) == (2, 0, 0)
    assert counts(load_gold(warehouse, silver({"application_id": "A-1"}, {"application_id": "A-2", "application_status": "Denied"}), rules, "run-2")) == (0, 0, 2)
    assert warehouse.fact().count() == 2
    mixed = silver(
        {"application_id": "A-1"}, {"application_id": "A-2", "application_status": "Withdrawn"},
        {"application_id": "A-3", "application_status": "Incomplete", "applicant_id": "P-2", "lender": "Second"},
    )
    assert counts(load_gold(warehouse, mixed, rules, "run-3")) == (1, 1, 1)
    assert {r["application_id"]: r["application_status"] for r in warehouse.fact().collect()} == {
        "A-1": "Approved", "A-2": "Withdrawn", "A-3": "Incomplete"
    }
    log = {r["run_id"]: r for r in audit.log_of(warehouse).collect()}
    assert (log["run-1"]["status"], log["run-1"]["rows_new"], log["run-1"]["rows_updated"], log["run-1"]["rows_unchanged"]) == ("SUCCESS", 2, 0, 0)
    latest = audit.latest_run(audit.log_of(warehouse)).collect()
    assert [(r["run_id"], r["stage"]) for r in latest] == [("run-3", "dimensional_load")]


def test_update_can_move_to_another_month_and_leave_one_empty(warehouse, silver, rules):
    load_gold(warehouse, silver({"application_id": "A-1"}, {"application_id": "A-2", "application_date": datetime(2024, 5, 1)}), rules, "run-1")
    moved = silver(
        {"application_id": "A-1", "application_date": datetime(2024, 4, 2), "loan_amount": 1.0},
        {"application_id": "A-2", "application_date": datetime(2024, 5, 1)},
    )
    assert counts(load_gold(warehouse, moved, rules, "run-2")) == (0, 1, 1)
    assert sorted((r["application_id"], r[MONTH]) for r in warehouse.fact(with_month=True).collect()) == [("A-1", "2024-04"), ("A-2", "2024-05")]


def test_only_hash_columns_make_an_update_and_absent_rows_stay(warehouse, silver, rules):
    load_gold(warehouse, silver({"application_id": "A-1"}, {"application_id": "A-2"}), rules, "run-1")
    assert counts(load_gold(warehouse, silver({"application_id": "A-1", "lender": "Other", "property_county": "X"}), rules, "run-2")) == (0, 0, 1)
    assert counts(load_gold(warehouse, silver({"application_id": "A-1", "source_file": "two.csv"}), rules, "run-3")) == (0, 1, 0)
    assert warehouse.fact().count() == 2


def test_missing_dimension_key_is_left_out_and_counted(warehouse, silver, rules):
    rows = silver({"application_id": "A-1"}, {"application_id": "A-2", "lender": None}, {"application_id": "A-3", "loan_term_months": None})
    result = load_gold(warehouse, rows, rules, "run-1")
    assert (counts(result), result.rows_rejected) == ((1, 0, 0), 2)
    assert sorted(r["application_id"] for r in D.unresolvable(rows).collect()) == ["A-2", "A-3"]


def test_failed_load_is_logged_and_raised(warehouse, silver, rules):
    with pytest.raises(Exception):
        load_gold(warehouse, silver({}).drop("lender"), rules, "run-1")
    assert [(r["status"], r["error_message"] is not None) for r in audit.log_of(warehouse).collect()] == [("FAILED", True)]


def test_dimension_keys_stay_and_grow_densely(spark, warehouse, silver, rules):
    first = silver(*[{"application_id": str(i), "applicant_id": f"P-{i % 40}", "lender": f"L-{i % 7}"} for i in range(80)])
    before = {r["applicant_id"]: r["applicant_key"] for r in D.refresh_dims(warehouse, first, rules)["dim_applicant"].collect()}
    assert sorted(before.values()) == list(range(1, 41))
    more = silver(*[{"application_id": str(i), "applicant_id": f"P-{i}", "income_band": "250K+"} for i in range(30, 60)])
    dims = D.refresh_dims(warehouse, more, rules)
    after = {r["applicant_id"]: r for r in dims["dim_applicant"].collect()}
    assert sorted(r["applicant_key"] for r in after.values()) == list(range(1, 61))
    assert all(after[i]["applicant_key"] == key for i, key in before.items())
    assert (after["P-1"]["income_band"], after["P-35"]["income_band"], after["P-59"]["income_band"]) == ("50K-100K", "250K+", "250K+")
    assert sorted(r["lender_key"] for r in dims["dim_lender"].collect()) == list(range(1, 9))
    third = silver({"application_id": "x", "lender": "L-1"}, {"application_id": "y", "lender": "new"}, {"application_id": "z", "lender": None})
    grown = D.refresh_dims(warehouse, third, rules)["dim_lender"]
    assert grown.count() == 9 and grown.agg(F.max("lender_key")).first()[0] == 9


def test_calendar_spans_all_of_silver(warehouse, silver, rules):
    days = [datetime(2017, 12, 31), datetime(2024, 3, 15), datetime(2027, 1, 5)]
    rows = silver(*[{"application_id": str(k), "application_date": day} for k, day in enumerate(days)])
    assert load_gold(warehouse, rows, rules, "r1").rows_rejected == 0
    star = Star.load(warehouse)
    assert star.joined().count() == star.fact.count() == 3
    load_gold(warehouse, silver({"application_id": "9", "application_date": datetime(2030, 5, 5)}), rules, "r2")
    star = Star.load(warehouse)
    assert star.joined().count() == 4 and star.dims["dim_date"].groupBy("date_key").count().filter("count > 1").isEmpty()


def test_a_load_that_fails_changes_nothing_and_can_be_repeated(warehouse, silver, rules, monkeypatch):
    at = lambda month, **more: silver({"application_id": "A", "application_date": datetime(2024, month, 1), **more})
    load_gold(warehouse, at(3), rules, "r1")
    monkeypatch.setattr(files, "write_text", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        warehouse.replace_months(["2024-03"], warehouse.fact(with_month=True).limit(0))
    monkeypatch.undo()
    assert warehouse.fact().count() == 1
    for month, amount in ((4, 1.0), (5, 2.0), (5, 2.0)):
        load_gold(warehouse, at(month, loan_amount=amount), rules, f"r{month}")
    rows = warehouse.fact(with_month=True).collect()
    assert [(r["application_month"], r["loan_amount"]) for r in rows] == [("2024-05", 2.0)]


def test_stages_know_their_counts_without_counting_jobs(spark, warehouse, bronze, rules, monkeypatch):
    rows = bronze(
        {"application_id": "1", "loan_amount": "-4"}, {"application_id": "2", "applicant_income": ""}, {"application_id": "3"},
        {"application_id": "4", "lender": " "},
    )
    counted = []
    kind = type(rows)
    monkeypatch.setattr(kind, "count", lambda self, f=kind.count: counted.append(self) or f(self))
    as_of = datetime(2024, 6, 1)
    done = load.refresh_silver(warehouse, rows, rules, "r1")
    assert (done.rows_read, done.rows_rejected, done.rows_written, done.rows_flagged) == (4, 1, 3, 1)
    stored = warehouse.read(load.SILVER)
    first = load_gold(warehouse, stored, rules, "r1", as_of)
    changed = stored.withColumn("loan_amount", F.when(F.col("application_id") == "3", 7000.0).otherwise(F.col("loan_amount")))
    extra = changed.unionByName(changed.filter("application_id = '3'").withColumn("application_id", F.lit("5")))
    second = load_gold(warehouse, extra, rules, "r2", as_of)
    load.check_quality(warehouse, rows, rules, "r2", as_of)
    assert (first.rows_read, first.rows_new, first.rows_rejected) == (3, 2, 1)
    assert (second.rows_read, second.rows_new, second.rows_updated, second.rows_unchanged, second.rows_rejected) == (4, 1, 1, 1, 1)
    assert not counted
    logged = {r["stage"]: r["rows_read"] for r in audit.log_of(warehouse).filter("run_id = 'r2'").collect()}
    assert logged == {"dimensional_load": 4, "data_quality": 3}


def test_latest_attributes_prefer_missing_update_time(silver):
    rows = silver(
        {"application_id": "1", "income_band": "a", "updated_timestamp": None},
        {"application_id": "2", "income_band": "b"},
        {"application_id": "3", "applicant_id": None},
    )
    assert [tuple(r) for r in D.latest_attributes(rows).collect()] == [("P-1", "a", "700-739")]


def test_fingerprint_keeps_nulls_neighbours_and_microseconds_apart(spark):
    rows = spark.createDataFrame(
        [(None, "a", None), ("a", None, None), ("", "a", None), ("1:a", "", None), ("1", "a", None),
         ("x", "x", datetime(2024, 1, 1)), ("x", "x", datetime(2024, 1, 1, 0, 0, 0, 1))],
        "a string, b string, t timestamp_ntz",
    )
    assert rows.select(fingerprint(rows, rows.columns).alias("f")).distinct().count() == 7


def test_state_extremes_need_enough_applications(warehouse, silver, rules):
    rows = [{"application_id": f"TX-{i}", "approval_indicator": i % 2} for i in range(6)]
    rows += [{"application_id": f"FL-{i}", "property_state": "FL"} for i in range(3)]
    rows += [{"application_id": "NY-1", "property_state": "NY", "approval_indicator": 0}]
    load_gold(warehouse, silver(*rows), rules, "run-1")
    result = Q.q02_state_extremes(Star.load(warehouse), rules.with_(min_state_applications=3)).collect()
    assert [(r["property_state"], r["approval_rate_pct"], r["category"]) for r in result] == [("FL", 100.0, "Top 5 highest"), ("TX", 50.0, "Top 5 highest")]


def test_silver_schema_matches_contract(silver):
    assert silver({}).columns == list(schemas.SILVER_COLUMNS)


def test_question_runner_goes_on_after_a_failure(warehouse, silver, bronze, rules):
    load_gold(warehouse, silver({}), rules, "r1")
    answers = Q.run_questions(Star.load(warehouse), bronze({}).drop("lender"), rules)
    assert [name for name, _, _ in answers] == [f"q{k:02d}" for k in range(1, 11)]
    assert [name for name, rows, error in answers if error] in ([], ["q09"]) and answers[0][1][0]["total_applications"] == 1


def test_a_first_load_forms_hashes_behind_its_last_exchange(spark, warehouse, silver, rules, monkeypatch):
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plans, replace = [], Warehouse.replace_months

    def seen(self, months, rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        replace(self, months, rows)

    monkeypatch.setattr(Warehouse, "replace_months", seen)
    rows = silver({"application_id": "A-1"}, {"application_id": "A-2", "updated_timestamp": None})
    load_gold(warehouse, rows, rules, "run-1")
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    above, below = plans[0].split("RebalancePartitions")
    assert "sha2" in above and "sha2" not in below
    expected = {tuple(r) for r in rows.select("application_id", fingerprint(rows, schemas.HASH_COLUMNS)).collect()}
    assert {tuple(r) for r in warehouse.fact().select("application_id", "row_hash").collect()} == expected
