from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from loanmill import schemas
from loanmill.rules import Rules
from loanmill.session import configure

BRONZE_ROW = {
    "application_id": "A-1", "application_date": "2024-03-15T00:00:00", "applicant_id": "P-1",
    "applicant_income": "85000.0", "loan_amount": "250000.0", "property_value": "310000.0",
    "loan_type": "Conventional", "interest_rate": "6.25", "loan_term_months": "360",
    "debt_to_income_ratio": "0.32", "loan_to_value_ratio": "0.81", "property_state": "TX",
    "property_county": "Travis County", "lender": "First Lender", "application_status": "Approved",
    "denial_reason": None, "credit_score_range": "700-739", "data_source_system": "CORE",
    "created_timestamp": "2024-03-15T00:00:00", "updated_timestamp": "2024-03-20T00:00:00",
    "_source_file": "one.csv", "_ingestion_timestamp": datetime(2024, 3, 21),
}
SILVER_ROW = {
    "application_id": "A-1", "application_date": datetime(2024, 3, 15), "applicant_id": "P-1",
    "applicant_income": 85000.0, "loan_amount": 250000.0, "property_value": 310000.0, "loan_type": "Conventional",
    "interest_rate": 6.25, "loan_term_months": 360, "debt_to_income_ratio": 0.32, "loan_to_value_ratio": 0.81,
    "property_state": "TX", "property_county": "Travis County", "lender": "First Lender",
    "application_status": "Approved", "denial_reason": None, "credit_score_range": "700-739",
    "data_source_system": "CORE", "created_timestamp": datetime(2024, 3, 15),
    "updated_timestamp": datetime(2024, 3, 20), "income_band": "50K-100K", "loan_amount_band": "250K-500K",
    "dti_band": "30-36%", "ltv_band": "80-90%", "application_processing_days": 5.0, "approval_indicator": 1,
    "high_risk_indicator": 0, "data_quality_status": "clean", "source_file": "one.csv",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1 -XX:+UseSerialGC")
        # On a handful of rows compiling generated code is most of the time; results do not depend on it.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture(scope="session")
def rules():
    return Rules()


@pytest.fixture(scope="session")
def bronze(spark):
    def make(*rows: dict):
        full = [{**BRONZE_ROW, **row} for row in rows]
        return spark.createDataFrame([tuple(r[c] for c in schemas.BRONZE_SCHEMA.names) for r in full], schemas.BRONZE_SCHEMA)

    return make


@pytest.fixture(scope="session")
def silver(spark):
    def make(*rows: dict):
        full = [{**SILVER_ROW, **row} for row in rows]
        return spark.createDataFrame([tuple(r[c] for c in schemas.SILVER_COLUMNS) for r in full], schemas.SILVER_SCHEMA)

    return make
