"""Column lists and types of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order are part of the data contract.
SOURCE_COLUMNS = (
    "application_id", "application_date", "applicant_id", "applicant_income", "loan_amount",
    "property_value", "loan_type", "interest_rate", "loan_term_months", "debt_to_income_ratio",
    "loan_to_value_ratio", "property_state", "property_county", "lender", "application_status",
    "denial_reason", "credit_score_range", "data_source_system", "created_timestamp",
    "updated_timestamp",
)
MONEY_AND_RATIO_COLUMNS = (
    "applicant_income", "loan_amount", "property_value", "interest_rate",
    "debt_to_income_ratio", "loan_to_value_ratio",
)
NUMERIC_COLUMNS = (
    "applicant_income", "loan_amount", "property_value", "interest_rate", "loan_term_months",
    "debt_to_income_ratio", "loan_to_value_ratio",
)
TIMESTAMP_COLUMNS = ("application_date", "created_timestamp", "updated_timestamp")
DERIVED_COLUMNS = (
    "income_band", "loan_amount_band", "dti_band", "ltv_band", "application_processing_days",
    "approval_indicator", "high_risk_indicator", "data_quality_status", "source_file",
)
SILVER_COLUMNS = SOURCE_COLUMNS + DERIVED_COLUMNS
# A change in any of these makes a delivered row an update of the stored one.
HASH_COLUMNS = (
    "applicant_income", "loan_amount", "property_value", "interest_rate", "debt_to_income_ratio",
    "loan_to_value_ratio", "application_processing_days", "application_status", "denial_reason",
    "income_band", "loan_amount_band", "dti_band", "ltv_band", "approval_indicator",
    "high_risk_indicator", "data_quality_status", "updated_timestamp", "source_file",
)
KEY_COLUMNS = ("date_key", "applicant_key", "property_key", "lender_key", "loan_product_key")
FACT_COLUMNS = (
    "application_id", "date_key", "applicant_key", "property_key", "lender_key", "loan_product_key",
    "applicant_income", "loan_amount", "property_value", "interest_rate", "debt_to_income_ratio",
    "loan_to_value_ratio", "application_processing_days", "application_status", "denial_reason",
    "income_band", "loan_amount_band", "dti_band", "ltv_band", "approval_indicator",
    "high_risk_indicator", "data_quality_status", "data_source_system", "application_date",
    "created_timestamp", "updated_timestamp", "source_file", "row_hash", "loaded_at",
)
REQUIRED_FACT_COLUMNS = (
    "application_id", "application_date", "loan_amount", "applicant_income", "property_value",
    "loan_product_key", "application_status",
)

SOURCE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SOURCE_COLUMNS])
BRONZE_SCHEMA = T.StructType(
    SOURCE_SCHEMA.fields
    + [T.StructField("_source_file", T.StringType()), T.StructField("_ingestion_timestamp", T.TimestampNTZType())]
)
_DOUBLES = {*MONEY_AND_RATIO_COLUMNS, "application_processing_days"}
_INTS = {"date_key", "loan_term_months", "approval_indicator", "high_risk_indicator"}
_LONGS = {"applicant_key", "property_key", "lender_key", "loan_product_key"}
_MOMENTS = {*TIMESTAMP_COLUMNS, "loaded_at"}


def _typed(column: str) -> T.StructField:
    for names, kind in (
        (_DOUBLES, T.DoubleType()), (_INTS, T.IntegerType()), (_LONGS, T.LongType()), (_MOMENTS, T.TimestampNTZType())
    ):
        if column in names:
            return T.StructField(column, kind)
    return T.StructField(column, T.StringType())


SILVER_SCHEMA = T.StructType([_typed(c) for c in SILVER_COLUMNS])
FACT_SCHEMA = T.StructType([_typed(c) for c in FACT_COLUMNS])
REJECT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("application_id", "stage", "reason")])
AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("ended_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_new", T.LongType()),
    T.StructField("rows_updated", T.LongType()),
    T.StructField("rows_unchanged", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("error_message", T.StringType()),
])

# Stored tables with a fixed shape; naming the schema on read spares a footer-reading job.
TABLES = {
    "silver_loan_application": SILVER_SCHEMA,
    "transformation_rejected": REJECT_SCHEMA,
    "dim_date": "date_key int, full_date date, year int, quarter int, month int, month_name string, year_month string, "
    "day_of_month int, day_of_week int, day_name string",
    "dim_applicant": "applicant_key bigint, applicant_id string, income_band string, credit_score_range string",
    "dim_property": "property_key bigint, property_state string, property_county string",
    "dim_lender": "lender_key bigint, lender_name string",
    "dim_loan_product": "loan_product_key bigint, loan_type string, loan_term_months int",
}
