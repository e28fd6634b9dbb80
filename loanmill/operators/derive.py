"""Derived Silver columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill import schemas
from loanmill.functions import numbers as N
from loanmill.rules import Rules


def derive(df: DataFrame, rules: Rules) -> DataFrame:
    """Bands, processing days, indicators and quality status (from `flag_range` / `flag_missing`)."""
    dti, ltv = F.col("debt_to_income_ratio"), F.col("loan_to_value_ratio")
    no = F.lit(False)
    risky = (
        F.coalesce(dti >= F.lit(rules.high_risk_dti), no)
        | F.coalesce(ltv >= F.lit(rules.high_risk_ltv), no)
        | F.coalesce(F.col("credit_score_range").isin(list(rules.high_risk_credit)), no)
    )
    flags = [F.coalesce(F.col(c), no) for c in ("flag_range", "flag_missing") if c in df.columns]
    flagged = flags[0] if flags else no
    for flag in flags[1:]:
        flagged = flagged | flag
    days = N.days_between(F.col("created_timestamp"), F.col("updated_timestamp"))
    return df.withColumns({
        "income_band": N.band(F.col("applicant_income"), rules.income_bands),
        "loan_amount_band": N.band(F.col("loan_amount"), rules.loan_bands),
        "dti_band": N.band(dti, rules.dti_bands),
        "ltv_band": N.band(ltv, rules.ltv_bands),
        "application_processing_days": N.round_even(days, 2),
        "approval_indicator": F.coalesce(F.col("application_status") == "Approved", no).cast("int"),
        "high_risk_indicator": risky.cast("int"),
        "data_quality_status": F.when(flagged, F.lit("flagged")).otherwise(F.lit("clean")),
    })


def silver_projection(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("_source_file", "source_file").select(*schemas.SILVER_COLUMNS)
