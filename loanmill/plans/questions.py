"""The ten portfolio questions.

Facts are aggregated by surrogate key wherever that shrinks them before a dimension is joined, and
windows run over aggregated rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmill.functions import numbers as N
from loanmill.operators.medians import grouped_median
from loanmill.plans.star import Star
from loanmill.rules import Rules

def _rate(part: str, whole: str) -> Column:
    return N.round_away(N.percent(F.col(part), F.col(whole)), 2)


def _volumes(df: DataFrame, *keys: str) -> DataFrame:
    """Applications and approvals per key, counted on the map side first."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_applications"), F.sum("approval_indicator").alias("approved_applications")
    )


def _regroup(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("total_applications").alias("total_applications"),
        F.sum("approved_applications").alias("approved_applications"),
    )


def _monthly(star: Star) -> DataFrame:
    return _regroup(star.with_date(_volumes(star.fact, "date_key")), "year_month")


def q01_monthly_trend(star: Star) -> DataFrame:
    return _monthly(star).withColumn(
        "approval_rate_pct", _rate("approved_applications", "total_applications")
    ).orderBy(F.col("year_month").asc_nulls_last())


def q02_state_extremes(star: Star, rules: Rules) -> DataFrame:
    """Five highest and five lowest states; the ranking sees one row per known state."""
    states = _regroup(star.with_property(_volumes(star.fact, "property_key")), "property_state")
    rated = states.filter(F.col("total_applications") >= rules.min_state_applications).withColumn(
        "approval_rate_pct", _rate("approved_applications", "total_applications")
    )
    ranked = rated.withColumns({
        "highest": F.rank().over(Window.orderBy(F.col("approval_rate_pct").desc_nulls_last())),
        "lowest": F.rank().over(Window.orderBy(F.col("approval_rate_pct").asc_nulls_last())),
    })
    extremes = ranked.filter((F.col("highest") <= 5) | (F.col("lowest") <= 5))
    category = F.when(F.col("highest") <= 5, "Top 5 highest").otherwise("Bottom 5 lowest")
    return (
        extremes.withColumn("category", category).drop("highest", "lowest")
        .orderBy(F.col("approval_rate_pct").desc_nulls_last(), "property_state")
    )


def q03_top_denial_reason(star: Star) -> DataFrame:
    denied = star.fact.filter(F.col("application_status") == "Denied")
    by_key = denied.groupBy("property_key", "denial_reason").agg(F.count(F.lit(1)).alias("n"))
    counts = star.with_property(by_key).groupBy("property_state", "denial_reason").agg(F.sum("n").alias("denial_count"))
    order = Window.partitionBy("property_state").orderBy(
        F.col("denial_count").desc_nulls_last(), F.col("denial_reason").asc_nulls_last()
    )
    top = counts.withColumn("rn", F.row_number().over(order)).filter("rn = 1").drop("rn")
    return top.orderBy(F.col("denial_count").desc_nulls_last(), "property_state")


def q04_loan_by_lender_and_type(star: Star) -> DataFrame:
    """Count, mean and exact median."""
    loans = star.with_product(star.with_lender()).select("lender_name", "loan_type", "loan_amount")
    keys = ["lender_name", "loan_type"]
    means = loans.groupBy(*keys).agg(F.count(F.lit(1)).alias("applications"), F.avg("loan_amount").alias("mean"))
    medians = grouped_median(loans, keys, ["loan_amount"])
    return means.join(medians, keys).select(
        *keys,
        "applications",
        N.cents(F.col("mean")).alias("avg_loan_amount"),
        N.cents(F.col("loan_amount_median")).alias("median_loan_amount"),
    ).orderBy(*keys)


def q05_approval_by_income_band(star: Star, rules: Rules) -> DataFrame:
    """By the applicant's latest band. Facts shrink to one row per applicant before that join, so an
    applicant with very many applications does not skew it."""
    by_applicant = _volumes(star.fact, "applicant_key").join(
        star.dims["dim_applicant"].select("applicant_key", "income_band"), "applicant_key"
    )
    return _regroup(by_applicant, "income_band").withColumn(
        "approval_rate_pct", _rate("approved_applications", "total_applications")
    ).orderBy(N.band_rank(F.col("income_band"), rules.income_bands))


def q06_lender_monthly_change(star: Star, limit: int = 20) -> DataFrame:
    """Largest changes against the lender's previous month that has applications."""
    by_key = star.fact.groupBy("lender_key", "date_key").agg(F.count(F.lit(1)).alias("n"))
    volume = star.with_date(star.with_lender(by_key)).groupBy("lender_name", "year_month").agg(
        F.sum("n").alias("applications")
    )
    prior = F.lag("applications").over(Window.partitionBy("lender_name").orderBy("year_month"))
    change = F.col("applications") - F.col("prior_month_applications")
    return (
        volume.withColumn("prior_month_applications", prior)
        .filter(F.col("prior_month_applications").isNotNull())
        .withColumn("change_in_applications", change)
        .withColumn("pct_change", _rate("change_in_applications", "prior_month_applications"))
        .orderBy(F.abs("change_in_applications").desc(), "lender_name", "year_month")
        .limit(limit)
    )


def q07_high_ratio_share(star: Star, rules: Rules) -> DataFrame:
    high_dti = F.coalesce(F.col("debt_to_income_ratio") >= F.lit(rules.high_risk_dti), F.lit(False))
    high_ltv = F.coalesce(F.col("loan_to_value_ratio") >= F.lit(rules.high_risk_ltv), F.lit(False))
    counts = star.fact.agg(
        F.count(F.lit(1)).alias("total_applications"),
        N.count_if(high_dti).alias("high_dti_count"),
        N.count_if(high_ltv).alias("high_ltv_count"),
        N.count_if(high_dti | high_ltv).alias("high_dti_or_ltv_count"),
    )
    names = ("high_dti", "high_ltv", "high_dti_or_ltv")
    shares = [_rate(f"{n}_count", "total_applications").alias(f"{n}_pct") for n in names]
    return counts.select("*", *shares)


def q08_top_lenders_per_state(star: Star, places: int = 5) -> DataFrame:
    """Dense ranking by volume; ties share a place, so a state may list more lenders than places."""
    by_key = star.fact.groupBy("property_key", "lender_key").agg(F.count(F.lit(1)).alias("n"))
    volume = star.with_lender(star.with_property(by_key)).groupBy("property_state", "lender_name").agg(
        F.sum("n").alias("applications")
    )
    rank = F.dense_rank().over(Window.partitionBy("property_state").orderBy(F.col("applications").desc()))
    return (
        volume.withColumn("lender_rank", rank).filter(F.col("lender_rank") <= places)
        .orderBy("property_state", "lender_rank", "lender_name")
    )


def q09_conflicting_deliveries(bronze: DataFrame) -> DataFrame:
    """Applications delivered more than once, from the raw text.

    Equal deliveries collapse first, with map-side counting, and ids seen once leave before the distinct
    counts, which copy every remaining row once per counted column.
    """
    raw = ["application_status", "loan_amount", "_source_file"]
    versions = bronze.groupBy("application_id", *raw).agg(F.count(F.lit(1)).alias("n"))
    repeated = versions.groupBy("application_id").agg(F.sum("n").alias("version_count")).filter("version_count > 1")
    seen = versions.join(repeated, "application_id").groupBy("application_id", "version_count").agg(
        F.count_distinct("application_status").alias("distinct_statuses"),
        F.count_distinct("loan_amount").alias("distinct_loan_amounts"),
        F.count_distinct("_source_file").alias("distinct_source_files"),
    )
    conflict = (F.col("distinct_statuses") > 1) | (F.col("distinct_loan_amounts") > 1)
    return (
        seen.withColumn("conflict_type", F.when(conflict, "Conflicting information").otherwise("Exact duplicate delivery"))
        .orderBy(
            F.col("distinct_statuses").desc(), F.col("distinct_loan_amounts").desc(), F.col("version_count").desc(),
            "application_id",
        )
    )


def q10_rolling_approval_rate(star: Star) -> DataFrame:
    """Rolling over the last three months that have applications; one row per month enters the window."""
    frame = Window.orderBy("year_month").rowsBetween(-2, 0)
    total, approved = "rolling_3mo_total_applications", "rolling_3mo_approved_applications"
    return (
        _monthly(star)
        .withColumns({
            total: F.sum("total_applications").over(frame),
            approved: F.sum("approved_applications").over(frame),
        })
        .withColumn("rolling_3mo_approval_rate_pct", _rate(approved, total))
        .orderBy("year_month")
    )


def run_questions(star: Star, bronze: DataFrame, rules: Rules) -> list[tuple[str, list | None, str | None]]:
    """(name, rows, error) of all ten questions in order; one that fails does not stop the others. Answers are small tables."""
    questions = {
        "q01": lambda: q01_monthly_trend(star), "q02": lambda: q02_state_extremes(star, rules), "q03": lambda: q03_top_denial_reason(star),
        "q04": lambda: q04_loan_by_lender_and_type(star), "q05": lambda: q05_approval_by_income_band(star, rules),
        "q06": lambda: q06_lender_monthly_change(star), "q07": lambda: q07_high_ratio_share(star, rules),
        "q08": lambda: q08_top_lenders_per_state(star), "q09": lambda: q09_conflicting_deliveries(bronze),
        "q10": lambda: q10_rolling_approval_rate(star),
    }
    out = []
    for name, question in questions.items():
        try:
            out.append((name, question().collect(), None))
        except Exception as failure:  # reported beside the other answers
            out.append((name, None, f"{type(failure).__name__}: {failure}"))
    return out
