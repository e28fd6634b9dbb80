"""Bronze text to typed, validated, de-duplicated and imputed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmill import schemas
from loanmill.functions import numbers as N
from loanmill.functions import text as X
from loanmill.operators.medians import counted_values, middle
from loanmill.rules import Rules
from loanmill.session import written

IMPUTED = ("applicant_income", "interest_rate")


def blank_to_null(df: DataFrame) -> DataFrame:
    """NULL for every string cell that holds white space only."""
    return df.select(*[
        X.blank_to_null(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes
    ])


def parse_types(df: DataFrame) -> DataFrame:
    """Type the numeric and timestamp columns; text that does not parse becomes NULL."""
    return df.withColumns({
        **{c: X.parse_number(F.col(c)) for c in schemas.MONEY_AND_RATIO_COLUMNS},
        "loan_term_months": X.parse_integer(F.col("loan_term_months")),
        **{c: X.parse_timestamp(F.col(c)) for c in schemas.TIMESTAMP_COLUMNS},
    })


def normalize_categoricals(df: DataFrame, rules: Rules) -> DataFrame:
    """Upper-case trimmed state; status matched without case against the known ones, else NULL.

    Text is stripped in a projection of its own, so the look-up works on a plain column.
    """
    stripped = df.withColumns({
        "property_state": F.upper(X.strip(F.col("property_state"))),
        "application_status": F.lower(X.strip(F.col("application_status"))),
    })
    canonical = F.lit(None).cast("string")
    for name in rules.statuses:
        canonical = F.when(F.col("application_status") == name.lower(), F.lit(name)).otherwise(canonical)
    return stripped.withColumn("application_status", canonical)


def reject_reason(rules: Rules) -> Column:
    """Text of the first rule the row fails, NULL for a row to keep."""

    def range_rule(column: str, bounds: tuple) -> tuple[Column, str]:
        return N.outside(F.col(column), bounds), f"{column} outside plausible range [{bounds[0]}, {bounds[1]}]"

    failures = [
        (F.col("application_date").isNull(), "invalid or unparseable application_date"),
        range_rule("applicant_income", rules.income),
        range_rule("loan_amount", rules.loan_amount),
        range_rule("property_value", rules.property_value),
        range_rule("interest_rate", rules.interest_rate),
        (
            ~F.coalesce(F.col("property_state").isin(list(rules.states)), F.lit(False)),
            "unrecognized property_state after normalization",
        ),
        (F.col("application_status").isNull(), "unrecognized application_status after normalization"),
    ]
    return F.coalesce(*[F.when(failed, F.lit(reason)) for failed, reason in failures])


def validate(df: DataFrame, rules: Rules) -> DataFrame:
    """Add `reject_reason` and `flag_range`, and clip both ratios."""
    dti, ltv = F.col("debt_to_income_ratio"), F.col("loan_to_value_ratio")
    return df.withColumns({
        "reject_reason": reject_reason(rules),
        "flag_range": N.outside(dti, rules.dti) | N.outside(ltv, rules.ltv),
        "debt_to_income_ratio": N.clip(dti, rules.dti),
        "loan_to_value_ratio": N.clip(ltv, rules.ltv),
    })


def checked(bronze: DataFrame, rules: Rules) -> DataFrame:
    """Bronze rows with types, normal forms and the verdict of the reject rules.

    Same result as blank_to_null first: parsers and categorical look-ups turn blanks into NULL or a
    rejected value themselves, so only the free-text columns need that step.
    """
    handled = {*schemas.NUMERIC_COLUMNS, *schemas.TIMESTAMP_COLUMNS, "property_state", "application_status"}
    free_text = [c for c, t in bronze.dtypes if t == "string" and c not in handled and not c.startswith("_")]
    nulled = bronze.withColumns({c: X.blank_to_null(F.col(c)) for c in free_text})
    return validate(normalize_categoricals(parse_types(nulled), rules), rules)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept rows, reject log) of a validated frame."""
    kept = df.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejects = df.filter(F.col("reject_reason").isNotNull()).select(
        "application_id", F.lit("transformation").alias("stage"), F.col("reject_reason").alias("reason")
    )
    return kept, rejects


def medians_by_loan_type(kept: DataFrame) -> DataFrame:
    """`loan_type`, `applicant_income_fill`, `interest_rate_fill`: the value that fills a gap.

    One row per loan type and one for rows without a type. A type's own median fills its gaps; the
    overall median serves rows without a type and types without any value. Medians are taken over kept
    rows before de-duplication, and both kinds from one table of counted values.
    """
    counts = counted_values(kept, ["loan_type"], IMPUTED)
    own = middle(counts.filter("loan_type IS NOT NULL"), ["field", "loan_type"])
    overall = middle(counts, ["field"]).select("field", F.lit(None).cast("string").alias("loan_type"), "median")
    medians = written(own.unionByName(overall), "medians")
    everywhere = {r["field"]: r["median"] for r in medians.filter("loan_type IS NULL").collect()}  # one row per field
    types = counts.select("loan_type").filter("loan_type IS NOT NULL").distinct()
    found = medians.groupBy("loan_type").agg(*[F.max(F.when(F.col("field") == c, F.col("median"))).alias(c) for c in IMPUTED])
    fills = [F.coalesce(F.col(c), F.lit(everywhere.get(c)).cast("double")).alias(f"{c}_fill") for c in IMPUTED]
    typed = types.join(found, "loan_type", "left").select("loan_type", *fills)
    rest = [F.lit(everywhere.get(c)).cast("double").alias(f"{c}_fill") for c in IMPUTED]
    return typed.unionByName(kept.sparkSession.range(1).select(F.lit(None).cast("string").alias("loan_type"), *rest))


def impute(kept: DataFrame, medians: DataFrame) -> DataFrame:
    """Fill gaps and add `flag_missing`.

    Income and rate take their loan type's fill value; county and credit range become `Unknown`; a
    denial without reason becomes `Not Specified`. The fill table is read from storage, so Catalyst
    broadcasts it only when its real size allows.
    """
    county_gap = X.is_blank(F.col("property_county"))
    credit_gap = X.is_blank(F.col("credit_score_range"))
    reason_gap = F.coalesce(F.col("application_status") == "Denied", F.lit(False)) & X.is_blank(F.col("denial_reason"))
    flag = county_gap | credit_gap | reason_gap
    for column in IMPUTED:
        flag = flag | F.col(column).isNull()
    fills = medians.withColumnRenamed("loan_type", "_type")
    joined = kept.join(fills, F.col("loan_type").eqNullSafe(F.col("_type")), "left")
    filled = joined.withColumns({
        "flag_missing": flag,
        **{c: F.coalesce(F.col(c), F.col(f"{c}_fill")) for c in IMPUTED},
        "property_county": F.when(county_gap, F.lit("Unknown")).otherwise(F.col("property_county")),
        "credit_score_range": F.when(credit_gap, F.lit("Unknown")).otherwise(F.col("credit_score_range")),
        "denial_reason": F.when(reason_gap, F.lit("Not Specified")).otherwise(F.col("denial_reason")),
    })
    return filled.select(*kept.columns, "flag_missing")


def latest_version(df: DataFrame) -> DataFrame:
    """One row per `application_id`: latest update, a missing update time counting as the latest.

    Ties go by ingestion time, then file, then every other column, so the choice does not depend on row
    order. `row_number() = 1` lets Spark keep one candidate per id in each input partition before the
    exchange, so an id with a third of all rows sends one row per partition, not all of them.
    """
    first = [c for c in ("updated_timestamp", "_ingestion_timestamp", "_source_file") if c in df.columns]
    rest = [c for c in df.columns if c not in first and c != "application_id"]
    order = [F.col("updated_timestamp").desc_nulls_first()]
    order += [F.col(c).desc_nulls_last() for c in first[1:] + rest]
    rank = F.row_number().over(Window.partitionBy("application_id").orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Identical deliveries: rows equal in everything but the ingestion time, with their surplus copies."""
    columns = [c for c in df.columns if c != "_ingestion_timestamp"]
    copies = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return copies.groupBy("application_id").agg(F.sum(F.col("copies") - 1).alias("surplus_copies"))
