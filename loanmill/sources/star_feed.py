"""An application feed derived from order tables (lineitem and its parents), all rows of them.

Each order line is one delivered application row of messy text. Key arithmetic plants every defect class
the cleansing rules know; it alters rows and never leaves any out.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmill import schemas
from loanmill.functions.numbers import moment
from loanmill.rules import Rules
from loanmill.session import spread

CSV_FILE, JSON_FILE = "feed_F.csv", "feed_O.json"
CSV_TIME, JSON_TIME = datetime(2002, 1, 1), datetime(2002, 1, 2)


def feed_rules(spark: SparkSession, sf_dir: str) -> Rules:
    """The rules with this feed's states (nation names), credit tiers and calendar."""
    names = [r[0] for r in spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_name").distinct().collect()]
    return Rules(
        states=tuple(sorted(n.upper() for n in names)),  # the nation table: 25 rows at every scale
        loan_types=("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"),
        high_risk_credit=("MACHINERY",),
        min_application_date=date(1995, 1, 1),
        calendar_start=date(1995, 1, 1),
        calendar_end=date(2002, 1, 1),
    )


def _planted(default: Column, *cases: tuple[Column, Column]) -> Column:
    out = default
    for condition, value in reversed(cases):
        out = F.when(condition, value).otherwise(out)
    return out


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 source columns as text, with `_source_file`, blank ids included."""
    table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # Orders meet their customers first, and lines travel to them once, however large customers are. Names that few rows
    # share come behind that exchange; parts come before it, since they can be too large for a broadcast and lines are narrowest there.
    orders = table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = (
        spread(table("lineitem"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    part = F.col("l_partkey")
    is_csv = F.col("l_linestatus") == "F"
    # What CSV delivers as an empty cell, JSON delivers as null.
    gap = F.when(is_csv, F.lit("")).otherwise(F.lit(None).cast("string"))

    def at(modulus: int, rest: int) -> Column:
        return part % modulus == rest

    def text(c: Column) -> Column:
        return c.cast("string")

    def day(c: str) -> Column:
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")

    income = F.col("c_acctbal") * F.lit(30.0)
    loan = F.col("l_extendedprice") * F.lit(10.0)
    value = F.col("o_totalprice") * F.lit(2.0)
    dti = F.col("l_quantity") / F.lit(50.0)
    status = F.when(F.col("l_returnflag") == "A", "Approved").when(F.col("l_returnflag") == "R", "Denied").otherwise("Withdrawn")
    rows = lines.select(
        _planted(F.concat(text(F.col("l_orderkey")), F.lit("-"), text(F.col("l_linenumber"))), (at(499, 7), F.lit("  ")))
        .alias("application_id"),
        _planted(
            day("o_orderdate"),
            (at(101, 0), F.lit("not-a-date")), (at(101, 1), F.lit("2023-02-30")),
            (at(101, 2), F.lit("13/45/2024")), (at(101, 3), gap),
        ).alias("application_date"),
        text(F.col("o_custkey")).alias("applicant_id"),
        _planted(text(income), (at(33, 0), gap), (at(97, 5), text(-income))).alias("applicant_income"),
        _planted(
            text(loan),
            (at(89, 11), text(-loan)),
            (~is_csv & (F.col("l_suppkey") % 20 == 3), F.concat(F.lit("$"), F.format_number(loan, 2))),
        ).alias("loan_amount"),
        _planted(text(value), (at(83, 4), text(-value))).alias("property_value"),
        F.col("p_type").alias("loan_type"),
        _planted(text(F.col("l_tax") * F.lit(100.0)), (F.col("l_tax") == 0, gap), (at(199, 9), F.lit("999.0")))
        .alias("interest_rate"),
        _planted(text(F.col("p_size")), (at(211, 5), F.lit("36.5"))).alias("loan_term_months"),
        text(_planted(dti, (at(71, 2), dti + F.lit(1.0)))).alias("debt_to_income_ratio"),
        text(F.col("l_extendedprice") / F.col("o_totalprice")).alias("loan_to_value_ratio"),
        _planted(
            F.col("n_name"), (at(307, 3), F.lit("ZZ")),
            (at(25, 0), F.concat(F.lit("  "), F.lower("n_name"), F.lit(" "))),
        ).alias("property_state"),
        _planted(F.col("r_name"), (at(34, 1), F.lit("   "))).alias("property_county"),
        _planted(F.col("s_name"), (at(401, 17), gap)).alias("lender"),
        _planted(
            status, (at(313, 6), F.lit("Pending")), (at(29, 3), F.lit("Incomplete")),
            (F.col("l_linenumber") == 2, F.upper(status)),
        ).alias("application_status"),
        _planted(gap, ((F.col("l_returnflag") == "R") & (F.col("o_orderpriority") != "4-NOT SPECIFIED"), F.col("o_orderpriority")))
        .alias("denial_reason"),
        _planted(F.col("c_mktsegment"), (at(35, 2), gap)).alias("credit_score_range"),
        F.col("l_linestatus").alias("data_source_system"),
        day("o_orderdate").alias("created_timestamp"),
        _planted(day("l_shipdate"), (at(373, 1), gap)).alias("updated_timestamp"),
        F.when(is_csv, CSV_FILE).otherwise(JSON_FILE).alias("_source_file"),
        # Some rows are delivered twice, unchanged.
        F.explode(F.when(at(67, 0), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return rows.select(*schemas.SOURCE_COLUMNS, "_source_file")
