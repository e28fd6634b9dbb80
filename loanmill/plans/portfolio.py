"""Portfolio KPIs, trends and breakdowns under optional filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmill.functions import numbers as N
from loanmill.plans.star import Star
from loanmill.rules import Rules
from loanmill.session import written


@dataclass(frozen=True)
class PortfolioFilter:
    """Equality filters, AND-ed; an empty or missing one does not filter. The lender is free text, the
    others must be known values."""

    state: str | None = None
    lender: str | None = None
    loan_type: str | None = None
    status: str | None = None

    def check(self, rules: Rules) -> "PortfolioFilter":
        known = (
            ("state code", self.state, self.state and self.state.strip().upper(), rules.states),
            ("loan_type", self.loan_type, self.loan_type, rules.loan_types),
            ("status", self.status, self.status, rules.statuses),
        )
        for label, given, value, domain in known:
            if given and value not in domain:
                raise ValueError(f"Unknown {label}: {given!r}. Expected one of {sorted(domain)}")
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        wanted = {
            "property_state": self.state and self.state.strip().upper(),
            "lender_name": self.lender,
            "loan_type": self.loan_type,
            "application_status": self.status,
        }
        for column, value in wanted.items():
            if value:
                df = df.filter(F.col(column) == F.lit(value))
        return df


@dataclass(frozen=True)
class ViewFilter:
    """Inclusive date range and value lists over the portfolio view; an empty list does not filter."""

    start: date | None = None
    end: date | None = None
    states: Sequence[str] = ()
    lenders: Sequence[str] = ()
    loan_types: Sequence[str] = ()
    statuses: Sequence[str] = ()
    risks: Sequence[str] = ()

    def condition(self) -> Column:
        chosen = F.lit(True)
        if self.start is not None and self.end is not None:
            chosen = chosen & F.col("application_date").between(F.lit(self.start), F.lit(self.end))
        lists = {
            "property_state": self.states,
            "lender_name": self.lenders,
            "loan_type": self.loan_types,
            "application_status": self.statuses,
            "risk_category": self.risks,
        }
        for column, values in lists.items():
            if values:
                chosen = chosen & F.col(column).isin(list(values))
        return chosen

    def apply(self, view: DataFrame) -> DataFrame:
        return view.filter(self.condition())


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("double"))


def _kpis(rows: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    return rows.agg(
        total.alias("total_applications"),
        _or_zero(F.sum("loan_amount")).alias("total_requested_loan_amount"),
        _or_zero(N.percent(F.sum("approval_indicator"), total)).alias("approval_rate_pct"),
        _or_zero(N.percent(N.count_if(F.col("application_status") == "Denied"), total)).alias("denial_rate_pct"),
        _or_zero(F.avg("loan_amount")).alias("average_loan_amount"),
        _or_zero(F.avg("applicant_income")).alias("average_applicant_income"),
        F.coalesce(F.sum("high_risk_indicator"), F.lit(0)).alias("high_risk_application_count"),
    )


def portfolio_summary(star: Star, chosen: PortfolioFilter = PortfolioFilter()) -> DataFrame:
    """Seven KPIs in one row; zeros where nothing matches."""
    return _kpis(chosen.apply(star.joined()))


def portfolio_trends(star: Star, chosen: PortfolioFilter = PortfolioFilter()) -> DataFrame:
    return monthly(chosen.apply(star.joined()))


def executive_summary(view: DataFrame) -> DataFrame:
    return _kpis(view)


def monthly(rows: DataFrame) -> DataFrame:
    total, approved = F.count(F.lit(1)), F.sum("approval_indicator")
    return rows.groupBy("year_month").agg(
        total.alias("total_applications"),
        approved.alias("approved_applications"),
        _or_zero(N.percent(approved, total)).alias("approval_rate_pct"),
        _or_zero(F.sum("loan_amount")).alias("total_loan_amount"),
    ).orderBy("year_month")


def match_counts(view: DataFrame, chosen: ViewFilter) -> DataFrame:
    """One row: applications that match the filter, and all of them, in a single pass."""
    return view.agg(
        N.count_if(chosen.condition()).alias("matching_applications"), F.count(F.lit(1)).alias("all_applications")
    )


def _approval(rows: DataFrame, key: str, *more: Column) -> DataFrame:
    grouped = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("applications"), F.sum("approval_indicator").alias("approved"), *more
    )
    return grouped.withColumn("approval_rate_pct", N.percent(F.col("approved"), F.col("applications")))


def by_state(view: DataFrame) -> DataFrame:
    return _approval(view, "property_state", F.avg("loan_amount").alias("avg_loan_amount"))


def by_lender(view: DataFrame) -> DataFrame:
    return _approval(view, "lender_name")


def by_product(view: DataFrame) -> DataFrame:
    return view.groupBy("loan_type").agg(
        F.sum("loan_amount").alias("loan_volume"), F.count(F.lit(1)).alias("applications")
    )


def denial_counts(view: DataFrame) -> DataFrame:
    denied = view.filter((F.col("application_status") == "Denied") & F.col("denial_reason").isNotNull())
    return denied.groupBy("property_state", "denial_reason").agg(F.count(F.lit(1)).alias("count"))


def top_denial_by_state(view: DataFrame) -> DataFrame:
    order = Window.partitionBy("property_state").orderBy(F.col("count").desc(), F.col("denial_reason").asc())
    ranked = denial_counts(view).withColumn("rn", F.row_number().over(order))
    return ranked.filter("rn = 1").select("property_state", "denial_reason", "count").orderBy("property_state")


def histogram(view: DataFrame, column: str, bands: Sequence[tuple]) -> DataFrame:
    """Applications per band in band order; rows without a band are left out, as a chart does."""
    counts = view.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("applications"))
    return counts.withColumn("band_order", N.band_rank(F.col(column), bands)).orderBy("band_order")


def top(rows: DataFrame, measure: str, key: str, limit: int | None = None) -> DataFrame:
    """Rows by falling measure, ties by key; at most `limit` of them."""
    ordered = rows.orderBy(F.col(measure).desc_nulls_last(), F.col(key).asc_nulls_last())
    return ordered if limit is None else ordered.limit(limit)


def filter_domains(view: DataFrame) -> DataFrame:
    """Values on offer per filter, as rows (filter_name, value); the date filter offers its two ends.

    Rows instead of collected lists, so a free-text column with very many values stays distributed.
    """
    columns = ("property_state", "lender_name", "loan_type", "application_status", "risk_category")
    pairs = F.array(*[F.struct(F.lit(c).alias("filter_name"), F.col(c).alias("value")) for c in columns])
    values = view.select(F.explode(pairs).alias("p")).select("p.*").filter("value IS NOT NULL").distinct()
    ends = view.agg(F.min("application_date").alias("a"), F.max("application_date").alias("z")).select(
        F.explode(F.array("a", "z")).alias("d")
    )
    dates = ends.filter("d IS NOT NULL").select(F.lit("application_date").alias("filter_name"), F.col("d").cast("string").alias("value"))
    return values.unionByName(dates.distinct()).orderBy("filter_name", "value")


# -- all breakdowns from one aggregate ----------------------------------------------------------------------

KEYS = ("property_key", "lender_key", "loan_product_key", "application_status", "high_risk_indicator")


@dataclass(frozen=True)
class Breakdowns:
    """The whole portfolio counted once by each of its keys; dimensions meet these few rows, not the facts."""

    star: Star
    counted: DataFrame

    @staticmethod
    def of(star: Star) -> "Breakdowns":
        """One scan of the fact table, one aggregate over grouping sets of the five keys and of nothing."""
        rows = star.fact.select(*KEYS, "approval_indicator", "loan_amount", "date_key")
        counted = rows.groupingSets([[F.col(k)] for k in KEYS] + [[]], *[F.col(k) for k in KEYS]).agg(
            F.grouping_id().alias("grouping"), F.count(F.lit(1)).alias("applications"), F.sum("approval_indicator").alias("approved"),
            F.sum("loan_amount").alias("loan_sum"), F.count("loan_amount").alias("loans"), F.min("date_key").alias("first"), F.max("date_key").alias("last"),
        )
        return Breakdowns(star, written(counted, "breakdowns"))

    def by(self, key: str | None) -> DataFrame:
        """Rows of one grouping set. Its number has a bit for each key that was left out."""
        left_out = sum(1 << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS) if k != key)
        return self.counted.filter(F.col("grouping") == left_out)

    def by_state(self) -> DataFrame:
        rows = self.star.with_property(self.by("property_key")).groupBy("property_state").agg(
            F.sum("applications").alias("applications"), F.sum("approved").alias("approved"),
            F.try_divide(F.sum("loan_sum"), F.sum("loans")).alias("avg_loan_amount"),
        )
        return rows.withColumn("approval_rate_pct", N.percent(F.col("approved"), F.col("applications")))

    def by_lender(self) -> DataFrame:
        rows = self.star.with_lender(self.by("lender_key")).groupBy("lender_name").agg(
            F.sum("applications").alias("applications"), F.sum("approved").alias("approved")
        )
        return rows.withColumn("approval_rate_pct", N.percent(F.col("approved"), F.col("applications")))

    def by_product(self) -> DataFrame:
        return self.star.with_product(self.by("loan_product_key")).groupBy("loan_type").agg(
            F.sum("loan_sum").alias("loan_volume"), F.sum("applications").alias("applications")
        )

    def filter_domains(self) -> DataFrame:
        """As the function of this name, without a look at the facts."""
        risk = F.when(F.col("high_risk_indicator") == 1, "High risk").when(F.col("high_risk_indicator") == 0, "Standard")
        parts = [
            ("property_state", self.star.with_property(self.by("property_key")), F.col("property_state")),
            ("lender_name", self.star.with_lender(self.by("lender_key")), F.col("lender_name")),
            ("loan_type", self.star.with_product(self.by("loan_product_key")), F.col("loan_type")),
            ("application_status", self.by("application_status"), F.col("application_status")),
            ("risk_category", self.by("high_risk_indicator"), risk),
            ("application_date", self.star.with_date(self.by(None).select(F.explode(F.array("first", "last")).alias("date_key"))), F.col("full_date")),
        ]
        out = None
        for name, rows, value in parts:
            part = rows.select(F.lit(name).alias("filter_name"), value.cast("string").alias("value")).filter("value IS NOT NULL").distinct()
            out = part if out is None else out.unionByName(part)
        return out.orderBy("filter_name", "value")
