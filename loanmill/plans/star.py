"""The star schema as one value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill.operators.dimensions import load_dims
from loanmill.sources.tables import Warehouse

# Columns of the joined portfolio view.
VIEW_COLUMNS = (
    "application_id", "application_date", "year_month", "property_state", "property_county", "lender_name",
    "loan_type", "loan_term_months", "applicant_income", "loan_amount", "property_value", "interest_rate",
    "debt_to_income_ratio", "loan_to_value_ratio", "application_status", "denial_reason", "income_band",
    "loan_amount_band", "dti_band", "ltv_band", "approval_indicator", "high_risk_indicator",
    "data_quality_status", "risk_category",
)


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dims: dict[str, DataFrame]

    @staticmethod
    def load(warehouse: Warehouse) -> "Star":
        return Star(warehouse.fact(), load_dims(warehouse))

    def with_date(self, df: DataFrame | None = None) -> DataFrame:
        return (df or self.fact).join(self.dims["dim_date"].select("date_key", "full_date", "year_month"), "date_key")

    def with_property(self, df: DataFrame | None = None) -> DataFrame:
        return (df or self.fact).join(self.dims["dim_property"], "property_key")

    def with_lender(self, df: DataFrame | None = None) -> DataFrame:
        return (df or self.fact).join(self.dims["dim_lender"], "lender_key")

    def with_product(self, df: DataFrame | None = None) -> DataFrame:
        return (df or self.fact).join(self.dims["dim_loan_product"], "loan_product_key")

    def joined(self) -> DataFrame:
        """Fact with its four descriptor dimensions; unused ones cost nothing but their (inner) join."""
        return self.with_date(self.with_product(self.with_lender(self.with_property())))

    def portfolio_view(self) -> DataFrame:
        """The denormalised portfolio, dated by the calendar day."""
        risk = F.when(F.col("high_risk_indicator") == 1, "High risk").when(F.col("high_risk_indicator") == 0, "Standard")
        return (
            self.joined().withColumn("application_date", F.col("full_date")).withColumn("risk_category", risk)
            .select(*VIEW_COLUMNS)
        )
