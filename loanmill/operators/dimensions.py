"""Star-schema dimensions: dense surrogate keys, overwrite-in-place attributes, key resolution."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanmill.rules import Rules
from loanmill.session import side_by_side, written
from loanmill.sources.tables import Warehouse

# New keys are numbered slot by slot; a slot is a hash class of the natural key, so numbering is
# repeatable and no task sees more than its slots.
SLOTS = 1024


@dataclass(frozen=True)
class Dimension:
    table: str
    key: str
    natural: tuple[str, ...]  # column names in the dimension
    silver: tuple[str, ...]  # the same columns in Silver


APPLICANT = Dimension("dim_applicant", "applicant_key", ("applicant_id",), ("applicant_id",))
PROPERTY = Dimension(
    "dim_property", "property_key", ("property_state", "property_county"), ("property_state", "property_county")
)
LENDER = Dimension("dim_lender", "lender_key", ("lender_name",), ("lender",))
PRODUCT = Dimension(
    "dim_loan_product", "loan_product_key", ("loan_type", "loan_term_months"), ("loan_type", "loan_term_months")
)
DIMENSIONS = (APPLICANT, PROPERTY, LENDER, PRODUCT)
SMALL = (PROPERTY, LENDER, PRODUCT)


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def dim_date(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from `start` up to, not including, `end`."""
    span = F.sequence(F.lit(start), F.lit(end - timedelta(days=1)))
    return calendar(spark.range(1).select(F.explode(span).alias("full_date")))


def calendar(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
    )


def latest_attributes(silver: DataFrame) -> DataFrame:
    """Income band and credit range of each applicant's latest application (no update time = latest)."""
    order = F.struct(F.col("updated_timestamp").isNull(), "updated_timestamp", "application_id")
    latest = F.max_by(F.struct("income_band", "credit_score_range"), order)
    return (
        silver.filter(F.col("applicant_id").isNotNull()).groupBy("applicant_id").agg(latest.alias("a"))
        .select("applicant_id", "a.income_band", "a.credit_score_range")
    )


def _natural_struct(d: Dimension, columns: tuple[str, ...]) -> Column:
    second = F.col(columns[1]).cast("string") if len(columns) > 1 else F.lit(None).cast("string")
    present = F.col(columns[0]).isNotNull()
    if len(columns) > 1:
        present = present & F.col(columns[1]).isNotNull()
    return F.when(present, F.struct(
        F.lit(d.table).alias("dim"), F.col(columns[0]).alias("k1"), second.alias("k2")
    ))


def natural_keys(silver: DataFrame) -> DataFrame:
    """Distinct (dim, k1, k2) of the three descriptor dimensions, each from a scan of its own columns: rows are never
    multiplied. Keys with a NULL part are left out: such rows cannot resolve."""
    out = None
    for d in SMALL:
        part = silver.select(*d.silver).distinct().select(_natural_struct(d, d.silver).alias("k")).filter("k IS NOT NULL").select("k.*")
        out = part if out is None else out.unionByName(part)
    return out


def number_keys(new: DataFrame, base: dict[str, int]) -> DataFrame:
    """Give the rows (dim, k1, k2) dense keys from `base[dim] + 1` on, without sorting a dimension in
    one task: position within the key's slot, plus the sizes of the slots before it."""
    slotted = new.withColumn("slot", F.pmod(F.xxhash64("k1", "k2"), F.lit(SLOTS)).cast("int"))
    within = F.row_number().over(Window.partitionBy("dim", "slot").orderBy("k1", F.col("k2").asc_nulls_first()))
    sizes = slotted.groupBy("dim", "slot").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy("dim").orderBy("slot")) - F.col("size")
    offsets = sizes.select(F.col("dim").alias("d"), F.col("slot").alias("s"), before.alias("before"))
    start = F.lit(0).cast("long")
    for name, value in base.items():
        start = F.when(F.col("dim") == name, F.lit(value).cast("long")).otherwise(start)
    numbered = slotted.withColumn("within", within)
    return numbered.join(offsets, (F.col("dim") == F.col("d")) & (F.col("slot") == F.col("s"))).select(
        "dim", "k1", "k2", (start + F.col("before") + F.col("within")).alias("key")
    )


def _as_rows(d: Dimension, numbered: DataFrame) -> DataFrame:
    parts = [F.col("k1").alias(d.natural[0])]
    if len(d.natural) > 1:
        kind = "int" if d.natural[1] == "loan_term_months" else "string"
        parts.append(F.col("k2").cast(kind).alias(d.natural[1]))
    return numbered.filter(F.col("dim") == d.table).select(F.col("key").alias(d.key), *parts)


def _same_key(a: DataFrame, b: DataFrame) -> Column:
    return (a["dim"] == b["dim"]) & (a["k1"] == b["k1"]) & a["k2"].eqNullSafe(b["k2"])


def overwrite_attributes(dim: DataFrame, attributes: DataFrame) -> DataFrame:
    """Type-1 update of dim_applicant: applicants in `attributes` take its values, others keep theirs."""
    new = attributes.select(
        F.col("applicant_id").alias("_id"), F.col("income_band").alias("_band"), F.col("credit_score_range").alias("_credit")
    )
    matched = F.col("_id").isNotNull()
    return dim.join(new, F.col("applicant_id") == F.col("_id"), "left").select(
        "applicant_key",
        "applicant_id",
        F.when(matched, F.col("_band")).otherwise(F.col("income_band")).alias("income_band"),
        F.when(matched, F.col("_credit")).otherwise(F.col("credit_score_range")).alias("credit_score_range"),
    )


def _refresh_calendar(warehouse: Warehouse, span: tuple[date | None, date | None], rules: Rules) -> None:
    """The stored calendar holds the days of the rules, of earlier loads, and all that Silver now spans."""
    first, last = span
    start, end = rules.calendar_start, rules.calendar_end
    if warehouse.has("dim_date"):
        start, known_last = warehouse.read("dim_date").agg(F.min("full_date"), F.max("full_date")).first()
        end = known_last + timedelta(days=1)
        if first is None or (start <= first and last < end):
            return
    if first is not None:
        start, end = min(start, first), max(end, last + timedelta(days=1))
    warehouse.write("dim_date", dim_date(warehouse.spark, start, end))


def refresh_dims(
    warehouse: Warehouse, silver: DataFrame, rules: Rules, span: tuple[date | None, date | None] | None = None
) -> dict[str, DataFrame]:
    """Bring all five dimensions up to date with Silver and return them. `span`: Silver's first and last day, if known."""
    if span is None:
        day = F.col("application_date").cast("date")
        span = tuple(silver.agg(F.min(day), F.max(day)).first())
    _refresh_calendar(warehouse, span, rules)
    attributes = written(latest_attributes(silver), "applicant-attributes")
    incoming = attributes.select(
        F.lit(APPLICANT.table).alias("dim"), F.col("applicant_id").alias("k1"), F.lit(None).cast("string").alias("k2")
    ).unionByName(natural_keys(silver))

    existing = {d: warehouse.read(d.table) for d in DIMENSIONS if warehouse.has(d.table)}
    base = {d.table: 0 for d in DIMENSIONS}
    fresh = incoming
    if existing:
        known = None
        for d, dim in existing.items():
            keys = dim.select(_natural_struct(d, d.natural).alias("k")).select("k.*")
            known = keys if known is None else known.unionByName(keys)
            base[d.table] = dim.agg(F.coalesce(F.max(d.key), F.lit(0))).first()[0]
        fresh = incoming.join(known, _same_key(incoming, known), "left_anti")
    numbered = written(number_keys(written(fresh, "fresh-keys"), base), "numbered-keys")
    grown = {row["dim"] for row in numbered.select("dim").distinct().collect()}  # at most four names

    def publish(d: Dimension) -> None:
        rows = _as_rows(d, numbered)
        if d is APPLICANT:
            rows = rows.join(attributes, "applicant_id").select(
                "applicant_key", "applicant_id", "income_band", "credit_score_range"
            )
            if d in existing:
                rows = overwrite_attributes(existing[d], attributes).unionByName(rows)
        elif d in existing:
            rows = existing[d].unionByName(rows)
        warehouse.write(d.table, rows)

    changed = [d for d in DIMENSIONS if d is APPLICANT or d.table in grown or d not in existing]
    side_by_side(*[lambda d=d: publish(d) for d in changed])
    return load_dims(warehouse)


def load_dims(warehouse: Warehouse) -> dict[str, DataFrame]:
    return {name: warehouse.read(name) for name in ["dim_date", *[d.table for d in DIMENSIONS]]}


def lacks_key(columns: list[str] | None = None) -> Column:
    """True for Silver rows that cannot join some dimension because a natural key is NULL."""
    lacking = F.lit(False)
    for column in columns or [c for d in DIMENSIONS for c in d.silver]:
        lacking = lacking | F.col(column).isNull()
    return lacking


def unresolvable(silver: DataFrame) -> DataFrame:
    """Reject log of the dimensional load."""
    return silver.filter(lacks_key()).select(
        "application_id", F.lit("dimensional_load").alias("stage"), F.lit("missing dimension key").alias("reason")
    )


def resolve_keys(silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Add the five keys; rows with a missing natural key drop out (`unresolvable` lists them).

    Descriptor dimensions come first so that, when small, they ride along as broadcasts; the applicant join is the
    one exchange, and adaptive execution splits the partition of an applicant with very many rows.
    """
    out = silver.filter(~lacks_key()).withColumn("date_key", date_key(F.col("application_date")))
    for d in (*SMALL, APPLICANT):
        dim = dims[d.table].select(d.key, *[F.col(n).alias(f"_{n}") for n in d.natural])
        condition = [F.col(s) == F.col(f"_{n}") for s, n in zip(d.silver, d.natural)]
        out = out.join(dim, condition).drop(*[f"_{n}" for n in d.natural])
    return out
