"""Every query by name: (spark, input folder) -> DataFrame, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmill import schemas
from loanmill.functions.numbers import cents, round_away, round_even
from loanmill.functions.text import parse_number
from loanmill.operators import answers, chunking, cleansing, medians, profiling, quality, vectors
from loanmill.operators import dimensions as D
from loanmill.operators import incremental as I
from loanmill.plans import ask, portfolio
from loanmill.plans import questions as Q
from loanmill.plans.lake import Lake
from loanmill.plans.portfolio import PortfolioFilter, ViewFilter
from loanmill.plans.star import Star
from loanmill.rules import Rules
from loanmill.session import written
from loanmill.sources import audit, star_feed

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

FILTER = PortfolioFilter(state=" nation_3 ", loan_type="PROMO", status="Approved")
VIEW_FILTER = ViewFilter(
    start=date(1996, 1, 1), end=date(1999, 12, 31), states=("NATION_1", "NATION_2", "NATION_3"),
    statuses=("Approved", "Denied"), risks=("High risk",),
)
VECTOR_RULES = Rules(min_score=0.3)
ASK_RULES = Rules(min_score=0.5)


def query(job: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    CATALOG[job.__name__] = lambda spark, sf_dir: job(Lake.of(spark, sf_dir))
    return job


# -- landing and cleansing --------------------------------------------------------------------------------


@query
def ingest_counts(lake: Lake) -> DataFrame:
    return lake.landing.counts()


@query
def relanded_bronze(lake: Lake) -> DataFrame:
    """Both files landed, then one of them again without its rows that lack an id."""
    return lake.relanded.counts()


@query
def ingest_csv_json(lake: Lake) -> DataFrame:
    """All rows of the raw files, kept and quarantined, as they lie in the landing; numbers parsed, since engines write them differently."""
    landing = lake.from_files
    both = landing.bronze().withColumn("quarantined", F.lit(False)).unionByName(landing.quarantine().withColumn("quarantined", F.lit(True)))
    numbers = {c: parse_number(F.col(c)) for c in schemas.NUMERIC_COLUMNS}
    source = F.when(F.col("_source_file").contains(".csv"), "csv").otherwise("json")
    return both.withColumns(numbers).select(*schemas.SOURCE_COLUMNS, "quarantined", source.alias("format"), "_ingestion_timestamp")


@query
def quarantined_rows(lake: Lake) -> DataFrame:
    return lake.landing.quarantine().select("applicant_id", "lender", "application_status", "_source_file")


@query
def parsed_types(lake: Lake) -> DataFrame:
    return lake.checked.select(
        "application_id", *schemas.TIMESTAMP_COLUMNS, "applicant_income", "loan_amount", "property_value",
        "interest_rate", "loan_term_months", "property_state", "application_status", "property_county", "lender",
        "denial_reason", "credit_score_range",
    )


@query
def clip_and_flag(lake: Lake) -> DataFrame:
    return lake.checked.select("application_id", "debt_to_income_ratio", "loan_to_value_ratio", "flag_range")


@query
def reject_log(lake: Lake) -> DataFrame:
    return lake.rejects


@query
def reject_reasons(lake: Lake) -> DataFrame:
    return lake.rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"))


@query
def impute_medians(lake: Lake) -> DataFrame:
    return cleansing.medians_by_loan_type(lake.kept)


@query
def medians_of_large_groups(lake: Lake) -> DataFrame:
    """Medians of groups that each span many ranges of the counted values; one of them is the group of NULL."""
    lines = lake.table("lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("returned"), "l_extendedprice",
        F.when(F.col("l_linenumber") > 1, F.col("l_discount")).alias("discount"), (F.col("l_partkey") % 2).cast("double").alias("parity"),
    )
    return medians.grouped_median(lines, ["returned"], ["l_extendedprice", "discount", "parity"], ranges=61)


@query
def imputed_rows(lake: Lake) -> DataFrame:
    return cleansing.impute(lake.kept, cleansing.medians_by_loan_type(lake.kept)).select(
        "application_id", "applicant_income", "interest_rate", "property_county", "credit_score_range",
        "denial_reason", "flag_missing",
    )


@query
def exact_duplicates(lake: Lake) -> DataFrame:
    return cleansing.exact_duplicates(lake.bronze)


@query
def dedup_latest(lake: Lake) -> DataFrame:
    return cleansing.latest_version(lake.kept).select(
        "application_id", "updated_timestamp", "loan_amount", "application_status", "lender", "_source_file"
    )


@query
def silver_clean(lake: Lake) -> DataFrame:
    return lake.silver


@query
def bands_and_risk(lake: Lake) -> DataFrame:
    return lake.silver.groupBy(
        "income_band", "loan_amount_band", "dti_band", "ltv_band", "high_risk_indicator", "data_quality_status"
    ).agg(F.count(F.lit(1)).alias("applications"), F.sum("approval_indicator").alias("approved"))


@query
def processing_days(lake: Lake) -> DataFrame:
    return lake.silver.select("application_id", "application_processing_days")


@query
def stage_counters(lake: Lake) -> DataFrame:
    """What the transformation observed while it wrote."""
    seen = lake.transformed
    counters = {"read": seen.rows_read, "rejected": seen.rows_rejected, "written": seen.rows_written, "flagged": seen.rows_flagged}
    return lake.spark.createDataFrame(list(counters.items()), "counter string, n bigint")


# -- star schema ------------------------------------------------------------------------------------------


@query
def dim_date(lake: Lake) -> DataFrame:
    """The calendar of the order dates, its last day exclusive."""
    span = lake.table("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("z"))
    days = F.sequence(F.col("a").cast("date"), F.date_sub(F.col("z").cast("date"), 1))
    return D.calendar(span.select(F.explode(days).alias("full_date")))


@query
def dim_property(lake: Lake) -> DataFrame:
    return lake.star.dims["dim_property"].select("property_state", "property_county")


@query
def dim_lender(lake: Lake) -> DataFrame:
    return lake.star.dims["dim_lender"].select("lender_name")


@query
def dim_loan_product(lake: Lake) -> DataFrame:
    return lake.star.dims["dim_loan_product"].select("loan_type", "loan_term_months")


@query
def dim_applicant_latest(lake: Lake) -> DataFrame:
    return lake.star.dims["dim_applicant"].select("applicant_id", "income_band", "credit_score_range")


@query
def dim_applicant_after_update(lake: Lake) -> DataFrame:
    """Applicants after a second load, whose attributes overwrite those of the first."""
    return lake.second_delivery.dims["dim_applicant"].select("applicant_id", "income_band", "credit_score_range")


@query
def dim_key_density(lake: Lake) -> DataFrame:
    """Surrogate keys of every dimension run from 1 without gaps."""
    return _key_density(lake.star)


@query
def dim_keys_after_update(lake: Lake) -> DataFrame:
    """The same after a second load, which adds keys and keeps the old ones."""
    return _key_density(lake.second_delivery)


def _key_density(star: Star) -> DataFrame:
    out = None
    for d in D.DIMENSIONS:
        part = star.dims[d.table].agg(
            F.lit(d.table).alias("dimension"), F.count(F.lit(1)).alias("members"),
            F.min(d.key).alias("least_key"), F.max(d.key).alias("greatest_key"),
            F.count_distinct(d.key).alias("distinct_keys"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query
def fact_resolved(lake: Lake) -> DataFrame:
    return lake.star.joined().join(lake.star.dims["dim_applicant"].select("applicant_key", "applicant_id"), "applicant_key").select(
        "application_id", "date_key", "applicant_id", "property_state", "property_county", "lender_name",
        "loan_type", "loan_term_months", "applicant_income", "loan_amount", "interest_rate",
        "application_processing_days", "application_status", "denial_reason", "updated_timestamp", "source_file",
    )


@query
def gold_rejects(lake: Lake) -> DataFrame:
    return D.unresolvable(lake.silver)


@query
def change_classification(lake: Lake) -> DataFrame:
    return lake.classified


@query
def change_counts(lake: Lake) -> DataFrame:
    return I.change_counts(lake.classified)


@query
def fact_upsert(lake: Lake) -> DataFrame:
    return lake.second_delivery.fact.select("application_id", *schemas.HASH_COLUMNS)


# -- the ten questions ------------------------------------------------------------------------------------


@query
def q01(lake: Lake) -> DataFrame:
    return Q.q01_monthly_trend(lake.star)


@query
def q02(lake: Lake) -> DataFrame:
    return Q.q02_state_extremes(lake.star, lake.rules)


@query
def q03(lake: Lake) -> DataFrame:
    return Q.q03_top_denial_reason(lake.star)


@query
def q04(lake: Lake) -> DataFrame:
    return Q.q04_loan_by_lender_and_type(lake.star)


@query
def q05(lake: Lake) -> DataFrame:
    return Q.q05_approval_by_income_band(lake.star, lake.rules)


@query
def q06(lake: Lake) -> DataFrame:
    return Q.q06_lender_monthly_change(lake.star)


@query
def q07(lake: Lake) -> DataFrame:
    return Q.q07_high_ratio_share(lake.star, lake.rules)


@query
def q08(lake: Lake) -> DataFrame:
    return Q.q08_top_lenders_per_state(lake.star)


@query
def q09(lake: Lake) -> DataFrame:
    return Q.q09_conflicting_deliveries(lake.bronze)


@query
def q10(lake: Lake) -> DataFrame:
    return Q.q10_rolling_approval_rate(lake.star)


# -- portfolio --------------------------------------------------------------------------------------------


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on the order of addition in their last bits; compare them to the cent."""
    return df.withColumns({c: cents(F.col(c)) for c in columns})


KPI_MONEY = ("total_requested_loan_amount", "average_loan_amount", "average_applicant_income")


@query
def portfolio_summary(lake: Lake) -> DataFrame:
    return _rounded(portfolio.portfolio_summary(lake.star), *KPI_MONEY)


@query
def portfolio_summary_filtered(lake: Lake) -> DataFrame:
    return _rounded(portfolio.portfolio_summary(lake.star, FILTER.check(lake.rules)), *KPI_MONEY)


@query
def portfolio_summary_empty(lake: Lake) -> DataFrame:
    return portfolio.portfolio_summary(lake.star, PortfolioFilter(lender="no such lender").check(lake.rules))


@query
def portfolio_trends(lake: Lake) -> DataFrame:
    return _rounded(portfolio.portfolio_trends(lake.star), "total_loan_amount")


@query
def portfolio_trends_filtered(lake: Lake) -> DataFrame:
    return _rounded(portfolio.portfolio_trends(lake.star, FILTER.check(lake.rules)), "total_loan_amount")


@query
def portfolio_view(lake: Lake) -> DataFrame:
    return lake.star.portfolio_view()


@query
def executive_summary(lake: Lake) -> DataFrame:
    return _rounded(portfolio.executive_summary(VIEW_FILTER.apply(lake.star.portfolio_view())), *KPI_MONEY)


@query
def monthly_filtered(lake: Lake) -> DataFrame:
    return _rounded(portfolio.monthly(VIEW_FILTER.apply(lake.star.portfolio_view())), "total_loan_amount")


@query
def match_counts(lake: Lake) -> DataFrame:
    return portfolio.match_counts(lake.star.portfolio_view(), VIEW_FILTER)


@query
def by_state(lake: Lake) -> DataFrame:
    return _rounded(lake.breakdowns.by_state(), "avg_loan_amount")


@query
def by_lender(lake: Lake) -> DataFrame:
    return lake.breakdowns.by_lender()


@query
def by_product(lake: Lake) -> DataFrame:
    return _rounded(lake.breakdowns.by_product(), "loan_volume")


@query
def denial_counts(lake: Lake) -> DataFrame:
    return portfolio.denial_counts(lake.star.portfolio_view())


@query
def top_denial_by_state(lake: Lake) -> DataFrame:
    return portfolio.top_denial_by_state(lake.star.portfolio_view())


@query
def dti_histogram(lake: Lake) -> DataFrame:
    return portfolio.histogram(lake.star.portfolio_view(), "dti_band", lake.rules.dti_bands)


@query
def ltv_histogram(lake: Lake) -> DataFrame:
    return portfolio.histogram(lake.star.portfolio_view(), "ltv_band", lake.rules.ltv_bands)


@query
def filter_domains(lake: Lake) -> DataFrame:
    return lake.breakdowns.filter_domains()


@query
def top20_states_by_applications(lake: Lake) -> DataFrame:
    return portfolio.top(portfolio.by_state(lake.star.portfolio_view()), "applications", "property_state", 20).select(
        "property_state", "applications"
    )


@query
def top20_states_by_approval(lake: Lake) -> DataFrame:
    return portfolio.top(portfolio.by_state(lake.star.portfolio_view()), "approval_rate_pct", "property_state", 20).select(
        "property_state", "approval_rate_pct"
    )


@query
def top20_states_by_avg_loan(lake: Lake) -> DataFrame:
    ranked = portfolio.top(portfolio.by_state(lake.star.portfolio_view()), "avg_loan_amount", "property_state", 20)
    return _rounded(ranked.select("property_state", "avg_loan_amount"), "avg_loan_amount")


@query
def top15_lenders(lake: Lake) -> DataFrame:
    return portfolio.top(portfolio.by_lender(lake.star.portfolio_view()), "applications", "lender_name", 15).select(
        "lender_name", "applications"
    )


@query
def lenders_by_approval(lake: Lake) -> DataFrame:
    return portfolio.top(portfolio.by_lender(lake.star.portfolio_view()), "approval_rate_pct", "lender_name")


# -- quality, profile, log --------------------------------------------------------------------------------


def _checks(lake: Lake) -> DataFrame:
    star = lake.star
    return quality.quality_checks(
        star.fact, lake.silver, lake.bronze, lake.rejects, star.dims, lake.rules, star_feed.JSON_TIME
    )


@query
def dq_checks(lake: Lake) -> DataFrame:
    return _checks(lake)


@query
def dq_checks_failing(lake: Lake) -> DataFrame:
    """The checks on a fact table with planted faults of every kind, and with each reject three times."""
    star, ends = lake.star, lambda *tails: F.col("application_id").rlike(f"({'|'.join(tails)})$")
    damaged = star.fact.withColumns({
        "application_status": F.when(ends("7-1"), "Pending").otherwise(F.col("application_status")),
        "loan_amount": F.when(ends("8-2"), -F.col("loan_amount")).otherwise(F.col("loan_amount")),
        "loan_to_value_ratio": F.when(ends("9-1"), 5.0).otherwise(F.col("loan_to_value_ratio")),
        "applicant_income": F.when(~ends("5-1"), F.col("applicant_income")),
        "application_date": F.when(ends("4-2"), F.lit("2050-01-01").cast("timestamp_ntz")).otherwise(F.col("application_date")),
        "lender_key": F.when(ends("6-1"), -1).otherwise(F.col("lender_key")),
    })
    twice = damaged.unionByName(damaged.filter(ends("3-3")))
    rejects = lake.rejects.select("*", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return quality.quality_checks(twice, lake.silver, lake.bronze, rejects, star.dims, lake.rules, star_feed.JSON_TIME)


@query
def dq_rollup(lake: Lake) -> DataFrame:
    return quality.rollup(_checks(lake))


@query
def dq_orphans(lake: Lake) -> DataFrame:
    """Orphans per dimension when the dimensions know only the first delivery."""
    keyed = lake.star.joined().join(
        lake.star.dims["dim_applicant"].select("applicant_key", "applicant_id"), "applicant_key"
    ).drop(*[d.key for d in D.DIMENSIONS])
    early = lake.first_dims
    for d in D.DIMENSIONS:
        keyed = keyed.join(early[d.table].select(d.key, *d.natural), list(d.natural), "left")
    return quality.orphan_counts(keyed, early)


@query
def dq_duplicate_ids(lake: Lake) -> DataFrame:
    return quality.duplicate_ids(lake.bronze)


@query
def profile_columns(lake: Lake) -> DataFrame:
    is_date = F.col("column_name").isin(list(schemas.TIMESTAMP_COLUMNS))
    return profiling.profile(lake.bronze).select(
        "position", "column_name", "record_count", "null_count", "null_pct", "distinct_count", "invalid_value_count",
        "min_number", "max_number", round_away(F.col("mean"), 4).alias("mean"),
        F.when(is_date, F.col("min")).alias("min_moment"), F.when(is_date, F.col("max")).alias("max_moment"),
    )


@query
def profile_sketch(lake: Lake) -> DataFrame:
    """The profile of each file, merged; distinct counts as approximations that lie within 5 % of the exact ones."""
    parts = [profiling.sketch_profile(lake.bronze.filter(F.col("_source_file") == f)) for f in (star_feed.CSV_FILE, star_feed.JSON_FILE)]
    merged = profiling.merge_profiles(written(parts[0].unionByName(parts[1]), "profiles"))
    exact = profiling.profile(lake.bronze).select("position", F.col("distinct_count").alias("exact"))
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= F.lit(0.05) * F.col("exact")
    return merged.join(exact, "position").select(
        "position", "column_name", "record_count", "null_count", "null_pct", near.alias("distinct_within_bound"), "distinct_is_approximate",
        "invalid_value_count", "min_number", "max_number", round_away(F.col("mean"), 4).alias("mean"),
    )


@query
def profile_row_counts(lake: Lake) -> DataFrame:
    return profiling.row_counts(lake.bronze)


@query
def profile_concerns(lake: Lake) -> DataFrame:
    return profiling.concerns(profiling.profile(lake.bronze), profiling.row_counts(lake.bronze))


@query
def run_log(lake: Lake) -> DataFrame:
    """The stages that this warehouse's load has logged."""
    assert lake.star
    return audit.latest_run(audit.log_of(lake.warehouse)).select(
        "run_id", "stage", "status", "rows_read", "rows_new", "rows_updated", "rows_unchanged", "rows_rejected", "error_message"
    )


@query
def latest_run_stages(lake: Lake) -> DataFrame:
    """The events table read as an execution log: user = run, event type = stage."""
    number = lambda name, c: F.lit(c).cast("long").alias(name)
    log = lake.table("events").select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.col("event_type").alias("stage"),
        F.col("ts").cast("timestamp_ntz").alias("started_at"),
        F.when(F.col("value") >= 1, F.col("ts").cast("timestamp_ntz")).alias("ended_at"),
        F.when(F.col("value") >= 1, "SUCCESS").otherwise("RUNNING").alias("status"),
        F.col("event_id").alias("rows_read"),
        number("rows_new", 0), number("rows_updated", 0), number("rows_unchanged", 0), number("rows_rejected", 0),
        F.lit(None).cast("string").alias("error_message"),
    )
    return audit.latest_run(audit.current(log)).select("run_id", "stage", "started_at", "status", "rows_read")


# -- documents and retrieval ------------------------------------------------------------------------------


def _markdown(lake: Lake) -> DataFrame:
    """Every document in Markdown form: a title, and a heading wherever a sentence ends inside a line."""
    body = F.regexp_replace("text", r"[.] (\w+) ", ".\n## $1\n")
    ends = F.when(F.col("doc_id") % 5 == 0, F.replace(body, F.lit("\n"), F.lit("\r\n"))).otherwise(body)
    titled = F.when(F.col("doc_id") % 3 == 0, ends).otherwise(F.concat(F.lit("# "), F.col("source"), F.lit("\n"), ends))
    return lake.table("documents").select(F.col("doc_id").cast("string").alias("document"), titled.alias("text"))


@query
def doc_sections(lake: Lake) -> DataFrame:
    return chunking.sections(_markdown(lake)).withColumn("section_no", F.col("section_no").cast("long"))


@query
def doc_chunks(lake: Lake) -> DataFrame:
    return chunking.chunk_documents(lake.plain_documents).drop("chunk_key")


def _vectors(lake: Lake, name: str) -> DataFrame:
    return lake.table("embeddings").select(F.col("vec_id").alias(name), "embedding")


@query
def vector_topk(lake: Lake) -> DataFrame:
    """The four nearest vectors of every vector."""
    found = vectors.top_k(_vectors(lake, "question_id"), _vectors(lake, "chunk_id"), VECTOR_RULES.top_k)
    return found.select("question_id", "chunk_id", "rank", round_even(F.col("score"), 4).alias("score"))


@query
def vector_topk_blocks(lake: Lake) -> DataFrame:
    """The same with question blocks of 64 kB, which makes several of them."""
    found = vectors.top_k(_vectors(lake, "question_id"), _vectors(lake, "chunk_id"), VECTOR_RULES.top_k, 1 << 16)
    return found.select("question_id", "chunk_id", "rank", round_even(F.col("score"), 4).alias("score"))


def _cited(citations: str) -> Column:
    one = lambda c: F.concat_ws("|", c["document_name"], c["section_title"], F.format_number(c["similarity_score"], 4))
    return F.array_join(F.transform(citations, one), ";")


@query
def answer_compose(lake: Lake) -> DataFrame:
    """Answers put together from the passages nearest to each vector. Passages are all documents, which share out the vectors by id, and
    all vectors that are left without a document, as passages without text."""
    number = F.col("doc_id") % lake.table("embeddings").count()
    documents = lake.table("documents").select(number.alias("vec_id"), "doc_id", "source", "lang", "text")
    passages = lake.table("embeddings").select("vec_id", "embedding").join(documents, "vec_id", "left").select(
        F.coalesce("doc_id", -1 - F.col("vec_id")).alias("chunk_id"), "embedding", F.coalesce("source", F.lit("none")).alias("document_name"),
        F.coalesce("lang", F.lit("none")).alias("section_title"), F.coalesce("text", F.lit("")).alias("text"),
    )
    found = vectors.top_k(_vectors(lake, "question_id"), passages, VECTOR_RULES.top_k)
    composed = answers.compose(found.join(passages.drop("embedding"), "chunk_id"), VECTOR_RULES.min_score, VECTOR_RULES.max_passages)
    return composed.select(
        "question_id", "answer", "is_answerable", _cited("citations").alias("citations"), F.size("retrieved_passages").alias("passages")
    )


@query
def refused_questions(lake: Lake) -> DataFrame:
    """Documents read as questions: those that are too short or too long to be asked."""
    questions = lake.table("documents").select(F.col("doc_id").alias("question_id"), F.col("text").alias("question"))
    _, refused = ask.split_questions(questions)
    return refused.select("question_id", F.length("question").cast("long").alias("question_chars"))


@query
def batch_ask(lake: Lake) -> DataFrame:
    """Every benchmark passage and every document asked against an index of all documents; those of the wrong length are refused."""
    index, encoder = lake.index
    questions = lake.table("benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question")).unionByName(
        lake.table("documents").select(F.col("doc_id").alias("question_id"), F.col("text").alias("question"))
    )
    return ask.ask(questions, index, encoder, ASK_RULES).select(
        "question_id", "question", "answer", "is_answerable", _cited("citations").alias("citations"),
        F.size("retrieved_passages").alias("passages"), "refusal_reason",
    )


@query
def evaluation_rates(lake: Lake) -> DataFrame:
    """Share of answered questions by category: benchmark passages as they are, their first words, read backwards, and too short ones."""
    index, encoder = lake.index
    asked = F.array(*[
        F.struct(F.lit(category).alias("category"), question.alias("question"))
        for category, question in (
            ("direct", F.col("text")), ("ambiguous", F.substring("text", 1, 24)), ("unanswerable", F.reverse("text")), ("too short", F.substring("text", 1, 2)),
        )
    ])
    questions = lake.table("benchmark").select(F.col("item_id").alias("question_id"), F.lit(None).cast("string").alias("expected_answer"), F.explode(asked).alias("q"))
    results = ask.evaluate(questions.select("question_id", "expected_answer", "q.*"), index, encoder, ASK_RULES)
    return answers.answerable_rates(results.withColumnRenamed("is_answerable_by_system", "is_answerable"))
