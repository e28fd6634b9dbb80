"""The same results as plain SQL for DuckDB, written independently of the Spark code, for checking only."""

from __future__ import annotations

from loanmill.functions.text import WHITE_SPACE
from loanmill.rules import DTI_BANDS, INCOME_BANDS, LOAN_BANDS, LTV_BANDS, NOT_FOUND

WS = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)
NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
STAMP = r"[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?"


def strip(c: str) -> str:
    return f"trim({c}, {WS})"


def blank_null(c: str) -> str:
    return f"CASE WHEN {strip(c)} <> '' THEN {c} END"


def number(c: str) -> str:
    t = strip(f"replace(replace({c}, ',', ''), '$', '')")
    return f"CASE WHEN regexp_full_match({t}, '{NUMBER}') THEN TRY_CAST({t} AS DOUBLE) END"


def stamp(c: str) -> str:
    return f"CASE WHEN regexp_full_match({strip(c)}, '{STAMP}') THEN TRY_CAST({strip(c)} AS TIMESTAMP) END"


def band(c: str, bands) -> str:
    cases = " ".join(
        f"WHEN {c} >= {low}::DOUBLE" + (f" AND {c} < {high}::DOUBLE" if high is not None else "") + f" THEN '{name}'"
        for low, high, name in bands
    )
    return f"CASE {cases} END"


def r2(x: str) -> str:
    """Half away from zero on the scaled double."""
    return f"(sign({x}) * floor(abs({x}) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE)"


def money(x: str) -> str:
    """Cents of a sum or mean: the noise of summation, far below a millionth, goes first."""
    return r2(f"(sign({x}) * floor(abs({x}) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE)")


def pct(a: str, b: str) -> str:
    return r2(f"(100.0::DOUBLE * {a} / {b})")


NUMBERS = (
    "applicant_income", "loan_amount", "property_value", "interest_rate", "loan_term_months", "debt_to_income_ratio", "loan_to_value_ratio",
)
FEED = r"""
feed AS (
  SELECT
    CASE WHEN l_partkey % 499 = 7 THEN '  ' ELSE l_orderkey || '-' || l_linenumber END AS application_id,
    CASE l_partkey % 101 WHEN 0 THEN 'not-a-date' WHEN 1 THEN '2023-02-30' WHEN 2 THEN '13/45/2024' WHEN 3 THEN gap
      ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS application_date,
    o_custkey::VARCHAR AS applicant_id,
    CASE WHEN l_partkey % 33 = 0 THEN gap WHEN l_partkey % 97 = 5 THEN (-(c_acctbal * 30.0::DOUBLE))::VARCHAR
      ELSE (c_acctbal * 30.0::DOUBLE)::VARCHAR END AS applicant_income,
    CASE WHEN l_partkey % 89 = 11 THEN (-(l_extendedprice * 10.0::DOUBLE))::VARCHAR
      WHEN l_linestatus <> 'F' AND l_suppkey % 20 = 3 THEN '$' || format('{:,.2f}', l_extendedprice * 10.0::DOUBLE)
      ELSE (l_extendedprice * 10.0::DOUBLE)::VARCHAR END AS loan_amount,
    CASE WHEN l_partkey % 83 = 4 THEN (-(o_totalprice * 2.0::DOUBLE))::VARCHAR
      ELSE (o_totalprice * 2.0::DOUBLE)::VARCHAR END AS property_value,
    p_type AS loan_type,
    CASE WHEN l_tax = 0 THEN gap WHEN l_partkey % 199 = 9 THEN '999.0'
      ELSE (l_tax * 100.0::DOUBLE)::VARCHAR END AS interest_rate,
    CASE WHEN l_partkey % 211 = 5 THEN '36.5' ELSE p_size::VARCHAR END AS loan_term_months,
    (l_quantity / 50.0::DOUBLE + CASE WHEN l_partkey % 71 = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)::VARCHAR AS debt_to_income_ratio,
    (l_extendedprice / o_totalprice)::VARCHAR AS loan_to_value_ratio,
    CASE WHEN l_partkey % 307 = 3 THEN 'ZZ' WHEN l_partkey % 25 = 0 THEN '  ' || lower(n_name) || ' ' ELSE n_name END AS property_state,
    CASE WHEN l_partkey % 34 = 1 THEN '   ' ELSE r_name END AS property_county,
    CASE WHEN l_partkey % 401 = 17 THEN gap ELSE s_name END AS lender,
    CASE WHEN l_partkey % 313 = 6 THEN 'Pending' WHEN l_partkey % 29 = 3 THEN 'Incomplete'
      WHEN l_linenumber = 2 THEN upper(st) ELSE st END AS application_status,
    CASE WHEN l_returnflag = 'R' AND o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority ELSE gap END AS denial_reason,
    CASE WHEN l_partkey % 35 = 2 THEN gap ELSE c_mktsegment END AS credit_score_range,
    l_linestatus AS data_source_system,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS created_timestamp,
    CASE WHEN l_partkey % 373 = 1 THEN gap ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END AS updated_timestamp,
    CASE WHEN l_linestatus = 'F' THEN 'feed_F.csv' ELSE 'feed_O.json' END AS _source_file,
    CASE WHEN l_linestatus = 'F' THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '2002-01-02' END AS _ingestion_timestamp
  FROM (
    SELECT *, CASE WHEN l_linestatus = 'F' THEN '' END AS gap,
      CASE l_returnflag WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Denied' ELSE 'Withdrawn' END AS st,
      unnest(CASE WHEN l_partkey % 67 = 0 THEN [1, 2] ELSE [1] END) AS copy
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  )
)"""

TERM = number("loan_term_months")
BRONZE = FEED + f""",
bronze AS (SELECT * FROM feed WHERE {strip("application_id")} <> '')"""

CHECKED = f""",
typed AS (
  SELECT application_id, {stamp("application_date")} AS application_date, {blank_null("applicant_id")} AS applicant_id,
    {number("applicant_income")} AS applicant_income, {number("loan_amount")} AS loan_amount,
    {number("property_value")} AS property_value, {blank_null("loan_type")} AS loan_type,
    {number("interest_rate")} AS interest_rate,
    CASE WHEN {TERM} = floor({TERM}) THEN CAST({TERM} AS INTEGER) END AS loan_term_months,
    {number("debt_to_income_ratio")} AS raw_dti, {number("loan_to_value_ratio")} AS raw_ltv,
    upper({strip("property_state")}) AS property_state, {blank_null("property_county")} AS property_county,
    {blank_null("lender")} AS lender,
    CASE lower({strip("application_status")}) WHEN 'approved' THEN 'Approved' WHEN 'denied' THEN 'Denied'
      WHEN 'withdrawn' THEN 'Withdrawn' WHEN 'incomplete' THEN 'Incomplete' END AS application_status,
    {blank_null("denial_reason")} AS denial_reason, {blank_null("credit_score_range")} AS credit_score_range,
    {blank_null("data_source_system")} AS data_source_system, {stamp("created_timestamp")} AS created_timestamp,
    {stamp("updated_timestamp")} AS updated_timestamp, _source_file, _ingestion_timestamp
  FROM bronze
),
checked AS (
  SELECT *,
    CASE WHEN raw_dti < 0 THEN 0 WHEN raw_dti > 1 THEN 1 ELSE raw_dti END AS debt_to_income_ratio,
    CASE WHEN raw_ltv < 0 THEN 0 WHEN raw_ltv > 2 THEN 2 ELSE raw_ltv END AS loan_to_value_ratio,
    coalesce(raw_dti < 0 OR raw_dti > 1, false) OR coalesce(raw_ltv < 0 OR raw_ltv > 2, false) AS flag_range,
    CASE WHEN application_date IS NULL THEN 'invalid or unparseable application_date'
      WHEN applicant_income NOT BETWEEN 1000 AND 5000000 THEN 'applicant_income outside plausible range [1000, 5000000]'
      WHEN loan_amount NOT BETWEEN 1000 AND 5000000 THEN 'loan_amount outside plausible range [1000, 5000000]'
      WHEN property_value NOT BETWEEN 1000 AND 10000000 THEN 'property_value outside plausible range [1000, 10000000]'
      WHEN interest_rate NOT BETWEEN 0.5::DOUBLE AND 20 THEN 'interest_rate outside plausible range [0.5, 20.0]'
      WHEN property_state IS NULL OR property_state NOT IN (SELECT upper(n_name) FROM nation)
        THEN 'unrecognized property_state after normalization'
      WHEN application_status IS NULL THEN 'unrecognized application_status after normalization' END AS reject_reason
  FROM typed
),
kept AS (SELECT * FROM checked WHERE reject_reason IS NULL),
overall AS (SELECT median(applicant_income) AS all_income, median(interest_rate) AS all_rate FROM kept),
medians AS (
  SELECT loan_type, median(applicant_income) AS own_income, median(interest_rate) AS own_rate
  FROM kept WHERE loan_type IS NOT NULL GROUP BY loan_type
)"""


def silver_chain(kept: str, suffix: str = "") -> str:
    """Imputation, latest version and derived columns over a kept-rows relation."""
    return f""",
filled{suffix} AS (
  SELECT k.* EXCLUDE (applicant_income, interest_rate, property_county, credit_score_range, denial_reason),
    coalesce(applicant_income, own_income, all_income) AS applicant_income,
    coalesce(interest_rate, own_rate, all_rate) AS interest_rate,
    coalesce(property_county, 'Unknown') AS property_county,
    coalesce(credit_score_range, 'Unknown') AS credit_score_range,
    CASE WHEN application_status = 'Denied' THEN coalesce(denial_reason, 'Not Specified') ELSE denial_reason END AS denial_reason,
    applicant_income IS NULL OR interest_rate IS NULL OR property_county IS NULL OR credit_score_range IS NULL
      OR (application_status = 'Denied' AND denial_reason IS NULL) AS flag_missing,
    ROW_NUMBER() OVER (PARTITION BY application_id ORDER BY updated_timestamp DESC NULLS FIRST,
      _ingestion_timestamp DESC NULLS LAST, _source_file DESC NULLS LAST, application_date DESC NULLS LAST,
      applicant_id DESC NULLS LAST, k.applicant_income DESC NULLS LAST, loan_amount DESC NULLS LAST,
      property_value DESC NULLS LAST, loan_type DESC NULLS LAST, k.interest_rate DESC NULLS LAST,
      loan_term_months DESC NULLS LAST, debt_to_income_ratio DESC NULLS LAST, loan_to_value_ratio DESC NULLS LAST,
      property_state DESC NULLS LAST, k.property_county DESC NULLS LAST, lender DESC NULLS LAST,
      application_status DESC NULLS LAST, k.denial_reason DESC NULLS LAST, k.credit_score_range DESC NULLS LAST,
      data_source_system DESC NULLS LAST, created_timestamp DESC NULLS LAST, flag_range DESC NULLS LAST) AS version
  FROM {kept} k LEFT JOIN medians{suffix} USING (loan_type) CROSS JOIN overall{suffix}
),
silver{suffix} AS (
  SELECT application_id, application_date, applicant_id, applicant_income, loan_amount, property_value, loan_type,
    interest_rate, loan_term_months, debt_to_income_ratio, loan_to_value_ratio, property_state, property_county, lender,
    application_status, denial_reason, credit_score_range, data_source_system, created_timestamp, updated_timestamp,
    {band("applicant_income", INCOME_BANDS)} AS income_band, {band("loan_amount", LOAN_BANDS)} AS loan_amount_band,
    {band("debt_to_income_ratio", DTI_BANDS)} AS dti_band, {band("loan_to_value_ratio", LTV_BANDS)} AS ltv_band,
    round_even(date_diff('microsecond', created_timestamp, updated_timestamp)::DOUBLE / 1e6 / 86400.0::DOUBLE, 2)
      AS application_processing_days,
    CAST(application_status = 'Approved' AS INTEGER) AS approval_indicator,
    CAST(coalesce(debt_to_income_ratio >= 0.43::DOUBLE, false) OR coalesce(loan_to_value_ratio >= 0.95::DOUBLE, false)
      OR credit_score_range IN ('MACHINERY') AS INTEGER) AS high_risk_indicator,
    CASE WHEN flag_range OR flag_missing THEN 'flagged' ELSE 'clean' END AS data_quality_status,
    _source_file AS source_file
  FROM filled{suffix} WHERE version = 1
)"""


STAR = """,
applicant AS (
  SELECT applicant_id, income_band AS dim_income_band, credit_score_range AS dim_credit_score_range FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY applicant_id ORDER BY updated_timestamp DESC NULLS FIRST, application_id DESC) AS rn
    FROM silver WHERE applicant_id IS NOT NULL) WHERE rn = 1
),
fact AS (
  SELECT *, lender AS lender_name, strftime(application_date, '%Y-%m') AS year_month,
    CAST(strftime(application_date, '%Y%m%d') AS INTEGER) AS date_key,
    CASE high_risk_indicator WHEN 1 THEN 'High risk' WHEN 0 THEN 'Standard' END AS risk_category
  FROM silver
  WHERE applicant_id IS NOT NULL AND property_state IS NOT NULL AND property_county IS NOT NULL AND lender IS NOT NULL
    AND loan_type IS NOT NULL AND loan_term_months IS NOT NULL
),
viewed AS (
  SELECT * FROM fact WHERE CAST(application_date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
    AND property_state IN ('NATION_1', 'NATION_2', 'NATION_3') AND application_status IN ('Approved', 'Denied')
    AND risk_category = 'High risk'
)"""

EARLY = """,
kept_early AS (SELECT * FROM kept WHERE _source_file = 'feed_F.csv'),
overall_early AS (SELECT median(applicant_income) AS all_income, median(interest_rate) AS all_rate FROM kept_early),
medians_early AS (
  SELECT loan_type, median(applicant_income) AS own_income, median(interest_rate) AS own_rate
  FROM kept_early WHERE loan_type IS NOT NULL GROUP BY loan_type
)"""

# Columns that make a delivery differ from what is stored.
COMPARED = (
    "applicant_income", "loan_amount", "property_value", "interest_rate",
    "debt_to_income_ratio", "loan_to_value_ratio", "application_processing_days", "application_status",
    "denial_reason", "income_band", "loan_amount_band", "dti_band",
    "ltv_band", "approval_indicator", "high_risk_indicator", "data_quality_status",
    "updated_timestamp", "source_file",
)
DIFFERS = " OR ".join(f"n.{c} IS DISTINCT FROM o.{c}" for c in COMPARED)
CLASSIFIED = f""",
loaded_early AS (SELECT * FROM silver_early WHERE applicant_id IS NOT NULL AND property_state IS NOT NULL
  AND property_county IS NOT NULL AND lender IS NOT NULL AND loan_type IS NOT NULL AND loan_term_months IS NOT NULL),
classified AS (
  SELECT n.application_id,
    CASE WHEN o.application_id IS NULL THEN 'NEW' WHEN {DIFFERS} THEN 'UPDATED' ELSE 'UNCHANGED' END AS change_type
  FROM silver n LEFT JOIN loaded_early o ON n.application_id = o.application_id
)"""

KPIS = """
  COUNT(*) AS total_applications, {money_sum} AS total_requested_loan_amount,
  coalesce(100.0::DOUBLE * SUM(approval_indicator) / nullif(COUNT(*), 0), 0) AS approval_rate_pct,
  coalesce(100.0::DOUBLE * COUNT(*) FILTER (application_status = 'Denied') / nullif(COUNT(*), 0), 0) AS denial_rate_pct,
  {mean_loan} AS average_loan_amount, {mean_income} AS average_applicant_income,
  CAST(coalesce(SUM(high_risk_indicator), 0) AS BIGINT) AS high_risk_application_count""".format(
    money_sum=money("coalesce(SUM(loan_amount), 0)"), mean_loan=money("coalesce(AVG(loan_amount), 0)"),
    mean_income=money("coalesce(AVG(applicant_income), 0)"),
)
MONTHLY = f"""year_month, COUNT(*) AS total_applications, CAST(SUM(approval_indicator) AS BIGINT) AS approved_applications,
  100.0::DOUBLE * SUM(approval_indicator) / COUNT(*) AS approval_rate_pct, {money("SUM(loan_amount)")} AS total_loan_amount"""
CHOSEN = "property_state = 'NATION_3' AND loan_type = 'PROMO' AND application_status = 'Approved'"
RATE = pct("SUM(approval_indicator)", "COUNT(*)")
COUNTS = "COUNT(*) AS total_applications, CAST(SUM(approval_indicator) AS BIGINT) AS approved_applications"
APPROVAL = "100.0::DOUBLE * SUM(approval_indicator) / COUNT(*)"

AT_BRONZE = BRONZE
AT_CHECKED = BRONZE + CHECKED
AT_SILVER = AT_CHECKED + silver_chain("kept")
AT_STAR = AT_SILVER + STAR
AT_EARLY = AT_STAR + EARLY + silver_chain("kept_early", "_early") + CLASSIFIED


def key_density(rows: str) -> str:
    """Members and keys of each dimension of the rows."""
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, COUNT(*) AS members, 1::BIGINT AS least_key, COUNT(*) AS greatest_key, COUNT(*) AS distinct_keys "
        f"FROM (SELECT DISTINCT {k} FROM {rows} WHERE {c})"
        for d, k, c in (
            ("dim_applicant", "applicant_id", "applicant_id IS NOT NULL"),
            ("dim_property", "property_state, property_county", "property_county IS NOT NULL"),
            ("dim_lender", "lender", "lender IS NOT NULL"),
            ("dim_loan_product", "loan_type, loan_term_months", "loan_term_months IS NOT NULL"),
        ))


def profile_sql() -> str:
    """Profile by one aggregate per column, stacked."""
    from loanmill import schemas

    parts = []
    for position, c in enumerate(schemas.SOURCE_COLUMNS, start=1):
        value, moment, check = "NULL::DOUBLE", "NULL::TIMESTAMP", "0"
        if c in schemas.NUMERIC_COLUMNS:
            value = number(c)
            check = f"greatest(COUNT(*) FILTER (({value}) IS NULL) - COUNT(*) FILTER ({c} IS NULL OR {strip(c)} = ''), 0)"
        if c in schemas.TIMESTAMP_COLUMNS:
            moment = stamp(c)
            check = f"greatest(COUNT(*) FILTER (({moment}) IS NULL) - COUNT(*) FILTER ({c} IS NULL OR {strip(c)} = ''), 0)"
        mean = f"AVG({value})"
        parts.append(f"""SELECT {position} AS position, '{c}' AS column_name, COUNT(*) AS record_count,
          COUNT(*) FILTER ({c} IS NULL OR {strip(c)} = '') AS null_count,
          round_even(100.0::DOUBLE * COUNT(*) FILTER ({c} IS NULL OR {strip(c)} = '') / COUNT(*), 2) AS null_pct,
          COUNT(DISTINCT {c}) AS distinct_count, CAST({check} AS BIGINT) AS invalid_value_count,
          MIN({value}) AS min_number, MAX({value}) AS max_number,
          sign({mean}) * floor(abs({mean}) * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS mean,
          strftime(MIN({moment}), '%Y-%m-%d %H:%M:%S') AS min_moment, strftime(MAX({moment}), '%Y-%m-%d %H:%M:%S') AS max_moment
          FROM bronze""")
    return ",\nprofiled AS (" + "\nUNION ALL\n".join(parts) + ")"


PROFILE = profile_sql()
ROW_COUNTS = "SELECT COUNT(*) AS record_count, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM bronze)) AS duplicate_count FROM bronze"
ORPHANS = """,
early_applicant AS (SELECT DISTINCT applicant_id FROM loaded_early),
orphans AS (
  SELECT 'dim_applicant' AS dim, COUNT(*) AS orphans FROM fact WHERE applicant_id NOT IN (SELECT applicant_id FROM silver_early WHERE applicant_id IS NOT NULL)
  UNION ALL SELECT 'dim_property', COUNT(*) FROM fact WHERE (property_state, property_county) NOT IN (SELECT (property_state, property_county) FROM silver_early)
  UNION ALL SELECT 'dim_lender', COUNT(*) FROM fact WHERE lender NOT IN (SELECT lender FROM silver_early WHERE lender IS NOT NULL)
  UNION ALL SELECT 'dim_loan_product', COUNT(*) FROM fact f WHERE NOT EXISTS (
    SELECT 1 FROM silver_early e WHERE e.loan_type = f.loan_type AND e.loan_term_months = f.loan_term_months)
  UNION ALL SELECT 'dim_date', COUNT(*) FROM fact WHERE application_date < TIMESTAMP '1995-01-01' OR application_date >= TIMESTAMP '2002-01-01'
)"""
DQ = """,
measures AS (SELECT (SELECT COUNT(*) FROM fact) AS facts, (SELECT COUNT(DISTINCT application_id) FROM silver) AS silvers,
  (SELECT COUNT(*) FROM bronze) AS bronzes, (SELECT COUNT(*) FROM checked WHERE reject_reason IS NOT NULL) AS rejected,
  (SELECT COUNT(*) - COUNT(DISTINCT application_id) FROM fact) AS duplicates,
  (SELECT COUNT(*) FROM fact WHERE application_id IS NULL OR application_date IS NULL OR loan_amount IS NULL
     OR applicant_income IS NULL OR property_value IS NULL OR application_status IS NULL) AS nulls,
  (SELECT COUNT(*) FROM fact WHERE application_date < TIMESTAMP '1995-01-01' OR application_date > TIMESTAMP '2002-01-03') AS dates,
  (SELECT COUNT(*) FROM fact WHERE application_status NOT IN ('Approved', 'Denied', 'Withdrawn', 'Incomplete')) AS statuses,
  (SELECT COUNT(*) FROM fact WHERE loan_amount <= 0 OR applicant_income <= 0 OR property_value <= 0) AS negatives,
  (SELECT COUNT(*) FROM fact WHERE debt_to_income_ratio NOT BETWEEN 0 AND 1 OR loan_to_value_ratio NOT BETWEEN 0 AND 2) AS ratios),
checks AS (
  SELECT 1 AS position, 'required_columns_present' AS name, true AS passed, 'all required columns present' AS details
  UNION ALL SELECT 2, 'no_nulls_in_required_columns', nulls = 0, CASE WHEN nulls = 0 THEN 'no nulls found' ELSE 'nulls' END FROM measures
  UNION ALL SELECT 3, 'no_duplicate_application_ids', duplicates = 0, CASE WHEN duplicates = 0 THEN 'no duplicates' ELSE duplicates || ' duplicate application_id(s) found' END FROM measures
  UNION ALL SELECT 4, 'valid_date_ranges', dates = 0, CASE WHEN dates = 0 THEN 'all dates in range' ELSE dates || ' row(s) outside [1995-01-01, 2002-01-03]' END FROM measures
  UNION ALL SELECT 5, 'accepted_status_values', statuses = 0, CASE WHEN statuses = 0 THEN 'all statuses valid' ELSE statuses || ' row(s) with unrecognized status' END FROM measures
  UNION ALL SELECT 6, 'positive_loan_and_income_values', negatives = 0, CASE WHEN negatives = 0 THEN 'all positive' ELSE negatives || ' row(s) with non-positive financial values' END FROM measures
  UNION ALL SELECT 7, 'dti_ltv_within_range', ratios = 0, CASE WHEN ratios = 0 THEN 'all within range' ELSE ratios || ' row(s) with out-of-range DTI/LTV' END FROM measures
  UNION ALL SELECT 8, 'referential_integrity', true, 'all foreign keys resolve'
  UNION ALL SELECT 9, 'source_to_target_row_reconciliation', silvers = facts,
    CASE WHEN silvers = facts THEN 'silver=' || silvers || ', fact=' || facts || ' (match)' ELSE 'MISMATCH: silver=' || silvers || ', fact=' || facts END FROM measures
  UNION ALL SELECT 10, 'rejected_record_rate_within_threshold', rejected / bronzes <= 0.15::DOUBLE,
    'rejected ' || rejected || '/' || bronzes || ' (' || format('{:.2f}', 100.0::DOUBLE * rejected / bronzes) || '%), threshold 15%' FROM measures
)"""

MARKDOWN = r"""
ended AS (
  SELECT doc_id, source, regexp_replace(text, '[.] (\w+) ', '.' || chr(10) || '## \1' || chr(10), 'g') AS body FROM documents
),
markdown AS (
  SELECT doc_id::VARCHAR AS document,
    CASE WHEN doc_id % 3 = 0 THEN '' ELSE '# ' || source || chr(10) END
      || CASE WHEN doc_id % 5 = 0 THEN replace(body, chr(10), chr(13) || chr(10)) ELSE body END AS text
  FROM ended
)"""
PLAIN = "\nmarkdown AS (SELECT doc_id::VARCHAR AS document, text FROM documents)"
SECTIONS = rf""",
cleaned AS (
  SELECT document, {strip(r"regexp_replace(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')")} AS text
  FROM markdown
),
titled AS (
  SELECT document, text, CASE WHEN regexp_extract(text, '(?m)^# ([^\n]+)$', 1) <> ''
    THEN {strip(r"regexp_extract(text, '(?m)^# ([^\n]+)$', 1)")} ELSE document END AS title,
    string_split_regex(chr(10) || text, '\n## ') AS parts
  FROM cleaned
),
numbered AS (
  SELECT document, title, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS section_no FROM titled
),
named AS (
  SELECT document, title, section_no,
    CASE WHEN section_no = 0 THEN 'Overview' ELSE {strip("string_split(part, chr(10))[1]")} END AS section_title,
    [line FOR line IN (CASE WHEN section_no = 0 THEN string_split(part, chr(10)) ELSE string_split(part, chr(10))[2:] END)
      IF NOT starts_with(line, '# ')] AS lines
  FROM numbered
),
sections AS (
  SELECT document, title, section_no, section_title, body FROM (
    SELECT *, {strip("array_to_string(lines, chr(10))")} AS body FROM named) WHERE body <> ''
)"""
CHUNKS = """,
windows AS (
  SELECT *, CASE WHEN length(body) <= 900 THEN 1 ELSE CAST(ceil((length(body) - 150) / 750.0::DOUBLE) AS BIGINT) END AS n FROM sections
),
pieces AS (SELECT *, unnest(range(n)) AS i FROM windows)"""
NEIGHBOURS = """
scored AS (
  SELECT q.vec_id AS question_id, c.vec_id AS chunk_id,
    round(list_inner_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 9) AS score
  FROM embeddings q, embeddings c
),
nearest AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) AS rank FROM scored)
  WHERE rank <= 4
)"""
PASSAGES = """
passages AS (
  SELECT coalesce(doc_id, -1 - vec_id) AS chunk_id, embedding, coalesce(source, 'none') AS document_name, coalesce(lang, 'none') AS section_title,
    coalesce(text, '') AS text
  FROM embeddings LEFT JOIN documents ON doc_id % (SELECT COUNT(*) FROM embeddings) = vec_id
),
scored AS (
  SELECT q.vec_id AS question_id, c.* EXCLUDE (embedding), round(list_inner_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 9) AS score
  FROM embeddings q, passages c
)"""


DAMAGED = """,
damaged AS (
  SELECT application_id,
    CASE WHEN application_id LIKE '%7-1' THEN 'Pending' ELSE application_status END AS application_status,
    CASE WHEN application_id LIKE '%8-2' THEN -loan_amount ELSE loan_amount END AS loan_amount,
    CASE WHEN application_id LIKE '%9-1' THEN 5 ELSE loan_to_value_ratio END AS loan_to_value_ratio, debt_to_income_ratio,
    CASE WHEN application_id NOT LIKE '%5-1' THEN applicant_income END AS applicant_income, property_value,
    CASE WHEN application_id LIKE '%4-2' THEN TIMESTAMP '2050-01-01' ELSE application_date END AS application_date,
    application_id LIKE '%6-1' AS lost
  FROM fact, unnest(CASE WHEN application_id LIKE '%3-3' THEN [1, 2] ELSE [1] END)
),
measures AS (
  SELECT COUNT(*) AS facts, COUNT(*) - COUNT(DISTINCT application_id) AS duplicates, COUNT(*) FILTER (application_status IS NULL) AS no_status,
    COUNT(*) FILTER (applicant_income IS NULL) AS no_income, COUNT(*) FILTER (loan_amount IS NULL) AS no_loan, COUNT(*) FILTER (property_value IS NULL) AS no_value,
    COUNT(*) FILTER (application_date < TIMESTAMP '1995-01-01' OR application_date > TIMESTAMP '2002-01-03') AS dates,
    COUNT(*) FILTER (application_status IS NULL OR application_status NOT IN ('Approved', 'Denied', 'Withdrawn', 'Incomplete')) AS statuses,
    COUNT(*) FILTER (loan_amount <= 0 OR applicant_income <= 0 OR property_value <= 0) AS negatives,
    COUNT(*) FILTER (debt_to_income_ratio NOT BETWEEN 0 AND 1 OR loan_to_value_ratio NOT BETWEEN 0 AND 2) AS ratios,
    COUNT(*) FILTER (lost) AS lost, (SELECT COUNT(DISTINCT application_id) FROM silver) AS silvers, (SELECT COUNT(*) FROM bronze) AS bronzes,
    (SELECT 3 * COUNT(*) FROM checked WHERE reject_reason IS NOT NULL) AS rejected
  FROM damaged
),
checks AS (
  SELECT 1 AS position, 'required_columns_present' AS name, true AS passed, 'all required columns present' AS details
  UNION ALL SELECT 2, 'no_nulls_in_required_columns', no_status + no_income + no_loan + no_value = 0,
    CASE WHEN no_status + no_income + no_loan + no_value = 0 THEN 'no nulls found' ELSE 'null counts: {' || concat_ws(', ',
      CASE WHEN no_loan > 0 THEN chr(39) || 'loan_amount' || chr(39) || ': ' || no_loan END, CASE WHEN no_income > 0 THEN chr(39) || 'applicant_income' || chr(39) || ': ' || no_income END,
      CASE WHEN no_value > 0 THEN chr(39) || 'property_value' || chr(39) || ': ' || no_value END,
      CASE WHEN no_status > 0 THEN chr(39) || 'application_status' || chr(39) || ': ' || no_status END) || '}' END FROM measures
  UNION ALL SELECT 3, 'no_duplicate_application_ids', duplicates = 0, CASE WHEN duplicates = 0 THEN 'no duplicates' ELSE duplicates || ' duplicate application_id(s) found' END FROM measures
  UNION ALL SELECT 4, 'valid_date_ranges', dates = 0, CASE WHEN dates = 0 THEN 'all dates in range' ELSE dates || ' row(s) outside [1995-01-01, 2002-01-03]' END FROM measures
  UNION ALL SELECT 5, 'accepted_status_values', statuses = 0, CASE WHEN statuses = 0 THEN 'all statuses valid' ELSE statuses || ' row(s) with unrecognized status' END FROM measures
  UNION ALL SELECT 6, 'positive_loan_and_income_values', negatives = 0, CASE WHEN negatives = 0 THEN 'all positive' ELSE negatives || ' row(s) with non-positive financial values' END FROM measures
  UNION ALL SELECT 7, 'dti_ltv_within_range', ratios = 0, CASE WHEN ratios = 0 THEN 'all within range' ELSE ratios || ' row(s) with out-of-range DTI/LTV' END FROM measures
  UNION ALL SELECT 8, 'referential_integrity', lost = 0, CASE WHEN lost = 0 THEN 'all foreign keys resolve' ELSE lost || ' orphaned fact row reference(s)' END FROM measures
  UNION ALL SELECT 9, 'source_to_target_row_reconciliation', silvers = facts,
    CASE WHEN silvers = facts THEN 'silver=' || silvers || ', fact=' || facts || ' (match)' ELSE 'MISMATCH: silver=' || silvers || ', fact=' || facts END FROM measures
  UNION ALL SELECT 10, 'rejected_record_rate_within_threshold', rejected / bronzes <= 0.15::DOUBLE,
    'rejected ' || rejected || '/' || bronzes || ' (' || format('{:.2f}', 100.0::DOUBLE * rejected / bronzes) || '%), threshold 15%' FROM measures
)"""


def composed(min_score: float) -> str:
    """Answers from `scored` (question_id, chunk_id, document_name, section_title, text, score)."""
    return f""",
found AS (
  SELECT *, score >= {min_score}::DOUBLE AS relevant FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) AS rank FROM scored) WHERE rank <= 4
),
firsts AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY question_id, relevant, document_name, section_title ORDER BY rank) AS again FROM found),
chosen AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY rank) AS place FROM firsts WHERE relevant AND again = 1),
composed AS (
  SELECT p.question_id, coalesce(string_agg(c.text, chr(10) || chr(10) ORDER BY p.rank), '{NOT_FOUND.replace("'", "''")}') AS answer,
    COUNT(c.text) > 0 AS is_answerable,
    coalesce(string_agg(c.document_name || '|' || c.section_title || '|' || format('{{:.4f}}', round_even(c.score, 4)), ';' ORDER BY p.rank), '') AS citations,
    CAST(COUNT(*) AS INTEGER) AS passages
  FROM found p LEFT JOIN (SELECT * FROM chosen WHERE place <= 2) c ON c.question_id = p.question_id AND c.rank = p.rank
  GROUP BY p.question_id
)"""


# Words hashed to 512 buckets by their MD5, weighted by rarity over all chunks, unit length, compared in single precision.
def buckets(rows: str) -> str:
    return f"""SELECT id, b, COUNT(*) AS n FROM (
      SELECT id, ('0x' || substr(md5(unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'))), 1, 8))::BIGINT % 512 AS b FROM {rows}) GROUP BY ALL"""


def weighted(counts: str) -> str:
    return f"""SELECT id, b, (n * w / sqrt(SUM(n * w * n * w) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS v FROM {counts} JOIN weights USING (b)"""


def asked(questions: str) -> str:
    """Scores of all pairs of `questions` (id, question) of the right length and chunks, and answers of all questions."""
    return f"""
questions AS ({questions}),
askable AS (SELECT id, question AS text FROM questions WHERE length(question) BETWEEN 3 AND 500),""" + PLAIN + SECTIONS + CHUNKS + f""",
passages AS (
  SELECT printf('%s#%06d.%06d', document, section_no, i) AS id, title AS document_name,
    section_title || CASE WHEN n > 1 THEN ' (part ' || (i + 1) || ')' ELSE '' END AS section_title,
    title || ' — ' || section_title || chr(10) || substr(body, i * 750 + 1, 900) AS text
  FROM pieces
),
chunk_counts AS ({buckets("passages")}),
question_counts AS ({buckets("askable")}),
weights AS (
  SELECT b, round(ln((1.0::DOUBLE + (SELECT COUNT(*) FROM passages)) / (1.0::DOUBLE + held)) + 1.0::DOUBLE, 6) AS w
  FROM (SELECT r.b, COUNT(c.id) AS held FROM (SELECT unnest(range(512)) AS b) r LEFT JOIN chunk_counts c USING (b) GROUP BY r.b)
),
chunk_vectors AS ({weighted("chunk_counts")}),
question_vectors AS ({weighted("question_counts")}),
products AS (
  SELECT q.id AS question_id, c.id AS chunk_id, SUM(q.v * c.v) AS score FROM question_vectors q JOIN chunk_vectors c USING (b) GROUP BY ALL
),
scored AS (
  SELECT q.id AS question_id, p.id AS chunk_id, p.document_name, p.section_title, p.text, round(coalesce(s.score, 0), 9) AS score
  FROM askable q CROSS JOIN passages p LEFT JOIN products s ON s.question_id = q.id AND s.chunk_id = p.id
)""" + composed(0.5)


def _with(prefix: str, body: str) -> str:
    return f"WITH {prefix.strip()}\n{body}".replace("round_even(", "round_half_even_placeholder(")


def _finish(sql: str) -> str:
    """Expand round_even(x, 2): half to even on the scaled double."""
    marker = "round_half_even_placeholder("
    while marker in sql:
        start = sql.index(marker)
        depth, end = 1, start + len(marker)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[start + len(marker) : end - 1]
        value, digits = inner.rsplit(",", 1)
        scale = f"{float(10 ** int(digits))}::DOUBLE"
        sql = f"{sql[:start]}(round_even(({value}) * {scale}, 0) / {scale}){sql[end:]}"
    return sql


def oracle() -> dict[str, str]:
    top = lambda columns, grouped, order, n: f"SELECT {columns} FROM fact GROUP BY {grouped} ORDER BY {order} LIMIT {n}"
    sql = {
        "ingest_counts": _with(FEED, f"""SELECT _source_file, COUNT(*) FILTER ({strip("application_id")} <> '') AS loaded,
            COUNT(*) FILTER ({strip("application_id")} = '') AS rejected FROM feed GROUP BY _source_file"""),
        "medians_of_large_groups": """SELECT CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS returned,
            median(l_extendedprice) AS l_extendedprice_median, median(CASE WHEN l_linenumber > 1 THEN l_discount END) AS discount_median,
            median((l_partkey % 2)::DOUBLE) AS parity_median FROM lineitem GROUP BY 1""",
        "ingest_csv_json": _with(FEED, f"""SELECT * EXCLUDE (_source_file, _ingestion_timestamp)
            REPLACE ({", ".join(f"{number(c)} AS {c}" for c in NUMBERS)}),
            {strip("application_id")} = '' AS quarantined, CASE _source_file WHEN 'feed_F.csv' THEN 'csv' ELSE 'json' END AS format,
            TIMESTAMP '2002-01-02' AS _ingestion_timestamp FROM feed"""),
        "quarantined_rows": _with(FEED, f"""SELECT applicant_id, lender, application_status, _source_file FROM feed
            WHERE {strip("application_id")} = ''"""),
        "parsed_types": _with(AT_CHECKED, """SELECT application_id, application_date, created_timestamp, updated_timestamp,
            applicant_income, loan_amount, property_value, interest_rate, loan_term_months, property_state,
            application_status, property_county, lender, denial_reason, credit_score_range FROM checked"""),
        "clip_and_flag": _with(AT_CHECKED, "SELECT application_id, debt_to_income_ratio, loan_to_value_ratio, flag_range FROM checked"),
        "reject_log": _with(AT_CHECKED, """SELECT application_id, 'transformation' AS stage, reject_reason AS reason
            FROM checked WHERE reject_reason IS NOT NULL"""),
        "reject_reasons": _with(AT_CHECKED, """SELECT reject_reason AS reason, COUNT(*) AS rejected FROM checked
            WHERE reject_reason IS NOT NULL GROUP BY reject_reason"""),
        "impute_medians": _with(AT_CHECKED, """SELECT loan_type, coalesce(own_income, all_income) AS applicant_income_fill,
            coalesce(own_rate, all_rate) AS interest_rate_fill FROM medians, overall
            UNION ALL SELECT NULL, all_income, all_rate FROM overall"""),
        "imputed_rows": _with(AT_SILVER, """SELECT application_id, applicant_income, interest_rate, property_county,
            credit_score_range, denial_reason, flag_missing FROM filled"""),
        "exact_duplicates": _with(AT_BRONZE, """SELECT application_id, CAST(SUM(n - 1) AS BIGINT) AS surplus_copies FROM (
            SELECT * EXCLUDE (_ingestion_timestamp), COUNT(*) AS n FROM bronze GROUP BY ALL) WHERE n > 1 GROUP BY application_id"""),
        "dedup_latest": _with(AT_SILVER, """SELECT application_id, updated_timestamp, loan_amount, application_status, lender,
            _source_file FROM filled WHERE version = 1"""),
        "silver_clean": _with(AT_SILVER, "SELECT * FROM silver"),
        "bands_and_risk": _with(AT_SILVER, """SELECT income_band, loan_amount_band, dti_band, ltv_band, high_risk_indicator,
            data_quality_status, COUNT(*) AS applications, CAST(SUM(approval_indicator) AS BIGINT) AS approved FROM silver
            GROUP BY ALL"""),
        "processing_days": _with(AT_SILVER, "SELECT application_id, application_processing_days FROM silver"),
        "stage_counters": _with(AT_SILVER, """SELECT 'read' AS counter, COUNT(*) AS n FROM bronze
            UNION ALL SELECT 'rejected', COUNT(*) FROM checked WHERE reject_reason IS NOT NULL
            UNION ALL SELECT 'written', COUNT(*) FROM silver
            UNION ALL SELECT 'flagged', COUNT(*) FROM silver WHERE data_quality_status = 'flagged'"""),
        "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
            CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
            strftime(d, '%B') AS month_name, strftime(d, '%Y-%m') AS year_month, CAST(day(d) AS INTEGER) AS day_of_month,
            CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name
            FROM (SELECT unnest(range(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""",
        "dim_property": _with(AT_SILVER, """SELECT DISTINCT property_state, property_county FROM silver
            WHERE property_state IS NOT NULL AND property_county IS NOT NULL"""),
        "dim_lender": _with(AT_SILVER, "SELECT DISTINCT lender AS lender_name FROM silver WHERE lender IS NOT NULL"),
        "dim_loan_product": _with(AT_SILVER, """SELECT DISTINCT loan_type, loan_term_months FROM silver
            WHERE loan_type IS NOT NULL AND loan_term_months IS NOT NULL"""),
        "dim_applicant_latest": _with(AT_STAR, """SELECT applicant_id, dim_income_band AS income_band,
            dim_credit_score_range AS credit_score_range FROM applicant"""),
        "dim_applicant_after_update": _with(AT_EARLY, """SELECT applicant_id, dim_income_band AS income_band,
            dim_credit_score_range AS credit_score_range FROM applicant
            UNION ALL SELECT applicant_id, income_band, credit_score_range FROM (
                SELECT *, ROW_NUMBER() OVER (PARTITION BY applicant_id ORDER BY updated_timestamp DESC NULLS FIRST, application_id DESC) AS rn
                FROM silver_early WHERE applicant_id NOT IN (SELECT applicant_id FROM applicant)) WHERE rn = 1"""),
        "dim_key_density": _with(AT_SILVER, key_density("silver")),
        "dim_keys_after_update": _with(AT_EARLY, key_density("(SELECT * FROM silver UNION ALL SELECT * FROM silver_early)")),
        "relanded_bronze": _with(FEED, f"""SELECT _source_file, COUNT(*) FILTER ({strip("application_id")} <> '') AS loaded,
            COUNT(*) FILTER ({strip("application_id")} = '' AND _source_file <> 'feed_F.csv') AS rejected FROM feed GROUP BY _source_file"""),
        "refused_questions": """SELECT doc_id AS question_id, length(text) AS question_chars FROM documents
            WHERE text IS NULL OR length(text) < 3 OR length(text) > 500""",
        "fact_resolved": _with(AT_STAR, """SELECT application_id, date_key, applicant_id, property_state, property_county,
            lender_name, loan_type, loan_term_months, applicant_income, loan_amount, interest_rate,
            application_processing_days, application_status, denial_reason, updated_timestamp, source_file FROM fact"""),
        "gold_rejects": _with(AT_STAR, """SELECT application_id, 'dimensional_load' AS stage, 'missing dimension key' AS reason
            FROM silver WHERE application_id NOT IN (SELECT application_id FROM fact)"""),
        "change_classification": _with(AT_EARLY, "SELECT * FROM classified"),
        "change_counts": _with(AT_EARLY, "SELECT change_type, COUNT(*) AS applications FROM classified GROUP BY change_type"),
        "fact_upsert": _with(AT_EARLY, f"""SELECT application_id, {", ".join(COMPARED)} FROM fact
            UNION ALL SELECT application_id, {", ".join(COMPARED)} FROM loaded_early
            WHERE application_id NOT IN (SELECT application_id FROM fact)"""),
        "q01": _with(AT_STAR, f"SELECT year_month, {COUNTS}, {RATE} AS approval_rate_pct FROM fact GROUP BY year_month"),
        "q02": _with(AT_STAR, f"""SELECT property_state, total_applications, approved_applications, approval_rate_pct,
            CASE WHEN hi <= 5 THEN 'Top 5 highest' ELSE 'Bottom 5 lowest' END AS category FROM (
              SELECT *, RANK() OVER (ORDER BY approval_rate_pct DESC) AS hi, RANK() OVER (ORDER BY approval_rate_pct) AS lo FROM (
                SELECT property_state, {COUNTS}, {RATE} AS approval_rate_pct FROM fact GROUP BY property_state HAVING COUNT(*) >= 100))
            WHERE hi <= 5 OR lo <= 5"""),
        "q03": _with(AT_STAR, """SELECT property_state, denial_reason, denial_count FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY property_state ORDER BY denial_count DESC, denial_reason) AS rn FROM (
              SELECT property_state, denial_reason, COUNT(*) AS denial_count FROM fact WHERE application_status = 'Denied'
              GROUP BY ALL)) WHERE rn = 1"""),
        "q04": _with(AT_STAR, f"""SELECT lender_name, loan_type, COUNT(*) AS applications,
            {money("AVG(loan_amount)")} AS avg_loan_amount, {money("MEDIAN(loan_amount)")} AS median_loan_amount FROM fact GROUP BY ALL"""),
        "q05": _with(AT_STAR, f"""SELECT dim_income_band AS income_band, {COUNTS}, {RATE} AS approval_rate_pct
            FROM fact JOIN applicant USING (applicant_id) GROUP BY dim_income_band"""),
        "q06": _with(AT_STAR, f"""SELECT lender_name, year_month, applications, prior AS prior_month_applications,
            applications - prior AS change_in_applications, {pct("(applications - prior)", "prior")} AS pct_change FROM (
              SELECT *, LAG(applications) OVER (PARTITION BY lender_name ORDER BY year_month) AS prior FROM (
                SELECT lender_name, year_month, COUNT(*) AS applications FROM fact GROUP BY ALL))
            WHERE prior IS NOT NULL ORDER BY abs(applications - prior) DESC, lender_name, year_month LIMIT 20"""),
        "q07": _with(AT_STAR, f"""SELECT n AS total_applications, a AS high_dti_count, {pct("a", "n")} AS high_dti_pct,
            b AS high_ltv_count, {pct("b", "n")} AS high_ltv_pct, c AS high_dti_or_ltv_count, {pct("c", "n")} AS high_dti_or_ltv_pct
            FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (debt_to_income_ratio >= 0.43::DOUBLE) AS a,
              COUNT(*) FILTER (loan_to_value_ratio >= 0.95::DOUBLE) AS b,
              COUNT(*) FILTER (debt_to_income_ratio >= 0.43::DOUBLE OR loan_to_value_ratio >= 0.95::DOUBLE) AS c FROM fact)"""),
        "q08": _with(AT_STAR, """SELECT property_state, CAST(lender_rank AS INTEGER) AS lender_rank, lender_name, applications FROM (
            SELECT *, DENSE_RANK() OVER (PARTITION BY property_state ORDER BY applications DESC) AS lender_rank FROM (
              SELECT property_state, lender_name, COUNT(*) AS applications FROM fact GROUP BY ALL)) WHERE lender_rank <= 5"""),
        "q09": _with(AT_BRONZE, """SELECT *, CASE WHEN distinct_statuses > 1 OR distinct_loan_amounts > 1 THEN 'Conflicting information'
            ELSE 'Exact duplicate delivery' END AS conflict_type FROM (
              SELECT application_id, COUNT(*) AS version_count, COUNT(DISTINCT application_status) AS distinct_statuses,
                COUNT(DISTINCT loan_amount) AS distinct_loan_amounts, COUNT(DISTINCT _source_file) AS distinct_source_files
              FROM bronze GROUP BY application_id HAVING COUNT(*) > 1)"""),
        "q10": _with(AT_STAR, f"""SELECT *, {pct("rolling_3mo_approved_applications", "rolling_3mo_total_applications")} AS rolling_3mo_approval_rate_pct
            FROM (SELECT *, CAST(SUM(total_applications) OVER w AS BIGINT) AS rolling_3mo_total_applications,
              CAST(SUM(approved_applications) OVER w AS BIGINT) AS rolling_3mo_approved_applications
            FROM (SELECT year_month, {COUNTS} FROM fact GROUP BY year_month)
            WINDOW w AS (ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""),
        "portfolio_summary": _with(AT_STAR, f"SELECT {KPIS} FROM fact"),
        "portfolio_summary_filtered": _with(AT_STAR, f"SELECT {KPIS} FROM fact WHERE {CHOSEN}"),
        "portfolio_summary_empty": _with(AT_STAR, f"SELECT {KPIS} FROM fact WHERE lender_name = 'no such lender'"),
        "portfolio_trends": _with(AT_STAR, f"SELECT {MONTHLY} FROM fact GROUP BY year_month"),
        "portfolio_trends_filtered": _with(AT_STAR, f"SELECT {MONTHLY} FROM fact WHERE {CHOSEN} GROUP BY year_month"),
        "portfolio_view": _with(AT_STAR, """SELECT application_id, CAST(application_date AS DATE) AS application_date, year_month,
            property_state, property_county, lender_name, loan_type, loan_term_months, applicant_income, loan_amount,
            property_value, interest_rate, debt_to_income_ratio, loan_to_value_ratio, application_status, denial_reason,
            income_band, loan_amount_band, dti_band, ltv_band, approval_indicator, high_risk_indicator,
            data_quality_status, risk_category FROM fact"""),
        "executive_summary": _with(AT_STAR, f"SELECT {KPIS} FROM viewed"),
        "monthly_filtered": _with(AT_STAR, f"SELECT {MONTHLY} FROM viewed GROUP BY year_month"),
        "match_counts": _with(AT_STAR, """SELECT (SELECT COUNT(*) FROM viewed) AS matching_applications,
            (SELECT COUNT(*) FROM fact) AS all_applications"""),
        "by_state": _with(AT_STAR, f"""SELECT property_state, COUNT(*) AS applications, CAST(SUM(approval_indicator) AS BIGINT) AS approved,
            {money("AVG(loan_amount)")} AS avg_loan_amount, {APPROVAL} AS approval_rate_pct FROM fact GROUP BY property_state"""),
        "by_lender": _with(AT_STAR, f"""SELECT lender_name, COUNT(*) AS applications, CAST(SUM(approval_indicator) AS BIGINT) AS approved,
            {APPROVAL} AS approval_rate_pct FROM fact GROUP BY lender_name"""),
        "by_product": _with(AT_STAR, f"SELECT loan_type, {money('SUM(loan_amount)')} AS loan_volume, COUNT(*) AS applications FROM fact GROUP BY loan_type"),
        "denial_counts": _with(AT_STAR, """SELECT property_state, denial_reason, COUNT(*) AS count FROM fact
            WHERE application_status = 'Denied' AND denial_reason IS NOT NULL GROUP BY ALL"""),
        "top_denial_by_state": _with(AT_STAR, """SELECT property_state, denial_reason, count FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY property_state ORDER BY count DESC, denial_reason) AS rn FROM (
              SELECT property_state, denial_reason, COUNT(*) AS count FROM fact
              WHERE application_status = 'Denied' AND denial_reason IS NOT NULL GROUP BY ALL)) WHERE rn = 1"""),
        **{
            f"{which}_histogram": _with(AT_STAR, f"""SELECT {which}_band, COUNT(*) AS applications,
                CAST(CASE {which}_band {" ".join(f"WHEN '{b[2]}' THEN {i}" for i, b in enumerate(bands, 1))} END AS INTEGER) AS band_order
                FROM fact WHERE {which}_band IS NOT NULL GROUP BY {which}_band""")
            for which, bands in (("dti", DTI_BANDS), ("ltv", LTV_BANDS))
        },
        "filter_domains": _with(AT_STAR, " UNION ALL ".join(
            f"SELECT DISTINCT '{c}' AS filter_name, {c} AS value FROM fact WHERE {c} IS NOT NULL"
            for c in ("property_state", "lender_name", "loan_type", "application_status", "risk_category")
        ) + """ UNION ALL SELECT DISTINCT 'application_date', CAST(unnest([MIN(CAST(application_date AS DATE)), MAX(CAST(application_date AS DATE))]) AS VARCHAR) FROM fact"""),
        "top20_states_by_applications": _with(AT_STAR, top("property_state, COUNT(*) AS applications", "property_state", "applications DESC, property_state", 20)),
        "top20_states_by_approval": _with(AT_STAR, top(f"property_state, {APPROVAL} AS approval_rate_pct", "property_state", "approval_rate_pct DESC, property_state", 20)),
        "top20_states_by_avg_loan": _with(AT_STAR, top(f"property_state, {money('AVG(loan_amount)')} AS avg_loan_amount", "property_state", "AVG(loan_amount) DESC, property_state", 20)),
        "top15_lenders": _with(AT_STAR, top("lender_name, COUNT(*) AS applications", "lender_name", "applications DESC, lender_name", 15)),
        "lenders_by_approval": _with(AT_STAR, f"""SELECT lender_name, COUNT(*) AS applications, CAST(SUM(approval_indicator) AS BIGINT) AS approved,
            {APPROVAL} AS approval_rate_pct FROM fact GROUP BY lender_name"""),
        "dq_checks": _with(AT_STAR + DQ, "SELECT * FROM checks"),
        "dq_checks_failing": _with(AT_STAR + DAMAGED, "SELECT * FROM checks"),
        "profile_sketch": _with(AT_BRONZE + PROFILE, """SELECT position, column_name, record_count, null_count, null_pct,
            true AS distinct_within_bound, true AS distinct_is_approximate, invalid_value_count, min_number, max_number, mean FROM profiled"""),
        "run_log": _with(AT_STAR, """SELECT 'run-1' AS run_id, 'transformation' AS stage, 'SUCCESS' AS status, (SELECT COUNT(*) FROM bronze) AS rows_read,
            (SELECT COUNT(*) FROM silver) AS rows_new, 0::BIGINT AS rows_updated, 0::BIGINT AS rows_unchanged,
            (SELECT COUNT(*) FROM checked WHERE reject_reason IS NOT NULL) AS rows_rejected, NULL::VARCHAR AS error_message
            UNION ALL SELECT 'run-1', 'dimensional_load', 'SUCCESS', silvers, facts, 0, 0, silvers - facts, NULL
            FROM (SELECT (SELECT COUNT(*) FROM silver) AS silvers, (SELECT COUNT(*) FROM fact) AS facts)"""),
        "dq_rollup": _with(AT_STAR + DQ, """SELECT CASE WHEN bool_and(passed) THEN 'PASS' ELSE 'FAIL' END AS overall_status,
            COUNT(*) FILTER (passed) AS checks_passed, COUNT(*) AS checks_total FROM checks"""),
        "dq_orphans": _with(AT_EARLY + ORPHANS, "SELECT * FROM orphans WHERE orphans > 0"),
        "dq_duplicate_ids": _with(AT_BRONZE, "SELECT COUNT(*) - COUNT(DISTINCT application_id) AS duplicates FROM bronze"),
        "profile_columns": _with(AT_BRONZE + PROFILE, "SELECT * FROM profiled"),
        "profile_row_counts": _with(AT_BRONZE, ROW_COUNTS),
        "profile_concerns": _with(AT_BRONZE + PROFILE, f"""SELECT 0 AS position, duplicate_count || ' exact duplicate row(s) found.' AS concern
            FROM ({ROW_COUNTS}) WHERE duplicate_count > 0
            UNION ALL SELECT position, 'Column ''' || column_name || ''' has ' || null_pct || '% missing values.' FROM profiled WHERE null_pct > 2
            UNION ALL SELECT position, 'Column ''' || column_name || ''' has ' || invalid_value_count || ' value(s) that fail type validation.'
              FROM profiled WHERE invalid_value_count > 0"""),
        "latest_run_stages": """WITH log AS (SELECT 'run-' || user_id AS run_id, event_type AS stage, ts AS started_at, value >= 1 AS done, event_id FROM events),
            cur AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id, stage ORDER BY started_at DESC, done DESC) AS rn FROM log) WHERE rn = 1)
            SELECT run_id, stage, started_at, CASE WHEN done THEN 'SUCCESS' ELSE 'RUNNING' END AS status, event_id AS rows_read
            FROM cur WHERE run_id = (SELECT run_id FROM cur ORDER BY started_at DESC, run_id DESC LIMIT 1)""",
        "doc_sections": _with(MARKDOWN + SECTIONS, "SELECT * FROM sections"),
        "doc_chunks": _with(PLAIN + SECTIONS + CHUNKS, """SELECT
            document || '::' || section_title || CASE WHEN n > 1 THEN ' (part ' || (i + 1) || ')' ELSE '' END AS chunk_id,
            title AS document_name, section_title || CASE WHEN n > 1 THEN ' (part ' || (i + 1) || ')' ELSE '' END AS section_title,
            title || ' — ' || section_title || chr(10) || substr(body, i * 750 + 1, 900) AS text FROM pieces"""),
        "vector_topk": _with(NEIGHBOURS, """SELECT question_id, chunk_id, CAST(rank AS INTEGER) AS rank,
            round_even(score, 4) AS score FROM nearest"""),
        "vector_topk_blocks": _with(NEIGHBOURS, """SELECT question_id, chunk_id, CAST(rank AS INTEGER) AS rank,
            round_even(score, 4) AS score FROM nearest"""),
        "answer_compose": _with(PASSAGES + composed(0.3), "SELECT * FROM composed"),
        "batch_ask": _with(asked("SELECT 'b' || item_id AS id, item_id AS question_id, text AS question FROM benchmark "
                                 "UNION ALL SELECT 'd' || doc_id, doc_id, text FROM documents"), f"""
            SELECT q.question_id, q.question, coalesce(c.answer, '{NOT_FOUND.replace("'", "''")}') AS answer, coalesce(c.is_answerable, false) AS is_answerable,
              coalesce(c.citations, '') AS citations, coalesce(c.passages, 0) AS passages,
              CASE WHEN coalesce(length(q.question) NOT BETWEEN 3 AND 500, true) THEN 'a question has 3 to 500 characters' END AS refusal_reason
            FROM questions q LEFT JOIN composed c ON c.question_id = q.id"""),
        "evaluation_rates": _with(asked("""SELECT c || item_id AS id, c AS category,
              CASE c WHEN 'direct' THEN text WHEN 'ambiguous' THEN substr(text, 1, 24) WHEN 'unanswerable' THEN reverse(text) ELSE substr(text, 1, 2) END AS question
            FROM benchmark, unnest(['direct', 'ambiguous', 'unanswerable', 'too short']) AS t(c)"""), """
            SELECT category, COUNT(*) AS questions, COUNT(*) FILTER (is_answerable) AS answered,
              100.0::DOUBLE * COUNT(*) FILTER (is_answerable) / COUNT(*) AS answered_pct
            FROM questions q LEFT JOIN composed c ON c.question_id = q.id GROUP BY category"""),
    }
    return {name: _finish(text) for name, text in sql.items()}
