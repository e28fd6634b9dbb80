"""Registered queries of the training-data operators, and the SQL that checks those SQL can express."""

from __future__ import annotations

from loanmill.llm import (
    chat_format, decontaminate, language_id, license_scan, lm_scoring, near_dedup, packing, pii, quality_rules, sharding, spelling_variants,
    toxicity, whitening,
)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_packing": packing.op2_packing,
    "op3_license_scan": license_scan.op3_license_scan,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_sharding": sharding.op7_sharding,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_chat_format": chat_format.op9_chat_format,
    "op10_lm_scoring": lm_scoring.op10_lm_scoring,
    "op11_spelling_variants": spelling_variants.op11_spelling_variants,
    "op12_whitening": whitening.op12_whitening,
    "op13_language_id": language_id.op13_language_id,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SHINGLES = r"""list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))"""

ORACLE = {
    "op4_decontamination": rf"""
WITH items AS (
    SELECT item_id, len(s) AS n, unnest(s) AS g FROM (SELECT item_id, {_SHINGLES} AS s FROM
        (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark))
), docs AS (
    SELECT doc_id, unnest({_SHINGLES}) AS g FROM
        (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
)
SELECT doc_id, item_id, n::BIGINT AS n_item_shingles, count(*) AS n_shared, count(*)::DOUBLE / n AS containment
FROM docs JOIN items USING (g) GROUP BY doc_id, item_id, n HAVING 10 * count(*) >= 8 * n
""",
    "op9_chat_format": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
    -- Escaping adds a backslash for every string that reads as a mark.
    SELECT *, sha256(role || chr(10) || text) AS place, length(text)
        + len(regexp_extract_all(text, '<s>|\[/?INST\]|\[OUT\]|</s>|\[/?ROLE\]|\[/TURN\]'))
        + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 11 ELSE 22 + length(role)
            + len(regexp_extract_all(role, '<s>|\[/?INST\]|\[OUT\]|</s>|\[/?ROLE\]|\[/TURN\]')) END AS size
    FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(size))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
""",
    "op6_near_dedup": rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
    FROM words
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id, doc_id AS other FROM sets
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sets s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
""",
}
