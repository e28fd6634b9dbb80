"""The pipeline's stages one by one, and the registered queries that SQL can express."""

from __future__ import annotations

import compare
import corpus_pipeline
import pytest
from llm_data import prose
from loanmill.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_do_what_they_say(table, tmp_path):
    clean, item = prose(1, 150), prose(77, 40)
    rows = [
        (1, clean, "en", "a", 1), (2, clean, "en", "a", 1), (3, clean.replace(clean.split()[70], "zz", 1), "en", "a", 1),
        (4, prose(2, 150) + " +1 (523) 555-1055 " + prose(3, 9), "en", "a", 1), (5, prose(4, 100) + " " + item + " " + prose(5, 60), "en", "a", 1),
        (6, "too short", "en", "a", 1), (7, None, None, None, None), (8, "same five words again now " * 20, "en", "a", 1), (None, prose(9, 90), "en", "a", 1),
    ] + [(k, prose(k, 120), "en", "b", 1) for k in range(100, 130)]
    docs = table(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    table([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark, kept = docs.sparkSession, set(r[0] for r in rows)
    for (name, stage), gone in zip(corpus_pipeline.STAGES[:4], ({6, 7, 8}, {2, 3}, {5}, set())):
        docs = stage(spark, docs, str(tmp_path))
        kept -= gone
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r.doc_id for r in docs.select("doc_id").collect()} == kept, name
    text = docs.filter("doc_id = 4").first()
    assert "<phone>" in text.text and "555" not in text.text and text.n_chars == len(text.text)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == kept and sum(r.length for r in packed) <= 2048 * len({r.sequence_id for r in packed})


def test_pipeline_of_an_empty_table(table, tmp_path):
    table([]).write.parquet(f"{tmp_path}/documents.parquet")
    table([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark = table([]).sparkSession
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare.differences(QUERIES[name](spark, SF), compare.connect(SF), ORACLE[name]) == []


def test_thirteen_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
