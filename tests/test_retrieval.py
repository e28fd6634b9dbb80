import hashlib
import math
import re
import tracemalloc
from collections import Counter
from time import perf_counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanmill.operators import answers, chunking, vectors
from loanmill.plans import ask
from loanmill.rules import NOT_FOUND, Rules

GUIDE = (
    "# Lending Guide \r\nIntro   text\twith blanks\r\n\r\n\r\n\r\nmore\r\n## First  Part \r\nbody one\r\n### deeper\r\nstill one\r\n"
    "# stray title\r\ntail\r\n## Empty\r\n\r\n## Last\r\nend"
)


def documents(spark, *rows):
    return spark.createDataFrame(list(rows), "document string, text string")


def test_sections(spark):
    rows = chunking.sections(documents(spark, ("guide", GUIDE), ("plain", "just text\nno heading"), ("lead", "## Only\nx"))).orderBy("document", "section_no").collect()
    assert [(r["document"], r["title"], r["section_title"], r["body"]) for r in rows] == [
        ("guide", "Lending Guide", "Overview", "Intro text with blanks\n\nmore"),
        ("guide", "Lending Guide", "First Part", "body one\n### deeper\nstill one\ntail"),
        ("guide", "Lending Guide", "Last", "end"),
        ("lead", "lead", "Only", "x"),
        ("plain", "plain", "Overview", "just text\nno heading"),
    ]


@pytest.mark.parametrize("length", [1, 899, 900, 901, 1650, 1651, 2400, 5000])
def test_windows_cover_the_text_exactly_as_a_sliding_cut(spark, length):
    body = "".join(chr(97 + i % 26) for i in range(length - 1)) + "é"
    expected, start = [], 0
    while True:
        expected.append(body[start : start + 900])
        if start + 900 >= length:
            break
        start += 750
    rows = chunking.chunk_documents(documents(spark, ("d", body))).orderBy("chunk_key").collect()
    assert [r["text"].split("\n", 1)[1] for r in rows] == expected
    suffix = [f" (part {i + 1})" for i in range(len(expected))] if len(expected) > 1 else [""]
    assert [r["chunk_id"] for r in rows] == [f"d::Overview{s}" for s in suffix]
    assert rows[0]["text"].startswith("d — Overview\n")


@pytest.mark.parametrize("size, overlap", [(10, 0), (10, 3), (10, 5), (10, 9), (3, 2), (1, 0)])
def test_windows_of_any_overlap(spark, size, overlap):
    bodies = ["".join(chr(97 + i % 26) for i in range(n - 1)) + "\U0001f600" for n in (1, 2, 3, 9, 10, 11, 13, 19, 20, 21, 37)]
    for (body,), rows in zip(
        [(b,) for b in bodies],
        [chunking.chunk(spark.createDataFrame([(b,)], "body string"), size, overlap).orderBy("part_no").collect() for b in bodies],
    ):
        expected, start = [], 0
        while True:
            expected.append(body[start : start + size])
            if start + size >= len(body):
                break
            start += size - overlap
        assert [(r["part_no"], r["parts"], r["piece"]) for r in rows] == [(i, len(expected), piece) for i, piece in enumerate(expected)]


def test_long_documents_take_time_in_proportion(spark):
    body = "0123456789" * 400_000  # the square of its 5,333 windows would be minutes

    def seconds(size):
        begin = perf_counter()
        row = chunking.chunk_documents(documents(spark, ("d", body[:size]))).agg(F.count("text"), F.max(F.length("text"))).first()
        assert row[0] == -(-(size - 150) // 750)
        return perf_counter() - begin

    seconds(10_000)
    assert seconds(4_000_000) < 30


def test_documents_are_named_by_file_stem(spark, tmp_path):
    (tmp_path / "high.risk.md").write_text("# T\nline one\nline two", encoding="utf-8")
    assert [tuple(r) for r in chunking.read_documents(spark, f"{tmp_path}/*.md").collect()] == [("high.risk", "# T\nline one\nline two")]


def _vectors(spark, name, matrix, ids):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, matrix)], f"{name} string, embedding array<float>")


@pytest.mark.parametrize("block", [vectors.QUESTION_BYTES, 4 * 8 * 8, 1])
def test_search_equals_brute_force(spark, block):
    rng = np.random.default_rng(7)
    chunks, questions = rng.normal(size=(90, 8)).astype(np.float32), rng.normal(size=(9, 8)).astype(np.float32)
    chunks[30:60] = chunks[0]  # a third of the chunks are copies of one
    questions[0] = chunks[0]
    chunk_ids, question_ids = [f"c{i:03d}" for i in range(90)], [f"q{i}" for i in range(9)]
    found = vectors.top_k(
        _vectors(spark, "question_id", questions, question_ids), _vectors(spark, "chunk_id", chunks, chunk_ids).repartition(5), 4, block
    ).collect()
    exact = np.round(questions.astype(float) @ chunks.astype(float).T, vectors.SCORE_DIGITS)
    expected = {
        (q, rank, c) for i, q in enumerate(question_ids)
        for rank, c in enumerate([c for _, c in sorted((-s, c) for s, c in zip(exact[i], chunk_ids))][:4], start=1)
    }
    assert {(r["question_id"], r["rank"], r["chunk_id"]) for r in found} == expected


def test_tiles_of_any_size_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(11)
    chunks = rng.integers(-2, 3, size=(70, 3)).astype(np.float32)  # many ties
    ids = [f"c{i:03d}" for i in rng.permutation(70)]
    frame = _vectors(spark, "chunk_id", chunks, ids).coalesce(1)
    asked = _vectors(spark, "question_id", chunks[:20], [f"q{i}" for i in range(20)])
    exact = chunks[:20].astype(float) @ chunks.astype(float).T
    expected = {
        (f"q{i}", rank, c) for i in range(20) for rank, c in enumerate([c for _, c in sorted((-s, c) for s, c in zip(exact[i], ids))][:4], start=1)
    }
    for questions, rows in ((256, 10_000), (7, 9), (1, 3), (20, 1)):
        monkeypatch.setattr(vectors, "TILE_QUESTIONS", questions)
        monkeypatch.setattr(vectors, "TILE_CHUNKS", rows)
        found = vectors.top_k(asked, frame, 4).collect()
        assert {(r["question_id"], r["rank"], r["chunk_id"]) for r in found} == expected


def test_memory_of_a_search_is_bounded_by_its_tile():
    """A full block of questions meets a full batch of chunks: the matrix of all their scores would take 1.6 GB."""
    rng = np.random.default_rng(3)
    wanted, chunks = rng.normal(size=(20_000, 4)), rng.normal(size=(10_000, 4)).astype(np.float32)

    class Shared:
        value = (list(range(len(wanted))), wanted)

    class Chunks:
        class sparkSession:
            class sparkContext:
                broadcast = staticmethod(lambda _: Shared)

        mapInArrow = staticmethod(lambda search, schema: search)

    lists = pa.array(list(chunks), pa.list_(pa.float32()))
    batch = pa.RecordBatch.from_pydict({"chunk_id": list(range(len(chunks))), "embedding": lists})
    block = pa.table({"question_id": [0], "embedding": pa.array([[0.0]], pa.list_(pa.float32()))})
    search, _ = vectors._block_search(block, Chunks, 4, None)
    tracemalloc.start()
    found = sum(b.num_rows for b in search(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 4 * len(wanted)
    assert peak < 300 << 20


def test_search_with_fewer_chunks_than_k_and_without_questions(spark):
    chunks = _vectors(spark, "chunk_id", np.eye(2), ["a", "b"])
    found = vectors.top_k(_vectors(spark, "question_id", np.eye(2), ["q", "r"]), chunks, 4)
    assert found.count() == 4
    assert vectors.top_k(chunks.select(F.col("chunk_id").alias("question_id"), "embedding").filter("false"), chunks, 4).count() == 0


def test_encoder_equals_plain_python(spark):
    texts = ["The cat sat on the mat.", "naïve Straße_1 的 的 x² naïve", "", "?!", None, "a " * 300, "cat " * 3 + "dog"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    encoder = vectors.fit_encoder(frame, features=32)

    def bucket(word):
        return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 32

    counts = [None if t is None else Counter(bucket(w) for w in re.findall(r"[^\W]+", t.lower())) for t in texts]
    held = Counter(b for c in counts if c is not None for b in c)
    weights = [math.log(7 / (1 + held[b])) + 1 for b in range(32)]
    assert encoder.weights == pytest.approx(weights, abs=1e-6)
    for r in vectors.embed(frame, encoder).collect():
        if counts[r["k"]] is None:
            assert r["embedding"] is None
            continue
        raw = np.array([counts[r["k"]][b] * weights[b] for b in range(32)])
        assert r["embedding"] == pytest.approx(raw / (np.linalg.norm(raw) or 1.0), abs=1e-6)


def test_documents_of_one_partition_are_dealt_before_they_are_cut(spark, monkeypatch):
    rows = [(f"d{k}", f"## S{k}\nwords of document number {k}") for k in range(40)]
    seen, write = {}, ask.written

    def written(df, label):
        seen[label] = df.select(F.spark_partition_id().alias("p")).distinct().count()
        return write(df, label)

    monkeypatch.setattr(ask, "written", written)
    index, _ = ask.build_index(documents(spark, *rows).coalesce(1))
    assert seen["chunks"] > 1
    assert sorted(r["document_name"] for r in index.select("document_name").collect()) == sorted(name for name, _ in rows)


@pytest.mark.parametrize("text", ["a b", "a  b", "a\tb", "a \tb", "a\t b", "\ta\t\t", " a ", "a\n\n\n \t\nb", "a\r\n\tb", " ", ""])
def test_clean_text_equals_plain_python(spark, text):
    expected = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", text.replace("\r\n", "\n"))).strip()
    assert spark.createDataFrame([(text,)], "t string").select(chunking.clean_text(F.col("t"))).first()[0] == expected


def test_repeated_and_missing_question_ids_get_their_own_answers(spark):
    index, encoder = ask.build_index(documents(spark, ("a", "## S\napples grow on trees"), ("b", "## S\nboats float on water")))
    rows = [("1", "apples grow on trees"), ("1", "boats float on water"), (None, "boats float"), (None, "x"), ("1", "apples grow on trees")]
    questions = spark.createDataFrame(rows, "question_id string, question string")
    got = ask.ask(questions, index, encoder, Rules(min_score=0.4, max_passages=1))
    assert got.columns[:2] == ["question_id", "question"]
    found = sorted((str(r["question_id"]), r["question"], r["answer"].split("\n")[-1]) for r in got.collect())
    apples, boats = ("1", "apples grow on trees", "apples grow on trees"), "boats float on water"
    assert found == sorted([apples, apples, ("1", boats, boats), ("None", "boats float", boats), ("None", "x", NOT_FOUND)])


def test_compose(spark):
    rows = [
        ("q1", 1, 0.91234, "Doc A", "S1", "first"), ("q1", 2, 0.9, "Doc A", "S1", "same section"),
        ("q1", 3, 0.6, "Doc B", "S1", "second"), ("q1", 4, 0.58, "Doc C", "S1", "third"),
        ("q2", 1, 0.5499, "Doc A", "S1", "first"),
        ("q3", 1, 0.55, "Doc C", "S2", "only"), ("q3", 2, 0.1, "Doc A", "S1", "first"),
    ]
    retrieved = spark.createDataFrame(rows, "question_id string, rank int, score double, document_name string, section_title string, text string")
    got = {r["question_id"]: r for r in answers.compose(retrieved, 0.55, 2).collect()}
    assert (got["q1"]["answer"], got["q1"]["is_answerable"]) == ("first\n\nsecond", True)
    assert [tuple(c) for c in got["q1"]["citations"]] == [("Doc A", "S1", 0.9123), ("Doc B", "S1", 0.6)]
    assert [p["text"] for p in got["q1"]["retrieved_passages"]] == ["first", "same section", "second", "third"]
    assert (got["q2"]["answer"], got["q2"]["is_answerable"], list(got["q2"]["citations"])) == (NOT_FOUND, False, [])
    assert len(got["q2"]["retrieved_passages"]) == 1
    assert got["q3"]["answer"] == "only"


def test_ask_over_an_index_of_files(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "ratios.md").write_text("# Ratios\n## Debt\nDebt to income must stay below forty three percent.\n## Value\nLoan to value cap is ninety five.", encoding="utf-8")
    (tmp_path / "docs" / "files.md").write_text("# Records\n## Retention\nDenied application files are retained for twenty five months.", encoding="utf-8")
    with pytest.raises(FileNotFoundError):
        vectors.read_index(spark, f"{tmp_path}/index")
    rules = Rules(min_score=0.3)
    encoder = ask.index_from_files(spark, f"{tmp_path}/docs/*.md", f"{tmp_path}/index", rules=rules)
    index = vectors.read_index(spark, f"{tmp_path}/index")
    assert index.count() == 3
    questions = spark.createDataFrame(
        [("1", "direct", "How long are denied application files retained?", "25 months"), ("2", "none", "zzz qqq", "nothing"), ("3", "none", "x", "too short")],
        "question_id string, category string, question string, expected_answer string",
    )
    assert [r["question_id"] for r in ask.split_questions(questions)[1].collect()] == ["3"]
    results = ask.evaluate(questions, index, encoder, rules)
    got = {r["id"]: r for r in results.collect()}
    assert set(got) == {"1", "2", "3"}
    refused = ask.ask(questions, index, encoder, rules).filter("question_id = '3'").first()
    assert refused["refusal_reason"] and refused["answer"] == NOT_FOUND and not refused["is_answerable"]
    assert got["1"]["is_answerable_by_system"] and "twenty five months" in got["1"]["generated_answer"]
    assert got["1"]["citations"][0]["document_name"] == "Records"
    assert not got["2"]["is_answerable_by_system"]
    ask.write_results(results, f"{tmp_path}/results")
    assert spark.read.json(f"{tmp_path}/results").count() == 3
    rates = answers.answerable_rates(results.withColumnRenamed("is_answerable_by_system", "is_answerable"))
    assert {r["category"]: r["answered_pct"] for r in rates.collect()} == {"direct": 100.0, "none": 0.0}


def test_nothing_retrieved_is_not_found(spark):
    index, encoder = ask.build_index(spark.createDataFrame([("doc", "# T\n## S\nÜber Straße größe Привет")], "document string, text string"))
    questions = spark.createDataFrame([("1", "straße größe"), ("2", None)], "question_id string, question string")
    for row in ask.ask(questions, index.limit(0), encoder).collect():
        assert (row["answer"], row["is_answerable"], row["citations"], row["retrieved_passages"]) == (NOT_FOUND, False, [], [])
    # One chunk and words beyond ASCII: still found.
    assert ask.ask(questions, index, encoder, Rules(min_score=0.2)).filter("question_id = '1'").first()["is_answerable"]


def test_a_function_can_be_the_encoder(spark):
    def encoder(df):
        return df.withColumn("embedding", F.array(F.length("text").cast("float")))

    assert vectors.embed(spark.createDataFrame([("ab",)], "text string"), encoder).first()["embedding"] == [2.0]


@pytest.mark.parametrize("held, scans", [(vectors.QUESTION_BYTES, 1), (6 * 8 * 8, 4), (1, 20)])
def test_a_pass_over_the_chunks_serves_many_blocks(spark, monkeypatch, held, scans):
    """Twenty questions in blocks of one; a pass serves as many as `held` bytes take."""
    rng, passes, search = np.random.default_rng(5), [], vectors._search
    chunks, questions = rng.normal(size=(50, 8)).astype(np.float32), rng.normal(size=(20, 8)).astype(np.float32)
    frame = lambda name, matrix: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], f"{name} bigint, embedding array<float>")
    monkeypatch.setattr(vectors, "QUESTION_BYTES", held)
    monkeypatch.setattr(vectors, "_search", lambda blocks, *more: passes.append([b.num_rows for b in blocks]) or search(blocks, *more))
    found = vectors.top_k(frame("question_id", questions), frame("chunk_id", chunks), 4, 8 * 8).collect()
    assert len(passes) == scans and all(rows == 1 for some in passes for rows in some) and sum(map(len, passes)) == 20
    exact = np.round(questions.astype(float) @ chunks.astype(float).T, vectors.SCORE_DIGITS)
    expected = {(q, rank, int(c)) for q in range(20) for rank, c in enumerate(np.argsort(-exact[q], kind="stable")[:4], start=1)}
    assert {(r["question_id"], r["rank"], r["chunk_id"]) for r in found} == expected
