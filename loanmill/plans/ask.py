"""Batch question answering over an index of document chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmill.operators import answers, chunking, vectors
from loanmill.rules import NOT_FOUND, Rules
from loanmill.session import written


ROW = "_question_row"


def build_index(documents: DataFrame, encoder=None, rules: Rules = Rules()):
    """(index, encoder): chunks of (`document`, `text`) rows with their vectors. Without an encoder the
    default one is fitted on the chunks.

    Documents are dealt evenly first: files of few row groups would leave all of their text to as many tasks."""
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = written(chunking.chunk_documents(documents.repartition(tasks), rules), "chunks")
    encoder = encoder or vectors.fit_encoder(chunks)
    return vectors.embed(chunks, encoder), encoder


def split_questions(questions: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame]:
    """(askable, refused) by question length in characters."""
    low, high = rules.question_chars
    fits = F.coalesce(F.length("question").between(low, high), F.lit(False))
    return questions.filter(fits), questions.filter(~fits)


def ask(questions: DataFrame, index: DataFrame, encoder, rules: Rules = Rules()) -> DataFrame:
    """One answer per row of (`question_id`, `question`, …), other columns kept; ids may repeat or be NULL.

    Both sides are encoded once, searched exactly, and only the winning chunks' texts are fetched. A question that is too
    short or too long is not asked, but answered as not found, with `refusal_reason`; so is one without any passage,
    which has no reason.
    """
    # Rows are told apart by a number of their own, fixed by writing it.
    columns = questions.columns
    questions = written(questions.withColumn(ROW, F.monotonically_increasing_id()), "questions")
    askable, _ = split_questions(questions, rules)
    asked = vectors.embed(askable.select(F.col(ROW).alias("question_id"), F.col("question").alias("text")), encoder)
    key = F.col("chunk_key").alias("chunk_id")
    found = vectors.top_k(asked.select("question_id", "embedding"), index.select(key, "embedding"), rules.top_k)
    passages = found.withColumnRenamed("chunk_id", "chunk_key").join(index.drop("embedding"), "chunk_key")
    composed = answers.compose(passages, rules.min_score, rules.max_passages)
    low, high = rules.question_chars
    fits = F.coalesce(F.length("question").between(low, high), F.lit(False))
    found = questions.join(composed.withColumnRenamed("question_id", ROW), ROW, "left").select(*columns, *composed.columns[1:])
    empty = {name: F.array().cast(composed.schema[name].dataType) for name in ("citations", "retrieved_passages")}
    return found.withColumns({
        "answer": F.coalesce("answer", F.lit(NOT_FOUND)),
        "is_answerable": F.coalesce("is_answerable", F.lit(False)),
        **{name: F.coalesce(name, none) for name, none in empty.items()},
        "refusal_reason": F.when(~fits, F.lit(f"a question has {low} to {high} characters")),
    })


def evaluate(questions: DataFrame, index: DataFrame, encoder, rules: Rules = Rules()) -> DataFrame:
    """Answers to (`question_id`, `category`, `question`, `expected_answer`) rows, ready to store."""
    return ask(questions, index, encoder, rules).select(
        F.col("question_id").alias("id"), "category", "question", "expected_answer",
        F.col("answer").alias("generated_answer"), F.col("is_answerable").alias("is_answerable_by_system"),
        "citations", "retrieved_passages",
    )


def write_results(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def index_from_files(spark: SparkSession, pattern: str, path: str, encoder=None, rules: Rules = Rules()):
    """Build and persist the index of all documents that match a glob; returns the encoder."""
    index, encoder = build_index(chunking.read_documents(spark, pattern), encoder, rules)
    vectors.write_index(index, path)
    return encoder
