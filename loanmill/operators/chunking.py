"""Markdown documents to section-aware, size-limited chunks. Row-wise expressions only: no exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmill.functions import text as X
from loanmill.functions.text import given
from loanmill.rules import Rules

# In the patterns, d makes only a line feed end a line and m lets ^ match at every line start.
TITLE = r"(?dm)^# (.+)$"
SECTION = r"(?dm)^## "
TITLE_LINE = r"(?dm)^# .*(\n|\z)"


def read_documents(spark: SparkSession, pattern: str) -> DataFrame:
    """(`document`, `text`): one row per file, named by its file stem."""
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return spark.read.text(pattern, wholetext=True).select(name.alias("document"), F.col("value").alias("text"))


def clean_text(c: Column) -> Column:
    """Unify line ends, squeeze blanks and tabs, keep at most one empty line, strip."""
    c = F.replace(c, F.lit("\r\n"), F.lit("\n"))
    c = F.regexp_replace(c, r"[ \t]{2,}|\t", " ")  # a blank by itself stays as it is
    return X.strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def document_title(cleaned: Column, fallback: Column) -> Column:
    """Text of the first `# ` line, else the fallback."""
    found = F.regexp_extract(cleaned, TITLE, 1)
    return F.when(found != "", X.strip(found)).otherwise(fallback)


def sections(documents: DataFrame) -> DataFrame:
    """(`document`, `title`, `section_no`, `section_title`, `body`) in document order.

    What precedes the first `## ` line is the section `Overview`. `# ` lines are not part of any body, and
    sections without text are left out; deeper headings stay in the body.
    """
    cleaned = documents.select("document", clean_text(F.col("text")).alias("text")).withColumn(
        "title", document_title(F.col("text"), F.col("document"))
    )
    parts = cleaned.select("document", "title", F.posexplode(F.split("text", SECTION)).alias("section_no", "part"))
    first_line = F.substring_index("part", "\n", 1)
    is_lead = F.col("section_no") == 0
    rest = F.when(is_lead, F.col("part")).otherwise(F.expr("substring(part, length(substring_index(part, '\n', 1)) + 2)"))
    # Behind an explode the body is worked out once, though both the filter and the windows look at it.
    body = X.strip(F.regexp_replace(rest, TITLE_LINE, ""))
    named = parts.select(
        "document", "title", "section_no",
        F.when(is_lead, "Overview").otherwise(X.strip(first_line)).alias("section_title"),
        F.explode(F.array(body)).alias("body"),
    )
    return named.filter("body <> ''")


def _windows(body: Column, size: int, overlap: int) -> Column:
    """Windows of `size` characters that step by `size - overlap` and cover the body to its end.

    The body is cut once into pieces of one step; a window is a piece with the beginning of what follows, so the work
    grows with the length of the body and not with its square.
    """
    step = size - overlap
    ahead = -(-overlap // step)  # pieces that hold the overlap

    def window(pieces: Column, piece: Column, i: Column) -> Column:
        following = F.array_join(F.slice(pieces, i + 2, ahead), "") if ahead else F.lit("")
        return F.concat(piece, F.substring(following, F.lit(1), F.lit(overlap)))

    def joined(pieces: Column) -> Column:
        windows = F.transform(pieces, lambda piece, i: window(pieces, piece, i))
        # What lies within the overlap of the window before is no window of its own.
        length = (F.size(pieces) - 1) * step + F.length(F.element_at(pieces, -1))
        count = F.ceil((length - overlap) / F.lit(float(step))).cast("int")
        return F.slice(windows, F.lit(1), F.greatest(count, F.lit(1)))

    return given(F.regexp_extract_all(body, F.lit(f"(?s).{{1,{step}}}"), F.lit(0)), joined)


def chunk(sectioned: DataFrame, size: int, overlap: int) -> DataFrame:
    """Add `part_no` (0-based), `parts` and `piece`: whole bodies up to `size` characters, else windows of
    `size` that step by `size - overlap`, covering the text to its end."""
    if not 0 <= overlap < size:
        raise ValueError("the overlap of chunks must be smaller than the chunks")
    cut = F.when(F.length("body") <= size, F.array("body")).otherwise(_windows(F.col("body"), size, overlap))
    # The number of parts goes with each part, so that the list of all is not copied along.
    numbered = given(cut, lambda w: F.transform(w, lambda piece, i: F.struct(i.alias("part_no"), F.size(w).alias("parts"), piece.alias("piece"))))
    return sectioned.withColumn("part", F.explode(numbered)).select(*[c for c in sectioned.columns if c != "body"], "part.*")


def chunk_documents(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(`chunk_key`, `chunk_id`, `document_name`, `section_title`, `text`) of every chunk of every document.

    `chunk_id` is the readable name and repeats when a document repeats a section title; `chunk_key` is
    unique and sorts in document order.
    """
    pieces = chunk(sections(documents), rules.chunk_chars, rules.chunk_overlap)
    suffix = F.when(
        F.col("parts") > 1, F.concat(F.lit(" (part "), (F.col("part_no") + 1).cast("string"), F.lit(")"))
    ).otherwise("")
    return pieces.select(
        F.format_string("%s#%06d.%06d", "document", "section_no", "part_no").alias("chunk_key"),
        F.concat("document", F.lit("::"), "section_title", suffix).alias("chunk_id"),
        F.col("title").alias("document_name"),
        F.concat("section_title", suffix).alias("section_title"),
        F.concat("title", F.lit(" — "), "section_title", F.lit("\n"), "piece").alias("text"),
    )
