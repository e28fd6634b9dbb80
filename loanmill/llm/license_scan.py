"""Licence scan: ordered signature rules behind a keyword filter, with overlaps resolved by containment and priority.

Everything is a column expression, so a document is scanned where it is read and nothing is shuffled.
"""

from __future__ import annotations

import json
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmill.llm import spans
from loanmill.llm.license_rules import ANCHORS, as_rows

# Phrase and label of the fixed part of the scan.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
_RULES = "array<struct<rule:int,label:string,priority:int,keyword:string,pattern:string,confidence:double>>"
_FOUND = "array<struct<start:int,end:int,label:string,confidence:double>>"


def words_of(text: Column) -> Column:
    """Lower-case words with one space between them. Words are runs of digits, letters A-Z and non-ASCII characters."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.trim(F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def detections(words: Column) -> Column:
    """What the rules find in a text of `words_of`: (`start`, `end`, `label`, `confidence`), in characters.

    A detection that lies inside another is dropped; of two at the same place the one of lower priority number stays, then the
    earlier rule. The rules are tried only where the text has an anchor, and each only where it has the rule's keyword.
    """
    rules = F.from_json(F.lit(json.dumps(as_rows())), _RULES)
    tried = F.filter(rules, lambda r: F.contains(words, r["keyword"]))
    found = F.flatten(F.transform(tried, lambda r: F.transform(
        spans.find(words, r["pattern"]),
        lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("before"), r["priority"].alias("priority"), r["rule"].alias("rule"),
            r["label"].alias("label"), r["confidence"].alias("confidence"),
        ),
    )))
    # In order of start, widest first, a detection lies in another if an earlier one reaches as far.
    none = F.array().cast(_FOUND)

    def step(state: Column, d: Column) -> Column:
        end = -d["before"]
        kept = F.concat(state["kept"], F.array(F.struct(d["start"].alias("start"), end.alias("end"), d["label"].alias("label"), d["confidence"].alias("confidence"))))
        return F.struct(F.greatest(state["reach"], end).alias("reach"), F.when(end > state["reach"], kept).otherwise(state["kept"]).alias("kept"))

    swept = F.aggregate(F.array_sort(found), F.struct(F.lit(-1).alias("reach"), none.alias("kept")), step, lambda s: s["kept"])
    anchored = F.lit(False)
    for anchor in ANCHORS:
        anchored = anchored | F.contains(words, F.lit(anchor))
    return F.when(anchored, swept).otherwise(none)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(`id_col`, `words`, `n_words`, `base_starts`, `base_labels`, `detections`) per row.

    `base_starts` are the word places of the base phrases, `base_labels` their distinct labels, sorted. Defined cases: a NULL or
    empty text has no words. Rows are scanned one by one, so repeated rows and repeated or NULL ids get a row each; other columns
    are not read.
    """
    words = docs.select(F.col(id_col), words_of(F.col(text_col)).alias("_words"))
    w = F.col("_words")
    places, labels = [], []
    for phrase, label in BASE:
        has = F.contains(w, F.lit(phrase))
        found = F.when(has, F.transform(spans.find(w, rf"(?<!\S){phrase}(?!\S)"), lambda s: s["start"]))
        places.append(F.coalesce(found, F.array().cast("array<int>")))
        labels.append(F.when(F.size(found) > 0, F.lit(label)))
    located = words.withColumn("_places", F.concat(*places)).withColumn(
        "base_labels", F.array_sort(F.array_compact(F.array(*labels)))
    ).withColumn("detections", detections(w))
    return located.select(
        F.col(id_col), w.alias("words"), F.when(w == "", F.lit(0)).otherwise(_spaces(w) + 1).cast("long").alias("n_words"),
        F.size("_places").cast("long").alias("n_base"),
        _word_at(w, F.array_min("_places")).alias("first_word"), _word_at(w, F.array_max("_places")).alias("last_word"),
        "base_labels", "detections",
    )


def _word_at(words: Column, start: Column) -> Column:
    """Place of the word that starts at a character, NULL for none."""
    return _spaces(F.substring(words, F.lit(1), start)).cast("long")


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licences named in all documents. The score is the chance that at least one detection is right, 0 if there is none."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    own = F.transform("detections", lambda d: d["label"])
    doubt = F.aggregate("detections", F.lit(1.0), lambda x, d: x * (1 - d["confidence"]))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base_labels", own))), ",").alias("labels"), (1 - doubt).alias("score"),
    )
