"""Places of matches, overlaps and replacements against plain Python, and their cost on one long text."""

from __future__ import annotations

import random
import re
from time import perf_counter

import pytest
from llm_data import prose
from loanmill.llm import pii, spans
from pyspark.sql import functions as F


@pytest.mark.parametrize("block", [128, 2])
def test_matches_and_what_lies_between(spark, monkeypatch, block):
    monkeypatch.setattr(spans, "BLOCK", block)
    source = random.Random(1)
    texts = ["", "1", "no", "12 34", "é1😀22ü", *("".join(source.choices("a1é 😀\n2", k=source.randint(0, 900))) for _ in range(30))]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    for r in frame.select("text", spans.find_between(F.col("text"), "[0-9]+").alias("found")).collect():
        hits = list(re.finditer("[0-9]+", r.text))
        gaps = re.split("[0-9]+", r.text)
        assert [tuple(x) for x in r.found] == [(m.start(), m.end(), m[0], gaps[k], gaps[k + 1]) for k, m in enumerate(hits)]


def test_apart_and_replaced(spark, monkeypatch):
    monkeypatch.setattr(spans, "BLOCK", 4)
    monkeypatch.setattr(spans, "PART", 7)
    source, rows = random.Random(3), []
    for k in range(60):
        text = "".join(source.choices("abcé😀\n", k=source.randint(0, 60)))
        cut = lambda n: [(a, source.randint(a + 1, len(text))) for a in (source.randrange(len(text)) for _ in range(n))] if text else []  # noqa: B023, E731
        at, items = 0, []
        for a, b in sorted(cut(6)):
            if a >= at:
                items.append((a, b))
                at = b
        rows.append((k, text, items, cut(source.randint(0, 8))))
    kind = "array<struct<start:int,end:int>>"
    frame = spark.createDataFrame(rows, f"k int, text string, items {kind}, others {kind}")
    got = frame.select(
        "*", spans.apart(F.col("items"), F.col("others")).alias("free"),
        spans.replaced(F.col("text"), F.array_sort("others"), lambda s: F.concat(F.lit("<"), s["start"].cast("string"), F.lit(">"))).alias("shown"),
    ).collect()
    for r in got:
        assert list(r.free) == [all(d <= a or c >= b for c, d in r.others) for a, b in r.items]
        out, at, end = "", 0, 0
        for a, b in sorted(r.others):
            if a >= end:
                out, at = out + r.text[end:a] + f"<{a}>", b
            end = max(end, b)
        assert r.shown == out + r.text[end:]


def test_units_of_a_text(spark):
    text = "Call  me at\n (user7), or write: x.y@z, ok 12"
    got = spark.createDataFrame([(text,)], "text string").select(F.inline(pii.units(F.col("text")))).collect()
    assert [(r.start, r.end, r.text, list(r.patterns)) for r in got] == [
        (14, 19, "user7", ["< me at", "<> at or"]), (32, 37, "x.y@z", ["< or write:", "<> write: ok"]),
    ]


def test_bootstrap_equals_a_plain_version(table):
    source = random.Random(5)
    seeds = [f"{a}.{b}.{source.randint(0, 255)}.9" for a in range(4, 10) for b in range(9)]
    texts = [f"{prose(k, 6)} seen from host {source.choice(seeds)} today {prose(k + 500, 4)}" for k in range(60)]
    texts += [f"{prose(k, 5)} seen from host {k:x}af:{k}b:2{k} today {prose(k, 3)}" for k in range(12)]
    texts += [f"the value of part {k}7:9:{k} lies apart" for k in range(9)]
    docs = table(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.extract(docs).collect()
    added = {r.doc_id: {(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.added} for r in rows}

    occurrences = {}
    for r in docs.select("doc_id", F.inline(pii.units(F.col("text")))).collect():
        occurrences.setdefault(r.text.lower(), []).append((r.doc_id, r.text, r.patterns))
    edges = {(p, i) for i, where in occurrences.items() for _, _, ps in where for p in ps}
    seed = {i: 1 for i in occurrences if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", i)}
    known = {i: (k, 1.0) for i, k in seed.items()}
    for _ in range(pii.ROUNDS):
        sure = {}
        for p in {p for p, _ in edges}:
            of = [i for q, i in edges if q == p]
            total = sum(known[i][1] for i in of if i in known)
            if total >= pii.SUPPORT and total / len(of) >= pii.PATTERN_SHARE:
                sure[p] = total / len(of)
        known = {i: (k, 1.0) for i, k in seed.items()}
        for i in occurrences:
            doubt = 1.0
            for p, j in edges:
                if j == i and p in sure:
                    doubt *= max(1 - sure[p], 1e-6)
            if i not in seed and 1 - doubt >= pii.INSTANCE_SCORE:
                known[i] = (1, 1 - doubt)
    want = {k: set() for k in range(len(texts))}
    for i in set(known) - set(seed):
        for doc, text, _ in occurrences[i]:
            if re.search(r"[0-9a-fA-F]+[.:][0-9a-fA-F]*[.:][0-9a-fA-F]", text):
                want[doc].add((1, text))
    assert added == want and sum(map(len, want.values())) == 12


def test_twenty_thousand_identifiers_in_one_text(spark, table):
    text = "".join(f"a{k}@b.co x\n" for k in range(20_000))
    docs = table([(1, text)], "doc_id long, text string")

    def seconds(job):
        begin = perf_counter()
        assert job() == 20_000
        return perf_counter() - begin

    for job in (lambda: docs.select(F.size(pii.base_spans(F.col("text")))).first()[0], lambda: docs.select(F.size(pii.units(F.col("text")))).first()[0]):
        assert min(seconds(job), seconds(job)) < 10
    assert pii.mask(docs).first()["text"] == "<email> x\n" * 20_000
