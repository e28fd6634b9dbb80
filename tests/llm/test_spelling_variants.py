"""Spelling variants against all pairs by the full edit matrix."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from loanmill.llm import spelling_variants as sv


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def expected(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if abs(len(v) - len(w)) <= 1 and edits(v, w) == 1]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        out[w] = [form, n, len(near), counts[form] if form is not None else None]
    for w, values in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        values.append(root)
    return {w: tuple(values) for w, values in out.items()}


def found(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.n, r.n_near, r.form_n, r.root) for r in rows}


def lower(run):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in run)


def damaged_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.text("abé", max_size=6), min_size=1, max_size=25), min_size=1, max_size=4))
def test_sorted_list_search_finds_every_pair_once(groups):
    lists = [sorted(g) for g in groups]
    begins = np.cumsum([0] + [len(g) for g in lists[:-1]])
    query, word, shared = sv.one_edit_apart([w for g in lists for w in g], begins)
    flat = [w for g in lists for w in g]
    pairs = [(b + i, b + j) for b, g in zip(begins, lists) for i, x in enumerate(g) for j, y in enumerate(g) if edits(x, y) == 1]
    assert sorted(zip(query, word)) == sorted(pairs)
    for q, w, p in zip(query, word, shared):
        assert flat[q][:p] == flat[w][:p] and flat[q][p : p + 1] != flat[w][p : p + 1]


@pytest.mark.parametrize("bucket", [1_024, 2])
def test_variants_match_all_pairs(spark, monkeypatch, bucket):
    monkeypatch.setattr(sv, "BUCKET", bucket)  # 2: every bucket is dealt again, down to single positions
    monkeypatch.setattr(sv, "CHUNK", 8)
    source = random.Random(4)
    words = {"".join(source.choices("abñ", k=source.randint(1, 6))) for _ in range(200)} | {"", "x", "xy", "y", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa"}
    counts = {w: source.choice([1, 2, 10, 20, 100, 100, 1000, 10000]) for w in sorted(words)}
    got = found(sv.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == expected(counts)


def test_damaged_vocabulary_and_query(spark, tmp_path):
    source = random.Random(9)
    stems = ["".join(source.choices("abcdeé", k=source.randint(6, 11))) for _ in range(60)]
    rows = [(k, " ".join(source.choices(stems, k=40)).replace("a", "A", 3) + "; É" + stems[k % 60].upper()) for k in range(300)]
    rows += [(None, None), (None, "straße straßen straßen, ÷×ÀÉÎÕÜ ÷×ÀÉÎÕÜ"), (5, ""), (7, "zz" * 3_000 + "1" + "zz" * 3_000), rows[3], rows[3]]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert found(sv.op11_spelling_variants(spark, str(tmp_path))) == expected(damaged_counts(rows))


def test_a_third_of_the_words_in_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(sv, "BUCKET", 16)
    words = [f"shared{a}{b}{c}x" for a in "abcdefg" for b in "abcdefg" for c in "abcdefg"] + [f"{k}single" for k in "qrstuv"]
    got = found(sv.variants(spark.createDataFrame([(w, 1) for w in words], "word string, n long")))
    assert all(got[w][2] == 18 for w in words if w.startswith("shared")) and all(got[w][2] == 5 for w in words if not w.startswith("shared"))


def test_edge_rows(tricky, nothing, spark):
    words = {r.word: r.n for r in sv.vocabulary(tricky).collect()}
    assert words == {w: n for w, n in Counter(
        lower(run) for r in tricky.collect() for run in re.findall("[A-Za-zÀ-ÿ]{7,}", r.text or "")
    ).items() if n >= 2}
    assert sv.variants(sv.vocabulary(nothing)).collect() == []
    assert sv.variants(sv.vocabulary(tricky)).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found(sv.variants(spark.createDataFrame([("only", 3), (None, 2)], "word string, n long").filter("word = 'only'"))) == {"only": (None, 3, 0, None, "only")}
