"""Quality rules, language-model scores and toxicity against plain Python."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import prose
from loanmill.llm import lm_scoring, quality_rules, toxicity
from loanmill.llm.common import fold
from pyspark.sql import functions as F

WORD = "[^\x20\x09-\x0D]+"


def quality_counts(text):
    w = re.findall(WORD, text)
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    inside = [False] * len(w)
    for k in range(len(w) - 4):
        if grams[tuple(w[k : k + 5])] > 1:
            inside[k : k + 5] = [True] * 5
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(inside)


def test_quality_counts_and_verdicts(table):
    texts = [prose(k, 120) for k in range(40)] + [
        "a b c d e f g\na b c d e f g\n \n\na b c d e f g ", "#*$ %&|<> é\n\né", "short one", "Ünï " * 30, "qzx jjq vvk wwq xxz qqj " + "zq9x#kk " * 1 + " ".join(chr(97 + (k * 17) % 26) * 5 + chr(98 + k % 20) for k in range(90)),
    ]
    rows = {r.doc_id: r for r in quality_rules.judge(table([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")).collect()}
    for k, text in enumerate(texts):
        r = rows[k]
        n = quality_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.kept and r.base_failed)
    assert all(rows[k].kept for k in range(40))
    assert not rows[len(texts) - 1].base_failed and not rows[len(texts) - 1].kept  # odd letters: beyond the band


def test_kneser_ney_probabilities_add_up():
    source = np.random.default_rng(1)
    codes, counts = np.unique(source.integers(97, 101, (3, 500)).T @ np.array([65536, 256, 1]), return_counts=True)
    model = quality_rules.kneser_ney(codes, counts)
    for before in (97 << 8 | 98, 97 << 8 | 200, 5 << 8 | 6):
        bits = model.bits((np.uint32(before) << np.uint32(8)) + np.arange(256, dtype=np.uint32))
        assert np.exp2(bits).sum() == pytest.approx(1, abs=1e-4)


def test_quality_edge_rows(tricky, nothing):
    assert quality_rules.judge(tricky).count() == 13
    left = quality_rules.without_rejected(tricky)
    assert left.columns == tricky.columns and {r.doc_id for r in left.select("doc_id").collect()} <= {1, None, 8, 11}
    assert quality_rules.judge(nothing).count() == 0


def test_copies_do_not_move_a_language_band(table):
    clean = [prose(k, 120) for k in range(40)]
    copy = " ".join(["zq xj vvk wwq"[(k % 4) * 3 :] + str(k * 7919 % 1000) for k in range(80)])
    rows = [(k, t, "en") for k, t in enumerate(clean)] + [(100 + k, copy, "en") for k in range(160)]
    alone = quality_rules.judge(table(rows[:41], "doc_id long, text string, lang string")).collect()
    judged = quality_rules.judge(table(rows, "doc_id long, text string, lang string")).collect()
    assert all(r.kept for r in judged if r.doc_id < 40)
    assert {(r.doc_id, r.bits, r.low, r.high) for r in alone} == {(r.doc_id, r.bits, r.low, r.high) for r in judged if r.doc_id <= 100}


def test_languages_beyond_a_pass_have_their_own_models(table, monkeypatch):
    rows = [(100 * j + k, prose(100 * j + k, 120).replace("a", "äöü"[j]), f"l{j}") for j in range(3) for k in range(20)]
    schema = "doc_id long, text string, lang string"
    together = sorted((r.doc_id, r.bits, r.kept) for r in quality_rules.judge(table(rows, schema)).collect())
    monkeypatch.setattr(quality_rules, "OWN_MODELS", 1)
    assert together == sorted((r.doc_id, r.bits, r.kept) for r in quality_rules.judge(table(rows, schema)).collect())


def test_symbol_laden_words_lie_beyond_the_band(table):
    laden = lambda seed, every: " ".join(
        w + ("$$$", "%%%", "&&&")[k % 3] if k % every == 0 else w for k, w in enumerate(prose(seed, 120).split())
    )
    rows = [(k, prose(k, 120), "en") for k in range(40)] + [(100 + e, laden(100 + e, e), "en") for e in (3, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20)]
    kept = {r.doc_id: r.kept for r in quality_rules.judge(table(rows, "doc_id long, text string, lang string")).collect()}
    assert all(kept[k] for k in range(40)) and not kept[104]  # six distances and 3 / sqrt(bytes) kept it


def ppm(sequences, top):
    """A brute-force trie: symbol counts by context; the longest contexts from the kept four-byte sequences."""
    kids = [defaultdict(dict) for _ in range(4)]
    for gram, n in sequences.items():
        for order in range(4):
            if order == 3 and gram not in top:
                continue
            g = gram[3 - order :]
            kids[order][g[:-1]][g[-1]] = kids[order][g[:-1]].get(g[-1], 0) + n

    def log10(before, symbol):
        excluded, p = set(), 0.0
        for order in (3, 2, 1, 0):
            children = kids[order].get(tuple(before[3 - order :]))
            if not children:
                continue
            open_ = {s: n for s, n in children.items() if s not in excluded}
            whole = sum(open_.values()) + len(open_)
            if symbol in open_:
                return p + math.log10(open_[symbol] / whole)
            if open_:
                p += math.log10(len(open_) / whole)
            excluded |= set(children)
        return p - math.log10(256 - len(excluded))

    return log10


@pytest.mark.parametrize(("head", "nodes"), [(200_000, 1 << 20), (20, 60)])
def test_language_model_scores(table, monkeypatch, head, nodes):
    monkeypatch.setattr(lm_scoring, "HEAD_WORDS", head)
    monkeypatch.setattr(lm_scoring, "TOP_NODES", nodes)
    texts = [prose(k, 40) for k in range(30)] + ["", None, "Ünï  CODE\ttext", "unseen zzz qqq"]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in lm_scoring.score(table(rows, "doc_id long, text string"), fold("doc_id") != 1).collect()}
    tokens = {k: re.findall(WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) for k, t in rows}
    learn = [k for k in tokens if zlib.crc32(str(k).encode()) % 5 != 1]
    counts = Counter(w for k in learn for w in tokens[k])
    counts[None] = len(learn)
    total, kinds = sum(counts.values()), len(counts)
    symbols = lambda k: [254] * 3 + list(" ".join(tokens[k]).encode()) + [255]
    grams = Counter(tuple(s[i - 3 : i + 1]) for k in learn for s in [symbols(k)] for i in range(3, len(s)))
    steps = Counter(math.floor(math.log2(n) * 8) for n in grams.values())
    lowest, kept = 1 << 30, 0
    for step in sorted(steps, reverse=True):
        if kept + steps[step] > nodes:
            break
        kept, lowest = kept + steps[step], step
    log10 = ppm(grams, {g for g, n in grams.items() if math.floor(math.log2(n) * 8) >= lowest})
    for k, row in got.items():
        base = sum(math.log10((counts.get(w, 0) + 0.5) / (total + 0.5 * (kinds + 1))) for w in [*tokens[k], None])
        s = symbols(k)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(tokens[k]) + 1, sum(w in counts for w in [*tokens[k], None]), total)
        assert row.held_out == (k not in learn)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score == pytest.approx(sum(log10(s[i - 3 : i], s[i]) for i in range(3, len(s))), rel=1e-9)


@pytest.mark.parametrize("travel", [60, 1])
def test_sequences_that_do_not_travel_are_scored_whole(table, monkeypatch, travel):
    texts = [prose(k, 40) for k in range(30)] + ["", None, "Ünï  CODE\ttext", "unseen zzz qqq"]
    docs = table(list(enumerate(texts)), "doc_id long, text string")
    got = lambda: {r.doc_id: r for r in lm_scoring.score(docs, fold("doc_id") != 1).collect()}
    whole = got()
    assert lm_scoring.TOP_NODES >= 1 << 32  # as many as there can be
    monkeypatch.setattr(lm_scoring, "HEAD_NODES", travel)
    parted = got()
    assert {k: r.score for k, r in parted.items()} == pytest.approx({k: r.score for k, r in whole.items()}, rel=1e-9)
    assert {k: r.n_known for k, r in parted.items()} == {k: r.n_known for k, r in whole.items()}


def test_language_model_edge_rows(tricky, nothing):
    assert lm_scoring.score(tricky, F.lit(True)).count() == 13
    untaught = lm_scoring.score(tricky, F.lit(False)).filter("doc_id = 7").first()
    assert untaught.score == pytest.approx(-4 * math.log10(256)) and untaught.base_score == 0 and untaught.n_known == 0
    assert lm_scoring.score(nothing, F.lit(True)).count() == 0


def test_toxicity_is_learned_from_positives_and_unlabelled(table):
    rows, marks = [], []
    for k in range(1500):
        bad = k % 6 == 0
        rows.append((k, prose(k, 60) + (" vilething " if bad else " ") + prose(k + 999, 20)))
        if zlib.crc32(b"mark%d" % k) % 2:
            marks.append((k, int(bad)))
    docs, labels = table(rows, "doc_id long, text string"), table(marks + [(None, 1), (3, None), (99_999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, lambda c: fold(c) != 0)
    scored = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    wrong = [k for k in scored if scored[k].predicted != int(k % 6 == 0)]
    assert len(wrong) <= 15 and all(0 <= r.score <= 1 for r in scored.values())


def test_toxicity_edge_rows(tricky, nothing, table):
    labels = table([(1, 1), (8, 0)], "doc_id long, toxic int")
    model = toxicity.fit(tricky, labels, lambda c: F.lit(True))
    assert toxicity.score(tricky, model).count() == 13
    none = toxicity.fit(nothing, labels.limit(0), lambda c: F.lit(True))
    assert toxicity.score(nothing, none).count() == 0 and toxicity.score(tricky, none).select("score").distinct().count() == 1


def test_toxicity_samples_do_not_depend_on_partitions(table, monkeypatch):
    monkeypatch.setattr(toxicity, "POSITIVES", 30)
    monkeypatch.setattr(toxicity, "UNLABELLED", 60)
    docs = table([(k, prose(k, 30) + (" vile slurs" if k % 5 == 0 else "")) for k in range(400)], "doc_id long, text string")
    labels = table([(k, int(k % 5 == 0)) for k in range(400)], "doc_id long, toxic int")
    models = [toxicity.fit(docs.repartition(n), labels.repartition(n), lambda c: F.lit(True)) for n in (1, 5)]
    assert len(models[0].features) and np.array_equal(models[0].features, models[1].features)
    assert np.allclose(models[0].weights, models[1].weights)
