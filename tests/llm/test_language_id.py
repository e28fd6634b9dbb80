"""Language identification against plain Python, and its accuracy on held-out texts."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_data import prose
from loanmill.llm import language_id as li
from loanmill.llm.common import fold

SCHEMA = "doc_id long, text string, lang string"
SYLLABLES = {
    "en": "th ing and er on st re at", "de": "sch ung ein ver ich keit ä ß", "fr": "eau que ment é è oi aux ou", "el": "ος και την αυ ει ου μα τι",
    "zh": "的 一 是 不 了 人 我 在",
}


def speech(language, seed, words):
    source = random.Random(f"{language}{seed}")
    parts = SYLLABLES[language].split()
    return " ".join("".join(source.choices(parts, k=source.randint(1, 4))) for _ in range(words)).capitalize() + "."


def buckets(text):
    """N-gram buckets of one normalised text, one after the other."""
    found = [f for f, _ in li.grams([text])]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def spelled(text):
    return [text[i : i + n] for n in li.LENGTHS for i in range(len(text) - n + 1)]


def test_letters():
    assert li.letters("Ab, 12 c_d\n É!") == " ab c d é "
    assert li.letters(None) == li.letters("") == li.letters("12 -_ 😀") == ""


@pytest.mark.parametrize("piece", [1 << 18, 7])
def test_every_ngram_of_every_text_is_found_once(monkeypatch, piece):
    monkeypatch.setattr(li, "PIECE", piece)
    texts = [li.letters(t) for t in ("naïve 😀 straße", "", "a", "的一是 不了人", "abcdefghijklmnopq " * 3)]
    code = {}
    for text in texts:
        for gram in spelled(text):
            code.setdefault(gram, buckets(gram)[-1])
    assert len(set(code.values())) == len(code)
    got = [Counter() for _ in texts]
    for found, owner in li.grams(texts):
        assert (np.diff(owner) >= 0).all()
        for f, o in zip(found, owner):
            got[o][f] += 1
    assert got == [Counter(code[g] for g in spelled(t)) for t in texts]


@pytest.mark.parametrize("piece", [1 << 18, 11])
def test_document_frequencies(table, monkeypatch, piece):
    monkeypatch.setattr(li, "PIECE", piece)
    texts = ["banana bandana", "Banana!", None, "12", "", "nab " * 40]
    got = {r.bucket: r.df for r in li.document_frequencies(table([(k, t, "en") for k, t in enumerate(texts)], SCHEMA)).collect()}
    want = Counter(b for t in texts for b in set(buckets(li.letters(t)).tolist()))
    assert got.pop(-1) == 3 and got == dict(want)


def test_leader_steps_match_the_formula():
    source = np.random.default_rng(2)
    learner = li.Ftrl(6, 3, alpha=0.3, beta=0.7, l1=0.05, l2=0.1)
    z, n = [[0.0] * 3 for _ in range(7)], [[0.0] * 3 for _ in range(7)]  # the last row is the intercept

    def weight(i, k):
        l1, l2 = (0.05, 0.1) if i < 6 else (0, 0)
        size = abs(z[i][k])
        return 0.0 if size <= l1 else -math.copysign(size - l1, z[i][k]) / ((0.7 + math.sqrt(n[i][k])) / 0.3 + l2)

    for _ in range(200):
        places = np.sort(source.choice(6, 3, replace=False))
        values, language = source.uniform(0, 2, 3), int(source.integers(3))
        learner.learn(places, values, language)
        row = [*zip(places.tolist(), values.tolist()), (6, 1.0)]
        logit = [sum(x * weight(i, k) for i, x in row) for k in range(3)]
        total = sum(map(math.exp, logit))
        for k in range(3):
            for i, x in row:
                g = x * (math.exp(logit[k]) / total - (k == language))
                w = weight(i, k)
                z[i][k] += g - (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / 0.3 * w
                n[i][k] += g * g
    w, w0 = learner.weights()
    assert w == pytest.approx(np.array([[weight(i, k) for k in range(3)] for i in range(6)]), abs=1e-9)
    assert w0 == pytest.approx(np.array([weight(6, k) for k in range(3)]), abs=1e-9)


def test_penalty_leaves_chance_features_at_zero():
    source = np.random.default_rng(5)
    learner = li.Ftrl(200, 2, l1=4.0)
    for _ in range(400):
        language = int(source.integers(2))
        learner.learn(np.append(source.choice(np.arange(2, 200), 5, replace=False), language), np.ones(6), language)
    w, _ = learner.weights()
    assert w[0, 0] > 0 > w[0, 1] and (w[2:] == 0).mean() > 0.9


def test_temperature_is_the_likeliest():
    source = np.random.default_rng(1)
    logits = source.normal(size=(4_000, 3))
    language = np.array([source.choice(3, p=p) for p in li._softmax(logits)])
    assert li.temperature(3 * logits, language) == pytest.approx(3, rel=0.1)
    assert li.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1


def test_held_out_accuracy_and_scores(table):
    rows = [(k, speech(language, k, 1 + k % 40), language) for k, language in enumerate(list(SYLLABLES) * 60)]
    docs = table(rows, SCHEMA)
    model = li.fit(docs.filter(fold("doc_id", 4) != 2))
    assert model.languages == sorted(SYLLABLES)
    got = {r.doc_id: r for r in li.predict(docs, model).collect()}
    assert sum(got[k].lang_pred == language for k, _, language in rows) >= 0.98 * len(rows)
    for k, text, _ in rows[:40]:  # the probability, worked out n-gram by n-gram
        found = buckets(li.letters(text))
        z = sum(model.weights[model.place[b]].astype(float) for b in found) * li.LOUDNESS / math.sqrt(len(found) * max(len(found), li.FULL_VOICE))
        e = np.exp((z + model.bias) / model.temperature - max((z + model.bias) / model.temperature))
        assert got[k].score == pytest.approx((e / e.sum()).max(), abs=1e-6)
        assert got[k].lang_pred == model.languages[int(np.argmax(e))]


def test_many_copies_of_one_text_do_not_fill_the_sample(table, monkeypatch):
    monkeypatch.setattr(li, "SAMPLE", 20)
    rows = [(k, speech("en", 0, 30), "en") for k in range(200)] + [(200 + k, speech(x, k, 20), x) for k in range(60) for x in ("en", "de")]
    sample, languages = li._sampled(table(rows, SCHEMA).select("text", "lang"))
    kept = sample.collect()
    assert languages == ["de", "en"] and Counter(r.lang for r in kept) == {"de": 10, "en": 10}
    assert len({r.text for r in kept if r.lang == "en"}) == 10


def test_query_and_edge_rows(spark, tmp_path, tricky, nothing):
    from pyspark.sql import functions as F

    rows = [(k, speech(x, k, 15), x) for k, x in enumerate(["en", "de"] * 40)] + [(500, "12 !", "en"), (501, None, "de"), (502, "ein", None), (None, speech("de", 1, 9), "de"), (3, rows_text := prose(3, 3_000), "en"), (3, rows_text, "en")]
    spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "key", "n", "score", "lang_pred")}).write.parquet(f"{tmp_path}/documents.parquet")
    out = li.op13_language_id(spark, str(tmp_path))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert (by_id[500].lang_pred, by_id[500].score) == ("und", 0.0) == (by_id[501].lang_pred, by_id[501].score)
    assert by_id[502].lang_pred == "de" and by_id[None].lang_pred == "de"
    model = li.fit(tricky)
    assert li.predict(tricky, model).count() == 13
    empty = li.fit(nothing)
    assert {r.lang_pred for r in li.predict(tricky, empty).collect()} == {"und"} and li.predict(nothing, model).count() == 0
    silent = li.fit(spark.createDataFrame([(1, "1 2 3", "en")], SCHEMA))
    assert [r.lang_pred for r in li.predict(spark.createDataFrame([(1, "4", "en"), (2, "word", "en")], SCHEMA), silent).collect()] == ["und", "en"]
