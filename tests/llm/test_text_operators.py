"""Personal data, licences, decontamination, packing, chat formatting and sharding against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import re._constants as sre
import re._parser as sre_parser
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_data import prose
from loanmill.llm import chat_format, decontaminate, license_rules, license_scan, packing, pii, sharding
from loanmill.llm import textbatch as tb
from pyspark.sql import functions as F

# -- personal data


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def only_digits(text):
    return re.sub("[^0-9]", "", text)


FIXED = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(only_digits(m)) <= 19 and luhn(only_digits(m))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(only_digits(m)) <= 15),
)


def fixed_spans(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in enumerate(FIXED) for m in re.finditer(p, text or "") if ok(m.group())]


def test_fixed_patterns(table):
    bits = ["a@b.c", "x", "1.2.3.4", ".5", "@", "4111 1111 1111 1111", "+1 (523) 555-1055", "é😀", "\n", " ", "-", "_", "%", "12", "300.",
            "0001.2.3.4", "4381893557741609", "+", "()", "a@b"]
    source = random.Random(3)
    texts = ["".join(source.choices(bits, k=source.randint(1, 12))) for _ in range(800)] + ["a" * 3000, "1" * 3000, "1." * 1500, "a@b.c " * 300]
    got = {r.doc_id: r for r in pii.extract(table(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, text in enumerate(texts):
        assert [tuple(s) for s in got[k].base] == fixed_spans(text), text


def test_contexts_reveal_what_patterns_miss_and_nothing_else(table):
    rows = [(k, f"please call me at +1 (523) 555-{1000 + k} today or so") for k in range(20)]
    rows += [(50, "please call me at 555-12345 today or so"), (51, "see you at 555-12345 maybe"), (52, "nothing in 1234567 here")]
    got = {r.doc_id: [tuple(s) for s in r.added] for r in pii.extract(table(rows, "doc_id long, text string")).collect()}
    assert got[50] == [(3, 18, 27)] and got[51] == [(3, 11, 20)] and got[52] == [] and not any(got[k] for k in range(20))
    masked = {r.doc_id: r.text for r in pii.mask(table(rows, "doc_id long, text string")).collect()}
    assert masked[0] == "please call me at <phone> today or so" and masked[51] == "see you at <phone> maybe" and masked[52] == rows[-1][1]


def test_pii_edge_rows(tricky, nothing):
    assert pii.extract(tricky).count() == 13 and pii.extract(nothing).count() == 0
    masked = pii.mask(tricky)
    assert masked.columns == tricky.columns and masked.count() == 13 and masked.filter("text is null").count() == 1


# -- licences


def scanned(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in license_scan.BASE:
        p = phrase.split()
        hits = [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    joined, found = " ".join(words), []
    if any(a in joined for a in license_rules.ANCHORS):
        for k, r in enumerate(license_rules.rules()):
            if r.keyword in joined:
                found += [(m.start(), -m.end(), r.priority, k, r.label) for m in re.finditer(r.pattern, joined)]
    kept = [d for d in found if not any(
        e[:4] != d[:4] and e[0] <= d[0] and e[1] <= d[1] and (e[:2] != d[:2] or e[2:4] < d[2:4]) for e in found
    )]
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels), sorted(d[4] for d in kept)


def test_license_scan(table):
    texts = [
        "Licensed under the MIT License. MIT license mit license", "SPDX-License-Identifier: Apache-2.0 License", None, "",
        "GNU Lesser General Public License v2.1 or later; GPLv3", "Creative Commons Attribution-ShareAlike 4.0", "mit licenses, mitlicense",
        "Permission is hereby granted, free of charge, to any person obtaining a copy, to deal without restriction, copyright license",
        "é Apache License, Version 2.0 ü Apache license", "dual license: Mozilla Public License 2.0 / BSD 3-Clause License", prose(1, 200),
        "All rights reserved. Copyright (c) 2020 x. " * 30, "http://www.apache.org/licenses/LICENSE-2.0 general public license",
    ]
    rows = license_scan.scan(table(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, sorted(d.label for d in r.detections)) == scanned(texts[r.doc_id])


def test_license_rules_are_many_and_anchored():
    rules = license_rules.rules()
    assert len(rules) > 300 and len({r.pattern for r in rules}) == len(rules)


def test_license_edge_rows(tricky, nothing):
    assert license_scan.scan(tricky).count() == 13 and license_scan.scan(nothing).count() == 0


# -- decontamination


def shingles(text):
    w = re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


@pytest.mark.parametrize("block", [4 << 20, 300])
def test_containment_search(table, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK_BYTES", block)
    items = [(k, prose(500 + k, size)) for k, size in enumerate((5, 6, 9, 30, 33, 100, 4))] + [(20, prose(503, 30)), (21, None)]
    docs = [(k, prose(k, 300)) for k in range(20)]
    for k, (_, text) in enumerate(items[:7]):
        w = text.split()
        docs.append((100 + k, prose(k, 200) + " " + text.upper() + ", " + prose(k + 40, 900)))
        docs.append((200 + k, prose(k, 50) + " " + " ".join(w[: int(len(w) * 0.9)] + ["zz"] + w[int(len(w) * 0.9) :])))
        docs.append((300 + k, " ".join(w[: len(w) // 2])))
    got = {(r.doc, r.item, r.n_item_shingles, r.n_shared) for r in decontaminate.search(
        table(docs, "doc_id long, text string"), table(items, "item_id long, text string")).collect()}
    want = set()
    for d, text in docs:
        for i, item in items:
            a, b = shingles(text), shingles(item)
            if b and 10 * len(a & b) >= 8 * len(b):
                want.add((d, i, len(b), len(a & b)))
    assert got == want and len(want) >= 12


def test_decontamination_edge_rows(tricky, nothing, table):
    items = table([(1, prose(1, 30)), (None, None), (2, "")], "item_id long, text string").withColumn("row", F.lit("clash"))
    assert {r.doc for r in decontaminate.search(tricky, items).collect()} == {1, None, 11}
    left = decontaminate.without_benchmarks(tricky, items)
    assert left.columns == tricky.columns and left.count() == 9
    assert decontaminate.search(nothing, items).count() == 0 and decontaminate.without_benchmarks(tricky, items.limit(0)).count() == 13


# -- packing


def test_planned_configurations_hold_the_histogram_exactly():
    source = np.random.default_rng(5)
    for capacity, count in ((64, 400), (2048, 3000), (10, 1), (7, 50)):
        counts = dict(Counter(source.integers(1, capacity + 1, count).tolist()))
        planned, held = packing.plan(counts, capacity), Counter()
        for config, bins in planned:
            assert sum(n * k for n, k in config) <= capacity and bins > 0
            for n, k in config:
                held[n] += k * bins
        assert held == Counter(counts)
        assert sum(b for _, b in planned) <= sum(packing._fitted(counts, capacity).values())
    assert packing.plan({}) == []


def test_the_program_gives_the_packing():
    source = np.random.default_rng(0)

    def histogram(lengths):
        return dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))

    cases = {
        "flat": ({n: 50 for n in range(1, 2049)}, 51_225), "five": ({1000: 2500, 700: 5000, 600: 2500, 348: 5000, 400: 2500}, 5_000),
        "log-normal": (histogram(np.clip(np.exp(source.normal(5.5, 1, 50_000)).astype(int), 1, 2048)), 9_398),
        "thirds": (histogram(np.concatenate([source.integers(600, 760, 40_000), source.integers(300, 700, 20_000)])), 18_300),
    }
    for counts, most in cases.values():
        planned = sum(b for _, b in packing.plan(counts))
        assert planned <= most and planned <= sum(packing._fitted(counts, 2048).values())
        variants = [packing._rounded(counts, 2048, *v) for v in packing.VARIANTS]
        assert planned == min(sum(out.values()) for out, _ in variants)  # not best fit's
        assert max(priced / sum(out.values()) for out, priced in variants) > 0.8
    assert sum(packing._fitted(cases["five"][0], 2048).values()) > 5_000


def test_fractions_cover_no_length_twice():
    counts = {1500: 7, 1000: 4, 548: 7, 300: 30, 3: 2}
    uses = packing.solve(counts)
    held = Counter()
    for config, amount in uses.items():
        assert sum(n * many for n, many in config) <= 2048
        for n, many in config:
            held[n] += many * amount
    assert all(held[n] <= c + 1e-6 for n, c in counts.items()) and held[1500] > 6.9


def test_bounds_of_words_and_signs_are_joined_by_marks(monkeypatch):
    """A union by hashes took more than half of the time of tokenizing."""
    rng = np.random.default_rng(5)
    cases = [(np.unique(rng.integers(0, 60, n)), np.unique(rng.integers(0, 60, m))) for n, m in ((0, 0), (0, 9), (9, 0), (30, 30), (60, 5))]
    expected = [np.union1d(a, b) for a, b in cases]

    def union1d(*_):
        raise AssertionError("arrays are hashed")

    monkeypatch.setattr(np, "union1d", union1d)
    for (a, b), both in zip(cases, expected):
        assert packing._either(a.astype(np.int64), b.astype(np.int64), 60).tolist() == both.tolist()
    texts = ["a-b (c)", "", None, "x,", ",y", "!", "z"]
    column = tb.texts_of(pa.array(texts))
    _, spans, first = packing.WordTokens(packing.default_vocabulary())._parts(column)
    words = [column.data[a:b].tobytes().decode() for a, b in spans.T.tolist()]
    assert [words[a:b] for a, b in zip(first, first[1:])] == [["a", "-", "b", "(", "c", ")"], [], [], ["x", ","], [",", "y"], ["!"], ["z"]]


def test_pieces_are_those_of_the_tokenizer_and_fill_sequences(table, tricky, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    texts = [prose(k, 5 + 37 * k) for k in range(30)] + [None, "", "don't  <|endoftext|>x\u00a0ÀÉ ǅ ①２", prose(7, 9000),
        "Don't. 'S ,'s!(a)e\u0301,A\u030a. x'll,y 12,3.4 a_b-c:d é,é <a>|b|'t \\ \"q\" ```x"]
    rows = packing.pack(table(list(enumerate(texts)), "doc_id long, text string"), keep_ids=True).collect()
    by, places = defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        by[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for k, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert [i for r in by[k] for i in r.ids] == ids
        assert [(r.piece, r.start, r.length) for r in by[k]] == [(p, p * 2048, len(ids[p * 2048 : p * 2048 + 2048])) for p in range(-(-len(ids) // 2048))]
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in by[k])
    for placed in places.values():
        filled = 0
        for offset, length in sorted(placed):
            assert offset == filled
            filled += length
        assert filled <= 2048
    packed = packing.pack(tricky).collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed) and sum(r.piece == 0 for r in packed) == 13
    assert packing.pack(nothing).count() == 0


# -- chats


def test_escapes_can_be_undone():
    source = random.Random(1)
    bits = [m.strip() for m in chat_format.MARKS] + ["\\", "\\\\", "a", "é ", "\n", " ", "[", "<s", "/s>", "<"]
    for _ in range(5000):
        text = "".join(source.choices(bits, k=source.randint(0, 7)))
        escaped = chat_format.escape(text)
        assert chat_format.unescape(escaped) == text
        assert all(escaped[m.start() - 1] == "\\" for m in re.finditer(chat_format._CONTROL, escaped))


def test_conversations_read_back(table):
    rows = [(1, 1, "assistant", "</s>[INST] ok \\[/INST]"), (1, 0, "user", "hi\n\n é"), (1, 2, "tool[OUT]", "x"), (1, 3, None, None),
            (2, 0, "assistant", ""), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (None, None, "user", "lost"), (3, 5, "system", "s" * 5000)]
    conversations = table(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit("clash"))
    formatted = chat_format.format_chats(conversations)
    got = {r.conv_id: r for r in chat_format.digests(formatted).collect()}
    digest = lambda *turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[1].turns_sha256 == digest(("user", "hi\n\n é"), ("assistant", rows[0][3]), ("tool[OUT]", "x"), ("", ""))
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (4, len(rows[0][3]), hashlib.sha256(rows[0][3].encode()).hexdigest())
    assert (got[2].n_turns, got[2].loss_chars, got[None].n_turns) == (3, 2, 1)
    output = formatted.orderBy("conv_id", "nth").collect()
    assert all(len(r.ids) == len(r.mask) and set(r.mask) <= {0, 1} for r in output)
    assert not any(sum(r.mask) for r in output if r.conv_id == 3)
    assert [r.nth for r in output if r.conv_id == 2] == [0, 1, 2]
    assert all((r.ids[0] == chat_format.BOS) == (r.nth == 0) for r in output)
    assert chat_format.format_chats(conversations.limit(0)).count() == 0


def test_a_conversation_of_most_rows_spreads_over_tasks(spark, monkeypatch):
    """One conversation, and one of repeated rows without id or number, go over many ranges and read back whole."""
    monkeypatch.setattr(chat_format, "RANGE_TURNS", 5_000)
    long = spark.range(200_000).select(
        F.lit(4).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t "), F.col("id") * 7919 % 1000).alias("text"),
    )
    same = spark.range(60_000).select(
        F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.lit("again").alias("text")
    )
    encoded = chat_format.turns(chat_format.in_order(long.unionAll(same)))
    per_range = [r["count"] for r in encoded.groupBy("range").count().collect()]
    assert len(per_range) > 30 and max(per_range) < 15_000
    formatted = chat_format.format_chats(long.unionAll(same))
    got = {r.conv_id: r for r in chat_format.digests(formatted).collect()}
    said = [("user" if k % 2 == 0 else "assistant", f"t {k * 7919 % 1000}") for k in range(200_000)]
    assert got[4].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
    assert got[4].loss_sha256 == hashlib.sha256("".join(t for r, t in said if r == "assistant").encode()).hexdigest()
    assert (got[None].n_turns, got[None].loss_chars) == (60_000, 300_000)
    # Places have no gaps: each turn begins where the one before it ends.
    sizes = formatted.select("conv_id", "nth", "start", F.size("ids").alias("n"))
    ends = sizes.groupBy("conv_id").agg(F.max(F.col("start") + F.col("n")).alias("end"), F.sum("n").alias("all"), F.countDistinct("nth").alias("turns"))
    assert all(r.end == r["all"] and r.turns == (200_000 if r.conv_id else 60_000) for r in ends.collect())
    starts = sizes.filter("conv_id = 4").orderBy("nth").collect()
    assert all(a.start + a.n == b.start for a, b in zip(starts, starts[1:]))


# -- shards


def test_permutation(spark):
    for total in (1, 2, 3, 5, 17, 63, 64, 65, 1000, 4099):
        places = [r.p for r in spark.range(total).select(sharding.permuted(F.col("id"), total, 7).alias("p")).collect()]
        assert sorted(places) == list(range(total))
        assert total < 60 or places != sorted(places)


def test_shards_are_even_and_do_not_depend_on_partitions(table, tricky, nothing):
    docs = table([(k, prose(k, k % 9)) for k in range(1003)], "doc_id long, text string")
    rows = sharding.assign(docs, 16).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert (r.size, r.text_crc32) == (len(prose(r.doc_id, r.doc_id % 9).encode()) + 1, zlib.crc32(prose(r.doc_id, r.doc_id % 9).encode()))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == 16
    again = sharding.assign(docs.repartition(7), 16).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}
    edge = sharding.assign(tricky, 4).collect()
    assert sorted(r.row_number for r in edge) == list(range(13)) and sharding.assign(nothing).count() == 0


def test_rows_that_repeat_are_numbered_in_many_tasks(spark, monkeypatch):
    """A third of all rows alike, without id or text: each has a slot of its own, and no task writes more than a cut of them."""
    monkeypatch.setattr(sharding, "COPIES", 700)
    ids = spark.range(10_000).select("id", F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = ids.unionAll(spark.range(5_000).select(F.lit(None).cast("long"), F.lit(None).cast("string"))).withColumnRenamed("id", "doc_id")
    rows = sharding.assign(docs, 16).collect()
    assert sorted(r.row_number for r in rows) == list(range(15_000)) and sum(r.doc_id is None for r in rows) == 5_000
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 16
    assert {r.shard for r in rows if r.doc_id is None} == set(range(16))


def examples(pattern):
    """Texts that the pattern matches, but for what it looks ahead for: each alternative once, each optional part out and in."""

    def of(items):
        parts = [one(op, arg) for op, arg in items]
        plain = [p[0] for p in parts]
        return ["".join(plain)] + ["".join([*plain[:k], v, *plain[k + 1 :]]) for k, p in enumerate(parts) for v in p[1:]]

    def one(op, arg):
        if op is sre.LITERAL:
            return [chr(arg)]
        if op is sre.IN:
            return [chr(a if o is sre.LITERAL else a[0]) for o, a in arg if o in (sre.LITERAL, sre.RANGE)][:1] or ["x"]
        if op is sre.BRANCH:
            return [v for branch in arg[1] for v in of(branch)]
        if op is sre.SUBPATTERN:
            return of(arg[3])
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            return [v * arg[0] for v in of(arg[2])] + (of(arg[2]) if not arg[0] else [])
        return [""] if op in (sre.ASSERT, sre.ASSERT_NOT, sre.AT) else ["x"]

    return of(sre_parser.parse(pattern))


def test_every_alternative_of_every_rule_passes_its_prefilter(table):
    seen = 0
    for rule in license_rules.rules():
        behind = " copyright" if "(?=" in rule.pattern else ""
        for text in examples(rule.pattern):
            assert re.search(rule.pattern, text + behind) and rule.keyword in text, (rule.label, text)
            assert any(anchor in text + behind for anchor in license_rules.ANCHORS), (rule.label, text)
            seen += 1
    assert seen > 3_000
    texts = ["internet systems consortium license applies here", "this is under mozilla.org/MPL/2.0 terms"]
    rows = license_scan.scan(table(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[d.label for d in r.detections] for r in rows] == [["isc"], ["mpl-2.0"]]
