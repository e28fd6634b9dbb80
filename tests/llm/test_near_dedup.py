from __future__ import annotations

import random
import re


from loanmill.llm import near_dedup
from loanmill.llm.components import components


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0D]+", lowered)


def shingles(text, n):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1)))


def expected(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def family(count, size, seed):
    """A text and mutants of earlier members, so that similarities lie on both sides of the threshold."""
    source = random.Random(seed)
    members = [[f"w{source.randint(0, 999)}" for _ in range(size)]]
    while len(members) < count:
        copy = list(source.choice(members))
        for _ in range(source.randint(0, 3)):
            copy[source.randrange(size)] = f"v{source.randint(0, 999)}"
        members.append(copy)
    return [" ".join(m) for m in members]


def test_components_equal_brute_force_on_chains_and_copies(spark, table):
    texts = family(60, 60, 1) + family(30, 200, 2) + ["Same Text here"] * 5 + ["same text HERE", "", " ", None, "one", "one"]
    rows = [(100 - k, t) for k, t in enumerate(texts)]
    docs = table(rows, "doc_id long, text string")
    for n, percent in ((3, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs, shingle=n, percent=percent).collect()}
        assert got == expected(rows, n, percent)


def test_blocks_of_any_size_find_the_same(spark, table, monkeypatch):
    rows = list(enumerate(family(40, 50, 3)))
    monkeypatch.setattr(near_dedup, "MEMBER_BLOCK", 7)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(table(rows, "doc_id long, text string"), shingle=3, percent=85).collect()}
    assert got == expected(rows, 3, 85)


def test_a_third_of_all_rows_in_one_component(spark, table):
    """Copies and near copies of one text make up a third of all rows; joins on what they share give the same results when
    nothing travels whole."""
    near = family(12, 80, 8)
    rows = [(k, near[k % 12] if k % 3 == 0 else f"alone {k} " + " ".join(f"u{k}x{j}" for j in range(12))) for k in range(900)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        found = near_dedup.near_duplicates(table(rows, "doc_id long, text string"), shingle=3, percent=85).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    distinct = {text: k for k, text in reversed(rows)}
    of = expected([(k, t) for t, k in distinct.items()], 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {k: of[distinct[t]][:2] for k, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == 900


def test_near_copies_with_null_and_repeated_ids(table):
    texts = family(40, 60, 4) + family(20, 80, 5)
    ids = [None if k % 3 == 0 else 7 + k % 4 for k in range(40)] + [None] * 20
    rows = [pair for k, pair in enumerate(zip(ids, texts)) for _ in range(1 + (k % 5 == 0))]
    of = expected(list(enumerate(t for _, t in rows)), 3, 85)
    names = {}
    for k, (_, root, _) in of.items():
        names.setdefault(root, []).append(rows[k][0])
    smallest = {root: min((i for i in held if i is not None), default=None) for root, held in names.items()}
    wanted = sorted(repr((i, of[k][0], smallest[of[k][1]])) for k, (i, _) in enumerate(rows))
    got = near_dedup.near_duplicates(table(rows, "doc_id long, text string"), shingle=3, percent=85).collect()
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in got) == wanted


def test_edge_rows(tricky, nothing):
    rows = near_dedup.near_duplicates(tricky).collect()
    assert len(rows) == 13
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5, 6}
    assert [r.component_id for r in rows if r.doc_id is None and r.n_shingles] == [1]  # a copy of document 1
    assert [r.kept for r in rows if r.doc_id is None] .count(True) == 1  # the NULL text, linked with nothing
    left = near_dedup.one_of_each(tricky)
    assert left.columns == tricky.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 1, 1, 5, 6, 7, 8, 9, 10, 12]
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}}
