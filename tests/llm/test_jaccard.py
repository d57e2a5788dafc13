from __future__ import annotations

import random

import duckdb
import numpy as np
from brute import components as brute
from brute import shingle_set
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import documents, odd_rows, prose  # noqa: F401

from kohort.llm import signature_trees as trees
from kohort.llm.components import components
from kohort.llm.shingles import shingles


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAbZ \n\té\x0b\x1c", max_size=40))
def test_shingle_counts(text):
    assert len(shingles(text, 4)) == len(shingle_set(text))


def near_copies(seed, n, words=60, edits=4):
    """Copies with some words changed, and looser relatives."""
    rng = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(1000)}"
        out.append(" ".join(w))
    return out


def test_odd_rows(documents, odd_rows):  # noqa: F811
    assert found(trees.jaccard_components(documents(odd_rows))) == brute(odd_rows)
    rows = [*odd_rows, (7, odd_rows[6][1]), (None, odd_rows[6][1])]
    got = trees.jaccard_components(documents(rows)).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == brute(odd_rows)
    assert trees.jaccard_components(documents([])).count() == 0


def test_groups_of_near_copies(documents):  # noqa: F811
    texts = [t for s in range(12) for t in near_copies(s, 12)] + [prose(100 + s, 50) for s in range(60)]
    rows = list(enumerate(texts))
    random.Random(0).shuffle(rows)
    assert found(trees.jaccard_components(documents(rows))) == brute(rows)


def test_large_block_over_several_tasks(documents, monkeypatch):  # noqa: F811
    monkeypatch.setattr(trees, "BLOCK", 8)
    monkeypatch.setattr(trees, "CARRY", 3)
    texts = near_copies(7, 90, edits=3) + [t for s in range(20, 30) for t in near_copies(s, 5)]
    rows = list(enumerate(texts))
    assert found(trees.jaccard_components(documents(rows))) == brute(rows)


def test_common_shingle_is_dealt(documents, monkeypatch):  # noqa: F811
    """Entries of a shingle that very many documents have: no task gets them all, no link is lost."""
    rest = trees._meet_rest

    def counted(percent):
        run = rest(percent)

        def checked(batches):
            def count():
                seen = {}
                for batch in batches:
                    for at in zip(*[c.to_pylist() for c, name in zip(batch.columns, batch.schema.names) if name in ("key", "cell")]):
                        seen[at] = seen.get(at, 0) + 1
                    assert max(seen.values(), default=0) <= 32
                    yield batch

            return run(count())

        return checked

    monkeypatch.setattr(trees, "_meet_rest", counted)
    monkeypatch.setattr(trees, "MEET", 16, raising=False)
    monkeypatch.setattr(trees, "DEAL", 8, raising=False)
    rng = random.Random(6)
    template = prose(9, 90).split()
    texts = []
    for i in range(160):  # own words around and inside one template, of many lengths
        own = [f"w{i}x{k}" for k in range(rng.randint(2, 14))]
        cut = rng.randint(0, len(own))
        w = [*own[:cut], *template, *own[cut:]]
        texts.append(" ".join(w[:rng.randint(70, len(w))]))
    rows = list(enumerate(texts))
    assert found(trees.jaccard_components(documents(rows))) == brute(rows)


def test_meet_finds_every_pair_that_fits():
    rng = np.random.default_rng(3)
    for percent in (80, 85, 100):
        e = np.zeros(300, trees._ENTRY)
        e["doc"], e["class_"] = np.arange(300) - 20, rng.integers(0, 200, 300)
        e["n"] = rng.integers(1, 60, 300)
        e["place"] = (e["n"] * rng.random(300) * 0.3).astype(int)
        group = rng.integers(0, 3, 300)
        n = e["n"].astype(np.int64)
        reach = (100 + percent) * (n - e["place"]) // percent - n
        got = trees.meet(e, group, np.full(300, 2), reach, [frozenset()] * 300)
        want = {(int(e["doc"][i]), int(e["doc"][j])) for i in range(300) for j in range(i + 1, 300)
                if group[i] == group[j] and trees._fits(e[i:i + 1], e[j:j + 1], percent)[0]}
        assert {tuple(x) for x in got.tolist()} == want


def test_repeated_id_with_different_texts_shares_no_keys(documents, monkeypatch):  # noqa: F811
    """No keys are skipped for a doc_id whose rows differ but have sets of one size."""
    rest = trees._meet_rest

    def checked(percent):
        run = rest(percent)

        def check(batches):
            def each():
                for batch in batches:
                    at = {name: c.to_pylist() for name, c in zip(batch.schema.names, batch.columns)}
                    assert all(not keys for doc, keys in zip(at["doc"], at["earlier"]) if doc == 500)
                    yield batch

            return run(each())

        return check

    monkeypatch.setattr(trees, "_meet_rest", checked)
    texts = [t for s in range(6) for t in near_copies(s, 12)]
    rows = list(enumerate(texts)) + [(500, texts[0]), (500, texts[12])]
    got = found(trees.jaccard_components(documents(rows)))
    want = brute([*rows[:-2], (500, texts[0])])
    assert all(got[d][0] == n for d, (n, _) in want.items() if d != 500)
    assert got[500][1] == got[0][1] == got[12][1]


def test_other_words_and_threshold(documents):  # noqa: F811
    texts = [t for s in range(8) for t in near_copies(s, 8, edits=8)]
    rows = list(enumerate(texts))
    got = found(trees.jaccard_components(documents(rows), words=5, percent=80))
    sets = {d: shingle_set(t, 5) for d, t in rows}
    for a, x in sets.items():
        for b, y in sets.items():
            if 100 * len(x & y) >= 80 * len(x | y):
                assert got[a][1] == got[b][1]


def test_tree_keeps_every_linked_pair():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        base = np.unique(rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64))
        for _ in range(3):
            keep = rng.random(len(base)) > 0.05
            sets.append(base[keep] if keep.any() else base)
    pairs = set(trees.SignatureTree(sets).candidates(85))
    pairs |= {(b, a) for a, b in pairs}
    linked = {(a, b) for a in range(len(sets)) for b in range(len(sets)) if a != b and trees.linked(sets[a], sets[b], 85)}
    assert linked and linked <= pairs
    assert len(pairs) < len(sets) * (len(sets) - 1) / 4


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(50)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        parent[hi] = lo
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in nodes}


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    want = {r[0]: (r[1], r[2]) for r in con.execute(trees.SQL).fetchall()}
    assert found(trees.op10_jaccard_join(spark, d)) == want


def test_one_id_with_two_texts_of_one_length():
    """Directly on a batch of candidate pairs: the second text of an id is not taken for the first."""
    import pyarrow as pa

    first, second = prose(1, 60), prose(2, 60)
    second = second[:len(first)].ljust(len(first), "x")
    batch = pa.RecordBatch.from_arrays([pa.array([1, 1, 3]), pa.array([2, 2, 2]), pa.array([second, second, first]),
                                        pa.array([first, second, second])], ["a", "b", "ta", "tb"])
    assert [b.num_rows for b in trees._test(4, 85)(iter([batch]))] == [1]


def test_repeated_id_keeps_the_links_of_all_its_texts(documents):  # noqa: F811
    first, second = prose(1, 60), prose(2, 60)
    second = second[:len(first)].ljust(len(first), "x")
    rows = [(2, first), (2, second), (5, first + " more"), (6, second + " more"), (9, second), (11, first)]
    got = {r.doc_id: r.component_id for r in trees.jaccard_components(documents(rows)).collect()}
    assert got == {2: 2, 5: 2, 6: 2, 9: 2, 11: 2}


def test_entries_are_bounded_for_long_texts(documents, monkeypatch):  # noqa: F811
    """Long texts that nearly link: an entry carries a bounded number of keys, and every link is found."""
    rest = trees._meet_rest

    def watched(percent):
        run = rest(percent)

        def checked(batches):
            def look():
                for batch in batches:
                    longest = max((len(x) for x in batch.column(7).to_pylist()), default=0)
                    assert longest <= trees.EARLIER
                    yield batch
            return run(look())
        return checked

    monkeypatch.setattr(trees, "_meet_rest", watched)
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(4000)]
    rows = []
    for i, edits in enumerate([0, 60, 90, 130, 170, 200, 260, 320]):
        w = list(base)
        for k in rng.sample(range(4000), edits):
            w[k] = f"x{i}y{k}"
        rows.append((i + 1, " ".join(w)))
    assert found(trees.jaccard_components(documents(rows))) == brute(rows)
