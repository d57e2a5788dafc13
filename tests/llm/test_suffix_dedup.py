from __future__ import annotations

import random

import numpy as np
from brute import cut, sha
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import documents, odd_rows, prose  # noqa: F401

from kohort.llm import suffix_dedup as op
from kohort.llm.bwt import collection_bwt, repeated


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=20) | st.text("ab", max_size=25).map(str.encode), min_size=1, max_size=8))
def test_transform_against_sorting(strings):
    lcp, string, length, bwt = collection_bwt(strings)
    suffix = lambda i, r: strings[i][len(strings[i]) - r:]
    want = sorted((tuple(x + 1 for x in suffix(i, r)) + (0, i), i, r) for i, s in enumerate(strings) for r in range(len(s) + 1))
    assert [(i, r) for _, i, r in want] == list(zip(string.tolist(), length.tolist()))
    assert int((bwt == 0).sum()) == len(strings)
    for k in range(1, len(want)):
        a, b = (suffix(i, r) for _, i, r in want[k - 1:k + 1])
        n = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[k] == n


def test_equal_windows_have_one_class():
    strings = [b"abcabcabc", b"xxabcabc", b"zzz"]
    group, string, offset = repeated(strings, 6)
    windows = [strings[s][o:o + 6] for s, o in zip(string, offset)]
    assert len(windows) == 7
    for i, a in enumerate(windows):
        for j, b in enumerate(windows):
            assert (a == b) == (group[i] == group[j])


def found(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()}


def test_odd_rows(documents, odd_rows):  # noqa: F811
    rows = [r for r in odd_rows if len(r[1] or "") < 200_000]
    assert found(op.remove_repeats(documents(rows))) == cut(rows)
    assert op.remove_repeats(documents([])).count() == 0


def test_shared_passages(documents):  # noqa: F811
    rng = random.Random(8)
    passages = [prose(50 + i, 40) for i in range(4)]
    rows = []
    for i in range(150):
        parts = [prose(1000 + i, 12)]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            parts += [p[a:a + rng.randint(60, len(p))], prose(5000 + rng.randrange(10**6), 5)]
        rows.append((i * 7 - 300, "".join(parts)))
    rows += [(5000, rows[3][1]), (5001, "é" * 90), (5002, "é" * 90), (5003, "ab" * 400), (5004, "abc" * 100 + "ab" * 100)]
    rng.shuffle(rows)
    assert found(op.remove_repeats(documents(rows))) == cut(rows)


def test_common_passage_is_spread(documents, monkeypatch):  # noqa: F811
    """A key with many different strings: no task gets more of them than a part holds."""
    build = op._build

    def counted(width, gram):
        run = build(width, gram)

        def checked(batches):
            def count():
                seen = {}
                for batch in batches:
                    for key in batch.column(0).to_pylist():
                        seen[key] = seen.get(key, 0) + 1
                    assert max(seen.values(), default=0) <= 16
                    yield batch

            return run(count())

        return checked

    monkeypatch.setattr(op, "_build", counted)
    monkeypatch.setattr(op, "PART", 16)
    monkeypatch.setattr(op, "SPREAD", 4, raising=False)
    notice = prose(40, 60)
    rows = [(i * 3, prose(2000 + i, 20) + (notice if i % 3 else notice[:200 + i]) + prose(4000 + i, 20)) for i in range(120)]
    rows += [(i * 3 + 1, prose(2000 + i, 20)) for i in range(0, 120, 7)] + [(7000, "ab" * 300)]
    random.Random(2).shuffle(rows)
    assert found(op.remove_repeats(documents(rows))) == cut(rows)


def test_other_widths(documents):  # noqa: F811
    rows = [(i, prose(i % 5, 30)[i:] + prose(90 + i, 4)) for i in range(25)]
    for width in (20, 60, 130):
        assert found(op.remove_repeats(documents(rows), width)) == cut(rows, width)


def test_long_text_in_slices(documents, monkeypatch):  # noqa: F811
    monkeypatch.setattr(op, "_SLICE", 500)
    text = prose(3, 900)
    rows = [(1, text), (2, prose(4, 300) + text[777:2999] + prose(5, 300)), (3, text[100:])]
    every = np.concatenate(list(op._slices([1], [text], 100, 32)))
    assert (every["size"] - 99).sum() == len(text.encode()) - 99
    assert found(op.remove_repeats(documents(rows))) == cut(rows)


def test_repeated_and_null_ids(documents):  # noqa: F811
    text = prose(1, 60)
    rows = [(1, text), (1, text), (None, text), (2, text)]
    got = sorted(((r.doc_id, r.n_removed) for r in op.remove_repeats(documents(rows)).collect()), key=str)
    assert got == sorted([(1, 0), (1, 0), (None, 0), (2, len(text.encode()))], key=str)


def test_cut_documents_keeps_columns(documents, odd_rows):  # noqa: F811
    docs = documents(odd_rows)
    left = op.cut_documents(docs)
    assert left.schema == docs.schema
    want = cut(odd_rows)
    for r in left.collect():
        text = dict(odd_rows)[r.doc_id]
        assert r.text == (text if not text else want[r.doc_id][3].decode("utf-8", "ignore"))
        assert r.n_chars == (None if r.text is None else len(r.text))


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    want = {k: (n, r, s, sha(kept)) for k, (n, r, s, kept) in cut(rows).items()}
    assert {r.doc_id: tuple(r)[1:] for r in op.op9_suffix_dedup(spark, d).collect()} == want
