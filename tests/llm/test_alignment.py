"""Cross-tokenizer alignment against the tokenizers themselves and a plain alignment."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kohort.llm import alignment
from kohort.llm.bpe import _byte_of_char
from kohort.llm.common import shared_table, tokenizer_path
from llm_fixtures import documents, odd_rows, prose  # noqa: F401


@pytest.fixture(scope="module")
def plain():
    """text -> (A ids, A bytes, B ids, B bytes), by the two libraries."""
    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    a.no_truncation()
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.piece_path())
    byte = _byte_of_char()

    def run(text):
        if not text:
            return [], [], [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            p = b.id_to_piece(i)
            bytes_b.append(bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
        raw = (" " + text).encode()
        return (ids_a, bytes_a, ids_b, bytes_b) if b"".join(bytes_a) == raw == b"".join(bytes_b) else ([], [], [], [])

    return run


def brute(rows, plain):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of every row."""
    done, counts = [], Counter()
    for doc, text in rows:
        ids_a, bytes_a, ids_b, bytes_b = plain(text)
        ends_a, ends_b, n = {}, {}, 0
        for i, t in enumerate(bytes_a):
            n += len(t)
            ends_a[n] = i
        n = 0
        for i, t in enumerate(bytes_b):
            n += len(t)
            ends_b[n] = i
        groups, links, p, q = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a[end] + 1, ends_b[end] + 1
            groups.append(",".join(map(str, ids_a[p:i])) + "|" + ",".join(map(str, ids_b[q:j])))
            links.append((ids_a[i - 1], ids_b[j - 1]))
            p, q = i, j
        counts.update(links)
        done.append((doc, len(ids_a), len(ids_b), links, ";".join(groups)))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return sorted((doc, na, nb, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                   hashlib.sha256(groups.encode()).hexdigest() if na else "") for doc, na, nb, links, groups in done)


def query(docs, tmp_path, monkeypatch, **options):
    if options:
        monkeypatch.setattr(alignment, "align", lambda d, f=alignment.align: f(d, **options))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = alignment.op11_tokenizer_alignment(docs.sparkSession, str(tmp_path))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows.columns == names
    return sorted(tuple(r) for r in rows.collect())


ODD = ["▁ not a space", " two  leading", "tab\tnew\n\nline ", "<s>x</s><0x41><|endoftext|>", "naïve café – “x”", "a\x00b\x1f", "日本語のテキスト 混ぜる",
       "😀😀 👩‍👩‍👧", " nbsp　wide", " ", "\n", "é ﬁ Å", "supercalifragilistic" * 30]


def test_odd_rows(spark, documents, odd_rows, plain, tmp_path, monkeypatch):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(ODD)]
    got = query(documents(rows), tmp_path, monkeypatch)
    assert got == brute(rows, plain)
    without = {r[0] for r in got if r[1] == 0}
    assert {1, 2, 100} <= without  # null, empty, and a text that holds the sign for a space


def test_small_blocks_and_memo(spark, documents, plain, tmp_path, monkeypatch):
    rows = [(i, prose(i, 40 + i)) for i in range(60)] + [(7, prose(7, 47))]
    got = query(documents(rows), tmp_path, monkeypatch, block_links=50)
    assert got == brute(rows, plain)


def test_memo_is_bounded_and_changes_nothing():
    small = alignment.Aligner(tokenizer_path(), alignment.piece_path(), memo_tokens=100)
    large = alignment.Aligner(tokenizer_path(), alignment.piece_path())
    rng = random.Random(3)
    for k in range(40):
        text = "".join(rng.choice(["the ", "of ", "Straße ", "x", " ", "\n", "é", "日", "ing", "😀"]) for _ in range(rng.randrange(60)))
        (a, b, groups, links), (a2, b2, groups2, links2) = small.align(text), large.align(text)
        assert (a, b, groups, links.tolist()) == (a2, b2, groups2, links2.tolist()), text
    assert small.held < 100 + 60 * 8 and large.held > small.held


def test_windows_begin_at_verified_anchors():
    al = alignment.Aligner(tokenizer_path(), alignment.piece_path())
    al.align("the cat sat on the cat sat on the mat")
    assert len(al.memo) < 8  # repeated words are one window each
    for key in al.memo:
        ids = np.frombuffer(key, np.uint32)
        a, b = ids[ids < len(al.a.tokens)], ids[ids >= len(al.a.tokens)] - len(al.a.tokens)
        assert al.a.tokens[a[0]][:1] == b" " and al.b.tokens[b[0]][:1] == b" "


def test_empty_table(spark, documents, tmp_path, monkeypatch):
    assert query(documents([]), tmp_path, monkeypatch) == []


def test_pair_counts_over_the_corpus(spark, documents):
    docs = documents([(1, "red red blue"), (2, "red"), (3, None)])
    aligned = shared_table(alignment.align(docs), "test-aligned")
    counts = {(r.id_a, r.id_b): r.links for r in alignment.pair_counts(alignment.block_links(aligned)).collect()}
    assert sum(counts.values()) == sum(r.n_links for r in aligned.collect())
    assert max(counts.values()) == 3
