from __future__ import annotations

import json
import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import documents, odd_rows, prose  # noqa: F401
from pyspark.sql import functions as F

from kohort.llm.bpe import Encoder, decode, encode
from kohort.llm.common import tokenizer_path
from kohort.llm.packing import cut_pieces, op1_packing, place, plan, sequences

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def reference_decode():
    from tokenizers import Tokenizer

    return lambda ids: Tokenizer.from_file(tokenizer_path()).decode(ids, skip_special_tokens=False)


ENCODER = Encoder(tokenizer_path())
PARTS = ["a", "b", "e", "the", " ", "  ", "\n", "\n\n", "'", "'s", "'re", "!", "!'", "..", "1", "23", "é", "日本", "😀", "\t", "ll",
         "<|endoftext|>", "<|end", "oftext|>", "ing", "ñ", "́", "\x85", "\xa0"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=200), st.integers(5, 60))
def test_tree_gives_the_ids_of_the_whole(parts, leaf):
    text = "".join(parts)
    assert ENCODER.encode(text, leaf).tolist() == ENCODER.piece(text).tolist()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_ids_are_the_library_s(text):
    from tokenizers import Tokenizer

    global _LIBRARY
    _LIBRARY = globals().get("_LIBRARY") or Tokenizer.from_file(tokenizer_path())
    ids = ENCODER.piece(text)
    assert ids.tolist() == _LIBRARY.encode(text, add_special_tokens=False).ids
    assert ENCODER.decode(ids) == text


def test_decoding_of_any_ids(reference_decode):
    rng = random.Random(3)
    for _ in range(100):
        ids = [rng.randrange(50_257) for _ in range(30)]
        assert ENCODER.decode(np.array(ids)) == reference_decode(ids)


@pytest.mark.parametrize("text", ["x" * 200_000, "xyzq" * 50_000, " " * 100_000 + "x", "é" * 60_000, "ab9!" * 30_000])
def test_long_unsplit_text(text):
    assert ENCODER.encode(text, 3001).tolist() == ENCODER.piece(text).tolist()


def test_refuses_another_kind_of_vocabulary(tmp_path):
    path = tmp_path / "v.json"
    path.write_text('{"added_tokens": [], "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": false}, '
                    '"model": {"vocab": {"a": 0, "b": 1, "ab": 2}, "merges": ["a b"]}}')
    with pytest.raises(ValueError):
        Encoder(str(path))


def test_encode_and_decode_rows(documents, odd_rows, reference):  # noqa: F811
    rows = odd_rows + [(11, odd_rows[10][1]), (11, odd_rows[10][1]), (None, "no id"), (None, "x" * 5000)]
    for leaf in (997, 32_768):
        got = decode(encode(documents(rows), leaf=leaf)).collect()
        assert sorted(((r.doc_id, list(r.ids), r.text) for r in got), key=str) == sorted(
            ((d, reference(t or ""), t or "") for d, t in rows), key=str)
    assert decode(encode(documents([]))).count() == 0


# --- packing ---------------------------------------------------------------

def loads(rows, size):
    """Sequences as lists of (offset, length) from plan rows."""
    out: dict[int, list[tuple[int, int]]] = {}
    for length, first, end, sequence, offset, each in rows:
        for nth in range(end - first):
            out.setdefault(sequence + nth // each, []).append((offset + nth % each * length, length))
    return out


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=20))
def test_plan_places_every_piece(counts):
    packed = loads(plan(counts, 32), 32)
    got: dict[int, int] = {}
    for parts in packed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
            got[length] = got.get(length, 0) + 1
        assert at <= 32
    assert got == counts
    assert sorted(packed) == list(range(len(packed)))


def test_two_smaller_pieces_replace_the_smallest():
    # greedy alone would fill 6 + 3 and leave a gap of 1; 2 + 2 fill it
    assert len(loads(plan({6: 1, 3: 1, 2: 2}, 10), 10)) == 2
    first = sorted(length for _, length in loads(plan({6: 1, 3: 1, 2: 2}, 10), 10)[0])
    assert first == [2, 2, 6]


def test_plan_is_tight():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 1025, 50_000)
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
    assert len(loads(plan(counts), 1024)) <= 1.005 * lengths.sum() / 1024


def check_packing(rows, ids):
    """rows: (doc, piece, start, length, crc, sequence, offset); ids: doc -> list of its ids with the separator."""
    by_sequence: dict[int, list] = {}
    for doc, piece, start, length, crc, sequence, offset in rows:
        part = np.array(ids[doc][start:start + length], "<u4")
        assert len(part) == length and zlib.crc32(part.tobytes()) == crc
        assert piece == 0 or length == 1024
        by_sequence.setdefault(sequence, []).append((offset, length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(r[3] for r in rows) == sum(map(len, ids.values()))
    return len(by_sequence)


def test_query(spark, reference):
    d = "/root/testdata/sf0.001"
    ids = {r.doc_id: reference(r.text or "") + [2] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = [tuple(r) for r in op1_packing(spark, d).collect()]
    n = check_packing(rows, ids)
    assert n <= 1.03 * sum(map(len, ids.values())) / 1024 + 1


def test_odd_rows_and_sequences(documents, odd_rows, reference):  # noqa: F811
    docs = documents([*odd_rows, (None, "no id")])
    pieces = cut_pieces(docs).withColumn("first", F.lit("clash")).withColumn("_nth", F.lit(7))
    placed = place(pieces).cache()
    ids = {d: reference(t or "") + [2] for d, t in [*odd_rows, (None, "no id")]}
    rows = [(r.doc_id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids)), r.sequence_id, r.offset) for r in placed.collect()]
    check_packing(rows, ids)
    whole = sequences(placed).collect()
    assert all(len(r.ids) == 4 * r.n_tokens <= 4096 for r in whole)
    assert sum(r.n_tokens for r in whole) == sum(map(len, ids.values()))
    again = cut_pieces(documents([(4, "one two")] * 3))
    assert place(again).count() == 3
    assert place(cut_pieces(documents([]))).count() == 0


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "NFC"}}, {"post_processor": {"type": "ByteLevel"}}, {"decoder": {"type": "WordPiece"}}, {"pre_tokenizer": None},
    {"model": {"ignore_merges": True}}, {"model": {"dropout": 0.1}}, {"model": {"type": "WordPiece"}}, {"model": {"end_of_word_suffix": "</w>"}},
    {"added_tokens": {"lstrip": True}}, {"added_tokens": {"rstrip": True}}, {"added_tokens": {"single_word": True}}, {"added_tokens": {"normalized": True}}])
def test_other_kinds_of_files_are_refused(tmp_path, change):
    spec = json.loads(open(tokenizer_path(), encoding="utf-8").read())
    for key, value in change.items():
        if key == "model":
            spec["model"] |= value
        elif key == "added_tokens":
            spec["added_tokens"] = [t | value for t in spec["added_tokens"]]
        else:
            spec[key] = value
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        Encoder(str(path))
