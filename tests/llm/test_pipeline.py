from __future__ import annotations

import os

import numpy as np
from brute import components, cut, shingle_set
from llm_fixtures import documents, odd_rows, prose  # noqa: F401

import corpus_pipeline
from kohort.llm import quality_model
from kohort.llm.common import tokenizer_path

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SF = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    score = quality_model.fit_on_labels(spark, frame, SF).scorer()
    texts = {r.doc_id: r.text for r in frame.collect()}
    texts = {d: t for d, t in texts.items() if score(t) >= 0.5}
    last = {t or "": d for d, t in sorted(texts.items())}
    texts = {d: t for d, t in texts.items() if last[t or ""] == d}
    groups = components(list(texts.items()))
    texts = {d: t for d, t in texts.items() if groups[d][1] == d}
    left = {d: kept.decode("utf-8", "ignore") for d, (_, _, _, kept) in cut(list(texts.items())).items()}
    lengths = {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in left.items()}
    rows = corpus_pipeline.run(spark, SF).collect()
    got: dict[int, int] = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == lengths
    n = len({r.sequence_id for r in rows})
    assert n <= 1.05 * sum(lengths.values()) / 1024 + 1
    assert np.bincount([r.sequence_id for r in rows], weights=[r.length for r in rows]).max() <= 1024


def test_stages_keep_columns_and_odd_rows(spark, documents, odd_rows):  # noqa: F811
    docs = documents([*odd_rows, (4, "one two"), (None, prose(77, 60))])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema == docs.schema
        out.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_near_copies_by_five_words_and_eighty_percent(spark, documents):  # noqa: F811
    words = [f"w{i}" for i in range(94)]
    changed = [*words[:30], "other", *words[31:60], "another", *words[61:]]
    longer = [f"v{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(longer)), (4, " ".join([*longer, *[f"u{i}" for i in range(21)]])),
            (5, " ".join([*longer, *[f"t{i}" for i in range(30)]]))]
    sets = {d: shingle_set(t, 5) for d, t in rows}
    like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert 0.8 <= like(1, 2) < 0.85 and 0.8 <= like(3, 4) < 0.85 and like(3, 5) < 0.8 and like(4, 5) < 0.8
    left = corpus_pipeline.near(spark, documents(rows), SF)
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 5]


def test_empty_table(spark, documents):  # noqa: F811
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents([]), SF).count() == 0
