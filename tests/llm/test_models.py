"""Language and quality classifiers: held-out accuracy, and defined results for odd rows."""

from __future__ import annotations

import pickle
import random
import zlib

import numpy as np
from llm_fixtures import CLASHES, documents, odd_rows, prose  # noqa: F401
from pyspark.sql import functions as F

from kohort.llm import language, quality_model

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = language.op3_language_id(spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) >= 0.98


def test_language_odd_rows(spark, documents, odd_rows):  # noqa: F811
    learn = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(learn, per_lang=40, landmarks_per_lang=10)
    rows = [*odd_rows, (20, "1234 !!"), (4, "one two"), (None, "the and of")]
    got = language.predict(documents(rows), model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for d in (1, 2, 3, 20):
        assert (by[d].lang_pred, by[d].score) == ("und", 0.0)
    assert all(r.lang_pred in model.langs for r in got if r.doc_id not in (1, 2, 3, 20))
    assert language.predict(documents([]), model).count() == 0
    none = language.fit(documents(rows).withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.predict(documents(rows), none).collect()} == {"und"}


def test_language_scores_are_the_kernel_s(monkeypatch):
    """The weights per n-gram give the same outputs as the kernel against the landmarks."""
    rows = [language.presence(prose(i, 50)) for i in range(6)]
    marks = rows[:3]
    alpha = np.array([[1.0, -2.0], [0.5, 0.0], [-1.0, 3.0]])
    weights = np.zeros((1 << language.BITS, 2), np.float32)
    for grams, row in zip(marks, alpha):
        weights[grams] += row / np.sqrt(len(grams))
    direct = language._kernel(rows, marks) @ alpha
    assert np.allclose(direct, [weights[r].sum(axis=0) / np.sqrt(len(r)) for r in rows], atol=1e-4)
    one = language.KernelModel(("x", "y"), marks, alpha)
    names, score = one.predict([prose(0, 50), None])
    assert names == [("x", "y")[int(direct[0].argmax())], "und"]
    assert np.allclose(one._scores(rows), direct, atol=1e-4)
    monkeypatch.setattr(language, "LANG_BLOCK", 1)  # the product with the kernel matrix
    again, by_kernel = one.predict([prose(0, 50), None])
    assert again == names and np.allclose(score, by_kernel, atol=1e-4)


def test_many_languages_are_all_learned(spark):
    name = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(3))
    rows = [(2 * i + j, " ".join(f"{name(i * 181)}{name(i * 77 + 5)} {name(i * 53 + 9)}o" for _ in range(5)), f"l{i:03d}")
            for i in range(150) for j in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert len(model.langs) == 150
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    assert got == {d: lang for d, _, lang in rows}


def test_two_thousand_languages(spark):
    """The model grows by one weight per landmark for each language; none is left out."""
    rows = []
    for i in range(2000):
        rng = random.Random(i)
        syllables = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(12)]
        rows += [(3 * i + j, " ".join(rng.choice(syllables) + rng.choice(syllables) for _ in range(30)), f"l{i:04d}") for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.fit(docs)
    assert len(model.langs) == 2000 and len(model.marks) == language.LANDMARKS
    assert len(pickle.dumps(model)) < 2000 * 4 * language.LANDMARKS + 4_000_000
    got = {r.doc_id: r.lang_pred for r in language.predict(docs.where("doc_id < 600"), model).collect()}
    assert np.mean([got[d] == lang for d, _, lang in rows[:600]]) > 0.8


def test_one_language_holds_most_rows(spark):
    """Weights per language, not per row: a rare language is told apart from one with most of the rows."""
    rows = [(i, prose(i, 40), "xx") for i in range(400)] + [(1000 + i, "zzq wwv kkj " * (3 + i), "yy") for i in range(4)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.predict(["kkj zzq wwv", prose(9999, 30)])[0] == ["yy", "xx"]


def test_presence_of_a_long_text_is_the_union():
    text = prose(9, 400)
    assert np.array_equal(language.presence(" ".join([text] * 900)), language.presence(text + " " + text))


def test_quality_held_out(spark):
    rows = quality_model.op8_quality_classifier(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) >= 0.95
    assert np.mean([b for a, b in held if a == 1]) >= 0.98


def test_quality_odd_rows(spark, documents, odd_rows):  # noqa: F811
    learn = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    model = quality_model.fit(learn, labels, per_class=60)
    rows = [*odd_rows, (4, "one two"), (None, "no id")]
    docs = documents(rows)
    got = quality_model.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] == 1 / (1 + np.exp(-model.shift))
    kept = quality_model.keep_good(docs, model)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r.doc_id for r in got if r.predicted), key=str)
    assert quality_model.score(documents([]), model).count() == 0


def test_quality_without_labels(spark, documents):  # noqa: F811
    docs = documents([(1, "some text"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.score > 0.99 for r in quality_model.score(docs, quality_model.fit(docs, none)).collect())
    torn = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1)], "doc_id long, quality int")
    assert all(r.score > 0.99 for r in quality_model.score(docs, quality_model.fit(docs, torn)).collect())
    bad = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    assert all(r.predicted == 0 for r in quality_model.score(docs, quality_model.fit(docs, bad)).collect())
    assert CLASHES
