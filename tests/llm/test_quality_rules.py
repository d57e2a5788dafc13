from __future__ import annotations

from brute import measures
from llm_fixtures import documents, odd_rows  # noqa: F401

from kohort.llm.quality_rules import MEASURES, POLICIES, RULES, Policy, ablation, apply_policy, ledger, measure_text


def test_measures_of_odd_rows(documents, odd_rows):
    rows = odd_rows + [(4, "one two"), (None, "a b c a b c a b c"), (30, "x y\nx y\n \nx y"), (31, "p q r p q r")]
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in ledger(documents(rows)).collect()), key=str)
    assert got == sorted(((d, *measures(t)) for d, t in rows), key=str)
    assert ledger(documents([])).count() == 0


def test_policy_is_a_mask(documents):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(1, good), (2, good.upper()), (3, " ".join(["$$$"] * 3 + good.split())), (4, "short"), (5, " ".join(["x"] * 100))]
    book = ledger(documents(rows))
    kept = lambda p: {r.doc_id for r in apply_policy(book, p).where("kept").collect()}
    assert kept(POLICIES["base"]) == {1, 2, 3}
    assert kept(POLICIES["v1"]) == {1, 2, 3} and kept(POLICIES["v2"]) == {1, 3}
    assert kept(Policy("none", ())) == {1, 2, 3, 4, 5}
    assert kept(Policy("symbols only", ("symbols",))) == {1, 2, 3, 4, 5}


def test_ablation_counts(spark):
    policy = Policy("t", ("few_words", "symbols"))
    few, sym = (1 << list(RULES).index(r) for r in policy.rules)
    book = spark.createDataFrame([(0,), (few,), (few | sym,), (sym,), (sym,), (1 << 6,)], "fail_bits long")
    got = {r.rule: (r.n_failed, r.n_only_this, r.n_kept_without) for r in ablation(book, policy).collect()}
    assert got == {"few_words": (2, 1, 3), "symbols": (3, 2, 4)}


def test_measure_names():
    assert len(measure_text(None)) == len(MEASURES) and set(measure_text("")) == {0}


def test_keeps_labelled_good(spark):
    d = "/root/testdata/sf0.01"
    book = apply_policy(ledger(spark.read.parquet(f"{d}/documents.parquet")))
    rows = book.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and r.n_words >= 50]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad)
