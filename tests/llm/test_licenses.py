"""License scans against a plain version of the same rules."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from kohort.llm import licenses
from llm_fixtures import documents, odd_rows, prose  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows):
    """(doc_id, n_words, n_base, first, last, base labels, labels, score) of every row."""
    notices = [(n.label, words(n.text), [words(k) for k in n.keys]) for n in licenses.NOTICES]
    vocabulary = {w for _, t, _ in notices for w in t}
    texts = [(doc, words(t)) for doc, t in rows]
    seen = Counter(w for _, t in texts for w in set(t) & vocabulary)
    out = []
    for doc, text in texts:
        places = []
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            places += [(i, label) for i in range(len(text)) if text[i:i + len(p)] == p]
        own, best = set(), 0.0
        have, joined = set(text), " " + " ".join(text) + " "
        for label, t, keys in notices:
            ranked = sorted(set(t), key=lambda w: (seen[w], w))
            asked = min(licenses.LOOK_UP, len(ranked))
            needed = max(2, -int(-licenses.MEET * asked // 1))
            chosen = [w for w in ranked if w in have][:asked]
            if len(chosen) < needed or not any(" " + " ".join(k) + " " in joined for k in keys):
                continue
            begins = {(i - p, w) for i, w in enumerate(text) if w in chosen for p, x in enumerate(t) if x == w}
            met = max(len({w for b, w in begins if abs(b - o) <= licenses.SLACK}) for o, _ in begins)
            if met >= needed:
                own.add(label)
                best = max(best, met / asked)
        base = {label for _, label in places}
        at = [i for i, _ in places]
        out.append((doc, len(text), len(places), min(at, default=None), max(at, default=None),
                    ",".join(sorted(base)), ",".join(sorted(base | own)), (0.5 if places else 0.0) + best / 2))
    return out


def rank(rows):
    return sorted(rows, key=lambda r: (str(r[0]), str(r)))


@pytest.fixture
def run(spark, documents, tmp_path):
    def f(rows):
        documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
        got = licenses.op12_license_scan(spark, str(tmp_path))
        assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        return rank(tuple(r) for r in got.collect())

    return f


def notice(label, n=0):
    return [x.text for x in licenses.NOTICES if x.label == label][n]


def corpus():
    rng = random.Random(4)
    rows = [(i, prose(i, 30 + i)) for i in range(40)]
    for k, n in enumerate(licenses.NOTICES):
        rows.append((100 + k, prose(k, 50) + "\n" + n.text.upper() + "\n" + prose(k + 1, 20)))
        cut = n.text.split(" ")
        del cut[len(cut) // 2: len(cut) // 2 + 2]  # two words are missing, some others stand between
        cut[len(cut) // 3: len(cut) // 3] = ["by", "Some", "Holder,"]
        rows.append((200 + k, " ".join(cut)))
        shuffled = n.text.split(" ") * 3
        rng.shuffle(shuffled)
        rows.append((300 + k, " ".join(shuffled)))  # all words, no order
        rows.append((400 + k, " ".join(n.text.split(" ")[:6])))
    return rows


def test_notices_and_phrases(run):
    rows = corpus()
    got = run(rows)
    assert got == rank(brute(rows))
    by_id = {r[0]: r for r in got}
    for k, n in enumerate(licenses.NOTICES):
        assert n.label in by_id[100 + k][6].split(","), n.label
    assert all(by_id[i][6] == "" and by_id[i][7] == 0.0 for i in range(40))


def test_odd_rows(run, odd_rows):
    base = "MIT-License, the Apache  LICENSE and\nGNU General\tPublic License; mit license"
    rows = odd_rows + [(30, base), (31, "mit license " * 9000), (32, "MIT"), (33, "license mit"), (34, "émit license"), (35, "mit license"),
                       (30, base), (30, "other"), (36, "general public licenses"), (None, "apache license"), (37, notice("mit") * 40), (38, "mit license license")]
    got = run(rows)
    assert got == rank(brute(rows))
    found = {r[0]: r for r in got if r[0] != 30}
    assert found[31][2:5] == (9000, 0, 2 * 8999)
    assert found[34][2] == found[35][2] == found[33][2] == 0


def test_empty_table(run):
    assert run([]) == []


def test_general_interface(spark, documents):
    own = (licenses.Notice("house", "kept by the river house for its own readers", ("river house",)),)
    docs = documents([(1, "x y kept by the river house for its own readers"), (2, "kept by the house river for its own readers"), (3, "house rules")])
    got = {r.doc_id: r for r in licenses.scan(docs, {"house rules": "rules"}, own).collect()}
    assert [(m.label, m.start) for m in got[1].matches] == [("house", 2)] and got[2].matches == []
    assert [(p.start, p.label) for p in got[3].places] == [(0, "rules")]


def test_no_python_in_the_plan(spark):
    plan = licenses.scan(spark.createDataFrame([(1, "mit license")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_sql_gives_the_same(odd_rows):  # noqa: F811
    import duckdb
    import pandas as pd

    rows = [(i + 1000 * k, t) for k, some in enumerate((corpus(), [r for r in odd_rows if "\x00" not in (r[1] or "")])) for i, t in some]
    rows += [(90_000, notice("mit") * 5), (90_001, "mit license " * 50), (90_002, "GNU General\tPublic License; mit license")]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    none = lambda x: None if x is None or x != x else x
    got = [tuple(none(x) for x in r) for r in con.execute(licenses.SQL).fetchall()]
    assert rank(got) == rank(brute(rows))
