from __future__ import annotations

import random

import pytest

#: columns of other tables and of the operators' own steps
CLASHES = ["key", "kind", "bucket", "a", "b", "n", "text_sha256", "component", "node", "spans", "_spans", "_keep", "ids",
           "score", "shard", "slot", "_chunk", "doc", "wanted", "parent", "block", "quality", "label", "html"]


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text) -> a documents table with columns whose names clash."""

    def make(rows):
        full = [(d, t, None, None, None if t is None else len(t), *(["x"] * len(CLASHES))) for d, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
        return spark.createDataFrame(full, schema)

    return make


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = [a + b for a in ("ba", "re", "to", "lin", "sur", "mo") for b in ("ka", "ne", "ris", "tol", "und", "é")]
    return " ".join(rng.choice(words) + ("." if rng.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, near copies."""
    base = prose(1, 300)
    words = base.split(" ")
    near = " ".join(words[:100] + ["changed"] + words[101:])
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, "ONE two"), (7, base), (8, base), (9, near),
        (9_000_000_000, near.upper()), (11, prose(2, 60_000)), (12, "x" * 150_000), (13, "ab " * 4000), (14, "\x00\x1f \x85 \xa0 é日本😀"),
        (15, prose(3, 40) + "\n" + base[:400] + "\n" + prose(4, 40)), (-3, prose(5, 80)), (17, "a\n" * 200),
        (18, "<|endoftext|> 's 're !'s  \n\n x"),
    ]
