from __future__ import annotations

from collections import defaultdict

from brute import sha
from llm_fixtures import documents, odd_rows  # noqa: F401

from kohort.llm import exact_dedup
from kohort.llm.exact_dedup import directory, drop_copies, exact_groups


def expected(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    keep = {t: max((d for d in ids if d is not None), default=None) for t, ids in groups.items()}
    return sorted(((d, keep[t or ""], len(groups[t or ""]), d == keep[t or ""], sha(t or "")) for d, t in rows), key=str)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def test_odd_rows(documents, odd_rows):
    rows = odd_rows + [(7, odd_rows[6][1]), (None, "no id"), (None, "one two")]
    assert found(exact_groups(documents(rows))) == expected(rows)


def test_empty_table(documents):
    assert exact_groups(documents([])).count() == 0
    assert drop_copies(documents([])).count() == 0


def test_weak_keys_chain(documents, odd_rows):
    """With two key bits every bucket chains many different texts."""
    rows = odd_rows + [(100 + i, f"text {i % 40}") for i in range(200)]
    weak = exact_groups(documents(rows), key_bits=2, max_depth=4)
    assert found(weak) == expected(rows)
    assert weak.agg({"link": "max"}).first()[0] > 5


def test_directory_splits_overfull_buckets(spark):
    entries = spark.range(1000).selectExpr("xxhash64(id) as key", "10L as n_bytes")
    rows = directory(entries, max_depth=8, bucket_bytes=500).collect()
    assert {r.depth for r in rows} <= set(range(3, 9)) and len({r.bucket for r in rows}) >= 20
    load = defaultdict(int)
    for r in entries.selectExpr("cast(shiftrightunsigned(key, 56) as int) as slot").collect():
        load[next(x.bucket for x in rows if x.slot == r.slot)] += 10
    assert all(v <= 500 for v in load.values())
    one = directory(entries, max_depth=8, bucket_bytes=10**9).collect()
    assert {(r.depth, r.bucket) for r in one} == {(0, 0)}


def test_hot_text(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) as text")
    kept = drop_copies(docs)
    assert kept.columns == ["doc_id", "text"]
    assert kept.count() == 2001 and kept.where("text = 'hot'").collect()[0].doc_id == 2997


def test_drop_copies_keeps_columns_and_one_row(documents, odd_rows):
    rows = odd_rows + [(8, odd_rows[7][1]), (8, odd_rows[7][1])]
    docs = documents(rows)
    kept = drop_copies(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(
        {k for _, k, _, kept_, _ in expected(rows) if kept_})


def test_query_has_sql():
    assert "sha256" in exact_dedup.SQL


def test_depth_follows_the_bytes():
    assert exact_dedup.depth_for(0) == (2, exact_dedup.BUCKET_BYTES)
    for total in (1 << 30, 1 << 40, 100 * 10**12, 10**16):
        depth, size = exact_dedup.depth_for(total)
        assert depth <= exact_dedup.DEPTH_LIMIT and size << depth >= 2 * total  # even keys never end in an overfull bucket
    assert exact_dedup.depth_for(10**12)[1] == exact_dedup.BUCKET_BYTES


def test_which_of_equal_rows_stays(spark):
    rows = [(1, "same", c, n) for c, n in [("b", 1), ("a", 2), ("a", 1), (None, 9)]] + [(2, "other", "z", 0)]
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n int").repartition(parts)
        assert sorted(tuple(r) for r in drop_copies(docs).collect()) == [(1, "same", None, 9), (2, "other", "z", 0)]
