from __future__ import annotations

import math
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F
from llm_fixtures import documents, odd_rows  # noqa: F401

from kohort.llm.sharding import op2_sharding, shard_documents, write_shards


def rows_of(spark, sf="/root/testdata/sf0.001"):
    return op2_sharding(spark, sf).collect()


def test_query(spark):
    rows = rows_of(spark)
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(text)
    for r in rows:
        data = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_only_the_key_decides(spark):
    a = spark.range(2000).withColumn("x", F.rand(1))
    one = {r.id: r.shard for r in shard_documents(a, "id", [1.0] * 8).collect()}
    two = {r.id: r.shard for r in shard_documents(a.repartition(7).where("id % 2 = 0"), "id", [1.0] * 8).collect()}
    assert all(one[k] == v for k, v in two.items())


def test_weights_and_growth(spark):
    docs = spark.range(20_000)
    got = shard_documents(docs, "id", [1, 2, 5], [1, 2, 5, 2]).collect()
    share = [sum(r.shard == s for r in got) / len(got) for s in range(3)]
    assert share == pytest.approx([1 / 8, 2 / 8, 5 / 8], abs=0.015)
    moved = [r for r in got if r.grown_shard != r.shard]
    assert all(r.grown_shard == 3 for r in moved) and len(moved) / len(got) == pytest.approx(0.2, abs=0.015)


def test_odd_rows(documents, odd_rows, spark, tmp_path):
    docs = documents(odd_rows + [(None, "x"), (None, "y"), (4, "one two")])
    got = shard_documents(docs.drop("shard"), "doc_id", [1.0] * 4)
    assert got.count() == len(odd_rows) + 3
    assert len({r.shard for r in got.where("doc_id IS NULL").collect()}) == 1
    write_shards(got.select("doc_id", "shard"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(odd_rows) + 3
    assert shard_documents(documents([]), "doc_id", [1.0]).count() == 0


def test_bad_weights(spark):
    with pytest.raises(ValueError):
        shard_documents(spark.range(1), "id", [1.0, 0.0])


def plain_shard(key, weights):
    """Rendezvous hashing with the xxhash library: the hash of the key seeds that of the shard number."""
    best = []
    for s, w in enumerate(weights):
        seed = xxhash.xxh64_intdigest(str(key).encode() if key is not None else b"", 42)
        h = xxhash.xxh64_intdigest(s.to_bytes(4, "little"), seed)
        u = ((h >> 11) + 0.5) / (1 << 53)
        best.append(-w / math.log(u))
    return best.index(max(best))


@pytest.mark.parametrize("weights", [[1.0] * 8, [1.0] * 9, [0.5, 3.0, 1.25], [2.0]])
def test_shards_against_another_hash_library(spark, weights):
    keys = [*range(-50, 400), 9_000_000_000, -(1 << 63), (1 << 63) - 1, None]
    got = shard_documents(spark.createDataFrame([(k,) for k in keys], "doc_id long"), "doc_id", weights).collect()
    assert {r.doc_id: r.shard for r in got} == {k: plain_shard(k, weights) for k in keys}
