"""attach_scalars: a one-row aggregate appended to every row through one
scalar subquery (no join); an empty one-row side gives nulls."""

from __future__ import annotations

from pyspark.sql import functions as F
from test_plans import _nodes

from kohort.operators.aggregates import attach_scalars


def test_attach_values_nulls_and_plan(spark):
    df = spark.range(5).withColumn("g", F.col("id") % 2)
    one = df.agg(F.sum("id").alias("total"), F.max("id").alias("top"),
                 F.array(F.lit(1.0), F.lit(2.0)).alias("arr"))
    out = attach_scalars(df, one)
    assert out.columns == ["id", "g", "total", "top", "arr"]
    assert {(r.id, r.total, r.top, tuple(r.arr)) for r in out.collect()} == \
        {(i, 10, 4, (1.0, 2.0)) for i in range(5)}
    kinds = [n.getClass().getSimpleName() for n in _nodes(out._jdf.queryExecution().executedPlan())]
    assert kinds.count("SubqueryExec") == 1
    assert not [k for k in kinds if "Join" in k]
    empty = df.where("id > 100").groupBy("g").agg(F.sum("id").alias("total"))
    got = attach_scalars(df, empty.select("total")).collect()
    assert len(got) == 5 and all(r.total is None for r in got)
