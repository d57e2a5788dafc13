"""Correlations of many columns from blocked Gram matrices.

A pair's correlation over the rows in which both values are present needs six
sums: of ones, x, y, x^2, y^2 and xy.  For all pairs they are the products of
three matrices of a batch of rows: the values (absent ones as 0), their
squares, and the mask of present values.  So one pass over the data, with
matrix products per batch, replaces an aggregate per pair.

Columns are cut into blocks of ``BLOCK``.  Every task adds its batches up and
sends, per pair of blocks, one row per column of the first (``6 * BLOCK``
numbers); the rows of a column and a block are dealt over a few tasks, added
as a stream, and added again.  What a task holds depends on the number of
columns, not of rows.

Values are shifted by a value of their own column before they are multiplied,
which keeps the sums well conditioned and makes a constant column exactly 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: columns per block
BLOCK = 64
#: tasks that add up the rows of a column and a block first
_SPREAD = 16
#: a variance below this share of the squares is rounding, not spread
_ROUNDING = 1e-12
_SCHEMA = "i int, b int, part int, sums array<double>"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lists(rows: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as a list column."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel()))


def gram_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """i, b, sums: per column and block of columns (from the column's own block on) the sums over rows with both values.

    ``sums`` holds six stretches, one number per column of the block: of 1, x,
    x^2, y, y^2 and xy, where x is column ``i``, y the block's column, both less
    a value of their own.
    """
    doubles = df.select(*[F.col(_q(c)).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    # one row: some value of each column
    first = doubles.agg(*[F.min(f"c{i}").alias(f"c{i}") for i in range(len(columns))]).first()
    shift = np.array([0.0 if v is None or not np.isfinite(v) else v for v in first])
    edges = [(k, min(k + BLOCK, len(columns))) for k in range(0, len(columns), BLOCK)]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            raw = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            there = ~np.column_stack([c.is_null().to_numpy(zero_copy_only=False) for c in batch.columns])
            x, m = np.where(there, raw - shift, 0.0), there.astype(float)
            xx = x * x
            for a, (p, q) in enumerate(edges):
                for b, (r, s) in enumerate(edges[a:], a):
                    pairs = ((m, m), (x, m), (xx, m), (m, x), (m, xx), (x, x))
                    sums = np.concatenate([u[:, p:q].T @ v[:, r:s] for u, v in pairs], axis=1)
                    total[a, b] = total[a, b] + sums if (a, b) in total else sums
        part = TaskContext.get().partitionId() % _SPREAD
        for (a, b), sums in total.items():
            i = np.arange(*edges[a], dtype=np.int32)
            same = [pa.array(np.full(len(i), k, np.int32)) for k in (b, part)]
            yield pa.RecordBatch.from_arrays([pa.array(i), *same, _lists(sums)], ["i", "b", "part", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, b, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                sums = sums.values.to_numpy()
                total[i, b] = total[i, b] + sums if (i, b) in total else sums.copy()
        for (i, b), sums in total.items():
            numbers = [pa.array([k], pa.int32()) for k in (i, b, 0)]
            yield pa.RecordBatch.from_arrays([*numbers, _lists(sums[None])], ["i", "b", "part", "sums"])

    partial = doubles.mapInArrow(multiply, _SCHEMA)
    half = partial.repartition("i", "b", "part").mapInArrow(add, _SCHEMA)
    return half.repartition("i", "b").mapInArrow(add, _SCHEMA).drop("part")


def correlations(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """col_a, col_b, corr for every ordered pair; null where a column is constant over the pair's rows."""
    names, block = np.array(columns, object), BLOCK

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, b, sums in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2)):
                j = np.arange(b * block, min((b + 1) * block, len(names)))
                n, x, xx, y, yy, xy = sums.values.to_numpy().reshape(6, -1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    vx, vy = xx - x * x / n, yy - y * y / n
                    corr = np.where(j == i, 1.0, np.clip((xy - x * y / n) / np.sqrt(vx * vy), -1, 1))
                    known = (n > 1) & (vx > _ROUNDING * xx) & (vy > _ROUNDING * yy)
                ways = [(names[np.full(len(j), i)], names[j])]
                if b != i // block:  # the other block has no row for this pair
                    ways.append(ways[0][::-1])
                for a, c in ways:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(c, pa.string()), pa.array(corr, mask=~known)],
                                                     ["col_a", "col_b", "corr"])

    found = gram_rows(df, columns).mapInArrow(finish, "col_a string, col_b string, corr double")
    return found.withColumn("corr", F.round("corr", digits))
