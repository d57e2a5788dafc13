"""Hard-negative mining with L2AP-style threshold joins (operator 13).

Scores are inner products of integer vectors.  Queries (the anchors) search
rows that are dealt into lanes of bounded size; a task builds the index of
one lane after the other and lets the queries stream past it.

* *Index*: dimensions in order of falling energy, in slabs.  A row's slabs
  from the point on where the norm of its rest times that of any query's rest
  stays below the threshold are left out of the inverted index (they cannot
  make a partner alone).
* *Search*: partial scores grow slab by slab over the index; a row whose
  partial score plus the product of the remaining norms stays below the
  query's threshold is pruned, and the rest of the sum is only worked out for
  those that remain.
* *Thresholds* begin high and are lowered until every window of the query
  holds ``k`` rows, or the window's lower end is reached; where a window is
  full, its last score is the threshold for all later rows.  Pruning uses
  upper bounds only, so no result is lost.

Both searches use it: positives (rows of the anchor's label, one window
without ends) and negatives (rows of other labels, one window per positive).
The lanes' best rows are merged by a ranking per window.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; a shorter vector counts as ended by zeros, an empty
one scores 0; ties go to the smaller id; "other rows" are rows of another
id; wholly repeated anchors are one anchor, other repeated rows count each;
anchors of one id with different rows are searched each; a null id is no
anchor and, as a candidate, no row; components beyond the range of 64-bit
integers are taken at its ends, and so are scores; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_table, table

#: components of a lane (the index that a task holds), and rows of a block within it
LANE_VALUES = 1 << 22
BLOCK_ROWS = 8_192
#: queries that are searched at once
QUERIES = 256
#: dimensions whose products are added before rows are pruned again
SLAB = 8
#: first threshold, as a share of the largest possible score, and its lowering
FIRST, LOWER = 0.8, 0.8
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           scale: int = 256) -> DataFrame:
    """id, label (long), v (array of long: floor(scale * x)) of the rows that take part."""
    v = F.col(vector_col)
    whole = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform(v, lambda x: F.floor(x.cast("double") * float(scale)).cast("long"))
    return (rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & whole)
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), scaled.alias("v")))


def energy_order(rows: DataFrame) -> list[int]:
    """Dimensions by falling sum of squares over all rows (one number per dimension)."""
    square = F.col("x").cast("double") * F.col("x")
    found = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.sum(square).alias("e")).collect()
    return [r.d for r in sorted(found, key=lambda r: (-r.e, r.d))]


def _matrix(lists: pa.ListArray, order: list[int]) -> np.ndarray:
    """Vectors as rows, dimensions in ``order``; shorter ones end in zeros."""
    edge, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    n, place = np.diff(edge), np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    out = np.zeros((len(lists), len(order)), np.int64)
    row, d = np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    known = d < len(order)  # a dimension that no indexed row has adds nothing
    out[row[known], place[d[known]]] = flat[edge[0]:edge[-1]][known]
    return out


def _exact_type(rows: np.ndarray, queries: np.ndarray) -> type:
    """The fastest number type in which all sums of products are exact."""
    top = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (rows, queries)]
    most = top[0] * top[1] * max(1, rows.shape[1])
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def _rest_norms(x: np.ndarray, slabs: int) -> np.ndarray:
    """Norm of what follows each slab's begin, rounded up (one column per slab and one for the end)."""
    squares = np.square(x.astype(np.float64)).reshape(len(x), slabs, SLAB).sum(axis=2)
    rest = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
    return np.concatenate([rest * (1 + 1e-9), np.zeros((len(x), 1))], axis=1)


class _Lane:
    """The rows of a lane, and their inverted index by slabs of dimensions."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        pad = -x.shape[1] % SLAB or (SLAB if not x.shape[1] else 0)
        self.x = np.pad(x, ((0, 0), (0, pad)))
        self.ids, self.labels, self.slabs = ids, labels, self.x.shape[1] // SLAB
        self.rest = _rest_norms(self.x, self.slabs)
        self.kind = None

    def blocks(self, kind: type) -> list[tuple[np.ndarray, list[np.ndarray]]]:
        """Row numbers of each block, and per slab the postings (the block's components there)."""
        if self.kind is not kind:  # also frees the former copy
            self.kind, self.parts = kind, []
            for at in range(0, len(self.ids), BLOCK_ROWS):
                # rows with the longest index first: a slab's postings are then the first rows
                rows = np.arange(at, min(at + BLOCK_ROWS, len(self.ids)))
                rows = rows[np.argsort(-self.rest[rows, self.slabs // 2], kind="stable")]
                self.parts.append((rows, [self.x[rows, s * SLAB:(s + 1) * SLAB].astype(kind) for s in range(self.slabs)]))
        return self.parts

    def search(self, q: np.ndarray, allowed, kinds: type, windows: list[list[tuple[int, int]]], k: int) -> list[list[list]]:
        """For every query and window ``(low, high)`` the best ``k`` allowed (score, id), best first."""
        best = [[[] for _ in w] for w in windows]
        rest = _rest_norms(q, self.slabs)
        slabs = [q[:, s * SLAB:(s + 1) * SLAB].astype(kinds) for s in range(self.slabs)]

        def floor(i: int) -> float:
            """No row below this score can still matter to query i."""
            return min((b[-1][0] if len(b) == k else lo for (lo, hi), b in zip(windows[i], best[i]) if lo <= hi),
                       default=float("inf"))

        for rows, postings in self.blocks(kinds):
            ok = allowed(rows)  # queries x rows
            floors = np.array([floor(i) for i in range(len(q))], np.float64)
            top = rest[:, 0] * self.rest[rows, 0].max(initial=0.0)
            full = [all(len(b) == k for b in w) for w in best]
            # a query with full windows needs one pass; others start high
            level = np.where(full, floors, np.maximum(floors, FIRST * top))
            above = np.full(len(q), np.inf)  # scores from here on are known
            todo = np.flatnonzero(floors < np.inf)
            while len(todo):
                for i, row, score in self._pass(slabs, rest, rows, postings, ok, todo, level):
                    new = score < above[i]
                    self._offer(best[i], windows[i], score[new], self.ids[row[new]], k)
                above[todo] = level[todo]
                floors = np.array([floor(i) for i in todo], np.float64)
                todo_next, now = [], level[todo]
                for i, f, t in zip(todo, floors, now):
                    if t > f:
                        lower = LOWER * t if t > 0.05 * top[i] else -np.inf
                        level[i] = max(f, lower)
                        todo_next.append(i)
                todo = np.array(todo_next, np.int64)
        return best

    def _pass(self, slabs: list, rest: np.ndarray, rows: np.ndarray, postings: list, ok: np.ndarray, todo: np.ndarray,
              level: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Rows whose score reaches the query's level: (query, row numbers, scores)."""
        own, bar = self.rest[rows], level[todo]
        # a row's index ends where the rest cannot reach any level alone
        depth = (own * rest[todo].max(axis=0) >= max(bar.min(), 0.0))[:, :self.slabs].sum(axis=1)
        posted = [int(np.flatnonzero(depth > s).max(initial=-1)) + 1 for s in range(self.slabs)]
        score = np.zeros((len(todo), len(rows)), postings[0].dtype)
        for s, n in enumerate(posted):
            score[:, :n] += slabs[s][todo] @ postings[s][:n].T
        met = (np.array(posted) > np.arange(len(rows))[:, None]).sum(axis=1)  # slabs in the score so far
        alive = ok[todo] & (score + rest[todo][:, met] * own[np.arange(len(rows)), met] >= bar[:, None])
        for s, n in enumerate(posted):  # what the index leaves out, for the remaining pairs
            left = alive[:, n:]
            if not left.any():
                continue
            if left.mean() > 0.1:
                score[:, n:] += slabs[s][todo] @ postings[s][n:].T
            else:
                i, r = np.nonzero(left)
                score[i, n + r] += (slabs[s][todo[i]] * postings[s][n + r]).sum(axis=1)
            left &= score[:, n:] + np.outer(rest[todo, s + 1], own[n:, s + 1]) >= bar[:, None]
        for i in np.flatnonzero(alive.any(axis=1)):
            r = np.flatnonzero(alive[i])
            yield todo[i], rows[r], score[i, r]

    @staticmethod
    def _offer(best: list[list], windows: list[tuple[int, int]], score: np.ndarray, ids: np.ndarray, k: int) -> None:
        for w, (lo, hi) in enumerate(windows):
            fits = np.flatnonzero((score >= lo) & (score <= hi))
            if len(best[w]) == k:
                fits = fits[score[fits] >= best[w][-1][0]]
            if len(fits) > 4 * k:  # all that reach the k-th score, ties too
                least = np.sort(score[fits])[-k]
                fits = fits[score[fits] >= least]
            if len(fits):
                rows = [*best[w], *zip(map(int, score[fits]), ids[fits].tolist())]
                best[w] = sorted(rows, key=lambda x: (-x[0], x[1]))[:k]


def threshold_join(rows: DataFrame, queries: DataFrame, order: list[int], k: int,
                   same_label: bool) -> DataFrame:
    """qid, qkey, w, id, score: the best ``k`` rows of every query's windows, by lane.

    ``rows``: id, label, v, lane.  ``queries``: qid, qkey, label, v, lane and
    windows (array of (low, high)); one row for each lane to search.  Rows of
    the query's own id are never partners; ``same_label`` picks rows of its
    label, else of the others.
    """
    both = (rows.select("lane", F.lit(0).alias("kind"), "id", F.lit(None).cast("long").alias("qkey"), "label", "v",
                        F.lit(None).cast("array<struct<low:long,high:long>>").alias("windows"))
            .unionByName(queries.select("lane", F.lit(1).alias("kind"), F.col("qid").alias("id"), "qkey", "label", "v", "windows")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, parts, index = None, [], None
        for batch in batches:
            lanes, kinds = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            edges = [0, *(i for i in range(1, batch.num_rows) if lanes[i] != lanes[i - 1] or kinds[i] != kinds[i - 1]), batch.num_rows]
            for start, end in zip(edges, edges[1:]):
                part = batch.slice(start, end - start)
                if lane is None or lane[0] != lanes[start]:
                    lane, parts, index = (lanes[start],), [], None
                if kinds[start] == 0:
                    parts.append(part)
                elif parts:
                    if index is None:
                        t = pa.Table.from_batches(parts).combine_chunks()
                        parts = parts[:1]
                        index = _Lane(t.column("id").to_numpy(), t.column("label").to_numpy(),
                                      _matrix(t.column("v").combine_chunks(), order))
                    for at in range(0, part.num_rows, QUERIES):
                        found = _answers(index, part.slice(at, QUERIES), order, k, same_label)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 5)],
                            ["qid", "qkey", "w", "id", "score"])

    # a lane's rows come before the queries that stream past them
    return (both.repartition("lane").sortWithinPartitions("lane", "kind")
            .mapInArrow(run, "qid long, qkey long, w long, id long, score long"))


def _answers(index: _Lane, part: pa.RecordBatch, order: list[int], k: int, same_label: bool) -> list[tuple]:
    qid, label = part.column("id").to_numpy(), part.column("label").to_numpy()
    x = _matrix(part.column("v"), order)
    q = np.pad(x, ((0, 0), (0, index.x.shape[1] - x.shape[1])))
    windows = [[(w["low"], w["high"]) for w in ws] for ws in part.column("windows").to_pylist()]

    def allowed(rows: np.ndarray) -> np.ndarray:
        return ((index.labels[rows] == label[:, None]) == same_label) & (index.ids[rows] != qid[:, None])

    found = index.search(q, allowed, _exact_type(index.x, q), windows, k)
    keys = part.column("qkey").to_pylist()
    return [(qid[i], keys[i], w, row, min(max(score, _LOW), _HIGH))
            for i, of in enumerate(found) for w, best in enumerate(of) for score, row in best]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each window over all lanes, with their rank."""
    top = Window.partitionBy("qid", "qkey", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         lane_values: int = LANE_VALUES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors``: id, label, v.  A negative's score lies between
    ``low`` and ``high`` percent of the positive's.
    """
    rows = shared_table(rows, "negative-rows")
    order = energy_order(rows)
    total, lane_rows = rows.count(), max(1, lane_values // max(1, len(order)))
    key = F.xxhash64("label", "v")
    asked = shared_table(anchors.select(F.col("id").alias("qid"), "label", "v", key.alias("qkey"))
                         .dropDuplicates(["qid", "label", "v"]), "anchors")

    # positives: lanes of one label each
    parts = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / lane_rows).cast("int").alias("parts"))
    own = F.struct("label", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))
    open_end = F.array(F.struct(F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high")))
    near = threshold_join(
        rows.join(parts, "label").withColumn("lane", F.xxhash64(own)),
        asked.join(parts, "label").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1).cast("array<long>")))
             .withColumn("lane", F.xxhash64(F.struct("label", "part"))).withColumn("windows", open_end),
        order, positives, same_label=True)
    chosen = shared_table(_ranked(near, positives).select("qid", "qkey", "rank", F.col("id").alias("positive_id"),
                                                          F.col("score").alias("positive_score")), "positives")

    # negatives: lanes over all rows, one window per positive
    lanes = max(1, -(-total // lane_rows), min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BLOCK_ROWS))
    p = F.col("positive_score").cast("decimal(38,0)")
    ends = F.struct(F.ceil(p * low / 100).cast("long").alias("low"), F.floor(p * high / 100).cast("long").alias("high"))
    windows = (chosen.groupBy("qid", "qkey")
               .agg(F.array_sort(F.collect_list(F.struct("rank", ends.alias("ends")))).alias("all"))
               .select("qid", "qkey", F.transform("all", lambda x: x["ends"]).alias("windows")))
    far = threshold_join(
        rows.withColumn("lane", F.pmod(F.xxhash64("id"), F.lit(lanes))),
        asked.join(windows, ["qid", "qkey"]).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)).cast("array<long>"))),
        order, negatives, same_label=False)
    best = _ranked(far, negatives).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    return (best.join(chosen.withColumnRenamed("rank", "place").withColumn("w", F.col("place").cast("long") - 1).drop("place"),
                      ["qid", "qkey", "w"])
            .select(F.col("qid").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.pmod("id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return mine(rows, rows.where(F.pmod("id", F.lit(50)) == 0))


SQL = """
WITH u AS (
  SELECT CAST(vec_id AS BIGINT) AS id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same,
         CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.v, b.v)]) AS BIGINT) AS score
  FROM u a JOIN u b ON a.id % 50 = 0 AND a.id <> b.id),
positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
       n.other AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
