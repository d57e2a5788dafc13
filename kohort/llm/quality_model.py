"""Quality classifier by compression (operator 8).

Two zstandard dictionaries are built, one from good and one from bad
labelled text.  A text is cut into pieces of ``PIECE`` bytes, every piece is
compressed with both dictionaries, and the normalised difference of the
compressed sizes, ``(bad - good) / (bad + good)``, summed over the whole
text, goes through a logistic curve fitted on labelled documents that built
neither dictionary.  Pieces keep the dictionaries' influence the same at the
start and at the end of a long text.

Fitting reads a bounded sample of the labelled rows: at most ``per_class``
documents of each class (lowest hash of the id first) and at most
``PIECES_PER_DOC`` pieces of each, spread evenly over its text.  The curve
is weighted by the class counts of all labelled rows.  Scoring reads every
byte of every text.

Defined cases: a null text counts as empty; an empty text gets the score of
a difference of 0; rows that repeat a doc_id are scored alike; labels that
contradict each other or are null are not learned; without labels of both
classes every score is the share of good labels (1 without any labels); an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, lowest_hashes, sliced, table

PER_CLASS = 3000
PIECE = 512
PIECES_PER_DOC = 32
DICT_BYTES = 256 * 1024
LEVEL = 3


@dataclass(frozen=True)
class CompressionModel:
    """Two dictionaries and the calibration curve (half a megabyte in all)."""

    good: bytes
    bad: bytes
    slope: float
    shift: float

    def scorer(self):
        make = lambda d: zstandard.ZstdCompressor(
            level=LEVEL, dict_data=_prepared(d), write_content_size=False, write_dict_id=False)
        if not self.good or not self.bad:
            return lambda text: 1 / (1 + np.exp(-self.shift))
        good, bad = make(self.good).compress, make(self.bad).compress

        def score(text: str | None) -> float:
            g = b = 0
            for piece in pieces(text):
                g += len(good(piece))
                b += len(bad(piece))
            x = (b - g) / (b + g) if b + g else 0.0
            return float(1 / (1 + np.exp(-np.clip(self.slope * x + self.shift, -40, 40))))

        return score


def _prepared(data: bytes) -> zstandard.ZstdCompressionDict:
    d = zstandard.ZstdCompressionDict(data)
    d.precompute_compress(level=LEVEL)
    return d


def pieces(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return [data[i:i + PIECE] for i in range(0, len(data), PIECE)]


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; with too little text to train one, the text itself."""
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to PIECES_PER_DOC evenly spread pieces of each text."""
    for batch in sliced(batches):
        out = []
        for text in batch.column(2).to_pylist():
            p = pieces(text)
            step = max(1, -(-len(p) // PIECES_PER_DOC))
            out.append(p[::step])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.binary()))], ["u", "quality", "pieces"])


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted one-variable logistic regression by Newton steps, lightly penalised."""
    scale = float(np.std(x)) or 1.0
    z = np.column_stack([x / scale, np.ones_like(x)])
    beta = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -40, 40)))
        grad = z.T @ (w * (p - y)) + 1e-2 * beta * [1, 0]
        hess = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> CompressionModel:
    """Model from the labelled documents; the caller leaves out what may not be learned."""
    clean = (labels.where("quality IN (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("_max"))
             .where("quality = _max AND doc_id IS NOT NULL"))
    counts = {r["quality"]: r["n"] for r in clean.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        share = (counts.get(1, 0) + 0.5) / (total + 1) if total else 0.999
        return CompressionModel(b"", b"", 0.0, float(np.log(share / (1 - share))))
    # at most 2 * per_class ids
    chosen = F.broadcast(lowest_hashes(clean.select("doc_id", "quality"), "quality", "doc_id", counts, per_class)
                         .select("doc_id", "quality"))
    sample = (docs.join(chosen, "doc_id")
              .select(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("part")), F.lit(3)).cast("int").alias("u"),
                      F.col("quality").cast("int").alias("quality"), F.col("text").cast("string").alias("text"))
              .mapInArrow(_spread, "u int, quality int, pieces array<binary>"))
    rows = sorted((r["quality"], r["u"], [bytes(p) for p in r["pieces"]]) for r in sample.collect())
    learn = {q: [p for c, u, ps in rows if c == q and u != 0 for p in ps] for q in (0, 1)}
    model = CompressionModel(_dictionary(learn[1]), _dictionary(learn[0]), 1.0, 0.0)
    rest = [(q, b"".join(ps)) for q, u, ps in rows if u == 0 and ps]
    if len({q for q, _ in rest}) < 2:
        rest = [(q, b"".join(ps)) for q, _, ps in rows if ps]
    if not model.good or not model.bad or len({q for q, _ in rest}) < 2:
        share = counts[1] / total
        return CompressionModel(b"", b"", 0.0, float(np.log(share / (1 - share))))
    good, bad = (zstandard.ZstdCompressor(level=LEVEL, dict_data=_prepared(d), write_content_size=False, write_dict_id=False)
                 for d in (model.good, model.bad))
    x = np.empty(len(rest))
    for i, (_, data) in enumerate(rest):
        cut = [data[k:k + PIECE] for k in range(0, len(data), PIECE)]
        g, b = (sum(len(c.compress(p)) for p in cut) for c in (good, bad))
        x[i] = (b - g) / (b + g)
    y = np.array([q for q, _ in rest], float)
    n = np.array([(y == 0).sum(), (y == 1).sum()], float)
    w = np.where(y == 1, counts[1] / total / n[1], counts[0] / total / n[0]) * len(y)
    slope, shift = _logistic(x, y, w)
    return CompressionModel(model.good, model.bad, slope, shift)


def score(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """doc_id, score, predicted for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch in sliced(batches):
            s = np.array([of(t) for t in batch.column(1).to_pylist()], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """``docs`` without the rejected rows, all columns as they were (no shuffle)."""
    schema = docs.schema
    at = [i for i, c in enumerate(docs.columns) if c == "text"][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch in sliced(batches):
            yield batch.filter(pa.array([of(t) >= 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, schema)


def fit_on_labels(spark: SparkSession, docs: DataFrame, sf_dir: str) -> CompressionModel:
    """Fit on the labelled rows of ``docs`` outside the held-out third."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", "quality")
    return fit(docs.select("doc_id", "text"), labels)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_on_labels(spark, docs, sf_dir)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
