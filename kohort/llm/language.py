"""Language identification with string kernels (operator 3).

The kernel is the blended-spectrum presence kernel: the number of different
n-grams (1 to 4 bytes of the lower-cased letters) that two texts share,
divided by the geometric mean of their own numbers.  Nystroem landmarks
span the feature space and one ridge regression per language is fitted
against all others in it.

A score is ``K(x, landmarks) @ alpha``, a product of a batch's kernel matrix
and the weights of all languages.  The kernel is an inner product of presence
vectors, so for up to ``LANG_BLOCK`` languages the product is associated the
other way round: ``X @ (landmarks.T @ alpha)``, with one row of folded weights
per n-gram, and a batch of texts is one sparse presence matrix.

Fitting reads at most ``per_lang`` texts of each language (lowest hash of
the id first).  At most ``LANDMARKS`` of them, dealt over the languages in
turn, are landmarks; n-grams are hashed to ``2 ** BITS`` columns.  The normal
equations are summed in the tasks that hold the sample, by language.  What
reaches the driver and the workers are the landmarks, one matrix of landmarks
by landmarks, and one weight per landmark (4 kB) for each language, so any
number of language values can be learned.  Scoring reads whole texts.

Defined cases: null text, or one without a letter: ``und`` with score 0; null
languages are not learned; without anything to learn from every text is
``und``; equal outputs: the first language in alphabetical order; repeated
rows are scored alike; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import held_out, shared_table, sliced, table

PER_LANG = 300
LANDMARKS_PER_LANG = 60
#: landmarks of all languages together
LANDMARKS = 512
#: languages for which weights per n-gram are kept (2 MB each)
LANG_BLOCK = 64
NGRAMS = (1, 2, 3, 4)
BITS = 19
RIDGE = 1e-2
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")
_BLOCK = 1 << 20


def presence(text: str | None) -> np.ndarray:
    """Sorted columns of the text's n-grams; empty without a letter."""
    letters = _OTHER.sub(" ", (text or "").lower())
    if not any(map(str.isalpha, letters)):
        return np.empty(0, np.int32)
    data = np.frombuffer(f" {letters.strip()} ".encode("utf-8", "surrogatepass"), np.uint8)
    found = []
    for at in range(0, len(data), _BLOCK):  # bounds the memory of a very long text
        b = data[at:at + _BLOCK + max(NGRAMS) - 1].astype(np.uint32)
        code = np.zeros(len(b), np.uint32)
        for n in range(1, max(NGRAMS) + 1):
            if len(b) < n:
                break
            code = (code[:len(b) - n + 1] << np.uint32(8)) | b[n - 1:]
            if n in NGRAMS:
                h = (code ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                found.append(((h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS))
    codes = np.sort(np.concatenate(found)).astype(np.int32)
    return codes[np.concatenate([[True], codes[1:] != codes[:-1]])]


class KernelModel:
    """Languages, landmarks (columns of their n-grams) and weights (landmarks x languages)."""

    def __init__(self, langs: tuple[str, ...], marks: list[np.ndarray], alpha: np.ndarray) -> None:
        self.langs, self.marks, self.alpha = langs, marks, alpha
        self._folded: np.ndarray | None = None

    def __getstate__(self) -> tuple:
        return self.langs, self.marks, self.alpha

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def _scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """``K(rows, landmarks) @ alpha``."""
        if len(self.langs) > LANG_BLOCK:
            return _kernel(rows, self.marks) @ self.alpha
        if self._folded is None:  # once in a worker
            self._folded = np.zeros((1 << BITS, len(self.langs)), np.float32)
            for grams, row in zip(self.marks, self.alpha):
                self._folded[grams] += row / np.sqrt(len(grams))
        sizes = np.array([len(r) for r in rows])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.add.reduceat(self._folded[np.concatenate(rows)], starts, axis=0) / np.sqrt(sizes)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        rows = [presence(t) for t in texts]
        names, score = [UNKNOWN] * len(rows), np.zeros(len(rows))
        some = [i for i, r in enumerate(rows) if len(r)] if self.langs else []
        if some:
            out = self._scores([rows[i] for i in some])
            share = np.clip((1 + out) / 2, 1e-6, 1)
            best = out.argmax(axis=1)
            score[some] = share[np.arange(len(some)), best] / share.sum(axis=1)
            for i, k in zip(some, best):
                names[i] = self.langs[k]
        return names, score


def _kernel(rows: list[np.ndarray], landmarks: list[np.ndarray]) -> np.ndarray:
    codes = np.concatenate(rows)
    sizes = np.array([len(r) for r in rows])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flags = np.zeros(1 << BITS, np.float32)
    out = np.empty((len(rows), len(landmarks)))
    for j, mark in enumerate(landmarks):
        flags[mark] = 1
        out[:, j] = np.add.reduceat(flags[codes], starts) / np.sqrt(sizes * len(mark))
        flags[mark] = 0
    return out


def _presence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        grams = [presence(t) for t in batch.column(2).to_pylist()]
        part = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(grams, pa.list_(pa.int32()))], ["lang", "u", "grams"])
        yield part.filter(pa.array([len(g) > 0 for g in grams], pa.bool_()))


def _sample(known: DataFrame, per_lang: int) -> DataFrame:
    """lang, u, grams, place, n: up to ``per_lang`` texts of each language with a letter, by rising hash of the id."""
    u = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") / float(1 << 53)
    # written: their sizes are known, so that Spark sends them to the rows where they are small
    sizes = shared_table(known.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("_n")), "language-sizes")
    # a limit that some 2 per_lang rows of a language pass: no task ranks more
    near = (known.select("doc_id", "lang").join(sizes, F.col("lang") == F.col("_lang")).withColumn("u", u)
            .where(F.col("u") * F.col("_n") < 2 * per_lang + 20).dropDuplicates(["doc_id", "lang"]))
    order = Window.partitionBy("lang").orderBy("u", "doc_id")
    ids = near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= per_lang)
    ids = shared_table(ids.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), "u"), "language-ids")
    some = known.join(ids, (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))
    rows = some.select("lang", "u", F.col("text").cast("string").alias("text")).mapInArrow(_presence_rows, "lang string, u double, grams array<int>")
    of = Window.partitionBy("lang")
    return shared_table(rows.withColumn("place", F.row_number().over(of.orderBy("u"))).withColumn("n", F.count(F.lit(1)).over(of)),
                        "language-sample")


_SUMS = "lang string, i int, sums array<double>"


def _sum_rows(lang: list, i: list, sums: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(i, pa.int32()), pa.array(sums, pa.list_(pa.float64()))],
                                      ["lang", "i", "sums"])


def _sums(shared):
    """Sample rows in; out: per language the mean kernel row, and the rows of the sum of products (weight 1 / n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        products, means = np.zeros((len(marks), len(marks))), {}
        for batch in sliced(batches):
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            k = _kernel([flat[at[j]:at[j + 1]] for j in range(len(lists))], marks)
            w = 1 / batch.column(2).to_numpy()[:, None]
            products += k.T @ (k * w)
            for lang, row in zip(batch.column(0).to_pylist(), k * w):
                means[lang] = means[lang] + row if lang in means else row
        for lang, row in means.items():
            yield _sum_rows([lang], [-1], [row])
        if means:
            for i, row in enumerate(products):
                yield _sum_rows([None], [i], [row])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for lang, i, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            sums = sums.values.to_numpy()
            total[lang, i] = total[lang, i] + sums if (lang, i) in total else sums.copy()
    for (lang, i), sums in total.items():
        yield _sum_rows([lang], [i], [sums])


def fit(docs: DataFrame, per_lang: int = PER_LANG, landmarks_per_lang: int = LANDMARKS_PER_LANG,
        ridge: float = RIDGE) -> KernelModel:
    """Model from doc_id, text and lang of ``docs``; each language weighs the same, however many texts it has."""
    spark = docs.sparkSession
    sample = _sample(docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL"), per_lang)
    chosen = sample.where(F.col("place") <= landmarks_per_lang).orderBy("place", "lang").limit(LANDMARKS).collect()
    if not chosen:
        return KernelModel((), [], np.zeros((0, 0), np.float32))
    chosen.sort(key=lambda r: (r["lang"], r["u"]))
    marks = [np.array(r["grams"], np.int32) for r in chosen]
    shared = spark.sparkContext.broadcast(marks)  # at most LANDMARKS presence vectors
    parts = sample.select("lang", "grams", "n").repartition(16, "lang").mapInArrow(_sums(shared), _SUMS)
    found = parts.repartition("lang", "i").mapInArrow(_add, _SUMS).collect()  # LANDMARKS rows, and one per language
    means = {r["lang"]: np.array(r["sums"]) for r in found if r["i"] < 0}
    products = np.array([r["sums"] for r in sorted((r for r in found if r["i"] >= 0), key=lambda r: r["i"])])
    langs = tuple(sorted(means))
    # every language has the weight of one row: sums of a language's rows are its mean
    own = np.array([means[lang] for lang in langs]).T
    a = products + ridge * len(langs) * _kernel(marks, marks) / len(marks) + 1e-6 * np.eye(len(marks))
    b = 2 * own - own.sum(axis=1, keepdims=True)  # 1 for the language, -1 for all others
    return KernelModel(langs, marks, np.linalg.solve(a, b).astype(np.float32))


def predict(docs: DataFrame, model: KernelModel) -> DataFrame:
    """doc_id, lang_pred, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks, and one weight for each per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                names, score = m.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "lang_pred", "score"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
