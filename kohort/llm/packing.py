"""Best-two-fit packing of token sequences (operator 1).

Documents are tokenised, end with a separator id and are cut into pieces of
at most ``size`` tokens (only documents longer than that are cut; the first
piece takes the rest, so all others are full).  For the packing a piece is
only its length, so the whole input is described exactly by the number of
pieces of each length: at most ``size`` numbers, however many documents.

The plan is made from those numbers: fill a sequence greedily with the
longest piece that still fits; then take out its shortest piece and, if two
unpacked pieces fill the gap that this leaves more tightly, put those in.
A sequential run would choose the same lengths again until one of them is
used up, so each filling is used as often as its lengths last, and the plan
has a few thousand rows at most.

The pieces of each length are numbered (in chunks, so no task holds all
pieces of a length) and the number decides the sequence and the place.

Defined cases: null text counts as empty and is one piece with the
separator only; rows that repeat a doc_id are packed one by one; ties between
pieces of a length go by a hash of doc_id and piece; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import LEAF_CHARS, load
from .common import free_name, number_rows, shared_table, table, tokenizer_path

SIZE = 1024
SEPARATOR = 2
#: chunks per length when pieces are numbered
CHUNKS = 1024


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, end, first_sequence, offset, each) from pieces per length.

    Pieces ``first .. end-1`` of a length go to consecutive sequences from
    ``first_sequence`` on, ``each`` of them side by side from ``offset``.
    """
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        if not 1 <= length <= size:
            raise ValueError(f"length {length} outside 1..{size}")
        left[length] = n
    used = np.zeros(size + 1, np.int64)
    rows, sequence = [], 0
    while True:
        free = np.flatnonzero(left)
        if not len(free):
            return rows
        have, gap, filling = left.copy(), size, []
        while True:
            k = np.searchsorted(free, gap, "right") - 1
            while k >= 0 and not have[free[k]]:
                k -= 1
            if k < 0:
                break
            take = int(min(have[free[k]], gap // free[k]))
            filling += [int(free[k])] * take
            have[free[k]] -= take
            gap -= take * int(free[k])
        if gap:
            pair = _tighter_pair(have, filling[-1], gap + filling[-1])
            if pair:
                filling[-1:] = pair
        need: dict[int, int] = {}
        for length in filling:
            need[length] = need.get(length, 0) + 1
        times = int(min(left[length] // n for length, n in need.items()))
        offset = 0
        for length, n in need.items():
            rows.append((length, int(used[length]), int(used[length]) + times * n, sequence, offset, n))
            used[length] += times * n
            left[length] -= times * n
            offset += n * length
        sequence += times


def _tighter_pair(have: np.ndarray, smallest: int, room: int) -> list[int] | None:
    """The two unpacked lengths with the largest sum in ``smallest+1 .. room``."""
    free = np.flatnonzero(have)
    free = free[free < room]
    if not len(free):
        return None
    at = np.searchsorted(free, room - free, "right") - 1  # best partner of each
    ok = at >= 0
    same = ok & (at == np.arange(len(free))) & (have[free] < 2)
    at = np.where(same, at - 1, at)
    ok &= at >= 0
    if not ok.any():
        return None
    total = np.where(ok, free + free[np.maximum(at, 0)], 0)
    k = int(total.argmax())
    if total[k] <= smallest:
        return None
    return sorted((int(free[k]), int(free[at[k]])), reverse=True)


def cut_pieces(docs: DataFrame, path: str | None = None, size: int = SIZE, separator: int = SEPARATOR,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (unsigned 32-bit little-endian), one row per piece."""
    path = path or tokenizer_path()
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = enc.piece(text or "") if len(text or "") <= LEAF_CHARS else enc.encode(text)
                    ids = np.append(ids, separator).astype("<u4")
                    first = len(ids) % size or size
                    limits = [0, *range(first, len(ids) + 1, size)]
                    out += [(doc, p, a, b - a, ids[a:b].tobytes()) for p, (a, b) in enumerate(zip(limits, limits[1:]))]
                cols = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                    ["doc_id", "piece", "start", "length", "ids"])

    return src.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def place(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` (with doc_id, piece, length) with ``sequence_id`` and ``offset``.

    ``pieces`` is read twice and should be a written table.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    nth, length, first, end, sequence, offset, each = (
        free_name(pieces, x) for x in ("_nth", "_length", "_first", "_end", "_sequence", "_offset", "_each"))
    slots = spark.createDataFrame(
        plan(counts, size) or [(0, 0, 0, 0, 0, 1)],
        ", ".join(f"`{c}` long" for c in (length, first, end, sequence, offset, each)))
    h = F.xxhash64(F.col("doc_id"), F.col("piece"))
    numbered = number_rows(pieces, "length", F.pmod(h, F.lit(CHUNKS)).cast("int"), [h, F.col("doc_id")], nth)
    # a few thousand rows, whatever the input: see plan()
    at = numbered.join(F.broadcast(slots), (F.col("length") == F.col(length))
                       & (F.col(nth) >= F.col(first)) & (F.col(nth) < F.col(end)))
    k = F.col(nth) - F.col(first)
    return (at.withColumn("sequence_id", F.col(sequence) + F.expr(f"(`{nth}` - `{first}`) div `{each}`"))
            .withColumn("offset", F.col(offset) + (k % F.col(each)) * F.col("length"))
            .drop(nth, length, first, end, sequence, offset, each))


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids (binary, pieces in order) of every packed sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (placed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id",
                    F.aggregate("parts", F.lit(0), lambda n, p: n + F.octet_length(p["ids"]), lambda n: n / 4).cast("long").alias("n_tokens"),
                    F.aggregate("parts", F.unhex(F.lit("")), lambda b, p: F.concat(b, p["ids"])).alias("ids")))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """The contract's columns for every piece of ``docs``."""
    narrow = cut_pieces(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return place(shared_table(narrow, "pieces")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
