"""Byte-level BPE encoding and decoding (operator 7).

The ids are those of the ``tokenizers`` library for the same vocabulary file
(no normaliser, byte-level pre-tokeniser, special tokens recognised in the
text).  The file's vocabulary and merges are read as merge ranks and applied
with ``tiktoken``, which gives the same ids about four times as fast; a file
for which that is not so (see ``load``) is refused.

Long text is encoded by *tree concatenation*: it is cut into leaves,
whatever stands at the cuts (a single unbroken word may be longer than
many leaves), the leaves are encoded in parallel as rows of their own, and
neighbours are joined pairwise, level by level.  A join re-encodes a window
around the cut that starts and ends at token limits of the two sides, and
grows it until the new tokens agree with the left side's tokens at the left
end and with the right side's at the right end.  What lies outside the
window is then unchanged, because byte-pair merges only depend on adjacent
tokens.

Defined cases: null text counts as empty (no ids); very long texts as above;
rows that repeat a doc_id or are wholly equal are encoded once each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, tokenizer_path

#: fixed value: the pre-tokeniser's pattern for this kind of vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF_CHARS = 32_768
#: tokens that must agree on each side of a join
AGREE = 8


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies print every byte as one character: printable ones
    as themselves, the others from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _plain(spec: dict) -> bool:
    """Whether a vocabulary file asks for nothing that is not done here."""
    cut, model, decoder = spec["pre_tokenizer"] or {}, spec["model"], spec.get("decoder") or {}
    flags = ("single_word", "lstrip", "rstrip", "normalized")
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    return (not spec.get("normalizer") and not spec.get("post_processor") and model.get("type") == "BPE"
            and cut.get("type") == decoder.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
            and not any(model.get(x) for x in options) and not any(t.get(x) for t in spec["added_tokens"] for x in flags))


class Encoder:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        if not _plain(spec) or len(plain) != 256 + len(merges) \
                or any(plain[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
            raise ValueError(f"{path}: not a byte-level vocabulary whose ids follow its merges")
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in t): i for t, i in plain.items()}
        self.core = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def piece(self, text: str) -> np.ndarray:
        """Ids of a text, in one go."""
        return self.core.encode_to_numpy(text, allowed_special="all").astype(np.int32)

    def bytes(self, ids: np.ndarray) -> bytes:
        return self.core.decode_bytes(ids.tolist())

    def decode(self, ids: np.ndarray) -> str:
        return self.bytes(ids).decode("utf-8", errors="replace")

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the text of ``left`` followed by that of ``right``."""
        if not len(left) or not len(right):
            return np.concatenate([left, right])
        k = 2 * AGREE
        while True:
            i, j = max(0, len(left) - k), min(len(right), k)
            while i and self._inside(left[i]):  # the window holds whole characters
                i -= 1
            while j < len(right) and self._inside(right[j]):
                j += 1
            window = self.piece((self.bytes(left[i:]) + self.bytes(right[:j])).decode("utf-8"))
            a, b = left[i:], right[:j]
            starts = i == 0 or len(window) >= AGREE and len(a) >= AGREE and np.array_equal(window[:AGREE], a[:AGREE])
            ends = j == len(right) or len(window) >= AGREE and len(b) >= AGREE and np.array_equal(window[-AGREE:], b[-AGREE:])
            if starts and ends and (len(window) >= 2 * AGREE or i == 0 and j == len(right)):
                return np.concatenate([left[:i], window, right[j:]])
            k *= 2

    def _inside(self, token: int) -> bool:
        """Whether a token starts in the middle of a character."""
        return 0x80 <= self.core.decode_single_token_bytes(int(token))[0] < 0xC0

    def join_all(self, leaves: list[np.ndarray]) -> np.ndarray:
        """Pairwise joins, level by level."""
        while len(leaves) > 1:
            paired = [self.join(*leaves[k:k + 2]) for k in range(0, len(leaves) - 1, 2)]
            leaves = paired + leaves[2 * len(paired):]
        return leaves[0] if leaves else np.empty(0, np.int32)

    def encode(self, text: str | None, leaf: int = LEAF_CHARS) -> np.ndarray:
        """Ids of one text in one place, by the same tree."""
        text = text or ""
        return self.join_all([self.piece(text[k:k + leaf]) for k in range(0, len(text), leaf)])


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    """The encoder of a worker process."""
    return Encoder(path)


def id_lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    at, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [flat[at[i]:at[i + 1]] for i in range(len(column))]


def encode(docs: DataFrame, path: str | None = None, leaf: int = LEAF_CHARS,
           id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id, ids (array of int) for every row; with ``decoded`` also the text of the ids."""
    path = path or tokenizer_path()
    names = ["doc_id", "ids", "text"] if decoded else ["doc_id", "ids"]
    schema = "doc_id long, ids array<int>" + (", text string" if decoded else "")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = F.char_length("text")

    def rows(enc: Encoder, ids: pa.Array, coded: list[np.ndarray]) -> pa.RecordBatch:
        columns = [ids, id_lists(coded)]
        if decoded:
            columns.append(pa.array([enc.decode(c) for c in coded], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield rows(enc, part.column(0), [enc.piece(t) for t in part.column(1).to_pylist()])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], id_lists([enc.piece(t) for t in part.column(3).to_pylist()])],
                    ["doc_id", "sha", "leaf", "ids"])

    def joined(key, group):  # pa.Table in and out
        enc = load(path)
        group = group.sort_by("leaf").combine_chunks()
        order = group.column("leaf").to_numpy()
        copies = int((order == 0).sum())  # wholly equal rows: each leaf comes that often
        ids = enc.join_all(_lists(group.column("ids").combine_chunks())[::copies])
        doc = pa.array([group.column("doc_id")[0].as_py()] * copies, pa.int64())
        return pa.Table.from_batches([rows(enc, doc, [ids] * copies)])

    short = src.where(n <= leaf).mapInArrow(whole, schema)
    starts = F.sequence(F.lit(0), F.ceil(n / leaf).cast("int") - 1)
    long = (src.where(n > leaf)
            .select("doc_id", F.sha2("text", 256).alias("sha"),
                    F.posexplode(F.transform(starts, lambda k: F.substring(F.col("text"), k * leaf + 1, F.lit(leaf)))).alias("leaf", "text"))
            .repartition("doc_id", "sha", "leaf")
            .mapInArrow(leaves, "doc_id long, sha string, leaf int, ids array<int>")
            # the leaves of one document: as large as the document itself
            .groupBy("doc_id", "sha").applyInArrow(joined, schema))
    return short.unionByName(long)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` with the decoded ``text``."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [enc.decode(ids) for ids in _lists(part.column(1))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents"), decoded=True)  # one Python worker for both
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
