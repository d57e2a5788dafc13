"""Cross-tokenizer alignment by whitespace-token anchors (operator 11).

Every text is tokenised whole by two vocabularies: A, byte-level merges over
space + text, and B, pieces with byte fallback, which puts that space there
itself.  Special tokens' strings inside a text are plain text.

1. *Anchors*: byte offsets at which a token of A and a token of B end and the
   next token of each begins with a space.  They are verified on the two
   offset lists, never assumed.
2. *Windows*: the anchors cut the ids of a text into pairs of short id
   tuples.  A window's groups and links depend on its ids alone, so they are
   worked out once and kept by id tuple; a worker keeps a bounded number of
   tokens of them, and forgets all when that is full.
3. *Groups* end where tokens of A and of B end together; the last two tokens
   of a group form its link.
4. *Counts*: links are folded per document and per block of documents, then
   summed over the corpus.  A block holds a bounded number of folded links
   (or one document), and only the counts of its own id pairs are sent back
   to it, so one task holds neither all documents nor all pairs.

Defined cases: a null or empty text, or one whose joined tokens of A or B do
not give space + text, has no tokens, groups or links; very long texts are
tokenised whole; rows that repeat a doc_id or are wholly equal count each; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Encoder
from .common import shared_table, sliced, table, tokenizer_path

PIECE_FILE = "piece_bpe_32k.model"
#: tokens of remembered windows in one worker
MEMO_TOKENS = 4_000_000
#: folded links of a block of documents
BLOCK_LINKS = 1 << 18
_SHIFT = 32
_SPACE = "▁"  # how pieces show a space


def piece_path() -> str:
    """Default place of B's vocabulary."""
    import public_tokenizers

    return str(public_tokenizers.path(PIECE_FILE))


def piece_bytes(processor: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes that each id of B stands for."""
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces)]


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    n = end - start
    return np.arange(n.sum()) + np.repeat(start - np.cumsum(n) + n, n)


class _Side:
    """Byte lengths and leading spaces of a vocabulary's tokens."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.spaced = np.array([t[:1] == b" " for t in tokens])
        #: decimal ids with the sign that follows them: inside a group, at its end in A, at its end in B
        self.names = {mark: np.array([f"{i}{mark}" for i in range(len(tokens))], object) for mark in ",|;"}

    def spells(self, ids: np.ndarray, raw: np.ndarray) -> bool:
        """Whether the tokens' bytes, one after the other, are ``raw``."""
        begin = self.begin[ids]
        return np.array_equal(self.flat[_ranges(begin, begin + self.length[ids])], raw)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.length[ids])

    def anchors(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ends that stand before a token with a leading space."""
        return ends[:-1][self.spaced[ids[1:]]]


class Aligner:
    """Both tokenizers and the remembered windows of a worker process."""

    def __init__(self, path_a: str, path_b: str, memo_tokens: int = MEMO_TOKENS) -> None:
        self.core = Encoder(path_a).core
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a = _Side([self._token(i) for i in range(self.core.n_vocab)])
        self.b = _Side(piece_bytes(self.pieces))
        self.memo_tokens = memo_tokens
        self._forget()

    def _token(self, i: int) -> bytes:
        try:
            return self.core.decode_single_token_bytes(i)
        except KeyError:  # an unused id
            return b""

    def _forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.links, self.first, self.held = array("q"), array("q", [0]), 0

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and B; none where they do not spell space + text."""
        none = np.empty(0, np.uint32)
        if not text:
            return none, none
        a = self.core.encode_to_numpy(" " + text, allowed_special=set(), disallowed_special=()).astype(np.uint32)
        b = np.array(self.pieces.encode(text), np.uint32)
        raw = np.frombuffer((" " + text).encode(), np.uint8)
        # A's tokens are stretches of the text's bytes, one after the other: their number tells whether any is missing
        if self.a.length[a].sum() != len(raw) or not self.b.spells(b, raw):
            return none, none
        return a, b

    def _align_windows(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, new: np.ndarray) -> None:
        """Align the windows (token ranges in A and B) that are met for the first time.

        Notes the groups of each as text and its links as id pairs.
        """
        p, i, q, j = new.T
        in_a, in_b = _ranges(p, i), _ranges(q, j)
        a, b = a[in_a], b[in_b]
        # the last tokens of the groups
        _, last_a, last_b = np.intersect1d(ends_a[in_a], ends_b[in_b], assume_unique=True, return_indices=True)
        # places in the text: a group's tokens of A, then its tokens of B
        before_a = np.concatenate([[0], last_b + 1])[np.searchsorted(last_a, np.arange(len(a)))]
        before_b = (last_a + 1)[np.searchsorted(last_b, np.arange(len(b)))]
        words = np.empty(len(a) + len(b), object)
        for side, ids, last, at, mark in ((self.a, a, last_a, before_a, "|"), (self.b, b, last_b, before_b, ";")):
            text = side.names[","][ids]
            text[last] = side.names[mark][ids[last]]
            words[np.arange(len(ids)) + at] = text
        words, edge = words.tolist(), 0
        for end in np.cumsum(i - p + j - q).tolist():
            self.texts.append("".join(words[edge:end])[:-1])
            edge = end
        self.links.extend((a[last_a].astype(np.int64) << _SHIFT | b[last_b]).tolist())
        links = np.searchsorted(last_a, np.cumsum(i - p) - 1, side="right")  # up to the end of each window
        self.first.extend((links + self.first[-1]).tolist())
        self.held += len(a) + len(b)

    def align(self, text: str | None) -> tuple[int, int, str, np.ndarray]:
        """Number of tokens of A and of B, groups as text, links (id of A << 32 | id of B)."""
        a, b = self.tokens(text)
        if not len(a):
            return 0, 0, "", np.empty(0, np.int64)
        if self.held > self.memo_tokens:
            self._forget()
        ends_a, ends_b = self.a.ends(a), self.b.ends(b)
        cut = np.intersect1d(self.a.anchors(a, ends_a), self.b.anchors(b, ends_b), assume_unique=True)
        to_a = (4 * np.append(np.searchsorted(ends_a, cut) + 1, len(a))).tolist()
        to_b = (4 * np.append(np.searchsorted(ends_b, cut) + 1, len(b))).tolist()
        # a window's id tuple, packed: ids of A, then ids of B above them
        ids_a, ids_b, memo = a.tobytes(), (b + np.uint32(len(self.a.tokens))).tobytes(), self.memo
        places = list(zip([0, *to_a], to_a, [0, *to_b], to_b))
        keys = [ids_a[p:i] + ids_b[q:j] for p, i, q, j in places]
        windows, new = list(map(memo.get, keys)), []
        if None in windows:
            for k, key in enumerate(keys):
                if windows[k] is None:
                    if key not in memo:
                        memo[key] = len(memo)
                        new.append(places[k])
                    windows[k] = memo[key]
            self._align_windows(a, b, ends_a, ends_b, np.array(new) // 4)
        at = np.array(windows)
        first = np.frombuffer(self.first, np.int64)
        links = np.frombuffer(self.links, np.int64)[_ranges(first[at], first[at + 1])]
        del first  # the arrays can grow again
        return len(a), len(b), ";".join(map(self.texts.__getitem__, windows)), links


@lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Aligner:
    """The aligner of a worker process."""
    return Aligner(path_a, path_b)


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
          id_col: str = "doc_id", text_col: str = "text", block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row per document: doc_id, block, n_a, n_b, n_links, groups, pairs, times.

    ``groups`` is the alignment, decimal ids as ``a1,a2|b1;a3|b2,b3``;
    ``pairs`` are its different links (id of A << 32 | id of B), ``times`` how
    often each stands in the document.  Write the result before ``block`` is
    used: it numbers the rows as they came.
    """
    path_a, path_b = path_a or tokenizer_path(), path_b or piece_path()
    names = ["doc_id", "block", "n_a", "n_b", "n_links", "groups", "pairs", "times"]
    kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, held = load(path_a, path_b), 0
        block = TaskContext.get().partitionId() << 32
        for part in sliced(batches, 64):
            rows = []
            for doc, text in zip(*(c.to_pylist() for c in part.columns)):
                n_a, n_b, groups, links = aligner.align(text)
                pairs, times = np.unique(links, return_counts=True)
                if held and held + len(pairs) > block_links:
                    block, held = block + 1, 0
                held += len(pairs)
                rows.append((doc, block, n_a, n_b, len(links), groups, pairs, times.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, block long, n_a long, n_b long, n_links long, groups string, "
                             "pairs array<long>, times array<int>"))


def block_links(aligned: DataFrame) -> DataFrame:
    """block, pair, n: links of each block of documents, folded."""
    each = aligned.select("block", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    return each.groupBy("block", F.col("x.pairs").alias("pair")).agg(F.sum(F.col("x.times").cast("long")).alias("n"))


def pair_counts(folded: DataFrame) -> DataFrame:
    """pair, id_a, id_b, links (over the corpus), best (no pair of that id of B has more)."""
    counts = (folded.groupBy("pair").agg(F.sum("n").alias("links"))
              .withColumn("id_a", F.shiftright("pair", _SHIFT).cast("int"))
              .withColumn("id_b", F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1)).cast("int")))
    # one row per id of B: at most the size of its vocabulary
    most = F.broadcast(counts.groupBy("id_b").agg(F.max("links").alias("most")))
    return counts.join(most, "id_b").select("pair", "id_a", "id_b", "links", (F.col("links") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame, folded: DataFrame) -> DataFrame:
    """``aligned`` (written) without its lists, with n_best and count_sum of every document."""
    known = folded.select("block", "pair").join(pair_counts(folded).select("pair", "links", "best"), "pair")
    kept = [c for c in aligned.columns if c not in ("block", "pairs", "times")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema if f.name in kept)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        pair, links, best = (right.column(c).to_numpy() for c in ("pair", "links", "best"))
        order = np.argsort(pair)
        lists = left.column("pairs").combine_chunks()
        flat, edge = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        at = order[np.searchsorted(pair, flat, sorter=order)] if len(flat) else np.empty(0, np.int64)
        times = left.column("times").combine_chunks().values.to_numpy(zero_copy_only=False).astype(np.int64)
        out = left.select(kept)
        for name, value in (("n_best", times * best[at].astype(np.int64)), ("count_sum", times * links[at])):
            total = np.concatenate([[0], np.cumsum(value)])
            out = out.append_column(name, pa.array(total[edge[1:]] - total[edge[:-1]], pa.int64()))
        return out

    return (aligned.groupBy("block").cogroup(known.groupBy("block"))
            .applyInArrow(score, schema + ", n_best long, count_sum long"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    aligned = shared_table(
        align(table(spark, sf_dir, "documents")).select(
            "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", digest, "block", "pairs", "times"),
        "aligned")
    folded = shared_table(block_links(aligned), "aligned-links")
    return link_scores(aligned, folded).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
