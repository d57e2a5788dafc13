"""N-gram Jaccard join with signature trees (operator 10).

Documents are sets of word shingles; two are linked when their Jaccard
similarity reaches a threshold.  No link is lost:

1. *Census*: one pass counts shingles that many documents share (they come
   last in the global shingle order; any fixed order gives the same links)
   and the blocks that are too large for one task.
2. *Blocks*: documents are dealt by their smallest shingle hash.  A block's
   documents form a signature tree: leaves hold documents, inner nodes the OR
   of the token bitmaps below them and the range of set sizes.  A dual
   traversal compares the tree with itself and leaves out node pairs whose
   largest possible overlap is too small; pairs that remain, and are not yet
   connected, are tested on their shingle sets.  Large blocks are dealt over
   several tasks, each of which also gets one document of the block (its
   pivot), so copies of one text stay connected.
3. *Prefixes*: similar sets share one of their first ``n - ceil(t n) + 1``
   shingles.  These are dealt by shingle; two documents that meet there, are
   not yet connected, and whose sizes and places in the order allow the
   overlap, are tested on their texts.  This finds every link between blocks.
   First each class of connected documents is tested with one document
   against the largest class it meets, which connects the classes of large
   groups; then all pairs that are still between different classes.  There
   an entry's place bounds the size of any partner, so only pairs that fit are
   visited, and entries that fit nothing are left out; the entries of a common
   shingle are dealt by size band and in blocks over tasks, every pair of
   blocks in one of them.
4. *Components* of all links, by joins.

Sets are compared by 64-bit shingle hashes.

Defined cases: null, empty or blank text: empty set, linked with nothing;
fewer words than a shingle: the whole sequence is the one shingle; rows with
a null doc_id are linked with nothing and their component is null; rows that
repeat a doc_id are one node that has the links of all of them; equal sets
are linked; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_table, sliced, table
from .components import components
from .shingles import shingles

WORDS = 4
PERCENT = 85
#: documents of a block in one task's memory; larger blocks are dealt over more tasks
BLOCK = 2048
MAX_SALTS = 1024
#: lengths of the two census lists; they only change the order of the work
COMMON_SHINGLES = 200_000
COMMON_SHARE = 100_000  # a shingle is common when more than one document in so many has it
LARGE_BLOCKS = 100_000
#: entries of a shingle in one task; of more, blocks of some DEAL entries meet pair by pair
MEET = 16_384
DEAL = 4096
#: keys that an entry carries of those before it in its document.  A pair that meets under one of them
#: is left to it; what comes up again in spite of that is dropped as a repeated pair.  So an entry has a
#: bounded size, and similar texts, which share nearly all of their first keys, still come up once.
EARLIER = 32
LEAF_DOCS = 16
FANOUT = 8
CARRY = 256
_CENSUS_FLUSH = 4_000_000


@dataclass(frozen=True)
class Census:
    common: np.ndarray            # sorted shingle hashes shared by many documents
    large: dict[int, tuple[int, int]]  # smallest hash -> (number of tasks, pivot's doc_id)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct hashes."""
    both = len(x) + len(y)
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (both - shared)


def prefix(grams: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles in the global order: rare ones by hash, then common ones by hash."""
    n = len(grams)
    if len(common):
        at = np.searchsorted(common, grams)
        at[at == len(common)] = 0
        often = common[at] == grams
        grams = np.concatenate([grams[~often], grams[often]])
    return grams[:n + (-percent * n // 100) + 1]


# --- signature tree -------------------------------------------------------

class SignatureTree:
    """Bitmaps and size ranges of a block's documents, level by level."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.size = np.array([len(s) for s in sets])
        # neighbours in the leaves: similar size, then similar smallest hashes
        self.order = np.lexsort((np.array([s[min(1, len(s) - 1)] for s in sets]), self.size))
        bits = 64
        while bits < 65_536 and bits < 2 * np.median(self.size):
            bits *= 2
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for row, i in enumerate(self.order):
            bit = sets[i] >> np.uint64(64 - (bits.bit_length() - 1))
            np.bitwise_or.at(maps[row], (bit >> np.uint64(6)).astype(np.intp), np.uint64(1) << (bit & np.uint64(63)))
        size = self.size[self.order]
        # a level: (bitmaps, fewest bits set by a document, smallest size, largest size)
        self.levels = [(maps, np.bitwise_count(maps).sum(axis=1).astype(np.int64), size, size)]
        step = LEAF_DOCS
        while len(self.levels[-1][0]) > 1:
            m, b, lo, hi = self.levels[-1]
            cut = np.arange(0, len(m), step)
            self.levels.append((np.bitwise_or.reduceat(m, cut), np.minimum.reduceat(b, cut),
                                np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut)))
            step = FANOUT

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether nodes a[i], b[i] of a level can hold a linked pair.

        Every bit that a document sets outside the other node's bitmap is a
        shingle that no document there has.
        """
        maps, few, lo, hi = self.levels[level]
        shared = np.bitwise_count(maps[a] & maps[b]).sum(axis=1).astype(np.int64)
        most = np.minimum(hi[a] - np.maximum(0, few[a] - shared), hi[b] - np.maximum(0, few[b] - shared))
        sizes = (100 * hi[a] >= percent * lo[b]) & (100 * hi[b] >= percent * lo[a])
        return sizes & ((100 + percent) * most >= percent * (lo[a] + lo[b]))

    def candidates(self, percent: int) -> Iterator[tuple[int, int]]:
        """Pairs of documents that the dual traversal cannot rule out."""
        todo = [(len(self.levels) - 1, np.zeros(1, np.intp), np.zeros(1, np.intp))]
        while todo:
            level, a, b = todo.pop()
            keep = (a == b) | self.possible(level, a, b, percent) if level else (a < b)
            a, b = a[keep], b[keep]
            if level == 0:
                keep = self.possible(0, a, b, percent)
                yield from zip(self.order[a[keep]].tolist(), self.order[b[keep]].tolist())
                continue
            step, n = (LEAF_DOCS if level == 1 else FANOUT), len(self.levels[level - 1][0])
            for at in range(0, len(a), 4096 // step):  # bounds the frontier's memory
                kid = np.arange(step)
                x = (a[at:at + 4096 // step, None, None] * step + kid[None, :, None])
                y = (b[at:at + 4096 // step, None, None] * step + kid[None, None, :])
                x, y = np.broadcast_arrays(x, y)
                x, y = x.ravel(), y.ravel()
                ok = (x <= y) & (x < n) & (y < n)
                todo.append((level - 1, x[ok], y[ok]))


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def join_block(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each document of a block the first document that it is connected with."""
    parent = list(range(len(sets)))
    if len(sets) > 1:
        for a, b in SignatureTree(sets).candidates(percent):
            x, y = _root(parent, a), _root(parent, b)
            if x != y and linked(sets[a], sets[b], percent):
                parent[max(x, y)] = min(x, y)
    return [_root(parent, i) for i in range(len(sets))]


# --- tasks ----------------------------------------------------------------

def _census(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total: dict[int, int] = {}
        first: dict[int, list[int]] = {}

        def flush() -> None:
            if held:
                value, n = np.unique(np.concatenate(held), return_counts=True)
                for v, c in zip(value[n > 2].tolist(), n[n > 2].tolist()):
                    total[v] = total.get(v, 0) + c
                held.clear()

        size = docs = 0
        for batch in sliced(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = shingles(text, words)
                if doc is None or not len(grams):
                    continue
                docs += 1
                held.append(grams)
                size += len(grams)
                seen = first.setdefault(int(grams[0]), [0, doc])
                seen[0] += 1
                seen[1] = min(seen[1], doc)
                if size > _CENSUS_FLUSH:
                    flush()
                    size = 0
        flush()
        rows = [(2, 0, docs, 0)] + [(0, k, n, 0) for k, n in total.items()] + [(1, k, n, d) for k, (n, d) in first.items() if n > 2]
        for at in range(0, len(rows), 50_000):
            kind, key, n, doc = zip(*rows[at:at + 50_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(np.array(key, np.uint64).view(np.int64)), pa.array(n, pa.int64()), pa.array(doc, pa.int64())],
                ["kind", "key", "n", "doc"])

    return run


def census(docs: DataFrame, words: int = WORDS) -> Census:
    counted = (docs.mapInArrow(_census(words), "kind int, key long, n long, doc long")
               .groupBy("kind", "key").agg(F.sum("n").alias("n"), F.min("doc").alias("doc")))
    counted = shared_table(counted.where("kind = 0 AND n > 5 OR kind = 1 AND n > 2 OR kind = 2"), "census")
    total = counted.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    # a share of all documents, so that the list does not grow with them
    often = max(5, total // COMMON_SHARE)
    common = counted.where(f"kind = 0 AND n > {often}").orderBy(F.desc("n"), "key").limit(COMMON_SHINGLES).select("key").collect()
    large = counted.where((F.col("kind") == 1) & (F.col("n") > BLOCK)).orderBy(F.desc("n"), "key").limit(LARGE_BLOCKS).collect()
    return Census(np.sort(np.array([r["key"] for r in common], np.int64).view(np.uint64)),
                  {r["key"]: (min(MAX_SALTS, -(-r["n"] // BLOCK)), r["doc"]) for r in large})


_DEALT = "block long, salt int, pivot int, doc_id long, parent long, text string"


def _deal(words: int, large: dict[int, tuple[int, int]]):
    """Rows for the blocks.  Equal sets within a task: the text goes once, the others name it as parent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in sliced(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = shingles(text, words)
                if doc is None or not len(grams):
                    rows.append((doc or 0, 0, 0, doc, None, text if len(grams) else None))
                    continue
                block = int(grams[:1].view(np.int64)[0])
                print_ = grams.tobytes() if len(grams) < 4 else _digest(grams)
                parent = known.setdefault(print_, doc)
                salts, pivot = large.get(block, (1, None))
                if doc == pivot:
                    rows += [(block, s, 1, doc, None, text) for s in range(salts)]
                elif parent != doc:
                    rows.append((doc, 0, 0, doc, parent, text))
                else:
                    rows.append((block, int(grams.sum() >> np.uint64(20)) % salts, 0, doc, None, text))
            for at in range(0, len(rows), 2000):
                cols = list(zip(*rows[at:at + 2000]))
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 ["block", "salt", "pivot", "doc_id", "parent", "text"])

    return run


def _digest(grams: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


_WORKED = "bucket int, kind int, a long, b long, n int, blob binary"
_ENTRY = np.dtype([("key", "<u8"), ("doc", "<i8"), ("class_", "<i8"), ("n", "<i4"), ("place", "<i4")])


def _work(words: int, percent: int, common: np.ndarray, buckets: int):
    """Blocks in, out: kind 0 (doc, what it is connected with, set size) and kind 1 (prefix entries by bucket)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: list[np.ndarray] = []
        rows: list[tuple] = []
        pack = zstandard.ZstdCompressor(level=1)

        def blobs() -> Iterator[pa.RecordBatch]:
            if not entries:
                return
            e = np.concatenate(entries)
            entries.clear()
            bucket = (e["key"] % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            e, bucket = e[order], bucket[order]
            cut = np.flatnonzero(np.diff(bucket, prepend=-1))
            out = []
            for lo, hi in zip(cut, [*cut[1:], len(e)]):
                part = e[lo:hi]
                # column by column, class and place relative: compresses well
                part = b"".join(c.tobytes() for c in (part["key"], part["doc"], part["doc"] - part["class_"], part["n"], part["place"]))
                out.append(pack.compress(part))
            yield _rows([(int(bucket[c]), 1, 0, 0, 0, x) for c, x in zip(cut, out)])

        def finish(block: list, carried: list) -> list:
            """Join one chunk of a block, together with what its earlier chunks left."""
            docs, sets, pivots, salts = zip(*carried, *block)
            found = join_block(list(sets), percent)
            members: dict[int, list[int]] = {}
            for i, r in enumerate(found):
                members.setdefault(r, []).append(i)
            left = []
            for who in members.values():
                pivot = next((docs[i] for i in who if pivots[i]), None)
                name = pivot if pivot is not None else min(docs[i] for i in who)
                old = next((i for i in who if i < len(carried)), None)
                for i in who:
                    if i < len(carried) and docs[i] != name:
                        rows.append((0, 0, docs[i], name, -1, None))  # a link only
                    elif i >= len(carried) and not (pivots[i] and salts[i]):
                        rows.append((0, 0, docs[i], name, len(sets[i]), None))
                        grams = prefix(sets[i], common, percent)
                        e = np.empty(len(grams), _ENTRY)
                        e["key"], e["doc"], e["class_"], e["n"], e["place"] = grams, docs[i], name, len(sets[i]), np.arange(len(grams))
                        entries.append(e)
                keep = old if old is not None else who[0]
                left.append((bool(pivots[keep]), len(who), (docs[keep], sets[keep], pivots[keep], salts[keep])))
            left.sort(key=lambda x: x[:2], reverse=True)
            return [x[2] for x in left[:CARRY]]

        at, block, carried = None, [], []
        held = 0
        for batch in sliced(batches):
            cols = [batch.column(i).to_pylist() for i in range(6)]
            for key, salt, pivot, doc, parent, text in zip(*cols):
                if (key, salt) != at or len(block) >= BLOCK:
                    if block:
                        carried = finish(block, carried)
                    if (key, salt) != at:
                        carried = []
                    at, block = (key, salt), []
                grams = shingles(text, words)
                if doc is None or not len(grams):
                    rows.append((0, 0, doc, doc, len(grams), None))
                elif parent is not None:
                    rows.append((0, 0, doc, parent, len(grams), None))
                else:
                    block.append((doc, grams, pivot, salt))
                    held += len(grams)
            if rows:
                yield _rows([((r[2] or 0) % buckets, *r[1:]) for r in rows])
                rows.clear()
            if held > 6_000_000:
                yield from blobs()
                held = 0
        if block:
            finish(block, carried)
        if rows:
            yield _rows([((r[2] or 0) % buckets, *r[1:]) for r in rows])
        yield from blobs()

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["bucket", "kind", "a", "b", "n", "blob"])


def _entries(blob: bytes) -> np.ndarray:
    raw = zstandard.decompress(blob)
    n = len(raw) // _ENTRY.itemsize
    e = np.empty(n, _ENTRY)
    at = 0
    for name in ("key", "doc", "class_", "n", "place"):
        kind = _ENTRY[name]
        e[name] = np.frombuffer(raw, kind, n, at)
        at += n * kind.itemsize
    e["class_"] = e["doc"] - e["class_"]
    return e


def _several_mask(e: np.ndarray) -> np.ndarray:
    """Entries, sorted by key, under which more than one class stands."""
    if not len(e):
        return np.zeros(0, bool)
    new = np.flatnonzero(np.concatenate([[True], e["key"][1:] != e["key"][:-1]]))
    one = np.minimum.reduceat(e["class_"], new) == np.maximum.reduceat(e["class_"], new)
    return np.repeat(~one, np.diff([*new, len(e)]))


def _fits(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and places allow a link.

    For the first shingle that two sets share, all before it are missing in
    the other, so their places bound the overlap.
    """
    nx, ny = x["n"].astype(np.int64), y["n"].astype(np.int64)
    most = np.minimum(nx - x["place"], ny - y["place"])
    return (x["class_"] != y["class_"]) & (x["doc"] != y["doc"]) & ((100 + percent) * most >= percent * (nx + ny))


def _pairs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.column_stack([np.minimum(x["doc"], y["doc"]), np.maximum(x["doc"], y["doc"])])


def meet_first(e: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """One document of each class against one of its key's largest class.

    Returns those pairs and the entries of keys with more than two, where
    other pairs remain.  As many pairs as classes, so a large group of near
    copies that fell into several classes costs little.
    """
    e = e[np.lexsort((e["n"], e["class_"], e["key"]))]
    e = e[_several_mask(e)]
    if not len(e):
        return np.empty((0, 2), np.int64), e
    of_key = np.concatenate([[True], e["key"][1:] != e["key"][:-1]])
    of_class = of_key | np.concatenate([[True], e["class_"][1:] != e["class_"][:-1]])
    at = np.flatnonzero(of_class)
    many = np.diff([*at, len(e)])
    middle = e[at + many // 2]
    group = np.cumsum(of_key[at]) - 1
    order = np.lexsort((-many, group))
    largest = order[np.searchsorted(group[order], np.arange(group[-1] + 1))]
    hub = middle[largest[group]]
    ok = _fits(hub, middle, percent)
    size = np.diff([*np.flatnonzero(of_key), len(e)])
    return np.unique(_pairs(hub[ok], middle[ok]), axis=0), e[np.repeat(size > 2, size)]


def meet(e: np.ndarray, group: np.ndarray, side: np.ndarray, reach: np.ndarray, earlier: list[frozenset]) -> np.ndarray:
    """All pairs (a < b) of documents of different classes that meet in a group and may be linked.

    ``reach``: the largest size of a partner that an entry's place allows (see
    ``_fits``).  The smaller set of a pair reaches the size of the larger,
    hence its own, so only such entries are taken as the left of a pair.
    ``side``: 0 left only, 1 right only, 2 both.  ``earlier``: per entry the
    first of the document's keys before this one; a pair that meets there too
    is left to those keys.
    """
    n, doc, class_ = e["n"].astype(np.int64), e["doc"], e["class_"]
    right = np.flatnonzero(side != 0)
    right = right[np.lexsort((n[right], group[right]))]
    left = np.flatnonzero((side != 1) & (reach >= n))
    code = (group << 32) + n
    lo = np.searchsorted(code[right], code[left])
    many = np.searchsorted(code[right], (group[left] << 32) + reach[left], side="right") - lo
    out, held = [np.empty((0, 2), np.int64)], 0
    total = np.cumsum(many)
    at = 0
    while at < len(left):  # some million pairs at a time
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + 1_000_000, side="right")))
        count = many[at:to]
        x = np.repeat(left[at:to], count)
        y = right[np.repeat(lo[at:to], count) + np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)]
        ok = (reach[y] >= n[x]) & (class_[x] != class_[y]) & ((n[x] < n[y]) | (doc[x] < doc[y])) & (doc[x] != doc[y])
        x, y = x[ok], y[ok]
        new = np.array([earlier[i].isdisjoint(earlier[j]) for i, j in zip(x.tolist(), y.tolist())], bool)
        out.append(_pairs(e[x[new]], e[y[new]]))
        held += len(out[-1])
        if held > 2_000_000:
            out = [np.unique(np.concatenate(out), axis=0)]
            held = 0
        at = to
    return np.unique(np.concatenate(out), axis=0)


_MET = "kind int, a long, b long, key long, n int, place int"
_DOC, _PAIR, _REST = 0, 2, 3


def _met(kind: int, a: np.ndarray, b: np.ndarray, key=None, n=None, place=None) -> pa.RecordBatch:
    zero = np.zeros(len(a), np.int64)
    cols = (np.full(len(a), kind), a, b, zero if key is None else key, zero if n is None else n, zero if place is None else place)
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(cols, types)],
                                      ["kind", "a", "b", "key", "n", "place"])


def _meet_first(percent: int):
    """Buckets in (sorted); out: documents as they came, first pairs, and entries with more to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blobs = None, []

        def bucket() -> Iterator[pa.RecordBatch]:
            pairs, rest = meet_first(np.concatenate([_entries(b) for b in blobs]), percent)
            if len(pairs):
                yield _met(_PAIR, pairs[:, 0], pairs[:, 1])
            if len(rest):
                yield _met(_REST, rest["doc"], rest["class_"], rest["key"].view(np.int64), rest["n"], rest["place"])

        for batch in batches:
            kind = batch.column(1)
            plain = batch.filter(pa.compute.equal(kind, 0))
            if plain.num_rows:
                a, b = (plain.column(i).to_pandas().astype("Int64") for i in (2, 3))
                none = pa.array(np.zeros(plain.num_rows, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [plain.column(1), pa.array(a, pa.int64()), pa.array(b, pa.int64()), none.cast(pa.int64()), plain.column(4), none],
                    ["kind", "a", "b", "key", "n", "place"])
            packed = batch.filter(pa.compute.equal(kind, 1))
            for k, blob in zip(packed.column(0).to_pylist(), packed.column(5).to_pylist()):
                if k != at and blobs:
                    yield from bucket()
                    blobs = []
                at = k
                blobs.append(blob)
        if blobs:
            yield from bucket()

    return run


def _meet_rest(percent: int):
    """Entries sorted by key and cell in; out: pairs.  Cells are taken together up to some number of entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def pairs() -> Iterator[pa.RecordBatch]:
            key, cell, doc, class_, n, reach, side, earlier = zip(*rows)
            e = np.zeros(len(rows), _ENTRY)
            e["doc"], e["class_"], e["n"] = doc, class_, n
            key, cell = np.array(key, np.int64), np.array(cell, np.int64)
            group = np.cumsum(np.concatenate([[False], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]))
            found = meet(e, group, np.array(side), np.array(reach, np.int64), [frozenset(x) for x in earlier])
            for k in range(0, len(found), 100_000):
                part = found[k:k + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part[:, 0].copy()), pa.array(part[:, 1].copy())], ["a", "b"])

        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                if len(rows) > 20_000 and r[:2] != rows[-1][:2]:
                    yield from pairs()
                    rows = []
                rows.append(r)
        if rows:
            yield from pairs()

    return run


_CELL = ("key", "cell", "doc", "class_", "n", "reach", "side", "earlier")


def _cells(kept: DataFrame, percent: int) -> DataFrame:
    """Entries of common shingles, dealt so that every pair that may fit meets in one bounded cell.

    Sizes of a pair are in one band or in neighbouring ones.  A band's entries
    are dealt into blocks; a cell is one block of left entries (``meet``) and
    one of right entries.
    """
    step = max(math.log(100 / percent), 0.01) * (1 + 1e-9)  # a little wider: logarithms are rounded
    kept = kept.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / step))
    own = F.col("reach") >= F.col("n")
    blocks = lambda c: F.ceil(F.count(c) / F.lit(DEAL)).cast("int")
    bands = kept.groupBy("key", "band").agg(
        blocks(F.when(own, 1)).alias("ls"), blocks(F.lit(1)).alias("rs"),
        F.min(F.when(own, F.col("n"))).alias("least"), F.max(F.when(own, F.col("reach"))).alias("most"))
    of_left = bands.where("ls > 0").select("key", F.col("band").alias("lb"), "ls", "least", "most")
    of_right = bands.select("key", F.col("band").alias("rb"), "rs")
    grid = of_left.join(of_right, "key").where("rb = lb OR rb = lb + 1")
    mine = lambda c: F.pmod(F.xxhash64("doc"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = (kept.where(own).join(grid.withColumnRenamed("lb", "band"), ["key", "band"])
            .withColumns({"lb": F.col("band"), "s": mine("ls"), "t": every("rs"), "side": F.lit(0)}))
    right = (kept.join(grid.withColumnRenamed("rb", "band"), ["key", "band"]).where("reach >= least AND n <= most")
             .withColumns({"rb": F.col("band"), "s": every("ls"), "t": mine("rs"), "side": F.lit(1)}))
    return (left.select(*kept.columns, "lb", "rb", "s", "t", "side").unionByName(right.select(*kept.columns, "lb", "rb", "s", "t", "side"))
            .withColumn("cell", F.xxhash64("lb", "rb", "s", "t")).select(*_CELL))


def _test(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, grams = None, shingles(None, words)
        for batch in sliced(batches):
            keep = []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if last != tb:  # an id may have several texts
                    last, grams = tb, shingles(tb, words)
                keep.append(linked(shingles(ta, words), grams, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = census(src, words)
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (src.mapInArrow(_deal(words, known.large), _DEALT)
             .repartition("block", "salt")
             .sortWithinPartitions("block", "salt", F.desc("pivot"), "doc_id"))
    worked = (dealt.mapInArrow(_work(words, percent, known.common, buckets), _WORKED)
              .repartition("bucket").sortWithinPartitions("bucket"))
    found = shared_table(worked.mapInArrow(_meet_first(percent), _MET), "jaccard")

    def tested(pairs: DataFrame) -> DataFrame:
        ta = src.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
        tb = src.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
        return (pairs.distinct().join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb")
                .mapInArrow(_test(words, percent), "a long, b long"))

    inside = found.where(f"kind = {_DOC} AND a IS NOT NULL AND a <> b").select("a", "b")
    first = shared_table(tested(found.where(f"kind = {_PAIR}").select("a", "b")).unionByName(inside), "jaccard-links")
    named = components(first)
    rest = shared_table(found.where(f"kind = {_REST}").join(named, F.col("b") == F.col("node"), "left").select(
        "key", F.col("a").alias("doc"), F.coalesce("component", "b").alias("class_"), "n", "place",
        F.expr(f"{100 + percent} * CAST(n - place AS LONG) div {percent} - n").alias("reach")), "jaccard-rest")
    # only keys under which different components still meet, and entries whose size and place fit some other's there
    own = F.col("reach") >= F.col("n")
    still = shared_table(rest.groupBy("key").agg(
        F.min("class_").alias("lo"), F.max("class_").alias("hi"), F.count(F.lit(1)).alias("m"),
        F.min(F.when(own, F.col("n"))).alias("least"), F.max(F.when(own, F.col("reach"))).alias("most"))
        .where("lo < hi AND least IS NOT NULL").select("key", "m", "least", "most"), "jaccard-keys")
    # with every entry, the first of the document's keys before it (see ``EARLIER``)
    of_doc = Window.partitionBy("doc", "n")
    head = F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") <= EARLIER, F.struct("place", "key"))).over(of_doc)), lambda x: x["key"])
    earlier = F.slice("head", F.lit(1), F.least(F.col("rank") - 1, F.lit(EARLIER)))
    # rows that repeat a doc_id may have different texts of one size: their keys cannot be told apart, so none is skipped
    again = (found.where(f"kind = {_DOC} AND n >= 0 AND a IS NOT NULL").groupBy(F.col("a").alias("doc"), "n")
             .agg(F.count(F.lit(1)).alias("times")).where("times > 1"))
    kept = (rest.join(still, "key").where("reach >= least AND n <= most")
            .withColumn("rank", F.row_number().over(of_doc.orderBy("place"))).withColumn("head", head)
            .join(again, ["doc", "n"], "left").select(
                "key", "doc", "class_", "n", "reach", F.when(F.col("times").isNull(), earlier)
                .otherwise(F.array().cast("array<long>")).alias("earlier"), (F.col("m") > MEET).alias("common")))
    whole = lambda some: some.withColumns({"cell": F.lit(0).cast("long"), "side": F.lit(2)}).select(*_CELL)
    if still.where(f"m > {MEET}").isEmpty():
        cells = whole(kept)
    else:
        kept = shared_table(kept, "jaccard-kept")
        cells = whole(kept.where("NOT common")).unionByName(_cells(kept.where("common"), percent))
    more = cells.repartition("key", "cell").sortWithinPartitions("key", "cell").mapInArrow(_meet_rest(percent), "a long, b long")
    links = shared_table(tested(more), "jaccard-links")
    if not links.isEmpty():
        named = components(links.unionByName(named.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    rows = found.where(f"kind = {_DOC} AND n >= 0").select(F.col("a").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"))
    return rows.join(named, rows["doc_id"] == named["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower_ascii, '[^\\x20\\x09-\\x0D]+') AS ws
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
        FROM documents)),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM w
  UNION SELECT link.a, reach.c FROM reach JOIN link ON link.b = reach.doc_id WHERE reach.c < link.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.c) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY w.doc_id
"""
