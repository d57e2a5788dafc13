"""Removal of repeated byte strings with a collection BWT (operator 9).

A byte goes when it lies in a string of ``width`` bytes that also starts
earlier: in a document with a smaller id, or further left in its own.  All
strings are judged on the input.

The transform of a collection is built column by column (module ``bwt``):
each round inserts one symbol of every string and updates transform and
common prefixes.  Over whole documents that would take as many passes as the
longest document has bytes, each over all data.  So the collection is cut
first, by content, into parts that hold every repeat:

1. *Cut*: every window of ``width`` bytes is filed under the smallest hash of
   its 32-byte substrings.  Consecutive windows under one hash make one
   string of ``width`` to ``2 width - 32`` bytes.  Equal windows get equal
   hashes, so they end up in the same part, wherever they stand.
2. *Fold*: copies of a string are folded, in the task that cuts them and
   then per hash: all but the first are repeats in full.  Equal
   windows also agree, around the smallest substring, in one of four fixed
   splits of the bytes beside it; only strings that share a split with another
   one of their hash go on, with one copy of each.  So what is fetched from
   the texts are strings with a likely partner, not all with a common
   substring.  Where one task alone finds many strings of a hash, all but two
   of them are dealt by their fingerprint instead, so no task folds all strings
   of a common hash; these go on without the test.
3. *Build*: the strings of a part (a bounded number of hashes) that can
   repeat anything go through the transform, at most ``2 width - 32`` rounds.  Neighbouring suffixes with
   a common prefix of ``width`` or more are equal windows; all but the first
   of a class are repeats.  A hash with more strings than a part holds (the
   edges of a passage that many documents share) is judged by its windows
   instead, in Spark: equal windows are grouped and all but the first are
   repeats.  Memory in a task does not depend on the strings of a hash.
4. *Apply*: the spans of each document are merged and cut out of its text.

Between the steps the collection lives in shuffle files and in written
tables of the shared folder, read and written sequentially.

Strings are told apart by 128 bits of hashes in step 2, windows byte by byte
in the transform and by 128 bits of hashes where a hash has too many strings.

Defined cases: null text counts as empty; a row with a null doc_id is
returned whole and nothing is a repeat of it; rows that repeat a doc_id are
one document read more than once: the same place in two of them is no
repeat, and each is cut at the spans found in any of them; texts shorter
than ``width`` are returned whole; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bwt import repeated
from .common import free_name, shared_table, sliced, table
from .shingles import BYTE_HASH, mix, prefix_hash, span_hash

WIDTH = 100
GRAM = 32
#: strings that are folded, and strings that go through the transform, at a time
FOLD = 400_000
PART = 4096
#: strings of one hash in a task, beyond which they are dealt by fingerprint
SPREAD = 64
_SLICE = 1 << 18
_U = np.uint64
_SPLITS = ["split0", "split1", "split2", "split3"]
_ENTRY = np.dtype([("key", "<u8"), ("print_", "<u8"), ("doc", "<i8"), ("start", "<i8"), ("size", "<i4"),
                   ("flags", "u1"), *((s, "<u4") for s in _SPLITS)])
_LOOPS, _COMMON = 1, 2  # flags: may repeat itself; other strings of its key are dealt elsewhere


def splits(width: int, gram: int) -> list[tuple[int, int]]:
    """Bytes left and right of a key's substring that two equal windows share, whichever they are.

    A window holds the key's substring and ``width - gram`` bytes around it.
    One with ``l`` bytes on the left covers the split whose left part is the
    largest that is not above ``l``; equal windows cover the same one.
    """
    around = width - gram
    step = max(1, -(-around // 4))
    return [(a, max(0, around - a - step)) for a in range(0, max(1, around), step)]


def _split_prints(h: np.ndarray, smallest: np.ndarray, prefix: np.ndarray, e: np.ndarray, start: np.ndarray, end: np.ndarray,
                  width: int, gram: int) -> None:
    """Fill in the 32-bit fingerprints of the splits (0: the string does not cover it)."""
    k = np.searchsorted(smallest, start)
    while True:  # the key's substring is one of the next few that are smallest in some window
        other = np.flatnonzero(h[smallest[k]] != e["key"])
        if not len(other):
            break
        k[other] += 1
    at = smallest[k]
    for name in _SPLITS:
        e[name] = 0
    for name, (a, b) in zip(_SPLITS, splits(width, gram)):
        ok = np.flatnonzero((at - start >= a) & (end - at - gram >= b))
        found = span_hash(prefix, at[ok] - a, at[ok] + gram + b) >> _U(32)
        e[name][ok] = np.maximum(found, _U(1)).astype(np.uint32)


def _sliding(f, h: np.ndarray, count: int) -> np.ndarray:
    """``f`` (minimum or maximum) over every run of ``count`` values."""
    span = 1
    while 2 * span <= count:
        h = f(h[:-span], h[span:])
        span *= 2
    return f(h[:len(h) - (count - span)], h[count - span:])


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all ``gram``-byte substrings."""
    h, step, base = BYTE_HASH[data], 1, 0x9E3779B97F4A7C15
    while step < gram:  # doubles the substrings' length
        h = h[:-step] * _U(base) + h[step:]
        base, step = base * base % (1 << 64), 2 * step
    return mix(h)


def _smallest(h: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of the substrings that are smallest in some window.

    They are those that equal the largest key of the windows around them.
    """
    count = len(h) - len(keys) + 1
    padded = np.concatenate([np.zeros(count - 1, np.uint64), keys, np.zeros(count - 1, np.uint64)])
    return np.flatnonzero(_sliding(np.maximum, padded, count) == h)


def _loops(h: np.ndarray, smallest: np.ndarray, e: np.ndarray, start: np.ndarray, end: np.ndarray, gram: int) -> np.ndarray:
    """Whether a string holds its key's substring twice, so that it may repeat itself.

    In one string, equal smallest substrings follow each other.
    """
    twice = np.flatnonzero(h[smallest[1:]] == h[smallest[:-1]])
    p, q = smallest[twice], smallest[twice + 1]
    out = np.zeros(len(e), bool)
    last = np.searchsorted(start, p, side="right") - 1
    for back in range(4):
        k = np.maximum(last - back, 0)
        out[k[(e["key"][k] == h[p]) & (start[k] <= p) & (end[k] >= q + gram)]] = True
    return out


def cut_strings(docs: list[int], texts: list[bytes], width: int, gram: int) -> np.ndarray:
    """Entries (key, fingerprint, doc, start, size, flags, split fingerprints) of the strings of a few documents."""
    kept = [(d, t) for d, t in zip(docs, texts) if len(t) >= width]
    if not kept:
        return np.empty(0, _ENTRY)
    sizes = np.array([len(t) for _, t in kept])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(t for _, t in kept), np.uint8)
    h = _gram_hashes(data, gram)
    every = keys = _sliding(np.minimum, h, width - gram + 1)
    inside = np.ones(len(keys), bool)  # windows that cross into the next document are none
    for e in ends[:-1]:
        inside[e - width + 1:e] = False
    at = np.flatnonzero(inside)
    keys = keys[at]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(new)
    since = np.arange(len(at)) - np.repeat(first, np.diff([*first, len(at)]))
    # one substring is smallest in that many windows at most; longer runs repeat it
    first = np.flatnonzero(since % (width - gram + 1) == 0)
    start = at[first]
    end = at[np.append(first[1:], len(at)) - 1] + width
    e = np.empty(len(first), _ENTRY)
    doc = np.searchsorted(ends, start, side="right")
    prefix, smallest = prefix_hash(data), _smallest(h, every)
    e["key"], e["print_"] = keys[first], span_hash(prefix, start, end)
    e["doc"] = np.array([d for d, _ in kept], np.int64)[doc]
    e["start"], e["size"] = start - (ends - sizes)[doc], end - start
    e["flags"] = np.where(_loops(h, smallest, e, start, end, gram), _LOOPS, 0)
    _split_prints(h, smallest, prefix, e, start, end, width, gram)
    return e


def _slices(docs: list[int | None], texts: list[str | None], width: int, gram: int) -> Iterator[np.ndarray]:
    """Entries of a batch, a quarter of a megabyte of text at a time; long texts in overlapping slices."""
    ids: list[int] = []
    held: list[bytes] = []
    size = 0
    for doc, text in zip(docs, texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if doc is None or len(data) < width:
            continue
        if len(data) > _SLICE:
            for at in range(0, len(data) - width + 1, _SLICE):
                e = cut_strings([doc], [data[at:at + _SLICE + width - 1]], width, gram)
                e["start"] += at
                yield e
            continue
        ids.append(doc)
        held.append(data)
        size += len(data)
        if size >= _SLICE:
            yield cut_strings(ids, held, width, gram)
            ids, held, size = [], [], 0
    yield cut_strings(ids, held, width, gram)


def fold(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first copies, later copies) of equal strings; entries come out sorted."""
    e = e[np.lexsort((e["start"], e["doc"], e["print_"], e["key"]))]
    if not len(e):
        return e, e
    new = np.concatenate([[True], (e["key"][1:] != e["key"][:-1]) | (e["print_"][1:] != e["print_"][:-1])])
    head = e[np.flatnonzero(new)[np.cumsum(new) - 1]]
    same = (head["doc"] == e["doc"]) & (head["start"] == e["start"])
    return e[new], e[~new & ~same]


def merge_spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of each document as one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    # running maximum of the ends within a document: documents are told apart by an offset
    lift = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]])) * (int(end.max()) + 2)
    top = np.maximum.accumulate(end + lift)
    new = np.concatenate([[True], start[1:] + lift[1:] > top[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], top[last] - lift[last]


_CUT = "bucket int, kind int, doc long, a long, b long, blob binary"
_FOUND = "kind int, key long, doc long, a long, b long"
_SPAN, _STRING, _SPREAD = 0, 1, 2


def _batch(names: str, *columns) -> pa.RecordBatch:
    """A record batch for a schema string, from arrays or single values."""
    fields = [f.split() for f in names.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    n = next(len(c) for c in columns if isinstance(c, (list, np.ndarray)))
    out = [pa.array(c, types[t]) if isinstance(c, (list, np.ndarray)) else pa.array([c] * n, types[t])
           for c, (_, t) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(out, [f for f, _ in fields])


def _cut(width: int, gram: int, buckets: int, spread: int):
    """Documents in; out: strings by bucket (packed), and spans that are repeats within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            firsts, again = fold(np.concatenate(held))
            held.clear()
            if len(again):
                doc, a, b = merge_spans(again["doc"], again["start"], again["start"] + again["size"])
                yield _batch(_CUT, (doc % buckets).astype(np.int32), _SPAN, doc, a, b, None)
            if not len(firsts):
                return
            new = np.flatnonzero(np.concatenate([[True], firsts["key"][1:] != firsts["key"][:-1]]))
            count = np.diff([*new, len(firsts)])
            # two strings of a key show in its own bucket that it has several
            many = np.repeat(count, count) > spread
            firsts["flags"][many] |= _COMMON
            dealt = many & (np.arange(len(firsts)) - np.repeat(new, count) >= 2)
            for kind, some, by in ((_STRING, firsts[~dealt], "key"), (_SPREAD, firsts[dealt], "print_")):
                bucket = (some[by] % _U(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                e, bucket = some[order], bucket[order]
                cut = np.flatnonzero(np.diff(bucket, prepend=-1))
                blobs = [pack.compress(b"".join(e[lo:hi][n].tobytes() for n in _ENTRY.names)) for lo, hi in zip(cut, [*cut[1:], len(e)])]
                if blobs:
                    yield _batch(_CUT, bucket[cut], kind, 0, 0, 0, blobs)

        n = 0
        for batch in sliced(batches):
            for e in _slices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), width, gram):
                held.append(e)
                n += len(e)
                if n >= FOLD:
                    yield from flush()
                    n = 0
        yield from flush()

    return run


def _unpack(blob: bytes) -> np.ndarray:
    raw = zstandard.decompress(blob)
    n = len(raw) // _ENTRY.itemsize
    e, at = np.empty(n, _ENTRY), 0
    for name in _ENTRY.names:
        e[name] = np.frombuffer(raw, _ENTRY[name], n, at)
        at += n * _ENTRY[name].itemsize
    return e


def partners(e: np.ndarray) -> np.ndarray:
    """Which of the different strings (sorted by key) can share a window with another of their key, or with themselves.

    Strings of a key that agree with none in any split have no repeat: they
    need no transform, and their bytes are never fetched.  A string that holds
    its key's substring twice has further splits, and other strings of a
    common key are not here: then all of the key stay.
    """
    key = e["key"]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.cumsum(new) - 1
    sizes = np.bincount(group)
    whole = np.bincount(group, e["flags"] > 0, len(sizes)) > 0
    keep = whole[group] & ((sizes[group] > 1) | (e["flags"] > 0))
    for name in _SPLITS:
        some = np.flatnonzero((e[name] > 0) & (sizes[group] > 1))
        mark = group[some].astype(np.uint64) << _U(32) | e[name][some]
        order = np.argsort(mark, kind="stable")
        same = np.flatnonzero(mark[order][1:] == mark[order][:-1])
        met = np.zeros(len(some), bool)
        met[order[same]] = met[order[same + 1]] = True
        keep[some[met]] = True
    return keep


def _fold_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted buckets in; out: spans of later copies, and the strings that must be compared."""
    at: tuple[int, int] | None = None
    blobs: list[bytes] = []

    def bucket() -> Iterator[pa.RecordBatch]:
        e = np.concatenate([_unpack(b) for b in blobs])
        common = np.unique(e["key"][e["flags"] & _COMMON > 0])
        firsts, again = fold(e)
        firsts["flags"][np.isin(firsts["key"], common)] |= _COMMON
        if len(again):
            doc, a, b = merge_spans(again["doc"], again["start"], again["start"] + again["size"])
            yield _batch(_FOUND, _SPAN, 0, doc, a, b)
        e = firsts[partners(firsts)] if at[1] == _STRING and len(firsts) else firsts
        if len(e):
            yield _batch(_FOUND, _STRING, e["key"].view(np.int64), e["doc"].copy(), e["start"].copy(), e["start"] + e["size"])

    for batch in batches:
        spans = batch.filter(pa.compute.equal(batch.column(1), _SPAN))
        if spans.num_rows:
            yield _batch(_FOUND, _SPAN, 0, *[spans.column(i).to_numpy() for i in (2, 3, 4)])
        packed = batch.filter(pa.compute.not_equal(batch.column(1), _SPAN))
        for *k, blob in zip(*[packed.column(i).to_pylist() for i in (0, 1, 5)]):
            k = tuple(k)
            if k != at and blobs:
                yield from bucket()
                blobs = []
            at = k
            blobs.append(blob)
    if blobs:
        yield from bucket()


_BYTES = "key long, doc long, a long, data binary"


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text and the strings wanted from it: the strings with their bytes."""
    for batch in sliced(batches):
        rows = []
        for doc, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if wanted:
                data = (text or "").encode("utf-8", "surrogatepass")
                rows += [(w["key"], doc, w["a"], data[w["a"]:w["b"]]) for w in wanted if w["b"] <= len(data)]
        if rows:
            yield _batch(_BYTES, *[list(c) for c in zip(*rows)])


_WINDOW = "h1 long, h2 long, doc long, a long"


def _windows(width: int):
    """Strings with their bytes: two 64-bit hashes of each of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4096):
            data = batch.column(3).to_pylist()
            sizes = np.array([len(x) for x in data])
            flat, first = np.frombuffer(b"".join(data), np.uint8), np.cumsum(sizes) - sizes
            n = sizes - width + 1
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(first, n) + offset
            h1 = span_hash(prefix_hash(flat), at, at + width)
            # another polynomial: every byte under another number
            h2 = span_hash(prefix_hash(flat ^ np.uint8(0x5A)), at, at + width)
            doc, a = (np.repeat(batch.column(i).to_numpy(), n) for i in (1, 2))
            yield _batch(_WINDOW, h1.view(np.int64), h2.view(np.int64), doc, a + offset)

    return run


def repeats(docs: np.ndarray, starts: np.ndarray, strings: list[bytes], width: int):
    """Spans of the windows of a part that are repeats of an earlier one."""
    group, string, offset = repeated(strings, width)
    doc, start = docs[string], starts[string] + offset
    order = np.lexsort((start, doc, group))
    group, doc, start = group[order], doc[order], start[order]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    head = np.repeat(first, np.diff([*first, len(group)]))
    later = (doc != doc[head]) | (start != start[head])
    return merge_spans(doc[later], start[later], start[later] + width)


def promising(keys: np.ndarray, strings: list[bytes], width: int, gram: int) -> np.ndarray:
    """Which strings can share a window with another string of their key, or with themselves.

    A window holds the key's substring and ``width - gram`` bytes around it,
    so two equal windows agree, around that substring, in one of a few fixed
    splits of those bytes into a left and a right part.  Strings that agree
    with none in any split have no repeat and need no transform.
    """
    sizes = np.array([len(s) for s in strings])
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(strings), np.uint8)
    h = _gram_hashes(data, gram)
    row = np.repeat(np.arange(len(strings)), sizes)[:len(h)]
    at = np.flatnonzero(h == keys[row])
    row = row[at]
    left, right = at - begin[row], begin[row] + sizes[row] - at - gram
    prefix, mark = prefix_hash(data), mix(keys[row])
    keep = np.zeros(len(strings), bool)
    around = width - gram
    step = max(1, around // 4)
    for a in range(0, around + 1, step):
        b = max(0, around - a - step)
        ok = np.flatnonzero((left >= a) & (right >= b))
        found = span_hash(prefix, at[ok] - a, at[ok] + gram + b) ^ mark[ok]
        order = np.argsort(found)
        same = found[order][1:] == found[order][:-1]
        keep[row[ok[order[1:][same]]]] = True
        keep[row[ok[order[:-1][same]]]] = True
        if not b:
            break
    return keep


def _build(width: int, gram: int):
    """Strings sorted by key in; out: spans.  A part ends where a key ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def part() -> Iterator[pa.RecordBatch]:
            keep = promising(np.array([r[0] for r in rows], np.int64).view(np.uint64), [r[3] for r in rows], width, gram)
            some = [r for r, k in zip(rows, keep) if k]
            if some:
                found = repeats(np.array([r[1] for r in some]), np.array([r[2] for r in some]), [r[3] for r in some], width)
                if len(found[0]):
                    yield _batch("doc long, a long, b long", *found)

        for batch in batches:
            for r in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if len(rows) >= PART and r[0] != rows[-1][0]:
                    yield from part()
                    rows = []
                rows.append(r)
        if rows:
            yield from part()

    return run


def cut_bytes(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of ``data`` without the spans, the bytes removed and the removed runs."""
    if not spans:
        return data, 0, 0
    kept, at, removed, runs = [], 0, 0, 0
    _, a, b = merge_spans(np.zeros(len(spans), np.int64), np.array([s[0] for s in spans]), np.array([s[1] for s in spans]))
    for lo, hi in zip(a.tolist(), np.minimum(b, len(data)).tolist()):
        if lo < hi:
            kept.append(data[at:lo])
            at, removed, runs = hi, removed + hi - lo, runs + 1
    kept.append(data[at:])
    return b"".join(kept), removed, runs


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        out: list[tuple] = []
        for doc, text, spans in zip(*[c.to_pylist() for c in batch.columns]):
            data = (text or "").encode("utf-8", "surrogatepass")
            kept, removed, runs = cut_bytes(data, [(s["a"], s["b"]) for s in spans or ()])
            out.append((doc, len(data), removed, runs, kept))
        if out:
            yield _batch(_RESULT, *[list(c) for c in zip(*out)])


def _replace(text_at: int, chars_at: int | None):
    """Rows with their spans in the last column: the rows with the text that is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            columns, names = batch.columns[:-1], batch.schema.names[:-1]
            texts = []
            for text, spans in zip(columns[text_at].to_pylist(), batch.columns[-1].to_pylist()):
                if spans and text:
                    data, _, _ = cut_bytes(text.encode("utf-8", "surrogatepass"), [(s["a"], s["b"]) for s in spans])
                    text = data.decode("utf-8", "ignore")  # without the rest of a character that was cut
                texts.append(text)
            columns[text_at] = pa.array(texts, pa.string())
            if chars_at is not None:
                columns[chars_at] = pa.array([None if t is None else len(t) for t in texts], columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def repeated_spans(src: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc, a, b: spans of ``src`` (doc_id, text) that are repeats; they may overlap."""
    gram = GRAM
    while 3 * gram > width and gram > 1:
        gram //= 2
    buckets = 4 * int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = src.where("doc_id IS NOT NULL").mapInArrow(_cut(width, gram, buckets, SPREAD), _CUT)
    found = shared_table(cut.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_fold_buckets, _FOUND), "repeats")
    strings = found.where(f"kind = {_STRING}")
    common = shared_table(strings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(f"n > {PART}").select("key"), "common-keys")
    spans = found.where(f"kind = {_SPAN}").select("doc", "a", "b")

    # the one pass that takes bytes out of the texts: strings that may have a partner
    lists = strings.groupBy("doc").agg(F.collect_list(F.struct("key", "a", "b")).alias("wanted"))
    fetched = src.join(lists, src["doc_id"] == lists["doc"]).select("doc_id", "text", "wanted").mapInArrow(_fetch, _BYTES)
    if not common.isEmpty():
        fetched = shared_table(fetched, "strings")
        # as many rows as a part holds strings, at least, stand behind each of these keys
        windows = shared_table(fetched.join(common, "key", "left_semi").mapInArrow(_windows(width), _WINDOW), "windows")
        first = (windows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "a")).alias("first"), F.count(F.lit(1)).alias("n"))
                 .where("n > 1").select("h1", "h2", "first"))
        later = windows.join(first, ["h1", "h2"]).where(F.struct("doc", "a") != F.col("first"))
        spans = spans.unionByName(later.select("doc", "a", (F.col("a") + width).alias("b")))
        fetched = fetched.join(common, "key", "left_anti").select("key", "doc", "a", "data")
    parts = fetched.repartition("key").sortWithinPartitions("key")
    return spans.unionByName(parts.mapInArrow(_build(width, gram), "doc long, a long, b long"))


def _with_spans(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with all spans of a row's document in the last column."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    doc, found = free_name(docs, "_doc"), free_name(docs, "_spans")
    spans = repeated_spans(src, width).groupBy(F.col("doc").alias(doc)).agg(F.collect_list(F.struct("a", "b")).alias(found))
    return docs.join(spans, docs[id_col].cast("long") == spans[doc], "left").select(
        *[F.col(f"`{c}`") for c in docs.columns], found)


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes that are kept, for every row."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _with_spans(src, width, "doc_id", "text").mapInArrow(_results, _RESULT)


def cut_documents(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
                  chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with all columns; the text, and its length if there is such a column, are what is left.

    Where a cut falls inside a character, the rest of it goes as well.
    """
    names = docs.columns
    chars = names.index(chars_col) if chars_col in names else None
    return _with_spans(docs, width, id_col, text_col).mapInArrow(_replace(names.index(text_col), chars), docs.schema)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
