"""Quality rules as a bitmask ledger (operator 6).

Every document is measured once and every rule is evaluated once; the ledger
keeps the measurements and one failure bit per rule.  A *policy* is a named,
versioned set of rules: applying it is one bitwise test per row, and the
effect of leaving a rule out is computed from the counts per distinct bit
pattern, without looking at any text again.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` of the whole text.

Defined cases: a null or empty text has no words and fails ``few_words``;
repeated rows and rows without doc_id get a ledger row each; an empty table
gives an empty ledger; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, table

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_letters", "n_upper", "n_marks")

#: name -> (what it fails on, as SQL over the measures).  The order fixes the bits.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "duplicate_lines": "n_dup_lines >= 3 AND 100 * n_dup_lines > 50 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "upper_case": "n_letters >= 20 AND 100 * n_upper > 60 * n_letters",
    "marks": "100 * n_marks > 50 * n_words",
}
BASE_RULES = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A version of the rules that are in force."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


POLICIES = {
    "base": Policy("base", BASE_RULES),
    "v1": Policy("v1", (*BASE_RULES, "symbols", "duplicate_lines", "word_length")),
    "v2": Policy("v2", tuple(RULES)),
}
CURRENT = "v2"

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


def _repeat_words(words: list[bytes]) -> int:
    """Words inside a window of three words that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    a = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    v = len(numbers)
    if v == n:
        return 0
    pairs = np.unique(a[:-1] * v + a[1:], return_inverse=True)[1].astype(np.int64)
    _, where, count = np.unique(pairs[:-1] * v + a[2:], return_inverse=True, return_counts=True)
    twice = count[where] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k:n - 2 + k] |= twice
    return int(inside.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measures of one whole text, in the order of ``MEASURES``."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # bytes.split: ASCII white space, as in the word rule
    joined = b"".join(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    gone = lambda drop: len(data) - len(data.translate(None, drop))
    starts = len(joined) - len(joined.translate(None, bytes(range(0x80, 0xC0))))
    return (len(words), len(joined) - starts, gone(_SYMBOLS), len(lines),
            len(lines) - len(set(lines)), _repeat_words(words),
            gone(_LETTERS), gone(_UPPER), gone(b"!?"))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        rows = [measure_text(t) for t in batch.column(1).to_pylist()]
        cols = list(zip(*rows)) or [[] for _ in MEASURES]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in cols)], ["doc_id", *MEASURES])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measures, and ``fail_bits`` (bit i: the i-th rule of ``RULES`` fails)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fields = ", ".join(f"{m} long" for m in MEASURES)
    measured = src.mapInArrow(_measure, f"doc_id long, {fields}")
    bits = " | ".join(f"if({cond}, {1 << i}, 0)" for i, cond in enumerate(RULES.values()))
    return measured.withColumn("fail_bits", F.expr(f"cast({bits} as long)"))


def apply_policy(rows: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """Ledger rows with ``kept``: no rule of the policy fails."""
    return (rows.withColumn("policy", F.lit(policy.version))
            .withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0))


def ablation(rows: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """Per rule of the policy: rows that fail it, that fail only it, and that would be kept without it.

    Rows are first counted per bit pattern (at most ``2 ** len(RULES)`` rows).
    """
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    names = list(RULES)
    per_rule = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit"))
                                   for r in policy.rules])).alias("r")
    hit = F.col("fail_bits").bitwiseAND(F.col("r.bit")) != 0
    rest = F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).bitwiseAND(F.bitwise_not(F.col("r.bit")))
    return (patterns.select("fail_bits", "n", per_rule)
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(hit & (rest == 0), F.col("n")).otherwise(0)).alias("n_only_this"),
                 F.sum(F.when(rest == 0, F.col("n")).otherwise(0)).alias("n_kept_without")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")))
    base = POLICIES["base"].mask
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(F.lit(base)) != 0).alias("base_failed"), "kept", "fail_bits")


_BITS = " | ".join(f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END" for i, cond in enumerate(RULES.values()))

SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
word AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
         FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)),
three AS (SELECT r, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3
          FROM word WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i, w, w3 IS NOT NULL AND count(*) OVER (PARTITION BY r, w, w2, w3) > 1 AS hit FROM three),
covered AS (SELECT r, w, hit OR coalesce(lag(hit) OVER o, false) OR coalesce(lag(hit, 2) OVER o, false) AS c
            FROM twice WINDOW o AS (PARTITION BY r ORDER BY i)),
words AS (SELECT r, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars, count(*) FILTER (c) AS n_repeat_words
          FROM covered GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
          FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS n_letters,
             length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
             length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS n_marks
      FROM d LEFT JOIN words USING (r) LEFT JOIN lines USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       b & {POLICIES["base"].mask} <> 0 AS base_failed, b & {POLICIES[CURRENT].mask} = 0 AS kept, b::BIGINT AS fail_bits
FROM (SELECT *, {_BITS} AS b FROM m)
"""
