"""License scans with a positional rare-token index (operator 12).

DataFrame functions only.  Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``
after lower-casing A-Z.

1. *Index*: every template (a license notice, or a short phrase) is filed by
   word: (word, template, position) postings.  Its size is that of the
   templates, whatever the corpus.
2. *Rarity*: the number of documents that hold each license word, counted
   over all documents, gives the words' IDF.
3. *Look-up*: of the words that a file shares with a template, the
   ``LOOK_UP`` with the highest IDF are looked up, at every place in the file.
   Files that share too few words with any template make no rows.
4. *Positions*: every occurrence votes for the place where the template
   would begin (its position less that of the posting).  Votes within
   ``SLACK`` words of each other, as names and line ends shift a copy, are
   joined; a template is a candidate where enough of its words meet.
   A phrase needs all of its words at one place, without slack.
5. *Verification*: a notice counts only if the file holds one of its mandatory
   key phrases (whole words, in a row).

Defined cases: a null or empty text has no words, places or labels and score
0; very long texts are read whole; rows that repeat a doc_id or are wholly
equal are judged each; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_table, table

#: words of a template that are looked up in a file
LOOK_UP = 16
#: share of them that must meet at one place
MEET = 0.6
#: words by which parts of a notice may be shifted
SLACK = 24
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: fixed values: phrases that are counted, and their labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Notice:
    """A license notice: its label, its text, and phrases of which a copy must hold one."""

    label: str
    text: str
    keys: tuple[str, ...]


#: opening and condition lines of public licenses
NOTICES = (
    Notice("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
           "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
           "(at your option) any later version.", ("gnu affero general public license",)),
    Notice("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
           "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
           "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
           "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
           ("apache license version 2", "apache org licenses license 2 0")),
    Notice("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
           "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
           "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
           ("redistribution and use in source and binary forms",)),
    Notice("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this "
           "license, visit http://creativecommons.org/licenses/by/4.0/", ("creative commons attribution 4", "creativecommons org licenses by 4")),
    Notice("cc-by", "Licensed under CC BY 4.0", ("cc by 4 0", "cc by 3 0")),
    Notice("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Notice("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
           "work under the CC0 1.0 Universal Public Domain Dedication", ("cc0 1 0 universal", "waived all copyright and related or neighboring rights")),
    Notice("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
           "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
           "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
           "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.", ("gnu general public license",)),
    Notice("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
           ("permission to use copy modify and or distribute this software",)),
    Notice("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
           "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any "
           "later version.", ("gnu lesser general public license", "gnu library general public license")),
    Notice("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the Software), to deal in the Software without restriction, including without limitation the rights "
           "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
           "to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
           "permission notice shall be included in all copies or substantial portions of the Software.",
           ("permission is hereby granted free of charge to any person obtaining a copy",)),
    Notice("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
           "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/", ("mozilla public license",)),
    Notice("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
           "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
           "purpose, commercial or non-commercial, and by any means.", ("free and unencumbered software released into the public domain",)),
)


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lower, NOT_WORD), "")


def _plain(spark: SparkSession, texts: list[str]) -> list[list[str]]:
    """The templates' own words, by the same rule as the documents' words."""
    return spark.range(1).select(F.array(*(words(F.lit(t)) for t in texts)).alias("w")).first().w


class Index:
    """Postings of the templates; phrases first, then notices."""

    def __init__(self, spark: SparkSession, phrases: dict[str, str], notices: tuple[Notice, ...]) -> None:
        keys = [k for n in notices for k in n.keys]
        plain = _plain(spark, [*phrases, *(n.text for n in notices), *keys])
        self.words = plain[:len(phrases) + len(notices)]
        self.n_phrases = len(phrases)
        self.labels = [*phrases.values(), *(n.label for n in notices)]
        self.keys = [" " + " ".join(w) + " " for w in plain[len(self.words):]]
        self.key_owner = [self.n_phrases + t for t, n in enumerate(notices) for _ in n.keys]
        self.vocabulary = sorted({w for t in self.words for w in t})

    def rarest_first(self, seen: dict[str, int]) -> list[list[str]]:
        """The different words of each template, highest IDF (fewest documents) first."""
        return [sorted(set(t), key=lambda w: (seen.get(w, 0), w)) for t in self.words]


def documents_with(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> DataFrame:
    """word, n_docs: over all documents, for the words of ``vocabulary`` (a row for each at most)."""
    found = F.array_intersect(F.array(*map(F.lit, vocabulary)), words(F.col(text_col)))
    return docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices: tuple[Notice, ...] = NOTICES,
         id_col: str = "doc_id", text_col: str = "text", look_up: int = LOOK_UP, meet: float = MEET,
         slack: int = SLACK) -> DataFrame:
    """One row per document: doc_id, n_words, places, matches.

    places: array of (start, label) of the phrases, by start; matches: array of
    (label, start, share) of the verified notices, ``share`` the part of the
    looked-up words that meet there.
    """
    spark = docs.sparkSession
    index = Index(spark, PHRASES if phrases is None else phrases, notices)
    # one row per license word: bounded by the templates
    seen = {r.word: r.n_docs for r in documents_with(docs, index.vocabulary, text_col).collect()}
    rarest = index.rarest_first(seen)
    asked = [len(t) if k < index.n_phrases else min(look_up, len(t)) for k, t in enumerate(rarest)]
    needed = [n if k < index.n_phrases else max(2, -int(-meet * n // 1)) for k, n in enumerate(asked)]

    def strings(values: list[str]) -> Column:
        return F.array(*map(F.lit, values))

    every = sorted(index.vocabulary, key=lambda w: (seen.get(w, 0), w))
    shared = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("words")) \
                 .withColumn("shared", F.array_intersect(strings(every), "words"))
    # of each template, the file's rarest words; none where too few are there
    chosen = [F.slice(F.array_intersect(strings(t), "shared"), 1, asked[k]) for k, t in enumerate(rarest)]
    lists = [F.when(F.size(c) >= needed[k], c).otherwise(F.array().cast("array<string>")) for k, c in enumerate(chosen)]
    asks = shared.withColumn("chosen", F.array(*lists)).withColumn("wanted", F.array_distinct(F.flatten("chosen")))
    at = F.transform("words", lambda w, i: F.struct(i.cast("long").alias("at"), w.alias("word")))
    hits = F.when(F.size("wanted") > 0, F.filter(at, lambda x: F.array_contains("wanted", x["word"])))
    joined = F.when(F.size("wanted") > 0, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    keys = [F.when(F.col("joined").contains(k), F.lit(t)) for k, t in zip(index.keys, index.key_owner)]
    verified = F.array_distinct(F.array_compact(F.array(*keys))) if keys else F.lit(None).cast("array<int>")
    files = shared_table(
        asks.withColumn("joined", joined).select("doc_id", F.size("words").cast("long").alias("n_words"), "chosen", hits.alias("hits"),
                    verified.alias("verified")).withColumn("file", F.monotonically_increasing_id()), "license-files")

    flags = range(1 + max(map(len, index.words), default=0) // 62)  # 62 words of a template in each

    def posting(k: int, position: int, word: str) -> Column:
        exact = k < index.n_phrases
        bit = position if exact else sorted(set(index.words[k])).index(word)
        marks = {f"bits{f}": F.lit(1 << bit % 62 if bit // 62 == f else 0).cast("long") for f in flags}
        row = {"word": word, "template": k, "position": position, "exact": exact, "needed": needed[k], "asked": asked[k],
               "label": index.labels[k], **marks}
        return F.struct(*((v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in row.items()))

    postings = spark.range(1).select(F.inline(F.array(*(posting(k, p, w) for k, t in enumerate(index.words) for p, w in enumerate(t)))))
    votes = (files.where(F.col("hits").isNotNull())
             .select("file", "chosen", "verified", F.explode("hits").alias("hit"))
             .select("file", "chosen", "verified", F.col("hit.at").alias("at"), F.col("hit.word").alias("word"))
             .join(F.broadcast(postings), "word")  # as many rows as the templates have words
             .where(F.array_contains(F.element_at("chosen", F.col("template") + 1), F.col("word"))
                    & (F.col("exact") | F.array_contains("verified", F.col("template")))))
    begins = (votes.groupBy("file", "template", "exact", "needed", "asked", "label", (F.col("at") - F.col("position")).alias("begin"))
              .agg(*(F.bit_or(f"bits{f}").alias(f"bits{f}") for f in flags)))
    exact = begins.where("exact").where(sum(F.bit_count(f"bits{k}") for k in flags) == F.col("needed"))
    near = Window.partitionBy("file", "template").orderBy("begin").rangeBetween(-slack, slack)
    met = sum(F.bit_count(F.bit_or(f"bits{k}").over(near)) for k in flags)
    loose = begins.where("not exact").withColumn("met", met).where("met >= needed")
    best = (loose.groupBy("file", "label")
            .agg(F.max(F.struct((F.col("met") / F.col("asked")).alias("share"), (-F.col("begin")).alias("at"))).alias("m")))
    found = (exact.select("file", F.struct(F.col("begin").alias("start"), "label").alias("place"), F.lit(None).alias("match"))
             .unionByName(best.select("file", F.lit(None).alias("place"),
                                      F.struct("label", F.greatest(-F.col("m.at"), F.lit(0)).alias("start"), "m.share").alias("match"))))
    per_file = found.groupBy("file").agg(F.array_sort(F.collect_list("place")).alias("places"),
                                         F.array_sort(F.collect_list("match")).alias("matches"))
    return (files.select("file", "doc_id", "n_words").join(per_file, "file", "left")
            .select("doc_id", "n_words", *[F.coalesce(c, F.array().cast(per_file.schema[c].dataType)).alias(c)
                                           for c in ("places", "matches")]))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    own = F.transform("matches", lambda m: m["label"])
    share = F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["start"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        # half for a phrase, half for the share of the best notice
        (F.when(F.size("places") > 0, 0.5).otherwise(0.0) + share / 2).alias("score"))


def _sql() -> str:
    """The same rules in DuckDB SQL, one text word a row."""
    plain = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    own = [plain.findall(n.text.translate(str.maketrans(ascii_uppercase, ascii_lowercase))) for n in NOTICES]
    asked = [min(LOOK_UP, len(set(t))) for t in own]
    values = lambda rows: "VALUES " + ", ".join("(" + ", ".join(map(repr, r)) + ")" for r in rows)
    notices = values((t, n.label, asked[t], max(2, -int(-MEET * asked[t] // 1))) for t, n in enumerate(NOTICES))
    places = values((t, p, w) for t, words_ in enumerate(own) for p, w in enumerate(words_))
    keys = values((t, f" {k} ") for t, n in enumerate(NOTICES) for k in n.keys)
    phrases = values((p, label, len(p.split()), p.split()[0]) for p, label in PHRASES.items())
    return f"""
WITH notice(t, label, asked, needed) AS ({notices}),
place(t, position, word) AS ({places}),
must(t, phrase) AS ({keys}),
phrase(words, label, n, head) AS ({phrases}),
doc AS (
  SELECT row_number() OVER () AS file, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents),
word AS (SELECT file, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM doc),
base AS (
  SELECT w.file, w.pos, p.label FROM word w JOIN phrase p ON w.word = p.head JOIN doc d ON d.file = w.file
  WHERE array_to_string(d.ws[w.pos + 1:w.pos + p.n], ' ') = p.words),
have AS (SELECT DISTINCT file, word FROM word WHERE word IN (SELECT word FROM place)),
seen AS (SELECT word, count(*) AS n FROM have GROUP BY word),
chosen AS (
  SELECT h.file, x.t, x.word FROM have h JOIN (SELECT DISTINCT t, word FROM place) x ON x.word = h.word
    JOIN seen s ON s.word = x.word JOIN notice o ON o.t = x.t
  QUALIFY row_number() OVER (PARTITION BY h.file, x.t ORDER BY s.n, x.word) <= any_value(o.asked) OVER (PARTITION BY h.file, x.t)),
verified AS (
  SELECT DISTINCT c.file, c.t FROM (SELECT file, t FROM chosen GROUP BY ALL HAVING count(*) >= (SELECT min(needed) FROM notice)) c
    JOIN doc d ON d.file = c.file JOIN must k ON k.t = c.t
  WHERE contains(' ' || array_to_string(d.ws, ' ') || ' ', k.phrase)),
vote AS (
  SELECT DISTINCT c.file, c.t, c.word, w.pos - p.position AS origin
  FROM verified v JOIN chosen c ON c.file = v.file AND c.t = v.t JOIN word w ON w.file = c.file AND w.word = c.word
    JOIN place p ON p.t = c.t AND p.word = c.word),
met AS (
  SELECT a.file, a.t, a.origin, count(DISTINCT b.word) AS met
  FROM (SELECT DISTINCT file, t, origin FROM vote) a JOIN vote b ON b.file = a.file AND b.t = a.t AND abs(a.origin - b.origin) <= {SLACK}
  GROUP BY ALL),
found AS (
  SELECT m.file, o.label, max(m.met / CAST(o.asked AS DOUBLE)) AS share FROM met m JOIN notice o ON o.t = m.t WHERE m.met >= o.needed GROUP BY ALL),
based AS (
  SELECT file, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM base GROUP BY file),
noticed AS (SELECT file, list(DISTINCT label) AS labels, max(share) AS share FROM found GROUP BY file)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
       array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(n.labels, [])))), ',') AS labels,
       CASE WHEN b.n_base > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END + coalesce(n.share, 0.0) / 2 AS score
FROM doc d LEFT JOIN based b ON b.file = d.file LEFT JOIN noticed n ON n.file = d.file
"""


SQL = _sql()
