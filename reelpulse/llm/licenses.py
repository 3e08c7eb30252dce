"""License scan with a positional rare-token index.

The index holds two kinds of templates.  *Phrases* are short, and all their words
must stand at their places.  *Notices* are licence texts of usual length; their
words of at least ``INDEXED_LENGTH`` characters are indexed with their positions.

1. One pass over the texts stores the places of indexed words (an ``IN`` filter
   inside the exploded word stream); all else works on that small table.  The
   number of files that have a word is its document frequency; the fewer, the
   higher its IDF.
2. Look-up: a phrase is proposed at the places of its highest-IDF word, its
   anchor.  A notice is proposed at the places of each file's ``FILE_WORDS``
   highest-IDF notice words: every posting of such a word proposes a template and
   an alignment, file position less template position.
3. Intersection: each proposal's other postings are looked for at that relative
   position.  A phrase needs all of them, a notice ``SHARE`` percent.
4. Verification: a notice counts only if its mandatory key phrase stands in the
   file, whole and at its place in the alignment.

Phrases are exact whatever the file, as a phrase's place has its anchor.  The rule
for notices is the one above: a notice whose rare words are all rarer elsewhere in
the same file than its own is not proposed.

Defined results: null text is empty; every input row gets its row, repeated rows
too; files without licence words get zero places, null positions, empty labels.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelpulse.llm.common import alnum_words, stored

INDEXED_LENGTH = 7
FILE_WORDS = 8
SHARE = 60
# Phrases as (label, base?, words).  "_" is a place whose word
# is not looked at.  The first four are the base phrases.
TEMPLATES = [
    ("gpl", True, "gnu general public license"),
    ("apache", True, "apache license"),
    ("cc-by", True, "cc by"),
    ("mit", True, "mit license"),
    ("lgpl", False, "gnu lesser general public license"),
    ("agpl", False, "gnu affero general public license"),
    ("mpl", False, "mozilla public license"),
    ("epl", False, "eclipse public license"),
    ("isc", False, "isc license"),
    ("bsd", False, "bsd license"),
    ("bsd", False, "redistribution _ use _ source _ binary forms"),
    ("mit", False, "permission _ hereby granted free _ charge"),
    ("apache-2.0", False, "apache license version 2 0"),
    ("cc-by-sa", False, "cc by sa"),
    ("cc-by-nc", False, "cc by nc"),
    ("cc-by-nd", False, "cc by nd"),
    ("cc0", False, "cc0"),
    ("creative-commons", False, "creative commons"),
    ("unlicense", False, "released into _ public domain"),
    ("all-rights-reserved", False, "all rights reserved"),
    ("isc", False, "permission _ use copy modify _ _ distribute"),
    ("zlib", False, "altered source versions must _ plainly marked"),
]
# Licence notices as (label, key phrase, text).
NOTICES = [
    ("mit-text", "permission _ hereby granted free _ charge", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("bsd-text", "redistribution _ use _ source _ binary forms", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution."""),
    ("isc-text", "permission _ use copy modify _ _ distribute", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS."""),
    ("apache-2.0-text", "apache license version 2 0", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License."""),
    ("gpl-text", "gnu general public license", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
        even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("mpl-text", "mozilla public license", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("zlib-text", "altered source versions must _ plainly marked", """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
        for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
        following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you
        wrote the original software. 2. Altered source versions must be plainly marked as such, and must not be
        misrepresented as being the original software."""),
    ("unlicense-text", "released into _ public domain", """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""),
]


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def postings(templates=TEMPLATES) -> list[tuple]:
    """(template, label, base, word, tpos, n) rows of the phrases."""
    rows = []
    for t, (label, base, phrase) in enumerate(templates):
        words = [(i, w) for i, w in enumerate(phrase.split()) if w != "_"]
        rows += [(t, label, base, w, i, len(words)) for i, w in words]
    return rows


def notice_postings(notices=NOTICES, templates=TEMPLATES) -> list[tuple]:
    """(notice, label, word, tpos, n, key, key_at) rows of the notices: ``key`` is the
    template number of the key phrase and ``key_at`` its place in the notice."""
    number = {phrase: t for t, (_, _, phrase) in reversed(list(enumerate(templates)))}
    rows = []
    for n, (label, key, text) in enumerate(notices):
        words, want = words_of(text), key.split()
        at = next(i for i in range(len(words)) if all(w in ("_", x) for w, x in zip(want, words[i:], strict=False))
                  and i + len(want) <= len(words))
        indexed = [(i, w) for i, w in enumerate(words) if len(w) >= INDEXED_LENGTH]
        rows += [(n, label, w, i, len(indexed), number[key], at) for i, w in indexed]
    return rows


def _values(rows: list[tuple]) -> str:
    def text(v):
        return f"'{v}'" if isinstance(v, str) else str(v).lower()

    return ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)


def index_tables(spark, templates=TEMPLATES, notices=NOTICES) -> tuple[DataFrame, DataFrame]:
    """Both indexes as DataFrames, one row per posting: as many as the templates have
    words."""
    phrases = spark.sql(f"SELECT * FROM VALUES {_values(postings(templates))} AS "
                        "p(template, label, base, word, tpos, n_indexed)")
    texts = spark.sql(f"SELECT * FROM VALUES {_values(notice_postings(notices, templates))} AS "
                      "p(notice, label, word, tpos, n_indexed, key, key_at)")
    return phrases, texts


def licence_word_places(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Stored table (rid, doc_id, n_words, pos, word): the places of licence
    words, and one row with pos -1 per input row."""
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                           alnum_words(F.col(text_col)).alias("words"))
    exploded = numbered.select("rid", "doc_id", F.size("words").cast("long").alias("n_words"),
                               F.posexplode(F.concat(F.array(F.lit("")), "words")).alias("at", "word"))
    return stored(
        exploded.filter((F.col("at") == 0) | F.col("word").isin(vocabulary))
        .select("rid", "doc_id", "n_words", (F.col("at") - 1).cast("long").alias("pos"), "word"),
        "license_words")


def document_frequency(places: DataFrame) -> DataFrame:
    """(word, df) of the indexed words that occur, one row each."""
    return stored(places.filter("pos >= 0").select("rid", "word").distinct().groupBy("word").agg(
        F.count("*").alias("df")), "license_df")


def _intersected(proposed: DataFrame, words: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """(rid, key, start, matched) of proposals: how many postings stand in place."""
    expected = proposed.join(F.broadcast(index.select(key, "word", "tpos")), key).select(  # one row per template word
        "rid", key, "start", "word", (F.col("start") + F.col("tpos")).alias("pos"))
    return expected.join(words, ["rid", "pos", "word"]).groupBy("rid", key, "start").agg(F.count("*").alias("matched"))


def phrase_matches(places: DataFrame, df: DataFrame, index: DataFrame) -> DataFrame:
    """Stored places of phrases: rid, template, label, base, start."""
    words = places.filter("pos >= 0").select("rid", "pos", "word")
    rarest = Window.partitionBy("template").orderBy("df", "tpos")
    # a phrase with a word that no file has is nowhere
    anchors = (index.join(df, "word").withColumn("at", F.row_number().over(rarest)).filter("at = 1")
               .select("template", "word", "tpos"))
    proposed = words.join(F.broadcast(anchors), "word").select(  # one row per phrase
        "rid", "template", (F.col("pos") - F.col("tpos")).alias("start"))
    whole = index.select("template", "label", "base", "n_indexed").distinct()
    return stored(_intersected(proposed, words, index, "template").join(F.broadcast(whole), "template")
                  .filter("matched = n_indexed").select("rid", "template", "label", "base", "start"), "license_phrases")


def notice_matches(places: DataFrame, df: DataFrame, index: DataFrame, phrases: DataFrame) -> DataFrame:
    """Stored places of notices: rid, notice, label, start."""
    words = places.filter("pos >= 0").select("rid", "pos", "word")
    vocabulary = F.broadcast(index.select("word").distinct().join(df, "word"))  # words of the notices
    rank = Window.partitionBy("rid").orderBy("df", "word")
    rare = (words.join(vocabulary, "word").select("rid", "word", "df").distinct()
            .withColumn("at", F.row_number().over(rank)).filter(F.col("at") <= FILE_WORDS).select("rid", "word"))
    proposed = stored(
        words.join(rare, ["rid", "word"]).join(F.broadcast(index.select("notice", "word", "tpos")), "word")
        .select("rid", "notice", (F.col("pos") - F.col("tpos")).alias("start")).distinct(), "license_proposals")
    whole = index.select("notice", "label", "n_indexed", "key", "key_at").distinct()
    near = (_intersected(proposed, words, index, "notice").join(F.broadcast(whole), "notice")
            .filter(100 * F.col("matched") >= SHARE * F.col("n_indexed"))
            .withColumn("key_start", F.col("start") + F.col("key_at")))
    keys = phrases.select("rid", F.col("template").alias("key"), F.col("start").alias("key_start"))
    return stored(near.join(keys, ["rid", "key", "key_start"], "left_semi").select("rid", "notice", "label", "start"),
                  "license_notices")


def scan(docs: DataFrame, templates=TEMPLATES, notices=NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels (sorted arrays), notices (labels of whole licence notices),
    score.  The score is 0 without a match, else 0.5 plus half of ten times the
    matches per word, 1 at most."""
    phrase_index, notice_index = index_tables(docs.sparkSession, templates, notices)
    vocabulary = sorted({r[3] for r in postings(templates)} | {r[2] for r in notice_postings(notices, templates)})
    places = licence_word_places(docs, vocabulary, id_col, text_col)
    df = document_frequency(places)
    phrases = phrase_matches(places, df, phrase_index)
    texts = notice_matches(places, df, notice_index, phrases)
    found = phrases.select("rid", "label", "base", "start", F.lit(False).alias("notice")).unionByName(
        texts.select("rid", "label", F.lit(False).alias("base"), "start", F.lit(True).alias("notice")))
    base_start = F.when(F.col("base"), F.col("start"))
    per_file = found.groupBy("rid").agg(
        F.count(base_start).alias("n_base"), F.min(base_start).alias("first_word"),
        F.max(base_start).alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.array_sort(F.collect_set(F.when(F.col("notice"), F.col("label")))).alias("notices"),
        F.count("*").alias("n_places"))
    files = places.filter("pos < 0").select("rid", "doc_id", "n_words")
    none = F.array().cast("array<string>")
    places_share = F.least(F.lit(1.0), F.col("n_places") * 10 / F.greatest("n_words", F.lit(1)))
    return files.join(per_file, "rid", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("notices", none).alias("notices"),
        F.when(F.col("n_places").isNull(), F.lit(0.0)).otherwise(0.5 + places_share / 2).alias("score"))


def op8_license_index(spark, sf_dir: str) -> DataFrame:
    """License phrases in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs)
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
        "score")


def _oracle() -> str:
    return rf"""
WITH p(template, label, base, word, tpos, n_indexed) AS (VALUES {_values(postings())}),
q(notice, label, word, tpos, n_indexed, key, key_at) AS (VALUES {_values(notice_postings())}),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
x AS (SELECT rid, unnest(w) AS word, unnest(generate_series(0, len(w) - 1)) AS pos FROM d),
m AS (SELECT rid, template, label, base, pos - tpos AS start
      FROM x JOIN p USING (word) GROUP BY rid, template, label, base, pos - tpos, n_indexed
      HAVING count(*) = n_indexed),
-- notices: proposed by each file's rarest notice words, enough words in place, key phrase in place
nw AS (SELECT rid, pos, word FROM x WHERE word IN (SELECT word FROM q)),
df AS (SELECT word, count(DISTINCT rid) AS df FROM nw GROUP BY word),
rare AS (SELECT rid, word FROM (SELECT DISTINCT rid, word, df FROM nw JOIN df USING (word))
         QUALIFY row_number() OVER (PARTITION BY rid ORDER BY df, word) <= {FILE_WORDS}),
proposed AS (SELECT DISTINCT rid, notice, pos - tpos AS start FROM nw JOIN rare USING (rid, word) JOIN q USING (word)),
aligned AS (SELECT rid, notice, label, key, key_at, pos - tpos AS start
            FROM nw JOIN q USING (word) GROUP BY rid, notice, label, key, key_at, pos - tpos, n_indexed
            HAVING 100 * count(*) >= {SHARE} * n_indexed),
notices AS (SELECT a.rid, a.label, a.start FROM aligned a JOIN proposed USING (rid, notice, start)
            JOIN m ON m.rid = a.rid AND m.template = a.key AND m.start = a.start + a.key_at),
every AS (SELECT rid, label, base, start FROM m UNION ALL SELECT rid, label, false, start FROM notices),
f AS (SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
             max(start) FILTER (base) AS last_word, count(*) AS n_places,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM every GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_places IS NULL THEN 0.0::DOUBLE
            ELSE 0.5 + least(1.0::DOUBLE, n_places * 10 / greatest(len(w), 1)::DOUBLE) / 2 END AS score
FROM d LEFT JOIN f USING (rid)
"""


ORACLE_OP8 = _oracle()
