"""License scans: an exact set-similarity join of text blocks with license templates, in DataFrame functions only.

A block is a window of consecutive words, wherever lines end: for a template of up to L words (a power of two), windows of
2 L words begin at every L-th one, so a notice stands whole in one of them. A block's set holds its distinct words. A block
matches a template when it contains at least the threshold of the template's distinct words, the words that name the
license among them. Words are ordered by their frequency over all documents, rarest first. A matching block must hold one
of a template's first words in that order (prefix), enough template words at all (length), and enough of them after the
first one shared (position); what is left is counted. Words that no template has can't add to an overlap, so lengths and
positions are those of the block's template words.

Texts are read once: a scratch table keeps each row's counts and the places of its template words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mossgrid.llm.common import kept

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
#: Phrases whose places are counted, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices and texts of public licenses, lower-case words only, with the words that name the license (a long text needs none).
TEMPLATES = (
    ("mit", "mit", "released under the mit license"),
    ("mit", "mit", "licensed under the mit license"),
    ("apache", "apache", "licensed under the apache license version 2 0"),
    ("gpl", "gnu", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "gnu", "released under the gnu general public license"),
    ("lgpl", "lesser", "licensed under the gnu lesser general public license"),
    ("cc-by-nc", "cc nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "noncommercial", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "sharealike", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    (
        "mpl",
        "mozilla",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    ),
    (
        "apache",
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless "
        "required by applicable law or agreed to in writing software distributed under the license is distributed on "
        "an as is basis without warranties or conditions of any kind either express or implied see the license for "
        "the specific language governing permissions and limitations under the license",
    ),
    (
        "gpl",
        "gnu",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version this program is distributed in the hope that it will be useful but without any "
        "warranty without even the implied warranty of merchantability or fitness for a particular purpose see the "
        "gnu general public license for more details you should have received a copy of the gnu general public "
        "license along with this program if not see http www gnu org licenses",
    ),
    (
        "mit",
        "",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "software the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no "
        "event shall the authors or copyright holders be liable for any claim damages or other liability whether in "
        "an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software",
    ),
    (
        "mit",
        "charge",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    (
        "isc",
        "",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies the "
        "software is provided as is and the author disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness in no event shall the author be liable for any special "
        "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or "
        "profits whether in an action of contract negligence or other tortious action arising out of or in connection "
        "with the use or performance of this software",
    ),
    (
        "bsd",
        "",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met redistributions of source code must retain the above copyright notice this "
        "list of conditions and the following disclaimer redistributions in binary form must reproduce the above "
        "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution this software is provided by the copyright holders and contributors "
        "as is and any express or implied warranties including but not limited to the implied warranties of "
        "merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder "
        "or contributors be liable for any direct indirect incidental special exemplary or consequential damages "
        "including but not limited to procurement of substitute goods or services loss of use data or profits or "
        "business interruption however caused and on any theory of liability whether in contract strict liability or "
        "tort including negligence or otherwise arising in any way out of the use of this software even if advised of "
        "the possibility of such damage",
    ),
    (
        "zlib",
        "",
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software permission is granted to anyone to use this "
        "software for any purpose including commercial applications and to alter it and redistribute it freely "
        "subject to the following restrictions the origin of this software must not be misrepresented you must not "
        "claim that you wrote the original software if you use this software in a product an acknowledgment in the "
        "product documentation would be appreciated but is not required altered source versions must be plainly "
        "marked as such and must not be misrepresented as being the original software this notice may not be removed "
        "or altered from any source distribution",
    ),
    (
        "unlicense",
        "",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish "
        "use compile sell or distribute this software either in source code form or as a compiled binary for any "
        "purpose commercial or non commercial and by any means",
    ),
)
ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
#: Columns that the operator adds for itself; tables can't have them.
INSIDE = frozenset("_row _words _at _hits _more _best".split())


class Template:
    """A template's distinct words, the least overlap, and its block length."""

    def __init__(self, label: str, names: str, text: str, threshold: float) -> None:
        self.label, self.names, self.words = label, sorted(set(names.split())), sorted(set(text.split()))
        self.least = math.ceil(threshold * len(self.words))
        self.block = 1 << (len(text.split()) - 1).bit_length()


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def lowered(text: Column) -> Column:
    """A-Z lower-cased. lower() also maps other letters, but of these only two to A-Z; they are put aside first, so words and their A-Z letters are the same."""
    return F.lower(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("İ"), F.lit("")), F.lit("K"), F.lit("")))


def places(words: Column, phrase: str) -> Column:
    """Starts of a phrase's words, from 0. Rows without its first or last word aren't searched."""
    parts = phrase.split()
    here = lambda i: [F.get(words, i + k) == p for k, p in enumerate(parts)]

    def all_of(i: Column) -> Column:
        out = F.lit(True)
        for x in here(i):
            out = out & F.coalesce(x, F.lit(False))
        return out

    found = F.filter(F.sequence(F.lit(0), F.size(words) - 1), all_of)
    return F.when(F.array_contains(words, parts[0]) & F.array_contains(words, parts[-1]), found).otherwise(F.array().cast("array<int>"))


def noted_words(df: DataFrame, text: str, templates: list[Template]) -> DataFrame:
    """The rows without their text, with numbers of their own (_row), counts, base results, and places and names of template words (_at, _hits). A table."""
    vocabulary = sorted({w for t in templates for w in t.words})
    keep = [F.col(f"`{c}`") for c in df.columns if c != text]
    split = df.select(*keep, words_of(lowered(F.col(text))).alias("_words"))
    none = F.array().cast("array<int>")
    at = F.when(F.size("_words") > 0, F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda i: F.get("_words", i).isin(vocabulary))).otherwise(none)
    found = split.select(*keep, "_words", at.alias("_at"), F.array(*(places(F.col("_words"), p) for p in PHRASES)).alias("_spots"))
    every = F.flatten("_spots")
    own = F.array_compact(F.array(*(F.when(F.size(F.col("_spots")[k]) > 0, F.lit(x)) for k, x in enumerate(PHRASES.values()))))
    base = [F.size("_words").cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), own.alias("base_labels")]
    noted = found.select(*keep, *base, "_at", F.transform("_at", lambda i: F.get("_words", i)).alias("_hits"))
    return kept(noted.withColumn("_row", F.monotonically_increasing_id()), "licenses")


def template_matches(noted: DataFrame, templates: list[Template]) -> DataFrame:
    """(_row, label, containment) of every block that meets a template's threshold and holds its names. Only counts of template words come to the driver."""
    spark = noted.sparkSession
    counts = {r.w: r.n for r in noted.select(F.explode("_hits").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    order = sorted({w for t in templates for w in t.words}, key=lambda w: (counts.get(w, 0), w))
    index = [(k, t.label, t.block, t.least, sorted(t.words, key=order.index), t.names) for k, t in enumerate(templates)]
    prefix = [(w, k, i, len(words), least, block) for k, _, block, least, words, _ in index for i, w in enumerate(words[: len(words) - least + 1])]
    starts = F.array(*map(F.lit, sorted({p[0] for p in prefix})))
    rare = spark.createDataFrame(prefix, "w string, template int, i int, size int, least int, block int")
    full = spark.createDataFrame([(k, label, words, names) for k, label, _, _, words, names in index], "template int, label string, words array<string>, names array<string>")
    lengths = F.array(*map(F.lit, sorted({t.block for t in templates})))
    hits = noted.where(F.arrays_overlap("_hits", starts)).select("_row", F.explode(F.arrays_zip("_at", "_hits")).alias("h")).select("_row", F.col("h._at").alias("at"), F.col("h._hits").alias("w"))
    begins = F.filter(F.array(F.floor(F.col("at") / F.col("block")), F.floor(F.col("at") / F.col("block")) - 1), lambda b: b >= 0)
    blocks = hits.select("_row", "w", "at", F.explode(lengths).alias("block")).select("_row", "w", "block", F.explode(begins).alias("begin"))
    own = blocks.groupBy("_row", "block", "begin").agg(F.collect_set("w").alias("own")).where(F.arrays_overlap("own", starts))
    own = own.withColumn("own", F.array_intersect(F.array(*map(F.lit, order)), "own"))
    met = own.select("_row", "block", "begin", "own", F.posexplode("own").alias("j", "w")).join(F.broadcast(rare), ["w", "block"])
    ahead = F.least(F.col("size") - F.col("i"), F.size("own") - F.col("j"))
    candidates = met.where((F.size("own") >= F.col("least")) & (ahead >= F.col("least"))).groupBy("_row", "begin", "template", "size", "least").agg(F.first("own").alias("own"))
    counted = candidates.join(F.broadcast(full), "template").withColumn("shared", F.size(F.array_intersect("own", "words")))
    named = F.size(F.array_except("names", "own")) == 0
    return counted.where((F.col("shared") >= F.col("least")) & named).select("_row", "label", (F.col("shared") / F.col("size")).alias("containment"))


def scan_licenses(df: DataFrame, text: str = "text", templates: tuple = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels and score to every row, and drops the text.

    Null text is empty: no words, no labels, score 0. score is the best containment of a template, 1 where a phrase stands.
    Rows are numbered and never compared with each other, so repeated rows and equal texts have equal results. Tables may
    be empty. Other columns stay, whatever their names; earlier ones of the added names are replaced, those of INSIDE are
    an error.
    """
    df = df.drop(*ADDED)
    if clash := INSIDE.intersection(df.columns):
        raise ValueError(f"columns {sorted(clash)} are used inside")
    ready = [Template(*t, threshold) for t in templates]
    noted = noted_words(df, text, ready)
    found = template_matches(noted, ready).groupBy("_row").agg(F.collect_set("label").alias("_more"), F.max("containment").alias("_best"))
    joined = noted.drop("_at", "_hits").join(found, "_row", "left")
    label_list = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    labels = label_list(F.concat("base_labels", F.coalesce("_more", F.array().cast("array<string>"))))
    keep = [F.col(f"`{c}`") for c in df.columns if c != text]
    return joined.select(*keep, "n_words", "n_base", "first_word", "last_word", label_list(F.col("base_labels")).alias("base_labels"), labels.alias("labels"), F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))


def sql(table: str = "documents") -> str:
    """The same result in DuckDB's SQL, each block compared with each template."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    ready = [Template(*t, THRESHOLD) for t in TEMPLATES]
    tokens = ", ".join(f"({k}, '{t.label}', '{w}', {len(t.words)}, {t.least}, {t.block}, {len(t.names)}, {int(w in t.names)})" for k, t in enumerate(ready) for w in t.words)
    phrase = lambda p: " AND ".join(f"ws[i + {k + 1}] = '{w}'" for k, w in enumerate(p.split()))
    cases = " ".join(f"WHEN {phrase(p)} THEN '{label}'" for p, label in PHRASES.items())
    return f"""
WITH t(template, label, w, size, least, block, names, name) AS (VALUES {tokens}),
d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS low FROM {table}),
ws AS (SELECT r, doc_id, regexp_extract_all(low, '{WORD}') AS ws FROM d),
spots AS (SELECT r, i, CASE {cases} END AS label FROM (SELECT r, ws, unnest(range(len(ws))) AS i FROM ws)),
base AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_distinct(list(label)) AS own FROM spots WHERE label IS NOT NULL GROUP BY r),
hits AS (SELECT r, unnest(range(len(ws))) AS i, unnest(ws) AS w FROM ws),
blocks AS (SELECT DISTINCT r, w, template, label, size, least, names, name, unnest([i // block, i // block - 1]) AS begin FROM hits JOIN t USING (w)),
hit AS (SELECT r, label, count(*) * 1.0 / any_value(size) AS c FROM blocks WHERE begin >= 0 GROUP BY r, begin, template, label HAVING count(*) >= any_value(least) AND sum(name) = any_value(names)),
more AS (SELECT r, list_distinct(list(label)) AS more, max(c) AS best FROM hit GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
 coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
 array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(more, [])))), ',') AS labels,
 CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM ws LEFT JOIN base USING (r) LEFT JOIN more USING (r)"""
