"""Licence notices found by a positional index of rare words.

Words are runs of letters and digits, A-Z lower-cased (`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`).
The index holds, for every template, its words with their positions.

1. Document frequencies of the template words are counted over all documents; a
   word's weight is the bits of N div df, an inverse document frequency in whole
   numbers (equal wherever it is computed).
2. The index posts the `lookups` heaviest words of each template, with all their places in
   it.  A file looks up those it contains; with fewer than `agree` of them (or than the
   template has words) the template is out.
3. Each place of a looked-up word meets the word's postings: place minus posting is
   the relative position at which the template would start.  A start counts if `agree`
   looked-up words agree on it
4. and the template's key phrase stands whole at its place.

The score of a start is the weight of all template words that stand in place, as a share
of the whole template's; a file's score is its best.  Only DataFrame functions; no text is
shuffled, only places of rare words whose key phrase stood beside them.  Template words
reach the plans as literals: their number is that of the templates, a parameter, not of
the data.

Defined cases: a NULL or empty text has no words, no labels and score 0; rows alike in id
and text have equal results, each its own row; rows with one id and different texts
are judged apart; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.llm.frames import stored

# Phrases that are labels by themselves.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@dataclass(frozen=True)
class Template:
    """A notice: its label, its words, and the phrase of it that must stand in place."""

    label: str
    text: str
    key: str

    @property
    def words(self) -> list[str]:
        return self.text.split(" ")

    @property
    def key_at(self) -> int:
        """Words before the key phrase."""
        size = self.key.count(" ") + 1
        return next(i for i in range(len(self.words)) if self.words[i : i + size] == self.key.split(" "))


# Opening words of public licence notices.
TEMPLATES = (
    Template("gpl", "gnu general public license", "gnu general public license"),
    Template("apache", "apache license", "apache license"),
    Template("cc-by", "cc by", "cc by"),
    Template("mit", "mit license", "mit license"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-header", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
             "free software you can redistribute it"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4"),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    Template("mit-release", "released under the mit license", "under the mit license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
             "permission is hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
             "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             "distribute this software for any purpose"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)

LOOKUPS, AGREE = 4, 3
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spaced_words(text: Column) -> Column:
    """The words of a text with one space between them.

    U+212A (the Kelvin sign) is the one other character that `lower` turns into an
    ASCII letter, so it is put out of the way first.
    """
    lower = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.trim(F.regexp_replace(lower, _GAPS, " "))


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _places(padded: Column, phrase: str) -> tuple[Column, Column, Column]:
    """How often a phrase stands in ' w0 w1 ... ', and the words before its first and its last place (NULL without one)."""
    whole = f" {phrase} "
    found = F.contains(padded, F.lit(whole))
    first = F.locate(whole, padded)
    last = F.length(padded) - F.locate(whole[::-1], F.reverse(padded)) - len(whole) + 2
    before = lambda at: F.when(found, _spaces(F.substring(padded, F.lit(1), at - 1)).cast("bigint"))
    count = F.when(found, F.regexp_count(padded, F.lit(f" (?={phrase} )")).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return count, before(first), before(last)


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scanned_words(docs: DataFrame, templates: tuple[Template, ...], phrases: dict[str, str], doc: str, text: str) -> DataFrame:
    """doc_id, text_id, n_words, n_base, first_word, last_word, base (labels), present (the template words it holds)."""
    vocabulary = sorted({w for t in templates for w in t.words})
    rows = docs.select(F.col(doc).alias("doc_id"), F.md5(F.col(text).cast("binary")).alias("text_id"), spaced_words(F.col(text)).alias("t"))
    rows = rows.select("*", F.concat(F.lit(" "), "t", F.lit(" ")).alias("padded"))
    found = [(label, *_places(F.col("padded"), phrase)) for phrase, label in sorted(phrases.items())]
    nothing = F.lit(None).cast("bigint")
    base = F.filter(F.array(*[F.when(count > 0, F.lit(label)) for label, count, _, _ in found]), lambda x: x.isNotNull()) if found else _strings([])
    return rows.select(
        "doc_id", "text_id", F.when(F.col("t") == "", 0).otherwise(_spaces(F.col("t")) + 1).cast("bigint").alias("n_words"),
        sum((count for _, count, _, _ in found), F.lit(0).cast("bigint")).alias("n_base"),
        F.array_min(F.array(nothing, *[a for _, _, a, _ in found])).alias("first_word"),
        F.array_max(F.array(nothing, *[b for _, _, _, b in found])).alias("last_word"),
        base.alias("base"), F.array_intersect(F.split("t", " "), _strings(vocabulary)).alias("present"))


def word_weights(scanned: DataFrame) -> dict[str, int]:
    """Weight of each template word that occurs: bits of N div df over all rows (as many entries as the templates have words)."""
    total = scanned.count()
    counts = scanned.select(F.explode("present").alias("word")).groupBy("word").count()
    return {r["word"]: (total // r["count"]).bit_length() for r in counts.collect()}


def _index_words(template: Template, weights: dict[str, int], lookups: int) -> list[str]:
    """The heaviest words of a template that occur at all."""
    return sorted(set(template.words) & set(weights), key=lambda w: (-weights[w], w))[:lookups]


def _postings(spark: SparkSession, templates: tuple[Template, ...], weights: dict[str, int], lookups: int) -> DataFrame:
    """word, place, template, and the template's words with their weights: a row per posting of the index."""
    rows = []
    for n, t in enumerate(templates):
        whole = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(weights.get(w, 0)).alias("weight")) for w in t.words])
        few = set(_index_words(t, weights, lookups))
        rows += [F.struct(F.lit(w).alias("word"), F.lit(i).alias("place"), F.lit(n).alias("template"), whole.alias("whole"), F.lit(t.key_at).alias("key_at"), F.lit(t.key).alias("key"))
                 for i, w in enumerate(t.words) if w in few]
    if not rows:
        return spark.range(0).selectExpr("'' AS word", "0 AS place", "0 AS template", "array(named_struct('word', '', 'weight', 0)) AS whole", "0 AS key_at", "'' AS key")
    return spark.range(1).select(F.inline(F.array(*rows)))


def notices(
    docs: DataFrame, weights: dict[str, int], templates: tuple[Template, ...] = TEMPLATES, lookups: int = LOOKUPS, agree: int = AGREE,
    doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Notices whose key phrase stands in place: doc_id, text_id, template, start (word), score.

    One pass: a file's words are looked at in its own row, and only starts leave it.  Files
    out of play explode to nothing (no filter, which Spark would push below the arrays it
    reads and so compute them twice).
    """
    few = [_index_words(t, weights, lookups) for t in templates]
    least = [min(agree, len(set(t.words))) for t in templates]
    none = _strings([])
    rows = docs.select(F.col(doc).alias("doc_id"), F.md5(F.col(text).cast("binary")).alias("text_id"), F.split(spaced_words(F.col(text)), " ").alias("words"))
    rows = rows.select("*", F.array_intersect("words", _strings(sorted({w for ws in few for w in ws}))).alias("present"))
    rows = rows.select("doc_id", "text_id", "words", *[F.array_intersect(_strings(ws), F.col("present")).alias(f"held{n}") for n, ws in enumerate(few)])
    inside = [F.size(f"held{n}") >= k for n, k in enumerate(least)]
    wanted = F.flatten(F.array(none, *[F.when(inside[n], F.col(f"held{n}")).otherwise(none) for n in range(len(templates))]))
    rows = rows.select("doc_id", "text_id", "words", F.array_distinct(wanted).alias("wanted"), F.array(*inside).alias("in_play"))
    some = F.when(F.size("wanted") > 0, F.col("words"))
    places = rows.select("doc_id", "text_id", "words", "wanted", "in_play", F.posexplode_outer(some).alias("at", "w")).where(F.array_contains("wanted", F.col("w")))
    hits = places.join(F.broadcast(_postings(docs.sparkSession, templates, weights, lookups)), F.col("w") == F.col("word")).where(F.col("in_play")[F.col("template")])
    hits = hits.withColumn("start", F.col("at") - F.col("place"))
    first = F.col("start") + F.col("key_at")
    length = F.size(F.split("key", " "))
    hits = hits.where((first >= 0) & (F.array_join(F.slice("words", F.greatest(first, F.lit(0)) + 1, length), " ") == F.col("key")))
    # Out of bounds is NULL, which is no word.
    standing = F.transform("whole", lambda x, i: F.when(F.get("words", F.col("start") + i) == x["word"], x["weight"]).otherwise(0))
    summed = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    score = summed(standing) / summed(F.transform("whole", lambda x: x["weight"]))
    # A row alike in id and text gives the same hits again: they count once.
    hits = hits.select("doc_id", "text_id", "template", "start", "place", score.alias("score")).distinct()
    starts = hits.groupBy("doc_id", "text_id", "template", "start").agg(F.count("*").alias("agreeing"), F.max("score").alias("score"))
    enough = F.element_at(F.array(*[F.lit(k) for k in least]), F.col("template") + 1)
    return starts.where(F.col("agreeing") >= enough).select("doc_id", "text_id", "template", "start", "score")


def scan_licenses(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, phrases: dict[str, str] = PHRASES, lookups: int = LOOKUPS, agree: int = AGREE,
    doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    scanned = stored(scanned_words(docs, templates, phrases, doc, text), "license-words")
    weights = word_weights(scanned)
    names = _strings([t.label for t in templates])
    found = notices(docs, weights, templates, lookups, agree, doc, text).groupBy(F.col("doc_id").alias("d"), F.col("text_id").alias("i")).agg(
        F.collect_set(F.element_at(names, F.col("template") + 1)).alias("more"), F.max("score").alias("best"))
    # A NULL text has no text_id and nothing to find.
    out = scanned.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_id") == F.col("i")), "left")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", _joined(F.col("base")).alias("base_labels"),
        _joined(F.concat("base", F.coalesce("more", _strings([])))).alias("labels"), F.coalesce("best", F.lit(0.0)).alias("score"))
