"""License scans with a positional index of rare license words.

Templates are license texts or notices. The index holds, for each template, its RARE words of
highest inverse document frequency over the scanned corpus, with their positions. A file looks up
those that it has; a hit at file position p of a word at template position q votes for the template
starting at p - q, with the word's weight. The best start's share of the template's indexed weight
is its score. A template counts as found when its share reaches MIN_SHARE and all its mandatory
key phrases stand in the file.

The templates, and so the index, are a fixed small list; no other data is broadcast. Everything is
DataFrame functions; only files that have an indexed word are looked at word by word.

Defined cases: a null or empty text has no words, labels '' and score 0; rows of equal id and text
get equal results; a null id is kept; a very long text is searched whole, as one string of its row; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE, MIN_SHARE = 4, 0.6


class Template(NamedTuple):
    """``text`` and ``keys`` are words with single blanks between."""

    label: str
    text: str
    keys: tuple[str, ...]


# The contract's phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of well-known licenses, as words.
TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        ("permission is hereby granted free of charge",),
    ),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template(
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license",
        ("gnu general public license",),
    ),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("redistribution and use in source and binary forms",),
    ),
    Template("mpl", "subject to the terms of the mozilla public license", ("mozilla public license",)),
)

_UPPER, _LOWER = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
_OTHER = "".join(chr(c) for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))


def words_of(text: Column) -> Column:
    """A-Z lower-cased, cut at ASCII characters that are neither letters nor digits."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _OTHER, _LOWER + " " * len(_OTHER))
    return F.array_remove(F.split(plain, " "), "")


def phrase_columns(words: str, joined: str, phrases: dict[str, str]) -> list[Column]:
    """n_base, first_word, last_word and base_labels, from the words and their text with blanks around."""
    line = F.col(joined)
    count, first, last, labels = [], [], [], []
    blanks = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    for phrase, label in phrases.items():
        own = f" {phrase} "
        there = F.contains(line, F.lit(own))
        count.append(F.when(there, F.regexp_count(line, F.lit(f"(?= {phrase} )"))).otherwise(0))
        first.append(F.when(there, blanks(F.substring_index(line, own, 1))))
        last.append(F.when(there, F.size(words) - blanks(F.substring_index(line, own, -1)) - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    found = F.array_compact(F.array_sort(F.array_distinct(F.array(*labels))))
    return [
        reduce(lambda a, b: a + b, count).cast("long").alias("n_base"),
        F.least(*first).cast("long").alias("first_word"),
        F.greatest(*last).cast("long").alias("last_word"),
        found.alias("base_labels"),
    ]


def word_weights(words: DataFrame, vocabulary: Sequence[str]) -> dict[str, float]:
    """Inverse document frequency of each word over all rows of ``words``; runs a job."""
    known = F.array(*map(F.lit, vocabulary))
    rows = words.count()
    has = words.select(F.explode(F.array_intersect(known, "words")).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in has.collect()}
    return {w: math.log((rows + 1) / (counts.get(w, 0) + 1)) + 1e-3 for w in vocabulary}


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    phrases: dict[str, str] = BASE,
    rare: int = RARE,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """The contract's columns for every row of ``docs``; runs a job for the word weights."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("_hash"), words_of(F.col(text_col)).alias("words")
    )
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    weight = word_weights(rows, vocabulary)
    postings, total = [], []
    for k, t in enumerate(templates):
        own = t.text.split()
        indexed = sorted(set(own), key=lambda w: (-weight[w], w))[:rare]
        postings += [(w, k, q, weight[w]) for q, w in enumerate(own) if w in indexed]
        total.append(sum(weight[w] for w in own if w in indexed))
    index = spark.createDataFrame(postings, "_term string, _template int, _at int, _weight double")
    indexed = F.array(*[F.lit(w) for w in sorted({p[0] for p in postings})])

    line = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    near = rows.where(F.arrays_overlap("words", indexed)).withColumn("_line", line)
    has_keys = [reduce(lambda a, b: a & b, [F.contains("_line", F.lit(f" {key} ")) for key in t.keys]) for t in templates]
    verified = F.array_compact(F.array(*[F.when(has, F.lit(k)) for k, has in enumerate(has_keys)]))
    # The templates to look for come first, so that phrases are sought once in a file, not at every word.
    sought = near.select("doc_id", "_hash", "words", F.explode(verified).alias("_of"))
    hits = sought.select("doc_id", "_hash", "_of", F.posexplode("words").alias("_pos", "_word")).join(
        F.broadcast(index), (F.col("_word") == F.col("_term")) & (F.col("_of") == F.col("_template"))
    )
    start = F.col("_pos") - F.col("_at")
    # A vote once per template position, also where one text stands in repeated rows.
    votes = hits.groupBy("doc_id", "_hash", "_template", start.alias("_start"), "_at").agg(F.max("_weight").alias("_weight"))
    starts = votes.groupBy("doc_id", "_hash", "_template", "_start").agg(F.sum("_weight").alias("_vote"))
    share = F.least(F.lit(1.0), F.col("_vote") / F.array(*map(F.lit, total))[F.col("_template")])
    label = F.array(*[F.lit(t.label) for t in templates])[F.col("_template")]
    found = (
        starts.select("doc_id", "_hash", share.alias("_share"), label.alias("_label"))
        .groupBy("doc_id", "_hash")
        .agg(F.max("_share").alias("_score"), F.collect_set(F.when(F.col("_share") >= min_share, F.col("_label"))).alias("_labels"))
        .withColumnsRenamed({"doc_id": "_id", "_hash": "_of"})
    )
    base = rows.withColumn("_line", F.when(F.arrays_overlap("words", F.array(*[F.lit(p.split()[-1]) for p in phrases])), line).otherwise(""))
    base = base.select("doc_id", "_hash", F.size("words").cast("long").alias("n_words"), *phrase_columns("words", "_line", phrases))
    joined = base.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of")), "left")
    every = F.array_sort(F.array_union("base_labels", F.coalesce("_labels", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.coalesce("_score", F.lit(0.0)).alias("score"),
    )
