"""License scan: a positional index of rare licence words, in SQL expressions alone.

Templates are well-known licence notices. How rare each of their words is (IDF) is
counted over all documents. Of each template, the `RARE` rarest words and their
places are the postings. A file's `TOP` words of highest IDF among these are looked up,
and each posting says where the template would begin; a template matches where
enough of its rare words agree on that beginning to within `SLACK` words. Its
mandatory key phrases must stand in the file too.

A file's words stay in its row; only the places of its rare words (few) are
exploded, joined to the postings (fewer than a hundred rows, fixed by the templates)
and counted, and narrow rows without texts are joined back. Rows are told apart by doc_id
and a hash of the text, so rows that share a doc_id (or have a null one) are judged each by its own text.

Besides, fixed phrases are found wherever their words stand consecutively; they give
the base labels and always count.

Defined cases: a null text is empty and has no words; repeated rows are scanned each;
score is 1 for a base phrase, else the best share of a template's rare words found in place, else 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import settle, table

# Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Label, notice, key phrases all of which must stand in a file (lower-cased words).
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ["www apache org licenses license 2 0"]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3", "gnu general public license as published by the free software foundation either version 3 of the license", ["gnu general public license", "version 3 of the license"]),
    ("gpl-2", "gnu general public license as published by the free software foundation either version 2 of the license", ["gnu general public license", "version 2 of the license"]),
    ("lgpl", "gnu lesser general public license as published by the free software foundation", ["gnu lesser general public license"]),
    ("agpl-3", "gnu affero general public license as published by the free software foundation", ["gnu affero general public license"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license v 2 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify", "is hereby granted"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]

RARE = 5
TOP = 64
SLACK = 3
# Of a template's rare words, this share must be in place.
SHARE = 0.8

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_text(text: Column) -> Column:
    """The words of a text, each between two single spaces; a text without words is one space."""
    whole = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(whole) == F.char_length(whole)
    lower = F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, _UPPER, _UPPER.lower()))
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(lower, _SEPARATORS, " ")), F.lit(" "))


def with_words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, words, list): the text of words and the list of them, made once a row."""
    made = docs.select(F.col(doc_id).alias("doc_id"), word_text(F.col(text)).alias("words"))
    # A generator over one struct keeps the optimiser from making the words anew at every use.
    return made.select("doc_id", F.explode(F.array(F.struct("words", F.split(F.btrim("words"), " ").alias("list")))).alias("w")).select(
        "doc_id", "w.words", F.when(F.col("w.words") == "  ", F.array().cast("array<string>")).otherwise(F.col("w.list")).alias("list")
    )


def document_frequencies(worded: DataFrame) -> dict[str, int]:
    """In how many documents each word of the templates stands, and, under "", how many there are."""
    vocabulary = sorted({w for _, notice, _ in TEMPLATES for w in notice.split()})
    held = F.array_intersect("list", F.array(*map(F.lit, vocabulary)))
    words = F.explode(F.concat(held, F.array(F.lit(""))))
    return {r["word"]: r["n"] for r in worded.select(words.alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}


def postings(frequencies: dict[str, int]) -> list[tuple[str, float, int, int, int]]:
    """(word, idf, template, place, number of the template's rare words) of each template's rarest words."""
    total = frequencies.get("", 0)
    idf = lambda w: math.log((total + 1) / (frequencies.get(w, 0) + 1))
    found = []
    for number, (_, notice, _) in enumerate(TEMPLATES):
        words = notice.split()
        rare = sorted(sorted(set(words)), key=lambda w: -idf(w))[:RARE]
        found += [(w, idf(w), number, p, len(rare)) for p, w in enumerate(words) if w in rare]
    return found


def _literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names, strict=True)]) for r in rows])))


def _phrase_places(words: Column, n_words: Column, phrase: str) -> Column:
    """(count, first, last) of the places of a phrase; null where it doesn't stand."""
    parts = F.split(words, f"(?<= ){phrase}(?= )", -1)
    count_in = lambda part: F.octet_length(part) - F.octet_length(F.replace(part, F.lit(" "))) - 1
    after = count_in(F.element_at(parts, -1))
    return F.when(
        F.contains(words, F.lit(f" {phrase} ")),
        F.struct(
            (F.size(parts) - 1).cast("long").alias("count"),
            count_in(F.element_at(parts, 1)).cast("long").alias("first"),
            (n_words - len(phrase.split()) - after).cast("long").alias("last"),
        ),
    )


def _read(worded: DataFrame, index: list[tuple]) -> DataFrame:
    """One narrow row for each file: places of the base phrases, of the rare words, and the verified templates."""
    idf = {w: value for w, value, *_ in index}
    rare = F.filter(
        F.transform("list", lambda w, i: F.when(w.isin(*idf), F.struct(i.alias("at"), w.alias("word")))), lambda s: s.isNotNull()
    )
    verified = [
        F.when(F.forall(F.array(*[F.contains(F.col("words"), F.lit(f" {k} ")) for k in keys]), lambda k: k), F.lit(number))
        for number, (_, _, keys) in enumerate(TEMPLATES)
    ]
    # All words of the index from the rarest on: a file's own are taken in this order.
    order = F.array(*[F.lit(w) for w in sorted(idf, key=lambda w: (-idf[w], w))])
    some = F.arrays_overlap("list", F.array(*map(F.lit, idf)))
    n_words = F.size("list")
    return worded.select(
        "doc_id",
        F.xxhash64("words").alias("h"),
        n_words.cast("long").alias("n_words"),
        *[_phrase_places(F.col("words"), n_words, p).alias(f"base{i}") for i, p in enumerate(BASE)],
        F.when(some, rare).alias("rare"),
        F.when(some, F.slice(F.array_intersect(order, F.col("list")), 1, TOP)).alias("top"),
        F.when(some, F.array_compact(F.array(*verified))).alias("verified"),
    )


def _matches(files: DataFrame, index: list[tuple]) -> DataFrame:
    """(doc_id, h, found): labels and shares of the templates found in each file."""
    spark = files.sparkSession
    lookup = _literal_rows(spark, index, ["word", "idf", "template", "place", "needed"])
    names = _literal_rows(spark, [(n, label) for n, (label, _, _) in enumerate(TEMPLATES)], ["template", "label"])
    spots = files.where(F.size("rare") > 0).select("doc_id", "h", "verified", "top", F.explode("rare").alias("r"))
    chosen = spots.where(F.array_contains("top", F.col("r.word")))
    aligned = chosen.select("doc_id", "h", "verified", "r.word", "r.at").join(F.broadcast(lookup), "word")
    begin = F.col("at") - F.col("place")
    # Windows of 2 SLACK words begin every SLACK words, so begins within SLACK of one another share one.
    window = F.floor(begin / SLACK)
    spread = aligned.where(F.array_contains("verified", F.col("template"))).select(
        "doc_id", "h", "template", "needed", "word", F.explode(F.array(window, window - 1)).alias("window")
    )
    counted = spread.groupBy("doc_id", "h", "template", "needed", "window").agg((F.size(F.collect_set("word")) / F.col("needed")).alias("share"))
    enough = counted.where(F.col("share") >= SHARE).join(F.broadcast(names), "template")
    return enough.groupBy("doc_id", "h").agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per row of `docs`."""
    worded = with_words(docs, doc_id, text)
    index = postings(document_frequencies(worded))
    files = settle(_read(worded, index), "licence-words")
    matched = settle(_matches(files, index), "licences").withColumnsRenamed({"doc_id": "found_id", "h": "found_h"})
    placed = files.join(matched, (F.col("h") == F.col("found_h")) & F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
    bases = [F.col(f"base{i}") for i in range(len(BASE))]
    own = F.array_compact(F.array(*[F.when(b.isNotNull(), F.lit(label)) for b, label in zip(bases, BASE.values(), strict=True)]))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return placed.select(
        "doc_id",
        "n_words",
        sum((F.coalesce(b["count"], F.lit(0)) for b in bases), F.lit(0)).cast("long").alias("n_base"),
        F.least(*[b["first"] for b in bases]).alias("first_word"),
        F.greatest(*[b["last"] for b in bases]).alias("last_word"),
        joined(own).alias("base_labels"),
        joined(F.concat(own, F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size(own) > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
