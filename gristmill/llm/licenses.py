"""Licence scan with a positional rare-token index.

A template is a word sequence with a mandatory key phrase inside.  The
document frequency of every template word is counted over the whole corpus;
each template is filed in the index under the highest-IDF word of its key
phrase, with the word's position.  A file is cut into words, its words are
looked up in the index, and each posting gives a relative position at which the
template may stand: the candidate is kept only if the whole key phrase stands
there.  A key phrase's every place holds its rarest word, so no place is lost
whatever the frequencies.  The score is the share of template words that
agree at their relative positions, over the best verified candidate.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  The base templates
(key phrase = template) make n_base, first_word, last_word and base_labels; all
templates make labels.

Edge cases: null and empty texts have no words, empty labels and score 0;
repeated rows get equal results; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, text_or_empty

#: What separates words (fixed value).
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    key: str  # mandatory phrase
    before: str = ""  # words in front of it
    after: str = ""  # words behind it

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def words(self) -> list[str]:
        return f"{self.before} {self.key} {self.after}".split()

    @property
    def lead(self) -> int:
        return len(self.before.split())


#: Base phrases and their labels (fixed values).
BASE = (
    Template("mit", "mit license"),
    Template("apache", "apache license"),
    Template("gpl", "general public license"),
)

#: Further templates from the public licence texts (fixed values).
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge", after="to any person obtaining a copy of this software"),
    Template("apache", "licensed under the apache license", after="version 2 0"),
    Template("gpl", "terms of the gnu general public license", before="redistribute it and or modify it under the"),
    Template("lgpl", "lesser general public license", before="gnu"),
    Template("agpl", "affero general public license", before="gnu"),
    Template("bsd", "bsd license"),
    Template("bsd", "redistribution and use in source and binary forms", after="with or without modification are permitted"),
    Template("mpl", "mozilla public license", after="version 2 0"),
    Template("epl", "eclipse public license"),
    Template("isc", "isc license"),
    Template("isc", "permission to use copy modify and or distribute this software", after="for any purpose"),
    Template("cc", "creative commons attribution"),
    Template("unlicense", "unencumbered software released into the public domain", before="this is free and"),
)


def words(text_col: str) -> Column:
    return F.array_remove(F.split(ascii_lower(text_or_empty(text_col)), NO_WORD), "")


def _list(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def document_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, int]:
    """Rows that hold each word of a (bounded) vocabulary."""
    present = docs.select(F.explode(F.array_intersect(_list(vocabulary), words(text_col))).alias("word"))
    return {r["word"]: r["n"] for r in present.groupBy("word").agg(F.count("*").alias("n")).collect()}


def rare_position(key_words: list[str], frequency: dict[str, int]) -> int:
    """Position of the highest-IDF word, the first among equals."""
    return min(range(len(key_words)), key=lambda i: (frequency.get(key_words[i], 0), i))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple[Template, ...] = BASE,
         templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, places) per row;
    places lists (label, start, score) of every verified candidate."""
    every = list(base) + list(templates)
    vocabulary = sorted({w for t in every for w in t.key_words})
    frequency = document_frequencies(docs, vocabulary, text_col)
    rare = [rare_position(t.key_words, frequency) for t in every]
    index = sorted({t.key_words[p] for t, p in zip(every, rare)})

    # Positions of index words; only a text that holds one as a substring is walked.
    rows = docs.select(F.col(id_col).alias("id"), ascii_lower(text_or_empty(text_col)).alias("text"))
    rows = rows.select("id", F.array_remove(F.split("text", NO_WORD), "").alias("w"), _any_of("text", index).alias("maybe"))
    spots = F.filter(F.transform("w", lambda w, i: F.when(w.isin(index), F.struct(w.alias("word"), i.alias("at")))),
                     lambda s: s.isNotNull())
    none = F.array().cast("array<struct<word:string,at:int>>")
    rows = rows.select("id", "w", F.size("w").cast("long").alias("n_words"),
                       F.when(F.col("maybe"), spots).otherwise(none).alias("spots"))

    def places(template: Template, position: int) -> Column:
        """(label, start, score) where the key phrase stands."""
        key = template.key_words
        starts = F.transform(F.filter("spots", lambda s: s["word"] == key[position]), lambda s: s["at"] - position)
        whole = F.filter(starts, lambda s: (s >= 0) & F.when(s >= 0, F.slice("w", s + 1, len(key)) == _list(key)))
        return F.transform(whole, lambda s: F.struct(F.lit(template.label).alias("label"), s.cast("long").alias("start"),
                                                     (_agreeing(s, template) / F.lit(float(len(template.words)))).alias("score")))

    def gather(lo: int, hi: int) -> Column:
        return F.concat(*[places(t, p) for t, p in zip(every[lo:hi], rare[lo:hi])]) if hi > lo else none_places

    none_places = F.array().cast("array<struct<label:string,start:bigint,score:double>>")
    n = len(base)
    found = F.size("spots") > 0
    rows = rows.select("id", "n_words", F.when(found, gather(0, n)).otherwise(none_places).alias("base"),
                       F.when(found, gather(n, len(every))).otherwise(none_places).alias("more"))
    rows = rows.withColumn("places", F.concat("base", "more"))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.col(c)["label"])), ",")
    return rows.select(F.col("id").alias(id_col), "n_words", F.size("base").cast("long").alias("n_base"),
                       F.array_min(F.col("base")["start"]).alias("first_word"),
                       F.array_max(F.col("base")["start"]).alias("last_word"),
                       labels("base").alias("base_labels"), labels("places").alias("labels"),
                       F.coalesce(F.array_max(F.col("places")["score"]), F.lit(0.0)).alias("score"), "places")


def _agreeing(start: Column, template: Template) -> Column:
    """Template words that stand at their relative positions; one outside of the text does not."""
    total = F.lit(len(template.key_words))
    for j, word in enumerate(template.words):
        if not 0 <= j - template.lead < len(template.key_words):
            total = total + F.coalesce((F.get("w", start - template.lead + j) == word).cast("int"), F.lit(0))
    return total


def _any_of(text_col: str, index: list[str]) -> Column:
    out = F.lit(False)
    for word in index:
        out = out | F.contains(F.col(text_col), F.lit(word))
    return out


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).drop("places")

