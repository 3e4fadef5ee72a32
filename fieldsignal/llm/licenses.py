"""License scans: an exact set-similarity join of text blocks and notice templates, in DataFrame functions.

Blocks are the lines of a text, templates short notices, both sets of words. A template fits a
block that holds at least ``threshold`` of its words, among them those that name its license, and
none that makes it another license. The words of the templates are put in order
by the number of blocks that hold them in all texts, rarest first; a block that fits must hold a
word of the template's prefix in that order. Blocks and prefixes meet by word; the sizes of both
and the place of the first common word bound what they can still have in common, and the
candidates that remain are compared in full.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldsignal.llm.common import lower_ascii, same_key
from fieldsignal.session import materialize

THRESHOLD = 0.8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases with their labels, and notices with theirs.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
#: For labels: the words that name the license, and the words that make it another one.
NAMING = {
    "mit": (["mit"], []),
    "apache-2": (["apache", "2"], []),
    "gpl-3": (["general", "public", "3"], ["lesser", "affero"]),
    "gpl-2": (["general", "public", "2"], ["lesser", "affero"]),
    "lgpl": (["lesser", "general", "public"], []),
    "mpl-2": (["mozilla", "2"], []),
    "bsd": (["redistribution"], []),
    "cc-by-nc": (["cc", "by", "nc"], []),
    "cc-by-sa": (["cc", "by", "sa"], ["nc"]),
    "cc-by": (["cc", "by", "attribution"], ["nc", "sa", "nd", "noncommercial", "sharealike", "noderivatives"]),
    "proprietary": (["all", "rights", "reserved"], []),
    "unlicense": (["unencumbered"], []),
}
TEMPLATES = [
    ("licensed under the mit license", "mit"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this work is licensed under the gnu general public license version 2", "gpl-2"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the mozilla public license version 2 0", "mpl-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("all rights reserved", "proprietary"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


def naming(template: str, label: str) -> tuple[list[str], list[str]]:
    """The template's words that must stand in a block that it fits, and the words that must not."""
    needed, barred = NAMING.get(label, ([], []))
    return [w for w in needed if w in template.split()], barred


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def _templates(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """template (a number), label, word: the distinct words of the templates."""
    rows = [(k, label, w) for k, (text, label) in enumerate(templates) for w in sorted(set(text.split()))]
    return spark.createDataFrame(rows, "template int, label string, word string")


def _blocks(docs: DataFrame, known: list[str]) -> DataFrame:
    """doc_id, mark, size, words: of every line with some of the known words the number of its distinct
    words, and which of the known ones they are."""
    lines = docs.select(
        "doc_id", F.xxhash64("text").alias("mark"), F.explode(F.split(lower_ascii(F.col("text")), "\n")).alias("line")
    )
    # The words are bound to a variable, so that they are extracted once for both columns.
    some = F.array(*[F.lit(w) for w in known])
    both = F.transform(
        F.array(F.array_distinct(_words(F.col("line")))),
        lambda words: F.struct(F.size(words).alias("size"), F.array_intersect(words, some).alias("words")),
    )
    # The outer form, as else a filter is inferred that extracts all words once more.
    found = lines.select("doc_id", "mark", F.explode_outer(both).alias("block"))
    return found.select("doc_id", "mark", "block.size", "block.words").where(F.size("words") > 0)


def word_order(blocks: DataFrame, templates: DataFrame) -> DataFrame:
    """template, label, word, place, size: the words of each template from the globally rarest on."""
    known = sorted({row["word"] for row in templates.select("word").collect()})  # a constant of the call
    vocabulary = F.array(*[F.lit(w) for w in known])
    # The outer form, as else a filter is inferred that extracts all words once more.
    found = blocks.select(F.explode_outer(F.array_intersect("words", vocabulary)).alias("word"))
    often = found.where("word is not null").groupBy("word").count()
    ranked = templates.join(often, "word", "left").select(
        "template", "label", "word", F.coalesce("count", F.lit(0)).alias("often")
    )
    in_order = F.array_sort(F.collect_list(F.struct("often", "word")))
    ranked = ranked.groupBy("template", "label").agg(in_order.alias("words"))
    return ranked.select("template", "label", F.col("words.word").alias("words"))


def similar_blocks(docs: DataFrame, templates: list[tuple[str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, mark (a hash of the text), template, label, score of every block that fits a template."""
    spark = docs.sparkSession
    known = {w for text, label in templates for words in (text.split(), *naming(text, label)) for w in words}
    # Written once, short: the order of the words and the candidates both come from it.
    blocks = materialize(_blocks(docs, sorted(known)))
    order = word_order(blocks, _templates(spark, templates)).collect()  # one row for each template
    prefixes = []
    for row in order:
        size = len(row["words"])
        need = math.ceil(threshold * size - 1e-9)
        needed, barred = naming(templates[row["template"]][0], row["label"])
        for place, word in enumerate(row["words"][: size - need + 1]):
            prefixes.append((word, row["template"], row["label"], list(row["words"]), need, place, needed, barred))
    prefix = spark.createDataFrame(
        prefixes,
        "word string, template int, label string, template_words array<string>, need int, place int,"
        " needed array<string>, barred array<string>",
    )
    rare = F.array(*[F.lit(w) for w in sorted({x[0] for x in prefixes})])
    candidates = blocks.where(F.arrays_overlap("words", rare))
    candidates = candidates.select("*", F.explode_outer(F.array_intersect("words", rare)).alias("word")).join(prefix, "word")
    # Length: the block holds as many words as are needed. Position: this is the first common word
    # of the template's order, and enough words stand from it on.
    candidates = candidates.where(
        (F.col("size") >= F.col("need"))
        & (F.size("template_words") - F.col("place") >= F.col("need"))
        & ~F.arrays_overlap("words", F.expr("slice(template_words, 1, place)"))
    )
    common = F.size(F.array_intersect("template_words", "words"))
    named = (F.size(F.array_except("needed", "words")) == 0) & ~F.arrays_overlap("words", "barred")
    return candidates.where((common >= F.col("need")) & named).select(
        "doc_id", "mark", "template", "label", (common / F.size("template_words")).alias("score")
    )


def _starts(text: Column, phrase: list[str]) -> Column:
    """The places, from 0, where the phrase's words stand one after another among the words of the text."""

    def among(words: Column) -> Column:
        last = F.size(words) - len(phrase)
        places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.filter(
            places, lambda n: reduce(and_, (F.get(words, n + k) == word for k, word in enumerate(phrase)))
        )

    # The words are bound to a variable: an expression inside the inner function would be evaluated for every place.
    return F.get(F.transform(F.array(_words(text)), among), 0)


def scan(
    docs: DataFrame,
    phrases: list[tuple[str, str]] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    The phrases give the base columns; templates add their labels. The score is 1 where a phrase
    stands, else the largest part of a template that one block holds, 0 if none fits. A null text
    has no words. Repeated rows are judged each, with the same result; rows that share an id but
    not a text are told apart by a hash of the text.
    """
    fits = similar_blocks(docs, templates, threshold).groupBy("doc_id", "mark").agg(
        F.collect_set("label").alias("found"), F.max("score").alias("part")
    )
    lower = F.coalesce(lower_ascii(F.col("text")), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.xxhash64("text").alias("mark"), lower.alias("lower"))
    none = F.array().cast("array<int>")
    starts = []
    for phrase, label in phrases:
        parts = phrase.split()
        # Texts without the phrase, whatever stands between its words, are not split at all.
        pattern = f"[^0-9a-z]+".join(re.escape(p) for p in parts)
        starts.append(F.when(F.rlike("lower", F.lit(pattern)), _starts(F.col("lower"), parts)).otherwise(none))
    rows = rows.select(
        "doc_id",
        "mark",
        F.regexp_count("lower", F.lit(WORD)).cast("long").alias("n_words"),
        F.array(*starts).alias("by_phrase"),
    )
    names = F.array(*[F.lit(label) for _, label in phrases])
    base = F.array_distinct(
        F.filter(F.transform(names, lambda x, k: F.when(F.size(F.get("by_phrase", k)) > 0, x)), lambda x: x.isNotNull())
    )
    rows = rows.select(
        "doc_id", "mark", "n_words", F.flatten("by_phrase").alias("at"), F.array_sort(base).alias("base")
    )
    joined = same_key(rows, fits, ["doc_id", "mark"], "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", found)), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("part", F.lit(0.0))).alias("score"),
    )
