"""Licence scans by diagonal voting, in DataFrame functions only (operator 7).

Every rolling word k-gram of the texts is joined by its hash to the places where licence templates have it. A match
of document word i and template word j votes for the diagonal i - j: the words of one copy of a template vote
for one diagonal, and for a neighbouring one after an inserted or missing word. Neighbouring diagonals are merged,
and the spans of a merged group are verified word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import passed_columns

#: What separates words, once A-Z are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 3
#: Diagonals this far apart at most belong together.
SLACK = 4
#: Share of a template's words that must stand on a merged group's diagonals.
VERIFIED = 0.8

#: Phrases whose words name a licence by themselves, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Notices that licences ask for, and short forms of them.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    ("lgpl", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met:"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
            "this work."),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _hash_at(words: Column, first: Column, i: Column) -> Column:
    """Hash of the gram that starts with word ``first`` at index i (of fewer words at the end)."""
    return F.xxhash64(F.lit(GRAM), first, *(F.get(words, i + j) for j in range(1, GRAM)))


def template_frame(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """``(tpl, label, words)`` of the templates: as many rows as there are."""
    rows = [(k, label, text) for k, (label, text) in enumerate(templates)]
    df = spark.createDataFrame(rows, "tpl int, label string, text string")
    return df.select("tpl", "label", words_of(F.col("text")).alias("words"))


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES, phrases=PHRASES, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_words``, ``places`` (word numbers of phrases, from 0), ``base_labels``, ``found`` and ``score``.

    ``base_labels`` are the labels of phrases whose words stand consecutively. ``found`` has (label, share, first,
    last) of each verified template span: ``share`` of the template's words stand there, word by word, between the
    words ``first`` and ``last``. ``score`` is 1 with a phrase, else the largest share of a verified span, else 0.
    NULL and empty texts have no words; repeated rows give equal results; input columns named like the results are
    replaced. The templates' grams are broadcast: there are as many as template words. The kept columns travel
    with the votes, and of texts with a template's gram the words; so leave texts out of ``keep`` where they
    aren't asked for. Texts of any length are read whole. Empty in, empty out.
    """
    results = ["n_words", "places", "base_labels", "found", "score"]
    keep = [c for c in passed_columns(docs, results) if keep is None or c in keep]
    tpl = template_frame(docs.sparkSession, templates)
    n_grams = F.size("words") - (GRAM - 1)
    grams = tpl.select("tpl", F.posexplode(F.slice(F.transform("words", lambda w, i: _hash_at(F.col("words"), w, i)), F.lit(1),
                                                   F.greatest(n_grams, F.lit(0)))).alias("at", "h")).select(
        "tpl", "at", F.col("h").alias("th"))
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.struct(*keep).alias("kept"),
                       words_of(F.col(text)).alias("words"))
    words, n = F.col("words"), F.size("words")

    def here(phrase: list[str]):
        def test(w: Column, i: Column) -> Column:
            ok = w == phrase[0]
            for j, p in enumerate(phrase[1:], 1):
                ok = ok & F.coalesce(F.get(words, i + j) == p, F.lit(False))
            return ok
        return test

    def starts(phrase: str) -> Column:
        parts = phrase.split()
        hits = F.transform(words, lambda w, i: F.when(here(parts)(w, i), i))
        return F.when(F.array_contains(words, parts[-1]), F.array_compact(hits)).otherwise(
            F.array().cast("array<int>"))

    per = [starts(p).alias(f"p{k}") for k, (p, _) in enumerate(phrases)]
    based = rows.select("__row", "kept", "words", *per)
    places = F.array_sort(F.concat(*(F.col(f"p{k}") for k in range(len(phrases)))))
    names = F.array_compact(F.array(*(F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(phrases))))
    # one row that carries the document, then one for each gram
    held = F.array(*(F.lit(h) for h in sorted({r["th"] for r in grams.select("th").collect()})))
    near = F.arrays_overlap(F.transform(words, lambda w, i: _hash_at(words, w, i)), held)
    of = F.struct("kept", n.alias("n"), F.when(near, words).otherwise(F.array().cast("array<string>")).alias("words"), places.alias("places"), F.array_sort(F.array_distinct(names)).alias("base_labels"))
    carried = based.select("__row", "words", of.alias("doc"))
    none = F.lit(None).cast(carried.schema["doc"].dataType)
    first = F.array(F.struct(F.lit(-1).alias("i"), F.lit(None).cast("long").alias("h"), F.col("doc")))
    rest = F.transform(F.slice(words, F.lit(1), F.greatest(n - (GRAM - 1), F.lit(0))), lambda w, i: F.struct(
        i.alias("i"), _hash_at(words, w, i).alias("h"), none.alias("doc")))
    each = carried.select("__row", F.explode(F.concat(first, rest)).alias("g"))
    each = each.select("__row", "g.i", "g.h", "g.doc")
    votes = each.join(F.broadcast(grams), F.col("h") == F.col("th"), "left").where(
        F.col("tpl").isNotNull() | (F.col("i") < 0))
    lines = votes.groupBy("__row", "tpl", (F.col("i") - F.col("at")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.first("doc", ignorenulls=True).alias("doc"))
    order = Window.partitionBy("__row", "tpl").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > SLACK, F.lit(True))
    groups = lines.withColumn("g", F.sum(apart.cast("int")).over(order))
    groups = groups.groupBy("__row", "tpl", "g").agg(
        F.array_sort(F.collect_list("diagonal")).alias("diagonals"), F.first("doc", ignorenulls=True).alias("doc"))
    known = F.broadcast(tpl.select(F.col("tpl").alias("t"), "label", F.col("words").alias("twords")))
    groups = groups.join(known, F.col("tpl") == F.col("t"), "left")
    one = F.when(F.col("tpl").isNotNull(), F.struct("label", "twords", "diagonals"))
    whole = groups.groupBy("__row").agg(F.first("doc", ignorenulls=True).alias("doc"), F.collect_list(one).alias("groups"))
    text_words = F.col("doc.words")

    def verify(g: Column) -> Column:
        """The document's words that equal the template's on one of the group's diagonals."""
        on = F.transform(g["twords"], lambda w, j: F.filter(
            g["diagonals"], lambda d: (d + j >= 0) & F.coalesce(F.get(text_words, (d + j).cast("int")) == w, F.lit(False))))
        at = F.array_compact(F.flatten(F.transform(on, lambda d, j: F.transform(d, lambda x: x + j))))
        hit = F.size(F.filter(on, lambda d: F.size(d) > 0))
        return F.struct(g["label"].alias("label"), (hit / F.size(g["twords"])).alias("share"),
                        F.array_min(at).cast("long").alias("first"), F.array_max(at).cast("long").alias("last"))

    found = F.array_sort(F.filter(F.transform("groups", verify), lambda s: s["share"] >= VERIFIED))
    out = whole.select("doc.*", found.alias("found"))
    score = F.when(F.size("base_labels") > 0, F.lit(1.0)).otherwise(
        F.coalesce(F.array_max(F.transform("found", lambda s: s["share"])), F.lit(0.0)))
    return out.select("kept.*", F.col("n").cast("long").alias("n_words"),
                      F.transform("places", lambda p: p.cast("long")).alias("places"), "base_labels", "found",
                      score.alias("score"))
