"""License scans by diagonal voting, with DataFrame operations alone.

Templates are short phrases, which must stand word for word, and opening lines of license notices, of
which a good part must stand in order. Every pair of neighbouring words of a text is hashed and joined to
the places of that pair in the templates. A hit votes for its diagonal, the word of the text at which
the template would begin. Diagonals side by side are merged, since a word more or less shifts what
follows by one, and a merged span is verified: enough of the template's pairs in a span about as long as
the template. The template table has as many rows as the templates have words, and is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.common import KEY, ascii_lower, row_key, whole

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Diagonals this far apart are one span; share of a notice's word pairs that must be there; how many
# times longer than the template a span may be.
SLACK, MIN_COVER, MAX_STRETCH = 3, 0.75, 1.5
# Word pairs of a template, one bit of a number each.
MAX_PAIRS = 63


class Template(NamedTuple):
    label: str
    text: str
    exact: bool = False


# The phrases of the base labels, and the first words of common notices.
PHRASES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
             "this software and associated documentation files (the \"Software\"), to deal in the "
             "Software without restriction"),
    Template("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
             "use this file except in compliance with the License"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the "
             "terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, "
             "are permitted provided that the following conditions are met"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose "
             "with or without fee is hereby granted"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0"),
)

# No word has these characters: this pair ends every text and tells how many words it has.
_END = ("\x01", "\x02")


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORDS), F.lit(0))


def _pair_hash(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def template_table(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """A row per word pair of every template: hash, place, and what is known of the template."""
    one = spark.range(1)
    listed = one.select(F.inline(F.array(*[
        F.struct(
            F.lit(n).alias("template"), F.lit(t.label).alias("label"), F.lit(t.exact).alias("exact"),
            words_of(F.lit(t.text)).alias("words"),
        )
        for n, t in enumerate(templates)
    ])))
    size = F.size("words")
    listed = listed.withColumn("pairs", F.when(size - 1 <= MAX_PAIRS, size - 1).otherwise(
        F.raise_error(F.lit(f"a template has more than {MAX_PAIRS} word pairs"))
    ))
    placed = listed.select(
        "template", "label", "exact", "pairs",
        F.explode(F.sequence(F.lit(0), F.col("pairs") - 1)).alias("at"), "words",
    )
    rows = placed.select(
        _pair_hash(F.get("words", F.col("at")), F.get("words", F.col("at") + 1)).alias("pair"),
        "template", "label", "exact", "pairs", "at",
    )
    end = one.select(
        _pair_hash(*map(F.lit, _END)).alias("pair"), F.lit(-1).alias("template"),
        F.lit(None).cast("string").alias("label"), F.lit(False).alias("exact"),
        F.lit(1).alias("pairs"), F.lit(0).alias("at"),
    )
    return rows.unionByName(end)


def diagonals(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Votes by row key, template and diagonal; template -1 has the number of words as its diagonal.

    ``seen`` has a bit for every word pair of the template that stands on the diagonal, ``n`` counts hits.
    """
    listed = F.concat(words_of(whole()), F.array(*map(F.lit, _END)))
    rows = docs.select(*row_key(), listed.alias("w"))
    # Each word beside the next one; the last has none and makes no pair.
    beside = F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.size("w")).alias("b"))
    rows = rows.select(*KEY, F.posexplode(beside).alias("place", "p"))
    rows = rows.select(*KEY, "place", _pair_hash(F.col("p.a"), F.col("p.b")).alias("pair"))
    hits = rows.join(F.broadcast(template_table(docs.sparkSession, templates)), "pair")
    hits = hits.withColumn("diagonal", F.col("place") - F.col("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at"))
    return hits.groupBy(*KEY, "template", "label", "exact", "pairs", "diagonal").agg(
        F.bit_or(bit).alias("seen"), F.count(F.lit(1)).alias("n"),
        F.min("place").alias("start"), F.max("place").alias("stop"),
    )


def scan(
    docs: DataFrame, phrases: Sequence[Template] = PHRASES, notices: Sequence[Template] = NOTICES
) -> DataFrame:
    """A row per row of ``docs`` with an identifier, ``n_words``, places and labels.

    ``n_base``, ``first_word``, ``last_word``, ``base_labels`` speak of places where all words of a phrase
    stand side by side; ``labels`` adds those of verified notices, ``score`` is the best share of a template
    that was found, 0 without any label. ``spans`` lists verified spans in words. Null and empty texts
    have no words, counts of 0, no places and empty labels. Copies of a row each get their row.
    """
    votes = diagonals(docs, [*phrases, *notices])
    by_template = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_template) > SLACK
    votes = votes.withColumn("new", F.when(apart, 1).otherwise(0))
    upto = by_template.rowsBetween(Window.unboundedPreceding, 0)
    votes = votes.withColumn("span", F.sum("new").over(upto))

    complete = F.col("exact") & (F.bit_count("seen") == F.col("pairs"))
    merged = votes.groupBy(*KEY, "template", "label", "exact", "pairs", "span").agg(
        F.bit_or("seen").alias("seen"), F.min("start").alias("start"), F.max("stop").alias("stop"),
        F.count_if(complete).alias("places"),
        F.min(F.when(complete, F.col("diagonal"))).alias("first"),
        F.max(F.when(complete, F.col("diagonal"))).alias("last"),
        F.max("n").alias("n"), F.max("diagonal").alias("diagonal"),
    )
    cover = F.bit_count("seen") / F.col("pairs")
    long = F.col("stop") - F.col("start") + 2
    notice = (
        (F.col("template") >= 0) & ~F.col("exact") & (cover >= MIN_COVER)
        & (long <= MAX_STRETCH * (F.col("pairs") + 1))
    )
    phrase = F.col("places") > 0
    end = F.col("template") == -1
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    share = F.when(phrase, F.lit(1.0)).when(notice, cover)
    told = merged.groupBy(*KEY).agg(
        F.max(F.when(end, F.col("diagonal"))).cast("bigint").alias("n_words"),
        F.max(F.when(end, F.col("n"))).alias("copies"),
        F.coalesce(F.sum("places"), F.lit(0)).cast("bigint").alias("n_base"),
        F.min("first").cast("bigint").alias("first_word"),
        F.max("last").cast("bigint").alias("last_word"),
        joined(F.when(phrase, F.col("label"))).alias("base_labels"),
        joined(F.when(phrase | notice, F.col("label"))).alias("labels"),
        F.coalesce(F.max(share), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(
            notice, F.struct("start", (F.col("stop") + 2).alias("end"), "label", cover.alias("cover"))
        ))).alias("spans"),
    )
    each = told.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(
        F.col("row_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels",
        "labels", "score", "spans",
    )
