"""License scans: word k-grams of all documents joined to template positions, and votes along diagonals.

Every document gives the hashes of all its rolling k-grams, of ``PHRASE_K`` words for short phrases and
of ``TEXT_K`` words for longer license texts. Spark joins them to the positions of the templates; a match
votes for the diagonal, the document's position less the template's. Votes are summed by diagonal, and
neighbouring diagonals of a template are merged, as words that were put in or left out shift what follows:
each goes to the one with most votes that is at most ``NEIGHBOURS`` away, so that a span is never much
longer than its template. It is verified by the share of the template's different positions that voted.
A phrase stands at a place only if all its positions vote for one diagonal.

The templates are a fixed list, so their table of a few hundred rows is broadcast; of the documents only
votes are shuffled, and one row each to carry those without any.

Cases: null or empty texts have no words and no spans; repeated rows and rows with one id are rows of
their own; ties between spans go by place, then label; an empty table gives an empty result; other
columns are not carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm import words

PHRASE_K, TEXT_K = 2, 4
NEIGHBOURS = 8  # a diagonal is merged with a stronger one that is no further away
COVERED = 0.5  # of a text's positions that have to vote
_PRESENT = 0  # stands for the document itself among its hashes


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False


# Phrases with their labels, and opening passages of public licenses.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
TEXTS = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so",
    ),
    Template(
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version",
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)


def _grams(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all k words in a row, where each text's begin, and its number of words."""
    found = words.words(texts, words.ALNUM)
    flat, bounds = words.shingles(found, k)
    return flat.astype(np.int64), bounds, found.counts


def _template_rows(templates: tuple[Template, ...]) -> list[tuple]:
    rows = [(_PRESENT, -1, 0, 0, 1, False, "")]
    for number, template in enumerate(templates):
        k = PHRASE_K if template.phrase else TEXT_K
        flat, _, (n,) = _grams(pa.array([template.text]), k)
        if n < k:
            raise ValueError(f"a template needs {k} words: {template.text!r}")
        rows += [(int(h), number, i, k, len(flat), template.phrase, template.label) for i, h in enumerate(flat)]
    return rows


def scan(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + TEXTS, text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, and spans in order of place.

    A span has start and end (words from 0, end not included), label, coverage (share of the template's
    positions found) and phrase (whether the template is one). Spans of texts that are not verified, but
    have votes, are there with verified = false.
    """
    spark = docs.sparkSession
    words.use_batches(spark)
    positions = spark.createDataFrame(
        _template_rows(templates), "h long, template int, at int, k int, size int, phrase boolean, label string"
    )

    def run(batches):
        for whole in batches:
            for batch in words.slices(whole, "text"):
                found = words.words(batch.column("text"), words.ALNUM)
                lists = []
                for k in (PHRASE_K, TEXT_K):
                    flat, bounds = words.shingles(found, k)
                    whole_grams = found.counts >= k  # a shorter text has one shingle that is no k-gram
                    flat = flat[np.repeat(whole_grams, np.diff(bounds))]
                    bounds = np.concatenate(([0], np.cumsum(np.diff(bounds) * whole_grams)))
                    lists.append(words.list_of(flat.astype(np.int64), bounds, pa.int64()))
                columns = [batch.column("doc_id"), batch.column("row"), pa.array(found.counts), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_words", "short", "long"])

    own = docs.select("doc_id", F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    hashed = own.mapInArrow(run, "doc_id long, row long, n_words long, short array<long>, long array<long>")
    every = F.concat(F.array(F.lit(_PRESENT).cast("long")), "short", "long")
    n_short = F.size("short")
    grams = hashed.select("doc_id", "row", "n_words", n_short.alias("n_short"), F.posexplode(every).alias("i", "h"))
    place = F.col("i") - 1 - F.when(F.col("k") == TEXT_K, F.col("n_short")).otherwise(0)
    votes = grams.join(F.broadcast(positions), "h").withColumn("place", place)
    votes = votes.withColumn("diagonal", F.col("place") - F.col("at"))
    lines = votes.groupBy("doc_id", "row", "n_words", "template", "phrase", "label", "k", "size", "diagonal").agg(
        F.collect_list("at").alias("voters"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    # a phrase's diagonals stay apart; those of a text go to the strongest one nearby, of equal ones the first
    around = Window.partitionBy("row", "doc_id", "template").orderBy("diagonal").rangeBetween(-NEIGHBOURS, NEIGHBOURS)
    strongest = F.max(F.struct(F.size("voters").alias("votes"), (-F.col("diagonal")).alias("to"))).over(around)
    lines = lines.withColumn("line", F.when(F.col("phrase"), F.col("diagonal")).otherwise(-strongest["to"]))
    merged = lines.groupBy("doc_id", "row", "n_words", "template", "phrase", "label", "k", "size", "line").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("voters")))).alias("votes"),
        F.min("first").alias("start"),
        (F.max("last") + F.col("k")).alias("end"),
    )
    coverage = F.col("votes") / F.col("size")
    verified = F.when(F.col("phrase"), F.col("votes") == F.col("size")).otherwise(coverage >= COVERED)
    span = F.struct("start", "end", "label", coverage.alias("coverage"), verified.alias("verified"), "phrase")
    real = F.when((F.col("template") >= 0) & (verified | ~F.col("phrase")), span)
    listed = merged.groupBy("doc_id", "row", "n_words").agg(F.sort_array(F.collect_list(real)).alias("spans"))
    return listed.select("doc_id", "n_words", "spans")
