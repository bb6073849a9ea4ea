"""License scans by diagonal voting.

Every run of ``K`` words of a document is hashed and joined with the positions of the same run in the license templates.
Matches vote for the offset between document and template position, their diagonal. Neighbouring diagonals, which words
put in or left out set apart, are merged, and the merged span is verified by the share of the template, and of the
span, that its matches cover.

Scale: the templates are a fixed small table, so the join is a broadcast join and only matches are shuffled, grouped by
document, template and diagonal. Texts are read twice and never shuffled. A document is known by two 64-bit keys of id
and text; rows equal in both share their result.

Edge cases: null and empty texts have no word, no place and no label. Fewer than ``K`` words give no run. Repeated rows
get equal results. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Words, chunks, letters

K = 3
GAP = 2
COVER = 0.6
LONG = 25
DENSITY = 0.5

# fixed values: phrases and their labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: wordings of public license notices
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
     "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License "
     "at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation, either version 3 of the License, or any later version"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0-1.0", "Licensed under CC0 1.0 Universal"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("all-rights-reserved", "All rights reserved. No part of this publication may be reproduced"),
)


def _places(text: bytes) -> tuple[int, int, int | None, int | None, list[str]]:
    """Words, places of the phrases, first and last start, labels."""
    padded = b" " + text + b" "
    n = text.count(b" ") + 1 if text else 0
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        want = b" " + phrase.encode() + b" "
        at, before, counted = padded.find(want), 0, 0
        while at >= 0:
            before += padded.count(b" ", counted, at)
            counted = at
            starts.append(before)
            labels.add(label)
            at = padded.find(want, at + 1)
    return n, len(starts), min(starts, default=None), max(starts, default=None), sorted(labels)


def phrase_places(text: Column) -> Column:
    @F.pandas_udf("n_words long, n_base long, first_word long, last_word long, base_labels array<string>")
    def places(texts: pd.Series) -> pd.DataFrame:
        rows = [_places(letters(t)) for t in texts]
        out = pd.DataFrame(rows, columns=["n_words", "n_base", "first_word", "last_word", "base_labels"])
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    return places(text)


def _runs(texts: list[bytes], k: int) -> list[np.ndarray]:
    w = Words(texts)
    at, doc = w.windows(k)
    h = w.hashes(w.start[at], w.end[at + k - 1]).view(np.int64) if len(at) else np.empty(0, np.int64)
    return np.split(h, np.searchsorted(doc, np.arange(1, len(texts))))


def run_hashes(text: Column, k: int = K) -> Column:
    """Hash of every run of ``k`` words, by position."""

    @F.pandas_udf("array<long>")
    def runs(texts: pd.Series) -> pd.Series:
        return pd.Series([h for part in chunks(texts, letters) for h in _runs(part, k)], dtype=object)

    return runs(text)


def template_positions(spark: SparkSession, templates=TEMPLATES, k: int = K) -> DataFrame:
    rows = []
    for number, (label, text) in enumerate(templates):
        words = letters(text)
        for at, h in enumerate(_runs([words], k)[0].tolist()):
            rows.append((h, number, label, words.count(b" ") + 1, at))
    return spark.createDataFrame(rows, "hash long, template int, label string, n_template int, tpos int")


def spans(documents: DataFrame, templates=TEMPLATES, k: int = K) -> DataFrame:
    """Verified spans: ``k1``, ``k2``, ``label``, ``first``, ``last`` (words), ``covered`` and ``score``."""
    runs = documents.select(*_keys(), F.posexplode(run_hashes(F.col("text"), k)).alias("pos", "hash"))
    known = F.broadcast(template_positions(documents.sparkSession, templates, k))
    hits = runs.join(known, "hash").withColumn("diagonal", F.col("pos") - F.col("tpos"))
    who = ["k1", "k2", "template", "label", "n_template"]
    votes = hits.groupBy(*who, "diagonal").agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_set("tpos").alias("tpos")
    )
    order = W.partitionBy("k1", "k2", "template").orderBy("diagonal", "first")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > GAP, F.lit(False))
    group = F.sum(apart.cast("int")).over(order)
    merged = votes.withColumn("group", group).groupBy(*who, "group").agg(
        F.min("first").alias("first"), (F.max("last") + (k - 1)).alias("last"),
        F.array_distinct(F.flatten(F.collect_list("tpos"))).alias("tpos"),
    )
    words = F.flatten(F.transform("tpos", lambda t: F.sequence(t, t + (k - 1))))
    covered = merged.withColumn("covered", F.size(F.array_distinct(words)))
    share, length = F.col("covered") / F.col("n_template"), F.col("last") - F.col("first") + 1
    verified = ((share >= COVER) | (F.col("covered") >= LONG)) & (F.col("covered") >= DENSITY * length)
    found = covered.filter(verified).select(
        "k1", "k2", "label", "first", "last", "covered", F.least(share, F.lit(1.0)).alias("score")
    )
    # of spans that overlap the best explains the words
    place = W.partitionBy("k1", "k2").orderBy("first", "last")
    reach = F.max("last").over(place.rowsBetween(W.unboundedPreceding, -1))
    found = found.withColumn("new", F.coalesce(F.col("first") > reach, F.lit(True)).cast("int"))
    found = found.withColumn("island", F.sum("new").over(place))
    best = F.max(F.struct("score", "covered")).over(W.partitionBy("k1", "k2", "island"))
    wins = (F.col("score") == F.col("best.score")) & (F.col("covered") == F.col("best.covered"))
    found = found.withColumn("best", best).filter(wins)
    return found.drop("new", "island", "best")


def _keys() -> list[Column]:
    return [F.xxhash64(F.lit("id"), "doc_id").alias("k1"), F.xxhash64(F.lit("text"), "text").alias("k2")]


def scan(documents: DataFrame, templates=TEMPLATES, k: int = K) -> DataFrame:
    """Per document: word and place counts, ``base_labels``, ``labels``, ``score`` and the number of verified spans."""
    base = documents.select("doc_id", *_keys(), phrase_places(F.col("text")).alias("b")).select("doc_id", "k1", "k2", "b.*")
    found = spans(documents, templates, k).groupBy("k1", "k2").agg(
        F.collect_set("label").alias("more"), F.max("score").alias("best"), F.count("*").alias("n_spans")
    )
    both = base.join(found, ["k1", "k2"], "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("more", none))))
    by_phrase = F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.round(F.greatest(F.coalesce("best", F.lit(0.0)), by_phrase), 6).alias("score"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
    )
