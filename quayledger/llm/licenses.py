"""License scans by diagonal voting of word pairs against template texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayledger.llm.shared import ship, slices, texts_of
from quayledger.llm.words import MARKS, runs, words_of

#: Words of a gram, the share of a template's grams that a span must have, and how far diagonals of one span may lie apart.
GRAM, SHARE, NEAR = 2, 0.8, 3
#: Template words, and the rows they may have in the broadcast table.
MOST_TEMPLATE_WORDS = 100_000

# Phrases that count wherever their words stand consecutively, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# The openings of public license notices.
TEMPLATES = {
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
}

#: The gram key of the mark that ends each document, so that documents without a hit keep a row.
END = -1


def word_pairs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every run of GRAM words: the text it stands in, its first word's number and its hash; and the texts' numbers of words."""
    hashes, _, _, first = words_of([t.lower() for t in texts], MARKS)
    at = np.arange(max(0, len(hashes) - GRAM + 1))
    text = np.repeat(np.arange(len(texts)), np.diff(first))[: len(at)]
    whole = at + GRAM <= first[1:][text]
    at, text = at[whole], text[whole]
    keys = runs(hashes, at, at + GRAM)
    keys[keys == np.uint64(2**64 - 1)] = 0  # END
    return np.column_stack([text, at - first[text]]), keys.view(np.int64), np.diff(first)


def _rolling(docs: DataFrame) -> DataFrame:
    """row, place and key of all word pairs of all documents, and an end row with doc_id and the number of words."""

    def roll(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for ids, texts in slices(batches, 1 << 20):
            where, keys, sizes = word_pairs(texts)
            yield pa.RecordBatch.from_arrays([pa.array(row + where[:, 0]), pa.array(where[:, 1]), pa.array(keys), pa.nulls(len(keys), pa.int64())], names=["row", "place", "h", "doc_id"])
            yield pa.RecordBatch.from_arrays([pa.array(row + np.arange(len(ids))), pa.array(sizes), pa.array(np.full(len(ids), END)), pa.array(ids, pa.int64())], names=["row", "place", "h", "doc_id"])
            row += len(ids)

    return texts_of(docs).mapInArrow(roll, "row long, place long, h long, doc_id long")


def _template_rows(spark: SparkSession, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """A row per gram of every phrase and template, and one for the end mark."""
    texts = [(text, label, True) for text, label in phrases.items()] + [(text, label, False) for label, text in templates.items()]
    if sum(len(t.split()) for t, _, _ in texts) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"more than {MOST_TEMPLATE_WORDS} template words: scan with the templates in several lists")
    where, keys, sizes = word_pairs([t.encode() for t, _, _ in texts])
    rows = [(int(h), int(t), *texts[t][1:], int(sizes[t]) - GRAM + 1, int(at)) for (t, at), h in zip(where, keys)]
    return spark.createDataFrame([*rows, (END, -1, "", False, 1, 0)], "key long, template int, label string, base boolean, need int, at long")


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row of docs.

    All word pairs join the template pairs by 64-bit hash; votes are counted per document, template and diagonal
    (the pair's place less its place in the template). A phrase stands where one diagonal has all of its pairs. A template's
    neighbouring diagonals, so few words added or lost, are one span, and it counts with SHARE of the pairs. The score is
    the largest share found, 1 for any phrase. The template table has a checked size and is broadcast; a row is added up in
    its own task first, so no word pair is hot. Null texts are empty: no words, null places, empty labels, score 0. Null
    doc_ids and repeated rows get a row each; an empty table gives none."""
    spark = docs.sparkSession
    ship(spark)
    table = _template_rows(spark, PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)
    votes = _rolling(docs).join(F.broadcast(table), F.col("h") == F.col("key"))
    keys = ["row", "template", "label", "base", "need"]
    lines = votes.groupBy(*keys, (F.col("place") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("met"), F.max("doc_id").alias("doc_id"))
    none = F.lit(None).cast("long")
    places = lines.where("base and size(met) = need").select("row", none.alias("doc_id"), none.alias("n_words"), "label", F.lit(True).alias("base"), F.col("diagonal").alias("start"), F.lit(1.0).alias("share"))
    in_text = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = lines.where("not base and template >= 0").withColumn("new", (F.col("diagonal") - F.lag("diagonal").over(in_text) > NEAR).cast("int"))
    spans = apart.withColumn("span", F.sum(F.coalesce("new", F.lit(1))).over(in_text)).groupBy(*keys, "span").agg(F.size(F.array_distinct(F.flatten(F.collect_list("met")))).alias("met"))
    spans = spans.where(F.col("met") >= SHARE * F.col("need")).select("row", none.alias("doc_id"), none.alias("n_words"), "label", F.lit(False).alias("base"), none.alias("start"), (F.col("met") / F.col("need")).alias("share"))
    every = lines.where("template = -1").select("row", "doc_id", F.col("diagonal").alias("n_words"), F.lit(None).cast("string").alias("label"), F.lit(False).alias("base"), none.alias("start"), F.lit(0.0).alias("share"))
    found = every.unionByName(places).unionByName(spans)
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    out = found.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.count(F.when(F.col("base"), 1)).alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"), F.max("share").alias("score"),
    )
    return out.drop("row")


def scan_sql(phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> str:
    """The same rows in DuckDB's SQL, over the view `documents`."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    listed = [(t, n, "TRUE") for t, n in (PHRASES if phrases is None else phrases).items()] + [(t, n, "FALSE") for n, t in (TEMPLATES if templates is None else templates).items()]
    rows = ", ".join(f"({k}, {quoted(t)}, {quoted(n)}, {b})" for k, (t, n, b) in enumerate(listed))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = lambda c: f"regexp_extract_all(translate(coalesce({c}, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words("text")} AS w FROM documents),
    t AS (SELECT k, label, base, {words("phrase")} AS w FROM (VALUES {rows}) p(k, phrase, label, base)),
    tg AS (SELECT k, label, base, need, i - 1 AS spot, w[i] || ' ' || w[i + 1] AS gram
           FROM (SELECT *, len(w) - 1 AS need, unnest(range(1, len(w))) AS i FROM t)),
    dg AS (SELECT r, i - 1 AS place, w[i] || ' ' || w[i + 1] AS gram FROM (SELECT *, unnest(range(1, len(w))) AS i FROM d)),
    v AS (SELECT r, k, label, base, need, spot, place - spot AS diagonal FROM dg JOIN tg USING (gram)),
    lines AS (SELECT r, k, label, base, need, diagonal, count(DISTINCT spot) AS met FROM v GROUP BY ALL),
    places AS (SELECT r, label, diagonal AS start FROM lines WHERE base AND met = need),
    apart AS (SELECT r, k, diagonal, sum(CASE WHEN gap <= {NEAR} THEN 0 ELSE 1 END) OVER (PARTITION BY r, k ORDER BY diagonal) AS span
              FROM (SELECT r, k, diagonal, diagonal - lag(diagonal) OVER (PARTITION BY r, k ORDER BY diagonal) AS gap
                    FROM lines WHERE NOT base)),
    spans AS (SELECT r, label, count(DISTINCT spot) / CAST(need AS DOUBLE) AS share FROM v JOIN apart USING (r, k, diagonal)
              GROUP BY r, k, label, need, span HAVING count(DISTINCT spot) >= {SHARE} * need),
    found AS (SELECT r, label, TRUE AS base, start, 1.0::DOUBLE AS share FROM places
              UNION ALL SELECT r, label, FALSE, NULL, share FROM spans)
    SELECT doc_id, CAST(len(any_value(w)) AS BIGINT) AS n_words, count(start) AS n_base, CAST(min(start) AS BIGINT) AS first_word,
           CAST(max(start) AS BIGINT) AS last_word, coalesce(string_agg(DISTINCT CASE WHEN base THEN label END, ',' ORDER BY CASE WHEN base THEN label END), '') AS base_labels,
           coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0)::DOUBLE AS score
    FROM d LEFT JOIN found USING (r) GROUP BY r, doc_id
    """
