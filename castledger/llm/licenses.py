r"""License scans by an exact set-similarity join of templates with text blocks.

A template of n words is looked for in blocks of 2n words, one starting every n
words, so that each run of n words lies whole in some block. Sought are all
blocks that hold at least ``PERCENT`` of the template's distinct words. Tokens are
ordered by their frequency in the whole corpus, rarest first; of a template with
m tokens, k of which must be there, the first m - k + 1 are its prefix, and a
block without any of them can't qualify. Candidates must have k distinct words
(length filter), and from the first prefix token found on, enough tokens must be
left in the order (positional filter). The rest is compared in full.

Templates and their prefixes are parameters of fixed size and travel with the
task; the corpus is scanned twice (token frequencies, then blocks) and not
shuffled.

Null text counts as empty: no words, no labels, score 0. Rows are independent:
repeated rows, equal or null doc_ids each give a row. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from castledger.llm.common import documents_of
from castledger.llm.textwords import alnum_words

PERCENT = 90

# Phrases and labels of the base scan.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Notices as they stand in public license texts.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                      "software and associated documentation files, to deal in the software without restriction",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of "
                  "the GNU General Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
           "fee is hereby granted",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}

SCANNED = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())),
    ("score", pa.float64()),
    ("blocks", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64()),
                                   ("containment", pa.float64())])))])
SCANNED_SQL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
               "base_labels array<string>, labels array<string>, score double, "
               "blocks array<struct<label: string, first: long, words: long, containment: double>>")


def token_counts(docs: DataFrame, tokens: list[bytes]) -> dict[bytes, int]:
    """How often each token stands in all documents. One number per token of the
    templates reaches the driver."""
    places = {t: i for i, t in enumerate(tokens)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = np.zeros(len(tokens) + 1, np.int64)
            for text in batch.column(1):
                words = alnum_words(text.as_py())
                found = np.fromiter(map(places.get, words, repeat(len(tokens))), np.int64, len(words))
                totals += np.bincount(found, minlength=len(totals))
            yield pa.record_batch([pa.array(np.arange(len(tokens))), pa.array(totals[:-1])],
                                  names=["token", "n"])

    rows = docs.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {tokens[r["token"]]: r["n"] for r in rows}


class Template:
    """A template's tokens in global order, and what the filters need."""

    def __init__(self, text: str, order: dict[bytes, int], percent: int):
        words = alnum_words(text)
        self.words = len(words)
        self.tokens = sorted({order[w] for w in words})
        self.least = -(-percent * len(self.tokens) // 100)
        self.prefix = self.tokens[:len(self.tokens) - self.least + 1]

    def containment(self, block: set[int]) -> float:
        """Of the tokens in the block; 0 where a filter rules it out."""
        total = len(self.tokens)
        at = next((i for i, t in enumerate(self.prefix) if t in block), total)
        if len(block) < self.least or total - at < self.least:
            return 0.0
        found = sum(t in block for t in self.tokens)
        return found / total if found >= self.least else 0.0


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES,
         percent: int = PERCENT) -> DataFrame:
    """Per document: number of words, places of the base phrases, labels, and all
    blocks that hold a template, with their containment."""
    docs = documents_of(docs)
    vocabulary = sorted({w for text in (*templates.values(), *phrases) for w in alnum_words(text)})
    counts = token_counts(docs, vocabulary)
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    known = {label: {"words": t.words, "tokens": t.tokens, "least": t.least, "prefix": t.prefix}
             for label, text in templates.items() if (t := Template(text, order, percent)).tokens}
    sought = {label: [[order[w] for w in alnum_words(p)] for p, x in phrases.items() if x == label]
              for label in set(phrases.values())}

    def restored(state: dict) -> Template:
        template = Template.__new__(Template)
        vars(template).update(state)
        return template

    def base(ids: np.ndarray) -> dict[str, list[int]]:
        found = {}
        for label, sequences in sought.items():
            for sequence in sequences:
                n = len(ids) - len(sequence) + 1
                if n > 0:
                    here = np.logical_and.reduce([ids[i:i + n] == t for i, t in enumerate(sequence)])
                    if here.any():
                        found[label] = found.get(label, []) + np.flatnonzero(here).tolist()
        return found

    def row(doc_id, text, all_templates):
        words = alnum_words(text)
        # other words get numbers below 0, different ones where they are in a block
        ids = np.fromiter(map(order.get, words, repeat(-1)), np.int64, len(words))
        places = base(ids)
        starts = [p for found in places.values() for p in found]
        blocks = []
        for label, template in all_templates.items():
            n = template.words
            at = np.flatnonzero(np.isin(ids, template.prefix)) // n
            for k in np.unique(np.concatenate([at, np.maximum(at - 1, 0)])).tolist():
                share = template.containment(set(words_or_ids(words, ids, k * n, k * n + 2 * n)))
                if share:
                    blocks.append({"label": label, "first": k * n, "words": min(2 * n, len(words) - k * n),
                                   "containment": share})
        labels = sorted({*places, *(b["label"] for b in blocks)})
        return (doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None),
                sorted(places), labels, max((b["containment"] for b in blocks), default=0.0), blocks)

    def words_or_ids(words, ids, first, end):
        return (w if i < 0 else i for w, i in zip(words[first:end], ids[first:end].tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_templates = {label: restored(state) for label, state in known.items()}
        for batch in batches:
            rows = [row(d.as_py(), t.as_py(), all_templates) for d, t in zip(batch.column(0), batch.column(1))]
            yield pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SCANNED)],
                                  schema=SCANNED)

    return docs.mapInArrow(run, SCANNED_SQL)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
        "score", F.size("blocks").cast("long").alias("n_blocks"))
