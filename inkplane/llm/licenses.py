"""Licence scans with a positional index of the templates' rarest words.

Two passes over the files. The first counts, for the templates' words only, in how many files each
stands; that gives their inverse document frequency (a table as long as the templates have words).
The second looks up each file's highest-IDF licence words, template by template, in the index from words
to positions, intersects their postings by relative position (place in the file less place in the
template), and accepts a template where enough of its words agree and every one of its mandatory key
phrases stands in the file. Base phrases are places of consecutive words and always count. A template's share is
the largest, over the shifts at which half of those words or more agree, of its words' weight that stands there.

Defined cases: null and empty texts have no words and no labels; rows that repeat, or have no id, are scanned
each; long texts are scanned whole; of equal IDF the word that sorts first is looked up; an empty table gives
none; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import arrow_batches, text_or_empty, trimming
from .notices import NOTICES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Only A-Z are lowered; other letters stay.
LOWER = {c: c + 32 for c in range(65, 91)}

#: Phrases that count wherever their words stand in a row, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@dataclass(frozen=True)
class Template:
    """A licence notice: its label, its words in order, and phrases that must stand in the file."""

    label: str
    text: str
    keys: tuple[str, ...]


#: One-sentence notices and the phrases that tell them apart; then the whole public notices.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("gpl-2.0", "This work is licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("lgpl", "licensed under the GNU Lesser General Public License", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the GNU Affero General Public License", ("gnu affero general public license",)),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
    Template("all-rights-reserved", "Copyright All rights reserved", ("all rights reserved",)),
    *(Template(*x) for x in NOTICES),
)


def words(text: str) -> list[str]:
    return WORD.findall(text.translate(LOWER) if not text.isascii() else text.lower())


@dataclass
class Index:
    """Postings of the templates' words, their IDF, and the phrases."""

    idf: dict[str, float]
    base: dict[str, str] = field(default_factory=lambda: dict(BASE))
    templates: tuple[Template, ...] = TEMPLATES
    rare: int = 4  # of a file's words that a template has, so many of the highest IDF are looked up
    agree: float = 0.6  # share of a template's words that must stand at their places

    def __post_init__(self):
        weight = lambda w: self.idf.get(w, 0.0) + 1.0
        self.places = [words(t.text) for t in self.templates]
        self.keys = [[words(k) for k in t.keys] for t in self.templates]
        self.weights = [[weight(w) for w in ws] for ws in self.places]
        self.totals = [sum(x) for x in self.weights]
        self.postings: list[dict[str, list[int]]] = [defaultdict(list) for _ in self.templates]
        for k, ws in enumerate(self.places):
            for p, w in enumerate(ws):
                self.postings[k][w].append(p)
        self.phrases = [(words(p), label) for p, label in self.base.items()]
        self.vocabulary = {w for ws in self.places for w in ws} | {w for ws, _ in self.phrases for w in ws} | {w for ks in self.keys for k in ks for w in k}

    def scan(self, ws: list[str]) -> tuple[int, int | None, int | None, list[str], list[str], float]:
        """Places of base phrases: number, first, last, labels; all labels; the best template's score."""
        vocabulary = self.vocabulary
        at = {i: w for i, w in enumerate(ws) if w in vocabulary}
        if not at:
            return 0, None, None, [], [], 0.0
        starts, base = [], set()
        by_word = defaultdict(list)
        for i, w in at.items():
            by_word[w].append(i)
        stands = lambda i, phrase: all(at.get(i + k) == w for k, w in enumerate(phrase))
        for phrase, label in self.phrases:
            found = [i for i in by_word.get(phrase[0], ()) if stands(i, phrase)]
            if found:
                starts += found
                base.add(label)
        labels, best = set(base), 0.0
        for k, template in enumerate(self.templates):
            got = self._agreement(k, at, by_word)
            if got >= self.agree and all(any(stands(i, key) for i in by_word.get(key[0], ())) for key in self.keys[k]):
                labels.add(template.label)
                best = max(best, got)
        if base:
            best = max(best, 0.5)
        return len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(labels), min(1.0, best)

    def _agreement(self, k: int, at: dict[int, str], by_word: dict[str, list[int]]) -> float:
        """The largest share of template k's words, by weight, that stand at one shift of its places."""
        postings, weights, total = self.postings[k], self.weights[k], self.totals[k]
        have = postings.keys() & by_word.keys()
        if sum(weights[p] for w in have for p in postings[w]) < self.agree * total:
            return 0.0  # too few of its words stand anywhere
        rarest = sorted(have, key=lambda w: (-self.idf.get(w, 0.0), w))[: self.rare]
        votes: dict[int, set[str]] = defaultdict(set)
        for w in rarest:
            for p in postings[w]:
                for i in by_word[w]:
                    votes[i - p].add(w)
        shifts = [s for s, ws in votes.items() if 2 * len(ws) >= len(rarest)]
        return max((sum(x for p, (w, x) in enumerate(zip(self.places[k], weights, strict=True)) if at.get(s + p) == w) / total for s in shifts), default=0.0)


def licence_idf(docs: DataFrame, vocabulary: set[str]) -> dict[str, float]:
    """IDF of the vocabulary's words over all documents; bounded by the vocabulary."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        n, found = 0, defaultdict(int)
        for b in batches:
            for text in b.column(0).to_pylist():
                n += 1
                for w in vocabulary.intersection(words(text)):
                    found[w] += 1
        ws = ["", *found]  # "": the number of documents
        yield pa.RecordBatch.from_arrays([pa.array(ws, pa.string()), pa.array([n, *(found[w] for w in ws[1:])], pa.int64())], ["word", "n"])

    rows = docs.select(text_or_empty().alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n_in = {r["word"]: r["n"] for r in rows}
    total = n_in.pop("", 0)
    return {w: math.log((total + 1) / (n_in.get(w, 0) + 1)) for w in vocabulary}


SCANNED = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row for each document, with its licences (see SCANNED)."""
    arrow_batches(docs.sparkSession)
    index = Index(licence_idf(docs, Index({}, templates=templates).vocabulary), templates=templates)

    def run(batches):
        for b in batches:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ws = words(text)
                n, first, last, base, labels, score = index.scan(ws)
                rows.append((i, len(ws), n, first, last, ",".join(base), ",".join(labels), score))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], [x.split()[0] for x in SCANNED.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(trimming(run), SCANNED)
