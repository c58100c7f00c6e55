"""Licence scans by a positional index of rare words.

Templates are short licence texts with mandatory key phrases. The index lists every template word's
postings (template, place); its weight is the IDF over the scanned documents themselves. A file's licence words
are found in one pass. For each template whose key phrases' words are all there, the file's
rarest words of that template are looked up in the postings, and every place votes for the relative position
file place - template place. Votes that lie within ``SLACK`` of each other, since a file may add
or leave out words, make a place of the template. It counts if every key phrase stands there, word
after word. Phrases of the base rule are templates that allow no slack: all their words at one relative position.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.alnum import Words, normal_form
from wordloom.llm.words import slices


class Template(NamedTuple):
    label: str
    text: str
    #: Phrases of ``text`` that a file must hold.
    keys: tuple[str, ...]


# The phrases of the base rule, and the opening or central sentences of public licences.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = (
    Template("mit-notice", "released under the mit license", ("under the mit license",)),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template(
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation",
        ("you can redistribute it and or modify it", "as published by the free software foundation"),
    ),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "provided that the following conditions are met"),
    ),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute this software",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software released into the public domain",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("under cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("under cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("under cc by nc 4 0",)),
    Template("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("under cc by nd 4 0",)),
    Template("cc-by-nc-sa-4.0", "licensed under cc by nc sa 4 0", ("under cc by nc sa 4 0",)),
    Template("cc-by-nc-nd-4.0", "licensed under cc by nc nd 4 0", ("under cc by nc nd 4 0",)),
    Template("cc0-1.0", "released under cc0 1 0 universal", ("cc0 1 0",)),
    Template("cc-attribution", "licensed under a creative commons attribution license", ("creative commons attribution",)),
)

#: Rarest words of a template, held by the file, that vote for a place.
ANCHORS = 6
#: Words that a file may add to a template, or leave out.
SLACK = 6
#: Words that are split from a normal form at a time.
BLOCK = 1 << 16


class Index:
    """The vocabulary, postings and phrases of a set of templates."""

    def __init__(self, templates: tuple[Template, ...] = TEMPLATES, base: dict[str, str] | None = None):
        self.templates = templates
        self.base = [(label, phrase.split()) for phrase, label in (BASE if base is None else base).items()]
        texts = [t.text.split() for t in templates]
        keys = [[k.split() for k in t.keys] for t in templates]
        every = sorted({w for ws in (*texts, *(k for t in keys for k in t), *(p for _, p in self.base)) for w in ws})
        self.ids = {w.encode(): n for n, w in enumerate(every)}
        self.texts = [self._coded(ws) for ws in texts]
        self.keys = [[self._coded(k) for k in t] for t in keys]
        self.phrases = [(label, self._coded(p)) for label, p in self.base]

    def _coded(self, words: list[str]) -> np.ndarray:
        return np.array([self.ids[w.encode()] for w in words], np.int64)


def places(words: Words, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(word number, id) of all words of the vocabulary; words are compared as they are, not by a hash."""
    at, ids, look = [], [], index.ids.get
    for a in range(0, len(words.starts), BLOCK):
        b = min(a + BLOCK, len(words.starts))
        piece = words.data[words.starts[a] : words.ends[b - 1]].tobytes().split(b" ")
        found = np.fromiter((look(w, -1) for w in piece), np.int64, b - a)
        held = np.flatnonzero(found >= 0)
        at.append(held + a)
        ids.append(found[held])
    return (np.concatenate(at), np.concatenate(ids)) if at else (np.empty(0, np.int64), np.empty(0, np.int64))


def document_frequencies(docs: DataFrame, index: Index, text: str = "text") -> tuple[int, np.ndarray]:
    """The number of texts, and of those that hold each word of the vocabulary; one number per word reaches the driver."""
    n = len(index.ids)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n + 1, np.int64)
        for batch in batches:
            for piece in slices(batch):
                words = normal_form(piece.column(0))
                at, ids = places(words, index)
                row = np.searchsorted(np.cumsum(words.per_row), at, "right")
                total[:n] += np.bincount(np.unique(row * n + ids) % n, minlength=n)
                total[n] += piece.num_rows
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["id", "n"])

    counted = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(task, "id bigint, n bigint")
    total = np.zeros(n + 1, np.int64)
    for word, count in counted.groupBy("id").agg(F.sum("n")).collect():
        total[word] = count
    return int(total[n]), total[:n]


def idf(n_docs: int, frequencies: np.ndarray) -> np.ndarray:
    return np.log((n_docs + 1) / (frequencies + 1)) + 1


def phrase_places(at: np.ndarray, ids: np.ndarray, phrase: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """First words of all places where the phrase stands, from the places of its rarest word outwards."""
    order = sorted(range(len(phrase)), key=lambda j: (-weight[phrase[j]], j))
    first = at[ids == phrase[order[0]]] - order[0]
    for j in order[1:]:
        if not len(first):
            break
        near = np.minimum(np.searchsorted(at, first + j), len(at) - 1)
        first = first[(at[near] == first + j) & (ids[near] == phrase[j])]
    return first


def template_share(at: np.ndarray, ids: np.ndarray, text: np.ndarray, keys: list[np.ndarray], weight: np.ndarray) -> float:
    """The weight of the template's words that stand in their order of place at its best verified place; 0 if there is none."""
    found = [phrase_places(at, ids, key, weight) for key in keys]
    if not all(len(f) for f in found):
        return 0.0
    held = np.unique(ids)
    rare = sorted(set(text.tolist()) & set(held.tolist()), key=lambda w: (-weight[w], w))[:ANCHORS]
    votes = np.unique(np.concatenate([at[ids == text[j]] - j for j in range(len(text)) if text[j] in rare]))
    cuts = np.flatnonzero(np.diff(votes) > SLACK) + 1
    low, high = votes[np.append(0, cuts)], votes[np.append(cuts, len(votes)) - 1]
    whole = np.ones(len(low), bool)
    for f, key in zip(found, keys):  # every key phrase lies inside
        first = np.minimum(np.searchsorted(f, low - SLACK), len(f) - 1)
        whole &= (f[first] >= low - SLACK) & (f[first] + len(key) <= high + len(text) + SLACK)
    low, high = low[whole], high[whole]
    share = np.zeros(len(low))
    for j, word in enumerate(text.tolist()):
        own = at[ids == word] - j
        if len(own):
            near = np.minimum(np.searchsorted(own, low - SLACK), len(own) - 1)
            share += weight[word] * ((own[near] >= low - SLACK) & (own[near] <= high + SLACK))
    return float(share.max(initial=0.0) / weight[text].sum())


def scan(docs: DataFrame, index: Index | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row of ``docs`` (doc_id, text, other columns).

    ``n_base`` counts the places of the base phrases, overlapping ones too, ``first_word`` and ``last_word`` are
    their least and greatest first words, from 0, or null. ``labels`` adds the templates found; both lists are distinct,
    sorted and comma-joined, empty if there are none. ``score`` is the best share of a template's weight found, 1 for
    a base phrase, 0 without a label. A null or empty text has no words and no labels. Repeated rows are
    scanned each; an empty table gives no rows.
    """
    index = index or Index()
    weight = idf(*document_frequencies(docs, index))
    key = docs.schema["doc_id"].dataType.simpleString()
    needed = [np.unique(np.concatenate(keys)) for keys in index.keys]

    def judge(at: np.ndarray, ids: np.ndarray) -> tuple:
        have = np.zeros(len(index.ids), bool)
        have[ids] = True
        base = [(label, phrase_places(at, ids, phrase, weight)) for label, phrase in index.phrases if have[phrase].all()]
        base = [(label, first) for label, first in base if len(first)]
        firsts = np.concatenate([first for _, first in base]) if base else at[:0]
        base_labels = {label for label, _ in base}
        best = {label: 1.0 for label in base_labels}
        for template, text, keys, need in zip(index.templates, index.texts, index.keys, needed):
            if have[need].all():
                share = template_share(at, ids, text, keys, weight)
                if share > 0:
                    best[template.label] = max(share, best.get(template.label, 0.0))
        edges = (int(firsts.min()), int(firsts.max())) if len(firsts) else (None, None)
        return len(firsts), *edges, ",".join(sorted(base_labels)), ",".join(sorted(best)), min(1.0, max(best.values(), default=0.0))

    none = (0, None, None, "", "", 0.0)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
        names = ["n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        for batch in batches:
            for piece in slices(batch):
                words = normal_form(piece.column(1))
                at, ids = places(words, index)
                ends = np.cumsum(words.per_row)
                cuts = np.searchsorted(at, np.append(0, ends))
                rows = [
                    judge(at[a:b] - (end - n), ids[a:b]) if b > a else none
                    for a, b, end, n in zip(cuts[:-1].tolist(), cuts[1:].tolist(), ends.tolist(), words.per_row.tolist())
                ]
                columns = [pa.array(column, t) for column, t in zip(zip(*rows), types)]
                yield pa.record_batch([piece.column(0), pa.array(words.per_row, pa.int64()), *columns], names=["doc_id", "n_words", *names])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {key}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    return rows.mapInArrow(task, schema)
