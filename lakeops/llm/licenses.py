"""License texts in documents: phrases, and templates that a block of text contains.

A block is a window of words, across lines: one starts at every place of a word of the template,
and is as long as the template and a quarter more. A block contains a template if at least
`THRESHOLD` of the template's different words are in it, all words without which it would be
another license, and none that make it another one.

The join of blocks and templates is exact and compares few pairs. Words are put in one order, by
how often they occur in all documents, rarest first; words of no template come before all, as
none is shared. If a block contains a template of n words by c = ceil(THRESHOLD * n), then

- it holds one of the template's n - c + 1 rarest (prefix filter): only blocks around the places
  of such words are looked at;
- it has c different words itself (length filter);
- if the first word they share has place p of n in the template and place q of m in the block,
  both in that order, they share min(n - p, m - q) at most (position filter).

What passes is counted in full. Templates are a parameter; only their words are counted over the
corpus, by partial sums, so what the driver holds grows with the templates alone.

Defined cases: a null or empty text has no words, blocks or labels; a block's repeated words
count once; a block at the end of a text is shorter; rows that repeat give the same result each;
templates alike in words give each its label; an empty table gives no rows; other columns are not
touched.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import WORD_BYTES

THRESHOLD = 0.8
# Phrases of the base labels (fixed values).
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}


@dataclass(frozen=True)
class Template:
    """Words that declare a license; a block has all of `needs` and none of `bars`."""

    text: str
    needs: str = ""
    bars: str = ""


# Sentences by which licenses are declared, with a label for each (fixed values).
TEMPLATES = {
    "apache": Template("Released under the Apache License", needs="apache"),
    "apache-2.0": Template("Licensed under the Apache License, Version 2.0", needs="apache 2"),
    "mit": Template("Released under the MIT License", needs="mit"),
    "mit-grant": Template(
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software"
    ),
    "mit-offer": Template(
        "Permission is hereby granted, free of charge, to any person obtaining a copy", bars="use"
    ),
    "isc": Template(
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies",
        needs="fee purpose",
    ),
    "bsd": Template("Released under the BSD License", needs="bsd"),
    "bsd-terms": Template(
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "gpl-3.0": Template(
        "This work is licensed under the GNU General Public License, version 3", needs="gnu 3", bars="lesser affero"
    ),
    "gpl-free": Template(
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation",
        bars="lesser affero",
    ),
    "lgpl": Template("GNU Lesser General Public License", needs="lesser"),
    "agpl": Template("GNU Affero General Public License", needs="affero"),
    "cc-by-4.0": Template("Licensed under CC BY 4.0", needs="cc by", bars="nc sa nd"),
    "cc-by-sa-4.0": Template("Licensed under CC BY-SA 4.0", needs="cc sa", bars="nc nd"),
    "cc-by-nc-4.0": Template("Licensed under CC BY-NC 4.0", needs="cc nc", bars="sa nd"),
    "cc-by-nd-4.0": Template("Licensed under CC BY-ND 4.0", needs="cc nd", bars="nc sa"),
    "cc-by-nc-sa-4.0": Template("Licensed under CC BY-NC-SA 4.0", needs="cc nc sa", bars="nd"),
    "mpl-2.0": Template(
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", needs="mozilla"
    ),
    "all-rights": Template("Copyright. All rights reserved", needs="rights reserved"),
}


def words(text: bytes) -> list[bytes]:
    return WORD_BYTES.findall(text.lower())


def _needed(n: int) -> int:
    """Words that a block must share with a template of `n`; exact, not by rounded products."""
    return math.ceil(round(THRESHOLD * 100) * n / 100)


def block_size(n: int) -> int:
    """Words of a block for a template of `n` words, repeats included."""
    return n + n // 4


class Matcher:
    """Templates in global order of words, and the index on their prefixes."""

    def __init__(self, templates: dict[str, Template], frequency: dict[bytes, int]):
        every = {w for t in templates.values() for w in words(t.text.encode())}
        # Places in the order; a word of no template comes before all.
        order = sorted(every, key=lambda w: (frequency.get(w, 0), w))
        self.place = {w: i for i, w in enumerate(order)}
        self.templates, self.index = {}, {}
        # What each filter let through, for tests.
        self.passed = Counter()
        for label, template in sorted(templates.items()):
            found = words(template.text.encode())
            own = sorted(set(found), key=self.place.__getitem__)
            need = _needed(len(own))
            limits = [frozenset(words(x.encode())) for x in (template.needs, template.bars)]
            at = {w: p for p, w in enumerate(own)}
            self.templates[label] = (at, need, block_size(len(found)), *limits)
            for w in own[: len(own) - need + 1]:
                self.index.setdefault(w, []).append(label)

    def labels(self, text: list[bytes]) -> dict[str, float]:
        """Templates that a block of the text contains, and how far at most."""
        starts: dict[str, set[int]] = {}
        for at, w in enumerate(text):
            for label in self.index.get(w, ()):
                own, _, size, _, _ = self.templates[label]
                near = range(max(0, at - size + 1), at + 1)
                starts.setdefault(label, set()).update(i for i in near if text[i] in own)
        out = {}
        for label, places in starts.items():
            part = max((self._part(label, text, i) for i in places), default=0.0)
            if part:
                out[label] = part
        return out

    def _part(self, label: str, text: list[bytes], start: int) -> float:
        own, need, size, needs, bars = self.templates[label]
        have = set(text[start : start + size])
        self.passed["prefix"] += 1
        if len(have) < need:
            return 0.0
        self.passed["length"] += 1
        shared = have & own.keys()
        first = min(shared, key=self.place.__getitem__)
        # Words of the block before the first shared one: of no template, or rarer ones of others.
        before = sum(1 for w in have if self.place.get(w, -1) < self.place[first])
        if min(len(own) - own[first], len(have) - before) < need:
            return 0.0
        self.passed["position"] += 1
        if len(shared) < need or not needs <= have or bars & have:
            return 0.0
        self.passed["all"] += 1
        return len(shared) / len(own)


def _frequencies(df: DataFrame, text: str, templates: dict[str, Template]) -> dict[bytes, int]:
    """How often each word of the templates occurs in all texts."""
    wanted = frozenset(w for t in templates.values() for w in words(t.text.encode()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for t in b.column("_text").cast(pa.binary()):
                found.update(filter(wanted.__contains__, words(t.as_py() or b"")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
            ["word", "n"],
        )

    rows = df.select(F.col(f"`{text}`").alias("_text")).mapInArrow(run, "word binary, n long")
    return {bytes(r[0]): r[1] for r in rows.groupBy("word").agg(F.sum("n")).collect()}


def _phrase_places(found: list[bytes], phrases: list[tuple[list[bytes], str]]):
    """Start and label of every place where a phrase's words stand in a row."""
    for phrase, label in phrases:
        at = -1
        while True:
            try:
                at = found.index(phrase[0], at + 1)
            except ValueError:
                break
            if found[at : at + len(phrase)] == phrase:
                yield at, label


def scan(
    df: DataFrame,
    templates: dict[str, Template] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: words, phrases and their places, labels of both kinds, and `score`,
    the greatest containment; a phrase is contained in full."""
    templates = TEMPLATES if templates is None else templates
    matcher = Matcher(templates, _frequencies(df, text, templates))
    phrases = [(words(p.encode()), label) for p, label in PHRASES.items()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column("_text").cast(pa.binary()):
                every = words(t.as_py() or b"")
                places = list(_phrase_places(every, phrases))
                found = matcher.labels(every)
                base = {label for _, label in places}
                starts = [at for at, _ in places]
                rows.append(
                    (len(every), len(places), min(starts, default=None), max(starts, default=None),
                     ",".join(sorted(base)), ",".join(sorted(base | set(found))),
                     1.0 if base else max(found.values(), default=0.0))
                )
            cols = list(zip(*rows)) if rows else [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, types)]],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )
