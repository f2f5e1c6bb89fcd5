"""License scans: an exact set-similarity join of text blocks with license templates.

A template is found in a block if at least `threshold` of its distinct words are in it. Words are put in one global order,
rarest in the corpus first. If a block holds enough of a template, it must hold one of the template's first words in that
order (prefix filter), so only blocks around such words are looked at, and only where there are as many words as must be
shared (length filter). What is left is counted exactly. Blocks are windows of twice a template's length that start at any
word; they slide over the places of the template's words, so the work is linear.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_schema, batch_of, small_batches, utf8

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices in the words of the licenses.
TEMPLATES = {
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "mit-line": "Released under the MIT License.",
    "cc-by-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so"
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
}

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The words of a text: runs of ASCII letters, in lower case, digits and bytes beyond ASCII."""
    return text.translate(_WORDS).split()


@dataclass(frozen=True)
class Template:
    """Distinct words in global order, how many of them must be shared, and the words of its windows."""

    name: str
    order: list[bytes]
    needed: int
    window: int


def prepared(templates: Mapping[str, str], counts: Mapping[bytes, int], threshold: float) -> list[Template]:
    """Templates with their words in order of corpus counts, rarest first, equal counts by the word."""
    out = []
    for name, text in sorted(templates.items()):
        words = words_of(text.encode())
        order = sorted(set(words), key=lambda w: (counts.get(w, 0), w))
        if order:
            out.append(Template(name, order, max(1, math.ceil(threshold * len(order) - 1e-9)), 2 * len(words)))
    return out


def word_counts(docs: DataFrame, templates: Mapping[str, str]) -> dict[bytes, int]:
    """How often all documents have the words of the templates: as many rows as the templates have words."""
    wanted = {w for text in templates.values() for w in words_of(text.encode())}
    out = arrow_schema("word binary,n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("__bytes"):
                counts.update(filter(wanted.__contains__, words_of(text.as_py())))
        yield batch_of({"word": list(counts), "n": list(counts.values())}, out)

    counted = docs.select(utf8().alias("__bytes")).mapInArrow(count, "word binary, n long")
    return {bytes(r.word): r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def best_windows(words: list[bytes], templates: list[Template], prefix: Mapping[bytes, list[tuple[int, int]]]) -> dict:
    """{template: (share, first word, window)} of the best window of each template that reaches its threshold.

    `prefix` gives, for a word, the templates that have it among the first of their order, and its place there. A window
    starts at any word; of equal shares the first counts, which ends at a word of the template, or starts at the first word
    of the text. Where the rarest word of a template is at place p of its order, at most the words from p on are shared
    (positional filter), so places that cannot beat the best window are passed over.
    """
    anchors: dict[int, list[tuple[int, int]]] = {}
    for at, word in enumerate(words):
        if word in prefix:
            for number, place in prefix[word]:
                anchors.setdefault(number, []).append((at, place))
    found = {}
    for number, anchored in anchors.items():
        places = [at for at, _ in anchored]
        t = templates[number]
        wanted, best, begin = set(t.order), t.needed - 1, 0
        while begin < len(places):
            # anchors whose windows may overlap are one run
            end = begin + 1
            while end < len(places) and places[end] - places[end - 1] < 2 * t.window:
                end += 1
            low, high = max(places[begin] - t.window + 1, 0), min(places[end - 1] + t.window, len(words))
            most = len(t.order) - min(place for _, place in anchored[begin:end])
            begin = end
            if high - low < t.needed or most <= best:
                continue
            inside: Counter[bytes] = Counter()
            shared, first, own = 0, 0, [at for at in range(low, high) if words[at] in wanted]
            for at in own:
                shared += not inside[words[at]]
                inside[words[at]] += 1
                while own[first] <= at - t.window:
                    inside[words[own[first]]] -= 1
                    shared -= not inside[words[own[first]]]
                    first += 1
                if shared > best:
                    start = max(at - t.window + 1, 0)
                    best, found[t.name] = shared, (shared / len(t.order), start, min(t.window, len(words) - start))
    return found


def phrase_places(words: list[bytes], phrases: Mapping[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words stand one after the other."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases.items():
        wanted, at, word, counted = b" " + phrase.encode() + b" ", 0, 0, 0
        while (at := joined.find(wanted, at)) >= 0:
            word += joined.count(b" ", counted, at)
            counted = at
            found.append((word, label))
            at += 1
    return found


def scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, phrases: Mapping[str, str] = PHRASES, threshold: float = 0.9
) -> DataFrame:
    """`docs` without text, with n_words, n_base, first_word, last_word, base_labels, labels, score and templates.

    n_base counts the places of phrases; first_word and last_word are their smallest and largest start, else null.
    base_labels are the labels of the phrases found, labels those and the names of the templates found, both distinct,
    sorted and joined by commas. score is the largest share of a template found, 1 with a phrase, else 0. templates lists
    `name:first word:words` of the best block of each template.

    A null or empty text has no words and no labels. Repeated rows get equal results; columns of `docs` with the new names
    are replaced; an empty table gives no rows.
    """
    added = T.StructType.fromDDL(
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "templates array<string>"
    )
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", *added.names)]
    packed = small_batches(docs).select(utf8().alias("__bytes"), F.struct(*carried).alias("__row"))
    ready = prepared(templates, word_counts(docs, templates), threshold)
    prefix: dict[bytes, list[tuple[int, int]]] = {}
    for number, t in enumerate(ready):
        for place, word in enumerate(t.order[: len(t.order) - t.needed + 1]):
            prefix.setdefault(word, []).append((number, place))

    def row(text: bytes) -> tuple:
        words = words_of(text)
        base = phrase_places(words, phrases)
        similar = best_windows(words, ready, prefix) if not prefix.keys().isdisjoint(words) else {}
        labels = {label for _, label in base}
        starts = [at for at, _ in base]
        return (
            len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | similar.keys())),
            1.0 if base else max((share for share, _, _ in similar.values()), default=0.0),
            [f"{name}:{at}:{size}" for name, (_, at, size) in sorted(similar.items())],
        )

    kinds = (pa.int64(),) * 4 + (pa.string(),) * 2 + (pa.float64(), pa.list_(pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(t.as_py()) for t in batch.column("__bytes")]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("__row"), *columns], names=["__row", *added.names])

    result = T.StructType([packed.schema["__row"], *added.fields])
    return packed.mapInArrow(run, result).select("__row.*", *added.names)
