"""License scans with a positional index of rare words.

Every template is a list of words; its index entries say at which positions a word stands in which template.
A scan takes a text's licence words in order of rarity over the whole corpus (highest IDF first). Each mandatory phrase is listed
under its rarest word, so only the phrases of words that are there are looked at, however many templates there are. The postings of a
phrase's rarest words are looked up: a word at text position p and template position t speaks for the template starting at p - t. The
starts on which they agree are verified: the whole phrase must stand there, and
a stated part of the template's words must stand in place. A template needs one of its mandatory phrases, and all words of
that phrase, so looking up the rarest ones misses none, however many licences a text holds.

Base phrases are counted over the whole text, wherever they stand. Their labels always stay; the templates add
theirs. ``score`` is the largest part of a verified template's words that stand in place, 1 for a text with a base phrase.

Defined results: a null text is empty: 0 words, no labels (empty strings), null places, score 0. Repeated rows are
scanned one by one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelattice.llm.common import slices
from hirelattice.llm.license_texts import FULL_TEXTS

# The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Opening sentences of public licences, with the phrases of which one must stand in place.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction",
     ["permission is hereby granted free of charge", "deal in the software without restriction"]),
    ("mit", "released under the mit license", ["under the mit license"]),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license", ["apache license version 2", "except in compliance with the license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
     ["creative commons attribution noncommercial"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4 0"]),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
     ["creative commons attribution sharealike"]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
     "the free software foundation", ["gnu general public license as published", "the free software foundation"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
     ["gnu lesser general public license"]),
    ("agpl-3", "under the terms of the gnu affero general public license as published by the free software foundation",
     ["gnu affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", ["redistribution and use in source and binary forms", "following conditions are met"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", ["permission to use copy modify and or distribute"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held "
     "liable for any damages arising from the use of this software",
     ["in no event will the authors be held liable for any damages"]),
]

# Upper case to lower case; all other ASCII than letters and digits to blanks; bytes of other characters stay.
_WORD_BYTES = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else 32 if b < 128 else b for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text: runs of ASCII letters and digits (lower-cased) and non-ASCII characters."""
    return text.translate(_WORD_BYTES).split() if text else []


@dataclass
class Index:
    """Templates by word: ``postings[word]`` lists (template, position)."""

    looked_up: int = 3  # words of a mandatory phrase that must agree before it is compared
    part: float = 0.6  # of a template's words, at least so many in place
    labels: list[str] = field(default_factory=list)
    words: list[list[bytes]] = field(default_factory=list)
    phrases: list[list[tuple[int, list[bytes]]]] = field(default_factory=list)
    postings: dict[bytes, list[tuple[int, int]]] = field(default_factory=lambda: defaultdict(list))
    base: list[tuple[list[bytes], str]] = field(default_factory=list)

    def add(self, label: str, text: str, mandatory: list[str]) -> None:
        words, number = words_of(text.encode()), len(self.words)
        self.labels.append(label)
        self.words.append(words)
        starts = []
        for phrase in (words_of(p.encode()) for p in mandatory):
            at = next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
            starts.append((at, phrase))
        self.phrases.append(starts)
        for position, word in enumerate(words):
            self.postings[word].append((number, position))


def build_index(templates=(*TEMPLATES, *FULL_TEXTS), base=BASE) -> Index:
    index = Index()
    for label, text, mandatory in templates:
        index.add(label, text, mandatory)
    index.postings = dict(index.postings)
    index.base = [(words_of(p.encode()), label) for p, label in base.items()]
    return index


def word_rarity(documents: DataFrame, index: Index) -> dict[bytes, float]:
    """IDF of every licence word over all documents; as many values as the templates have words."""
    vocabulary = index.postings.keys()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        rows = 0
        for batch in slices(batches, "text"):
            rows += batch.num_rows
            for text in batch.column("text").to_pylist():
                seen.update(vocabulary & set(words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *seen], pa.binary()), pa.array([rows, *seen.values()], pa.int64())], names=["word", "n"]
        )

    counted = documents.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "word binary, n long")
    found = {None if w is None else bytes(w): n for w, n in counted.groupBy("word").agg(F.sum("n")).collect()}
    total = found.pop(None, 0)
    return {w: math.log((1 + total) / (1 + found.get(w, 0))) for w in vocabulary}


def _places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Where the phrase starts, looked for by its rarest-looking (longest) word."""
    anchor = max(range(len(phrase)), key=lambda i: len(phrase[i]))
    places, at = [], -1
    for _ in range(words.count(phrase[anchor])):
        at = words.index(phrase[anchor], at + 1)
        start = at - anchor
        if start >= 0 and words[start:start + len(phrase)] == phrase:
            places.append(start)
    return places


def _in_place(words: list[bytes], start: int, template: list[bytes]) -> int:
    begin = max(0, -start)
    return sum(a == b for a, b in zip(template[begin:], words[start + begin:start + len(template)], strict=False))


def rarest_words(index: Index, rarity: dict[bytes, float]) -> dict[bytes, list[tuple[int, list[bytes], int, list[bytes]]]]:
    """The mandatory phrases by their rarest word: (template, rarest words, place, phrase)."""
    listed = defaultdict(list)
    for number, phrases in enumerate(index.phrases):
        for place, phrase in phrases:
            rare = sorted(set(phrase), key=lambda w: (-rarity[w], w))[:index.looked_up]
            listed[rare[0]].append((number, rare, place, phrase))
    return dict(listed)


def find_templates(words: list[bytes], present: set[bytes], index: Index, rarity: dict[bytes, float], listed: dict) -> dict[str, float]:
    """Labels of verified templates with the best part of their words in place."""
    own = sorted(present & listed.keys(), key=lambda w: (-rarity[w], w))
    live = [entry for word in own for entry in listed[word] if present.issuperset(entry[1])]
    looked_up = {w for _, rare, _, _ in live for w in rare}
    if not looked_up:
        return {}
    starts: dict[tuple[int, bytes], set[int]] = defaultdict(set)  # of a template, as a word of it says
    for position, word in enumerate(words):
        if word in looked_up:
            for number, place in index.postings[word]:
                starts[number, word].add(position - place)
    found: dict[str, float] = {}
    for number, rare, place, phrase in live:
        agreed = set.intersection(*(starts[number, w] for w in rare))
        body, label = index.words[number], index.labels[number]
        for start in agreed:
            if start + place < 0 or words[start + place:start + place + len(phrase)] != phrase:
                continue
            part = _in_place(words, start, body) / len(body)
            if part >= index.part:
                found[label] = max(part, found.get(label, 0.0))
    return found


def scan(documents: DataFrame, index: Index | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every document."""
    index = index or build_index()
    rarity = word_rarity(documents, index)
    listed = rarest_words(index, rarity)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base_words = [set(phrase) for phrase, _ in index.base]
        for batch in slices(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                present = set(words)
                places, base = [], set()
                for (phrase, name), needed in zip(index.base, base_words, strict=True):
                    here = _places(words, phrase) if needed <= present else []
                    places += here
                    if here:
                        base.add(name)
                found = find_templates(words, present, index, rarity, listed)
                rows.append((
                    len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
                    ",".join(sorted(base | found.keys())), 1.0 if base else max(found.values(), default=0.0),
                ))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    source = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        label, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double"
    )
