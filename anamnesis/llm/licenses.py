"""License scans with a positional index of the templates' rare words."""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases whose words, standing consecutively, name a license.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label, words of a well-known notice, and the phrases without which it is not that notice.
#: Where versions or variants differ, a phrase that only one of them has tells them apart.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction",
     ["permission is hereby granted free of charge", "without restriction"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies",
     ["with or without fee is hereby granted"]),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
               "with the license",
     ["apache license version 2 0"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation",
     ["gnu general public license", "free software"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("gpl-2", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license",
     ["gnu general public license", "version 2"]),
    ("gpl-3", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license",
     ["gnu general public license", "version 3"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
     ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation",
     ["gnu affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met",
     ["redistribution and use in source and binary forms"]),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission",
     ["endorse or promote products"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license",
     ["eclipse public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution"]),
]
#: Words that may be put in or left out between two words of a notice before they count as missing.
BAND = 3

#: Digits, small letters and all beyond ASCII stay, capitals become small, the rest parts words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    required: tuple[bytes, ...]  # each as ' word word '


def _spaced(phrase: str) -> bytes:
    return b" " + phrase.encode() + b" "


def templates(texts=TEMPLATES) -> list[Template]:
    return [
        Template(label, tuple(words_of(text.encode())), tuple(map(_spaced, required)))
        for label, text, required in texts
    ]


def license_words(known: list[Template]) -> frozenset[bytes]:
    return frozenset(w for t in known for w in t.words)


def document_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> DataFrame:
    """(word, n): in how many of all the documents each word of the templates stands."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(vocabulary.intersection(words_of(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    parts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(counted, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """Postings (template, position) of each template's rarest words, by the corpus' document counts.

    A template is posted under as many of its rarest words as may be missing, and
    one more: wherever ``least`` of its words stand, one of those does. So a text
    is looked up by its rare licence words alone, and what that costs follows the
    hits, not the number of templates.
    """

    def __init__(self, known: list[Template], counts: dict[bytes, int], least: float = 0.75, band: int = BAND):
        self.known, self.least, self.band = known, least, band
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for number, template in enumerate(known):
            rare = sorted(range(len(template.words)), key=lambda i: (counts.get(template.words[i], 0), template.words[i], i))
            for position in rare[:self.may_miss(number) + 1]:
                self.postings.setdefault(template.words[position], []).append((number, position))
        self.keys = frozenset(self.postings)

    def may_miss(self, number: int) -> int:
        size = len(self.known[number].words)
        return size - ceil(self.least * size)

    def share(self, number: int, shift: int, words: list[bytes]) -> float:
        """Of a template's words, how many stand within the band of their place; 0 when too many miss."""
        template, missing = self.known[number].words, self.may_miss(number)
        for i, word in enumerate(template, shift):
            if word not in words[max(i - self.band, 0):max(i + self.band + 1, 0)]:
                missing -= 1
                if missing < 0:
                    return 0.0
        return (len(template) - self.may_miss(number) + missing) / len(template)

    def match(self, words: list[bytes], spaced: bytes) -> dict[str, float]:
        """Label -> the best share of a template's words in place, for those verified.

        Rare words give templates and their places in the text; where such a place
        holds, the template's phrases are searched.
        """
        if self.keys.isdisjoint(words):
            return {}
        shifts: dict[int, set[int]] = {}
        for at, word in enumerate(words):
            if word in self.keys:
                for number, position in self.postings[word]:
                    shifts.setdefault(number, set()).add(at - position)
        best: dict[str, float] = {}
        for number, places in shifts.items():
            template = self.known[number]
            share = max(self.share(number, shift, words) for shift in places)
            if share and all(phrase in spaced for phrase in template.required):
                best[template.label] = max(best.get(template.label, 0.0), share)
        return best


def phrase_places(words: list[bytes], spaced: bytes, phrases: dict[bytes, str]) -> list[tuple[int, str]]:
    """(first word's number, label) of every place where a phrase's words stand consecutively."""
    places = []
    for phrase, label in phrases.items():
        at, number, seen = spaced.find(phrase), 0, 0
        while at >= 0:
            number += spaced.count(b" ", seen, at)
            seen = at
            places.append((number, label))
            at = spaced.find(phrase, at + 1)
    return places


def scan(docs: DataFrame, least: float = 0.75, band: int = BAND) -> DataFrame:
    """License labels of every whole text.

    Rows: ``doc_id``, ``n_words``, ``n_base``, ``first_word`` and ``last_word`` (null
    without a place), ``base_labels``, ``labels`` and ``score``, the best share of a
    template's words in place (0 without one, 1 where a phrase alone stands).

    A first pass counts in how many documents each word of the templates stands;
    its result has as many rows as the templates have words. The second looks up a
    text's rare licence words, takes templates and relative positions from their
    postings, keeps places where ``least`` of a template's words stand, each up to
    ``band`` words off, and verifies the mandatory phrases last. So a notice bears a
    word put in, left out or changed, and a text may hold any number of notices.
    Null and empty texts have no words; repeated rows stay; other columns are
    ignored; an empty table gives no rows.
    """
    known = templates()
    vocabulary = license_words(known)
    counts = {r["word"].encode(): r["n"] for r in document_counts(docs, vocabulary).collect()}
    index = Index(known, counts, least, band)
    phrases = {_spaced(p): label for p, label in PHRASES.items()}
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                spaced = b" " + b" ".join(words) + b" "
                places = phrase_places(words, spaced, phrases)
                base = sorted({label for _, label in places})
                found = index.match(words, spaced)
                at = [number for number, _ in places]
                rows.append((len(words), len(places), min(at, default=None), max(at, default=None), ",".join(base),
                             ",".join(sorted({*base, *found})), max([*found.values(), 1.0 if base else 0.0])))
            columns = zip(*rows) if rows else [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], names)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        scanned, f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")
