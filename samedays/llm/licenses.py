"""Licence scan with a positional index of rare words.

The templates are notices and key sentences of common licences. A template's rarest words, by inverse document
frequency over all files, make the index: word -> (template, place). A file looks up all its words; each place in
the file and each posting vote for the place where the template would begin. Templates whose votes agree on a place
are verified there: every mandatory phrase must stand consecutively near it, and the score is
the share of the template's words found in order of place.

The index is a few hundred postings, fixed by the templates, and is broadcast. Files are read once to count
frequencies and once to be scanned; nothing but counts is shuffled, and texts are taken whole.

Defined results: null and empty texts have no words, no labels and score 0. Repeated rows give repeated rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samedays.llm.common import document_frequencies, plain_words

#: Phrase and label.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Label, text, mandatory phrases. Sentences of the licences themselves.
TEMPLATES = (
    ("mit-notice", "released under the mit license", ("under the mit license",)),
    ("mit-notice", "licensed under the mit license", ("under the mit license",)),
    (
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    ("apache-2.0-notice", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    (
        "apache-2.0-text",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at http www apache org licenses license 2 0",
        ("apache license version 2 0", "except in compliance with the license"),
    ),
    (
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
        ("general public license", "free software foundation"),
    ),
    ("gpl-short-notice", "distributed under the gnu general public license", ("gnu general public license",)),
    ("gpl-short-notice", "under the terms of the gnu general public license", ("gnu general public license",)),
    (
        "lgpl-notice",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
        "public license as published by the free software foundation",
        ("lesser general public license",),
    ),
    (
        "bsd-text",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer",
        ("redistribution and use in source and binary forms", "must retain the above copyright notice"),
    ),
    (
        "isc-text",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    (
        "mpl-2.0-notice",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    (
        "unlicense-text",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
)

#: Rarest words of a template in the index.
INDEXED = 8
#: Words by which a match may be shifted inside (insertions such as a name or a year).
SLACK = 4
#: Share of a template's indexed words whose votes must agree, share of its words that a match needs, and the score
#: of a base phrase that no template explains.
VOTES, SCORE, PHRASE_SCORE = 0.4, 0.5, 0.5


class Index:
    """Postings of the templates' rarest words."""

    def __init__(self, idf: dict[bytes, float]) -> None:
        self.templates = [(label, plain_words(text), [plain_words(p) for p in phrases]) for label, text, phrases in TEMPLATES]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.needed = []
        for number, (_, words, _) in enumerate(self.templates):
            rare = sorted({w for w in words if w in idf}, key=lambda w: (-idf[w], w))[:INDEXED]
            for place, word in enumerate(words):
                if word in rare:
                    self.postings.setdefault(word, []).append((number, place))
            self.needed.append(max(1, math.ceil(VOTES * len(rare))))

    def candidates(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(template, first word) where votes of different words agree within the slack."""
        places: dict[bytes, list[int]] = {}
        for i, word in enumerate(words):
            if word in self.postings:
                places.setdefault(word, []).append(i)
        voters: dict[int, set[bytes]] = {}
        for word in places:
            for number, _ in self.postings[word]:
                voters.setdefault(number, set()).add(word)
        for number, own in voters.items():
            # votes of fewer different words cannot reach the number needed anywhere
            if len(own) < self.needed[number]:
                continue
            found = sorted((place - offset, word) for word in own for n, offset in self.postings[word] if n == number for place in places[word])
            begin, inside, past = 0, {}, None
            for start, word in found:
                inside[word] = inside.get(word, 0) + 1
                while found[begin][0] < start - SLACK:
                    gone = found[begin][1]
                    inside[gone] -= 1
                    if not inside[gone]:
                        del inside[gone]
                    begin += 1
                # every such place, so that chance votes just before a match do not hide it
                if len(inside) >= self.needed[number] and found[begin][0] != past:
                    past = found[begin][0]
                    yield number, past

    def verify(self, number: int, start: int, words: list[bytes]) -> float:
        """Share of the template's words in order near the place; 0 if a mandatory phrase is missing there."""
        _, template, phrases = self.templates[number]
        near = words[max(start - SLACK, 0) : max(start, 0) + len(template) + 3 * SLACK]
        run = b" " + b" ".join(near) + b" "
        if any(b" " + b" ".join(p) + b" " not in run for p in phrases):
            return 0.0
        at = matched = 0
        for word in template:
            window = near[at : at + 2 * SLACK + 1]
            if word in window:
                at += window.index(word) + 1
                matched += 1
        return matched / len(template)


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase, in order."""
    out = []
    for phrase, label in BASE_PHRASES:
        parts = phrase.encode().split()
        ends = [i for i, w in enumerate(words) if w == parts[-1]]
        back = len(parts) - 1
        out += [(i - back, label) for i in ends if i >= back and words[i - back : i + 1] == parts]
    return sorted(out)


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every document."""
    spark = documents.sparkSession
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    vocabulary = sorted({w for _, body, _ in TEMPLATES for w in plain_words(body)})
    # a few hundred counts, whatever the number of files
    counted = {row.word: row.n for row in document_frequencies(texts, {w: i for i, w in enumerate(vocabulary)}).collect()}
    total = counted.get(-1, 0)
    # a word of no file is in no text that could match; rarity only ranks a template's words, whatever their share
    present = {w: counted[i] for i, w in enumerate(vocabulary) if counted.get(i, 0)}
    idf = {w: math.log((1 + total) / (1 + n)) for w, n in present.items()}
    shared = spark.sparkContext.broadcast(Index(idf))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for batch in batches:
            out = []
            for body in batch["text"]:
                words = plain_words(body)
                places = phrase_places(words) if b"license" in words else []
                base = sorted({label for _, label in places})
                shares: dict[str, float] = {}
                for number, start in index.candidates(words):
                    label, share = index.templates[number][0], index.verify(number, start, words)
                    if share >= SCORE:
                        shares[label] = max(shares.get(label, 0.0), share)
                score = max([*shares.values(), PHRASE_SCORE if base else 0.0])
                first, last = (places[0][0], places[-1][0]) if places else (None, None)
                out.append((len(words), len(places), first, last, ",".join(base), ",".join(sorted({*base, *shares})), score))
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
            found = pd.DataFrame(out, columns=names, index=batch.index)
            yield pd.concat([batch[["doc_id"]], found.astype({"first_word": "Int64", "last_word": "Int64"})], axis=1)

    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return texts.mapInPandas(run, schema)
