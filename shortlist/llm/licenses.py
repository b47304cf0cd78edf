"""Licence notices by a positional index of rare words.

The index has, for each template, its ``ANCHORS`` words of the highest inverse
document frequency, which is counted over the whole corpus, with their places. A file looks
up its words; an anchor at place f of the file and t of the template votes for
the notice to start at f - t. Where votes that lie within ``SLACK`` words of each
other hold at least ``VOTES`` of the template's anchor weight, the notice is a
candidate. It is verified by the template's mandatory phrases, each of which must
stand there word for word, and scored by the weighted share of the template's
words found near their place; ``COVERAGE`` of it names the licence. Short phrases that alone name a licence are
found at every place they stand.

The index is of fixed size, and each file is read whole in one task.

Cases: a null or empty text has no words and no labels, score 0, and null first
and last places; a repeated row gets the same result; an empty table gives
no row. All columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANCHORS = 8
SLACK = 8
# More starts of a notice than this are compared all at once, in blocks.
FEW_STARTS, START_BLOCK = 8, 1 << 16
VOTES = 0.6
COVERAGE = 0.6
PIECE = 1 << 20

# Phrases that name a licence, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, mandatory phrases, and text of well-known licence notices.
TEMPLATES = (
    ("mit", ("mit license",), "Released under the MIT License."),
    ("apache-2.0", ("apache license version 2 0",), "Licensed under the Apache License, Version 2.0."),
    (
        "gpl-3.0",
        ("gnu general public license version 3",),
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    ("cc-by-4.0", ("cc by 4 0",), "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", ("cc by sa 4 0",), "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", ("cc by nc 4 0",), "Licensed under CC BY-NC 4.0."),
    (
        "mit",
        ("permission is hereby granted free of charge", "without restriction"),
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "apache-2.0",
        ("licensed under the apache license version 2 0", "except in compliance with the license"),
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "gpl-3.0-or-later",
        ("gnu general public license", "either version 3 of the license or"),
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ),
    (
        "gpl-2.0-or-later",
        ("gnu general public license", "either version 2 of the license or"),
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version.",
    ),
    (
        "lgpl-2.1-or-later",
        ("gnu lesser general public license",),
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "agpl-3.0-or-later",
        ("gnu affero general public license",),
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "bsd",
        ("redistribution and use in source and binary forms with or without modification are permitted",),
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    (
        "isc",
        ("permission to use copy modify and or distribute this software for any purpose",),
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl-2.0",
        ("mozilla public license v 2 0",),
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        ("released into the public domain",),
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
)

# Lower-cases A-Z, keeps digits, letters and all bytes beyond ASCII, and makes spaces of the rest.
_KEPT = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i > 127 else 32 for i in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_KEPT).split()


def vocabulary(templates=TEMPLATES, phrases=PHRASES) -> dict[bytes, int]:
    texts = [*phrases, *[t for _, must, body in templates for t in (*must, body)]]
    return {w: n + 1 for n, w in enumerate(sorted({w for t in texts for w in words_of(t)}))}


def numbered(terms: dict[bytes, int], words: list[bytes]) -> np.ndarray:
    return np.fromiter((terms.get(w, 0) for w in words), np.int32, len(words))


def numbered_text(terms: dict[bytes, int], text: str | None) -> np.ndarray:
    """The term of every word, 0 for words of no template; read in pieces, so that a long text needs little memory."""
    text, at, found = text or "", 0, []
    while at < len(text):
        end = at + PIECE
        while end < len(text) and not text[end].isspace():
            end += 1
        found.append(numbered(terms, words_of(text[at:end])))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.int32)


def places(numbers: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of a phrase stand one after another."""
    n = len(numbers) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    found = np.flatnonzero(numbers[:n] == phrase[0])
    for k in range(1, len(phrase)):
        found = found[numbers[found + k] == phrase[k]]
    return found


class Index:
    def __init__(self, terms: dict[bytes, int], held: np.ndarray, files: float, templates=TEMPLATES, phrases=PHRASES):
        """``held[t]`` of ``files`` files hold term t."""
        self.terms = terms
        self.weight = np.log((files + 1) / (held + 1)) + 1e-3
        self.weight[0] = 0
        self.phrases = [(numbered(terms, words_of(p)), label) for p, label in phrases.items()]
        self.templates = []
        postings = []
        for k, (label, must, body) in enumerate(templates):
            words = numbered(terms, words_of(body))
            ranked = sorted(set(words.tolist()), key=lambda t: (-self.weight[t], t))[:ANCHORS]
            spots = np.flatnonzero(np.isin(words, ranked))
            postings += [(int(words[s]), k, int(s)) for s in spots]
            need = VOTES * self.weight[words[spots]].sum()
            self.templates.append((label, [numbered(terms, words_of(m)) for m in must], words, need))
        postings.sort()
        term, self.template, self.spot = (np.array(x, np.int64) for x in zip(*postings))
        self.at = np.searchsorted(term, np.arange(len(terms) + 2))

    def candidates(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, first start, last start) of runs of votes that are strong enough."""
        place = np.flatnonzero(numbers)
        term = numbers[place]
        n = self.at[term + 1] - self.at[term]
        place, term, n = place[n > 0], term[n > 0], n[n > 0]
        if not len(place):
            return
        posting = np.repeat(self.at[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
        template, start = self.template[posting], np.repeat(place, n) - self.spot[posting]
        weight = np.repeat(self.weight[term], n)
        for k in np.unique(template).tolist():
            own = np.flatnonzero(template == k)
            own = own[np.argsort(start[own], kind="stable")]
            starts, sums = start[own], np.concatenate([[0.0], np.cumsum(weight[own])])
            upto = np.searchsorted(starts, starts + SLACK, side="right")
            strong = np.flatnonzero(sums[upto] - sums[np.arange(len(starts))] >= self.templates[k][3] - 1e-9)
            for run in np.split(strong, np.flatnonzero(np.diff(starts[strong]) > SLACK) + 1):
                if len(run):
                    yield k, int(starts[run[0]]), int(starts[upto[run[-1]] - 1])

    def best_start(self, numbers: np.ndarray, words: np.ndarray, first: int, last: int) -> tuple[float, int]:
        """The largest weight that a start from ``first`` to ``last`` covers, and the first such start.

        Each word of the template is looked for around its place after all starts at once.
        """
        total = np.zeros(last - first + 1)
        reach = np.arange(first - SLACK - 1, last + len(words) + SLACK)
        stretch = np.where((reach >= 0) & (reach < len(numbers)), numbers[np.clip(reach, 0, max(0, len(numbers) - 1))], -1)
        counts: dict[int, np.ndarray] = {}
        for i, word in enumerate(words.tolist()):
            if word not in counts:
                counts[word] = np.cumsum(stretch == word)
            upto = counts[word][i : i + len(total) + 2 * SLACK + 1]
            total += self.weight[word] * (upto[2 * SLACK + 1 :] > upto[: len(total)])
        return float(total.max()), first + int(np.argmax(total >= total.max() - 1e-9))

    def verify(self, numbers: np.ndarray, k: int, first: int, last: int) -> tuple[bool, float, int, int]:
        """Whether the mandatory phrases stand there, the covered share, and the stretch of the file."""
        _, must, words, _ = self.templates[k]
        a, b = max(0, first - SLACK), min(len(numbers), last + len(words) + SLACK)
        stretch = numbers[a:b]
        complete = all(len(places(stretch, m)) for m in must)
        weight, best = self.weight[words], 0.0
        starts = range(first, last + 1)
        if len(starts) > FEW_STARTS:
            at = max(range(first, last + 1, START_BLOCK), key=lambda b: self.best_start(numbers, words, b, min(last, b + START_BLOCK - 1))[0])
            starts = [self.best_start(numbers, words, at, min(last, at + START_BLOCK - 1))[1]]
        for start in starts:
            hit = np.zeros(len(words), bool)
            for shift in range(-SLACK, SLACK + 1):
                spot = np.arange(len(words)) + start + shift
                inside = (spot >= 0) & (spot < len(numbers))
                hit[inside] |= numbers[spot[inside]] == words[inside]
            best = max(best, float(weight[hit].sum() / weight.sum()))
            if best >= 1 - 1e-12:
                break
        return complete, min(1.0, best), a, b

    def scan(self, text: str | None) -> tuple:
        numbers = numbered_text(self.terms, text)
        found = [(p, label) for phrase, label in self.phrases for p in places(numbers, phrase).tolist()]
        notices, score = [], 0.0
        for k, first, last in self.candidates(numbers):
            complete, covered, a, b = self.verify(numbers, k, first, last)
            score = max(score, covered)
            if complete and covered >= COVERAGE:
                notices.append({"label": self.templates[k][0], "first_word": a, "end_word": b, "score": covered})
        base = {label for _, label in found}
        spots = [p for p, _ in found]
        return (
            len(numbers),
            len(found),
            min(spots, default=None),
            max(spots, default=None),
            sorted(base),
            sorted(base | {n["label"] for n in notices}),
            score,
            notices,
        )


RESULT = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, labels array<string>, "
    "score double, notices array<struct<label:string,first_word:bigint,end_word:bigint,score:double>>"
)
_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"]


def file_counts(docs: DataFrame, text: str, terms: dict[bytes, int]) -> tuple[np.ndarray, float]:
    """In how many files each term occurs, and the number of files; one partial row per term and task is shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(len(terms) + 1, np.int64)
        for batch in batches:
            for value in batch["text"]:
                found = np.unique(numbered_text(terms, value))
                held[found[found > 0]] += 1
                held[0] += 1
        used = np.flatnonzero(held)
        yield pd.DataFrame({"term": used, "n": held[used]})

    counted = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(run, "term bigint, n bigint")
    rows = counted.groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    held = np.zeros(len(terms) + 1)
    held[rows["term"].to_numpy(np.int64)] = rows["n"]
    files, held[0] = float(held[0]), 0
    return held, files


def _scanner(index: Broadcast):
    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = pd.DataFrame([index.value.scan(t) for t in texts], columns=_NAMES, dtype=object)
            yield rows.astype({"n_words": "int64", "n_base": "int64", "first_word": "Int64", "last_word": "Int64", "score": "float64"})

    return run


def scan(docs: DataFrame, text: str = "text", name: str = "license") -> DataFrame:
    """Add a struct of word count, base phrases, labels, score and verified notices."""
    terms = vocabulary()
    index = docs.sparkSession.sparkContext.broadcast(Index(terms, *file_counts(docs, text, terms)))
    return docs.withColumn(name, _scanner(index)(F.coalesce(F.col(text), F.lit(""))))
