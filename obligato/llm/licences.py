"""Licence scan: sparse TF-IDF cosine to notice templates, then inheritance from the nearest directory above.

A file's own licence is the template nearest to any of its runs of as many words as the template has (a notice may
stand anywhere in it, also within a line), to any run of up to LINES of its lines, or to its whole text. Files
without one take that of the licence file in the nearest directory on the way up, found by joining directories' paths. A match counts only if the words that tell the
licence from its relatives (version, variant) agree.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, words_of, written

# Usual notices of well-known licences, by SPDX name.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0 1.0)."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
                 "License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation; either version 2 of the License, or any later version."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation; either version 2.1 of the License, or any later version."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation; either version 3 of the License, or any later version."),
]


def _gnu(kind: str, version: str) -> str:
    """The name, and the version that stands first after it or directly before it."""
    name, number = rf"(?<!affero )(?<!lesser )(?<!library ){kind}general public licen[cs]e\b", rf"{version}\b(?! [1-9]\b)"
    return rf"\b{name}(?:(?: (?!v(?:ersion)? ?\d)\S+){{0,12}}? v(?:ersion)?)? ?{number}|\bv(?:ersion)? ?{version}(?: 0)? of the (?:gnu )?{name}"


def _cc(short: str, long: str) -> str:
    return rf"\b(?:cc by{short}|attribution{long})(?: (?:international|public|licen[cs]e|version|v))* v?4\b"


_NC, _ND, _SA = " non ?commercial", r" no ?deriv(?:ative)?s?(?: works)?", " share ?alike"
_CONDITIONS = r"\bredistribution and use in source and binary forms\b(?=.* redistributions in binary form must\b)(?!.* all advertising materials\b)"
# What tells a licence from its relatives, as patterns over the words of a run, NEAR words around it, and, for conditions that
# follow a notice, AFTER words up to the disclaimer. A run without it is no match.
TELLING = {
    "AGPL-3.0": _gnu("affero ", "3"),
    "Apache-2.0": r"\bapache (?:software )?(?:licen[cs]e)?(?: ?v(?:ersion)?)? ?2\b(?! [1-9]\b)|\blicenses license 2 0\b",
    "BSD-2-Clause": rf"\b(?:bsd 2 clause|2 clause bsd|simplified bsd)\b|{_CONDITIONS}(?!.* endorse or promote\b)",
    "BSD-3-Clause": rf"\b(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)\b|{_CONDITIONS}(?=.* endorse or promote\b)",
    "CC-BY-4.0": _cc("", ""), "CC-BY-NC-4.0": _cc(" nc", _NC), "CC-BY-ND-4.0": _cc(" nd", _ND), "CC-BY-SA-4.0": _cc(" sa", _SA),
    "CC-BY-NC-ND-4.0": _cc(" nc nd", _NC + _ND), "CC-BY-NC-SA-4.0": _cc(" nc sa", _NC + _SA),
    "CC0-1.0": r"\bcc0\b|\bwaived all copyright\b",
    "GPL-2.0": _gnu("", "2"), "GPL-3.0": _gnu("", "3"), "LGPL-2.1": _gnu("lesser ", "2 1"), "LGPL-3.0": _gnu("lesser ", "3"),
    "MIT": r"\bmit\b(?! no attribution\b| 0\b)|\bassociated documentation files\b",
    "MPL-2.0": r"\bmozilla public licen[cs]e(?: v(?:ersion)?)? ?2\b(?! [1-9]\b)",
}
NEAR, AFTER, DISCLAIMER = 2, 150, " this software is provided "
#: Least cosine of a match, and lines that a notice may run over.
THRESHOLD, LINES = 0.7, 6
#: Names of licence files.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense)"


class Candidate(NamedTuple):
    """A run of words: a bound on its cosine, the template's name, the dot product with it, the squared norm of the words
    that templates have, and the other words with their counts."""

    bound: float
    name: str
    dot: float
    square: float
    others: tuple[tuple[str, int], ...]


class Matcher:
    """Scores texts against templates; ``documents`` and ``frequency`` are the corpus counts that the weights come from.

    ``counted`` is a table (word, n) of all words' document frequencies, if there are more than ``frequency`` has.
    """

    def __init__(self, templates: list[tuple[str, str]], threshold: float, documents: int, frequency: dict[str, int],
                 counted: DataFrame | None = None):
        self.threshold, self.documents, self.frequency, self.counted = threshold, documents, frequency, counted
        self.vocabulary = {w for _, t in templates for w in words_of(t.encode())}
        self.idf = {w: self.weight(w) for w in self.vocabulary}
        split = [(name, words_of(t.encode())) for name, t in sorted(templates)]
        self.templates = [(name, self.vector(words)) for name, words in split]
        self.lengths = [len(words) for _, words in split]
        self.own_signs = [self._signs(v) for _, v in self.templates]
        self.telling = [re.compile(TELLING.get(name, "")) for name, _ in self.templates]
        self.signs = set().union(*self.own_signs)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"counted": None}  # a table stays with the driver

    def weight(self, word: bytes) -> float:
        return math.log((1 + self.documents) / (1 + self.frequency.get(word.decode("utf-8", "replace"), 0))) + 1

    def vector(self, words: list[bytes]) -> dict[bytes, float]:
        """Unit TF-IDF vector."""
        counts = {w: n * (self.idf.get(w) or self.weight(w)) for w, n in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in counts.values()))
        return {w: x / norm for w, x in counts.items()} if norm else {}

    def _signs(self, vector: dict[bytes, float]) -> set[bytes]:
        """The heaviest words, so many that a text with none of them cannot reach the threshold."""
        rest, out = 1.0, set()
        for w, x in sorted(vector.items(), key=lambda i: (-i[1], i[0])):
            if math.sqrt(max(0.0, rest)) < self.threshold - 1e-9:
                break
            out.add(w)
            rest -= x * x
        return out

    def cosine(self, words: list[bytes]) -> tuple[float, str] | None:
        """Best (cosine, name) from the threshold on; ties go to the first name."""
        v = self.vector(words)
        best = None
        for k, (name, t) in enumerate(self.templates):
            c = sum(x * v[w] for w, x in t.items() if w in v)
            if c >= self.threshold - 1e-9 and (best is None or c > best[0] + 1e-12) and self._told(words, 0, len(words), k):
                best = (c, name)
        return best

    def _told(self, words: list[bytes], a: int, b: int, k: int) -> bool:
        """Whether the words of the run or around it tell template ``k``'s licence from its relatives."""
        after = AFTER if self.templates[k][0].startswith("BSD-") else NEAR
        around = b" ".join(words[max(0, a - NEAR):b + after]).decode("utf-8", "replace")
        return self.telling[k].search(around.split(DISCLAIMER)[0] if after == AFTER else around) is not None

    def candidates(self, text: bytes | None) -> list[Candidate]:
        """The runs of words that can be the best match. Words that no template has weigh at least 1, so that a bound
        on each cosine is known before they are looked up; runs that it rules out are left out."""
        lines = [words_of(line) for line in (text or b"").split(b"\n")]
        words = [w for line in lines for w in line]
        if not self.signs.intersection(words):
            return []
        at = [0, *accumulate(map(len, lines))]
        runs = {(at[max(0, i - a)], at[min(len(lines), i - a + n)]) for i, line in enumerate(lines) if self.signs.intersection(line)
                for n in range(1, LINES + 1) for a in range(n)} | {(0, len(words))}
        every = range(len(self.templates))
        found = {x for a, b in runs for x in self._scored(words, a, b, every)}
        for k in every:
            found.update(x for a, b in self._windows(words, k) for x in self._scored(words, a, b, [k]))
        sure = max((x.bound for x in found if not x.others), default=0.0)
        return sorted(x for x in found if x.bound >= sure - 1e-12)

    def _scored(self, words: list[bytes], a: int, b: int, templates: Iterable[int]) -> Iterator[Candidate]:
        counts = Counter(words[a:b])
        known = {w: n * self.idf[w] for w, n in counts.items() if w in self.idf}
        others = tuple(sorted((w.decode("utf-8", "replace"), n) for w, n in counts.items() if w not in self.idf))
        square = math.fsum(x * x for x in known.values())
        least = math.sqrt(square + sum(n * n for _, n in others))
        for k in templates:
            name, t = self.templates[k]
            dot = math.fsum(x * known[w] for w, x in t.items() if w in known)
            if least and dot / least >= self.threshold - 1e-9 and self._told(words, a, b, k):
                yield Candidate(dot / least, name, dot, square, others)

    def _windows(self, words: list[bytes], k: int) -> Iterator[tuple[int, int]]:
        """Runs of as many words as template ``k`` has whose cosine to it may reach the threshold."""
        n, t, signs = self.lengths[k], self.templates[k][1], self.own_signs[k]
        spans: list[list[int]] = []
        for i, w in enumerate(words):
            if w in signs:
                low, high = max(0, i - n + 1), min(len(words), i + n)
                if spans and low <= spans[-1][1]:
                    spans[-1][1] = high
                else:
                    spans.append([low, high])
        for low, high in spans:
            counts: Counter = Counter()
            dot = square = 0.0
            for i in range(low, high):
                w = words[i]
                x = self.idf.get(w, 1.0)
                square += x * x * (2 * counts[w] + 1)
                counts[w] += 1
                dot += x * t.get(w, 0.0)
                if i >= low + n:
                    w = words[i - n]
                    x = self.idf.get(w, 1.0)
                    counts[w] -= 1
                    square -= x * x * (2 * counts[w] + 1)
                    dot -= x * t.get(w, 0.0)
                if i >= low + n - 1 and dot > 0 and dot * dot >= self.threshold ** 2 * square - 1e-6:
                    yield i - n + 1, i + 1

    def best(self, text: bytes | None) -> tuple[float, str] | None:
        """Best match of any run, with the weights that ``frequency`` gives."""
        scored = [(x.dot / math.sqrt(x.square + sum((n * self.weight(w.encode())) ** 2 for w, n in x.others)), x.name) for x in self.candidates(text)]
        return min((m for m in scored if m[0] >= self.threshold - 1e-9), key=lambda m: (-round(m[0], 12), m[1]), default=None)


def fit(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, text_col: str = "text") -> Matcher:
    """A matcher with the document frequencies of all words of ``files``; the driver holds those of the templates' words."""
    bound_batches(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter({b"": batch.num_rows})
            for text in batch.column(0).to_pylist():
                counts.update(set(words_of(text)))
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in counts], pa.string()),
                                              pa.array(counts.values(), pa.int64())], ["word", "n"])

    counted = written(files.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "word string, n long")
                      .groupBy("word").agg(F.sum("n").alias("n")), "licence-words")
    vocabulary = sorted({w.decode() for _, t in templates for w in words_of(t.encode())})
    counts = {r.word: r.n for r in counted.where(F.col("word").isin(["", *vocabulary])).collect()}
    return Matcher(templates, threshold, counts.pop("", 0), counts, counted)


def found_runs(matcher: Matcher, text: Column) -> Column:
    """The matcher's candidates of a text."""
    word = pa.struct([("word", pa.string()), ("n", pa.int64())])
    kind = pa.list_(pa.struct([("licence", pa.string()), ("dot", pa.float64()), ("square", pa.float64()), ("others", pa.list_(word))]))

    @F.arrow_udf("array<struct<licence string, dot double, square double, others array<struct<word string, n bigint>>>>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([[{"licence": x.name, "dot": x.dot, "square": x.square, "others": [{"word": w, "n": n} for w, n in x.others]}
                          for x in matcher.candidates(t)] for t in texts.to_pylist()], kind)

    return run(text.cast("binary"))


def own_licences(rows: DataFrame, matcher: Matcher) -> DataFrame:
    """(at, own): struct(score, licence) of the best of each row's ``runs`` that reaches the threshold, the words
    that no template has weighed by their document frequencies."""
    counted = matcher.counted
    if counted is None:
        counted = rows.sparkSession.createDataFrame([*matcher.frequency.items()], "word string, n long")
    runs = (rows.where(F.size("runs") > 0).select("at", F.posexplode("runs").alias("nth", "run"))
            .select("at", "nth", "run.licence", "run.dot", "run.square", F.explode_outer("run.others").alias("other")))
    weight = F.log((1 + F.lit(float(matcher.documents))) / (1 + F.coalesce("n", F.lit(0)))) + 1
    weighed = (runs.select("at", "nth", "licence", "dot", "square", F.col("other.word").alias("word"), F.col("other.n").alias("times"))
               .join(counted, "word", "left").groupBy("at", "nth", "licence", "dot", "square")
               .agg(F.sum(F.coalesce(F.pow(F.col("times") * weight, F.lit(2)), F.lit(0.0))).alias("more")))
    score = F.col("dot") / F.sqrt(F.col("square") + F.col("more"))
    return (weighed.select("at", "licence", score.alias("score")).where(F.col("score") >= matcher.threshold - 1e-9)
            .groupBy("at").agg(F.min(F.struct(-F.round("score", 12), "licence", F.round("score", 9).alias("score"))).alias("best"))
            .select("at", F.struct("best.score", "best.licence").alias("own")))


def scan(files: DataFrame, matcher: Matcher, path_col: str = "path", text_col: str = "text", id_cols: tuple[str, ...] = ()) -> DataFrame:
    """(*id_cols, path, licence, score, how, source), one row per row of ``files``.

    ``how`` is ``file`` for a licence file with its own match, ``header`` for another file with one, ``inherited`` with
    the licence file's path in ``source``, or ``none``. Of several licence files in a directory the best match counts, of
    equal ones the first path. Null and empty texts have no licence of their own; a file without a path inherits
    nothing; rows that repeat a path each get their row. An empty table gives an empty result.
    """
    path = F.col(path_col)
    bound_batches(files.sparkSession)
    rows = written(files.select(*id_cols, path.alias("path"), found_runs(matcher, F.col(text_col)).alias("runs"),
                                F.monotonically_increasing_id().alias("at")), "licence-runs")
    rows = written(rows.drop("runs").join(own_licences(rows, matcher), "at", "left").drop("at"), "licences")
    name = F.element_at(F.split("path", "/"), -1)
    rows = rows.withColumns({"dir": F.regexp_extract("path", r"^(.*)/[^/]*$", 1), "is_file": name.rlike(LICENCE_FILE)})
    granted = (rows.where("is_file AND own IS NOT NULL").groupBy(F.col("dir").alias("at"))
               .agg(F.min(F.struct(-F.col("own.score"), "path", "own.licence")).alias("best"))
               .select("at", F.col("best.path").alias("source"), F.col("best.licence").alias("inherited")))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    nearest = (rows.where("own IS NULL AND dir IS NOT NULL").select("dir").distinct().select("dir", F.explode(above).alias("at"))
               .join(granted, "at").groupBy(F.col("dir").alias("below"))
               .agg(F.max_by(F.struct("source", "inherited"), F.length("at")).alias("from")))
    how = (F.when(F.col("own").isNotNull(), F.when(F.col("is_file"), "file").otherwise("header"))
           .when(F.col("from").isNotNull(), "inherited").otherwise("none"))
    given = F.when(F.col("own").isNull(), F.col("from"))
    return (rows.join(nearest, F.col("dir") == F.col("below"), "left")
            .select(*id_cols, "path", F.coalesce("own.licence", given["inherited"]).alias("licence"), "own.score", how.alias("how"),
                    given["source"].alias("source")))
