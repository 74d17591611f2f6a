"""Operator 10: license scans by sparse TF-IDF cosine and path inheritance.

Header candidates of a file are its lines, its paragraphs and, for each
template, every window of the template's number of words, wherever it begins;
the whole text of a licence file (by its name) is one more. A candidate's words
weigh (count) x (inverse document frequency), where the frequencies of the
template words are counted over all documents and all other words weigh as never
seen; its cosine to each template decides. A template also demands agreement:
words it needs (a version, a variant) must be in the candidate, words that name
another licence must not be (for a window, nor names in ``GUARD`` words around
it). The best template at or above the threshold that agrees is the file's own license
(ties: the higher cosine, then more words needed, then the template name, then
the first candidate).

Candidates are met through the templates' words only: a candidate that shares
none but common words cannot reach the threshold. Common words are chosen so
that, for each template, their part of the template's length is below the
threshold, which bounds the cosine by Cauchy-Schwarz; so nothing is lost.
Windows slide over the neighbourhood of a template's telling words, a word in, a
word out, so their cost does not grow with the template.

A file without a license of its own takes that of the nearest ancestor
directory that holds a licence file with one (its own directory counts as the
nearest). Directories are made distinct before their ancestors are joined, so
many files in one directory ask once.

Cases: a null text is the empty text, a null path has no directory and inherits
nothing; texts are read whole; ties as above, and several licence files of a
directory give the one with the highest cosine, then the smallest path;
repeated rows give equal results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, text_of, written

THRESHOLD = 0.75
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([.\-_].*)?$"
TOKEN = re.compile(rb"[a-z0-9]+")

GUARD = 4            # words on either side of a window that must not name another licence

#: Usual short notices of public licenses.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or any later version."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1.",
                 "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                 "Public License as published by the Free Software Foundation; either version 2.1 of the License, or any later version."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.",
                 "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.",
                 "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "BSD-2-Clause": ["Distributed under the BSD 2-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"],
    "BSD-3-Clause": ["Distributed under the BSD 3-Clause License.",
                     "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}
#: The same with the machine-readable tag of each license.
TEMPLATES = {name: [*texts, f"SPDX-License-Identifier: {name}"] for name, texts in NOTICES.items()}

#: Words that tell versions and variants apart. Of each group a
#: notice must have the words that its template has, and none of the others.
VARIANTS = [{"lesser", "affero", "library"}, {"lgpl", "agpl", "gpl", "mit", "apache", "mpl", "bsd", "cc"}, {"2", "3"},
            {"noncommercial", "sharealike", "noderivatives"}, {"nc", "sa", "nd"}, {"neither"}]
#: Fixed value: a template whose words come as their variants' own does not need them (a library's notice says so itself).
OPTIONAL = {"library"}


def tokens(text: str) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits."""
    return TOKEN.findall(text.encode("utf-8").lower())


VERSIONS = {b"2", b"3"}  # numbers around a window are not its version


def agreement(words: list[bytes]) -> tuple[frozenset[bytes], frozenset[bytes]]:
    """(words that a candidate of this template needs, words it must not have)."""
    own = set(words)
    variants = [{w.encode() for w in group} for group in VARIANTS]
    needs = {w for group in variants for w in group & own} - {w.encode() for w in OPTIONAL}
    # A notice without a word of a group is not told by that group's versions; names of variants it lacks speak against it.
    bans = {w for k, group in enumerate(variants) for w in group - own if k != 2 or group & own} - {w.encode() for w in OPTIONAL}
    return frozenset(needs), frozenset(bans)


class Scanner:
    """Cosines of candidates to the templates under given document frequencies."""

    def __init__(self, frequencies: dict[bytes, int], documents: int, templates: dict[str, list[str]], threshold: float):
        self.threshold = threshold
        self.names = [(name, tokens(t)) for name, texts in sorted(templates.items()) for t in texts]
        self.agrees = [agreement(ws) for _, ws in self.names]
        vocabulary = {w for _, ws in self.names for w in ws}
        idf = lambda n: math.log((1 + documents) / (1 + n)) + 1
        self.idf = {w: idf(frequencies.get(w, 0)) for w in vocabulary}
        self.unseen = idf(0)
        self.postings: dict[bytes, list[tuple[int, float]]] = {w: [] for w in vocabulary}
        self.shares: list[dict[bytes, float]] = []
        squares = [{w: (n * self.idf[w]) ** 2 for w, n in Counter(ws).items()} for _, ws in self.names]
        for k, sq in enumerate(squares):
            norm = math.sqrt(sum(sq.values()))
            self.shares.append({w: math.sqrt(v) / norm for w, v in sq.items()})
            for w, v in self.shares[-1].items():
                self.postings[w].append((k, v))
        # Common words: as many of the lowest idf as no template needs to stay below the threshold.
        self.telling = set(vocabulary)
        common: set[bytes] = set()
        for w in sorted(vocabulary, key=lambda w: (self.idf[w], w)):
            trial = common | {w}
            if all(sum(v for x, v in sq.items() if x in trial) < 0.999 * threshold ** 2 * sum(sq.values()) for sq in squares):
                common = trial
        self.telling -= common
        self.telling_of = [self.telling & set(ws) for _, ws in self.names]

    def cosines(self, words: list[bytes]) -> list[tuple[float, int]]:
        """(cosine, template) of a candidate and the templates that agree with it."""
        if self.telling.isdisjoint(words):
            return []
        norm, dots = 0.0, {}
        counts = Counter(words)
        for w, n in counts.items():
            weight = n * self.idf.get(w, self.unseen)
            norm += weight * weight
            for k, v in self.postings.get(w, ()):
                dots[k] = dots.get(k, 0.0) + weight * v
        norm = math.sqrt(norm)
        return [(round(d / norm, 9), k) for k, d in dots.items()
                if d >= 0.999 * self.threshold * norm and self.agrees[k][0] <= counts.keys() and self.agrees[k][1].isdisjoint(counts)]

    def windows(self, words: list[bytes]) -> Iterator[tuple[float, int, int]]:
        """(cosine, template, first word) of every window at the threshold that agrees with the template of its length."""
        for k, telling in enumerate(self.telling_of):
            size = len(self.names[k][1])
            at = [i for i, w in enumerate(words) if w in telling]
            needs, bans = self.agrees[k]
            if not at or len(words) < size or not needs.issubset(words):
                continue
            ranges: list[list[int]] = []  # of window starts
            for i in at:
                low, high = max(0, i - size + 1), min(i, len(words) - size)
                if ranges and low <= ranges[-1][1] + 1:
                    ranges[-1][1] = max(ranges[-1][1], high)
                elif low <= high:
                    ranges.append([low, high])
            share, idf, unseen = self.shares[k], self.idf, self.unseen
            for low, high in ranges:
                counts: Counter = Counter()
                norm = dot = 0.0
                for end in range(low, high + size):
                    w = words[end]
                    weight, n = idf.get(w, unseen), counts[w]
                    norm += (2 * n + 1) * weight * weight
                    dot += weight * share.get(w, 0.0)
                    counts[w] = n + 1
                    start = end - size + 1
                    if start < low:
                        continue
                    if dot > 0 and dot >= 0.999 * self.threshold * math.sqrt(norm):
                        near = words[max(0, start - GUARD):start + size + GUARD]
                        if all(counts[x] for x in needs) and (bans - VERSIONS).isdisjoint(near):
                            # Reckoned anew, as the running sums carry rounding, and with the window's own agreement.
                            exact = next((c for c, t in self.cosines(words[start:start + size]) if t == k), 0.0)
                            if exact >= self.threshold:
                                yield exact, k, start
                    w = words[start]
                    weight, n = idf.get(w, unseen), counts[w]
                    norm -= (2 * n - 1) * weight * weight
                    dot -= weight * share.get(w, 0.0)
                    counts[w] = n - 1

    def scan(self, text: str, whole: bool) -> tuple[str | None, float | None, int | None]:
        """(template, cosine, first line) of the best candidate at or above the threshold."""
        words = tokens(text)
        if self.telling.isdisjoint(words):
            return None, None, None
        lines, of_word = [], []
        for at, line in enumerate(text.split("\n")):
            lines.append(tokens(line))
            of_word += [at] * len(lines[-1])
        found = [(c, k, at) for at, ws in enumerate(lines) if ws for c, k in self.cosines(ws)]
        start = 0
        for at, ws in enumerate([*lines, []]):
            if not ws:
                if at - start > 1:
                    found += [(c, k, start) for c, k in self.cosines([w for x in lines[start:at] for w in x])]
                start = at + 1
        found += [(c, k, of_word[first]) for c, k, first in self.windows(words)]
        if whole:
            found += [(c, k, 0) for c, k in self.cosines(words)]
        found = [x for x in found if x[0] >= self.threshold]
        if not found:
            return None, None, None
        cosine, k, at = min(found, key=lambda x: (-x[0], -len(self.agrees[x[1]][0]), self.names[x[1]][0], x[2]))
        return self.names[k][0], cosine, at


def document_frequencies(df: DataFrame, text_col: str, templates: dict[str, list[str]]) -> tuple[dict[bytes, int], int]:
    """In how many texts each template word occurs, and the number of texts. As
    many rows come to the driver as the templates have words."""
    vocabulary = sorted({w.decode() for texts in templates.values() for t in texts for w in tokens(t)})
    lowered = F.translate(text_of(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = df.select(F.array_intersect(F.split(lowered, "[^a-z0-9]+"), F.lit(vocabulary)).alias("words"))
    rows = words.select(F.explode_outer(F.array_append("words", F.lit(""))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {r.word.encode(): r.n for r in rows}
    return found, found.pop(b"", 0)


def file_licenses(df: DataFrame, id_col: str, path: Column, text_col: str, templates: dict[str, list[str]],
                  threshold: float) -> DataFrame:
    """``id``, ``path``, ``license``, ``score`` and ``line`` of every file's own license."""
    ship(df.sparkSession)
    frequencies, documents = document_frequencies(df, text_col, templates)
    rows = df.select(F.col(id_col).alias("id"), path.alias("path"),
                     F.coalesce(F.element_at(F.split(path, "/"), -1).rlike(LICENCE_FILE), F.lit(False)).alias("whole"),
                     text_of(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("path", T.StringType()), T.StructField("whole", T.BooleanType()),
                           T.StructField("license", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("line", T.LongType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(frequencies, documents, templates, threshold)
        for batch in batches:
            found = [scanner.scan(t, w) for t, w in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.int64())], names=schema.names)

    return rows.mapInArrow(task, schema)


def directory(path: Column) -> Column:
    """The path without its last component; "" for a file at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scanned(df: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text",
            templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per file: id, path, license, score, first line of the header, ``origin``
    ("own", "inherited" or null) and the path of the licence file inherited from."""
    files = written(file_licenses(df, id_col, path, text_col, templates, threshold).withColumn("dir", directory(F.col("path"))), "files")
    holders = (files.filter("whole and license is not null").groupBy(F.col("dir").alias("ancestor"))
               .agg(F.min_by(F.struct("license", F.col("path").alias("license_path")), F.struct(-F.col("score"), F.col("path"))).alias("from_file")))
    dirs = files.filter("license is null and dir is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        F.array_join(F.slice(parts, 1, n), "/").alias("ancestor"), n.alias("depth")))
    near = (dirs.select("dir", F.explode(F.when(F.col("dir") == "", F.array(F.struct(F.lit("").alias("ancestor"), F.lit(0).alias("depth"))))
                                          .otherwise(ancestors)).alias("a")).select("dir", "a.*")
                .join(holders, "ancestor").groupBy("dir").agg(F.max_by("from_file", "depth").alias("inherited")))
    out = files.join(near, "dir", "left")
    own = F.col("license").isNotNull()
    return out.select(
        F.col("id").alias(id_col), "path", F.coalesce("license", "inherited.license").alias("license"), "score", "line",
        F.when(own, "own").when(F.col("inherited").isNotNull(), "inherited").alias("origin"),
        F.when(~own, F.col("inherited.license_path")).alias("license_path"))


def room_path(id_col: str = "doc_id", source_col: str = "source") -> Column:
    """A place in a file tree for a row of ``documents``: source, then thousands
    and hundreds of the id. Every 50th document is a licence file, every 1000th
    one at the top of its source."""
    i = F.col(id_col)
    top = F.concat_ws("/", F.coalesce(F.col(source_col), F.lit("none")))
    deep = F.concat_ws("/", top, F.concat(F.lit("d"), F.floor(i / 1000)), F.concat(F.lit("p"), F.floor(i / 100) % 10))
    return (F.when(i % 1000 == 0, F.concat(top, F.lit("/LICENSE."), i))
             .when(i % 50 == 0, F.concat(deep, F.lit("/LICENSE."), i))
             .otherwise(F.concat(deep, F.lit("/doc_"), i, F.lit(".txt"))))
