"""Licence scan: sparse TF-IDF cosine to templates, then inheritance along directories.

Every line of a text, and the whole text, is compared with short licence
templates. Terms are weighted by their document frequency over all lines of the
corpus, counted in ``BUCKETS`` hashed counters, so the table that tasks need has a
fixed size. A line can only reach the threshold if it holds one of a template's
heavier terms (by the Cauchy-Schwarz bound); texts without any are passed by, and
nothing is lost. ``licences`` also slides windows of each template's length over
the terms of the text, across line breaks, wherever a heavy term stands, so notices
that are wrapped or share a line with other words count as well.

A file without a licence of its own takes that of the nearest directory above it
that holds a licence file: its ancestors are joined to the directories' licences
by path, and the longest path wins.

Defined cases: null or empty text and null paths have no licence of their own; a
null path inherits none; ties go to the template's name, then the smallest id;
repeated rows each get their result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from casebook.llm.common import row_slices, small
from casebook.session import materialize

BUCKETS = 1 << 18
TERM = re.compile(r"[a-z0-9]+(?:[.'-][a-z0-9]+)*")

# Usual notices of common licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version",
    ],
    "LGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
        "Licensed under the GNU Lesser General Public License, version 3",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
        "Licensed under the GNU Affero General Public License, version 3",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, Version 2.0"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Licensed under the ISC License"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}
for _name, _texts in TEMPLATES.items():
    _texts.append(f"SPDX-License-Identifier: {_name}")


@dataclass(frozen=True)
class Rule:
    """Least cosine of a notice, and of a whole text that counts as a licence file."""

    notice: float = 0.75
    file: float = 0.4


def bucket(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term) % BUCKETS


def line_frequencies(documents: DataFrame) -> DataFrame:
    """bucket, n: the number of lines in which a term of the bucket occurs; lines in all under bucket -1."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, lines, places = np.zeros(BUCKETS, np.int64), 0, {}
        for batch in row_slices(batches):
            met: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                for line in (text or "").lower().split("\n"):
                    terms = set(TERM.findall(line))
                    if terms:
                        lines += 1
                        met.update(terms)
            for term, n in met.items():
                at = places.get(term)
                if at is None:
                    if len(places) > 500_000:
                        places.clear()
                    at = places[term] = bucket(term)
                counts[at] += n
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[used, -1].astype(np.int32)), pa.array(np.r_[counts[used], lines])], schema=schema
        )

    partial = documents.select(F.col("text").cast("string")).mapInArrow(count, "bucket int, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


class Weights:
    """Inverse line frequencies; at most one float for each bucket."""

    def __init__(self, frequencies: DataFrame) -> None:
        counts = np.zeros(BUCKETS + 1, np.int64)
        for row in frequencies.toLocalIterator():
            counts[row["bucket"]] = row["n"]
        lines = counts[BUCKETS]
        self.idf = np.log((1 + lines) / (1 + counts[:BUCKETS])).astype(np.float32) + np.float32(1)

    def vector(self, terms: list[str]) -> dict[str, float]:
        return {t: (1 + math.log(n)) * float(self.idf[bucket(t)]) for t, n in Counter(terms).items()}


def norm(vector: dict[str, float]) -> float:
    return math.sqrt(sum(w * w for w in vector.values()))


def heavy_terms(vector: dict[str, float], share: float) -> set[str]:
    """Terms of which one at least must occur for a cosine of ``share``: those behind the light ones that cannot reach it."""
    light, bound = 0.0, (share * norm(vector)) ** 2
    found = set()
    for term, w in sorted(vector.items(), key=lambda x: (x[1], x[0])):
        light += w * w
        if light >= bound:
            found.add(term)
    return found


class Windows:
    """The best cosine of a template to a stretch of as many terms as the template has."""

    def __init__(self, weights: Weights, texts: list[tuple[str, str]], least: float) -> None:
        self.weights, self.least, self.forms, self.heavy = weights, least, [], {}
        for name, text in texts:
            terms = TERM.findall(text.lower())
            form = weights.vector(terms)
            for term in heavy_terms(form, least):
                self.heavy.setdefault(term, []).append(len(self.forms))
            self.forms.append((name, len(terms), form, norm(form)))

    def best(self, terms: list[str]) -> tuple[float, str | None]:
        spots: dict[int, list[int]] = {}
        for i, term in enumerate(terms):
            for k in self.heavy.get(term, ()):
                spots.setdefault(k, []).append(i)
        found: tuple[float, str | None] = (0.0, None)
        for k in sorted(spots):
            name, length, form, size = self.forms[k]
            low = high = -1
            for spot in [*spots[k], None]:
                if spot is not None and low >= 0 and spot - length < high:
                    high = spot + length
                    continue
                if low >= 0:
                    score = self.slide(terms[low:high], length, form, size)
                    if score > found[0]:
                        found = (score, name)
                if spot is not None:
                    low, high = max(0, spot - length + 1), spot + length
        return found

    def slide(self, terms: list[str], length: int, form: dict[str, float], size: float) -> float:
        # No window can be closer than one that has all of the stretch's terms of the template.
        if math.sqrt(sum(form[t] ** 2 for t in set(terms) & form.keys())) < self.least * size:
            return 0.0
        idf = {t: float(self.weights.idf[bucket(t)]) for t in set(terms)}
        counts: Counter[str] = Counter()
        dot = square = most = 0.0
        weight = lambda t: (1 + math.log(counts[t])) * idf[t] if counts[t] else 0.0
        for i, term in enumerate(terms):
            for t, change in ((term, 1), *(((terms[i - length], -1),) if i >= length else ())):
                old = weight(t)
                counts[t] += change
                new = weight(t)
                square += new * new - old * old
                dot += (new - old) * form.get(t, 0.0)
            if i + 1 >= min(length, len(terms)) and square > 0:
                most = max(most, dot / (math.sqrt(square) * size))
        return most


def scan(
    documents: DataFrame, rule: Rule = Rule(), templates: dict[str, list[str]] = TEMPLATES, across_lines: bool = False
) -> DataFrame:
    """One stored row per document: doc_id, mark, path, licence and score of its best notice, whole_licence, whole_score.

    A notice is a line, or with ``across_lines`` also a window of terms.
    """
    weights = Weights(materialize(line_frequencies(documents), "frequencies"))
    forms = [(name, weights.vector(TERM.findall(text.lower()))) for name, texts in sorted(templates.items()) for text in texts]
    windows = Windows(weights, [(name, text) for name, texts in sorted(templates.items()) for text in texts], rule.notice)
    heavy = sorted(set().union(*[heavy_terms(v, min(rule.notice, rule.file)) for _, v in forms]))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("path", pa.string()), ("licence", pa.string()), ("score", pa.float64()),
        ("whole_licence", pa.string()), ("whole_score", pa.float64()),
    ])

    def best(terms: list[str]) -> tuple[float, str | None]:
        vector = weights.vector(terms)
        size, found = norm(vector), (0.0, None)
        for name, form in forms:
            dot = sum(w * vector[t] for t, w in form.items() if t in vector)
            score = dot / (size * norm(form)) if dot else 0.0
            if score > found[0]:
                found = (score, name)
        return found

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            rows = []
            for text in batch.column(2).to_pylist():
                low = (text or "").lower()
                line, whole = (0.0, None), (0.0, None)
                if any(t in low for t in heavy):
                    for part in low.split("\n"):
                        if any(t in part for t in heavy):
                            got = best(TERM.findall(part))
                            if got[0] > line[0]:
                                line = got
                    terms = TERM.findall(low)
                    whole = best(terms)
                    if across_lines:
                        got = windows.best(terms)
                        # Sums that slide end a little off; an equal line keeps its template.
                        if got[0] > line[0] + 1e-9:
                            line = got
                rows.append((*(line[::-1] if line[0] >= rule.notice else (None, None)),
                             *(whole[::-1] if whole[0] >= rule.file else (None, None))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)] + [pa.array(x, f.type) for x, f in zip(zip(*rows), list(schema)[2:], strict=True)],
                schema=schema,
            ) if rows else pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)

    rows = documents.select(F.col("doc_id").cast("long"), F.col("path").cast("string"), F.col("text").cast("string"))
    kind = "doc_id long, path string, licence string, score double, whole_licence string, whole_score double"
    return materialize(rows.mapInArrow(judge, kind), "notices")


def directories(path: Column) -> Column:
    """All directories above a path, the root as empty text."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def licences(documents: DataFrame, rule: Rule = Rule(), templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """doc_id, path, licence, score, origin (own, inherited or none) and directory it is inherited from.

    ``documents`` has doc_id, path and text.
    """
    found = scan(documents, rule, templates, across_lines=True)
    files = found.where(F.col("whole_licence").isNotNull() & F.col("path").isNotNull()).select(
        F.array_join(F.slice(F.split("path", "/"), F.lit(1), F.size(F.split("path", "/")) - 1), "/").alias("directory"),
        "whole_licence", "whole_score", "doc_id",
    )
    rank = F.struct(-F.col("whole_score"), F.col("whole_licence").alias("name"), F.col("doc_id"))
    held = small(materialize(files.groupBy("directory").agg(F.min(rank)["name"].alias("taken")), "directories"))
    needing = found.where(F.col("licence").isNull() & F.col("path").isNotNull())
    above = needing.select("path", F.explode(directories(F.col("path"))).alias("directory")).distinct().join(held, "directory")
    nearest = above.groupBy("path").agg(F.max(F.struct(F.length("directory").alias("n"), "directory", "taken")).alias("near"))
    nearest = nearest.select(F.col("path").alias("_path"), "near")
    return found.join(nearest, F.col("path") == F.col("_path"), "left").select(
        "doc_id", "path",
        F.coalesce("licence", F.when(F.col("licence").isNull(), F.col("near.taken"))).alias("licence"),
        "score",
        F.when(F.col("licence").isNotNull(), "own").when(F.col("near.taken").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("licence").isNull(), F.col("near.directory")).alias("directory"),
    )


def with_paths(documents: DataFrame) -> DataFrame:
    """Paths for a table that has none: source, language, hundreds of ids, id."""
    part = lambda c: F.coalesce(F.col(c), F.lit("none"))
    hundreds = F.floor(F.col("doc_id") / 100).cast("string")
    return documents.select("doc_id", "text", F.concat_ws("/", part("source"), part("lang"), hundreds, F.col("doc_id").cast("string")).alias("path"))
