"""License scans: TF-IDF cosine to templates, then inheritance from directories.

Segments of a file (its lines, its paragraphs and, of a license file, the whole) are sparse
vectors of term counts times inverse document frequencies. Frequencies of the templates'
terms are counted over all files; a term of no template weighs like one that no file has. A
file's own license is that of the most similar template, if the cosine reaches a threshold.

Cosines alone take one license for its neighbour: sentences of two licenses may differ in one
word. So a template is allowed for a segment only if the segment holds the template's numbers
and key terms, and no key terms of other licenses; near sentences that allow no template, or
more than one license, give `unknown`. An SPDX tag is taken as it is written. A license file of
an unknown license passes `unknown` on, so that files under it do not take a further one's.

By Cauchy's inequality a segment reaches the threshold only if it holds one of a template's
heaviest terms, those without which the rest of the template is too light. Segments without
any such term are passed over; no others.

A file without a license of its own takes that of the nearest directory above it that has a
license file. Directories, not files, are expanded to their ancestors and joined by path.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import small
from rivulet.util import stage

THRESHOLD = 0.6
_TERM = re.compile(r"[^\W_]+")
_LICENSE_FILE = r"(?i)^(licen[cs]e|copying)([-._].*)?$"

# Opening or header sentences of public licenses, as their texts give them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used"
        " to endorse or promote products derived from this software without specific prior"
        " written permission.",
    ),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms"
     " of the Eclipse Public License 2.0"),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with"
        " or without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    ("ISC", "Released under the ISC License."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the Software), to deal in the Software"
        " without restriction",
    ),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
        " If a copy of the MPL was not distributed with this file, You can obtain one at"
        " https://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Released under the Unlicense."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related"
     " or neighboring rights to this work under CC0 1.0 Universal."),
]
# Licenses whose sentences differ in a name and a version only.
_GNU = [
    ("GPL-2.0", "GNU General Public License", "2"),
    ("GPL-3.0", "GNU General Public License", "3"),
    ("LGPL-2.0", "GNU Library General Public License", "2"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3"),
    ("AGPL-3.0", "GNU Affero General Public License", "3"),
]
_COMMONS = [
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
]
for _id, _name, _version in _GNU:
    TEMPLATES += [
        (_id, f"This work is licensed under the {_name}, version {_version}."),
        (
            _id,
            "This program is free software: you can redistribute it and/or modify it under the"
            f" terms of the {_name} as published by the Free Software"
            f" Foundation, either version {_version} of the License, or (at your option) any later version.",
        ),
    ]
for _short, _name in _COMMONS:
    TEMPLATES += [
        (f"CC-{_short}-4.0", f"Licensed under CC {_short} 4.0."),
        (
            f"CC-{_short}-4.0",
            f"This work is licensed under a Creative Commons {_name} 4.0 International License.",
        ),
    ]
# Terms that tell licenses apart; sentences that differ in them differ in law.
KEYS = frozenset(
    "apache bsd boost eclipse isc mit mozilla mpl unlicense unencumbered cc cc0 commons gnu affero"
    " lesser library lgpl agpl gpl nc nd sa noncommercial noderivatives sharealike".split()
)
# Licenses that are the other one and a clause more.
EXTENDS = {"BSD-3-Clause": "BSD-2-Clause"}
UNKNOWN = "unknown"
MARGIN = 0.02
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[A-Za-z0-9.+-]+)*)")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class Templates:
    """Template vectors under the document frequencies of a corpus."""

    def __init__(self, templates, frequencies: dict[str, int], n_files: int, threshold: float):
        self.threshold = threshold
        self.unseen = math.log(1 + n_files) + 1
        counts = [(name, Counter(terms(text))) for name, text in templates]
        vocabulary = {t for _, c in counts for t in c}
        self.idf = {
            t: math.log((1 + n_files) / (1 + frequencies.get(t, 0))) + 1 for t in vocabulary
        }
        self.vectors, needed = [], set()
        # By template: the terms a segment must hold; by license: the keys it may hold.
        self.must = [frozenset(t for t in c if t in KEYS or t.isdigit()) for _, c in counts]
        self.may: dict[str, set[str]] = {}
        for name, count in counts:
            self.may.setdefault(name, set()).update(KEYS.intersection(count), terms(name))
            vector = {t: n * self.idf[t] for t, n in count.items()}
            norm = math.sqrt(sum(x * x for x in vector.values()))
            self.vectors.append((name, {t: x / norm for t, x in vector.items()}))
            rest = 1.0
            for t, x in sorted(vector.items(), key=lambda p: (-p[1], p[0])):
                if rest < threshold * threshold - 1e-12:
                    break
                needed.add(t)
                rest -= (x / norm) ** 2
        self.vectors = [(n, v, must) for (n, v), must in zip(self.vectors, self.must, strict=True)]
        self.needed = frozenset(needed)

    def may_match(self, segment: str) -> bool:
        return not self.needed.isdisjoint(terms(segment))

    def best(self, segment: str) -> tuple[float, str]:
        """Greatest cosine and its license, of templates that the segment's keys allow;
        `unknown` where templates reach the threshold, but none that is allowed or not one
        license only within the margin. Of equal cosines the first by name."""
        count = Counter(terms(segment))
        vector = {t: n * self.idf.get(t, self.unseen) for t, n in count.items()}
        norm = math.sqrt(math.fsum(x * x for x in vector.values()))
        if not norm:
            return 0.0, ""
        keys = KEYS.intersection(count)
        held, near = [], []
        for name, template, must in self.vectors:
            score = math.fsum(x * vector[t] for t, x in template.items() if t in vector) / norm
            if score >= self.threshold:
                near.append(score)
                if must <= count.keys() and keys <= self.may[name]:
                    held.append((-score, name))
        if not held:
            return (max(near), UNKNOWN) if near else (0.0, "")
        score, name = min(held)
        rivals = [n for x, n in held if n != name and x <= score + MARGIN]
        return -score, UNKNOWN if rivals else name

    def scan(self, text: str, whole: bool) -> tuple[str | None, float | None]:
        """License and cosine of a file: its SPDX expression, as it is written first, else the
        best segment that reaches the threshold. A license counts before `unknown`, and one
        that extends another before that."""
        tag = _SPDX.search(text)
        if tag:
            return " ".join(tag.group(1).split()), 1.0
        if not self.may_match(text):
            return None, None
        segments = {x for x in text.split("\n") if self.may_match(x)}
        segments |= {x for x in re.split(r"\n\s*\n", text) if self.may_match(x)}
        if whole:
            segments.add(text)
        found = {(-s, n) for s, n in map(self.best, segments) if n}
        if not found:
            return None, None
        named = {n for _, n in found}
        extended = {EXTENDS[n] for n in named if n in EXTENDS}
        score, name = min(
            (n == UNKNOWN, s, n) for s, n in found if n not in extended
        )[1:]
        return name, -score


def frequencies(files: DataFrame, templates) -> dict[str, int]:
    """In how many files each term of the templates is; one number a term reaches the driver."""
    vocabulary = frozenset(t for _, text in templates for t in terms(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text in batch.column("text"):
                found.update(vocabulary.intersection(terms(text.as_py() or "")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["term", "n"],
            )

    counted = files.select("text").mapInArrow(count, "term string, n long")
    return {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def scan_files(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of (file_id, repo, path, text) with `own` (license or null) and `score`."""
    spark = files.sparkSession
    shared = spark.sparkContext.broadcast(
        (templates, frequencies(files, templates), files.count(), threshold)
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Templates(*shared.value)
        for batch in batches:
            whole = batch.column("whole").to_pylist()
            found = [
                model.scan(text.as_py() or "", bool(w))
                for text, w in zip(batch.column("text"), whole, strict=True)
            ]
            own = pa.array([f[0] for f in found], pa.string())
            score = pa.array([f[1] for f in found], pa.float64())
            columns = [batch.column(c) for c in ("file_id", "repo", "path", "whole")]
            yield pa.RecordBatch.from_arrays(
                [*columns, own, score],
                names=["file_id", "repo", "path", "whole", "own", "score"],
            )

    name = F.element_at(F.split("path", "/"), -1)
    rows = files.select(
        F.col("file_id").cast("long").alias("file_id"),
        F.col("repo").cast("string").alias("repo"),
        F.col("path").cast("string").alias("path"),
        F.coalesce(name.rlike(_LICENSE_FILE), F.lit(False)).alias("whole"),
        "text",
    )
    return rows.mapInArrow(
        scan,
        "file_id long, repo string, path string, whole boolean, own string, score double",
    )


def scan_licenses(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """License of every file: its own, or that of the nearest directory above it.

    `files` needs file_id, repo, path (parts between slashes, the last is the name) and
    text; other columns are not looked at. Returns a row per row: file_id, path, own,
    score, license and origin (`own`, the directory inherited from, or null).

    Directories get the license of the best license file right in them (LICENSE, LICENCE
    or COPYING, perhaps with a suffix), `unknown` after all others; of equal scores the first by name. Defined cases: a
    null text has no license of its own; a null repo or path inherits nothing and gives
    nothing; repeated rows get equal results; an empty table gives an empty result.
    """
    parts = F.split("path", "/")
    folder = F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
    scanned = stage(
        scan_files(files, templates, threshold).withColumn("dir", F.when(F.col("path").isNotNull(), folder)),
        "scanned",
    )
    rank = F.struct(F.col("own") == UNKNOWN, -F.col("score"), "own")
    given = (
        scanned.where("whole and own is not null and repo is not null and dir is not null")
        .groupBy("repo", F.col("dir").alias("above"))
        .agg(F.min(rank).alias("best"))
        .select("repo", "above", F.col("best.own").alias("given"))
    )
    steps = F.split("dir", "/")
    dirs = (
        scanned.where("own is null and repo is not null and dir is not null")
        .select("repo", "dir").distinct()
        .withColumn("depth", F.explode(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(steps)))))
        .withColumn("above", F.array_join(F.slice(steps, F.lit(1), F.col("depth")), "/"))
    )
    nearest = (
        dirs.join(small(stage(given, "given")), ["repo", "above"])
        .groupBy("repo", "dir")
        .agg(F.max(F.struct("depth", "above", "given")).alias("n"))
        .select("repo", "dir", F.col("n.above").alias("above"), F.col("n.given").alias("given"))
    )
    return scanned.join(small(stage(nearest, "nearest")), ["repo", "dir"], "left").select(
        "file_id", "path", "own", "score",
        F.coalesce("own", "given").alias("license"),
        F.when(F.col("own").isNotNull(), "own")
        .when(F.col("given").isNotNull(), F.concat(F.lit("/"), "above")).alias("origin"),
    )
