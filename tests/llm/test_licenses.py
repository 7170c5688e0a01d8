import math
import re
from collections import Counter

import pytest

from rivulet.llm import licenses as L
from tests.llm.cases import prose

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."

BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
CLAUSE = next(x for _, x in L.TEMPLATES if x.startswith("Neither the name"))


def rows():
    apache = L.TEMPLATES[1][1]
    texts = [
        ("r", "LICENSE", MIT), ("r", "a/LICENSE.txt", f"{prose(1, 5)}\n{GPL}\n"), ("r", "a/b/x.py", prose(2, 40)), ("r", "a/b/y.py", f"# {MIT}\n{prose(3, 30)}"),
        ("r", "c/d/e/z.py", prose(4, 9)), ("r", "top.py", "the license of the work"), ("q", "a/z.py", prose(5, 9)), ("q", "LICENSED.txt", MIT),
        ("r", "w.py", "\n".join([prose(6, 8), "", *re.findall(".{1,60}(?: |$)", apache), "", prose(7, 9)])), (None, "a/x.py", prose(1, 3)), ("r", None, prose(1, 3)),
        ("r", "n.py", None), ("r", "e.py", ""), ("r", "a/COPYING", f"{GPL} {MIT}"), ("r", "a/LICENCE-2", GPL), ("r", "/a//s.py", "x"),
        ("r", "u/LICENSE", "This work is licensed under the GNU General Public License."), ("r", "u/v/x.py", prose(3, 9)),
        ("r", "bsd.c", f"{BSD}:\n\n1. One.\n\n3. {CLAUSE}\n"), ("r", "bsd2.c", f"{BSD}:\n\n1. One."),
        ("r", "long.py", prose(8, 6000) + "\nSPDX-License-Identifier: Apache-2.0\n" + prose(9, 6000)),
    ]
    return [(k, *t) for k, t in enumerate(texts)] + [(2, *texts[2])]


def brute(table):
    n, df = len(table), Counter()
    for *_, text in table:
        df.update(set(L.terms(text or "")))
    known = {t for _, x in L.TEMPLATES for t in L.terms(x)}

    def vector(text):
        v = {t: c * (math.log((1 + n) / (1 + (df[t] if t in known else 0))) + 1) for t, c in Counter(L.terms(text)).items()}
        return v, math.sqrt(sum(x * x for x in v.values()))

    names = {}
    for name, x in L.TEMPLATES:
        names.setdefault(name, set(L.terms(name))).update(L.terms(x))

    def one(segment):
        v, a = vector(segment)
        scores = []
        for name, x in L.TEMPLATES:
            w, b = vector(x)
            score = sum(y * v.get(t, 0) for t, y in w.items()) / (a * b) if a else 0
            wanted = {t for t in w if t in L.KEYS or t.isdigit()}
            allowed = wanted <= set(v) and all(t in names[name] for t in v if t in L.KEYS)
            if score >= L.THRESHOLD:
                scores.append((score, name, allowed))
        fit = sorted((-s, n) for s, n, ok in scores if ok)
        if not fit:
            return (L.UNKNOWN, max(scores)[0]) if scores else None
        close = {n for s, n in fit if s <= fit[0][0] + L.MARGIN}
        return (fit[0][1] if len(close) == 1 else L.UNKNOWN), -fit[0][0]

    def best(text, whole):
        if "SPDX-License-Identifier: " in text:
            return text.split("SPDX-License-Identifier: ")[1].split()[0], 1.0
        segments = [*text.split("\n"), *re.split(r"\n\s*\n", text), *([text] if whole else [])]
        found = [f for f in map(one, segments) if f]
        if any(n == "BSD-3-Clause" for n, _ in found):
            found = [f for f in found if f[0] != "BSD-2-Clause"]
        return min(found, key=lambda f: (f[0] == L.UNKNOWN, -f[1], f[0]), default=(None, 0.0))

    own, given = {}, {}
    for k, repo, path, text in table:
        name = (path or "").split("/")[-1]
        whole = bool(re.match(r"(?i)^(licen[cs]e|copying)([-._].*)?$", name))
        own[k], score = best(text or "", whole)
        if whole and own[k] and repo and path is not None:
            key = repo, "/".join(path.split("/")[:-1])
            given[key] = min(given.get(key, (True, 9, "")), (own[k] == L.UNKNOWN, -round(score, 9), own[k]))
    out = {}
    for k, repo, path, _ in table:
        license_, origin = own[k], "own" if own[k] else None
        parts = path.split("/")[:-1] if path is not None and repo else None
        while license_ is None and parts is not None:
            if (repo, "/".join(parts)) in given:
                license_, origin = given[repo, "/".join(parts)][2], "/" + "/".join(parts)
            elif not parts:
                break
            parts = parts[:-1]
        out[k] = (own[k], license_, origin)
    return out


def test_equals_brute_force(spark):
    files = spark.createDataFrame([(*r, "c", 1) for r in rows()], "file_id long, repo string, path string, text string, own string, depth int")
    found = L.scan_licenses(files).collect()
    assert len(found) == len(rows())
    want = brute(rows())
    assert {r.file_id: (r.own, r.license, r.origin) for r in found} == want
    by_path = {path: want[k] for k, _, path, _ in rows() if path}
    assert by_path["a/b/x.py"][1:] == ("GPL-3.0", "/a") and by_path["w.py"][0] == by_path["long.py"][0] == "Apache-2.0"
    assert by_path["u/v/x.py"][1:] == ("unknown", "/u") and by_path["a/COPYING"][0] == "unknown"
    assert (by_path["bsd.c"][0], by_path["bsd2.c"][0]) == ("BSD-3-Clause", "BSD-2-Clause")


def test_empty(spark):
    files = spark.createDataFrame([], "file_id long, repo string, path string, text string")
    assert L.scan_licenses(files).count() == 0


def test_no_segment_that_reaches_the_threshold_is_passed_over():
    model = L.Templates(L.TEMPLATES, {"the": 900, "license": 40, "work": 500}, 1000, L.THRESHOLD)
    for _, text in L.TEMPLATES:
        held = L.terms(text)
        for cut in range(1, len(held)):
            for part in (held[:cut], held[cut:]):
                segment = " ".join(part)
                assert model.best(segment)[0] < L.THRESHOLD or model.may_match(segment)


GNU = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by"
    " the Free Software Foundation; either version {} of the License, or (at your option) any later version."
)


@pytest.mark.parametrize(
    ("text", "license_"),
    [
        (GNU.format("General Public License", "2"), "GPL-2.0"), (GNU.format("General Public License", "3"), "GPL-3.0"),
        (GNU.format("Lesser General Public License", "2.1"), "LGPL-2.1"), (GNU.format("Lesser General Public License", "3"), "LGPL-3.0"),
        (GNU.format("Affero General Public License", "3"), "AGPL-3.0"), (GNU.format("Affero General Public License", "1"), "unknown"),
        (GNU.format("General Public License", "9"), "unknown"), ("This is licensed under the GNU General Public License.", "unknown"),
        (f"{BSD}:", "BSD-2-Clause"), (f"{BSD}:\n\n{CLAUSE}", "BSD-3-Clause"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
        ("Released under the ISC License.", "ISC"), ("Released under the MIT License.", "MIT"),
        ("Released under the MIT License. Released under the ISC License.", "unknown"),
        ("# SPDX-License-Identifier: LGPL-2.1-only", "LGPL-2.1-only"), ("/* SPDX-License-Identifier: ISC */", "ISC"),
        ("<!-- SPDX-License-Identifier: (MIT OR Apache-2.0) -->", "MIT OR Apache-2.0"), ("// SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0-only"),
    ],
)
@pytest.mark.parametrize("seen", [{}, {"the": 900, "license": 400, "work": 500, "version": 80, "3": 700, "2": 300}])
def test_neighbours_are_told_apart(text, license_, seen):
    model = L.Templates(L.TEMPLATES, seen, 1000, L.THRESHOLD)
    assert model.scan(text, True)[0] == license_
    assert model.scan(f"{prose(1, 50)}\n\n{text}\n\n{prose(2, 50)}", False)[0] == license_
    assert model.scan("Released under the Foo License.", True)[0] in (None, "unknown")
