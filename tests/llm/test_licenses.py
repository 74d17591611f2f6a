"""Operator 10 against brute force: all candidates, all templates, all ancestors."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from termscope.llm import licenses

SCHEMA = "doc_id long, text string, path string, license string, whole int"


def words(t):
    return re.findall("[a-z0-9]+", "".join(c.lower() if c.isascii() else c for c in t))


def brute_scan(texts, names, threshold=licenses.THRESHOLD):
    docs = [set(words(t or "")) for t in texts]
    df = Counter(w for d in docs for w in d)
    templates = [(n, words(t)) for n, ts in sorted(licenses.TEMPLATES.items()) for t in ts]
    vocabulary = {w for _, ws in templates for w in ws}

    def vec(ws):
        return {w: n * (math.log((1 + len(texts)) / (1 + (df[w] if w in vocabulary else 0))) + 1) for w, n in Counter(ws).items()}

    def cos(a, b):
        return sum(v * b.get(w, 0) for w, v in a.items()) / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))

    tv = [(n, vec(ws), len(ws), *([x.decode() for x in side] for side in licenses.agreement([w.encode() for w in ws]))) for n, ws in templates]
    out = []
    for t, name in zip(texts, names):
        t = t or ""
        units = [*t.split("\n"), *("\n".join(p) for p in paragraphs(t))]
        if name and re.match(licenses.LICENCE_FILE, name.split("/")[-1]):
            units.append(t)
        # (words, words that must not name another licence, the one template it is for)
        units = [(words(u), words(u), None) for u in units]
        every = words(t)
        for k, size in enumerate(x[2] for x in tv):
            for i in range(len(every) - size + 1):
                units.append((every[i:i + size], every[max(0, i - licenses.GUARD):i + size + licenses.GUARD], k))
        best = None
        for ws, near, only in units:
            if not ws:
                continue
            v = vec(ws)
            for k, (n, tvec, _, needs, bans) in enumerate(tv):
                if only not in (None, k) or not set(needs) <= set(ws) or set(bans) & set(ws) or (set(bans) - {"2", "3"}) & set(near):
                    continue
                rank = (round(cos(v, tvec), 9), len(needs))
                if rank[0] >= threshold and (best is None or rank > best[0] or rank == best[0] and n < best[1]):
                    best = (rank, n)
        out.append(best and (best[0][0], best[1]))
    return out


def paragraphs(t):
    out, now = [], []
    for line in [*t.split("\n"), ""]:
        if words(line):
            now.append(line)
        else:
            out.append(now)
            now = []
    return [p for p in out if len(p) > 1]


def test_against_brute_force(spark):
    rng = random.Random(4)
    lines = [t for ts in licenses.TEMPLATES.values() for t in ts]
    prose = ["the of and is under this", "work version 3 of the licensed thing", "Étude of a public license", "x y z", ""]
    rows = []
    for i in range(130):
        body = rng.choices(prose, k=rng.choice([0, 1, 3, 6]))
        if rng.random() < .4:
            line = rng.choice(lines).split(" ")
            for _ in range(rng.randrange(4)):
                line[rng.randrange(len(line))] = rng.choice(["zz", "the", "QQ,"])
            at = rng.randrange(len(line))
            body.insert(0, " ".join(line[:at]) + rng.choice([" ", "\n"]) + " ".join(line[at:]))
        folder = "/".join(rng.choices(["a", "b", "c"], k=rng.randrange(4)))
        name = rng.choice(["LICENSE", "COPYING.txt", "x.py", "y.md", "z.txt"]) + (f".{i}" if rng.random() < .7 else "")
        rows.append((i, None if rng.random() < .03 else "\n".join(body), f"{folder}/{name}" if folder else name, "clash", 1))
    rows += [(1000, "word " * 4_000 + "\nReleased under the MIT License.", None, None, None), (None, lines[0], "a/q.txt", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = licenses.scanned(df, F.col("path")).collect()
    want = brute_scan([r[1] for r in rows], [r[2] for r in rows])
    assert len(got) == len(rows)
    folder = lambda p: p.rpartition("/")[0]
    holders = {}
    for r, w in zip(rows, want):
        if w and r[2] and re.match(licenses.LICENCE_FILE, r[2].split("/")[-1]):
            holders.setdefault(folder(r[2]), []).append((-w[0], r[2], w[1]))
    inherited = 0
    for g in got:
        k = next(i for i, r in enumerate(rows) if r[0] == g.doc_id)
        w, path = want[k], rows[k][2]
        if w:
            assert (g.license, g.origin, g.license_path) == (w[1], "own", None) and abs(g.score - w[0]) < 1e-6
            continue
        at = folder(path) if path is not None else None
        while at is not None and at not in holders:
            at = None if at == "" else folder(at)
        if at is None:
            assert (g.license, g.origin, g.license_path) == (None, None, None)
        else:
            _, p, name = min(holders[at])
            assert (g.license, g.origin, g.license_path) == (name, "inherited", p)
            inherited += 1
    assert inherited > 10


def test_notices_within_lines_and_versions_that_must_agree(spark):
    """Notices that share a line with other words are found; a version or variant without a template is no other licence."""
    texts = {
        "Copyright 2020 Foo Bar. Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Some text about the corpus and more. Released under the MIT License. See the file for details of it.": "MIT",
        "code(); // SPDX-License-Identifier: MIT": "MIT", "SPDX-License-Identifier: GPL-2.0": "GPL-2.0", "SPDX-License-Identifier: LGPL-3.0": "LGPL-3.0",
        licenses.NOTICES["GPL-2.0"][1]: "GPL-2.0", licenses.NOTICES["GPL-3.0"][1]: "GPL-3.0", licenses.NOTICES["LGPL-2.1"][1]: "LGPL-2.1",
        licenses.NOTICES["AGPL-3.0"][1] + " Ask us": "AGPL-3.0", "x = 1\n" + licenses.NOTICES["GPL-3.0"][1] + " y = 2 " * 10: "GPL-3.0",
        "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Licensed under CC BY-ND 4.0.": None, "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "Distributed under the BSD 2-Clause License.": "BSD-2-Clause", "Distributed under the BSD 3-Clause License.": "BSD-3-Clause",
        licenses.NOTICES["BSD-2-Clause"][1] + "\n" + licenses.NOTICES["BSD-3-Clause"][1]: "BSD-3-Clause",
        "This work is licensed under the GNU General Public License, version 4.": None, "nothing of the kind is said here": None,
    }
    rows = [(i, t, f"f{i}.txt", None, 1) for i, t in enumerate(texts)] + [(1000 + i, f"filler text {i} of the corpus that is for you and version {i}", f"z{i}", None, 1) for i in range(400)]
    got = {r.doc_id: r.license for r in licenses.scanned(spark.createDataFrame(rows, SCHEMA), F.col("path")).collect()}
    assert {t: got[i] for i, t in enumerate(texts)} == texts
    assert not any(got[1000 + i] for i in range(400))


def test_frequencies(spark):
    texts = ["The License, the license", None, "", "K\u212a license é", "MIT"]
    found, n = licenses.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"), "text", licenses.TEMPLATES)
    assert n == 5 and found[b"license"] == 2 and found[b"the"] == 1 and found[b"mit"] == 1


def test_empty_table(spark):
    assert licenses.scanned(spark.createDataFrame([], SCHEMA), F.col("path")).count() == 0
