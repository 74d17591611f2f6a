"""Operator 5 against brute force."""

import hashlib
import random
from collections import Counter

from termscope.llm import line_dedup

SCHEMA = "doc_id long, text string, n_chars long, lines string, row int"


def brute(rows):
    """Documents by id, then by the MD5 of the text; every window but its first occurrence covers its lines.
    Per (id, text): what each of its rows is cut to, as (text, lines, lines removed)."""
    seen, out = set(), {}
    for i, text in sorted(((i, t) for i, t, *_ in rows if t is not None),
                          key=lambda x: (x[0] is not None, x[0] or 0, hashlib.md5(x[1].encode()).digest())):
        lines = text.split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if w in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(w)
        out.setdefault((i, text), []).append(("\n".join(x for p, x in enumerate(lines) if p not in gone), len(lines), len(gone)))
    return out


def test_against_brute_force(spark):
    rng = random.Random(1)
    pool = [f"line {i}" for i in range(25)] + ["", "", " ", "é", "\r"]
    texts = ["\n".join(rng.choices(pool, k=rng.choice([0, 1, 2, 3, 4, 9, 40]))) for _ in range(150)]
    block = "\n".join(f"common {i}" for i in range(5))
    texts += [f"own {i}\n{block}\nend {i}" for i in range(60)]  # a window that a third of the rows hold
    texts += ["a\na\na\na\na", None, "", "x\n" * 3000, texts[3]]
    rows = [(i, t, -1, "clash", 1) for i, t in enumerate(texts)] + [(None, "a\nb\nc\nd", 1, None, None)] * 2
    rows += rows[:4]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    got = line_dedup.report(df).collect()
    assert len(got) == len(rows)
    clean = line_dedup.clean(df)
    assert clean.schema.names == df.schema.names
    found = Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got)
    assert found == Counter((i, *cut) for (i, _), cuts in want.items() for cut in cuts) + Counter(
        (i, None, 0, 0) for i, t, *_ in rows if t is None)
    chars = Counter((r.doc_id, r.text, r.n_chars) for r in clean.collect())
    given = {(i, t): c for i, t, c, *_ in rows}
    assert chars == Counter((i, t, len(t) if n else given[i, old]) for (i, old), cuts in want.items() for t, _, n in cuts) + Counter(
        (i, None, c) for i, t, c, *_ in rows if t is None)
    assert {r.lines for r in clean.collect()} == {"clash", None}
    assert sum(r.n_removed > 0 for r in got) > 60


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_dedup.report(empty).count() == 0 and line_dedup.clean(empty).count() == 0
