"""Operator 2: base spans against Python's re; discovery on planted contexts."""

import hashlib
import random
import re

from termscope.llm import pii

SCHEMA = "doc_id long, text string, base string, kind int, spans int"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def ok(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if ok(k, m.group())] for k, p in BASE.items()}


def with_check_digit(rng, n):
    body = "".join(rng.choices("0123456789", k=n - 1))
    return next(body + c for c in "0123456789" if luhn(body + c))


def check_base(got, texts):
    for r in got:
        want = brute(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(len, want.values())), texts[r.doc_id]
        shown = ",".join(f"{k}:{a}:{b}" for k, s in want.items() for a, b in s)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        if not r.n_added:
            assert r.spans == shown


def test_base_spans(spark):
    rng = random.Random(7)
    bits = ["a.b@c-d.e", "x@y", "@", "..", "@a.b", "_", "%+", "1.2.3.4", "256.1.1.1", "001.02.0.255", "1.2.3", "9" * 30, "+", "+1 (988) 555-2485",
            "+12 34", "-", " ", "(", ").", "é", "😀", "\n", "word", "12", "7", "4111 1111 1111 1111", "4111-1111-1111-1112", ",", "00000000000000000001.1.1.1"]
    texts = ["".join(rng.choices(bits, k=rng.choice([1, 3, 8, 20]))) for _ in range(1500)]
    texts += [" ".join([f"u{i}@h{i}.org", with_check_digit(rng, 13 + i % 7), f"+{10 ** (8 + i % 8)}", f"{i}.{i}.{i}.{i}"]) for i in range(300)]
    texts += ["a" * 20_000, "1" * 20_000, "1 " * 60_000, "a@b" + ".c" * 50_000, "+1" + "(" * 100_000, None, "", "x@y.z " * 2000, "é1" * 30_000 + " 1.2.3.4"]
    got = pii.report(spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in enumerate(texts)], SCHEMA)).collect()
    assert len(got) == len(texts)
    check_base(got, texts)


def test_trusted_patterns_find_unseen_identifiers(spark):
    rng = random.Random(1)
    texts = [f"Hello there. my phone is +1 (5{i:02d}) 555-20{i:02d} thanks" for i in range(20)]
    texts += [f"note: card number {with_check_digit(rng, 16)} expires" for _ in range(8)]
    texts += ["well my phone is 0171-5550199 thanks", "call 0171-5550199 now, or mail a@b.org", "my phone is 0171-5550199 thanks"]
    texts += ["about version 12.5-rc17 of it", "the year 1984-1985 was", "my phone is +4 so there", "serial no 99887766-55", "É 12345"]
    got = pii.report(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], SCHEMA)).collect()
    check_base(got, texts)
    added = {(r.doc_id, s) for r in got for s in (r.spans.split(",") if r.spans else [])
             if tuple(map(int, s.split(":")[1:])) not in brute(texts[r.doc_id])[s.split(":")[0]]}
    want = {(i, f"phone:{t.index('0171')}:{t.index('0171') + 12}") for i, t in enumerate(texts) if "0171" in t}
    assert added == want and sum(r.n_added for r in got) == len(want)


def test_unseen_identifiers_with_blanks_and_glued_seeds(spark):
    texts = [f"Hello there. my phone is +1 (5{i:02d}) 555-20{i:02d} thanks" for i in range(40)]
    unseen = ["555 123 4567", "0171 555 0199", "(555) 123-4568", "0171-5550199"]
    texts += [f"well my phone is {u} thanks" for u in unseen]
    texts += [f"reach us at E-mail: <bob{i}@x.org>### today" for i in range(8)]
    got = pii.report(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], SCHEMA)).collect()
    check_base(got, texts)
    spans = {r.doc_id: r.spans for r in got}
    for i, u in enumerate(unseen, 40):
        assert spans[i] == f"phone:17:{17 + len(u)}", (u, spans[i])
    found = pii.mentions(spark.createDataFrame([(1, "x", "Email:bob@x.org a@b.org### c@d.org")], "id long, digest string, text string"))
    assert sorted((r.string, r.kind) for r in found.collect()) == [("a@b.org", 0), ("bob@x.org", 0), ("c@d.org", 0)]


def test_as_many_unseen_identifiers_as_seeds(spark):
    """A context is trusted while half of its strings are to be discovered, not where most of them are something else."""
    texts = [f"hi. my phone is +1 (5{i:02d}) 555-20{i:02d} today" for i in range(8)] + [f"hi. my phone is 0171-55501{i:02d} today" for i in range(8)]
    texts += [f"see order no +1 (5{i:02d}) 555-30{i:02d} soon" for i in range(4)] + [f"see order no 88-77{i:03d} soon" for i in range(60)]
    texts += [f"reach it by bob{i}@x.org or so" for i in range(4)] + [f"reach it by {i}.{i}.{i}.7 or so" for i in range(4)] + ["reach it by a77-b88 or so"]
    got = pii.report(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], SCHEMA)).collect()
    check_base(got, texts)
    assert {r.doc_id for r in got if r.n_added} == set(range(8, 16))  # neither orders nor what two kinds share
    assert {r.spans for r in got if r.doc_id in range(8, 16)} == {"phone:16:28"}


def test_one_word_before_is_a_pattern(spark):
    """Contexts that share only the word before the identifier."""
    texts = [f"w{chr(97 + i)} phone +1 (5{i:02d}) 555-20{i:02d} z{chr(97 + i)}" for i in range(20)]
    texts += ["other phone 0171-5550199 end", "other fax 0171-5550188 end", "order 88-77123 end"]
    got = pii.report(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], SCHEMA)).collect()
    check_base(got, texts)
    assert {r.doc_id: r.spans for r in got if r.n_added} == {20: "phone:12:24"}
    assert all(r.n_spans == len([s for s in r.spans.split(",") if s]) for r in got)


def test_repeated_rows_and_empty_table(spark):
    assert pii.report(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a@b.c", "x", 1, 2), (1, "a@b.c", "x", 1, 2), (1, "nothing", "x", 1, 2), (None, "1.1.1.1", None, None, None)]
    got = pii.report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.spans for r in got) == ["", "email:0:5", "email:0:5", "ip:0:7"]
