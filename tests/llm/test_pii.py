"""Spans against plain patterns in Python."""

from __future__ import annotations

import hashlib
import re

from fixtures import empty, frame, stored, texts
from orderweave.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    spans = [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m[0])]
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return [sum(s[0] == k for s in spans) for k in PLAIN] + [hashlib.sha256(listed.encode()).hexdigest()], listed


TRICKY = [
    (100, "a@b.c@d.e x@y.zz%%%a@b.c.d_e@f.g @x.y a@b a@b. a@b..c é@x.fr mailto:me@x.org."),
    (101, "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.0004 99999999999999999999999.1.1.1 1..2.3.4 0000000000255.1.1.1"),
    (102, "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 41111111111111111111111 12 3-4--5 0000000000000"),
    (103, "+1 (017) 555-7713 ++49 30 1234567 +1 +12 +123456789012345678 +1.2.3.4.5.6.7.8.9 + 1 +1)))))2345678 90-"),
    (104, "\U0001F600\U0001F600 me@x.org \U0001F600 +49 30 1234567 é 10.0.0.1"),
    (105, "a" * 40000 + " " + "9" * 40000 + " " + "1 " * 30000 + " x@y.zz " + "+1" + " 2" * 20000),
    (106, "Dr. Ada Lovelace, my IBAN DE89 3704 0044 0532 0130 00 at the bank, ssn 123-45-6789; ABCD 12 Mr x"),
    (107, "Contact Mrs Jane Doe by mail jane@doe.org"),
]


def test_base_spans(spark):
    rows = texts() + TRICKY + stored("documents", "doc_id + 1000, text")
    got = {(r["doc_id"], r["base_sha256"]): r for r in pii.span_digest(frame(spark, rows)).collect()}
    for doc, text in rows:
        (counts, listed) = brute(text)
        row = got[doc, counts[-1]]
        assert [row[f"n_{k}"] for k in PLAIN] == counts[:-1]
        base = [s for s in row["spans"].split(",") if s.split(":")[0] in PLAIN]
        assert ",".join(base) == listed


def test_added_spans_are_voted_in(spark):
    rows = TRICKY + stored("documents", "doc_id + 1000, text")
    found = {r["doc_id"]: r["spans"] for r in pii.span_digest(frame(spark, rows)).collect()}
    kinds = {s.split(":")[0] for s in found[106].split(",")}
    assert {"name", "iban", "ssn"} <= kinds
    assert "name" in found[107]


def test_redaction(spark):
    rows = [(1, "mail me@x.org or +49 30 1234567!"), (2, None), (3, "clean"), (4, "4111 1111 1111 1111")]
    out = pii.redact(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()} == {
        1: ("mail [EMAIL] or [PHONE]!", 24), 2: (None, None), 3: ("clean", 5), 4: ("[CARD]", 6)}


def test_empty(spark):
    assert pii.span_digest(empty(spark)).collect() == []
    assert pii.redact(empty(spark)).collect() == []


def test_plan_is_native(spark):
    plan = pii.span_digest(frame(spark, TRICKY))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
