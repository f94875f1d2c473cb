"""Base spans against plain regular expressions; what the trees add."""

from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F

from perimeter.llm import pii
from perimeter.llm.shared import Scratch

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(number):
    total = 0
    for n, d in enumerate(reversed(number)):
        d = int(d) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _passes(kind, value):
    number = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(number) <= 19 and _luhn(number)
    return kind == "email" or 9 <= len(number) <= 15


def _brute(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in BASE.items()
        for m in re.finditer(pattern, text or "")
        if _passes(kind, m.group())
    ]


def _card(rng):
    body = "4" + "".join(rng.choices("0123456789", k=14))
    return next(body + d for d in "0123456789" if _luhn(body + d))


def _texts(count):
    rng = random.Random(6)
    rows = []
    for n in range(count):
        good, parts = n % 2 == 0, []
        for _ in range(3):
            parts += rng.choices(["und", "the", "é", "x-y", "3.", "a.b", "12"], k=4)
            card = _card(rng)
            parts.append(
                rng.choice(
                    [f"u{n}.x@mail{n}.example.com", f"{n % 256}.{n % 200}.0.1", card, f"+1 (555) {n % 900 + 100}-0400"]
                    if good
                    else [f"{n}@", f"999.{n}.0.1", card[:-1] + str((int(card[-1]) + 1) % 10), f"+{n % 10} 55", "1.2.3", f"00 {n % 90 + 10} 99-9"]
                )
            )
        rows.append((n, " ".join(parts)))
    return rows


def _found(frame):
    return {
        r["doc_id"]: ([tuple(s) for s in r["base"]], [tuple(s) for s in r["added"]]) for r in pii.find(frame).collect()
    }


def test_base_equals_plain_patterns(documents):
    rows = _texts(300)
    rng = random.Random(1)
    rows += [(1_000 + n, "".join(rng.choices("01a.@-+ ()é_%", k=60))) for n in range(300)]
    rows += [(2_000 + n, "".join(rng.choices("0123456789-. +", k=80))) for n in range(200)]
    rows += [(3_000, "a@b.c_d@e.f a@b@c.d x@y..z 1.2.3.4.5.6.7.8 01.002.0003.255"), (3_001, "\U0001f600 a@b.c é 1.2.3.4")]
    found = _found(documents(rows))
    assert {k: v[0] for k, v in found.items()} == {i: _brute(t) for i, t in rows}


def test_masked_forms_are_added_and_clean_text_is_left(documents):
    rows = _texts(800)
    rows += [(5_000 + n, f"write to me{n} (at) mail.example.com now") for n in range(20)]
    rows += [(6_000 + n, "This is a clean text of 12 words, chapter 3.2.1, page 44.") for n in range(50)]
    found = _found(documents(rows))
    assert not any(added for i, (_, added) in found.items() if i >= 6_000)
    assert sum(bool(added) for i, (_, added) in found.items() if 5_000 <= i < 6_000) in (0, 20)


def test_masked_forms_are_added_at_every_size(documents):
    masked = [(5_000 + n, f"write to me{n} (at) mail.example.com now") for n in range(20)]
    plain = [(6_000 + n, f"call 555-123-4567, not 12 345 67{n}, {n} (at) home") for n in range(3)]
    for size in (0, 2, 800):
        found = {i: [kind for kind, _, _ in added] for i, (_, added) in _found(documents(_texts(size) + masked + plain)).items()}
        assert all(found[i] == ["email"] for i, _ in masked), size
        assert all(found[i] == ["phone"] for i, _ in plain), size


def test_a_rare_kind_is_calibrated_beside_a_frequent_one(documents, monkeypatch):
    """6,000 cards beside 12 addresses: their masked forms are still added."""
    monkeypatch.setattr(pii, "MAX_SAMPLE", 300)
    rng = random.Random(3)
    rows = []
    for n in range(300):
        cards = [_card(rng) for _ in range(20)]
        rows.append((n, " und ".join(c if k % 2 else c[:-1] + str((int(c[-1]) + 1) % 10) for k, c in enumerate(cards))))
    rows += [(2_000 + n, f"see u{n}@mail{n}.example.com or u{n} (at) home, u{n}@host{n}") for n in range(12)]
    rows += [(3_000 + n, f"see me{n} (at) mail{n}.example.com now") for n in range(20)]
    found = _found(documents(rows))
    kinds = {i: [kind for kind, _, _ in added] for i, (_, added) in found.items()}
    assert all(kinds[3_000 + n] == ["email"] for n in range(20))
    assert not any(kinds[2_000 + n] for n in range(12))


def test_odd_rows(documents, clashing):
    rows = [(1, None), (2, ""), (3, "9" * 60_000), (4, "a" * 60_000 + "@"), (5, "a@b.c"), (5, "a@b.c"), (None, "x 10.0.0.1")]
    found = pii.find(clashing(documents(rows))).collect()
    assert len(found) == len(rows)
    plain = sorted((str(r["doc_id"]), [tuple(s) for s in r["base"]]) for r in found)
    assert plain == sorted((str(i), _brute(t)) for i, t in rows)
    assert pii.find(documents([])).count() == 0


def test_span_list_and_redaction(documents):
    text = "+1 (555) 555-0400 a@b.c é 10.0.0.1"
    row = pii.find(documents([(1, text)])).select(pii.span_list(F.col("base")).alias("s"), "base")
    assert row.first()["s"] == "email:18:23,ip:26:34,phone:0:17"
    joined = row.crossJoin(documents([(1, text)]).select("text"))
    assert pii.redact(joined, F.col("base")).first()["text"] == "*" * 17 + " ***** é ********"


def test_many_matches_in_one_text(documents):
    """100,000 matches of three kinds, in time that grows with the text."""
    text = "a@b.c 10.0.0.1 x " * 33_400 + "+1 (555) 555-0400 " * 33_400
    began = time.perf_counter()
    rows = documents([(1, text)]).select(*(pii.base_spans(F.col("text"), k).alias(k) for k in ("email", "ip", "phone"))).collect()
    took = time.perf_counter() - began
    spans = {k: [(k, s["start"], s["start"] + len(s["value"])) for s in rows[0][k]] for k in ("email", "ip", "phone")}
    assert sum(spans.values(), []) == [s for s in _brute(text) if s[0] != "card"]
    assert took < 30


def test_what_stands_around_a_match(documents):
    text = "call a@b.c, then é 1.2.3.4x1.2.3.4"
    row = documents([(1, text)]).select(pii.located(F.col("text"), pii.STRICT["ip"]).alias("s")).first()
    assert [tuple(s) for s in row["s"]] == [(19, "1.2.3.4", "call a@b.c, then é ", "x"), (27, "1.2.3.4", "x", "")]


def test_candidates_and_strict_spans_by_place(documents):
    """Against all pairs: which loose candidates stay, and which lie in a strict span of another kind."""
    rng = random.Random(9)
    pieces = ["4111 1111 1111 1111", "+44 20 7946 0958", "10.0.0.1", "a@b.com", "555-123-4567", "x (at) y.org", "1.2.3.4.5", " ", "-", "+"]
    rows = [(n, "".join(rng.choices(pieces, k=rng.randint(1, 9)))) for n in range(200)]
    frame = documents(rows, 1)
    scratch = Scratch(frame.sparkSession, "test")
    found = scratch.store(pii.candidates(frame, "doc_id", "text"), "candidates")
    placed = {(r["row"], r["kind"], r["start"], r["end"]): r["passes"] for r in pii.apart(found).collect()}
    expected = {}
    for r in found.collect():
        for s in r["loose"]:
            same = [b for b in r["base"] if b["kind"] == s["kind"] and b["start"] < s["end"] and s["start"] < b["end"]]
            inside = [b for b in r["base"] if b["kind"] != s["kind"] and b["start"] <= s["start"] and s["end"] <= b["end"]]
            if not same:
                expected[r["row"], s["kind"], s["start"], s["end"]] = s["passes"] and not inside
    assert placed == expected and any(placed.values()) and not all(placed.values())
