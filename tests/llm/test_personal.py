"""Personal data against a plain version, spans and bootstrapping alike."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest

from lettermill.llm import personal

SCHEMA = "doc_id long, text string, spans string"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = "|".join([
    r"(?:[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)", r"(?<![0-9.])[0-9]+(?:\.[0-9]+){3,}", PLAIN["phone"],
    r"(?<![A-Za-z0-9])[0-9](?:[\x20-]?[0-9]){5,}", r"(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{8,}",
])


def good(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1]))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain_base(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m[0])]


def plain(rows):
    order = list(PLAIN)
    bases = [plain_base(t) for _, t, *_ in rows]
    seen, edges, kinds = [], set(), {}
    for n, (_, text, *_) in enumerate(rows):
        text = text or ""
        ms = list(re.finditer(LOOSE, text))
        for j, m in enumerate(ms):
            a = text[ms[j - 1].end() if j else 0 : m.start()]
            b = text[m.end() : ms[j + 1].start() if j + 1 < len(ms) else len(text)]
            split = lambda s: [w for w in re.split(r"[\x20\x09-\x0D]+", s.lower()) if w]
            left = ["<end>" if j == 0 else "<id>"] * 2 + split(a[-80:])
            right = split(b[:80]) + ["<end>" if j + 1 == len(ms) else "<id>"] * 2
            for p in (f"{left[-2]} {left[-1]} _", f"{left[-1]} _ {right[0]}", f"_ {right[0]} {right[1]}"):
                edges.add((m[0], p))
            kind = next((i for i, k in enumerate(order) if re.fullmatch(PLAIN[k], m[0]) and good(k, m[0])), None)
            if kind is not None:
                kinds[m[0]] = kind
            seen.append((n, m[0], m.start(), m.end()))
    seeds, known = dict(kinds), dict(kinds)
    for _ in range(personal.ROUNDS):
        slots = {}
        for v, p in edges:
            slots.setdefault(p, []).append(known.get(v))
        sure = {}
        for p, ks in slots.items():
            n, kind = max((sum(k == i for k in ks), -i) for i in range(4))
            if n >= 3 and 5 * n >= 4 * (len(ks) + 1):
                sure[p] = (-kind, round(-1e6 * math.log(1 - n / (len(ks) + 1))))
        score = {}
        for v, p in edges:
            if p in sure:
                score[v, sure[p][0]] = score.get((v, sure[p][0]), 0) + sure[p][1]
        fresh = {}
        for (v, k), s in score.items():
            if v not in known and s >= round(-1e6 * math.log(1 - 0.9)):
                fresh[v] = max(fresh.get(v, (0, 0)), (s, -k))
        if not fresh:
            break
        known |= {v: -k for v, (_, k) in fresh.items()}
    out = []
    for n, (doc, *_) in enumerate(rows):
        spans = [(order.index(k), a, b) for k, a, b in bases[n]]
        text = lambda xs: ",".join(f"{order[k]}:{a}:{b}" for k, a, b in sorted(xs))
        extra = [(known[v], a, b) for i, v, a, b in seen if i == n and v in known and v not in seeds and all(b <= s or e <= a for _, s, e in spans)]
        out.append((doc, *[sum(k == i for k, _, _ in spans) for i in range(4)], hashlib.sha256(text(spans).encode()).hexdigest(), text(spans + extra)))
    return sorted(out, key=repr)


def found(spark, rows, parts=3):
    got = personal.find_personal_data(spark.createDataFrame(rows, SCHEMA).repartition(parts))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    return sorted(map(tuple, got.collect()), key=repr)


def luhn(rng):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(body + d for d in "0123456789" if good("card", body + d))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    fill = lambda: " ".join(rng.choice("the of déjà vu and that 😀 from this word".split()) for _ in range(rng.randrange(4, 30)))
    value = {
        "write me at {} thanks": lambda i: f"u{i}.x@mail{i % 3}.example.com",
        "my card number is {} ok": lambda i: luhn(rng),
        "call us under {} today": lambda i: f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}",
        "server at address {} is down": lambda i: f"10.{i}.3.{rng.randrange(256)}",
    }
    rows = []
    for i in range(160):
        frame, make = list(value.items())[i % 4]
        rows.append((i, f"{fill()} {frame.format(make(i))} {fill()}", None))
    rows += [(200, f"{fill()} write me at boss@localhost thanks {fill()}", "x"), (201, "call us under 020 555 1234 today", None)]
    rows += [(202, "my card number is 4000 1234 5678 9999 ok and order 123456789 too", None), (203, "a 020 555 1234 b", None)]
    rows += [(210 + k, f"ref token = {rng.randrange(16**12):012x}a1 end {fill()}", None) for k in range(30)]
    rows += [(300, None, None), (301, "", None), (None, "x a@b.cd y", None), (None, "1.2.3.4", None), (5, rows[5][1], None), (5, rows[5][1], None)]
    rows += [(310, "a@b.c%d@e.f a@b.c.d.@x 1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.255 1.2.3 +1 2 +12 (34) 5678-90. +1234567890123456", None)]
    rows += [(311, "x@y 12 " * 3000 + "9" * 5000 + " a" * 3000 + "z" * 60000 + "@q.r" + ".s" * 9000, None)]
    return rows


def test_equals_the_plain_version(spark, rows):
    got = found(spark, rows)
    assert got == plain(rows)
    spans = {r[0]: r[6] for r in got}
    assert spans[200].startswith("email:") and spans[201] == "phone:14:26" and spans[203] == "phone:2:14"
    assert spans[202] == "card:18:37" and spans[210] == ""


def test_random_text_equals_the_plain_version(spark):
    rng = random.Random(9)
    bits = ["@", ".", "+", " ", "-", "(", ")", "a", "b7", "12", "255", "256", "4111 1111 1111 1111", "é", "\n", "%", "_x"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(60))), None) for i in range(1500)]
    assert found(spark, rows, 5) == plain(rows)


def test_second_round_uses_what_the_first_found(spark):
    seeds = [(i, f"mail to me{i}@site.org please", None) for i in range(8)]
    bridge = [(100 + i, f"mail to odd{i}@host please", None) for i in range(8)] + [(120 + i, f"reach odd{i}@host now", None) for i in range(8)]
    rows = seeds + seeds[:1] + bridge + [(150, "reach far@place now", None)]
    rows += [(160 + i, f"mail to new{i}@site.net please", None) for i in range(60)]
    got = {r[0]: r[6] for r in found(spark, rows)}
    assert got[100] == "email:8:17" and got[150] == "email:6:15"
    one = personal.find_personal_data(spark.createDataFrame(rows, SCHEMA), rounds=1)
    assert {r["doc_id"]: r["spans"] for r in one.collect()}[150] == ""


def test_no_python_in_the_plan(spark, rows):
    plan = personal.find_personal_data(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    cuts = personal.cut_texts(spark.createDataFrame(rows, SCHEMA))
    for step in (personal.base_spans(cuts), personal.candidates(cuts)):
        assert step.count() >= 0


def test_empty_table(spark):
    assert found(spark, []) == []
