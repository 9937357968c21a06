import functools
import hashlib
import re

import numpy as np

from assetscan.llm import pii as P
from . import cases as K


@functools.cache
def brute(t):
    t, out = t or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t) if "@" in t else ():   # quadratic on long words
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and P.luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


TRICKY = ["a@b.c_d@e.f x@y@z.com @q.r ab@c", "1.2.3.4.5.6.7.8 256.1.1.1 0255.0.0.01 1.2.3", "4539 1488 0343 6467 and 4539148803436468 1-2-3",
          "+1 (555) 123-4567 +12 +1 2 3 4 5 6 7 8 9 0 +49.30.1234567-", "é" * 5 + "user@host.example.org, 10.0.0.1;+33 1 23 45 67 89 4111111111111111",
          "..@..", "a.b+c%d-e_f@x-y.z-w.q", "9" * 5000, "a" * 20000 + "@x.y", "1." * 400, "+1" * 300]


def test_luhn():
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")


def test_base_spans_follow_the_patterns_and_stay():
    rng = np.random.default_rng(0)
    noise = ["".join(rng.choice(list("0123456789.+@- ()ab"), 60)) for _ in range(3000)]
    for t in TRICKY + noise:
        assert P.base_spans(t) == brute(t), t[:80]


def test_report_over_edge_rows(spark):
    docs = K.rows(n=6) + [(500 + i, t) for i, t in enumerate(TRICKY)] + [(600, "pay with password=hunter2secret99 now"), (601, "in 1999 about 45% of v2.0")] * 2
    got = P.find_personal_data(K.frame(spark, docs)).collect()
    want = sorted(((d, *[sum(s[0] == k for s in brute(t)) for k in P.KINDS],
                    hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in brute(t)).encode()).hexdigest()) for d, t in docs), key=repr)
    assert K.by_row([tuple(r)[:6] for r in got]) == want
    texts = dict(docs)
    for r in got:
        assert {f"{k}:{a}:{z}" for k, a, z in brute(texts[r.doc_id])} <= set(r.spans.split(",")) or not brute(texts[r.doc_id])
    assert all(r.spans == "" for r in got if r.doc_id == 601)
    assert P.find_personal_data(K.frame(spark, [])).count() == 0


def test_candidates_of_several_tokens_stand_for_their_tokens():
    text = ("call (555) 123-4567 or 030 1234 5678; Konto DE89 3704 0044 0532 0130 00 BIC; +1 (826) 555-4081 190.137.223.204 "
            "Dear Maria von Hagen, 12 Main Street or Hauptstraße 5b, Calle de Alcalá 45, 7 rue de Rivoli. The The x9")
    found = [(text[a:b], form) for a, b, form in P.candidates(text)]
    assert found == [("(555) 123-4567", "groups"), ("030 1234 5678", "groups"), ("DE89 3704 0044 0532 0130 00", "iban"), ("+1 (826) 555-4081", "groups"),
                     ("190.137.223.204", "token"), ("Maria von Hagen", "name"), ("12 Main Street", "address"), ("Hauptstraße 5b", "address"),
                     ("Calle de Alcalá 45", "address"), ("7 rue de Rivoli", "address"), ("x9", "token")]
    assert P.iban_holds("GB82 WEST 1234 5698 7654 32") and not P.iban_holds("GB82 WEST 1234 5698 7654 33") and not P.iban_holds("DE89 3704 0044 0532 0130 0")
    rng = np.random.default_rng(1)
    for t in TRICKY + ["".join(rng.choice(list("0123456789 -()+AaDE"), 80)) for _ in range(500)]:
        spans = P.candidates(t)
        assert all(b <= c for (_, b, _), (c, _, _) in zip(spans, spans[1:])) and all(0 <= a < b <= len(t) or a == b for a, b, _ in spans)


def test_added_spans_are_the_planted_ones(spark):
    """Planted data of every added form in half of the documents, numbers that are none in the other half."""
    rng = np.random.default_rng(5)
    d = lambda n: "".join(rng.choice(list("0123456789"), n))

    def account():
        body = d(18)
        check = 98 - int(body + "131400") % 97                # DE is 13 14
        plain = f"DE{check:02d}{body}"
        return " ".join(plain[i:i + 4] for i in range(0, 22, 4))

    planted = [lambda: ("phone", f"({rng.integers(200, 999)}) {d(3)}-{d(4)}"), lambda: ("phone", f"0{rng.integers(20, 99)} {d(4)} {d(4)}"), lambda: ("iban", account()),
               lambda: ("name", f"{rng.choice(sorted(P.GIVEN_NAMES))} {rng.choice(['Hagen', 'Oakley', 'Duval', 'Ortega'])}"),
               lambda: ("address", f"{rng.integers(1, 200)} {rng.choice(['Elm', 'Mill', 'Station'])} {rng.choice(['Street', 'Road', 'Lane'])}")]
    cue = {"phone": "phone", "iban": "iban", "name": "dear", "address": "address"}
    plain = [lambda: f"{rng.integers(1900, 2030)} {rng.integers(1900, 2030)} {rng.integers(1900, 2030)}", lambda: " ".join(str(rng.integers(10, 99)) for _ in range(6)),
             lambda: f"{rng.integers(1, 99)}%", lambda: f"v{rng.integers(1, 9)}.{rng.integers(0, 20)}"]
    docs, want = [], {}
    for i in range(600):
        head, tail = K.sentence(K.random.Random(i), 12), K.sentence(K.random.Random(-i), 9)
        if i % 2:
            kind, what = planted[i // 2 % len(planted)]()
            head += f" {cue[kind]}" if i % 3 else ""
            want[i] = f"{kind}:{len(head) + 1}:{len(head) + 1 + len(what)}"
        else:
            what = plain[i // 2 % len(plain)]()
        docs.append((i, f"{head} {what} {tail}"))
    got = {r.doc_id: set(filter(None, r.spans.split(","))) for r in P.find_personal_data(K.frame(spark, docs)).collect()}
    clean = [got[i] for i in range(0, 600, 2)]
    assert sum(map(bool, clean)) <= 3
    assert sum(want[i] in got[i] for i in want) >= 0.95 * len(want)
    masked = {r.doc_id: r.text for r in P.mask_personal_data(K.frame(spark, docs)).collect()}
    assert sum("<name>" in masked[i] for i in want if want[i].startswith("name")) >= 0.95 * sum(x.startswith("name") for x in want.values())


def test_em_finds_the_reliable_labelers():
    rng = np.random.default_rng(2)
    counts = {}
    for _ in range(20000):
        y = rng.random() < 0.4
        votes = [(1 if y else -1) if rng.random() < good else (-1 if y else 1) for good in (0.95, 0.9, 0.85, 0.6, 0.9, 0.5)]
        code = sum((v + 1) * 3 ** i for i, v in enumerate(votes))
        counts[code] = counts.get(code, 0) + 1
    _, table, prior = P.estimate_reliability(counts)
    assert abs(prior - 0.4) < 0.03
    assert np.allclose(table[1, :, 2], (0.95, 0.9, 0.85, 0.6, 0.9, 0.5), atol=0.03)


def test_masking_keeps_other_columns_and_text(spark):
    frame = K.frame(spark, [(1, "mail a@b.cd or 10.0.0.1."), (2, None), (3, "plain")])
    got = {r.doc_id: r for r in P.mask_personal_data(frame).collect()}
    assert got[1].text == "mail <email> or <ip>." and got[2].text is None and got[3].text == "plain"
    assert got[1].key == "k"
