import hashlib

import numpy as np

from assetscan.llm import fingerprints as P
from . import cases as K


def test_edited_texts_likeness_and_equal_fingerprints(spark):
    docs = [(i, t) for i, (_, t) in enumerate(K.rows(n=60))]
    got = {r.doc_id: r for r in P.fingerprint_table(K.frame(spark, docs), buckets=8).collect()}
    assert len(got) == len(docs)
    shingles = lambda t: {tuple(w[i:i + 5]) for w in [K.words(t)] for i in range(max(1, len(w) - 4)) if w}
    by_text, errors = {}, []
    for i, (d, t) in enumerate(docs):
        t, nxt = t or "", docs[(i + 1) % len(docs)][1] or ""
        ed = P.edited(t, nxt)
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(ed.encode()).hexdigest()
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        for other, near in ((ed, r.near_edited), (nxt, r.near_next)):
            a, b = shingles(t), shingles(other)
            errors.append(near - (len(a & b) / len(a | b) if a | b else 1.0))
    assert np.sqrt(np.mean(np.square(errors))) < 0.05 and np.abs(errors).max() < 0.2


def test_densification_fills_every_bin_from_an_occupied_one():
    low, held = np.zeros((1, P.BINS), np.uint8), np.zeros((1, P.BINS), bool)
    low[0, [3, 200]], held[0, [3, 200]] = (7, 9), True
    full = P._densify(low, held)
    assert set(full[0]) == {7, 9}
    for b in (0, 77, 255):
        first = min((3, 200), key=lambda j: P._TURN[b, j]) if b not in (3, 200) else b
        assert full[0, b] == low[0, first]


def test_null_ids_repeats_empty_and_single_rows(spark):
    docs = K.rows(n=5)
    assert P.fingerprint_table(K.frame(spark, docs)).count() == len(docs)
    assert P.fingerprint_table(K.frame(spark, [])).count() == 0
    one = P.fingerprint_table(K.frame(spark, [(4, "a b c d e f g")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(4, 1.0)]
