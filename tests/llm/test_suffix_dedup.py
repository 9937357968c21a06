import hashlib
from collections import Counter

import numpy as np

from assetscan.llm import suffix_dedup as S
from . import cases as K


def brute(docs, length=S.LENGTH):
    data = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i:i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((gone[:-1] & ~np.concatenate(([False], gone[:-1]))[:-1]).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]]) if b else b""
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_matches_brute_force(spark):
    docs = K.rows(seed=2, n=30)
    docs += [(700, "x" * 199), (701, "y" * 200), (702, "z" * 201), (703, "0123456789" * 60), (704, "é" * 150 + "q" + "é" * 100)]
    got = S.remove_repeats(K.frame(spark, docs)).collect()
    assert K.by_row(got) == brute(docs)


def test_repeated_rows_cost_their_number_not_its_square(spark):
    import random
    import time
    text = K.sentence(random.Random(1), 550)
    seconds = {}
    for n in (20, 200, 1600):                             # the first one warms up
        docs = [(None, text)] * n + [(i, K.sentence(random.Random(1000 + i), 120)) for i in range(20)]
        start = time.time()
        got = S.remove_repeats(K.frame(spark, docs)).collect()
        seconds[n] = time.time() - start
        assert sorted(r.n_removed for r in got) == [0] * 20 + [len(text.encode())] * n
    assert seconds[1600] < 2 * 8 * seconds[200]


def test_texts_cut_into_parts_agree_with_whole_ones(spark, monkeypatch):
    rng = np.random.default_rng(0)
    long = bytes(rng.integers(97, 123, 9000, dtype=np.uint8)).decode()
    docs = [(1, long), (2, long[3000:5000] + "-" + long[:400]), (3, long[8700:])]
    monkeypatch.setattr(S, "CHUNK", 700)
    parts = []
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([t for _, t in docs])], names=["rk", "text"])
    for out in S._runs([batch]):
        parts += out.to_pylist()
    for rk, (_, t) in zip((1, 2, 3), docs):              # every window of each text lies in exactly one run
        covered = sorted(s for r in parts if r["rk"] == rk for s in range(r["s"], r["s"] + r["m"]))
        assert covered == list(range(len(t) - S.LENGTH + 1))


def test_empty_table(spark):
    assert S.remove_repeats(K.frame(spark, [])).count() == 0
