import math
import zlib
from collections import Counter

import numpy as np

from assetscan.llm import brown_lm as B
from . import cases as K


def likelihood(cls, bigrams, k):
    joint = np.zeros((k, k))
    for i in range(len(cls)):
        for j in range(len(cls)):
            joint[cls[i], cls[j]] += bigrams[i, j]
    f = lambda x: sum(v * math.log(v) for v in np.ravel(x) if v > 0)
    return f(joint) - f(joint.sum(0)) - f(joint.sum(1))


def test_exchange_raises_the_likelihood_to_a_local_optimum():
    rng = np.random.default_rng(3)
    bigrams = rng.poisson(1.5, (12, 12)).astype(float)
    bigrams[:6, 6:] += 8
    start = np.arange(12) % 3
    cls, history = B.exchange(bigrams, np.zeros(12, bool), 3, start, sweeps=50)
    assert all(b >= a - 1e-9 for a, b in zip(history, history[1:]))
    assert abs(history[-1] - likelihood(cls, bigrams, 3)) < 1e-6
    for w in range(12):                                   # no single move is better
        for c in range(3):
            moved = cls.copy()
            moved[w] = c
            assert likelihood(moved, bigrams, 3) <= history[-1] + 1e-6


def test_counts_base_scores_and_held_out_gain(spark):
    rng = np.random.default_rng(1)
    nouns, verbs = [f"n{i}" for i in range(40)], [f"v{i}" for i in range(40)]
    made = [(i, " ".join(f"{rng.choice(nouns)} {rng.choice(verbs)}" for _ in range(30))) for i in range(200)]
    docs = made + [(1000, None), (1001, ""), (1002, "N1 v1\n\tunseen"), (1002, "N1 v1\n\tunseen"), (None, "n1 n2"), (1003, "x " * 5000)]
    got = B.class_lm_scores(K.frame(spark, docs)).collect()
    tokens = lambda t: K.words(t) + ["\n"]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    c = Counter(w for d, t in docs if not held(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((d, held(d), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                    round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in tokens(t)), 6)) for d, t in docs), key=repr)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == want
    out = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.1 * sum(r.n_tokens for r in out)
    assert all(r.score < 0 and r.perplexity > 1 for r in got)


def test_empty_table_and_only_held_out_rows(spark):
    assert B.class_lm_scores(K.frame(spark, [])).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = B.class_lm_scores(K.frame(spark, [(only, "a b")])).collect()[0]
    assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 3) and abs(r.base_score) < 1e-9


def test_core_and_classes_follow_the_vocabulary(spark):
    assert B.n_core(100) >= 1024 and B.n_core(16_000_000) == 4000 and B.n_classes(100) == 24 and B.n_classes(16_000_000) > 120
    words = np.array([5, 9, B.END_HASH] + list(range(100, 900)))
    words.sort()
    counts = np.arange(len(words))[::-1] + 1
    cls, gains = B.cluster_core(words, counts, np.ones((len(words) + 1,) * 2), 30)
    assert cls.max() == 31 and gains.shape == (2, 32, 32) and len(set(cls)) > 24


def test_other_words_take_the_class_of_all_their_neighbours(spark, monkeypatch):
    """Words outside the core: the class is best over the corpus, whatever the blocks and partitions."""
    rng = np.random.default_rng(5)
    core = np.sort(rng.choice(10**9, 12, replace=False) + 10)
    core = np.insert(core, 0, B.END_HASH)
    k = 6
    cls = np.concatenate(([k - 1], rng.integers(0, k - 2, 12)))
    gains = np.log(rng.dirichlet(np.ones(k), (2, k)).transpose(0, 2, 1))
    other = [f"w{i}" for i in range(20)]
    texts = [[int(x) if rng.random() < 0.6 else str(rng.choice(other)) for x in rng.choice(core[1:], 15)] for _ in range(60)]
    number = {w: 2 * 10**9 + i for i, w in enumerate(other)}
    rows, want = [], {w: np.zeros(k - 2) for w in number.values()}
    for at in range(0, 60, 5):
        tokens, lengths = [], []
        for t in texts[at:at + 5]:
            ids = [number.get(w, w) for w in t] + [B.END_HASH]
            of = [int(cls[list(core).index(x)]) if x in core else k - 2 for x in ids]
            for i, x in enumerate(ids):
                if x in want:
                    want[x] += gains[0, of[i - 1] if i else k - 1, :k - 2] + gains[1, of[i + 1], :k - 2]
            tokens += ids
            lengths.append(len(ids))
        vocabulary, local, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        rows.append((at, [0] * len(lengths), [False] * len(lengths), lengths, bytearray(B._pack(local)), vocabulary.tolist(), counts.tolist()))
    sc = spark.sparkContext
    full = sc.broadcast(np.full(4096, 255, np.uint8))
    for parts, limit in ((1, 1 << 21), (4, 30)):
        monkeypatch.setattr(B, "NEIGHBOURS", limit)
        blocks = spark.createDataFrame(rows, B.BLOCKS).repartition(parts)
        near = blocks.mapInArrow(B._neighbours(sc.broadcast(core), sc.broadcast(cls), k, full), "word long, near binary")
        got = near.repartition(3, "word").sortWithinPartitions("word").mapInArrow(B._best_classes(sc.broadcast(gains)), "word long, class int").collect()
        assert {r["word"]: r["class"] for r in got} == {w: int(x.argmax()) for w, x in want.items()} and len(got) == 20


def test_many_neighbours_and_batches():
    import pyarrow as pa
    gains = np.log(np.random.default_rng(2).dirichlet(np.ones(5), (2, 5)))
    parts = [(np.array([7, 7, 8]), np.array([0, 9, 3]), np.array([200_000, 5, 65_535])), (np.array([7]), np.array([9]), np.array([70_000]))]
    batch = B._packed_neighbours(parts)
    assert batch.column(0).to_pylist() == [7, 8]
    pairs = np.frombuffer(batch.column(1)[0].as_py(), "<u2").reshape(-1, 2).astype(int)
    assert pairs[pairs[:, 0] == 0, 1].sum() == 200_000 and pairs[pairs[:, 0] == 9, 1].sum() == 70_005

    class Held:
        value = gains
    both = gains.reshape(10, 5)[:, :3]
    want = [(7, int((200_000 * both[0] + 70_005 * both[9]).argmax())), (8, int(both[3].argmax()))]
    whole = [tuple(x) for b in B._best_classes(Held)([batch]) for x in zip(*(c.to_pylist() for c in b.columns))]
    split = [tuple(x) for b in B._best_classes(Held)([B._packed_neighbours([p]) for p in (tuple(x[:1] for x in parts[0]), tuple(x[1:2] for x in parts[0]), parts[1], tuple(x[2:] for x in parts[0]))])
             for x in zip(*(c.to_pylist() for c in b.columns))]
    assert whole == split == want
