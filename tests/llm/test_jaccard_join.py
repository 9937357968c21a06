import random

from assetscan.llm import jaccard_join as J
from . import cases as K


def shingles(t, n=J.N):
    w = K.words(t)
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(docs):
    """Per row: (doc_id, set size, smallest id reachable over links between rows)."""
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 90 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(find(i), []).append(docs[i][0])
    out = []
    for i, (d, _) in enumerate(docs):
        ids = [x for x in groups[find(i)] if x is not None]
        out.append((d, len(sets[i]), d if not sets[i] else min(ids) if ids else None))
    return sorted(out, key=repr)


def near_group(seed=7, n=60):
    """Copies of one text with up to eight edits each: links run along chains, not to one centre."""
    rng = random.Random(seed)
    base = K.sentence(rng, 150).split(" ")
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = rng.choice(("edit", "alter", "swap"))
        out.append((2000 + i, " ".join(w)))
    return out


def test_components_match_brute_force(spark):
    docs = [(d, t) for d, t in K.rows(seed=3) if len(t or "") < 50000] + near_group()
    got = J.jaccard_report(K.frame(spark, docs)).collect()
    assert K.by_row(got) == brute(docs)


def test_keep_one_of_each(spark):
    docs = near_group(n=20) + [(1, "a b c d"), (1, "a b c d"), (2, "A B c d"), (3, ""), (4, None), (None, "lone words here"), (5, "")]
    frame = K.frame(spark, docs)
    kept = J.keep_one_of_each(frame)
    assert kept.columns == frame.columns
    parts = {(d, c) for d, _, c in brute(docs)}
    want = sorted([d for d, c in parts if d == c and d is not None] + [None], key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want


def test_prefix_filter_loses_no_pair():
    rng = random.Random(1)
    for _ in range(300):
        universe = list(range(60))
        x = set(rng.sample(universe, rng.randint(5, 50)))
        y = set(x)
        for _ in range(rng.randint(0, 4)):
            y.discard(rng.choice(universe)), y.add(rng.choice(universe))
        if 100 * len(x & y) >= 90 * len(x | y):
            px, py = (set(sorted(s)[:J.prefix_length(len(s), 90)]) for s in (x, y))
            assert px & py


def test_empty_table(spark):
    assert J.jaccard_report(K.frame(spark, [])).count() == 0
