import random
import re
from itertools import permutations

from assetscan.llm import filter_audit as FA
from . import cases as K

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """Apply every order step by step, document by document."""
    good, toxic = ({d for d, *marks in labels if d is not None and marks[i] == 1} for i in (0, 1))
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    parts = {}
    for d, t, s in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = set()
        fails |= {"A"} if len(w) < 50 else set()
        fails |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t) else set()
        fails |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        fails |= {"E"} if d is not None and least[t] < d else set()
        parts.setdefault(s or "", []).append((fails, d in good, d in toxic))
    out = []
    for part, rows in parts.items():
        found = []
        for order in permutations("ABCDE"):
            left = list(rows)
            for i, f in enumerate(order):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                redundant = sum(f in r[0] and any(g in r[0] for g in order[:i]) for r in rows)
                unique = sum(r[0] == {f} for r in rows)
                found.append((part, "".join(order), i + 1, len(left), len(gone), redundant, unique, sum(r[1] for r in gone), sum(r[2] for r in gone), f))
        total = {f: sum(r[4] for r in found if r[-1] == f) for f in "ABCDE"}
        out += [(*r[:-1], total[r[-1]]) for r in found]
    return sorted(out)


def corpus(n=160):
    rng = random.Random(3)
    texts = [K.sentence(rng, rng.choice([3, 49, 50, 51, 80])) for _ in range(30)]
    texts += ["", None, "a " * 60, "A B " * 30, "x|y", "ab #1 " + K.sentence(rng, 60), "ABC " + K.sentence(rng, 80), "É \x0b\x1c   x " * 25, K.sentence(rng, 30000)]
    docs = [(i if i % 11 else None, rng.choice(texts), rng.choice(["s1", "s2", "", None, "hot", "hot", "hot"])) for i in range(n)]
    docs += docs[:6] + [(7, docs[7][1], "elsewhere"), (3, "other text", "s1")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, n, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1), (99999, 1, 1)]
    return docs, labels


def frames(spark, docs, labels):
    rows = [(d, t, "xx", s, 1, 1, True, "k") for d, t, s in docs]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mask int, n int, good boolean, part string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_equals_brute_force(spark):
    docs, labels = corpus()
    got = FA.filter_interactions(*frames(spark, docs, labels))
    assert got.columns == COLUMNS
    assert [t for _, t in got.dtypes if t not in ("string", "int")] == ["bigint"] * 7
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, labels)


def test_potential_gives_shapley_values():
    rng = random.Random(1)
    for k in (1, 3, 5):
        game = {s: rng.randint(0, 99) for s in range(1 << k)} | {0: 0}
        q = {0: 0}
        for s in sorted(range(1, 1 << k), key=int.bit_count):
            q[s] = FA.scaled_potential(s, k, game[s], q)
        full = (1 << k) - 1
        for i in range(k):
            direct = sum(game[sum(1 << j for j in o[:o.index(i) + 1])] - game[sum(1 << j for j in o[:o.index(i)])] for o in permutations(range(k)))
            assert q[full] - k * q[full ^ (1 << i)] == direct


def test_empty_tables(spark):
    docs, labels = corpus(40)
    d, m = frames(spark, docs, labels)
    assert FA.filter_interactions(d.limit(0), m).count() == 0
    got = FA.filter_interactions(d, m.limit(0)).collect()
    assert sorted(tuple(r) for r in got) == brute(docs, [])
