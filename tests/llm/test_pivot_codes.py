import hashlib
import math
import random

import numpy as np

from assetscan.llm import pivot_codes as P

SCHEMA = "vec_id long, embedding array<float>, label int, v string, d int, code int, error string"


def brute(rows):
    """Every distance, in plain integers; rows are (vec_id, components, label)."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    longest = max(len(v) for _, v, _ in kept)
    width = max(16, -(-longest // 16) * 16) // 16
    kept = [(i, [max(-P.BOUND, min(P.BOUND, x)) for x in v] + [0] * (16 * width - len(v)), l) for i, v, l in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[v[p * width:(p + 1) * width] for p in range(16)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:64]] for p in range(16)]

    def assign(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(books[p]))

    for _ in range(2):
        for p in range(16):
            groups = {}
            for c in cut:
                groups.setdefault(assign(p, c[p])[1], []).append(c[p])
            new = list(books[p])
            for e, g in groups.items():
                new[e] = [sum(col) // len(g) for col in zip(*g)]
            books[p] = new
    final = [[assign(p, c[p]) for p in range(16)] for c in cut]
    digest = hashlib.sha256(",".join(str(x) for b in books for y in b for x in y).encode()).hexdigest()
    total = {}
    for (_, _, l), f in zip(kept, final):
        total[l] = total.get(l, 0) + sum(d for d, _ in f)
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), total[l], digest) for (i, _, l), f in zip(kept, final)), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 1, 2, "y") for i, v, l in rows], SCHEMA).repartition(3)


def vectors(n, width, seed=1):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, .2) for _ in range(width)] for _ in range(9)]
    return [(i * 2, [rng.gauss(c, .05) for c in rng.choice(centres)], rng.choice([None, 1, 1, 1, 2])) for i in range(n)]


def report(spark, rows):
    return sorted((tuple(r) for r in P.code_report(frame(spark, rows)).collect()), key=repr)


def test_equals_brute_force_with_edge_rows(spark):
    rows = vectors(150, 64)
    rows += [(1000, None, 1), (1001, [0.1] * 63 + [None], 1), (1002, [0.1] * 63 + [float("nan")], 1), (1003, [float("-inf")] + [0.0] * 63, 2)]
    rows += [rows[3], rows[3], (None, rows[5][1], 1), (None, rows[5][1], 1), (6, rows[9][1], None), (500, [0.0] * 64, 1), (501, [1e30] + [-70000.0] * 63, 7)]
    got = P.code_report(frame(spark, rows))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint", "string", "bigint", "bigint", "string"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_few_equal_and_uneven_vectors(spark):
    for rows in (vectors(5, 64), [(i, [0.5] * 32, 1) for i in range(80)], vectors(30, 20) + [(7, [], 1), (9, [0.3], None)], [(1, [], 3)]):
        assert report(spark, rows) == brute(rows)


def test_empty_tables(spark):
    assert report(spark, []) == [] and report(spark, [(1, None, 1), (2, [None], 2)]) == []


def test_pruning_is_exact_and_spares_most_evaluations():
    rng = np.random.default_rng(4)
    for spread, width in ((40, 4), (3, 4), (1, 2), (400, 16), (1 << 23, 4)):
        entries = rng.integers(-spread, spread + 1, (64, width))
        points = np.concatenate((rng.integers(-spread, spread + 1, (3000, width)), entries))
        pivots = P.choose_pivots(entries)
        at, square, done = P.nearest(points, P.distances(points, pivots), entries, P.distances(pivots, entries))
        exact = ((points[:, None] - entries[None]) ** 2).sum(2)
        assert (at == exact.argmin(1)).all() and (square == exact.min(1)).all()
        if width == 4 and spread > 3:
            assert done < 0.4 * exact.size
