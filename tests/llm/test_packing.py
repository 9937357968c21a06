import zlib

import numpy as np
from tokenizers import Tokenizer

from assetscan.llm import packing as P
from . import cases as K


def test_pieces_rebuild_every_document_without_padding(spark):
    docs = [(i, t) for i, (_, t) in enumerate(K.rows(seed=4, n=50))] + [(900, "a <|endoftext|> b"), (901, "  two  spaces "), (902, "tab\t x\n y"), (902, "tab\t x\n y"),
            (903, "日本語 テキスト ok"), (None, "null id here")]
    got = P.pack_documents(K.frame(spark, docs), block_tokens=20_000).collect()
    tok = Tokenizer.from_file(P.tokenizer_paths()[0])
    want = {}
    for d, t in docs:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want.setdefault(d, []).append(ids)
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.step_group))
    assert pieces.keys() == want.keys()
    for d, copies in want.items():
        ids, total = copies[0], sum(r.length for r in pieces[d])
        assert total == len(ids) * len(copies)
        for r in pieces[d]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        if len(copies) == 1:
            assert [r.start for r in sorted(pieces[d], key=lambda r: r.start)] == np.cumsum([0] + [r.length for r in sorted(pieces[d], key=lambda r: r.start)])[:-1].tolist()
    groups = {}
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _, _ in parts] == np.cumsum([0] + [n for _, n, _ in parts])[:-1].tolist()
        size = sum(n for _, n, _ in parts)
        assert size <= P.WINDOW and size & (size - 1) == 0
        assert len({g for _, _, g in parts}) == 1
        if size == P.WINDOW:
            groups.setdefault(parts[0][2], []).append(size)
    assert groups


def naive(sizes, pieces):
    """The rule stated plainly: scans of one list instead of sorted tiers."""
    pieces, out = sorted(pieces), []

    def tier(n):
        return min(t for t, size in enumerate(sizes) if n <= size)

    def take(gap, upto):
        for t in range(upto, -1, -1):
            fits = [p for p in pieces if tier(p[0]) == t and p[0] <= gap]
            if fits:
                pieces.remove(max(fits))
                return max(fits)
        t = min(tier(p[0]) for p in pieces if tier(p[0]) <= upto)
        n, d, s = min(p for p in pieces if tier(p[0]) == t)
        pieces.remove((n, d, s))
        pieces.append((n - gap, d, s + gap))
        return gap, d, s

    def fill(gap, seq, choose):
        while gap:
            seq.append(take(gap, choose()))
            gap -= seq[-1][0]
        return seq

    for t in range(len(sizes) - 1, -1, -1):
        while True:
            own = [p for p in pieces if tier(p[0]) == t]
            if not own or sum(p[0] for p in pieces if tier(p[0]) <= t) < sizes[t]:
                break
            pieces.remove(max(own))
            below = max(t - 1, 0)
            out.append((sizes[t], fill(sizes[t] - max(own)[0], [max(own)], lambda: below if any(tier(p[0]) <= below for p in pieces) else t)))
        if t:
            for n, d, s in [p for p in pieces if tier(p[0]) == t]:
                pieces.remove((n, d, s))
                pieces += [(min(sizes[t - 1], n - at), d, s + at) for at in range(0, n, sizes[t - 1])]
    size = sizes[0]
    while pieces:
        size //= 2
        while sum(p[0] for p in pieces) >= size:
            out.append((size, fill(size, [], lambda: 0)))
    return out


def test_tiers_equal_the_plain_rule():
    rng = np.random.default_rng(7)
    for sizes in ((4, 8, 16), (256, 512, 1024)):
        for top in (sizes[0], sizes[1], sizes[2] - 1):
            for n in (0, 1, 5, 60, 200):
                pieces = [(int(x), i, 0) for i, x in enumerate(rng.integers(1, top + 1, n))]
                got = P.Tiers(sizes, pieces).pack()
                assert got == naive(sizes, pieces)
                assert all(sum(p[0] for p in seq) == size for size, seq in got)


def test_documents_go_to_the_tier_they_fit_and_long_gaps_take_shorter_ones():
    short, middle, long = [(100, i, 0) for i in range(40)], [(400, 100 + i, 0) for i in range(8)], [(700, 200 + i, 0) for i in range(6)]
    alone = P.Tiers(P.TIERS, short).pack()
    assert {size for size, _ in alone if size >= 256} == {256}
    assert {size for size, _ in P.Tiers(P.TIERS, middle).pack() if size >= 256} >= {512}
    packed = P.Tiers(P.TIERS, short + middle + long).pack()
    assert {1024, 512, 256} <= {size for size, _ in packed}
    windows = [seq for size, seq in packed if size == 1024]
    assert len(windows) == 6 and all(seq[0][0] == 700 and all(n < 512 for n, _, _ in seq[1:]) for seq in windows)


def test_step_groups_balance_tokens_and_cost_over_all_tiers():
    rng = np.random.default_rng(0)
    tokens = rng.choice([256, 512, 1024], 600).tolist()
    cost = [int(t * rng.integers(1, t)) for t in tokens]
    group = P.step_groups(tokens, cost, 64 * 1024)
    sums, costs = np.bincount(group, weights=tokens), np.bincount(group, weights=cost)
    assert len(sums) == round(sum(tokens) / (64 * 1024)) and sums.max() - sums.min() <= 1024
    assert costs.max() - costs.min() <= 0.1 * costs.mean()


def test_empty_table(spark):
    assert P.pack_documents(K.frame(spark, [])).count() == 0
