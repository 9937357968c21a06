import zlib

import numpy as np

from assetscan.llm import sharding as S
from . import cases as K


def test_bytes_even_slots_gapless_and_groups_whole(spark):
    docs = K.rows(seed=5, n=600)
    docs = [(d, t) for d, t in docs if len(t or "") < 5000] + [(5000 + i, "hot text " * 40) for i in range(400)]
    got = S.sharding_report(K.frame(spark, docs)).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(((d, size(t), zlib.crc32((t or "").encode())) for d, t in docs), key=repr)
    load = np.bincount([r.shard for r in got], weights=[r.size for r in got], minlength=16)
    assert load.max() - load.min() < 0.01 * load.mean()
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    crc = zlib.crc32(("hot text " * 40).encode())
    homes = {}
    for r in got:
        homes.setdefault(r.text_crc32, set()).add(r.shard)
    assert len(homes[crc]) > 1                            # a third of the rows: dealt over shards
    assert all(len(v) == 1 for k, v in homes.items() if k not in (crc, 0))   # 0: null and empty texts


def test_placement_balances_all_measures():
    rng = np.random.default_rng(0)
    v = np.column_stack((rng.pareto(2, 3000) + 1, rng.pareto(2, 3000) + 1, np.ones(3000)))
    shard = S.place(v.copy(), 8)
    for k in range(3):
        load = np.bincount(shard, weights=v[:, k])
        assert load.max() / load.mean() < 1.05
    load = np.bincount(shard, weights=v[:, 0])
    assert (load.max() - load.min()) / load.mean() < 0.001


def test_empty_table(spark):
    assert S.sharding_report(K.frame(spark, [])).count() == 0
