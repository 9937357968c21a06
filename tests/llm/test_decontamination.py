import hashlib

from assetscan.llm import decontamination as D
from . import cases as K


def brute(docs, bench):
    windows = {}
    for item, text in bench:
        w = K.words(text, K.ALNUM)
        for x in ([tuple(w)] if 0 < len(w) < 10 else [tuple(w[i:i + 10]) for i in range(len(w) - 9)]):
            windows.setdefault(x, set()).add(item)
    out = []
    for d, text in docs:
        w, hit, items = K.words(text, K.ALNUM), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i:i + n]))
                if found is not None:
                    hit.update(range(i, i + n))
                    items |= found - {None}
        ids = ",".join(sorted(map(str, items)))
        out.append((d, len(w), len(hit), len(items), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_matches_brute_force_with_nulls_repeats_and_short_items(spark):
    docs = K.rows()
    passage = max((t for _, t in docs if t and "\n" in t), key=len).split("\n")[0].split(" ")
    short = [t for _, t in docs if t and 3 <= len(t.split()) < 9]
    bench = [(1, " ".join(passage[5:30])), (2, "!! " + " ".join(passage[12:40]).upper()), (2, "!! " + " ".join(passage[12:40]).upper()),
             (3, None), (4, ""), (5, short[0] if short else "one two"), (6, "one two"), (None, " ".join(passage[30:45])), (7, "zz " * 15)]
    items = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id long, text string, rk string")
    got = D.decontamination_report(K.frame(spark, docs), items).collect()
    assert K.by_row(got) == brute(docs, bench)
    assert any(r.contaminated for r in got)


def test_empty_tables(spark):
    docs, none = K.frame(spark, K.rows(n=3)), K.frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.contaminated for r in D.decontamination_report(docs, items).collect())
    assert D.decontamination_report(none, spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0
