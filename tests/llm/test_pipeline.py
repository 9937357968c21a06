import random

import corpus_pipeline
from assetscan.llm import pipeline
from . import cases as K
from . import test_jaccard_join as J
from . import test_toxicity as T


def test_every_stage_takes_effect(spark, tmp_path):
    docs, labels = T.corpus(240)
    rng = random.Random(3)
    passage = K.sentence(rng, 40)
    near = J.near_group(n=6)
    docs += near + [(7000, "write to me.now@mail.example.com or call +1 (555) 123-4567 " + K.sentence(rng, 30)), (7001, K.sentence(rng, 10) + " " + passage), (7002, None), (7003, "")]
    K.frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    state, left = frame, []
    for name, stage in pipeline.STAGES[:-1]:
        state = stage(spark, state, str(tmp_path))
        assert state.columns == frame.columns
        state = spark.createDataFrame(state.collect(), frame.schema)
        left.append({r.doc_id for r in state.collect()})
    toxic = {d for d, _ in docs if d < 240 and d % 6 == 0}
    assert len(left[0] & toxic) <= 0.05 * len(toxic) and len(left[0]) >= len(docs) - 1.1 * len(toxic)
    groups = {c for d, _, c in J.brute([x for x in docs if x[0] in left[0]])}
    assert left[1] == groups
    assert left[1] - left[2] == {7001}
    text = {r.doc_id: r for r in state.collect()}
    assert text[7000].text.startswith("write to <email> or call <phone> ") and text[7000].n_chars == len(text[7000].text)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == left[3]
    assert all(r.length <= 1024 for r in packed)


def test_near_duplicate_stage_takes_five_words_and_four_fifths(spark):
    rng = random.Random(11)
    base = K.sentence(rng, 100).split(" ")
    two = ["changed" if i in (30, 70) else w for i, w in enumerate(base)]
    docs = [(1, " ".join(base)), (2, " ".join(two)), (3, K.sentence(rng, 100))] + J.near_group(n=40)
    sets = [J.shingles(t, 5) for _, t in docs]
    assert 0.8 <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.82
    label = list(range(len(docs)))
    for _ in docs:                                            # smallest row reachable over links
        for i, x in enumerate(sets):
            label[i] = min(label[j] for j, y in enumerate(sets) if 5 * len(x & y) >= 4 * len(x | y))
    kept = pipeline.drop_near_duplicates(spark, K.frame(spark, docs), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted({docs[i][0] for i in label})
    assert {1, 3} <= {r.doc_id for r in kept} and 2 not in {r.doc_id for r in kept}


def write(spark, folder, docs, labels, items):
    """A table directory; extra columns have the names that stages use inside."""
    K.frame(spark, docs).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))


def through(spark, folder, upto):
    state = spark.read.parquet(str(folder / "documents.parquet"))
    columns = state.columns
    for _, stage in pipeline.STAGES[:upto]:
        state = stage(spark, state, str(folder))
        assert state.columns == columns
        state = spark.createDataFrame(state.collect(), state.schema)
    return state.collect()


def test_nulls_empty_long_and_repeated_rows_through_all_stages(spark, tmp_path):
    rng = random.Random(9)
    long = K.sentence(rng, 9000)
    fine = [(i, K.sentence(rng, 40)) for i in range(1, 8)]
    docs = fine + [(20, None), (21, ""), (22, " \n "), (None, None), (None, K.sentence(rng, 30)), (30, long), (31, long), fine[0], fine[0], (40, "x" * 200000)]
    write(spark, tmp_path, docs, [(1, 1, 0), (2, None, 1), (None, 0, 1), (99, 0, 1)], [(1, None), (2, ""), (3, "some words that no document has")])
    rows = through(spark, tmp_path, 4)
    assert sorted((r.doc_id for r in rows), key=repr) == sorted([d for d, _ in fine] + [20, 21, 22, None, None, 30, 40], key=repr)
    assert {r.doc_id: r.text for r in rows if r.doc_id in (20, 21, 30)} == {20: None, 21: "", 30: long}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(r.length for r in packed if r.doc_id == 30) == next(r.doc_tokens for r in packed if r.doc_id == 30)
    assert {r.doc_tokens for r in packed if r.doc_id in (20, 21)} == {1}


def test_empty_tables(spark, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    write(spark, tmp_path / "a", [], [], [])
    assert corpus_pipeline.run(spark, str(tmp_path / "a")).count() == 0
    docs = [(i, K.sentence(random.Random(i), 30)) for i in range(5)]
    write(spark, tmp_path / "b", docs, [], [])
    assert sorted(r.doc_id for r in through(spark, tmp_path / "b", 4)) == list(range(5))
