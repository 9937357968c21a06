import random
import zlib

import numpy as np

from assetscan.llm import rule_ensemble as R
from . import cases as K


def corpus(n=500):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        text, low = K.sentence(rng, rng.randint(15, 150)), i % 6 == 0
        if low:
            w = text.split(" ")
            text = [" ".join(x for x in w[:20] for _ in range(8)), " ".join(x.upper() + "!!" for x in w), " ".join(x + "##$" for x in w), " | ".join(w)][i // 6 % 4]
        docs.append((i, text))
        labels.append((i, 0 if low else 1))
    return docs, labels


def marks(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    edge = [(9000, None), (9001, ""), (9002, "word " * 30000), (None, "fine text"), (3, docs[3][1])]
    got = R.quality_scores(K.frame(spark, docs + edge), marks(spark, labels + [(99999, 1), (None, 0), (2, None), (4, 7)])).collect()
    assert len(got) == len(docs) + len(edge) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    unseen = [r for r in got if r.held_out and r.doc_id < 500]
    assert sum(r.predicted != int(r.doc_id % 6 != 0) for r in unseen) <= 0.03 * len(unseen)
    empty = {r.score for r in got if r.doc_id in (9000, 9001)}
    assert len(empty) == 1 and len({r.score for r in got if r.doc_id == 3}) == 1


def test_held_out_labels_are_not_learned_from(spark):
    docs, labels = corpus(240)
    wrong = [(d, 1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q) for d, q in labels]
    frame = K.frame(spark, docs)
    one, two = (sorted((r.doc_id, r.score) for r in R.quality_scores(frame, marks(spark, m)).collect()) for m in (labels, wrong))
    assert one == two


def test_compiled_column_equals_the_rules(spark):
    docs, labels = corpus(300)
    rows = R.training_sample(K.frame(spark, docs), marks(spark, labels)).toArrow().sort_by("doc_id")
    x = np.column_stack([rows[s].to_numpy() for s in R.STATISTICS])
    model = R.fit_rules(x, rows["y"].to_numpy(), rows["weight"].to_numpy(), R.STATISTICS, rows["fold"].to_numpy())
    assert 1 <= len(model.rules) < 60 and all(1 <= len(r) <= R.DEPTH for r in model.rules)
    frame = R.with_statistics(K.frame(spark, docs + [(None, None)]), ["doc_id"])
    got = frame.select(*R.STATISTICS, model.score().alias("score")).collect()
    assert np.allclose(model.predict(np.array([r[:-1] for r in got])), [r.score for r in got])


def test_statistics_by_hand(spark):
    text = "Aa aa aa  bb 12!\nx#| É\nx#| É"
    r = R.with_statistics(K.frame(spark, [(1, text), (2, None)]), ["doc_id"]).orderBy("doc_id").collect()
    a, none = r[0].asDict(), r[1].asDict()
    n = len(text)
    assert a["words"] == 9 and abs(a["distinct_words"] - 6 / 9) < 1e-12 and abs(a["repeated_words"] - 1 / 9) < 1e-12
    assert abs(a["capitals"] - 3 / n) < 1e-12 and abs(a["digits"] - 2 / n) < 1e-12 and abs(a["marks"] - 1 / n) < 1e-12
    assert abs(a["distinct_lines"] - 2 / 3) < 1e-12 and a["line_words"] == 3 and abs(a["signs"] - 2 / n) < 1e-12
    assert all(none[s] == 0 for s in R.STATISTICS)


def test_lasso_zeroes_useless_rules_and_is_optimal():
    rng = np.random.default_rng(2)
    h = (rng.random((400, 12)) < 0.5).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(3 * h[:, 0] - 3 * h[:, 1])))).astype(float)
    w = rng.random(400) + 0.5
    theta, bias = R.lasso_logistic(h, y, w, 0.02)
    assert theta[0] > 0.5 and theta[1] < -0.5 and (np.abs(theta[2:]) < 0.1).sum() >= 8

    def objective(t, b):
        z = h @ t + b
        return ((w / w.sum()) * (np.logaddexp(0, z) - y * z)).sum() + 0.02 * np.abs(t).sum()
    best = objective(theta, bias)
    assert all(objective(theta + 1e-2 * rng.standard_normal(12), bias + 1e-2 * rng.standard_normal()) >= best - 1e-7 for _ in range(200))


def test_without_labels_or_documents(spark):
    docs, labels = corpus(30)
    frame = K.frame(spark, docs)
    assert {r.score for r in R.quality_scores(frame, marks(spark, [])).collect()} == {0.5}
    assert all(r.predicted == 1 for r in R.quality_scores(frame, marks(spark, [(d, 1) for d, _ in labels])).collect())
    assert R.quality_scores(K.frame(spark, []), marks(spark, labels)).count() == 0
