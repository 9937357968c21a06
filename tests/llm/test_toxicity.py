import random

from assetscan.llm import toxicity as T
from . import cases as K


def corpus(n=400):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        text, toxic, low = K.sentence(rng, rng.randint(20, 120)), i % 6 == 0, i % 5 == 0
        if toxic:
            text += " you utter " + rng.choice(["blockheadish", "blockheads", "blockheaded", "numskull"]) + " go"
        if low:
            text = " ".join(w + "!!" for w in text.split(" "))
        docs.append((i, text))
        if i % 2 == 0 or i > n // 2:
            labels.append((i, 0 if low else 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_filtering(spark):
    docs, labels = corpus()
    edge = [(9000, None), (9001, ""), (9002, "word " * 40000), (None, "fine text"), (3, docs[3][1])]
    frame = K.frame(spark, docs + edge)
    marks = spark.createDataFrame(labels + [(99999, 1, 1), (None, 0, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    got = T.toxicity_scores(frame, marks).collect()
    assert len(got) == len(docs) + len(edge)
    known = {d for d, _, _ in labels}
    unseen = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id not in known]
    wrong = [r for r in unseen if r.rejected != (r.doc_id % 6 == 0)]
    assert len(wrong) <= 0.03 * len(unseen)
    assert all(0 <= r.p_low_quality <= 1 and 0 <= r.p_toxic <= 1 for r in got)
    kept = T.drop_toxic(frame, marks)
    assert kept.schema == frame.schema
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r.doc_id) for r in got if not r.rejected)


def test_later_models_use_out_of_fold_log_odds_of_earlier_ones():
    import numpy as np
    texts = [b"aa bb", b"aa cc", b"dd bb", b"dd cc"] * 40
    y = np.array([[1, 1], [1, 1], [0, 0], [0, 0]] * 40)
    cuts, slots = T.distinct_features(np.frombuffer(b"".join(texts), np.uint8), np.arange(161) * 5)
    chain = T.train_chain(np.repeat(np.arange(160), np.diff(cuts)), slots, y, np.arange(160) % 5, ["a", "b"])
    assert chain.chained[1, 0] > 0 and chain.chained[0].sum() == 0


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not any(r.rejected for r in T.toxicity_scores(K.frame(spark, K.rows(n=4)), none).collect())
    one_sided = spark.createDataFrame([(0, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert not any(r.rejected for r in T.toxicity_scores(K.frame(spark, K.rows(n=4)), one_sided).collect())
    assert T.toxicity_scores(K.frame(spark, []), none).count() == 0


def test_prediction_equals_the_chain_worked_out_text_by_text(spark):
    """Brute force: presence of every selected feature looked up one by one, each category's log-odds summed in order."""
    import numpy as np
    docs, labels = corpus(200)
    frame, marks = K.frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = T.fit(frame, marks)
    got = {r.doc_id: r for r in T.toxicity_scores(frame, marks).collect()}
    for doc_id, text in docs:
        raw = np.frombuffer(text.encode(), np.uint8)
        present = set(T.features(raw, np.array([0, len(raw)]))[1].tolist())
        odds = []
        for c in range(2):
            z = chain.bias[c] + sum(w for slot, w in zip(chain.slots.tolist(), chain.weights[c]) if slot in present)
            z += sum(chain.chained[c, earlier] * odds[earlier] for earlier in range(c))
            odds.append(min(15.0, max(-15.0, z)))
        p = [1 / (1 + np.exp(-z)) for z in odds]
        r = got[doc_id]
        assert abs(r.p_low_quality - p[0]) < 1e-9 and abs(r.p_toxic - p[1]) < 1e-9 and r.rejected == (p[1] >= T.REJECT)


def test_features_by_hand():
    import numpy as np
    from assetscan.llm import common as C
    text = "Ab!! abcde"
    raw = np.frombuffer(text.encode(), np.uint8)
    mask = (1 << T.FEATURE_BITS) - 1
    h = lambda s: int(C.word_hashes(np.frombuffer(s.encode(), np.uint8), np.array([0]), np.array([len(s)]))[0])
    want = {(h("ab") ^ int(C.ODD[0])) & mask, (h("abcde") ^ int(C.ODD[0])) & mask, (h("abcd") ^ int(C.ODD[4])) & mask,
            (h("!!") ^ int(C.ODD[9])) & mask, (h("de") ^ int(C.ODD[9])) & mask}
    assert set(T.features(raw, np.array([0, len(raw)]))[1].tolist()) == want
