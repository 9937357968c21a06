"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another; each model sees the text's features and the log-odds of
the categories before it. For training those come from out-of-fold predictions, so a later model learns
from probabilities as uncertain as the ones it meets in use. Features are the presence of hashed words,
word beginnings of 4, 5 and 6 bytes, and token endings; the `SELECTED` most telling ones per category (by
G statistic) get weights. Models are fitted on a bounded sample of labelled rows: at most `SAMPLE` per
combination of labels, the smallest by hash of doc_id. Prediction covers every whole text.

The tables label two categories, low quality and toxicity; the chain is in that order.

Defined results. Null or empty text: no features, the category's base rate. A labelled id without a document, or a
null label or id: ignored. Repeated labels: the largest. Without both label values a category predicts its base
rate and rejects nothing. Repeated rows: equal results. Empty tables: no rows. Extra columns stay as they are.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SAMPLE = 2500
FOLDS = 5
FEATURE_BITS = 22
SELECTED = 2000
STEPS = 150
L2 = 1e-4
REJECT = 0.5
CATEGORIES: dict[str, Column | str] = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature slot) of every occurrence."""
    low = C.LOWER[buf]
    mask = np.uint64((1 << FEATURE_BITS) - 1)
    docs, slots = [], []
    starts, ends, doc = C.find_words(low, offs, C.ALPHANUMERIC)
    for k in (0, 4, 5, 6):
        long = ends - starts > k
        s, d = starts[long], doc[long]
        h = C.word_hashes(low, s, s + k if k else ends[long])
        docs.append(d), slots.append((h ^ C.ODD[k]) & mask)
    starts, ends, doc = C.find_words(buf, offs, C.SPACE_SEPARATED)
    long = ends - starts > 2
    docs.append(doc[long]), slots.append((C.word_hashes(buf, ends[long] - 2, ends[long]) ^ C.ODD[9]) & mask)
    return np.concatenate(docs), np.concatenate(slots).astype(np.int64)


@dataclass
class Chain:
    """Selected slots in ascending order, one weight row per category (slots, then earlier log-odds), biases."""
    names: list[str]
    slots: np.ndarray
    weights: np.ndarray
    chained: np.ndarray
    bias: np.ndarray

    def predict(self, n: int, doc: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """n x categories probabilities, from (text, slot) occurrences."""
        used = np.zeros(1 << FEATURE_BITS, bool)
        used[self.slots] = True
        here = used[slot]
        pair = np.unique(doc[here].astype(np.int64) << FEATURE_BITS | slot[here])
        d, at = pair >> FEATURE_BITS, np.searchsorted(self.slots, pair & ((1 << FEATURE_BITS) - 1))
        z = np.zeros((n, len(self.names)))
        for c in range(len(self.names)):
            z[:, c] = np.bincount(d, weights=self.weights[c][at], minlength=n) + self.bias[c] + z[:, :c] @ self.chained[c, :c]
            z[:, c] = np.clip(z[:, c], -15, 15)
        return _sigmoid(z)


def _sigmoid(z):
    return 1 / (1 + np.exp(-z))


def _fit(row: np.ndarray, at: np.ndarray, extra: np.ndarray, y: np.ndarray, use: np.ndarray, n_slots: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression by Adam on sparse presence and dense extra columns, over the rows in `use`."""
    n = max(1, int(use.sum()))
    rate = (y[use].sum() + 0.5) / (n + 1)
    w, v, b = np.zeros(n_slots), np.zeros(extra.shape[1]), float(np.log(rate / (1 - rate)))
    if y[use].min(initial=1) == y[use].max(initial=0):
        return w, v, b
    balance = np.where(y == 1, 0.5 / max(rate, 1e-3), 0.5 / max(1 - rate, 1e-3)) * use / n
    theta = np.concatenate((w, v, [b]))
    m, s = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        z = np.bincount(row, weights=theta[at], minlength=len(y)) + extra @ theta[n_slots:-1] + theta[-1]
        err = balance * (_sigmoid(np.clip(z, -30, 30)) - y)
        g = np.concatenate((np.bincount(at, weights=err[row], minlength=n_slots), extra.T @ err, [err.sum()]))
        g[:-1] += L2 * theta[:-1]
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        theta -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
    return theta[:n_slots], theta[n_slots:-1], float(theta[-1])


def _select(doc: np.ndarray, slot: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The slots whose presence tells most about y (G statistic of the 2 x 2 table)."""
    pos = np.bincount(slot[y[doc] == 1], minlength=1 << FEATURE_BITS).astype(float)
    tot = np.bincount(slot, minlength=1 << FEATURE_BITS).astype(float)
    seen = np.flatnonzero(tot >= 2)
    if not len(seen) or y.min() == y.max():
        return np.zeros(0, np.int64)
    n, p = len(y), y.sum()
    a, k = pos[seen], tot[seen]
    g = np.zeros(len(seen))
    for obs, exp in ((a, k * p / n), (k - a, k * (n - p) / n), (p - a, (n - k) * p / n), (n - k - p + a, (n - k) * (n - p) / n)):
        g += np.where(obs > 0, obs * np.log(np.maximum(obs, 1e-9) / np.maximum(exp, 1e-9)), 0)
    return seen[np.argsort(-g, kind="stable")[:SELECTED]]


def distinct_features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the texts, slots) with each text's slots distinct."""
    d, s = features(buf, offs)
    pair = np.unique(d.astype(np.int64) << FEATURE_BITS | s)
    return np.searchsorted(pair >> FEATURE_BITS, np.arange(len(offs))), (pair & ((1 << FEATURE_BITS) - 1)).astype(np.int32)


def train_chain(doc: np.ndarray, slot: np.ndarray, labels: np.ndarray, folds: np.ndarray, names: list[str]) -> Chain:
    """Fit the chain on the distinct (text number, slot) pairs; labels is texts x categories of 0 and 1."""
    n, k = len(labels), len(names)
    if not n:
        return Chain(names, np.zeros(0, np.int64), np.zeros((k, 0)), np.zeros((k, k)), np.full(k, -15.0))
    slots = np.unique(np.concatenate([_select(doc, slot, labels[:, c]) for c in range(k)]))
    keep = np.isin(slot, slots)
    row, at = doc[keep], np.searchsorted(slots, slot[keep])
    weights, chained, bias = np.zeros((k, len(slots))), np.zeros((k, k)), np.zeros(k)
    earlier = np.zeros((n, 0))
    for c in range(k):
        y = labels[:, c].astype(float)
        weights[c], chained[c, :c], bias[c] = _fit(row, at, earlier, y, np.ones(n, bool), len(slots))
        if c + 1 < k:                                   # out-of-fold log-odds for the models after this one
            z = np.zeros(n)
            for f in range(FOLDS):
                w, v, b = _fit(row, at, earlier, y, folds != f, len(slots))
                own = np.bincount(row, weights=w[at], minlength=n) + earlier @ v + b
                z[folds == f] = own[folds == f]
            earlier = np.column_stack((earlier, np.clip(z, -15, 15)))
    return Chain(names, slots, weights, chained, bias)


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES) -> Chain:
    """Train on a bounded sample of labelled documents: the features of at most SAMPLE * 2 ** categories texts,
    read on the executors, reach the driver."""
    names = list(categories)
    rank = F.xxhash64(F.col("doc_id"), F.lit(7))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.expr(f"cast({c} as int)").alias(f"y{i}") for i, c in enumerate(categories.values())])
    known = known.dropna().groupBy("doc_id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))])
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    known = C.stage_table(known.join(ids, "doc_id", "left_semi"), "labelled")
    picked = None
    for combo in known.select(*[f"y{i}" for i in range(len(names))]).distinct().collect():
        part = known.where(" and ".join(f"y{i} = {combo[i]}" for i in range(len(names)))).orderBy(rank, "doc_id").limit(SAMPLE)
        picked = part if picked is None else picked.union(part)
    none = np.zeros(0, np.int32)
    if picked is None:
        return train_chain(none, none, np.zeros((0, len(names))), none, names)
    picked = C.stage_table(picked, "sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    sample = (texts.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])
              .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(FOLDS)).cast("int"))
              .withColumn("y", F.array(*[f"y{i}" for i in range(len(names))])).select("doc_id", "text", "fold", "y")
              .mapInArrow(_sample_features, "doc_id long, fold int, y array<int>, slots array<int>").toArrow().sort_by("doc_id").combine_chunks())
    if not sample.num_rows:
        return train_chain(none, none, np.zeros((0, len(names))), none, names)
    slots = sample["slots"].chunk(0)
    offs = slots.offsets.to_numpy() - slots.offsets[0].as_py()
    doc = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))
    y = sample["y"].chunk(0).flatten().to_numpy().reshape(-1, len(names))
    return train_chain(doc, slots.flatten().to_numpy(), y, sample["fold"].to_numpy(), names)


def _sample_features(batches):
    for rows, buf, offs in C.text_chunks(batches):
        cuts, slots = distinct_features(buf, offs)
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), rows.column(3), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(slots))],
                                         names=["doc_id", "fold", "y", "slots"])


def _probabilities(chain: Chain, rows: int, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    d, s = features(buf, offs)
    return chain.predict(rows, d, s)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, a probability per category, rejected."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    names = list(CATEGORIES)

    def run(batches):
        for rows, buf, offs in C.text_chunks(batches):
            p = _probabilities(model.value, rows.num_rows, buf, offs)
            yield pa.RecordBatch.from_arrays([rows.column(0)] + [pa.array(p[:, c]) for c in range(len(names))] + [pa.array(p[:, -1] >= REJECT)],
                                             names=["doc_id", *[f"p_{n}" for n in names], "rejected"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, " + ", ".join(f"p_{n} double" for n in names) + ", rejected boolean")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches):
        for rows, buf, offs in C.text_chunks(batches):
            p = _probabilities(model.value, rows.num_rows, buf, offs)
            yield rows.filter(pa.array(p[:, -1] < REJECT))

    return docs.mapInArrow(run, docs.schema)
