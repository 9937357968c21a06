"""Quality scores by a sparse rule ensemble.

A text is described by statistics that are plain column expressions (`statistics`). Small regression trees are grown
one after another on what the earlier ones leave unexplained; every path from a root to a node is a rule, a conjunction
of one to `DEPTH` conditions `statistic <= t` or `> t`. The distinct rules are the inputs of a logistic regression with
an L1 penalty, which leaves weights on few of them; the penalty is the strongest of `PENALTIES` whose loss on a fifth of
the sample, set aside, is within `SLACK` of the least. The weighted rules are compiled into one Spark column, so scoring is a scan without
shuffle or Python.

Rules and weights are fitted on a bounded sample of labelled rows: at most `SAMPLE` of each label, the smallest by hash
of doc_id, weighted by the number of labelled rows each stands for, so scores are probabilities at the labels' own
rate. Only the sample's statistics reach the driver. Labels, lang, source and doc_id are no statistics.

Defined results. Null or empty text: every statistic is 0, and scored as such. Labels without a document, null labels
and null ids: not learned from. Repeated labels: the largest; repeated documents of one id in the sample: the smallest statistics. Without both label values the
score is the labels' rate, 0.5 without any. Null doc_id: not held out, never learned from. Repeated rows: equal
results, one each. Empty documents: no rows. Extra columns are not read.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SAMPLE = 4000            # labelled rows of each label
TREES = 60
DEPTH = 3
BINS = 48                # candidate thresholds a statistic
SHRINKAGE = 0.3
LEAST_ROWS = 8           # rows of the sample a rule must hold and leave out
PENALTIES = (0.01, 0.003, 0.001, 0.0003)
SLACK = 1.1              # the strongest penalty within this factor of the least loss is taken
STEPS = 1000
LEAST_WEIGHT = 0.01      # log-odds; rules of less weight are left out
THRESHOLD = 0.3
FOLDS = 5

Rule = tuple[tuple[int, bool, float], ...]     # (statistic, greater, threshold) of each condition


# ---- statistics ------------------------------------------------------------ #
def statistics(text: Column) -> tuple[dict[str, Column], dict[str, Column]]:
    """(columns to compute first, statistics over them) of a text that is never null."""
    first = {
        "s_text": text,
        "s_words": F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""),
        "s_lines": F.array_remove(F.split(text, r"\s*\n\s*"), ""),
        "s_rest": F.regexp_replace(text, r"[\p{Ll}\s]+", ""),      # all but lower-case letters and space
    }
    words, lines, rest = F.col("s_words"), F.col("s_lines"), F.col("s_rest")
    n_chars, n_words, n_lines = F.length("s_text"), F.size(words), F.size(lines)

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part.cast("double") / whole).otherwise(0.0)

    def found(pattern: str) -> Column:
        return F.length(rest) - F.length(F.regexp_replace(rest, pattern, ""))

    same_as_last = F.aggregate(words, F.struct(F.lit(0).alias("n"), F.lit("").alias("w")),
                               lambda a, w: F.struct((a["n"] + F.when(a["w"] == w, 1).otherwise(0)).alias("n"), w.alias("w")), lambda a: a["n"])
    return first, {
        "words": n_words.cast("double"),
        "word_length": share(n_chars, n_words),
        "distinct_words": share(F.size(F.array_distinct(words)), n_words),
        "repeated_words": share(same_as_last, n_words),
        "line_words": share(n_words, n_lines),
        "distinct_lines": share(F.size(F.array_distinct(lines)), n_lines),
        "capitals": share(found(r"\p{Lu}"), n_chars),
        "digits": share(found(r"\p{Nd}"), n_chars),
        "symbols": share(found(r"[^\p{L}\p{Nd}\p{P}]"), n_chars),
        "signs": share(found(r"[#%&*@/\\_]"), n_chars),
        "stops": share(found(r"[.,;:]"), n_chars),
        "marks": share(found(r"[!?]"), n_chars),
        "brackets": share(found(r"[\[\](){}<>\"']"), n_chars),
    }


def with_statistics(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and the statistics of column `text`."""
    first, stats = statistics(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return rows.select(*keep, *[c.alias(k) for k, c in first.items()]).select(*keep, *[c.alias(k) for k, c in stats.items()])


STATISTICS = ["words", "word_length", "distinct_words", "repeated_words", "line_words", "distinct_lines", "capitals",
              "digits", "symbols", "signs", "stops", "marks", "brackets"]


# ---- rules from trees ------------------------------------------------------ #
@dataclass
class RuleEnsemble:
    names: list[str]
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0

    def score(self) -> Column:
        """The probability of label 1 as a column over the statistics' columns."""
        z = F.lit(float(self.bias))
        for rule, weight in zip(self.rules, self.weights):
            held = F.lit(True)
            for stat, greater, t in rule:
                c = F.col(self.names[stat])
                held = held & ((c > F.lit(float(t))) if greater else (c <= F.lit(float(t))))
            z = z + F.when(held, F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.bias + holds(self.rules, x) @ np.array(self.weights, float))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def holds(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    """rows x rules, 1 where the rule holds."""
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for stat, greater, t in rule:
            out[:, j] *= (x[:, stat] > t) if greater else (x[:, stat] <= t)
    return out


def _thresholds(x: np.ndarray) -> list[np.ndarray]:
    """Candidate thresholds of each statistic: midpoints between its quantiles' distinct values."""
    out = []
    for s in range(x.shape[1]):
        values = np.unique(np.quantile(x[:, s], np.linspace(0, 1, BINS + 1), method="nearest"))
        out.append((values[:-1] + values[1:]) / 2)
    return out


def _grow(bins: np.ndarray, cuts: list[np.ndarray], target: np.ndarray, weight: np.ndarray, rows: np.ndarray,
          path: Rule, depth: int, value: np.ndarray, rules: list[Rule]) -> None:
    """Split `rows` where the weighted squared error falls most; every node below the root gives a rule."""
    if path:
        rules.append(path)
    w, wt = weight[rows], weight[rows] * target[rows]
    total = w.sum()
    value[rows] = wt.sum() / total
    if depth == 0 or len(rows) < 2 * LEAST_ROWS:
        return
    best = (1e-9, -1, -1)
    for s, c in enumerate(cuts):
        if not len(c):
            continue
        b, k = bins[rows, s], len(c) + 1
        n, sw, st = (np.cumsum(np.bincount(b, weights=v, minlength=k))[:-1] for v in (np.ones(len(rows)), w, wt))
        ok = (n >= LEAST_ROWS) & (len(rows) - n >= LEAST_ROWS)
        sw_r, st_r = total - sw, wt.sum() - st
        gain = np.where(ok, st ** 2 / np.maximum(sw, 1e-12) + st_r ** 2 / np.maximum(sw_r, 1e-12) - wt.sum() ** 2 / total, 0)
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (gain[at], s, at)
    _, s, at = best
    if s < 0:
        return
    left = bins[rows, s] <= at
    for side, greater in ((rows[left], False), (rows[~left], True)):
        _grow(bins, cuts, target, weight, side, path + ((s, greater, float(cuts[s][at])),), depth - 1, value, rules)


def _simplified(rule: Rule) -> Rule:
    """One condition a statistic and direction: the tightest."""
    tight: dict[tuple[int, bool], float] = {}
    for stat, greater, t in rule:
        key = (stat, greater)
        tight[key] = t if key not in tight else max(t, tight[key]) if greater else min(t, tight[key])
    return tuple(sorted((s, g, t) for (s, g), t in tight.items()))


def tree_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 1) -> list[Rule]:
    """The distinct paths of trees grown one after another, each on half of the rows and statistics."""
    rng = np.random.default_rng(seed)
    cuts = _thresholds(x)
    bins = np.column_stack([np.searchsorted(c, x[:, s], side="left") for s, c in enumerate(cuts)])
    f = np.zeros(len(y))
    rules: list[Rule] = []
    for _ in range(TREES):
        rows = np.flatnonzero(rng.random(len(y)) < 0.5)
        used = rng.random(x.shape[1]) < 0.5
        if len(rows) < 2 * LEAST_ROWS or not used.any():
            continue
        value, own = np.zeros(len(y)), []
        _grow(bins, [c if u else c[:0] for c, u in zip(cuts, used)], y - _sigmoid(f), weight, rows, (), DEPTH, value, own)
        f[rows] += SHRINKAGE * 4 * value[rows]
        rules += own
    rules = list(dict.fromkeys(_simplified(r) for r in rules))
    if not rules:
        return rules
    h = holds(rules, x)
    first: dict[bytes, int] = {}                     # rules that hold for the same rows: the shortest
    for j in sorted(range(len(rules)), key=lambda j: (len(rules[j]), j)):
        n = h[:, j].sum()
        if LEAST_ROWS <= n <= len(y) - LEAST_ROWS:
            first.setdefault(np.packbits(h[:, j].astype(bool)).tobytes(), j)
    return [rules[j] for j in sorted(first.values())]


def lasso_logistic(h: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the weighted log-loss plus `penalty` times the sum of |weight| (accelerated proximal steps)."""
    w = weight / weight.sum()
    rate = np.clip((w * y).sum(), 1e-4, 1 - 1e-4)
    theta, bias = np.zeros(h.shape[1]), float(np.log(rate / (1 - rate)))
    x = np.column_stack((h, np.ones(len(y))))
    step = 4 / max(np.linalg.norm(np.sqrt(w)[:, None] * x, 2) ** 2, 1e-9)
    now = np.append(theta, bias)
    look, t = now.copy(), 1.0
    for _ in range(STEPS):
        moved = look - step * (x.T @ (w * (_sigmoid(x @ look) - y)))
        moved[:-1] = np.sign(moved[:-1]) * np.maximum(np.abs(moved[:-1]) - step * penalty, 0)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, now, t = moved + (t - 1) / after * (moved - now), moved, after
    return now[:-1], float(now[-1])


def fit_rules(x: np.ndarray, y: np.ndarray, weight: np.ndarray, names: list[str], fold: np.ndarray) -> RuleEnsemble:
    """Rules and lasso weights from a sample: statistics, labels 0 or 1, row weights, and folds (fold 0 sets the penalty)."""
    total = weight.sum() if len(y) else 0.0
    rate = (float((weight * y).sum()) + 0.5) / (total + 1)
    flat = RuleEnsemble(names, bias=float(np.log(rate / (1 - rate))))
    if not len(y) or y.min() == y.max():
        return flat
    rules = tree_rules(x, y.astype(float), weight / weight.mean())
    if not rules:
        return flat
    h = holds(rules, x)
    train, test = fold != 0, fold == 0
    penalty = PENALTIES[-1]
    if len(set(y[train])) == 2 and test.any():
        def loss(p: float) -> float:
            theta, bias = lasso_logistic(h[train], y[train], weight[train], p)
            q = np.clip(_sigmoid(h[test] @ theta + bias), 1e-6, 1 - 1e-6)
            return float(-(weight[test] * np.where(y[test] == 1, np.log(q), np.log(1 - q))).sum())
        losses = [loss(p) for p in PENALTIES]
        penalty = next(p for p, v in zip(PENALTIES, losses) if v <= SLACK * min(losses))
    theta, bias = lasso_logistic(h, y, weight, penalty)
    used = np.flatnonzero(np.abs(theta) >= LEAST_WEIGHT)
    return RuleEnsemble(names, [rules[j] for j in used], [float(theta[j]) for j in used], bias)


# ---- Spark side ------------------------------------------------------------ #
def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, y, weight, fold and the statistics of at most `sample` labelled documents of each label."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
             .where("doc_id is not null and y in (0, 1)").where(remainder(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("y").alias("y")))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    known = C.stage_table(known.join(ids, "doc_id", "left_semi"), "rules-labelled")
    rank = F.xxhash64(F.col("doc_id"), F.lit(7))
    picked = None
    for y, n in sorted((r["y"], r["n"]) for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()):
        part = known.where(F.col("y") == y).orderBy(rank, "doc_id").limit(sample).withColumn("weight", F.lit(max(1.0, n / sample)))
        picked = part if picked is None else picked.union(part)
    if picked is None:
        picked = known.withColumn("weight", F.lit(1.0))
    picked = C.stage_table(picked, "rules-sample")                  # at most 2 x sample narrow rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    stats = with_statistics(rows, ["doc_id", "y", "weight"])
    one = stats.groupBy("doc_id", "y", "weight").agg(F.min(F.struct(*STATISTICS)).alias("s"))
    return one.select("doc_id", "y", "weight", F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(FOLDS)).cast("int").alias("fold"), "s.*")


def fit(docs: DataFrame, labels: DataFrame) -> RuleEnsemble:
    rows = training_sample(docs, labels).toArrow().sort_by("doc_id")
    x = np.column_stack([rows[s].to_numpy() for s in STATISTICS]) if rows.num_rows else np.zeros((0, len(STATISTICS)))
    return fit_rules(x, rows["y"].to_numpy(), rows["weight"].to_numpy(), STATISTICS, rows["fold"].to_numpy())


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = with_statistics(rows, ["doc_id"]).select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                                                      model.score().alias("score"))
    return scored.select("*", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
