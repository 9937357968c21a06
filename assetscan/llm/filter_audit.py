"""Interaction audit of a set of filters by the Hart-Mas-Colell potential.

Each filter marks documents that fail it. A coalition S of filters removes the documents that fail any
filter of S, which is the removal game v(S). Its potential is P(S) = (v(S) + sum over i in S of P(S - i)) / |S|
with P of nothing 0, computed over the coalitions by size; a filter's Shapley value is P(all) - P(all - i).
`|S|! P(S)` is an integer, so the recursion runs in whole numbers, and k! times the Shapley value, the
sum of what the filter removes over all k! orders, is Q(all) - k Q(all - i) with Q(S) = |S|! P(S). What a filter does
at its step of an order is the difference of two coalitions: v(S + i) - v(S) with the filters before it in S.

Everything is DataFrame functions: one pass over the texts gives each row its marks; rows shrink to counts per (part,
marks) before anything is spread out again, so the orders' table costs parts x orders x filters rows.

`identical_to_smaller` (filter E): rows are counted by (text digest, part, marks) with their smallest doc_id
and how many rows have it, map-side, so a text with any number of copies is a few rows per part; these
meet the digest's smallest doc_id. Texts are equal when their SHA-256 and length are.

Defined results. Null text: empty (fails `words < 50`, has no distinct words to compare). Null doc_id: no labels, never
identical to a smaller one and never the smaller one. Null source: part ''. Repeated rows count each; rows that
share a doc_id are not smaller than one another. Repeated labels: 1 if any is 1; null labels: not 1. A label
without a document: ignored. Empty documents: no rows. Extra columns are not read.
"""
from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SPACES = r"[\x20\x09-\x0D]+"
SALTS = 4096


def text_conditions(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions that one text decides; `words` is its array of words."""
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n_words < 50,
        "B": 100 * n_distinct.cast("long") < 65 * n_words.cast("long"),
        "C": 100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _marked(docs: DataFrame) -> DataFrame:
    """One narrow row per document: doc_id, part, digest, mask of the text conditions (A is bit 1, B bit 2, ...)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACES), ""))
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_conditions(F.col("text"), F.col("words")).values())]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask + b
    digest = F.concat(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), F.to_binary(F.hex(F.length("text").cast("long")), F.lit("hex")))
    return rows.select("doc_id", "part", digest.alias("digest"), mask.alias("mask"))


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with good (quality 1) and toxic (toxic 1); equal rows are counted first, rows without an id are spread."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
             .where("doc_id is not null").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
             .withColumn("salt", F.lit(0)))
    counted = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.hash("digest", "part"), F.lit(SALTS))).otherwise(F.lit(0))
    joined = counted.withColumn("salt", spread).join(known, ["doc_id", "salt"], "left")
    no = F.lit(False)
    return joined.select("doc_id", "part", "digest", "mask", "n", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def _counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows per part and set of failed filters; E is the last bit."""
    rows = _with_labels(_marked(docs), labels)
    group = ["digest", "part", "mask", "good", "toxic", "known"]
    texts = C.stage_table(rows.withColumn("known", F.col("doc_id").isNotNull()).groupBy(*group)
                          .agg(F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first")), "audit-texts")
    least = texts.groupBy("digest").agg(F.min("first").alias("least"))
    met = texts.join(least, "digest")
    unique = F.when(~F.col("known"), F.col("n")).when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(F.lit(0))
    both = F.array(F.struct(F.col("mask").alias("mask"), unique.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - unique).alias("n")))
    split = met.select("part", "good", "toxic", F.explode(both).alias("b")).select("part", "good", "toxic", "b.mask", "b.n")
    return split.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                                             F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def scaled_potential(s: int, k: int, value: Column | int, q: Mapping[int, Column | int]) -> Column | int:
    """|S|! P(S) of the coalition with bits `s` from its value and those of the coalitions one filter smaller."""
    total = value * factorial(s.bit_count() - 1)
    for i in range(k):
        if s >> i & 1:
            total = total + q[s ^ (1 << i)]
    return total


def interaction_audit(counts: DataFrame, names: str) -> DataFrame:
    """One row per part, order of the filters and step, from rows per (part, mask): n, good, toxic."""
    k = len(names)
    everything = (1 << k) - 1

    def removed(value: str, s: int) -> Column:
        return F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(value)).otherwise(0))

    games = counts.groupBy("part").agg(F.sum("n").alias("rows"), *[F.array(*[removed(v, s) for s in range(1 << k)]).alias(f"v_{v}") for v in ("n", "good", "toxic")])
    # The recursion, one projection per coalition size: what a size needs are columns of the sizes before it.
    frame = games.select("*", F.lit(0).cast("long").alias("q0"))
    q = {s: F.col(f"q{s}") for s in range(1 << k)}
    for size in range(1, k + 1):
        frame = frame.select("*", *[scaled_potential(s, k, F.col("v_n")[s], q).alias(f"q{s}") for s in range(1 << k) if s.bit_count() == size])
    shapley = F.array(*[q[everything] - k * q[everything ^ (1 << i)] for i in range(k)])
    frame = frame.select("part", "rows", "v_n", "v_good", "v_toxic", shapley.alias("shapley"))
    steps = []
    for order in permutations(range(k)):
        before = 0
        for at, i in enumerate(order):
            steps.append((("".join(names[j] for j in order)), at + 1, i, before))
            before |= 1 << i
    plan = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(i).alias("i"), F.lit(1 << i).alias("own"), F.lit(b).alias("before")) for o, s, i, b in steps])
    out = frame.select("*", F.explode(plan).alias("o")).select("part", "rows", "v_n", "v_good", "v_toxic", "shapley", "o.*")
    own, after = F.col("own"), F.col("before").bitwiseOR(F.col("own"))

    def at(values: str, s: Column) -> Column:
        return F.element_at(F.col(values), s + 1)

    here = at("v_n", after) - at("v_n", F.col("before"))
    return out.select(
        "part", "filter_order", "step",
        (F.col("rows") - at("v_n", after)).alias("kept"),
        here.alias("removed"),
        (at("v_n", own) - here).alias("redundant"),
        (at("v_n", F.lit(everything)) - at("v_n", F.lit(everything) - own)).alias("unique_fails"),
        (at("v_good", after) - at("v_good", F.col("before"))).alias("good_lost"),
        (at("v_toxic", after) - at("v_toxic", F.col("before"))).alias("toxic_lost"),
        F.element_at("shapley", F.col("i") + 1).alias("shapley"))


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters A to E over all documents, by source."""
    return interaction_audit(C.stage_table(_counts(docs, labels), "audit-counts"), "ABCDE")
