"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Rows are grouped by equal text. A group that holds more than half a shard of any measure is dealt
into pieces by doc_id; small groups are bundled by hash into cells, so the driver places a bounded
number of units (`cells` plus at most 6 * `n_shards` large groups and their pieces), however many
rows there are. Units go, largest first, to the shard where the dot product of the unit's vector
with the shard's residual capacity is highest. A last pass moves units from the fullest to the
emptiest shard while that evens out the bytes (law `bytes`).

Defined results. Null text: size 1, checksum 0, grouped with other null texts, not with empty ones.
Repeated rows are separate rows of one group. Null doc_id: sorts first. Empty table: no rows.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

N_SHARDS = 16
CELLS = 4096
SLOT_CELLS = 256
MEASURES = ("bytes", "tokens", "rows")


def place(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each unit: largest first, to the highest dot product with what the shards have left."""
    total = vectors.sum(axis=0)
    unit = vectors / np.where(total > 0, total, 1) * n_shards      # a shard's capacity is 1 in every measure
    left = np.ones((n_shards, vectors.shape[1]))
    shard = np.zeros(len(vectors), dtype=np.int64)
    for i in np.lexsort((np.arange(len(unit)), -unit.max(axis=1))):
        fits = (left >= unit[i] - 1e-12).all(axis=1)
        score = left @ unit[i]
        pick = np.argmax(np.where(fits, score, -np.inf)) if fits.any() else np.argmax(left.min(axis=1))
        shard[i] = pick
        left[pick] -= unit[i]
    return _even_out(vectors[:, 0], shard, n_shards)


def _even_out(size: np.ndarray, shard: np.ndarray, n_shards: int, rounds: int = 2000) -> np.ndarray:
    """Move or swap units between the fullest and the emptiest shard while their gap in bytes closes."""
    load = np.bincount(shard, weights=size, minlength=n_shards)
    for _ in range(rounds):
        hi, lo = int(load.argmax()), int(load.argmin())
        gap = load[hi] - load[lo]
        here, there = np.flatnonzero(shard == hi), np.flatnonzero(shard == lo)
        if gap <= 1 or not len(here):
            break
        there_sizes = np.concatenate(([0.0], size[there]))          # 0: a move instead of a swap
        order = np.argsort(there_sizes, kind="stable")
        want = size[here] - gap / 2
        at = np.clip(np.searchsorted(there_sizes[order], want), 0, len(order) - 1)
        near = np.where((at > 0) & (np.abs(there_sizes[order[np.maximum(at - 1, 0)]] - want) < np.abs(there_sizes[order[at]] - want)), at - 1, at)
        off = np.abs(there_sizes[order[near]] - want)
        best = int(off.argmin())
        moved = size[here[best]] - there_sizes[order[near[best]]]
        if not 0 < moved < gap:
            break
        shard[here[best]] = lo
        other = order[near[best]] - 1
        if other >= 0:
            shard[there[other]] = hi
        load[hi] -= moved
        load[lo] += moved
    return shard


def assign_shards(docs: DataFrame, n_shards: int = N_SHARDS, cells: int = CELLS) -> DataFrame:
    """Per row: doc_id, size, tokens, text_crc32, unit, shard, slot."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slim = C.stage_table(d.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1, F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64("text").alias("g")), "sizes")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    groups = slim.groupBy("g", "text_crc32", "size").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("n_tokens"),
                                                       F.count(F.lit(1)).alias("rows"))
    total = slim.agg(*sums).first()
    if not total["rows"]:
        return slim.select("doc_id", "size", "tokens", "text_crc32", F.lit("").alias("unit"),
                           F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    half = 2 * n_shards
    share = F.greatest(F.col("bytes") / total["bytes"], F.col("n_tokens") / max(total["tokens"], 1), F.col("rows") / total["rows"])
    # at most 3 * half groups can hold more than 1 / half of some measure
    large = [(r["g"], r["text_crc32"], r["size"], max(1, min(int(r["rows"]), int(np.ceil(r["share"] * half * 2)))))
             for r in groups.withColumn("share", share).where(F.col("share") > 1.0 / half).collect()]
    big = F.broadcast(C.local_rows(spark, large, "g long, text_crc32 long, size long, pieces int"))
    units = (slim.join(big, ["g", "text_crc32", "size"], "left")
             .withColumn("unit", F.when(F.col("pieces").isNull(), F.concat(F.lit("c"), F.pmod(F.xxhash64("g", "size"), F.lit(cells))))
                         .otherwise(F.concat(F.lit("g"), "g", F.lit("/"), F.pmod(F.xxhash64("doc_id"), F.col("pieces"))))))
    table = units.groupBy("unit").agg(*sums).orderBy("unit").collect()
    shard = place(np.array([[r[m] for m in MEASURES] for r in table], dtype=float), n_shards)
    placed = F.broadcast(C.local_rows(spark, [(r["unit"], int(s)) for r, s in zip(table, shard)], "unit string, shard int"))
    rows = units.join(placed, "unit").withColumn("cell", F.pmod(F.xxhash64("doc_id", "g"), F.lit(SLOT_CELLS)).cast("int"))
    counts = {(r["shard"], r["cell"]): r["count"] for r in rows.groupBy("shard", "cell").count().collect()}
    base, seen = [], dict.fromkeys(range(n_shards), 0)
    for (s, c) in sorted(counts):
        base.append((s, c, seen[s]))
        seen[s] += counts[s, c]
    bases = F.broadcast(C.local_rows(spark, base, "shard int, cell int, base long"))
    from pyspark.sql import Window as W
    order = W.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return (rows.join(bases, ["shard", "cell"])
            .select("doc_id", "size", "tokens", "text_crc32", "unit", "shard",
                    (F.col("base") + F.row_number().over(order) - 1).cast("long").alias("slot")))


def sharding_report(docs: DataFrame) -> DataFrame:
    return assign_shards(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                      F.lit(None).cast("int").alias("grown_shard"), "tokens")
