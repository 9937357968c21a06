"""One-permutation MinHash fingerprints with optimal densification and b-bit packing.

The five-word shingles of a text are hashed once; the hash's high bits choose one of `BINS` bins, which
keeps the smallest value. An empty bin takes the value of the first occupied bin in its own random
probe order (the same for every text). The low eight bits of each bin are stored as hex. The
likeness of two fingerprints is the share of equal bins, corrected for chance agreement of eight bits.

Defined results. Null text: empty. A text with fewer than five words has its whole word sequence as one
shingle; a text without words has an empty fingerprint, like another empty one with 1 and any other with
0. Repeated rows have equal fingerprints; ties in doc_id are broken by the text. Null doc_id sorts first.
Empty table: no rows. A table of one row: its next document is itself.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SHINGLE = 5
BINS = 256
BITS = 8
BUCKETS = 512
FINGERPRINTED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")
# For each bin, the order in which it looks at the others: a fixed random permutation.
_PROBES = np.argsort(C.mix64(np.arange(BINS * BINS, dtype=np.uint64)).reshape(BINS, BINS), axis=1)
_TURN = np.argsort(_PROBES, axis=1).astype(np.int32)  # _TURN[i, j]: when bin i looks at bin j


def _densify(low: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Fill empty bins in place of each row from the occupied bin that comes first in its probe order."""
    row, bin_ = np.nonzero(~held & held.any(axis=1)[:, None])
    values = low.copy()
    for turn in range(BINS):
        if not len(row):
            break
        source = _PROBES[bin_, turn]
        hit = held[row, source]
        values[row[hit], bin_[hit]] = low[row[hit], source[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    return values


def minhash(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(n x BINS low bytes, which texts have shingles)."""
    offs = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    low = C.LOWER[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    starts, ends, doc = C.find_words(low, offs, C.SPACE_SEPARATED)
    wh = C.word_hashes(low, starts, ends)
    n_words = np.bincount(doc, minlength=len(texts))
    h, at = C.ngrams(wh, doc, SHINGLE)
    owner = doc[at]
    for n in range(1, SHINGLE):
        g, p = C.ngrams(wh, doc, n)
        short = n_words[doc[p]] == n
        h, owner = np.concatenate((h, g[short])), np.concatenate((owner, doc[p][short]))
    slot = owner * BINS + (h >> np.uint64(56)).astype(np.int64)
    best = np.full(len(texts) * BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(best, slot, h & np.uint64((1 << 56) - 1))
    held = (best != np.iinfo(np.uint64).max).reshape(-1, BINS)
    return _densify((best & np.uint64(255)).astype(np.uint8).reshape(-1, BINS), held), held.any(axis=1)


def likeness(a: np.ndarray, b: np.ndarray, has_a: np.ndarray, has_b: np.ndarray) -> np.ndarray:
    chance = 1.0 / (1 << BITS)
    same = (a == b).mean(axis=1)
    out = np.clip((same - chance) / (1 - chance), 0.0, 1.0)
    return np.where(has_a & has_b, out, (has_a == has_b).astype(float))


def _groups(texts: list[str]):
    """Successive index ranges of a few MB."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size < C.CHUNK_BYTES // 2):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _fingerprints(rows: list[tuple]) -> pa.RecordBatch:
    """(doc_id, text, next text) -> result rows."""
    own = [t for _, t, _ in rows]
    ed = [edited(t, f) for _, t, f in rows]
    enc = [[x.encode() for x in col] for col in (own, ed, [f for _, _, f in rows])]
    (fp, has), (fe, he), (fn, hn) = (minhash(x) for x in enc)
    near_e, near_n = likeness(fp, fe, has, he), likeness(fp, fn, has, hn)
    text = lambda m, h: [m[i].tobytes().hex() if h[i] else "" for i in range(len(m))]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([len(t) for t in own], pa.int64()),
         pa.array([hashlib.sha256(x).hexdigest() for x in enc[1]]), pa.array(text(fp, has), pa.string()),
         pa.array(text(fe, he), pa.string()), pa.array(near_e, pa.float64()), pa.array(near_n, pa.float64())],
        names=[c.split()[0] for c in FINGERPRINTED.split(", ")])


def _run(batches):
    """Rows of whole buckets, sorted; a bucket's last row is the next bucket's first, marked as a guest."""
    before, rows = None, []
    size = 0
    for b in batches:
        for bucket, doc_id, text, guest in zip(*(b.column(i).to_pylist() for i in range(4))):
            if before is not None and before[0] == bucket:
                rows.append((before[1], before[2], text))
                size += len(before[2])
            before = None if guest else (bucket, doc_id, text)
            if size >= C.CHUNK_BYTES // 4:
                yield _fingerprints(rows)
                rows, size = [], 0
    if rows:
        yield _fingerprints(rows)


def fingerprint_table(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Fingerprint of each text, of its edited text, and the likeness to both neighbours' texts.

    Documents are dealt to ranges of doc_id (bounds from an approximate quantile over all ids); the first
    document of each range is also sent to the range before, so every document meets its next one in one
    shuffle. The bounds and first documents are at most `buckets` rows."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = d.select("doc_id").where(F.col("doc_id").isNotNull())
    cuts = sorted(set(int(x) for x in ids.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 1.0 / (4 * buckets))))
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(_bucket_of("doc_id", cuts))
    d = d.withColumn("bucket", bucket)
    heads = sorted((r["bucket"], r["head"]) for r in d.groupBy("bucket").agg(F.min("doc_id").alias("head")).collect())
    if not heads:
        return d.select(F.col("doc_id"), F.lit(0).cast("long").alias("n_chars"), *[F.lit("").alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                        F.lit(0.0).alias("near_edited"), F.lit(0.0).alias("near_next"))
    order = [b for b, _ in heads]
    before = {b: order[i - 1] for i, b in enumerate(order)}      # the first range's head goes to the last range
    guests = F.broadcast(C.local_rows(spark, [(b, x, before[b]) for b, x in heads], "bucket int, head long, host int"))
    # of equal first ids the smallest text is the guest
    g = (d.join(guests, "bucket").where(F.col("doc_id").eqNullSafe(F.col("head")))
         .groupBy("bucket", "host").agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id")))
    both = (d.select("bucket", "doc_id", "text", F.lit(0).alias("guest"))
            .unionByName(g.select(F.col("host").alias("bucket"), "doc_id", "text", F.lit(1).alias("guest"))))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return (both.repartition(n, "bucket").sortWithinPartitions("bucket", "guest", "doc_id", "text")
            .select("bucket", "doc_id", "text", "guest").mapInArrow(_run, FINGERPRINTED))


def _bucket_of(name: str, cuts: list[int]):
    """Number of cuts at or under the column, as a balanced tree of comparisons."""
    def tree(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(name) < F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return tree(0, len(cuts))
