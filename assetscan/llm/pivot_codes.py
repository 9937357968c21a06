"""Vector codes with exact integer codebooks, nearest entries found by LAESA pivots.

A vector's components become integers and are cut into `PARTS` equal parts; each part position has a codebook of up
to `ENTRIES` entries, improved in `ROUNDS` rounds of assignment and componentwise floor of the mean. For every position
`PIVOTS` fixed points are chosen among the first entries (the one farthest from their mean, then always the one
farthest from those chosen). The distances from each part to its pivots are computed once and kept in a table beside the
integers. A round only computes pivot-entry distances; by the triangle inequality |d(part, pivot) - d(pivot, entry)|, the
largest over the pivots, is a lower bound of the distance. Entries are tried in the order of their bounds, and a
part stops when the next bound is over its best exact squared distance, which is evaluated in integers. Bounds are
lowered by more than their rounding error, so no nearest entry is lost and ties go to the lower index.

Spark reads, filters and adds up; tasks keep one Arrow batch, and sums of 64 entries. The driver sees the first entries
and the summed codebooks (64 x the vector's length), never rows.

Defined results. Null vectors and vectors with null or non-finite components: dropped. A null vec_id is kept and
comes last among the ids; rows with equal ids are ordered by their integers and all count (repeated rows too). Fewer than 64 vectors: as many
entries. Vectors shorter than the table's longest, and lengths that are no multiple of 16, count as followed by
zeros. Integers beyond +-2**24 (components beyond +-65536) are set to that bound, so that every sum is exact in 64 bits. Null
labels are one label. An empty table, or none kept: no rows. Extra columns are not read.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

PARTS = 16
ENTRIES = 64
ROUNDS = 2
PIVOTS = 3
SCALE = 256
BOUND = 1 << 24
MARGIN = np.float32(4e-6)     # of the two distances of a bound: over fifty roundings of 32-bit floats
SALTS = 16


# ---- one part position ------------------------------------------------------ #
def choose_pivots(entries: np.ndarray) -> np.ndarray:
    """`PIVOTS` rows of `entries`, far from one another."""
    far = ((entries - entries.mean(axis=0)) ** 2).sum(axis=1)
    picked = [int(far.argmax())]
    least = ((entries - entries[picked[0]]) ** 2).sum(axis=1)
    while len(picked) < min(PIVOTS, len(entries)):
        picked.append(int(least.argmax()))
        least = np.minimum(least, ((entries - entries[picked[-1]]) ** 2).sum(axis=1))
    return entries[picked]


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """points x pivots Euclidean distances as 32-bit floats, from exact squares."""
    return np.sqrt(((points[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2).astype(np.float64)).astype(np.float32)


def nearest(points: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivot_entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, its squared distance, number of exact evaluations) of every point.

    `to_pivots` is points x pivots, `pivot_entry` pivots x entries."""
    lower = np.zeros((len(points), len(entries)), np.float32)
    for p in range(len(pivot_entry)):
        d, e = to_pivots[:, p, None], pivot_entry[p][None, :]
        np.maximum(lower, np.abs(d - e) - MARGIN * (d + e), out=lower)
    order = np.argsort(lower, axis=1).astype(np.int16)
    best = np.full(len(points), np.iinfo(np.int64).max)
    at = np.full(len(points), len(entries))
    left, done = np.arange(len(points)), 0
    for k in range(len(entries)):
        e = order[left, k].astype(np.int64)
        bound = lower[left, e].astype(np.float64)
        open_ = bound * bound <= best[left]
        left, e = left[open_], e[open_]
        if not len(left):
            break
        done += len(left)
        square = ((points[left] - entries[e]) ** 2).sum(axis=1)
        better = (square < best[left]) | ((square == best[left]) & (e < at[left]))
        best[left[better]], at[left[better]] = square[better], e[better]
    return at, best, done


# ---- Spark side ------------------------------------------------------------ #
def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, v: the kept vectors as integers, all as long as the longest, rounded up to a multiple of `PARTS`."""
    x = F.col("x")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.where(x.isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    longest = rows.agg(F.max(F.size("x"))).first()[0] or 0
    width = max(PARTS, -(-longest // PARTS) * PARTS)
    whole = F.transform("x", lambda c: F.greatest(F.least(F.floor(F.greatest(F.least(c, F.lit(1e9)), F.lit(-1e9)) * SCALE), F.lit(BOUND)), F.lit(-BOUND)).cast("int"))
    return rows.select("vec_id", "label", F.concat(whole, F.array_repeat(F.lit(0), width - F.size("x"))).alias("v"))


def _matrix(batch: pa.RecordBatch, column: str, dtype) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1).astype(dtype)


def _with_pivot_distances(rows: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(pivots)        # PARTS x PIVOTS points

    def run(batches):
        for b in batches:
            if b.num_rows:
                v = _matrix(b, "v", np.int64).reshape(b.num_rows, PARTS, -1)
                d = np.concatenate([distances(v[:, p], shared.value[p]) for p in range(PARTS)], axis=1)
                cuts = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * d.shape[1])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(cuts, pa.array(d.ravel()))], names=["vec_id", "label", "v", "d"])

    return rows.mapInArrow(run, f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, v array<int>, d array<float>")


def _assigned(batch: pa.RecordBatch, books: list[np.ndarray], pivots: list[np.ndarray]):
    """The batch's parts, and (rows x PARTS) entry numbers and squared distances."""
    v = _matrix(batch, "v", np.int64).reshape(batch.num_rows, PARTS, -1)
    d = _matrix(batch, "d", np.float32).reshape(batch.num_rows, PARTS, -1)
    at, square = np.zeros((batch.num_rows, PARTS), np.int64), np.zeros((batch.num_rows, PARTS), np.int64)
    for p in range(PARTS):
        at[:, p], square[:, p], _ = nearest(v[:, p], d[:, p], books[p], distances(pivots[p], books[p]))
    return v, at, square


def _improved(rows: DataFrame, books: list[np.ndarray], pivots: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: floors of means, unused entries unchanged."""
    shared = rows.sparkSession.sparkContext.broadcast((books, pivots))
    m, w = books[0].shape

    def run(batches):
        sums, counts = np.zeros((PARTS, m, w), np.int64), np.zeros((PARTS, m), np.int64)
        for b in batches:
            if b.num_rows:
                v, at, _ = _assigned(b, *shared.value)
                for p in range(PARTS):
                    counts[p] += np.bincount(at[:, p], minlength=m)
                    np.add.at(sums[p], at[:, p], v[:, p])
        p, e, i = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, sums.shape))
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(i.astype(np.int32)),
                                          pa.array(sums[p, e, i]), pa.array(counts[p, e])], names=["p", "e", "i", "total", "n"])

    summed = (rows.select("v", "d").mapInArrow(run, "p int, e int, i int, total long, n long")
              .groupBy("p", "e", "i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow())
    new = [b.copy() for b in books]
    for p, e, i, total, n in zip(*(summed[c].to_pylist() for c in ("p", "e", "i", "total", "n"))):
        new[p][e, i] = total // n
    return new


def codebooks_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error of every kept vector; the final codebooks)."""
    spark = vectors.sparkSession
    rows = integer_vectors(vectors)
    label_type = rows.schema["label"].dataType.simpleString()
    first = np.array([r["v"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()], dtype=np.int64)
    schema = f"vec_id long, label {label_type}, code string, error long"
    if not len(first):
        return spark.createDataFrame([], schema), []
    books = [np.ascontiguousarray(b) for b in first.reshape(len(first), PARTS, -1).transpose(1, 0, 2)]
    pivots = [choose_pivots(b) for b in books]
    rows = C.stage_table(_with_pivot_distances(rows, pivots), "codes-vectors")
    for _ in range(rounds):
        books = _improved(rows, books, pivots)
    shared = spark.sparkContext.broadcast((books, pivots))

    def run(batches):
        for b in batches:
            if b.num_rows:
                _, at, square = _assigned(b, *shared.value)
                text = at.astype(np.uint8).tobytes().hex()
                codes = [text[i:i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes, pa.string()), pa.array(square.sum(axis=1))],
                                                 names=["vec_id", "label", "code", "error"])

    return C.stage_table(rows.mapInArrow(run, schema), "codes"), books


def code_report(vectors: DataFrame) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error, codebooks_sha256. A label's rows are dealt over `SALTS` keys."""
    codes, books = encode_vectors(vectors)
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = totals.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("to"))
    dealt = codes.withColumn("salt", F.pmod(F.hash("vec_id", "code"), F.lit(SALTS)))
    met = dealt.join(totals, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("to")))
    return met.select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
