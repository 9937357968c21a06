"""Repeated byte strings by bucket-pointer refinement over the suffixes of all texts.

Every suffix has a bucket identifier for its first q bytes. Identifiers start with q = 8 (the bytes
themselves) and are refined by pairing a suffix's identifier with that of the suffix q later, so each
refinement reuses the last one: 8, 16, 32, 64, then 72 = (64, 8 at +64), 128 = (64, 64 at +64) and 200 = (128, 72 at
+128). Two suffixes are in one bucket of depth 200 if they share their first 200 bytes. A bucket's identifier is a 64-bit
mix of the pair, compared together with the identifier of an enclosing bucket (128 bits in all).

Not all suffixes are moved. Of the depth-72 buckets only those of sampled offsets go through a shuffle: in each
window of 200 - 72 + 1 offsets the one with the smallest identifier, so that equal 200-byte strings sample the same
bucket at the same place. Offsets alone in their bucket are settled. Of the others, a run of
windows that has the same sample is compared as a whole first (the identifier of the run's span); only runs with a
shared bucket and a span of their own (the borders of repeats) are refined: in blocks of 16 suffixes by the bytes that
the block shares, then suffix by suffix to depth 200. Buckets are counted with map-side sums and joined, never
gathered, so hot strings spread over tasks.

Defined results. Null text: empty. Texts under 200 bytes keep all bytes. Repeated rows repeat each other. Null
doc_id is carried. Empty table: no rows.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

LENGTH = 200
SAMPLED = 72
WINDOWS = LENGTH - SAMPLED + 1
CHUNK = 2 << 20
U = np.uint64


def _pair(x: np.ndarray, y: np.ndarray, level: int) -> np.ndarray:
    """Identifier of the bucket that the pair (x, y) refines to."""
    z = x * C.ODD[level]
    z ^= z >> U(29)
    z += y
    z *= C.ODD[level + 1]
    z ^= z >> U(32)
    z *= C.ODD[level + 2]
    z ^= z >> U(29)
    return z


def bucket_ids(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket identifiers of every offset at depths 64 and 72, as far as the bytes go."""
    ids = np.ndarray((max(len(data) - 7, 0),), dtype="<u8", buffer=np.ascontiguousarray(data), strides=(1,)).astype(U)
    eight, q = ids, 8
    while q < 64:
        ids = _pair(ids[:-q], ids[q:], q.bit_length())
        q *= 2
    return ids, _pair(ids[:len(data) - SAMPLED + 1], eight[64:], 20)


def depth_200(id64: np.ndarray, id72: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Identifiers of the suffixes at `at` refined to their first 200 bytes."""
    return _pair(_pair(id64[at], id64[at + 64], 7), id72[at + 128], 24)


def sampled_offsets(ids: np.ndarray) -> np.ndarray:
    """For each window of WINDOWS offsets the one with the smallest identifier, the rightmost of equal ones."""
    value, index, width = ids, np.arange(len(ids), dtype=np.int32), 1

    def wider(shift):
        right = value[shift:] <= value[:-shift]
        return np.minimum(value[:-shift], value[shift:]), np.where(right, index[shift:], index[:-shift])

    while width * 2 <= WINDOWS:
        value, index = wider(width)
        width *= 2
    if width < WINDOWS:
        value, index = wider(WINDOWS - width)
    return index


def _pieces(batches):
    """(row numbers' batch, bytes, offsets of texts, byte at which each text's part begins); texts over
    CHUNK are cut into parts that overlap by LENGTH - 1 bytes, so each window lies in one part."""
    for rows, buf, offs in C.text_chunks(batches, max_bytes=CHUNK):
        if rows.num_rows > 1 or len(buf) <= 2 * CHUNK:
            yield rows, buf, offs, 0
            continue
        for a in range(0, len(buf) - LENGTH + 1, CHUNK):
            part = buf[a:a + CHUNK + LENGTH - 1]
            yield rows, part, np.array([0, len(part)]), a


def _runs(batches):
    """Runs of windows with one sampled offset: its bucket, the span's identifier, row, first window, windows,
    the sampled offset's distance from the first window, and that the run itself is to be settled."""
    for rows, buf, offs, base in _pieces(batches):
        n = len(buf) - LENGTH + 1
        if n <= 0:
            continue
        id64, id72 = bucket_ids(buf)
        index = sampled_offsets(id72)[:n]
        ends = np.repeat(offs[1:], np.diff(offs))[:n]
        whole = np.arange(n) + LENGTH <= ends
        new = whole.copy()
        new[1:] &= ~((index[1:] == index[:-1]) & whole[:-1])
        heads = offs[:-1][offs[:-1] < n]
        new[heads] = whole[heads]
        first = np.flatnonzero(new)
        last = whole.copy()
        last[:-1] &= new[1:] | ~whole[1:]
        last = np.flatnonzero(last)
        m = last - first + 1
        doc = np.searchsorted(offs, first, side="right") - 1
        span = C.mix64(_pair(depth_200(id64, id72, first), depth_200(id64, id72, last), 28) + m.astype(U))
        rk = rows.column(rows.schema.get_field_index("rk")).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(C.signed(id72[index[first]])), pa.array(C.signed(span)), pa.array(rk[doc]), pa.array(first - offs[doc] + base),
             pa.array(m.astype(np.int32)), pa.array((index[first] - first).astype(np.int32)), pa.array(np.ones(len(m), bool))],
            names=["key", "span", "rk", "s", "m", "d", "single"])


def _parts(size: int):
    """Border runs with their texts -> the same windows in blocks of `size`, aligned to the sampled offset.

    A block's key is the identifier of the bytes that all windows of the (unclipped) block share; its span
    that of all bytes of the windows it has here. For size 1 both are the window's depth-200 bucket."""

    def run(batches):
        for b in batches:
            out = []
            for rk, text, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                for r in runs:
                    s, m, d = r["s"], r["m"], r["d"]
                    id64, id72 = bucket_ids(data[s:s + m - 1 + LENGTH])
                    back = d - np.arange(m)                       # sampled offset minus window
                    block = back // size
                    first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
                    last = np.concatenate((first[1:] - 1, [m - 1]))
                    span = C.mix64(_pair(depth_200(id64, id72, first), depth_200(id64, id72, last), 28) + (last - first + 1).astype(U))
                    if size == 1:
                        core = span
                    else:                                          # bytes from the block's last window to its first one's end
                        head = d - block[first] * size
                        core = C.mix64(_pair(id64[head] + C.ODD[40], id64[head + LENGTH - size - 63], 31)
                                       ^ _pair(id64[head + 64], id72[np.minimum(head + LENGTH - size - 71, len(id72) - 1)], 34))
                    n = len(first)
                    out.append((C.signed(C.mix64(core ^ (block[first] + 1).astype(U) * C.ODD[41] ^ U(r["key"] & (2 ** 64 - 1)))), C.signed(span), np.full(n, rk, np.int64),
                                s + first, (last - first + 1).astype(np.int32), back[first].astype(np.int32), np.full(n, r["single"])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)],
                                                 names=["key", "span", "rk", "s", "m", "d", "single"])

    return run


def _refine(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """One refinement: (windows settled as repeated, borders to refine further).

    Rows alone in their bucket are settled as unique. Of the rest, rows whose whole span occurs again are repeated in full.
    Buckets that hold a row with a span of its own go on, with one row for each distinct span."""
    shared = C.stage_table(rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), f"{name}-shared")
    rows = C.stage_table(C.filter_by_bitmap(rows, "key", shared, "key").join(shared, "key"), f"{name}-rows")
    spans = C.stage_table(rows.groupBy("key", "span").agg(F.count(F.lit(1)).alias("c"), F.max("single").alias("single"),
                                                          F.min(F.struct("rk", "s", "m", "d")).alias("at"))
                          .select("key", "span", "c", "single", "at.*"), f"{name}-spans")
    whole = rows.where("single").join(spans.where("c > 1").select("key", "span"), ["key", "span"]).select("rk", "s", "m")
    own = spans.where("c = 1 and single").select("key").distinct()
    border = spans.join(own, "key", "left_semi").select("key", "rk", "s", "m", "d", (F.col("single") & (F.col("c") == 1)).alias("single"))
    return whole, border


PARTS = "key long, span long, rk long, s long, m int, d int, single boolean"
BLOCKS = (16, 1)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(rk, s, m): the 200-byte strings at bytes s to s + m - 1 of the row's text also start elsewhere."""
    keyed = C.keyed(docs)
    runs = C.stage_table(keyed.select("rk", "text").mapInArrow(_runs, PARTS), "runs")
    found, border = _refine(runs, "runs")
    texts = None
    for size in BLOCKS:
        by_text = C.stage_table(border.groupBy("rk").agg(F.collect_list(F.struct("key", "s", "m", "d", "single")).alias("runs")), "border")
        if texts is None:                                  # later borders lie in the texts of the first ones
            # one text for all rows that are equal in doc_id and text: their windows are the same
            texts = C.stage_table(C.filter_by_bitmap(keyed.select("rk", "text"), "rk", by_text, "rk")
                                  .join(by_text.select("rk"), "rk").dropDuplicates(["rk"]), "border-texts")
        parts = C.stage_table(texts.join(by_text, "rk").select("rk", "text", "runs").mapInArrow(_parts(size), PARTS), f"parts{size}")
        whole, border = _refine(parts, f"parts{size}")
        found = found.union(whole)
    return found


def _cut(batches):
    """Texts with repeated windows -> sizes, runs and checksum of what stays."""
    for b in batches:
        out = []
        for doc_id, text, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
            data = (text.as_py() or "").encode()
            s = np.array([r["s"] for r in runs], np.int64)
            a, z = C.merge_intervals(s, s + np.array([r["m"] for r in runs], np.int64) - 1 + LENGTH)
            kept, at = hashlib.sha256(), 0
            for x, y in zip(a.tolist(), z.tolist()):
                kept.update(data[at:x])
                at = y
            kept.update(data[at:])
            out.append((doc_id, len(data), int((z - a).sum()), len(a), kept.hexdigest()))
        cols = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.string()])],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256. The texts of documents without
    repeats are not shuffled."""
    keyed = C.keyed(docs)
    # a set: copies of a row find the same windows, and a text's list is as long as its own windows
    hits = C.stage_table(repeated_windows(docs).groupBy("rk").agg(F.collect_set(F.struct("s", "m")).alias("runs")), "repeats")
    cut = (C.filter_by_bitmap(keyed, "rk", hits, "rk").join(hits, "rk").select("doc_id", "text", "runs")
           .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
    text = F.coalesce("text", F.lit(""))
    rest = keyed.select("doc_id", "rk", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("kept_sha256"))
    rest = rest.join(hits.select("rk"), "rk", "left_anti").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), "kept_sha256")
    return cut.union(rest)
