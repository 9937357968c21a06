"""Helpers shared by the operators: stage tables, text chunks, vectorised words, bounded bitmaps.

Texts reach Python as Arrow batches. Everything per byte or per word is a numpy pass over
a chunk of a few MB of UTF-8 bytes (one long text is one chunk, hashed in blocks), so a task's
memory follows the chunk, not the partition.
"""
from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

CHUNK_BYTES = 2 << 20
U64 = np.uint64

# Byte classes. UTF-8 bytes over 0x7F belong to words in both classes.
SPACE_SEPARATED = np.ones(256, dtype=bool)          # [^\x20\x09-\x0D]+
SPACE_SEPARATED[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)            # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


# ---- Spark side ------------------------------------------------------------ #
def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` under the session's shared checkpoint folder and read it back: a lost executor
    does not recompute what came before, and a table used twice is computed once."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that `stage_table` wrote and nothing will read again."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_key() -> Column:
    """64-bit key of a row from doc_id and text; rows with the same key and doc_id are equal rows."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["rk"] == right["rk"])


def keyed(docs: DataFrame) -> DataFrame:
    """Only the columns the operators need: extra columns can't clash with theirs."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).withColumn("rk", row_key())


BITMAP_BITS = 25


def slot_bitmap(df: DataFrame, column: str, bits: int = BITMAP_BITS):
    """Broadcast bitmap of the low `bits` bits of a 64-bit column. Its size is 2**bits / 8 bytes
    (4 MB) whatever the table's; with many values more bits are set and fewer rows are filtered
    out, so it may only pre-filter what an exact join follows."""
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (df.select(slot.alias("s")).groupBy(F.shiftright("s", 15).alias("part"))
            .agg(F.bitmap_construct_agg(F.col("s").bitwiseAND(F.lit(32767))).alias("bits")).collect())
    table = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in rows:
        table[r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return df.sparkSession.sparkContext.broadcast(table)


def in_bitmap(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = values.astype(U64) & U64(len(table) * 8 - 1)
    return (table[slot >> U64(3)] >> (slot & U64(7)).astype(np.uint8)) & 1 == 1


def local_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# ---- Arrow and numpy side -------------------------------------------------- #
def text_chunks(batches, column: str = "text", max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, their UTF-8 bytes, offsets) of at most `max_bytes`, or of one longer text. Null: empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        if col.null_count:
            col = col.fill_null("")
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        offs = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if offs[-1] > offs[0] else np.zeros(0, np.uint8)
        i, n = 0, len(col)
        while i < n:
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + max_bytes, "right")) - 1)
            yield batch.slice(i, j - i), data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            i = j
    release_memory()


def small_batches(batches, rows: int = 1024):
    """The batches in slices of at most `rows` rows, for tasks that make Python objects of what a batch holds: so those are
    bounded whatever the session's batch size. Freed memory is given back at the task's end."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    release_memory()


def release_memory() -> None:
    """Give freed memory back to the system at a task's end: workers live on and serve other operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc only
    if trim is not None:
        trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64's constants)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


ODD = mix64(np.arange(1, 65, dtype=U64)) | U64(1)
_BASE = int(mix64(np.array([1000003], dtype=U64))[0]) | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and _BASE**-i modulo 2**64, kept by the worker."""
    if len(_POWERS.get("up", ())) < n:
        n = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            step = np.full(n, base, dtype=U64)
            step[0] = 1
            _POWERS[name] = np.cumprod(step, dtype=U64)
    return _POWERS["up"], _POWERS["down"]


def find_words(low: np.ndarray, offs: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and text number of every word; words end where a text ends."""
    if not len(low):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = word_bytes[low]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    heads = np.unique(offs[:-1][offs[:-1] < offs[1:]])
    first[heads] = inside[heads]
    last[heads[1:] - 1] = inside[heads[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: differences of prefix sums, in blocks of bounded size."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, "right")))
        a, b = starts[i], ends[j - 1]
        up, down = _powers(int(b - a) + 1)
        sums = np.zeros(b - a + 1, dtype=U64)
        np.cumsum((low[a:b].astype(U64) + U64(1)) * up[:b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix64((sums[e] - sums[s]) * down[s] + (e - s).astype(U64) * ODD[0])
        i = j
    return out


def ngrams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n successive words, and the first word's number; n-grams never cross texts."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    g = np.zeros(m, dtype=U64)
    for j in range(n):
        g += hashes[j:j + m] * ODD[j % 64]
    at = np.flatnonzero(doc[:m] == doc[n - 1:n - 1 + m])
    return mix64(g[at] + U64(n)), at


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def merge_intervals(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals; touching ones merge."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate(([True], s[1:] > e[:-1])))
    return s[new], e[np.concatenate((new[1:] - 1, [len(e) - 1]))]


def filter_by_bitmap(df: DataFrame, column: str, wanted: DataFrame, wanted_column: str) -> DataFrame:
    """Rows of `df` whose 64-bit key may be among the wanted ones; an exact join must follow. It keeps
    most unwanted texts out of that join's shuffle while the wanted keys are few against the bitmap's bits."""
    bitmap = slot_bitmap(wanted, wanted_column)

    def run(batches):
        table = bitmap.value
        for b in batches:
            keys = b.column(b.schema.get_field_index(column)).to_numpy(zero_copy_only=False)
            yield b.filter(pa.array(in_bitmap(table, keys.view(U64))))

    return df.mapInArrow(run, df.schema)


def without_rows(docs: DataFrame, keys: DataFrame, drop: DataFrame) -> DataFrame:
    """`docs` without the rows that `drop` names by (doc_id, rk); `keys` has (doc_id, rk) of all rows. No text of a row
    that a bitmap of the dropped keys rules out, or that is dropped, is shuffled: the few rows that are kept though the
    bitmap has their slot are found among the keys, and only their texts meet that list in a join."""
    drop = stage_table(drop.select("doc_id", "rk"), "drop")
    named = slot_bitmap(drop, "rk")

    def doubtful(batches):
        for b in batches:
            yield b.filter(pa.array(in_bitmap(named.value, b.column(1).to_numpy(zero_copy_only=False).view(U64))))

    maybe = keys.select("doc_id", "rk").mapInArrow(doubtful, "doc_id long, rk long")
    spared = stage_table(maybe.join(drop, same_row(maybe, drop), "left_anti").distinct(), "spared")
    slots = slot_bitmap(spared, "rk")
    keyed_docs = docs.withColumn("_rk", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))

    def ruled_out(batches):
        for b in batches:
            rk = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).view(U64)
            yield pa.RecordBatch.from_arrays(b.columns[:-1], schema=pa.schema(list(b.schema)[:-1])).filter(pa.array(~in_bitmap(named.value, rk)))

    def listed(batches):
        for b in batches:
            rk = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).view(U64)
            yield b.filter(pa.array(in_bitmap(named.value, rk) & in_bitmap(slots.value, rk)))

    sure = keyed_docs.mapInArrow(ruled_out, docs.schema)
    checked = keyed_docs.mapInArrow(listed, keyed_docs.schema)
    s = spared.select(F.col("doc_id").alias("_spared_id"), F.col("rk").alias("_spared_rk"))
    checked = checked.join(s, checked["doc_id"].cast("long").eqNullSafe(s["_spared_id"]) & (checked["_rk"] == s["_spared_rk"]), "left_semi")
    return sure.unionByName(checked.drop("_rk"))


def connected_components(links: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of the undirected links (a, b): label is the smallest node reachable.

    Alternating large-star and small-star steps over the links as tables; each step keeps the links'
    number and moves them to smaller ends. Hot nodes are only reduced by min() and joined, never gathered."""
    edges = stage_table(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    seen = None
    for _ in range(max_rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        moved = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges = stage_table(moved, name)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen is not None and tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label").union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
