"""Benchmark decontamination by winnowing.

Of the k-word hashes in each sliding window of `window - k + 1` of them the smallest is kept
as a fingerprint, for texts and benchmark items alike, so a shared span of `window` words has a
fingerprint in common. Fingerprints are joined, and each hit is extended word by word over the
words around it; a run of at least `window` equal words counts. An item shorter than a window
is matched whole, by the hash of all its words.

Defined results. Null text: no words. Null item text or item without words: never matches. Items
with a null id hit words but are not listed. Repeated documents or items: each row has the same
result. Empty tables: every document clean. Extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

K = 4
WINDOW = 10
FINGERPRINTS = "array<struct<kind:int,hash:long,pos:int,around:string>>"


def _kept(g: np.ndarray, at: np.ndarray, doc: np.ndarray, ask: np.ndarray, window: int) -> np.ndarray:
    """Which of the k-grams numbered `ask` are the smallest of some full window of k-grams. Ties:
    all of them are kept, which keeps a superset of the rightmost ones."""
    span = window - K + 1
    if not len(ask):
        return np.zeros(0, bool)
    full = np.full(len(doc), np.iinfo(np.uint64).max, dtype=np.uint64)
    full[at] = g
    p = at[ask]
    near = p[:, None] + np.arange(-(span - 1), span)[None, :]
    ok = (near >= 0) & (near < len(doc))
    near = np.where(ok, near, 0)
    values = full[near]
    keep = np.zeros(len(p), bool)
    last = near + (window - 1)
    whole = ok & (last < len(doc))
    whole &= doc[np.where(whole, last, 0)] == doc[p][:, None]
    whole &= doc[near] == doc[p][:, None]
    for j in range(span):  # the window of k-grams that starts j - span + 1 from p
        keep |= whole[:, j] & (g[ask] == values[:, j:j + span].min(axis=1))
    return keep


def _scan(id_name: str, lengths: tuple[int, ...], bitmap, window: int, items: bool):
    """Rows with their number of words and fingerprints. Texts keep only fingerprints in the bitmap."""

    def run(batches):
        table = bitmap.value if bitmap is not None else None
        for rows, buf, offs in C.text_chunks(batches):
            low = C.LOWER[buf]
            starts, ends, doc = C.find_words(low, offs, C.ALPHANUMERIC)
            wh = C.word_hashes(low, starts, ends)
            n_words = np.bincount(doc, minlength=rows.num_rows)
            first = np.concatenate(([0], np.cumsum(n_words)))
            found = []
            g, at = C.ngrams(wh, doc, K)
            ask = np.flatnonzero(C.in_bitmap(table, g)) if table is not None else np.arange(len(g))
            ask = ask[_kept(g, at, doc, ask, window)]
            found.append((np.full(len(ask), window), g[ask], at[ask]))
            for n in (range(1, window) if items else lengths):
                h, p = C.ngrams(wh, doc, n)
                if items:
                    sel = np.flatnonzero(n_words[doc[p]] == n)
                else:
                    sel = np.flatnonzero(C.in_bitmap(table, h))
                found.append((np.full(len(sel), n), h[sel], p[sel]))
            kind, h, p = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((p, doc[p])) if len(p) else np.zeros(0, np.int64)
            kind, h, p = kind[order], h[order], p[order]
            raw = low.tobytes()
            around = []
            for n, q in zip(kind.tolist(), p.tolist()):
                a, b = (q - (window - K), q + window) if n == window else (q, q + n)
                lo, hi = first[doc[q]], first[doc[q] + 1]
                around.append("\n".join(raw[starts[x]:ends[x]].decode() if lo <= x < hi else "" for x in range(a, b)))
            cuts = np.searchsorted(doc[p], np.arange(rows.num_rows + 1)) if len(p) else np.zeros(rows.num_rows + 1)
            inner = pa.StructArray.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(C.signed(h), pa.int64()),
                 pa.array((p - first[doc[p]]) if len(p) else p, pa.int32()), pa.array(around, pa.string())],
                names=["kind", "hash", "pos", "around"])
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index(id_name)), rows.column(rows.schema.get_field_index("rk")),
                 pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), inner)],
                names=[id_name, "rk", "n_words", "fps"])

    return run


def _extend(window: int):
    """Joined fingerprints -> runs of at least `window` equal words (short items: equal texts)."""

    def run(batches):
        for b in batches:
            kinds, pos, text, item = (b.column(n).to_pylist() for n in ("kind", "pos", "around", "item_around"))
            keep, lo, hi = [], [], []
            for i, (n, p, t, s) in enumerate(zip(kinds, pos, text, item)):
                if n < window:
                    if t == s:
                        keep.append(i), lo.append(p), hi.append(p + n)
                    continue
                x, y = t.split("\n"), s.split("\n")
                c = window - K
                if x[c:c + K] != y[c:c + K]:
                    continue
                a, z = c, c + K
                while a > 0 and x[a - 1] and x[a - 1] == y[a - 1]:
                    a -= 1
                while z < len(x) and x[z] and x[z] == y[z]:
                    z += 1
                if z - a >= window:
                    keep.append(i), lo.append(p + a - c), hi.append(p + z - c)
            out = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [out.column(n) for n in ("doc_id", "rk", "kind", "hash", "item_around")]
                + [pa.array(lo, pa.int64()), pa.array(hi, pa.int64())],
                names=["doc_id", "rk", "kind", "hash", "item_around", "a", "b"])

    return run


def winnow_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with n_words, hit runs per document, (document, item) pairs)."""
    items = benchmark.select(F.col("item_id").alias("item_id"), F.col("text").cast("string").alias("text"),
                             F.lit(0).cast("long").alias("rk"))
    item_type = items.schema["item_id"].dataType.simpleString()
    items = (items.mapInArrow(_scan("item_id", (), None, window, True), f"item_id {item_type}, rk long, n_words long, fps {FINGERPRINTS}")
             .select("item_id", F.explode("fps").alias("f"))
             .select("item_id", "f.kind", "f.hash", F.col("f.around").alias("item_around")))
    items = C.stage_table(items, "items")
    lengths = tuple(sorted(r["kind"] for r in items.select("kind").distinct().collect() if r["kind"] < window))  # at most 9
    bitmap = C.slot_bitmap(items, "hash")
    scanned = C.stage_table(
        C.keyed(docs).mapInArrow(_scan("doc_id", lengths, bitmap, window, False),
                                 f"doc_id long, rk long, n_words long, fps {FINGERPRINTS}"), "winnowed")
    prints = (scanned.where(F.size("fps") > 0).select("doc_id", "rk", F.explode("fps").alias("f"))
              .select("doc_id", "rk", "f.*"))
    contexts = items.select("kind", "hash", "item_around").distinct()
    runs = C.stage_table(
        prints.join(contexts, ["kind", "hash"]).select("doc_id", "rk", "kind", "hash", "pos", "around", "item_around")
        .mapInArrow(_extend(window), "doc_id long, rk long, kind int, hash long, item_around string, a long, b long"), "runs")
    pairs = (runs.select("doc_id", "rk", "kind", "hash", "item_around").distinct()
             .join(items.where(F.col("item_id").isNotNull()), ["kind", "hash", "item_around"])
             .select("doc_id", "rk", F.col("item_id").cast("string").alias("item")).distinct())
    return scanned, runs, pairs


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, rk, n_words, n_hit (words in a hit run), items (sorted ids), spans (merged
    word intervals). One document's runs and items meet in its row; they are bounded by its text and the benchmark."""
    scanned, runs, pairs = winnow_hits(docs, benchmark, window)
    cover = "aggregate(runs, named_struct('n', 0L, 'e', 0L), (x, r) -> named_struct('n', x.n + greatest(0L, r.b - greatest(r.a, x.e)), 'e', greatest(x.e, r.b)), x -> x.n)"
    hit = (runs.groupBy("doc_id", "rk").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("runs"))
           .withColumn("n_hit", F.expr(cover)))
    items = pairs.groupBy("doc_id", "rk").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = scanned.select("doc_id", "rk", "n_words")
    out = out.join(hit, C.same_row(out, hit), "left").select(out["*"], hit["runs"], hit["n_hit"])
    out = out.join(items, C.same_row(out, items), "left").select(out["*"], items["items"])
    return out.select("doc_id", "rk", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      F.coalesce("runs", F.array().cast("array<struct<a:long,b:long>>")).alias("runs"))


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    d = decontaminate(docs, benchmark)
    return d.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))
