"""N-gram Jaccard join with rare-first prefix filtering, verified once per pair.

A document's set is its distinct n-word shingles. Shingles are ordered by how often they occur
(counted over all documents in a table of fixed size), then by hash, so a prefix holds the rare ones.
Two sets that reach the similarity share a prefix shingle. Documents with equal sets are one
class, and one representative per class takes part.

Links are sought in two steps so that a large group of near copies is not expanded into all its pairs:
first every member of a prefix bucket is compared with the bucket's head (the member whose prefix
reaches the shingle first, i.e. the least edited one); verified links form components. Then the members of
different components that still share a bucket are compared in full. Candidates of both steps pass length, positional
and suffix filters before their texts are read, each pair once. A pair inside one component would add nothing to the components, so no link between
components is lost. The suffix filter splits the hashes at fixed pivots into `SIGNATURE` parts; the parts
whose parities differ bound the symmetric difference from below.

Defined results. Null text, or no words: empty set, linked with nothing, its own component. Fewer words than n:
the whole sequence is the one shingle. Repeated rows fall into one class. A null doc_id takes part but is
never a component's id; a component of null ids alone has a null id. Empty table: no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

N = 3
PERCENT = 90
FREQUENCY_BITS = 18
SIGNATURE = 512
SALTS = 16
SET_SCHEMA = "doc_id long, rk long, n long, s1 long, s2 long, prefix array<long>, sig array<long>"


def shingle_sets(buf: np.ndarray, offs: np.ndarray, n: int):
    """(hashes, text numbers, in order of text) of all shingle occurrences."""
    low = C.LOWER[buf]
    starts, ends, doc = C.find_words(low, offs, C.SPACE_SEPARATED)
    wh = C.word_hashes(low, starts, ends)
    n_words = np.bincount(doc, minlength=len(offs) - 1)
    h, at = C.ngrams(wh, doc, n)
    owner = doc[at]
    parts, owners = [h], [owner]
    for m in range(1, n):
        g, p = C.ngrams(wh, doc, m)
        short = n_words[doc[p]] == m
        parts.append(g[short]), owners.append(doc[p][short])
    h, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return h[order], owner[order]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _frequencies(n: int):
    def run(batches):
        counts = np.zeros(1 << FREQUENCY_BITS, dtype=np.int64)
        for _, buf, offs in C.text_chunks(batches):
            h, _ = shingle_sets(buf, offs, n)
            counts += np.bincount((h & np.uint64(len(counts) - 1)).astype(np.int64), minlength=len(counts))
        slot = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(counts[slot])], names=["slot", "c"])

    return run


def _sets(n: int, percent: int, frequency):
    def run(batches):
        table = frequency.value
        mask = np.uint64(len(table) - 1)
        for rows, buf, offs in C.text_chunks(batches):
            h, owner = shingle_sets(buf, offs, n)
            cuts = np.searchsorted(owner, np.arange(rows.num_rows + 1))
            size, s1, s2, prefix, lengths, sigs = [], [], [], [], [], []
            for i in range(rows.num_rows):
                u = np.unique(h[cuts[i]:cuts[i + 1]])
                rare = np.argsort(table[u & mask], kind="stable")      # ties stay in order of hash
                p = prefix_length(len(u), percent) if len(u) else 0
                size.append(len(u)), lengths.append(p), prefix.append(u[rare[:p]])
                s1.append(C.mix64(u + C.ODD[1]).sum(dtype=np.uint64)), s2.append(C.mix64(u ^ C.ODD[2]).sum(dtype=np.uint64))
                part = np.bincount((u >> np.uint64(55)).astype(np.int64), minlength=SIGNATURE) & 1
                sigs.append(np.packbits(part.astype(np.uint8)).view(np.int64))
            ends = np.concatenate(([0], np.cumsum(lengths)))
            values = np.concatenate(prefix) if prefix else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(size, pa.int64()),
                 pa.array(C.signed(np.array(s1, np.uint64))), pa.array(C.signed(np.array(s2, np.uint64))),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(C.signed(values))),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * (SIGNATURE // 64), pa.int32()),
                                          pa.array(np.concatenate(sigs) if sigs else np.zeros(0, np.int64)))],
                names=["doc_id", "rk", "n", "s1", "s2", "prefix", "sig"])

    return run


def _verify(n: int, percent: int):
    """Pairs with both texts -> pairs with whether they link; each text's set is built from its whole text."""

    def run(batches):
        for b in batches:
            step = 0
            left, right = b.column(2).to_pylist(), b.column(3).to_pylist()
            while step < b.num_rows:
                end, size, texts = step, 0, []
                while end < b.num_rows and (end == step or size < C.CHUNK_BYTES):
                    x, y = left[end].encode(), right[end].encode()
                    texts += [x, y]
                    size += len(x) + len(y)
                    end += 1
                offs = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
                h, owner = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offs, n)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                linked = []
                for i in range(0, len(texts), 2):
                    x, y = np.unique(h[cuts[i]:cuts[i + 1]]), np.unique(h[cuts[i + 1]:cuts[i + 2]])
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(step, end - step), b.column(1).slice(step, end - step),
                                                  pa.array(linked, pa.bool_())], names=["a", "b", "linked"])
                step = end
        C.release_memory()

    return run


def _could_reach(percent: int) -> str:
    """Length and positional filters over the sizes and positions of x and y in SQL."""
    need = f"(cast({percent} as double) / (100 + {percent})) * (x.n + y.n) - 1e-9"
    return (f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and "
            f"least(x.pos, y.pos) + 1 + least(x.n - x.pos, y.n - y.pos) - 1 >= {need}")


def _near_signatures(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that pass the suffix filter; only the sizes and signatures (64 bytes) of nodes in pairs are joined."""
    sig = C.filter_by_bitmap(classes.select("node", "n", "sig"), "node", pairs.select(F.explode(F.array("a", "b")).alias("node")), "node")
    side = lambda c: sig.select(F.col("node").alias(c), F.struct("n", "sig").alias(f"{c}_"))
    apart = " + ".join(f"bit_count(a_.sig[{i}] ^ b_.sig[{i}])" for i in range(SIGNATURE // 64))
    most = f"(a_.n + b_.n) * cast({100 - percent} as double) / (100 + {percent}) + 1e-9"
    return pairs.join(side("a"), "a").join(side("b"), "b").where(f"{apart} <= {most}").select("a", "b")


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose prefixes share enough: of the set whose prefix ends first in
    the order, every shingle that is common lies in both prefixes or after its own, so the intersection is at
    most the prefixes' plus the longer of what follows them."""
    sets = C.filter_by_bitmap(classes.select("node", "n", "prefix"), "node", pairs.select(F.explode(F.array("a", "b")).alias("node")), "node")
    side = lambda c: sets.select(F.col("node").alias(c), F.struct("n", "prefix").alias(f"{c}_"))
    both = f"(a_.n + b_.n) * cast({percent} as double) / (100 + {percent}) - 1e-9"
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(f"size(array_intersect(a_.prefix, b_.prefix)) + greatest(a_.n - size(a_.prefix), b_.n - size(b_.prefix)) >= {both}")
            .select("a", "b"))


def links(docs: DataFrame, n: int = N, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their set's identity, one row per class with its node, verified links)."""
    keyed = C.keyed(docs)
    spark = docs.sparkSession
    counted = keyed.select("text").mapInArrow(_frequencies(n), "slot int, c long").groupBy("slot").agg(F.sum("c").alias("c")).toArrow()
    frequency = np.zeros(1 << FREQUENCY_BITS, dtype=np.int64)
    frequency[counted["slot"].to_numpy()] = counted["c"].to_numpy()
    wide = C.stage_table(keyed.select("doc_id", "rk", "text").mapInArrow(_sets(n, percent, spark.sparkContext.broadcast(frequency)), SET_SCHEMA), "sets")
    sets = C.stage_table(wide.drop("prefix", "sig"), "documents")
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rk")
    classes = C.stage_table(wide.where("n > 0").groupBy("s1", "s2", "n").agg(
        F.min("rk").alias("node"), F.min("doc_id").alias("first_id"), F.min(row).alias("best"), F.any_value("prefix").alias("prefix"),
        F.any_value("sig").alias("sig")), "classes")
    C.drop_table(wide)
    grams = classes.select("node", "n", F.posexplode("prefix").alias("pos", "gram"))
    shared = C.stage_table(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("gram"), "shared")
    grams = C.stage_table(C.filter_by_bitmap(grams, "gram", shared, "gram").join(shared, "gram"), "grams")
    C.drop_table(shared)

    heads = grams.groupBy("gram").agg(F.min(F.struct("pos", "node", "n")).alias("h")).select("gram", "h.*")
    star = (grams.alias("x").join(heads.alias("y"), F.expr("x.gram = y.gram and x.node <> y.node and " + _could_reach(percent)))
            .select(F.expr("least(x.node, y.node)").alias("a"), F.expr("greatest(x.node, y.node)").alias("b")).distinct())
    star = C.stage_table(star, "star")
    near = C.stage_table(_near_signatures(star, classes, percent), "near")
    first = _verified(keyed, _plausible(near, classes, percent), n, percent, "first")
    C.drop_table(star), C.drop_table(near)
    label = C.stage_table(C.connected_components(first.where("linked"), "near"), "labels")

    at = grams.join(label, "node", "left").select("gram", "node", "n", "pos", F.coalesce("label", "node").alias("comp"))
    mixed = at.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("gram")
    sig = classes.select("node", *[F.col("sig")[i].alias(f"s{i}") for i in range(SIGNATURE // 64)])
    at = C.stage_table(at.join(mixed, "gram").join(sig, "node"), "mixed")
    C.drop_table(grams)
    apart = " + ".join(f"bit_count(x.s{i} ^ y.s{i})" for i in range(SIGNATURE // 64))
    most = f"(x.n + y.n) * cast({100 - percent} as double) / (100 + {percent}) + 1e-9"
    rest = (at.alias("x").join(at.alias("y"), F.expr(f"x.gram = y.gram and x.node < y.node and x.comp <> y.comp and {_could_reach(percent)} and {apart} <= {most}"))
            .select(F.expr("x.node").alias("a"), F.expr("y.node").alias("b")).distinct())
    rest = C.stage_table(rest.join(first.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    C.drop_table(at)
    second = _verified(keyed, _plausible(rest, classes, percent), n, percent, "second")
    C.drop_table(rest)
    return sets, classes, first.where("linked").select("a", "b").union(second.where("linked").select("a", "b"))


def _verified(keyed: DataFrame, pairs: DataFrame, n: int, percent: int, name: str) -> DataFrame:
    """The pairs with whether they link, as a table; what led to it is removed."""
    pairs = C.stage_table(pairs, "pairs")
    nodes = C.stage_table(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "nodes")
    texts = (C.filter_by_bitmap(keyed.select("rk", "text"), "rk", nodes, "node")
             .join(nodes, F.col("rk") == F.col("node")).select("node", "text"))
    texts = C.stage_table(texts.groupBy("node").agg(F.first("text").alias("text")), "texts")
    out = C.stage_table(pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
                        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
                        .select("a", "b", "ta", "tb").mapInArrow(_verify(n, percent), "a long, b long, linked boolean"), name)
    for table in (pairs, nodes, texts):
        C.drop_table(table)
    return out


def _labelled(classes: DataFrame, found: DataFrame) -> DataFrame:
    """Classes with the node that names their component."""
    label = C.connected_components(found, "components")
    return classes.join(label, "node", "left").select("s1", "s2", "n", "node", "first_id", "best", F.coalesce("label", "node").alias("label"))


def near_duplicate_classes(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, rk, n_shingles, component_id (smallest doc_id reachable by links) and
    group_key (the component's node; null without words)."""
    sets, classes, found = links(docs, n, percent)
    nodes = C.stage_table(_labelled(classes, found), "labelled")
    # the rows of a large component are dealt over SALTS keys
    ids = nodes.groupBy("label").agg(F.min("first_id").alias("component")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    nodes = (nodes.withColumn("salt", F.pmod("node", F.lit(SALTS)).cast("int")).join(ids, ["label", "salt"])
             .select("s1", "s2", "n", "component", F.col("label").alias("group_key")))
    return (sets.join(nodes, ["s1", "s2", "n"], "left")
            .select("doc_id", "rk", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"), "group_key"))


def keep_one_of_each(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest doc_id (null last), with all columns.
    Of rows equal in doc_id and text one stays; documents without words all stay. Who stays is decided over classes,
    so no component's rows meet in a join."""
    sets, classes, found = links(docs, n, percent)
    best = _labelled(classes, found).groupBy("label").agg(F.min("best").alias("b")).select("b.doc_id", "b.rk")
    worded = sets.where("n > 0").select("doc_id", "rk")
    drop = worded.join(best, C.same_row(worded, best), "left_anti").distinct()
    kept = C.without_rows(docs, sets, drop)
    repeated = worded.groupBy("doc_id", "rk").count().where("count > 1")
    repeated = C.stage_table(repeated.join(best, C.same_row(repeated, best), "left_semi")
                             .select(F.col("doc_id").alias("_row_id"), F.col("rk").alias("_row_key")), "repeated")
    if repeated.isEmpty():
        return kept
    key = F.xxhash64(kept["doc_id"].cast("long"), kept["text"].cast("string"))
    same = kept["doc_id"].cast("long").eqNullSafe(F.col("_row_id")) & (key == F.col("_row_key"))
    return kept.join(repeated, same, "left_anti").unionByName(
        kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def jaccard_report(docs: DataFrame) -> DataFrame:
    return near_duplicate_classes(docs).select("doc_id", "n_shingles", "component_id")
