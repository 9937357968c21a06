"""Brown class-based bigrams: exchange clustering, class transitions and word emissions.

log10 P(text) = sum over tokens of log10 P(class | class before) + log10 P(word | class), both smoothed by adding
0.5. Tokens are the words and one end per text, which is also the context of the first word.

1. Texts are read once into blocks: a bounded number of texts, their tokens as numbers into the block's own
   vocabulary, and the vocabulary with its training counts. Word counts are sums over the blocks'
   vocabularies, so what is shuffled grows with the distinct words per block, not with the tokens.
2. Exchange clustering, core: the most frequent words, at least `CORE` and else the square root of the vocabulary, start
   in classes by frequency (at least `CLASSES`, else twice the vocabulary's fourth root); each in turn moves to the class
   that raises the training likelihood of the class bigrams most, until no word moves. Their bigram counts, a table of
   the vocabulary's size at most, are summed over all blocks.
3. Exchange step for all other words seen twice or more: with the core's classes fixed, a word's neighbours are counted
   by side and class and summed over all blocks; it takes the class under which they are most likely, so blocks and
   partitions change nothing. Words seen once share one class with words never seen, which so get the probability of
   rare words.
4. Classes and counts are joined to the blocks' vocabularies; blocks then score their texts.

A word is known by a 64-bit hash. Defined results. Null or empty text: the end alone. A null doc_id counts as the empty
text in the hold-out rule. Repeated rows count as often as they occur. No training rows: base and model give the
smoothed values of empty counts. Empty table: no rows.
"""
from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

CLASSES = 24            # at least so many classes that words are exchanged between; one class after them holds words
                        # seen once or never, and one the end of a text
CORE = 1024             # at least so many words that exchange one at a time
SWEEPS = 8
BLOCK_BYTES = 6 << 20
NEIGHBOURS = 1 << 21    # counts that a task holds before it passes them on
END_HASH = 1            # the end's word; real words hash to other values
BLOCKS = "block long, docs array<long>, held array<boolean>, lengths array<int>, ids binary, words array<long>, counts array<int>"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, emission double, transitions array<struct<code:int,n:int>>"


def n_core(vocabulary: int) -> int:
    return max(CORE, math.isqrt(vocabulary))


def n_classes(vocabulary: int) -> int:
    return max(CLASSES, math.isqrt(4 * math.isqrt(vocabulary)))


# ---- 1. blocks ------------------------------------------------------------- #
def _blocks(batches):
    part, number = TaskContext.get().partitionId(), 0
    for rows, buf, offs in C.text_chunks(batches, max_bytes=BLOCK_BYTES):
        low = C.LOWER[buf]
        starts, ends, doc = C.find_words(low, offs, C.SPACE_SEPARATED)
        h = C.signed(C.word_hashes(low, starts, ends))
        h[h == END_HASH] += 1
        n = rows.num_rows
        words = np.bincount(doc, minlength=n)
        tokens = np.full(len(h) + n, END_HASH, dtype=np.int64)
        place = np.arange(len(h)) + doc                      # one end after each text before
        tokens[place] = h
        ids = rows.column(0).to_pylist()
        held = np.array([zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i in ids])
        vocabulary, local, times = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")            # frequent words get small numbers, which pack well
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        vocabulary, local = vocabulary[order], rank[local]
        train = np.repeat(~held, words + 1)
        counts = np.bincount(local[train], minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays(
            [pa.array([part << 32 | number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([held.tolist()], pa.list_(pa.bool_())),
             pa.ListArray.from_arrays([0, n], pa.array((words + 1).astype(np.int32))), pa.array([_pack(local)], pa.binary()),
             pa.ListArray.from_arrays([0, len(vocabulary)], pa.array(vocabulary)),
             pa.ListArray.from_arrays([0, len(vocabulary)], pa.array(counts.astype(np.int32)))],
            names=["block", "docs", "held", "lengths", "ids", "words", "counts"])
        number += 1


def _pack(ids: np.ndarray) -> bytes:
    """Numbers under 2**24 as three planes of bytes, compressed: a block's vocabulary is far smaller."""
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
    return zlib.compress(np.ascontiguousarray(planes.T).tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    low, mid, high = np.frombuffer(zlib.decompress(data), np.uint8).reshape(3, -1).astype(np.int64)
    return low | mid << 8 | high << 16


def _row(batch: pa.RecordBatch, i: int):
    """Arrays of one block: (lengths, held, token numbers, vocabulary, counts)."""
    get = lambda name: batch.column(batch.schema.get_field_index(name))[i]
    return *_texts(batch, i), get("words").values.to_numpy(), get("counts").values.to_numpy()


def _texts(batch: pa.RecordBatch, i: int):
    """Arrays of one block's texts: (lengths, held, token numbers)."""
    get = lambda name: batch.column(batch.schema.get_field_index(name))[i]
    return get("lengths").values.to_numpy(), get("held").values.to_numpy(zero_copy_only=False), _unpack(get("ids").as_py())


def _contexts(lengths: np.ndarray) -> np.ndarray:
    """Whether a token is the first of its text."""
    first = np.zeros(int(lengths.sum()), bool)
    first[np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)] = True
    return first


# ---- 2. core --------------------------------------------------------------- #
def _core_bigrams(core):
    """Bigram counts of core words (others: one extra row and column) in training texts, in slices."""

    def run(batches):
        words = core.value
        m = len(words) + 1
        total = np.zeros(m * m, dtype=np.int64)
        for b in batches:
            for i in range(b.num_rows):
                lengths, held, local, vocabulary, _ = _row(b, i)
                at = np.searchsorted(words, vocabulary)
                known = (at < len(words)) & (words[np.minimum(at, len(words) - 1)] == vocabulary) if len(words) else np.zeros(len(vocabulary), bool)
                token = np.where(known, at, len(words))[local]
                end = int(np.searchsorted(words, END_HASH))
                before = np.concatenate(([end], token[:-1]))
                before[_contexts(lengths)] = end
                train = np.repeat(~held, lengths)
                total += np.bincount(before[train] * m + token[train], minlength=m * m)
        where = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32)), pa.array(total[where])], names=["cell", "n"])

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def _joint(cls: np.ndarray, bigrams: np.ndarray, k: int) -> np.ndarray:
    """Class-bigram counts."""
    member = np.eye(k)[cls]
    return member.T @ bigrams @ member


def exchange(bigrams: np.ndarray, fixed: np.ndarray, classes: int, start: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, list[float]]:
    """Exchange clustering of words by their bigram counts.

    `fixed` words keep their class. Each other word moves to the class with the highest class-bigram
    likelihood sum n(c, d) log n(c, d) - sum n(c.) log n(c.) - sum n(.c) log n(.c). Returns classes and the
    likelihood after each sweep, which never falls."""
    k = int(start.max(initial=0)) + 1
    k = max(k, classes)
    cls = start.copy()
    joint = _joint(cls, bigrams, k)
    value = lambda j: _xlogx(j).sum() - _xlogx(j.sum(1)).sum() - _xlogx(j.sum(0)).sum()
    history = [float(value(joint))]
    for _ in range(sweeps):
        moved = 0
        for w in np.flatnonzero(~fixed):
            own, self_n = cls[w], bigrams[w, w]
            out = np.bincount(cls, weights=bigrams[w], minlength=k)
            inn = np.bincount(cls, weights=bigrams[:, w], minlength=k)
            out[own] -= self_n
            inn[own] -= self_n
            base = joint.copy()                               # without the word
            base[own] -= out
            base[:, own] -= inn
            base[own, own] -= self_n
            rows, cols = base.sum(1), base.sum(0)
            # adding the word to class c changes row c, column c and their totals
            row_gain = (_xlogx(base + out[None, :]) - _xlogx(base)).sum(1)
            col_gain = (_xlogx(base + inn[:, None]) - _xlogx(base)).sum(0)
            diag = base.diagonal()
            both = _xlogx(diag + out + inn + self_n) - _xlogx(diag + out) - _xlogx(diag + inn) + _xlogx(diag)
            # context totals of other classes change alike for every c, but for c's own entries
            n_out, n_in = out.sum() + self_n, inn.sum() + self_n
            row_total = _xlogx(rows + inn)                    # rows of d gain n(d, w)
            col_total = _xlogx(cols + out)
            total_rows = row_total.sum() - row_total + _xlogx(rows + inn + n_out)
            total_cols = col_total.sum() - col_total + _xlogx(cols + out + n_in)
            score = row_gain + col_gain + both - total_rows - total_cols
            best = int(np.argmax(score[:classes]))
            if score[best] <= score[own] + 1e-9:
                best = own
            cls[w] = best
            moved += best != own
            joint = base
            joint[best] += out
            joint[:, best] += inn
            joint[best, best] += self_n
        history.append(float(value(joint)))
        if not moved:
            break
    return cls, history


def cluster_core(words: np.ndarray, counts: np.ndarray, bigrams: np.ndarray, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """(class of each core word, smoothed log P of class c next to core class d as (2, d, c) table)."""
    m = len(words) + 1
    start = np.empty(m, np.int64)
    order = np.argsort(-counts, kind="stable")
    start[order] = np.arange(len(words)) % classes
    start[-1] = classes                                        # all words outside the core stay together
    fixed = np.zeros(m, bool)
    fixed[-1] = True
    end = np.searchsorted(words, END_HASH)
    if end < len(words) and words[end] == END_HASH:
        start[end], fixed[end] = classes + 1, True
    cls, _ = exchange(bigrams, fixed, classes, start)
    joint = _joint(cls, bigrams, classes + 2) + 0.5
    after = np.log(joint / joint.sum(0))                      # P(class before d | class c) at [d, c]
    ahead = np.log(joint / joint.sum(1, keepdims=True)).T     # P(class after d | class c) at [d, c]
    return cls[:-1], np.stack((after, ahead))


# ---- 3. other words -------------------------------------------------------- #
def _neighbours(core, classes, k, repeated):
    """(word, its neighbours) of non-core words in training texts, summed over a task's blocks. Neighbours are pairs of
    two-byte numbers: side * k + class, and how often. `repeated` is a bitmap that keeps out most words seen once,
    which need no class of their own."""

    def run(batches):
        words, cls = core.value, classes.value
        rare, end = k - 2, k - 1
        held_back, size = [], 0
        for b in batches:
            for i in range(b.num_rows):
                lengths, held, local, vocabulary, counts = _row(b, i)
                at = np.minimum(np.searchsorted(words, vocabulary), max(len(words) - 1, 0))
                known = words[at] == vocabulary if len(words) else np.zeros(len(vocabulary), bool)
                of = np.where(known, cls[at] if len(words) else rare, rare)[local]
                first = _contexts(lengths)
                before = np.concatenate(([end], of[:-1]))
                before[first] = end
                after = np.concatenate((of[1:], [end]))
                wanted = ~known & (counts > 0) & (vocabulary != END_HASH) & C.in_bitmap(repeated.value, vocabulary)
                use = np.repeat(~held, lengths) & wanted[local]
                key = local[use].astype(np.int64) * (2 * k)
                key, n = np.unique(np.concatenate((key + before[use], key + k + after[use])), return_counts=True)
                held_back.append((vocabulary[key // (2 * k)], key % (2 * k), n))
                size += len(key)
                if size >= NEIGHBOURS:
                    yield _packed_neighbours(held_back)
                    held_back, size = [], 0
        if size:
            yield _packed_neighbours(held_back)

    return run


def _packed_neighbours(parts: list[tuple]) -> pa.RecordBatch:
    word, code, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((code, word))
    word, code, n = word[order], code[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], (word[1:] != word[:-1]) | (code[1:] != code[:-1]))))
    word, code, n = word[first], code[first], np.add.reduceat(n, first)
    times = -(-n // 65535)                                    # larger numbers take several pairs
    last = np.cumsum(times) - 1
    word, code = np.repeat(word, times), np.repeat(code, times)
    part = np.full(len(word), 65535)
    part[last] = n - 65535 * (times - 1)
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    data = np.stack((code, part), axis=1).astype("<u2")
    offsets = np.append(first, len(word)).astype(np.int32) * 4
    near = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(word[first]), near], names=["word", "near"])


def _best_classes(table):
    """Rows in order of word -> the class of each word with the highest log-likelihood of all its neighbours, the first of equal ones."""

    def run(batches):
        gains = table.value
        k = gains.shape[1]
        both = gains.reshape(2 * k, k)[:, :k - 2]
        kept, kept_n = None, None                             # the last word so far: its next rows may be in the next batch
        pick = lambda w, n: pa.RecordBatch.from_arrays([pa.array(w, pa.int64()), pa.array((n @ both).argmax(axis=1).astype(np.int32))], names=["word", "class"])
        for b in batches:
            if not b.num_rows:
                continue
            rows = b.column(0).to_numpy()
            near = b.column(1)
            ends = np.frombuffer(near.buffers()[1], np.int32)[near.offset:near.offset + len(near) + 1]
            data = np.frombuffer(near.buffers()[2], np.uint8)[ends[0]:ends[-1]].view("<u2").reshape(-1, 2).astype(np.int64)
            new = np.concatenate(([True], rows[1:] != rows[:-1]))
            word = rows[new]
            of = np.repeat(np.cumsum(new) - 1, np.diff(ends) // 4)
            n = np.bincount(of * (2 * k) + data[:, 0], weights=data[:, 1], minlength=len(word) * 2 * k).reshape(-1, 2 * k)
            if kept is not None and kept == word[0]:
                n[0] += kept_n
            elif kept is not None:
                yield pick([kept], kept_n[None, :])
            yield pick(word[:-1], n[:-1])
            kept, kept_n = int(word[-1]), n[-1].copy()
        if kept is not None:
            yield pick([kept], kept_n[None, :])

    return run


# ---- 4. scores ------------------------------------------------------------- #
def _score(totals, sizes, mass):
    """Blocks with their vocabulary's counts and classes -> per text sums and class-bigram counts."""
    n_train, v_train = totals
    k = len(sizes)
    rare, end = k - 2, k - 1

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
                            ("emission", pa.float64()), ("transitions", pa.list_(pa.struct([("code", pa.int32()), ("n", pa.int32())])))])
        if not left.num_rows:
            return schema.empty_table()
        row = left.combine_chunks().to_batches()[0]
        lengths, held, local = _texts(row, 0)
        count = np.zeros(left["n_words"][0].as_py())
        cls = np.full(len(count), rare)
        cls[left["end_at"][0].as_py()] = end
        at = right["at"].to_numpy()
        count[at], cls[at] = right["c"].to_numpy(), right["class"].to_numpy()
        base = np.log10((count + 0.5) / (n_train + 0.5 * (v_train + 1)))
        emission = np.log10((count + 0.5) / (mass[cls] + 0.5 * (sizes[cls] + (cls == rare))))
        owner = np.repeat(np.arange(len(lengths)), lengths)
        n = len(lengths)
        of = cls[local]
        before = np.concatenate(([end], of[:-1]))
        before[_contexts(lengths)] = end
        pair, times = np.unique(owner * (k * k) + before * k + of, return_counts=True)
        cuts = np.searchsorted(pair, np.arange(n + 1) * (k * k))
        inner = pa.StructArray.from_arrays([pa.array((pair % (k * k)).astype(np.int32)), pa.array(times.astype(np.int32))], names=["code", "n"])
        sums = lambda x: pa.array(np.bincount(owner, weights=x[local], minlength=n))
        return pa.Table.from_arrays(
            [left["docs"].combine_chunks()[0].values, pa.array(held), pa.array(lengths.astype(np.int64)),
             pa.array(np.bincount(owner, weights=count[local] > 0, minlength=n).astype(np.int64)), sums(base), sums(emission),
             pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), inner)], schema=schema)

    return run


def class_lm_scores(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = C.stage_table(d.mapInArrow(_blocks, BLOCKS), "blocks")
    counts = (blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("x")).select("x.words", "x.counts").where("counts > 0")
              .groupBy(F.col("words").alias("word")).agg(F.sum("counts").alias("c")))
    counts = C.stage_table(counts, "counts")
    t = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    n_train, v_train = t[0] or 0, t[1]
    top = counts.where(F.col("word") != END_HASH).orderBy(F.desc("c"), "word").limit(n_core(v_train)).union(counts.where(F.col("word") == END_HASH)).toArrow()
    order = np.argsort(top["word"].to_numpy(), kind="stable")
    core, core_counts = top["word"].to_numpy()[order], top["c"].to_numpy()[order]
    shared = sc.broadcast(core)
    m = len(core) + 1
    cells = blocks.mapInArrow(_core_bigrams(shared), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    k = n_classes(v_train) + 2
    bigrams = np.zeros(m * m)
    bigrams[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    cls, gains = cluster_core(core, core_counts, bigrams.reshape(m, m), k - 2)
    repeated = C.slot_bitmap(counts.where("c > 1"), "word")
    votes = (blocks.mapInArrow(_neighbours(shared, sc.broadcast(cls), k, repeated), "word long, near binary")
             .repartition("word").sortWithinPartitions("word").mapInArrow(_best_classes(sc.broadcast(gains)), "word long, class int"))
    fixed = C.local_rows(spark, [(int(w), int(c)) for w, c in zip(core, cls)], "word long, core_class int")
    words = (counts.join(votes, "word", "left").join(F.broadcast(fixed), "word", "left")
             .select("word", "c", F.coalesce("core_class", F.when(F.col("c") == 1, F.lit(k - 2)).otherwise(F.col("class")), F.lit(k - 2)).alias("class")))
    words = C.stage_table(words, "words")
    sizes, mass = np.zeros(k), np.zeros(k)
    for r in words.groupBy("class").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).collect():
        sizes[r["class"]], mass[r["class"]] = r["v"], r["n"]
    sizes[k - 1] = max(sizes[k - 1], 1)
    vocabulary = (blocks.select(F.col("block").alias("part"), F.posexplode("words").alias("at", "word")).join(words, "word").select("part", "at", "c", "class"))
    texts = blocks.select("block", "docs", "held", "lengths", "ids", F.size("words").alias("n_words"),
                          (F.array_position("words", F.lit(END_HASH).cast("long")) - 1).alias("end_at"))
    scored = C.stage_table(
        texts.groupBy("block").cogroup(vocabulary.groupBy("part")).applyInArrow(_score((n_train, v_train), sizes, mass), SCORED), "scored")
    pairs = scored.where("not held_out").select(F.explode("transitions").alias("t")).groupBy("t.code").agg(F.sum("t.n").alias("n")).collect()
    joint = np.zeros(k * k)
    for r in pairs:
        joint[r["code"]] = r["n"]
    joint = joint.reshape(k, k) + 0.5
    transition = [float(x) for x in np.log10(joint / joint.sum(1, keepdims=True)).ravel()]
    logs = F.expr(f"array({', '.join(f'{x!r}D' for x in transition)})")
    score = F.col("emission") + F.aggregate("transitions", F.lit(0.0), lambda s, x: s + x["n"] * F.get(logs, x["code"]))
    return (scored.withColumn("score", score)
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
                    F.col("base").alias("base_score"), "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")))
