"""Hierarchical multi-length packing into sequences of at most `WINDOW` tokens.

Each task packs its documents in blocks of about `BLOCK_TOKENS` tokens, with no shuffle. A document's full windows are
sequences of their own; what is left is routed to the shortest of the context sizes `TIERS` (256, 512, 1,024) that it
fits. Each tier is packed into windows of its own size, the longest first: its longest document opens a window, and the gap is
filled by the longest documents of the shorter tiers that fit, then by cutting the shortest one there is. The
shortest tier fills its own gaps, and documents of a tier that can't fill another window go to the tiers below. What is
left of a block, less than a window of the shortest tier, is cut into sequences of power-of-two lengths. So every
sequence is full or of such a length, and none is padded.

Step groups: a block's sequences of all tiers, the costliest first, go one by one to the group with the fewest tokens,
of those to the one with the least attention cost; groups hold about `STEP_WINDOWS` windows of tokens.

Token ids. A text of common scripts without special strings goes through the fast encoder of the same vocabulary, all
others through `tokenizers`. Tests compare the two.

Defined results. Null or empty text: the end id alone. Repeated rows are packed separately. Null
doc_id is carried. Empty table: no rows. A task retried makes the same sequences: ids are the
partition's number and a counter.
"""
from __future__ import annotations

import base64
import bisect
import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory

WINDOW = 1024
TIERS = (256, 512, 1024)                     # context sizes, powers of two, ascending; the last is the window
BLOCK_TOKENS = 1 << 20
STEP_WINDOWS = 64
END_ID = 0
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "tier int, step_group long")
_PLAIN = re.compile(r"[\x00-\u024f\u2010-\u2027]*\Z")
_ENCODERS: dict[tuple, object] = {}


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers as P
    return P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Token ids of whole texts as little-endian uint32 bytes."""

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers as P
        import tiktoken
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        plain = _PLAIN.match(text) and not any(s in text for s in self.special)
        ids = self.fast.encode_ordinary(text) if plain else self.slow.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()


def encoder(paths: tuple[str, str]) -> Encoder:
    if paths not in _ENCODERS:
        _ENCODERS[paths] = Encoder(*paths)
    return _ENCODERS[paths]


Piece = tuple[int, int, int]                 # (length, document number, start)


class Tiers:
    """The pieces of a block by the tier they are routed to, each tier sorted by length."""

    def __init__(self, sizes: tuple[int, ...], pieces: list[Piece]):
        self.sizes = sizes
        self.held: list[list[Piece]] = [[] for _ in sizes]
        for p in pieces:
            self.held[self.route(p[0])].append(p)
        for tier in self.held:
            tier.sort()

    def route(self, length: int) -> int:
        return bisect.bisect_left(self.sizes, length)

    def add(self, piece: Piece) -> None:
        bisect.insort(self.held[self.route(piece[0])], piece)

    def tokens(self, upto: int) -> int:
        return sum(p[0] for tier in self.held[:upto + 1] for p in tier)

    def fitting(self, gap: int, upto: int) -> Piece | None:
        """The longest piece of at most `gap` tokens in the tiers up to `upto`, the longest tier first."""
        for tier in range(upto, -1, -1):
            at = bisect.bisect_right(self.held[tier], (gap, 1 << 62, 0)) - 1
            if at >= 0:
                return self.held[tier].pop(at)
        return None

    def cut(self, gap: int, upto: int) -> Piece:
        """The first `gap` tokens of the shortest piece; the rest is routed anew."""
        tier = next(t for t in range(upto + 1) if self.held[t])
        n, doc, start = self.held[tier].pop(0)
        self.add((n - gap, doc, start + gap))
        return gap, doc, start

    def pack(self) -> list[tuple[int, list[Piece]]]:
        """(size, pieces) of every sequence; sizes are the tiers', then the rest's powers of two."""
        out = []
        for tier in range(len(self.sizes) - 1, -1, -1):
            size, below = self.sizes[tier], max(tier - 1, 0)
            left = self.tokens(tier)
            while self.held[tier] and left >= size:
                pieces, gap = [], size
                piece = self.held[tier].pop()                              # its longest opens the window
                while True:
                    pieces.append(piece)
                    gap -= piece[0]
                    if not gap:
                        break
                    # gaps are filled from the shorter tiers; from this one only when they are empty
                    upto = below if any(self.held[:below + 1]) else tier
                    piece = self.fitting(gap, upto) or self.cut(gap, upto)
                out.append((size, pieces))
                left -= size
            if tier and self.held[tier]:                                   # cannot fill another window: to the tier below
                rest, self.held[tier] = self.held[tier], []
                for n, doc, start in rest:
                    for at in range(0, n, self.sizes[tier - 1]):
                        self.add((min(self.sizes[tier - 1], n - at), doc, start + at))
        size, left = self.sizes[0], self.tokens(0)
        while left:
            size >>= 1
            while left >= size:
                pieces, gap = [], size
                while gap:
                    piece = self.fitting(gap, 0) or self.cut(gap, 0)
                    pieces.append(piece)
                    gap -= piece[0]
                out.append((size, pieces))
                left -= size
        return out


def step_groups(tokens: list[int], costs: list[int], per_group: int) -> list[int]:
    """Group of each sequence: the costliest first, to the group with the fewest tokens and then the least cost."""
    heap = [(0, 0, g) for g in range(max(1, round(sum(tokens) / per_group)))]
    out = [0] * len(tokens)
    for q in sorted(range(len(tokens)), key=lambda q: (-tokens[q], -costs[q], q)):
        held, cost, g = heapq.heappop(heap)
        out[q] = g
        heapq.heappush(heap, (held + tokens[q], cost + costs[q], g))
    return out


def _pack_block(docs: list[tuple[int | None, bytes]], tiers: tuple[int, ...], first_sequence: int, first_group: int):
    window, sequences, rest = tiers[-1], [], []
    for i, (_, ids) in enumerate(docs):
        n = len(ids) // 4
        full = n - n % window
        sequences += [(window, [(window, i, s)]) for s in range(0, full, window)]
        if n > full:
            rest.append((n - full, i, full))
    sequences += Tiers(tiers, rest).pack()
    groups = step_groups([size for size, _ in sequences], [sum(n * n for n, _, _ in pieces) for _, pieces in sequences], STEP_WINDOWS * window)
    out = []
    for q, (size, pieces) in enumerate(sequences):
        offset = 0
        for n, i, s in pieces:
            doc_id, ids = docs[i]
            out.append((doc_id, s, n, zlib.crc32(memoryview(ids)[4 * s:4 * (s + n)]), len(ids) // 4, first_sequence + q,
                        offset, size, first_group + groups[q]))
            offset += n
    return out, len(sequences), max(groups, default=-1) + 1


def _packer(paths: tuple[str, str], tiers: tuple[int, ...], block_tokens: int):
    end = np.array([END_ID], dtype="<u4").tobytes()
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [pa.int32() if c.endswith(" int") else pa.int64() for c in SCHEMA.split(", ")]

    def run(batches):
        enc = encoder(paths)
        part = TaskContext.get().partitionId()
        sequence, group = part << 32, part << 32
        docs, held = [], 0

        def flush():
            nonlocal sequence, group
            rows, n, g = _pack_block(docs, tiers, sequence, group)
            sequence, group = sequence + n, group + g
            docs.clear()
            cols = list(zip(*rows)) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                ids = enc.encode(text.as_py() or "") + end
                docs.append((doc_id.as_py(), ids))
                held += len(ids) // 4
                if held >= block_tokens:
                    yield flush()
                    held = 0
        if docs:
            yield flush()
        release_memory()

    return run


def pack_documents(docs: DataFrame, tiers: tuple[int, ...] = TIERS, paths: tuple[str, str] | None = None,
                   block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece; `tier` is the size of its sequence. Sequences are as long as a tier, or a power of two."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(_packer(paths or tokenizer_paths(), tiers, block_tokens), SCHEMA)
