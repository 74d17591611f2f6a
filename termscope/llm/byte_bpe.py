"""Operator 1: byte-level BPE encoding and decoding by monoid tree reduction.

An encoded span of text is an element of a monoid; two neighbours are joined by
re-encoding only what their common border can change. The tree has two levels:

* **Text.** A text is halved until a leaf is short, the leaf is cut by the
  pre-token pattern, and two neighbours are joined by cutting a growing window
  around their border anew. Scanning with the pattern is a function of the
  position alone (it never looks back, and no more than three characters ahead
  of a piece's start or one beyond its end), so left pieces that end before the
  border and start three characters before it are final, and as soon as the new
  cut meets a piece start of the right half, all later right pieces are final.
* **Piece.** A long piece is halved in bytes, and the halves' tokens are joined
  by merging a growing window of border tokens anew. A token sequence is the
  encoding of its bytes exactly when every adjacent pair is the encoding of the
  pair's bytes. So once the window's first token equals the left half's token
  there, and its last token the right half's (or the window reaches an end),
  every pair of the joined sequence is a pair of a true encoding, and the tokens
  outside the window are proved final.

Decoding concatenates up the same kind of tree.

Cases: a null text is the empty text (no ids, no bytes); texts of any length
are held as one row; equal rows give equal results; an empty table gives an
empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, text_of

LOOKAHEAD = 3  # characters a match may inspect beyond its start without taking them


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class KnownPieces(dict):
    """Ids of pieces seen before; a missing piece is encoded on the way. Two
    generations of bounded size, so that common pieces survive the change."""

    def __init__(self, codec: BytePairCodec):
        self.codec, self.older = codec, {}

    def change(self) -> None:
        self.older = dict(self)
        self.clear()

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            packed, data = self.codec.packed, piece.encode("utf-8")
            ids = packed.get(data)
            if ids is None:
                ids = b"".join([packed[t] for t in self.codec.merge_tree(data)])
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class BytePairCodec:
    """Encodes texts to little-endian unsigned 32-bit ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = 4096,
                 leaf_bytes: int = 24, leaf_ids: int = 8192, cache: int = 250_000):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.leaf_chars, self.leaf_bytes, self.leaf_ids, self.cache = leaf_chars, leaf_bytes, leaf_ids, cache
        self.packed = {t: i.to_bytes(4, "little") for t, i in ranks.items()}
        self.tokens = {i: t for t, i in ranks.items()}
        self.known = KnownPieces(self)

    # -- pieces -----------------------------------------------------------
    def piece_ids(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > self.cache:
            self.known.change()
        return list(map(self.known.__getitem__, pieces))

    def merge_tree(self, data: bytes) -> list[bytes]:
        if len(data) <= self.leaf_bytes:
            return self.merge(data)
        mid = len(data) // 2
        left, right = self.merge_tree(data[:mid]), self.merge_tree(data[mid:])
        width = 2
        while True:
            i, j = max(0, len(left) - width), min(len(right), width)
            new = self.merge(b"".join(left[i:]) + b"".join(right[:j]))
            if (i == 0 or new[0] == left[i]) and (j == len(right) or new[-1] == right[j - 1]):
                return left[:i] + new + right[j:]
            width *= 2

    def merge(self, data: bytes) -> list[bytes]:
        """Merge the adjacent pair of lowest rank, leftmost first, until none is left."""
        if len(data) > 96:
            return self.merge_heap(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = self.ranks.get
        far = 1 << 62
        near = [rank(a + b, far) for a, b in zip(parts, parts[1:])]
        while near:
            low = min(near)
            if low == far:
                break
            i = near.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del near[i]
            if i:
                near[i - 1] = rank(parts[i - 1] + parts[i], far)
            if i < len(near):
                near[i] = rank(parts[i] + parts[i + 1], far)
        return parts

    def merge_heap(self, data: bytes) -> list[bytes]:
        """The same merges with a heap over a linked list, for long windows."""
        n, rank = len(data), self.ranks.get
        part: list[bytes | None] = [data[i:i + 1] for i in range(n)]
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            if part[i] is None or after[i] >= n or len(part[i]) + len(part[after[i]]) != size:
                continue  # one side has changed since
            j = after[i]
            part[i] += part[j]
            part[j] = None
            after[i] = after[j]
            if after[i] < n:
                ahead[after[i]] = i
            for a in (ahead[i], i):
                if a >= 0 and after[a] < n:
                    both = part[a] + part[after[a]]
                    if (r := rank(both)) is not None:
                        heapq.heappush(heap, (r, a, len(both)))
        return [p for p in part if p is not None]

    # -- texts ------------------------------------------------------------
    def encode(self, text: str) -> bytes:
        return b"".join(self.encode_span(text, 0, len(text))[1])

    def encode_span(self, text: str, a: int, b: int) -> tuple[list[str], list[bytes]]:
        """Pieces of text[a:b] as a text of its own, and the ids of each."""
        if b - a <= self.leaf_chars:
            pieces = self.pattern.findall(text, a, b)
            return pieces, self.piece_ids(pieces)
        mid = (a + b) // 2
        (left, left_ids), (right, right_ids) = self.encode_span(text, a, mid), self.encode_span(text, mid, b)
        i, start = len(left), mid
        while i and (start == mid or start + LOOKAHEAD > mid):
            i -= 1
            start -= len(left[i])
            # now [i] starts at start; it is final only if it ends before the border and starts early enough
        if i == 0:
            start = a
        width = 16
        while True:
            end = min(b, mid + width)
            new = self.pattern.findall(text, start, end)
            taken = self.meet(new, start, end, end == b, right, mid)
            if taken is not None:
                keep, skip = taken
                break
            width *= 2
        window = new[:keep]
        return (left[:i] + window + right[skip:], left_ids[:i] + self.piece_ids(window) + right_ids[skip:])

    @staticmethod
    def meet(new: list[str], start: int, end: int, last: bool, right: list[str], mid: int) -> tuple[int, int] | None:
        """How many new pieces to take and right pieces to skip until both cuts
        meet, counting only new pieces that text beyond ``end`` cannot change."""
        at, k, r, m = start, 0, mid, 0
        while True:
            if at >= mid:
                while r < at and m < len(right):
                    r += len(right[m])
                    m += 1
                if r == at:
                    return k, m
            if k == len(new):
                return (k, len(right)) if last else None
            nxt = at + len(new[k])
            if not last and (nxt >= end or at + LOOKAHEAD > end):
                return None
            at, k = nxt, k + 1

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= self.leaf_ids:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


_CODECS: dict = {}


def _codec(key: str, shared, pattern: str) -> BytePairCodec:
    """One codec per worker process, so that tasks share the known pieces."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = BytePairCodec(shared.value, pattern)
    return _CODECS[key]


def encode_decode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text", batch_rows: int = 256) -> DataFrame:
    """``id_col``, ``n_tokens``, ``ids`` (binary, little-endian unsigned 32-bit)
    and ``decoded`` (binary, the bytes the ids decode to) of every row.

    The rank file is read once on the driver (its size is fixed by the
    vocabulary) and sent to the tasks as a broadcast variable. No shuffle."""
    spark = df.sparkSession
    ship(spark)
    shared, key = spark.sparkContext.broadcast(load_ranks(ranks_path)), uuid.uuid4().hex
    rows = df.select(F.col(id_col), text_of(text_col).alias("__text"))
    schema = T.StructType([rows.schema[0], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, shared, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                ids = [codec.encode(x) for x in part.column(1).to_pylist()]
                back = [codec.decode(np.frombuffer(x, "<u4")) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()), pa.array(back, pa.binary())],
                    names=[id_col, "n_tokens", "ids", "decoded"])

    return rows.mapInArrow(task, schema)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's digest columns of :func:`encode_decode`'s result."""
    return encoded.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
