"""Operator 7: repeated byte strings by a distributed merge of sorted suffixes.

Every byte that a 50-byte string covers goes, if that string also starts in a
document with a smaller id. Strings are judged on the input, never cross
documents, and may overlap.

Sorting every suffix of a corpus would move many times its size, so suffixes are
taken at anchors only, which loses nothing: of every 50 bytes, the 24-byte
string with the smallest hash is an anchor, so equal 50-byte strings have equal
anchors at equal places, and each 50-byte string belongs to (at least) one.

1. *Which anchors repeat.* Tasks send anchor hashes by range of the hash, packed
   by document; a range's task finds those of two or more documents and answers
   by bucket of documents. Hashes only filter: a chance agreement costs time.
2. *Sorted runs.* For each repeated anchor of its documents, a bucket's task cuts
   the context that the anchor's 50-byte strings span, as suffix (from the
   anchor) and what stands before it. Contexts are sorted into one run per
   range; equal ones of a run are answered at once, all but that of the smallest
   id, and the rest is front-coded: shared prefix length and tail.
3. *Merge.* A range's task merges the runs with a loser tree that knows each
   candidate's common prefix with the last winner: candidates with different
   ones are ordered without looking at a byte, and equal ones are compared from
   there on. The merge yields the common prefixes of neighbours, so suffixes that
   share an anchor come out as a group, and within a group each distinct 50-byte
   string gets its smallest id. No pairs are formed.
4. *Removal.* Covered stretches go back to the documents' buckets, are merged per
   document, and what is left is returned.

An anchor of more than ``HOT`` documents would gather all of them in one group;
its 50-byte strings are sorted one by one instead, dealt by their own hash, and
each run keeps one per string, so a group holds no more than one entry per run
(and place in the document of smallest id). Both ways are exact.

Numbers of ranges and buckets follow the corpus: ``task_bytes`` of text each,
16 MiB or, beyond 100 GB, 50 times the square root of the corpus (500 MB at
100 TB), as every bucket sends to every range and the packed rows between them
should not shrink to single entries. So what a task holds is bounded; one
document is the smallest unit.

Cases: a null text is the empty text; texts of under 50 bytes lose nothing; rows
that share an id do not cover each other, and are told apart by their text; a
row without an id loses nothing and covers nothing; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, text_of

LENGTH = 50
ANCHOR = 24
HOT = 10_000
BYTES_PER_TASK = 16 << 20        # at least
ROOTS_PER_TASK = 50              # times the square root of the corpus
LOW = 40                         # bits of a hash sent with its range
HOT_BIT = np.uint64(1 << 63)


def task_bytes(total: int, least: int = BYTES_PER_TASK) -> int:
    """Bytes of text per range and bucket for a corpus of ``total`` bytes."""
    return max(least, ROOTS_PER_TASK * math.isqrt(total))


# -- anchors ----------------------------------------------------------------
def _slide(a: np.ndarray, width: int, op) -> np.ndarray:
    """op over every window of ``width`` elements, by doubling."""
    out, size = a, 1
    while 2 * size <= width:
        out = op(out[:-size], out[size:])
        size *= 2
    if size < width:
        n = len(a) - width + 1
        out = op(out[:n], out[width - size: width - size + n])
    return out


def anchors(data: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes, smallest hash per string): the anchors of a document."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    raw = np.frombuffer(data + bytes(8), np.uint8)
    words = np.zeros(len(data), "<u8")
    for shift in range(8):  # the eight bytes from every place on
        words[shift::8] = np.frombuffer(raw[shift:].tobytes()[: (len(data) - shift + 7) // 8 * 8], "<u8")[: len(words[shift::8])]
    words = words.astype(np.uint64)
    n, mult = len(data) - anchor + 1, np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(n, np.uint64)
    for at in [*range(0, anchor - 7, 8), *([anchor - 8] if anchor % 8 else [])]:
        h = ((h ^ (h >> np.uint64(29))) + words[at: at + n]) * mult
    h ^= h >> np.uint64(32)
    h *= mult
    h ^= h >> np.uint64(29)
    width = length - anchor + 1
    least = _slide(h, width, np.minimum)
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    places = np.flatnonzero(_slide(around, width, np.maximum) == h)
    return places, h[places], least


def _keys(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Range and low bits of a hash in one number below 2**63 (ranges < 2**23)."""
    low = hashes & np.uint64((1 << LOW) - 1)
    return ((hashes >> np.uint64(LOW)) % np.uint64(ranges)) << np.uint64(LOW) | low


def bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64)
    mixed = (x ^ (x >> np.uint64(13)) ^ (x >> np.uint64(29))) & np.uint64((1 << 62) - 1)
    return (mixed % np.uint64(buckets)).astype(np.int64)


def bucket_column(col: Column, buckets: int) -> Column:
    """The same as :func:`bucket_of`; rows without an id go to bucket 0."""
    mixed = col.bitwiseXOR(F.shiftrightunsigned(col, 13)).bitwiseXOR(F.shiftrightunsigned(col, 29))
    return F.coalesce(F.pmod(mixed.bitwiseAND(F.lit((1 << 62) - 1)), F.lit(buckets)), F.lit(0)).cast("int")


def _pack(*arrays: np.ndarray) -> bytes:
    return zlib.compress(b"".join([len(arrays[0]).to_bytes(8, "little"), *(np.ascontiguousarray(a).tobytes() for a in arrays)]), 1)


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    data = zlib.decompress(blob)
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for k in kinds:
        size = n * np.dtype(k).itemsize
        out.append(np.frombuffer(data, k, n, at))
        at += size
    out.append(np.frombuffer(data, np.uint8, len(data) - at, at))
    return out


def _delta(ids: np.ndarray) -> np.ndarray:
    return np.diff(ids, prepend=np.int64(0))  # wraps around, and so does its inverse


# -- step 1 -----------------------------------------------------------------
def _hash_task(ranges: int, flush: int = 1 << 20):
    """(id, data) rows to one packed row per range and flush."""

    def send(ids: list, hashes: list) -> Iterator[pa.RecordBatch]:
        if not ids:
            return
        doc = np.repeat(np.arange(len(ids)), [len(h) for h in hashes])
        keys = _keys(np.concatenate(hashes), ranges)
        order = np.argsort(keys >> np.uint64(LOW), kind="stable")
        keys, doc = keys[order], doc[order]
        rng = (keys >> np.uint64(LOW)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(rng, prepend=-1))
        all_ids = np.array(ids, np.int64)
        rows = []
        for a, b in zip(cuts, [*cuts[1:], len(rng)]):
            first = np.flatnonzero(np.diff(doc[a:b], prepend=-1))
            counts = np.diff(np.append(first, b - a)).astype(np.uint32)
            low = keys[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : LOW // 8]
            rows.append((int(rng[a]), _pack(_delta(all_ids[doc[a:b][first]]), counts), low.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                          pa.array([r[2] for r in rows], pa.binary())], names=["r", "docs", "low"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, held = [], [], 0
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = np.unique(anchors(data)[1])
                if len(h):
                    ids.append(i)
                    hashes.append(h)
                    held += len(h)
                    if held >= flush:
                        yield from send(ids, hashes)
                        ids, hashes, held = [], [], 0
        yield from send(ids, hashes)

    return task


def _repeated_task(buckets: int, hot: int):
    """All packed rows of a range to one packed row per bucket: ids, counts and keys that repeat."""

    def task(key: tuple, table: pa.Table) -> pa.Table:
        r = key[0].as_py()
        ids, lows = [], []
        for docs, low in zip(table.column("docs").to_pylist(), table.column("low").to_pylist()):
            delta, counts, _ = _unpack(docs, "i8", "u4")
            ids.append(np.repeat(np.cumsum(delta), counts))
            wide = np.zeros((len(low) * 8 // LOW, 8), np.uint8)
            wide[:, : LOW // 8] = np.frombuffer(low, np.uint8).reshape(-1, LOW // 8)
            lows.append(wide.view("<u8").ravel())
        ids, lows = np.concatenate(ids), np.concatenate(lows).astype(np.uint64)
        order = np.argsort(lows, kind="stable")
        ids, lows = ids[order], lows[order]
        first = np.flatnonzero(np.concatenate([[True], lows[1:] != lows[:-1]]))
        counts = np.diff(np.append(first, len(lows)))
        each = np.repeat(counts, counts)
        keep = each > 1
        keys = lows[keep] | np.uint64(r << LOW)
        keys = np.where(each[keep] > hot, keys | HOT_BIT, keys)
        ids = ids[keep]
        bucket = bucket_of(ids, buckets)
        order = np.lexsort((ids, bucket))
        ids, keys, bucket = ids[order], keys[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        rows = [(int(bucket[a]), _pack(_delta(ids[a:b]), keys[a:b])) for a, b in zip(cuts, [*cuts[1:], len(ids)])]
        return pa.table({"b": pa.array([x[0] for x in rows], pa.int32()), "blob": pa.array([x[1] for x in rows], pa.binary())})

    return task


# -- step 2 -----------------------------------------------------------------
def _by_row(table: pa.Table) -> Iterator[tuple[int | None, int, bytes]]:
    """(id, number among different texts of this id, data) of a bucket's rows."""
    seen: dict = {}
    rows = list(zip(table.column("id").to_pylist(), table.column("data").to_pylist()))
    rows.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    for i, data in rows:
        if i is None:
            yield None, 0, data
            continue
        last = seen.get("id"), seen.get("data")
        number = 0 if last[0] != i else seen["number"] + (last[1] != data)
        seen = {"id": i, "data": data, "number": number}
        yield i, number, data


def _common(x: bytes, y: bytes, at: int) -> int:
    """Length of the common prefix, known to be ``at`` at least."""
    n = min(len(x), len(y))
    a, b = x[at:n], y[at:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


def _front_coded(entries: list[tuple]) -> bytes:
    """Sorted (context, before, id, row, place) as common prefix lengths and tails."""
    shared, tails, last = [], [], b""
    for e in entries:
        x = e[0]
        n = _common(last, x, 0) if last else 0
        shared.append(n)
        tails.append(x[n:])
        last = x
    return _pack(np.array(shared, np.uint8), np.array(list(map(len, tails)), np.uint8), np.array([e[1] for e in entries], np.uint8),
                 np.array([e[2] for e in entries], np.int64), np.array([e[3] for e in entries], np.uint32),
                 np.array([e[4] for e in entries], np.uint64), np.frombuffer(b"".join(tails), np.uint8))


def _cover_rows(ids: list, rows: list, starts: list, ends: list, buckets: int) -> list[tuple[int, bytes]]:
    """Covered stretches, packed by bucket."""
    if not ids:
        return []
    ids = np.array(ids, np.int64)
    bucket = bucket_of(ids, buckets)
    order = np.argsort(bucket, kind="stable")
    cols = [np.array(c, k)[order] for c, k in ((ids, np.int64), (rows, np.uint32), (starts, np.uint64), (ends, np.uint64))]
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    return [(int(bucket[a]), _pack(*(c[a:b] for c in cols))) for a, b in zip(cuts, [*cuts[1:], len(bucket)])]


def _out(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    """kind 0: a run for range ``to``; kind 1: covered stretches for bucket ``b``, sent along with a range."""
    return pa.table({"to": pa.array([r[0] for r in rows], pa.int32()), "b": pa.array([r[1] for r in rows], pa.int32()),
                     "blob": pa.array([r[2] for r in rows], pa.binary())})


def _runs_task(ranges: int, buckets: int):
    """A bucket's documents and repeated keys to sorted, front-coded runs by range."""
    width = LENGTH - ANCHOR + 1
    steps = np.arange(width)

    def contexts(data: bytes, asked: np.ndarray, i: int, number: int, out: dict) -> None:
        places, hashes, least = anchors(data)
        keys = _keys(hashes, ranges)
        at = np.searchsorted(asked, keys)
        at[at == len(asked)] = 0
        mask = asked[at] == keys
        hot = np.zeros(len(keys), bool)
        other = np.searchsorted(asked, keys | HOT_BIT)
        other[other == len(asked)] = 0
        hot = asked[other] == keys | HOT_BIT
        mask |= hot
        q, h, keys, hot = places[mask], hashes[mask], keys[mask], hot[mask]
        if not len(q):
            return
        # The strings (by start) whose smallest hash is this anchor's: one stretch of starts.
        starts = q[:, None] - (width - 1) + steps
        mine = (starts >= 0) & (starts < len(least))
        mine &= least[np.clip(starts, 0, len(least) - 1)] == h[:, None]
        low = starts[np.arange(len(q)), mine.argmax(axis=1)]
        high = starts[np.arange(len(q)), width - 1 - mine[:, ::-1].argmax(axis=1)]
        to = (keys >> np.uint64(LOW)).astype(np.int64)
        for p, a, b, t, many in zip(q.tolist(), low.tolist(), high.tolist(), to.tolist(), hot.tolist()):
            if many:
                for s in range(a, b + 1):
                    x = data[s: s + LENGTH]
                    out.setdefault(ranges + zlib.crc32(x) % ranges, []).append((x, 0, i, number, s))
            else:
                out.setdefault(t, []).append((data[p: b + LENGTH] + data[a:p], p - a, i, number, a))

    def task(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        b = key[0].as_py()
        blobs = [_unpack(x, "i8", "u8") for x in answers.column("blob").to_pylist()]
        if not blobs or not texts.num_rows:
            return _out([])
        ids = np.concatenate([np.cumsum(x[0]) for x in blobs])
        keys = np.concatenate([x[1] for x in blobs])
        order = np.lexsort((keys, ids))
        ids, keys = ids[order], keys[order]
        runs: dict[int, list[tuple]] = {}
        for i, number, data in _by_row(texts):
            if i is None:
                continue
            x, y = np.searchsorted(ids, i, "left"), np.searchsorted(ids, i, "right")
            if x < y:
                contexts(data, np.unique(keys[x:y]), i, number, runs)
        rows, cover = [], ([], [], [], [])
        for to in sorted(runs):
            entries = runs.pop(to)
            entries.sort()
            kept, last = [], (None, None, None)
            for e in entries:
                if e[0] == last[0] and e[1] == last[1] and e[2] != last[2]:
                    for c, v in zip(cover, (e[2], e[3], e[4], e[4] + len(e[0]))):
                        c.append(v)
                else:
                    kept.append(e)
                    if e[0] != last[0] or e[1] != last[1]:
                        last = e
            rows.append((to, -1, _front_coded(kept)))
        rows += [(bucket % ranges, bucket, blob) for bucket, blob in _cover_rows(*cover, buckets)]
        return _out(rows)

    return task


# -- step 3 -----------------------------------------------------------------
def _run(blob: bytes) -> Iterator[tuple[int, bytes, int, int, int, int]]:
    """(common prefix with the one before, context, before, id, row, place) of a front-coded run."""
    shared, sizes, before, ids, rows, places, tails = _unpack(blob, "u1", "u1", "u1", "i8", "u4", "u8")
    tails, at, last = tails.tobytes(), 0, b""
    for n, size, a, i, r, p in zip(shared.tolist(), sizes.tolist(), before.tolist(), ids.tolist(), rows.tolist(), places.tolist()):
        last = last[:n] + tails[at: at + size]
        at += size
        yield n, last, a, i, r, p


def merged(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs of (common prefix with the one before, bytes, ...) by a loser tree.

    Yields the same tuples in order, with the common prefix to the one yielded
    before. A candidate carries its common prefix with the last winner; of two
    candidates the one with the longer is smaller, and only equal ones compare
    bytes, from that prefix on. The loser then carries its prefix with the winner."""
    k = len(runs)
    if k == 1:
        yield from runs[0]
        return
    size = 1 << (k - 1).bit_length()
    items: list = [next(r, None) for r in runs] + [None] * (size - k)
    text: list = [x[1] if x else None for x in items]
    known = [0] * size

    def beats(i: int, j: int) -> bool:
        """Whether i comes before j; the loser's known prefix is brought up to date."""
        x, y = text[i], text[j]
        if x is None or y is None:
            return y is None
        a, b = known[i], known[j]
        if a != b:
            return a > b
        n = _common(x, y, a)
        if n == len(x) or n == len(y):
            first = len(x) < len(y) or len(x) == len(y) and i < j
        else:
            first = x[n] < y[n]
        known[j if first else i] = n
        return first

    losers, winners = [0] * size, [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        i, j = winners[2 * node], winners[2 * node + 1]
        if not beats(i, j):
            i, j = j, i
        winners[node], losers[node] = i, j
    w = winners[1]
    known[w] = 0
    while text[w] is not None:
        item = items[w]
        yield (known[w], *item[1:])
        nxt = next(runs[w], None)
        items[w] = nxt
        if nxt is None:
            text[w] = None
        else:
            known[w], text[w] = nxt[0], nxt[1]
        node = (w + size) >> 1
        while node:
            j = losers[node]
            y = text[j]
            if y is not None:
                x = text[w]
                if x is None or known[w] < known[j] or known[w] == known[j] and not beats(w, j):
                    losers[node], w = w, j
            node >>= 1


def _resolve(group: list[tuple], cover: tuple[list, list, list, list]) -> None:
    """Covered stretches of suffixes that share an anchor."""
    contexts: dict[tuple, list[tuple]] = {}
    for _, x, a, i, r, p in group:
        contexts.setdefault((x, a), []).append((i, r, p))
    best: dict[bytes, int] = {}
    strings: dict[tuple, list[bytes]] = {}
    least = {c: min(m)[0] for c, m in contexts.items()}
    if len(contexts) > 1:
        for c, i in least.items():
            x, a = c
            x = x[len(x) - a:] + x[: len(x) - a]
            strings[c] = own = [x[s: s + LENGTH] for s in range(len(x) - LENGTH + 1)]
            for s in own:
                if best.get(s, i) >= i:
                    best[s] = i
    ids, rows, starts, ends = cover
    for c, members in contexts.items():
        size, m = len(c[0]), least[c]
        stretches = []
        if strings:
            on = None
            for s, x in enumerate(strings[c]):
                if best[x] < m:
                    on = s if on is None else on
                elif on is not None:
                    stretches.append((on, s - 1 + LENGTH))
                    on = None
            if on is not None:
                stretches.append((on, size))
        for i, r, p in members:
            for a, b in ([(0, size)] if i > m else stretches):
                ids.append(i)
                rows.append(r)
                starts.append(p + a)
                ends.append(p + b)


def _merge_task(ranges: int, buckets: int):
    def task(key: tuple, table: pa.Table) -> pa.Table:
        to = key[0].as_py()
        least = LENGTH if to >= ranges else ANCHOR
        rows, runs = [], []
        for b, blob in zip(table.column("b").to_pylist(), table.column("blob").to_pylist()):
            if b >= 0:
                rows.append((to, b, blob))
            else:
                runs.append(_run(blob))
        if runs:
            cover: tuple[list, list, list, list] = ([], [], [], [])
            group: list[tuple] = []
            for item in merged(runs):
                if item[0] >= least:
                    group.append(item)
                else:
                    if len(group) > 1:
                        _resolve(group, cover)
                    group = [item]
            if len(group) > 1:
                _resolve(group, cover)
            rows += [(to, b, blob) for b, blob in _cover_rows(*cover, buckets)]
        return _out(rows)

    return task


# -- step 4 -----------------------------------------------------------------
def _cut_task(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
    blobs = [_unpack(x, "i8", "u4", "u8", "u8") for x in answers.column("blob").to_pylist()]
    where: dict[tuple[int, int], tuple[int, int]] = {}
    starts = ends = np.zeros(0, np.int64)
    if blobs:
        ids, rows, starts, ends = (np.concatenate([x[k] for x in blobs]) for k in range(4))
        order = np.lexsort((starts, rows, ids))
        ids, rows, starts, ends = ids[order], rows[order], starts[order].astype(np.int64), ends[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1])]))
        where = {(int(ids[a]), int(rows[a])): (a, b) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(ids)])}
    out = []
    for i, number, data in _by_row(texts):
        a, b = where.get((i, number), (0, 0))
        if a == b:
            out.append((i, len(data), 0, 0, data))
            continue
        s, e = starts[a:b], np.maximum.accumulate(ends[a:b])
        begin = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
        s, e = s[begin].tolist(), e[np.append(begin[1:] - 1, len(e) - 1)].tolist()
        kept = b"".join([data[x:y] for x, y in zip([0, *e], [*s, len(data)])])
        out.append((i, len(data), len(data) - len(kept), len(s), kept))
    return pa.table({n: pa.array([r[k] for r in out], t) for k, (n, t) in enumerate(
        (("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())))})


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT,
                    bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary) of every row."""
    ship(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).cast("binary").alias("data"))
    total = docs.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    n = max(1, math.ceil(total / task_bytes(total, bytes_per_task)))  # ranges and buckets
    texts = docs.select(bucket_column(F.col("id"), n).alias("b"), "id", "data")
    hashes = docs.filter(F.col("id").isNotNull()).mapInArrow(_hash_task(n), "r int, docs binary, low binary")
    asked = hashes.groupBy("r").applyInArrow(_repeated_task(n, hot), "b int, blob binary")
    kinds = "to int, b int, blob binary"
    runs = texts.groupBy("b").cogroup(asked.groupBy("b")).applyInArrow(_runs_task(n, n), kinds)
    cover = runs.groupBy("to").applyInArrow(_merge_task(n, n), kinds)
    out = texts.groupBy("b").cogroup(cover.groupBy("b")).applyInArrow(
        _cut_task, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("id", id_col)


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns: the digest of what is left."""
    return without_repeats(df, id_col, text_col).select(
        id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
