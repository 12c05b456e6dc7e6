"""Removal of repeated byte strings by merged Burrows-Wheeler transforms (operator 11).

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier
(smaller doc_id, or same document and earlier start) is removed.

Candidates. A window is a string of ``LENGTH`` bytes; its key is the smallest
hash of its ``GRAM``-byte grams, so equal windows have equal keys. Neighbouring
windows with one key are a run; one that may hold equal windows itself (a text
of short period) is cut in two. Keys that occur in one run only cannot repeat;
the others are found by one shuffle of packed keys. Only their runs go on:
each with its bytes, to the bucket of its key, where all equal windows meet.

Shard transforms. The bytes of a run are read as strings over an alphabet of
``SYMBOL``-byte blocks (one string per phase; a block is a 64-bit hash, which
is a consistent order), so that a window is ``LENGTH / SYMBOL`` symbols. A
shard sorts its suffixes to that depth and keeps their transform: the symbol
before each suffix. Its repeated intervals settle the copies within the shard,
and only the first of equal windows leaves it. So a passage that a third of
all documents share reaches its bucket once per shard, not once per document.

Merge. The transforms of a bucket's shards are merged by iterative interleave
refinement: in each round the interleave, read in order, is dealt by the
symbols before the suffixes, which orders all suffixes by one symbol more;
blocks split where symbols or the blocks behind them differ, and the round in
which a boundary appears is the common prefix there. No suffix is sorted again
against those of other shards. After ``LENGTH / SYMBOL`` rounds each block is
the set of equal windows: all but the first one are repeated.

Texts are shuffled once, by a hash of the row, and meet their candidate runs
and their repeated spans in that layout. Nothing is collected; every task holds
a shard or a bucket of bounded bytes.

Defined cases: a NULL text is empty; texts under ``LENGTH`` bytes keep
everything; a NULL doc_id counts as the last; rows of one doc_id with several
texts stand in the order of a hash of their texts; of equal rows the first is
judged as any text and all bytes of the others are repeated (if there are
``LENGTH`` or more); other columns are ignored; whole texts are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, arrow_schema, hash_runs, mix, saved

#: Bytes of a repeated string, of a symbol of the transform, and of a gram of the candidate search.
LENGTH, SYMBOL, GRAM = 100, 50, 32
#: Bytes (about) of a shard's runs, of those of a bucket, and of the pieces that a bucket sorts by themselves.
SHARD_BYTES, BUCKET_BYTES, PIECE_BYTES = 1 << 19, 1 << 20, 1 << 18
#: Entries of a key bucket (about), and window runs per text byte (about).
BUCKET_ENTRIES, RUNS_PER_BYTE = 500_000, 1 / 30
#: Entries that a task packs at once.
FLUSH_ENTRIES = 250_000
#: Bytes of a text that are hashed at once; a run is cut there, which at most adds candidates.
TEXT_BLOCK = 1 << 18
#: Order of a NULL doc_id.
LAST = (1 << 63) - 1
#: Longest run that one entry tells.
RUN_MAX = 0xFFFF


# ---- candidates (plain functions on arrays) --------------------------------

def window_runs(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and key of the runs of neighbouring windows with one key.

    Equal windows of one run lie a period apart, so the least gram leaves the
    window somewhere and the key stays. A run is cut at the first such place:
    its key then occurs twice.
    """
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    first = np.arange(len(data) - gram + 1)
    grams = hash_runs(data, first, first + gram)
    keys = sliding_min(grams, length - gram + 1)
    stays = keys[1:] == keys[:-1]
    start = np.flatnonzero(np.concatenate([[True], ~stays]))
    again = np.flatnonzero(stays & (grams[: n - 1] == keys[:-1]))
    if len(again):
        of = np.searchsorted(start, again, side="right")
        start = np.sort(np.concatenate([start, again[np.diff(of, prepend=0) > 0] + 1]))
    size = np.diff(np.append(start, n))
    if size.max() > RUN_MAX:  # long runs in pieces
        parts = -(-size // RUN_MAX)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        whole, end = np.repeat(start, parts), np.repeat(start + size, parts)
        start = whole + nth * RUN_MAX
        size = np.minimum(RUN_MAX, end - start)
    return start, size, keys[start]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbouring values, by minima from the left and the right in blocks of that width."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


# ---- transforms (plain functions on arrays) --------------------------------

def sorted_by(values: np.ndarray) -> np.ndarray:
    """Stable order of small non-negative values (below 2**32): value and place in one sorted word."""
    n = len(values)
    bits = U64(max(1, n - 1).bit_length())
    words = (values.astype(U64) << bits) | np.arange(n, dtype=U64)
    words.sort()
    return (words & ((U64(1) << bits) - U64(1))).astype(np.int64)


def ranked(symbols: np.ndarray) -> np.ndarray:
    """Dense ranks of 64-bit symbols, 0 staying 0."""
    return ranks_and_order(symbols)[0]


def ranks_and_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks of 64-bit symbols, 0 staying 0, and the stable order of those that are not 0.

    One sort of (leading bits, place); the few equal leading bits are sorted whole.
    """
    rank = np.zeros(len(symbols), np.int32)
    there = np.flatnonzero(symbols)
    n = len(there)
    if not n:
        return rank, there
    dense = n == len(symbols)
    symbols = symbols if dense else symbols[there]
    bits = U64(max(1, n - 1).bit_length())
    words = (symbols >> bits << bits) | np.arange(n, dtype=U64)
    words.sort()
    order = (words & ((U64(1) << bits) - U64(1))).astype(np.int64)
    words >>= bits
    s = symbols[order]
    new = s[1:] != s[:-1]
    mixed = words[1:][(words[1:] == words[:-1]) & new]
    if len(mixed):
        for prefix in np.unique(mixed):
            here = slice(*np.searchsorted(words, [prefix, prefix + U64(1)]))
            order[here] = order[here][np.argsort(symbols[order[here]], kind="stable")]
            s[here] = symbols[order[here]]
        new = s[1:] != s[:-1]
    if not dense:
        order = there[order]
    rank[order] = np.cumsum(np.append(True, new), dtype=np.int32)
    return rank, order


class Shard:
    """The suffixes of some runs' strings, sorted by ``depth`` symbols, and their transform."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, symbol: int):
        """Runs of ``sizes[i]`` windows whose bytes begin at ``data[starts[i]]``."""
        self.depth = depth = length // symbol
        phases = np.minimum(sizes, symbol)
        run = np.repeat(np.arange(len(sizes)), phases)
        phase = np.arange(phases.sum()) - np.repeat(np.cumsum(phases) - phases, phases)
        windows = -(-(sizes[run] - phase) // symbol)
        items = windows + (depth - 1)  # the windows' suffixes and shorter ones; the empty one is added below
        self.strings = len(items)
        end = np.cumsum(items)
        n = int(end[-1]) if len(end) else 0
        first = starts[run] + phase
        nth = np.arange(n) - np.repeat(end - items, items)
        place = np.repeat(first, items) + nth * symbol
        symbols = hash_runs(data, place, place + symbol) | U64(1)
        rank, by_symbol = ranks_and_order(symbols)
        keys = [rank]
        for _ in range(depth - 1):
            nxt = np.append(keys[-1][1:], np.int32(0)) if n else keys[-1]
            nxt[end - 1] = 0
            keys.append(nxt)
        bits = max(1, n.bit_length())
        if bits * (depth + 1) <= 64:  # all symbols and the place fit one word: one sort
            whole = keys[0].astype(np.int64)
            for key in keys[1:]:
                whole = (whole << bits) | key
            keys = [whole]
            order = sorted_by(whole)
        else:
            order = by_symbol
            for i, key in enumerate(reversed(keys)):
                order = sorted_by(key) if not i else order[sorted_by(key[order])]
        before = np.append(U64(0), symbols[:-1]) if n else symbols
        before[end - items] = 0
        #: symbol before each suffix (0: none), whether it begins a window, and its place in the data; the empty ones come first
        self.transform = np.concatenate([symbols[end - 1], before[order]])
        self.window = np.concatenate([np.zeros(len(items), bool), (nth < np.repeat(windows, items))[order]])
        self.place = np.concatenate([first + items * symbol, place[order]])
        split = np.zeros(len(items) + n, bool)
        split[: 1] = True
        if n:
            split[len(items)] = True
            for key in keys:
                sorted_key = key[order]
                split[len(items) + 1 :] |= sorted_key[1:] != sorted_key[:-1]
        #: intervals of suffixes that are equal to the depth
        self.interval = np.cumsum(split, dtype=np.int32)


def merged(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleave of the shards' suffixes by ``depth`` symbols.

    Returns which suffix (numbered shard after shard, each in its own order)
    stands at each place, the interval of equal ones there, and the symbols
    that it has in common with the one before (``depth``: equal).
    """
    depth = shards[0].depth
    sizes = [len(s.transform) for s in shards]
    offsets = np.cumsum([0, *sizes])
    n = int(offsets[-1])
    small = np.uint8 if len(shards) <= 1 << 8 else np.uint16 if len(shards) <= 1 << 16 else np.int64
    rank, order = ranks_and_order(np.concatenate([s.transform for s in shards]))
    shard = np.repeat(np.arange(len(shards), dtype=small), sizes)
    empties = np.repeat(np.arange(len(shards), dtype=small), [s.strings for s in shards])
    at = None  # the interleave: at first shard after shard, nothing compared yet
    interval = None
    common = np.full(n, depth, np.int16)
    for known in range(depth):
        if at is None:  # suffixes with a symbol before them, by that symbol: the ranks' own order
            before, owner = rank, shard
        else:
            before, owner = rank[at], shard[at]
            there = np.flatnonzero(before)
            order = there[sorted_by(before[there])]
        dealt = np.concatenate([empties, owner[order]])
        split = np.zeros(n, bool)
        b = before[order]
        split[len(empties) + 1 :] = b[1:] != b[:-1]
        if known:
            behind = interval[order]
            split[len(empties) + 1 :] |= behind[1:] != behind[:-1]
        split[len(empties) : len(empties) + 1] = True
        common -= split  # a boundary stays: the rounds that have it are those after the common prefix
        interval = np.cumsum(split, dtype=np.int32)
        at = np.empty(n, np.int32 if n < 1 << 31 else np.int64)
        if len(shards) <= 16:  # each shard's places, in turn
            for i in range(len(shards)):
                at[dealt == small(i)] = np.arange(offsets[i], offsets[i + 1], dtype=at.dtype)
        else:
            at[np.argsort(dealt, kind="stable")] = np.arange(n, dtype=at.dtype)
    return at, interval, common


def later_ones(interval: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Of suffixes in the order of their intervals: whether another one of the interval has a smaller key."""
    if not len(interval):
        return np.zeros(0, bool)
    first = np.flatnonzero(np.append(True, interval[1:] != interval[:-1]))
    return key != np.repeat(np.minimum.reduceat(key, first), np.diff(np.append(first, len(key))))


def marked_runs(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of marked places."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2] - edge[::2]


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of the ranges, one after the other."""
    before = np.cumsum(sizes) - sizes
    return data[np.arange(sizes.sum()) + np.repeat(starts - before, sizes)]


def by_row_order(ids: np.ndarray, refs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Order of runs by doc_id, row and start."""
    return np.lexsort((starts, refs, ids))


# ---- Spark stages ----------------------------------------------------------

KEYS = "bucket int, alone int, several int, keys binary, refs binary, starts binary, sizes binary"
RUNS = "ref bigint, start int, size int, key int"


def _entries(rows: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """Runs of windows, packed by bucket: those whose key stands alone in the batch, the first ones of the other keys, the rest.

    The first two kinds go to the key's bucket. The rest are known to repeat and are dealt by their row.
    """
    out = arrow_schema(KEYS)

    def flush(found: list[tuple]) -> pa.RecordBatch:
        refs = np.repeat(np.array([r for r, *_ in found], np.int64), [len(s) for _, s, *_ in found])
        starts, sizes, keys = (np.concatenate([f[i] for f in found]) for i in (1, 2, 3))
        order = np.argsort(keys, kind="stable")
        same = np.diff(keys[order].view(np.int64)) == 0
        head = np.concatenate([[True], ~same])
        several = np.zeros(len(order), bool)
        several[1:] |= same
        several[:-1] |= same
        kind = np.empty(len(order), np.int64)
        kind[order] = np.where(head, several, 2)
        # a key is the smallest of many hashes: by its size almost all would stand in the first buckets
        dealt_by = np.where(kind < 2, keys, refs.view(U64))
        bucket = (mix(dealt_by) % U64(buckets)).astype(np.int64)
        place = sorted_by(bucket * 3 + kind)
        bucket, kind = bucket[place], kind[place]
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        counts = [np.add.reduceat(kind == k, first, dtype=np.int32) if len(first) else first for k in (0, 1)]
        cols = [keys[place].astype("<u8"), refs[place], starts[place].astype(np.int32), sizes[place].astype(np.uint16)]
        parts = [[x.tobytes() for x in np.split(c, first[1:])] if len(first) else [] for c in cols]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in (bucket[first], *counts)), *(pa.array(p, pa.binary()) for p in parts)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, entries = [], 0
            texts = b.column(1).cast(pa.large_binary())
            bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1].tolist()
            every = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            for ref, (begin, end) in zip(b.column(0).to_pylist(), pairwise(bounds), strict=True):
                data = every[begin:end]
                for at in range(0, max(0, len(data) - length + 1), TEXT_BLOCK):
                    start, size, key = window_runs(data[at : at + TEXT_BLOCK + length - 1], length, gram)
                    found.append((ref, start + at, size, key))
                    entries += len(start)
                    if entries >= FLUSH_ENTRIES:
                        yield flush(found)
                        found, entries = [], 0
            if found:
                yield flush(found)

    return rows.select("ref", "text").mapInArrow(run, KEYS)


def _unpacked(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _repeated(table: pa.Table) -> pa.Table:
    """The runs of a bucket whose key occurs in several of them."""
    keys, refs = _unpacked(table["keys"], U64), _unpacked(table["refs"], np.int64)
    starts, sizes = _unpacked(table["starts"], np.int32), _unpacked(table["sizes"], np.uint16)
    alone, several = table["alone"].to_numpy(), table["several"].to_numpy()
    rest = np.array([len(x) // 8 for x in table["keys"].to_pylist()]) - alone - several
    known = np.repeat(np.tile(np.array([0, 1, 2], np.int8), len(rest)), np.stack([alone, several, rest], axis=1).ravel())
    order = np.argsort(keys, kind="stable")
    shared = np.zeros(len(keys), bool)
    here = known[order] < 2  # the others are known, and may stand in any bucket
    k = keys[order][here]
    same = np.zeros(len(k), bool)
    same[1:] |= k[1:] == k[:-1]
    same[:-1] |= k[1:] == k[:-1]
    shared[order[here]] = same
    keep = shared | (known > 0)
    cols = [refs[keep], starts[keep], sizes[keep].astype(np.int32), (keys[keep] & U64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)]
    return pa.Table.from_arrays([pa.array(c) for c in cols], schema=arrow_schema(RUNS))


SEGMENTS = "bucket int, ref bigint, id bigint, start int, size int, bytes binary"
SPANS = "ref bigint, id bigint, start int, size int"


def _rows(bucket: np.ndarray, refs: np.ndarray, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, data: np.ndarray, at: np.ndarray, span: np.ndarray) -> pa.RecordBatch:
    """One row per run, with its ``span[i]`` bytes from ``data[at[i]]`` on."""
    raw = gathered(data, at, span)
    ends = np.append(0, np.cumsum(span)).astype(np.int32)
    bytes_ = pa.Array.from_buffers(pa.binary(), len(span), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])
    cols = [bucket.astype(np.int32), refs, ids, starts.astype(np.int32), sizes.astype(np.int32)]
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in cols), bytes_], schema=arrow_schema(SEGMENTS))


def _settled(data: np.ndarray, at: np.ndarray, refs, ids, starts, sizes, keys, buckets: int, length: int, symbol: int) -> Iterator[pa.RecordBatch]:
    """A shard's runs (in row order; bytes from ``data[at]`` on): spans that it settles, and its first windows."""
    span = sizes + length - 1
    own = gathered(data, at, span)
    base = np.cumsum(span) - span
    shard = Shard(own, base, sizes, length, symbol)
    place = shard.place[shard.window]
    later = later_ones(shard.interval[shard.window], place)  # places stand in row order
    for which, kept in ((later, False), (~later, True)):
        mark = np.zeros(len(own), bool)
        mark[place[which]] = True
        where, n = marked_runs(mark)
        run = np.searchsorted(base, where, side="right") - 1
        hashed = keys[run] if kept else refs[run]  # settled spans are dealt evenly
        bucket = (mix(hashed.view(U64).copy()) % U64(buckets)).astype(np.int64)
        taken = n + length - 1 if kept else np.zeros(len(n), np.int64)
        yield _rows(bucket, refs[run], ids[run], starts[run] + where - base[run], n, own, where, taken)


def _segments(found: DataFrame, buckets: int, length: int, symbol: int) -> DataFrame:
    """Runs of each shard's first windows with their bytes; rows without bytes are spans that a shard settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(1).fill_null(LAST).to_numpy()
            texts = b.column(2).cast(pa.large_binary())
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            lists = b.column(3)
            count = np.diff(lists.offsets.to_numpy())
            doc = np.repeat(np.arange(len(ids)), count)
            start, size, key = (lists.flatten().field(c).to_numpy().astype(np.int64) for c in ("start", "size", "key"))
            fits = bounds[doc] + start + size + length - 1 <= bounds[doc + 1]  # else of another text with this hash
            doc, start, size, key = doc[fits], start[fits], size[fits], key[fits]
            refs, ids = b.column(0).to_numpy()[doc], ids[doc]
            shard = (np.cumsum(size + length - 1) - 1) // SHARD_BYTES
            for i in range(int(shard[-1]) + 1 if len(shard) else 0):
                own = np.flatnonzero(shard == i)
                if len(own):
                    own = own[by_row_order(ids[own], refs[own], start[own])]
                    yield from _settled(data, bounds[doc[own]] + start[own], refs[own], ids[own], start[own], size[own], key[own], buckets, length, symbol)

    return found.select("ref", "doc_id", "text", "runs").mapInArrow(run, SEGMENTS)


def _spans(length: int, symbol: int):
    """Repeated windows of a bucket, by the merged transforms of its shards (its runs in pieces of ``PIECE_BYTES``)."""

    def run(table: pa.Table) -> pa.Table:
        refs, ids, starts, sizes = (table[c].to_numpy().astype(np.int64) for c in ("ref", "id", "start", "size"))
        raw = pa.concat_arrays([c.cast(pa.large_binary()) for c in table["bytes"].chunks])
        bounds = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        open_ = np.diff(bounds) > 0
        done = [(refs[~open_], ids[~open_], starts[~open_], sizes[~open_])]
        refs, ids, starts, sizes = (c[open_] for c in (refs, ids, starts, sizes))
        if len(refs):
            span = sizes + length - 1
            base = np.cumsum(span) - span
            piece = base // PIECE_BYTES
            cuts = np.append(np.flatnonzero(np.diff(piece, prepend=-1)), len(refs))
            edges = np.append(base, len(data))[cuts]
            shards = [Shard(data[a:b], base[i:j] - a, sizes[i:j], length, symbol) for (i, j), (a, b) in zip(pairwise(cuts), pairwise(edges), strict=True)]
            at, interval, _ = merged(shards)
            window = np.flatnonzero(np.concatenate([s.window for s in shards])[at])
            place, interval = np.concatenate([s.place + a for s, a in zip(shards, edges[:-1], strict=True)])[at[window]], interval[window]
            several = np.zeros(len(place), bool)
            several[1:] = interval[1:] == interval[:-1]
            several[:-1] |= several[1:]
            place, interval = place[several], interval[several]
            order = by_row_order(ids, refs, starts)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            # a place's order: its run's rank, then its start in the run
            later = later_ones(interval, np.repeat((rank << 32) - base, span)[place] + place)
            mark = np.zeros(len(data), bool)
            mark[place[later]] = True
            where, n = marked_runs(mark)
            of = np.searchsorted(base, where, side="right") - 1
            done.append((refs[of], ids[of], starts[of] + where - base[of], n))
        cols = [np.concatenate([d[i] for d in done]).astype(t) for i, t in enumerate((np.int64, np.int64, np.int32, np.int32))]
        return pa.Table.from_arrays([pa.array(c) for c in cols], schema=arrow_schema(SPANS))

    return run


RESULT = "ref bigint, doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def kept_bytes(text: bytes, spans: list[tuple[int, int]], length: int) -> tuple[list[tuple[int, int]], bytes]:
    """The union of the windows' bytes as maximal spans, and what is left of the text."""
    union: list[tuple[int, int]] = []
    for start, size in sorted(spans):
        end = start + size + length - 1
        if union and start <= union[-1][1]:
            union[-1] = (union[-1][0], max(end, union[-1][1]))
        else:
            union.append((start, end))
    left, at = [], 0
    for start, end in union:
        left.append(text[at:start])
        at = end
    left.append(text[at:])
    return union, b"".join(left)


def _kept(rows: DataFrame, length: int) -> DataFrame:
    out = arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for ref, doc_id, text, spans in zip(*(c.to_pylist() for c in (b.column(0), b.column(1), b.column(2).cast(pa.large_binary()), b.column(3))), strict=True):
                own = LAST if doc_id is None else doc_id
                union, left = kept_bytes(text, [(s["start"], s["size"]) for s in spans or [] if s["id"] == own], length)
                got.append((ref, doc_id, len(text), len(text) - len(left), len(union), hashlib.sha256(left).hexdigest()))
            cols = zip(*got, strict=True) if got else [[]] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out, strict=True)], schema=out)

    return rows.mapInArrow(run, RESULT)


def without_repeats(docs: DataFrame, length: int = LENGTH, symbol: int = SYMBOL, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``."""
    if length % symbol or not 0 < gram <= length:
        raise ValueError("a window must be whole symbols, and hold a gram")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint"), text.alias("text")).withColumn("ref", F.xxhash64("doc_id", "text"))
    again = saved(rows.groupBy("ref", "doc_id").agg(F.count("*").alias("copies")).where("copies > 1"), "again")
    repeats = again.limit(1).count() > 0
    if repeats:  # one of each equal rows
        equal = rows.join(again.select("ref"), "ref", "left_semi").groupBy("ref", "doc_id").agg(F.min("text").alias("text"))
        rows = rows.join(again.select("ref"), "ref", "left_anti").unionByName(equal)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.select("ref", "doc_id", "text")

    key_buckets = max(8, int(size * RUNS_PER_BYTE) // BUCKET_ENTRIES)
    runs = saved(_entries(rows, key_buckets, length, gram).groupBy("bucket").applyInArrow(_repeated, RUNS), "runs")
    moved = runs.agg(F.sum(F.col("size") + (length - 1))).first()[0] or 0
    buckets = max(8, int(moved) // BUCKET_BYTES)
    per_text = runs.groupBy("ref").agg(F.collect_list(F.struct("start", "size", "key")).alias("runs"))
    # the texts' shuffle is the same in both joins: Spark reads it twice
    found = rows.join(per_text, "ref")
    spans = _segments(found, buckets, length, symbol).groupBy("bucket").applyInArrow(_spans(length, symbol), SPANS)
    per_text = spans.groupBy("ref").agg(F.collect_list(F.struct("id", "start", "size")).alias("spans"))
    result = _kept(rows.join(per_text, "ref", "left").select("ref", "doc_id", "text", "spans"), length)
    if repeats:
        counted = again.select("ref", F.col("doc_id").alias("id"), "copies")
        result = result.join(counted, (result.ref == counted.ref) & result.doc_id.eqNullSafe(counted.id), "left").drop(counted.ref)
        result = result.withColumn("copy", F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)).cast("int"))))
        whole = (F.col("copy") > 1) & (F.col("n_bytes") >= length)
        result = result.withColumns({
            "n_removed": F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")),
            "n_spans": F.when(whole, F.lit(1)).otherwise(F.col("n_spans")),
            "kept_sha256": F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")),
        })
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
