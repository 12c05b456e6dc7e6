"""Benchmark decontamination by greedy string tiling (operator 7).

Texts are sequences of lower-cased words; in scripts that are written without
spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese, Tibetan) every character
is a word. Seeds are runs of ``MIN_MATCH``
words that a document shares with a benchmark item: the items' seeds form a
sorted hash table that is broadcast, and each document joins its own seeds to
it by rolling Karp-Rabin hashes. Seeds that follow each other in both texts
make a match. Tiling marks the longest match first, cuts what overlaps marked
words from the rest, and goes on until no unmarked match of ``MIN_MATCH``
words is left. A match uses words of the item and of the document once, in
any order, so reordered passages are covered too. A document is contaminated
if its tiles cover ``MIN_COVERAGE`` of an item's words, or if one tile has
``LONG_TILE`` words. An item with fewer than ``MIN_MATCH`` words is one seed
of its whole length. Such an item ("yes", "New York") is evidence where it is
the whole document; inside a longer one only if it has ``SHORT_CHARS``
characters in its words, which everyday phrases of so few words do not have.

Shared seeds are expanded in pieces of ``PIECE`` pairs and become runs at once,
so a word that an item and a very long document repeat takes memory for its
runs, not for all pairs of places.

The broadcast is bounded: items are dealt to blocks of at most ``BLOCK_BYTES``
of text (a longer item is a block by itself; an item that is given several
times counts once there), and the documents are scanned
once per block. No document is shuffled, and an item that many documents
contain costs no more than a rare one.

Defined cases: NULL or empty texts contain nothing; items without words, NULL
ones included, are no evidence and match nothing;
equal items are reported one by one; repeated rows give repeated result rows;
extra columns are ignored (``contaminated``) or kept (``clean``); ties
between matches go to the earlier place in the item, then in the document.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BASE, U64, arrow_schema, mix, to_batch

#: Shortest match in words; share of an item's words that tiles must cover.
MIN_MATCH, MIN_COVERAGE = 5, 0.5
#: Words of a single tile that is evidence by itself, however long the item.
LONG_TILE = 50
#: Characters that an item of under MIN_MATCH words needs to be evidence inside a longer text.
SHORT_CHARS = 20
#: Pairs of places of shared seeds that are expanded at once.
PIECE = 1 << 20
#: Bytes of item text that are broadcast at once.
BLOCK_BYTES = 4 << 20

NO_SPACES = (
    "\u0e01-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af"
)
WORD = re.compile(rf"[^\W{NO_SPACES}]+|\w")
SCHEMA = "doc_id bigint, item_id bigint, coverage double, matched bigint, tiles bigint, longest bigint"


def rolled(ids: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` ids."""
    k = len(ids) - n + 1
    h = np.zeros(max(k, 0), U64)
    for j in range(n if k > 0 else 0):
        h = h * U64(BASE) + ids[j : j + k]
    return mix(h)


def runs(owner: np.ndarray, item_at: np.ndarray, doc_at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of seeds that follow each other in an item and in the document, joined
    where one ends and the next begins: ``(owner, item place, document place, seeds)``."""
    order = np.lexsort((item_at, doc_at - item_at, owner))
    o, i, d, k = (x[order] for x in (owner, item_at, doc_at, size))
    diagonal = d - i
    new = (o[1:] != o[:-1]) | (diagonal[1:] != diagonal[:-1]) | (i[1:] != i[:-1] + k[:-1])
    first = np.flatnonzero(np.concatenate([[True], new]))
    return o[first], i[first], d[first], np.add.reduceat(k, first)


def tile(found: list[tuple[int, int, int]], n: int, size: int | None = None) -> list[tuple[int, int, int]]:
    """Greedy tiles among the matches: longest first, no word of either text used twice.

    ``size``: words of the item; when all are used, no further tile is possible."""
    heap = [(-length, i, d) for length, i, d in found]
    heapq.heapify(heap)
    in_item: set[int] = set()
    in_doc: set[int] = set()
    tiles = []
    while heap and len(in_item) != size:
        length, i, d = heapq.heappop(heap)
        length = -length
        free = [(i + k) not in in_item and (d + k) not in in_doc for k in range(length)]
        if all(free):
            tiles.append((length, i, d))
            in_item.update(range(i, i + length))
            in_doc.update(range(d, d + length))
            continue
        start = None  # what is left unmarked goes back
        for k, ok in enumerate([*free, False]):
            if ok and start is None:
                start = k
            elif not ok and start is not None:
                if k - start >= n:
                    heapq.heappush(heap, (-(k - start), i + start, d + start))
                start = None
    return tiles


class Items:
    """The seeds of a block of benchmark items, and the search for them in a text."""

    def __init__(self, rows: list[tuple], n: int = MIN_MATCH, coverage: float = MIN_COVERAGE, short_chars: int = SHORT_CHARS):
        """``rows``: ``(item_id, text)``, or with how often the item is given."""
        self.n, self.coverage = n, coverage
        self.number: dict[str, int] = {}
        self.ids, self.sizes, self.times, self.weighty = [], [], [], []
        found: dict[int, list] = {}  # by the length of the seeds
        for item_id, text, *times in rows:
            words = WORD.findall((text or "").lower())
            if not any(w.strip("_") for w in words):
                continue
            length = min(n, len(words))
            h = rolled(np.array([self.number.setdefault(w, len(self.number) + 1) for w in words], U64), length)
            found.setdefault(length, []).append((h, np.full(len(h), len(self.ids)), np.arange(len(h))))
            self.ids.append(item_id)
            self.sizes.append(len(words))
            self.times.append(times[0] if times else 1)
            self.weighty.append(sum(map(len, words)) >= short_chars)
        self.seeds = {}
        for length, parts in sorted(found.items()):
            h, o, p = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            self.seeds[length] = h[order], o[order], p[order]

    def hits(self, text: str | None) -> Iterator[tuple]:
        """``(item_id, coverage, matched words, tiles, longest tile)`` of the items that the text contains."""
        if not text or not self.seeds:
            return
        number = self.number
        ids = np.array([number.get(w, 0) for w in WORD.findall(text.lower())], U64)
        known = np.concatenate([[0], np.cumsum(ids != 0)])
        for length, (hashes, owners, places) in self.seeds.items():
            if len(ids) < length:
                return
            at = np.flatnonzero(known[length:] - known[:-length] == length)  # runs of known words
            if not len(at):
                return
            h = rolled(ids, length)[at]
            if length < self.n:  # whole items
                h = np.unique(h)
                low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
                for a, b in zip(low[high > low], high[high > low], strict=True):
                    for k in owners[a:b]:
                        if self.weighty[k] or len(ids) == length:
                            yield from [(self.ids[k], 1.0, length, 1, length)] * self.times[k]
                continue
            low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            shared = high > low
            if not shared.any():
                return
            yield from self._tiled(*self._runs(owners, places, at[shared], low[shared], high[shared]))

    def _runs(self, owners: np.ndarray, places: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """The runs of the seeds at ``at`` in the document, each shared with the table's places from ``low`` to ``high``."""
        counts = high - low
        piece = (np.cumsum(counts) - counts) // PIECE
        ends = np.flatnonzero(np.diff(piece)) + 1
        parts = []
        for a, c, lo in zip(np.split(at, ends), np.split(counts, ends), np.split(low, ends), strict=True):
            seed = np.repeat(lo, c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            parts.append(runs(owners[seed], places[seed], np.repeat(a, c), np.ones(len(seed), np.int64)))
        return parts[0] if len(parts) == 1 else runs(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    def _tiled(self, owner: np.ndarray, item_at: np.ndarray, doc_at: np.ndarray, seeds: np.ndarray) -> Iterator[tuple]:
        """The hits among the items that own runs of seeds."""
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        for g in np.split(np.arange(len(owner)), first[1:]):
            k = int(owner[g[0]])
            size = self.sizes[k]
            # seeds cover at most n words each: too few of them cannot reach the threshold or make a long tile
            most = int(seeds[g].sum())
            if most * self.n < self.coverage * size and most + self.n - 1 < LONG_TILE:
                continue
            found = list(zip((seeds[g] + self.n - 1).tolist(), item_at[g].tolist(), doc_at[g].tolist(), strict=True))
            tiles = tile(found, self.n, size)
            covered, longest = sum(length for length, _, _ in tiles), max(length for length, _, _ in tiles)
            if covered >= self.coverage * size or longest >= LONG_TILE:
                yield from [(self.ids[k], covered / size, covered, len(tiles), longest)] * self.times[k]


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of a bounded size, one after the other."""
    items = (
        benchmark.select(F.col("item_id").cast("bigint"), "text").where(F.length("text") > 0)
        .groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("times"))
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-2 * size // BLOCK_BYTES) or 1
    for k in range(count):
        own = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield Items(sorted(((r.item_id, r.text, r.times) for r in own.collect()), key=str))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and benchmark item that it contains."""
    out = arrow_schema(SCHEMA)
    found = []
    for items in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                pairs = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                rows = [(doc_id, *hit) for doc_id, text in pairs for hit in shared.value.hits(text)]
                yield to_batch(rows, out)

        found.append(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, SCHEMA))
    return reduce(DataFrame.unionByName, found)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, unchanged."""
    for items in _blocks(benchmark):
        docs = docs.where(_free_of(docs.sparkSession.sparkContext.broadcast(items))("text"))
    return docs


def _free_of(shared):
    @F.arrow_udf("boolean")
    def free(text: pa.Array) -> pa.Array:
        return pa.array([next(shared.value.hits(t), None) is None for t in text.to_pylist()], pa.bool_())

    return free
