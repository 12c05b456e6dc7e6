"""Lempel-Ziv phrase fingerprints (operator 1).

A text is a sequence of symbols: its words, long ones in pieces. It is parsed
into dictionary phrases: each phrase is the shortest run of symbols not seen
as a phrase before. The set of phrases is hashed and
kept as a one-permutation minimum-hash signature of ``BINS`` bins with one
byte each; an empty bin borrows from the next filled one, shifted by the
distance. The share of equal bins, corrected for chance, estimates the
Jaccard likeness of two phrase sets, which follows how well one text would
compress with the other's dictionary.

``edit_neighbours`` compares each document with the next one in descending
(doc_id, text hash) order. It range-partitions the documents once by that
order, so the next document is the next row of the same partition; only the
last row of a partition needs the first row of the next one, and these (two
rows per partition) are joined afterwards.

Defined cases: a NULL text counts as empty; a text without words has the empty
fingerprint, likeness 1 to another such text and 0 to any other; repeated
rows are documents of their own, next to each other; a NULL doc_id sorts
last; a table of one row is its own next document; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import U64, arrow_schema, hash_runs, saved, to_batch

#: Bins of a signature (a power of two); each holds one byte, two hex digits.
BINS = 256
#: Longest symbol in bytes; parses scripts without spaces too.
PIECE = 8
BIN_SHIFT = U64(64 - BINS.bit_length() + 1)


def symbols(data: bytes) -> np.ndarray:
    """Hashes of the symbols of a text: its words (runs free of ASCII white space), cut every ``PIECE`` bytes."""
    raw = np.frombuffer(data, np.uint8)
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    pieces = -(-(ends - starts) // PIECE)
    if len(pieces) and pieces.max() > 1:
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + nth * PIECE
        ends = np.minimum(starts + PIECE, np.repeat(ends, pieces))
    return hash_runs(raw, starts, ends)


def phrase_ends(ids: list[int], kinds: int) -> list[int]:
    """End offsets of the phrases of a symbol sequence; an incomplete last phrase counts too."""
    child: dict[int, int] = {}
    get = child.get
    ends: list[int] = []
    node = made = 0
    for at, symbol in enumerate(ids, 1):
        key = node * kinds + symbol
        node = get(key, 0)
        if not node:
            made += 1
            child[key] = made
            ends.append(at)
    if node:
        ends.append(len(ids))
    return ends


def signature(data: bytes) -> bytes:
    """Minimum-hash signature of the phrase set: ``BINS`` bytes, or none for a text without words."""
    parts = symbols(data)
    if not len(parts):
        return b""
    kinds, ids = np.unique(parts, return_inverse=True)
    ends = np.array(phrase_ends(ids.tolist(), len(kinds)), np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    h = np.sort(hash_runs(parts, starts, ends))
    filled, first = np.unique((h >> BIN_SHIFT).astype(np.int64), return_index=True)
    low = (h[first] & U64(0xFF)).astype(np.int64)
    bins = np.arange(BINS)
    at = np.searchsorted(filled, bins)
    distance = np.where(at < len(filled), filled[at % len(filled)] - bins, filled[0] + BINS - bins)
    return ((low[at % len(filled)] + 89 * distance) % 256).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard likeness of two signatures, 0 to 1."""
    if not a or not b:
        return float(a == b)
    same = np.count_nonzero(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)) / BINS
    return max(0.0, (same - 1 / 256) / (1 - 1 / 256))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many leading code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(doc_id, text: str, own: bytes, following: str, theirs: bytes) -> tuple:
    new = edited(text, following)
    print_new = own if new == text else signature(new.encode())
    return doc_id, len(text), hashlib.sha256(new.encode()).digest(), own, print_new, likeness(own, print_new), likeness(own, theirs)


#: Hashes stay binary in the checkpoint folder: half the size of their hex form.
FIELDS = "doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
HASHES = ("edited_sha256", "fingerprint", "edited_fingerprint")
#: Rows without a result yet: the first and last row of each partition, with their texts.
SCHEMA = FIELDS + ", part int, edge string, text string"
#: Result rows per output batch.
BATCH = 2000


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = arrow_schema(SCHEMA)
    part = TaskContext.get().partitionId()
    rows: list[tuple] = []
    last = None

    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            own = signature(text.encode())
            if last is None:
                rows.append((doc_id, *[None] * 6, part, "first", text))
            else:
                rows.append((*_compared(*last, text, own), part, None, None))
            last = doc_id, text, own
            if len(rows) >= BATCH:
                yield to_batch(rows, out)
                rows.clear()
    if last is not None:
        rows.append((last[0], *[None] * 6, part, "last", last[1]))
    if rows:
        yield to_batch(rows, out)


def edit_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    done = saved(sorted_rows.mapInArrow(_neighbours, SCHEMA), "fingerprints")

    # two rows per partition are left: its last row needs the next partition's first
    edges = done.where("edge IS NOT NULL")
    w = Window.orderBy("part")
    links = (
        edges.where("edge = 'first'").select("part").withColumn("following", F.lead("part").over(w))
        .select("part", F.coalesce("following", F.min("part").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("following"))
    )
    first = edges.where("edge = 'first'").select(F.col("part").alias("following"), F.col("text").alias("next_text"))
    pairs = edges.where("edge = 'last'").select("part", "doc_id", "text").join(links, "part").join(first, "following")
    closed = pairs.select("doc_id", "text", "next_text").mapInArrow(_close, FIELDS)
    both = done.where("edge IS NULL").drop("part", "edge", "text").unionByName(closed)
    return both.withColumns({c: F.lower(F.hex(c)) for c in HASHES})


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = arrow_schema(FIELDS)
    for b in batches:
        for doc_id, text, following in zip(*(c.to_pylist() for c in b.columns), strict=True):
            row = _compared(doc_id, text, signature(text.encode()), following, signature(following.encode()))
            yield to_batch([row], out)
