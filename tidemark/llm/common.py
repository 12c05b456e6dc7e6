"""Shared helpers of the training-data operators: storage, whole-text Arrow maps, word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import shared_dir

U64 = np.uint64
#: Odd multiplier of the rolling byte hash, its inverse modulo 2**64, and odd mixing constants.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
#: Texts are hashed in blocks of about this many bytes, so that the arrays stay in cache.
BLOCK_BYTES = 1 << 18


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table that every executor sees; a lost executor
    costs no recomputation of what is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow form of a flat column list such as ``"doc_id bigint, text string"`` (usable in workers)."""
    return pa.schema([(name, ARROW[kind]) for name, kind in (c.split() for c in ddl.split(","))])


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def map_rows(df: DataFrame, columns: list[str], fn: Callable[..., tuple], schema: str) -> DataFrame:
    """Stream the rows through ``fn(*values) -> tuple`` in Arrow batches (bounded by the batch size)."""
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield to_batch([fn(*v) for v in zip(*(c.to_pylist() for c in batch.columns), strict=True)], out)

    return df.select(*columns).mapInArrow(run, schema)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of a splittable generator), in place."""
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


class _Powers:
    """Powers of BASE and of its inverse, grown on demand up to the longest block seen."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, BLOCK_BYTES + 1)
            self.up, self.down = (
                np.concatenate([[U64(1)], np.cumprod(np.full(n - 1, b, U64), dtype=U64)]) for b in (BASE, BASE_INV)
            )
        return self.up[:n], self.down[:n]


_powers = _Powers()


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run ``data[starts[i]:ends[i]]`` of bytes or hashes; equal runs give equal hashes."""
    up, down = _powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=total[1:], dtype=U64)
    h = (total[ends] - total[starts]) * down[starts]
    h += (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)
    return mix(h)


def word_hashes(texts: list[bytes | None]) -> Iterator[list[np.ndarray]]:
    """For blocks of whole texts: the word hashes of each text, in order.

    Words are runs of bytes other than space and 9-13; A-Z are lower-cased.
    A NULL text has no words. A text longer than a block is a block of its own.
    """
    block: list[bytes] = []
    size = 0
    for t in texts:
        t = t or b""
        if block and size + len(t) > BLOCK_BYTES:
            yield _block_hashes(block)
            block, size = [], 0
        block.append(t)
        size += len(t) + 1
    if block:
        yield _block_hashes(block)


def _block_hashes(block: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(block) + b" ", np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    hashes = hash_runs(data, starts, ends)
    bounds = np.cumsum([len(t) + 1 for t in block])[:-1]
    return np.split(hashes, np.searchsorted(starts, bounds))


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles of a text.

    Fewer than ``n`` words: the whole sequence as one shingle; no words: empty.
    """
    k = len(words)
    if k == 0:
        return np.zeros(0, U64)
    w = min(k, n)
    h = np.full(k - w + 1, w, U64)
    for j in range(w):
        h = h * U64(BASE) + words[j : k - w + 1 + j]
    return np.unique(mix(h))


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()
