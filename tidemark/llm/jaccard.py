"""N-gram Jaccard join by universe partition and the pigeonhole principle (operator 8).

A document is the set of its distinct ``n``-word shingles, as 64-bit hashes.
Documents with the same set are one node (its id is the set's hash), so exact
copies cost nothing later. Two sets of sizes a <= b with Jaccard >= t differ
in at most (a + b)(1 - t)/(1 + t) tokens.

Index. Sizes fall into bands [L, U]; a set is indexed in its own band and in
the next one if t * L' <= size, so a linked pair meets in the band of its
larger set, where at most H = 2U(1 - t)/(1 + t) tokens differ. In a band the
universe of tokens is cut by hash into m = 2H + 1 segments: at least m - H of
a linked pair are equal. Small bands (H = 1) index the whole set and its
one-deletion neighbourhood instead; H = 0 allows equal sets only.

Cost-based allocation. A set indexes only its H + 1 cheapest filled segments.
A segment costs as much as its rarest token is frequent; the order of cost
(frequency class, then hash) is the same for all sets. If k segments of a set
are filled, e = m - k are empty and at least c = m - H - e of the equal ones
of any link are filled, so the first k - c + 1 = H + 1 of both sides in that
order have one in common: frequent passages are indexed only by sets that
have little else. Frequencies are counted over all documents (batch counts of
``BATCH_COUNT`` or more, added up); tokens missing from them count as rare.
They change the cost, never the result. (A set with m - H empty segments or
more indexes all segments, the empty ones too.)

Search. The segments' hashes go to buckets in packed arrays (one shuffle); a
bucket groups equal hashes. Links are then found in four phases, each
verified exactly on the whole sets: every node against the leader (smallest
node) that it shares most segments with; against its other leaders; in large
groups that still hold several components, each node against two neighbours
by chance; and at last, in every group that still holds several components,
all pairs of different components, so that no link can be missed.
A group of near copies costs about its size in pairs, not its square: once
two nodes are connected, their pair need not be tested. A parity bitmap of
each set gives a lower bound of the difference that spares most sets the trip
to a verification. Components come from minimum labels with pointer jumping;
every step is a Spark join over tables in the checkpoint folder.

Defined cases: NULL or wordless texts have an empty set and are linked with
nothing; fewer than ``n`` words count as one shingle; repeated rows (equal
doc_id) give repeated result rows with one component; a row with a NULL doc_id
links others as any row and has the smallest doc_id that it reaches, NULL if
there is none; extra columns are ignored; whole texts are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BASE, U64, arrow_schema, binary_column, mix, saved, shingle_set, word_hashes

#: Words of a shingle and the similarity of a link, as a fraction.
SHINGLE_WORDS = 5
THRESHOLD = (80, 100)
#: Ratio of a band's largest to its smallest size.
BAND_RATIO = 1.5
#: Sets of a batch that share a token, from which on it is reported as frequent; the most frequent that are broadcast.
BATCH_COUNT, FREQUENT_TOKENS = 2, 1 << 18
#: Rows of a group of equal entries from which on neighbours in it are tried before all pairs.
LARGE_GROUP = 8
#: Ids that are broadcast at most (32 MB).
BROADCAST_IDS = 1 << 22
#: Rows of groups that are compared in one piece of work (about).
BUCKET_ROWS = 20_000
#: Index entries of a bucket (about) and per text byte (at most about).
BUCKET_ENTRIES, ENTRIES_PER_BYTE = 500_000, 0.12

#: Bytes of a token's hash that the verification compares: two sets of a thousand tokens differ by a chance of 4e-9 from whole hashes.
TOKEN_BYTES = 6

MASK = (1 << 64) - 1


# ---- sets, bands and index entries (plain functions on arrays) -------------

def node_of(tokens: np.ndarray) -> int:
    """Signed 64-bit hash of a token set."""
    s = BASE * len(tokens) + int(np.sum(mix(tokens ^ U64(BASE)), dtype=U64))
    return int(mix(np.array([s & MASK], U64)).view(np.int64)[0])


def max_difference(total: int, threshold: tuple[int, int]) -> int:
    """Most tokens in which two sets of ``total`` tokens together differ if they are linked."""
    num, den = threshold
    return total * (den - num) // (den + num)


@lru_cache(maxsize=65536)
def bands_of(size: int, threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """``(band number, H)`` of the bands in which a set of this size is indexed."""
    num, den = threshold
    out, k, low = [], 0, 1
    while num * low <= den * size:
        high = max(low, int(low * BAND_RATIO))
        if high >= size:
            out.append((k, max_difference(2 * high, threshold)))
        k, low = k + 1, high + 1
    return out


class Frequencies:
    """Frequency class (log2 of the count) of the frequent tokens; 0 for all others."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens = tokens[order]
        self.classes = (np.log2(np.maximum(counts[order], 1)).astype(np.int64) + 1).astype(np.uint8)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.uint8)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.classes[at], 0).astype(np.uint8)


def entries(tokens: np.ndarray, threshold: tuple[int, int], frequencies: Frequencies) -> Iterator[np.ndarray]:
    """Index entries of a set: per band the hashes of its cheapest segments."""
    for band, h in bands_of(len(tokens), threshold):
        if h == 0:
            continue
        salt = U64(0xC2B2AE3D27D4EB4F * (band + 1) & MASK)
        spread = mix(tokens ^ salt)
        if h == 1:  # the whole set and its one-deletion neighbourhood
            total = np.sum(spread, dtype=U64)
            yield mix(np.append(total - spread, total) ^ salt)
            continue
        m = 2 * h + 1
        segment = ((spread >> U64(32)) % U64(m)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        segment = segment[order]
        first = np.flatnonzero(np.diff(segment, prepend=-1))
        filled = segment[first]
        sums = np.add.reduceat(spread[order], first)
        cost = np.minimum.reduceat(frequencies.of(tokens)[order], first)
        if m - len(filled) >= m - h:  # equal segments might all be empty: they take part
            all_sums = np.zeros(m, U64)
            all_sums[filled] = sums
            yield mix(all_sums + salt * (np.arange(m, dtype=U64) + U64(2)))
            continue
        hashes = mix(sums + salt * (filled.astype(U64) + U64(2)))
        yield hashes[np.lexsort((hashes, cost))[: h + 1]]


def parity(tokens: np.ndarray) -> bytes:
    """Parity bitmap of a set: bit i tells whether an odd number of tokens falls on i."""
    bits = max(256, 1 << (max(1, len(tokens)) - 1).bit_length())
    count = np.bincount((tokens >> U64(7)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8)).tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """A lower bound of the tokens in which two sets differ."""
    x, y = (np.unpackbits(np.frombuffer(v, np.uint8)) for v in (a, b))
    if len(x) < len(y):
        x, y = y, x
    return int(np.count_nonzero(np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0) ^ y))


def stored(tokens: np.ndarray) -> bytes:
    """A sorted set with ``TOKEN_BYTES`` leading bytes per token."""
    return tokens.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES].tobytes()


def loaded(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BYTES)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, :TOKEN_BYTES] = raw
    return full.view(">u8").ravel().astype(U64)


def is_link(a: np.ndarray, b: np.ndarray, threshold: tuple[int, int]) -> bool:
    both = np.sort(np.concatenate([a, b]))
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    num, den = threshold
    return common > 0 and den * common >= num * (len(both) - common)


# ---- Spark stages ----------------------------------------------------------

def _sets(batch: pa.RecordBatch, n: int) -> Iterator[np.ndarray]:
    for block in word_hashes(binary_column(batch, "text")):
        for words in block:
            yield shingle_set(words, n)


def shingle_nodes(docs: DataFrame, n: int = SHINGLE_WORDS) -> tuple[DataFrame, Frequencies]:
    """``doc_id, n_shingles, node`` per row (the node is NULL for an empty set), and the frequent tokens."""
    schema = "doc_id bigint, n_shingles bigint, node bigint, token bigint, times bigint"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, nodes, distinct = [], [], {}
            for s in _sets(b, n):
                sizes.append(len(s))
                nodes.append(node_of(s) if len(s) else None)
                distinct[nodes[-1]] = s
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), none, none], schema=out)
            tokens, times = np.unique(np.concatenate([np.zeros(0, U64), *distinct.values()]), return_counts=True)
            often = times >= BATCH_COUNT
            none = pa.nulls(int(often.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(tokens[often].view(np.int64)), pa.array(times[often])], schema=out)

    rows = saved(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema), "nodes")
    frequent = rows.where("token IS NOT NULL").groupBy("token").agg(F.sum("times").alias("times"))
    top = frequent.orderBy(F.desc("times"), "token").limit(FREQUENT_TOKENS).toArrow()
    frequencies = Frequencies(top["token"].to_numpy().view(U64), top["times"].to_numpy())
    return rows.where("token IS NULL").drop("token", "times"), frequencies


def _packed(docs: DataFrame, n: int, threshold: tuple[int, int], buckets: int, frequencies: Frequencies) -> DataFrame:
    """Index entries packed by bucket: 6-byte hashes and nodes of up to about a million entries."""
    schema = "bucket int, hashes binary, nodes binary"
    out = arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(frequencies)

    def pack(own: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
        h = np.concatenate([x for x, _ in own])
        v = np.repeat(np.array([node for _, node in own], np.int64), [len(x) for x, _ in own])
        bucket = ((h >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        cols = [h[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6], v[order]]
        parts = [[x.tobytes() for x in np.split(c, first[1:])] for c in cols]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int32()), *(pa.array(p, pa.binary()) for p in parts)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: set[int] = set()
            own, size = [], 0
            for s in _sets(b, n):
                node = node_of(s)
                if node in seen:
                    continue
                seen.add(node)
                for hashes in entries(s, threshold, shared.value):
                    own.append((hashes, node))
                    size += len(hashes)
                if size >= BUCKET_ENTRIES:
                    yield pack(own)
                    own, size = [], 0
            if own:
                yield pack(own)

    return docs.select("text").mapInArrow(run, schema)


GROUPS = "hash bigint, node bigint, leader bigint"


def _groups(table: pa.Table) -> pa.Table:
    """The entries of one bucket whose hash occurs with several nodes."""
    raw = np.frombuffer(b"".join(table["hashes"].to_pylist()), np.uint8).reshape(-1, 6)
    h = np.zeros((len(raw), 8), np.uint8)
    h[:, :6] = raw
    h = h.view("<u8").ravel()
    v = np.frombuffer(b"".join(table["nodes"].to_pylist()), np.int64)
    order = np.argsort(h, kind="stable")
    h = h[order]
    shared = np.zeros(len(h), bool)  # hashes that occur once go first: most do
    shared[1:] = h[1:] == h[:-1]
    shared[:-1] |= shared[1:]
    h, order = h[shared], order[shared]
    v = v[order]
    order = np.lexsort((v, h))
    h, v = h[order], v[order]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (v[1:] == v[:-1])
    h, v = h[~again], v[~again]
    first = np.flatnonzero(np.diff(h, prepend=h[:1] + U64(1))) if len(h) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(h)))
    size, leader = np.repeat(sizes, sizes), np.repeat(v[first], sizes)
    keep = size > 1
    bucket = int(table["bucket"][0].as_py()) if len(table) else 0
    name = (h | U64((bucket & 0xFFFF) << 48)).view(np.int64)
    cols = [name[keep], v[keep], leader[keep]]
    return pa.Table.from_arrays([pa.array(c) for c in cols], schema=arrow_schema(GROUPS))


def candidate_groups(docs: DataFrame, n: int, threshold: tuple[int, int], frequencies: Frequencies) -> DataFrame:
    """Groups of nodes with an equal index entry, in the checkpoint folder."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, int(size * ENTRIES_PER_BYTE) // BUCKET_ENTRIES)
    return saved(_packed(docs, n, threshold, buckets, frequencies).groupBy("bucket").applyInArrow(_groups, GROUPS), "groups")


def _token_sets(docs: DataFrame, n: int) -> DataFrame:
    schema = "node bigint, size int, tokens binary, bitmap binary"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(_sets(b, n))
            cols = [[node_of(s) for s in sets], [len(s) for s in sets], [stored(s) for s in sets], [parity(s) for s in sets]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out, strict=True)], schema=out)

    return docs.select("text").mapInArrow(run, schema)


def _near(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs ``a, b`` that sizes and parity bitmaps do not rule out."""
    num, den = threshold

    @F.arrow_udf("boolean")
    def possible(x: pa.Array, y: pa.Array, total: pa.Array) -> pa.Array:
        rows = zip(x.to_pylist(), y.to_pylist(), total.to_pylist(), strict=True)
        return pa.array([differing_bits(a, b) <= max_difference(n, threshold) for a, b, n in rows], pa.bool_())

    brief = sets.select("node", "size", "bitmap")
    both = (
        pairs.join(brief.toDF("a", "size_a", "bitmap_a"), "a").join(brief.toDF("b", "size_b", "bitmap_b"), "b")
        .where((num * F.col("size_a") <= den * F.col("size_b")) & (num * F.col("size_b") <= den * F.col("size_a")))
    )
    return both.where(possible("bitmap_a", "bitmap_b", F.col("size_a") + F.col("size_b"))).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The linked ones of the pairs ``a, b``, by their whole token sets."""

    @F.arrow_udf("boolean")
    def linked(x: pa.Array, y: pa.Array) -> pa.Array:
        rows = zip(x.to_pylist(), y.to_pylist(), strict=True)
        return pa.array([is_link(loaded(a), loaded(b), threshold) for a, b in rows], pa.bool_())

    whole = sets.select("node", "tokens")
    both = pairs.join(whole.toDF("a", "tokens_a"), "a").join(whole.toDF("b", "tokens_b"), "b")
    return both.where(linked("tokens_a", "tokens_b")).select("a", "b")


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` of the nodes of the links ``a, b`` (minimum label, pointer jumping)."""
    edges = saved(links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct(), "edges")
    labels = saved(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    while True:
        # the smallest label of the neighbours ...
        told = edges.join(labels.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("component").alias("told"))
        lower = saved(labels.join(told, "node").select("node", "component", F.least("component", "told").alias("next")), "lower")
        if lower.where("next < component").limit(1).count() == 0:
            return labels
        # ... and then the label of that label's node
        ahead = lower.select(F.col("node").alias("next"), F.col("next").alias("jump"))
        labels = saved(lower.join(ahead, "next").select("node", F.least("next", "jump").alias("component")), "labels")


def _other(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different components."""
    la, lb = labels.toDF("a", "ca"), labels.toDF("b", "cb")
    both = pairs.join(la, "a", "left").join(lb, "b", "left")
    return both.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _checked(ids: DataFrame) -> DataFrame:
    """A table of ids, broadcast if it is counted to be small; else Spark's own choice of join."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _mixed(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """``hash, node, component, rows`` of the groups that hold several components."""
    by_hash = Window.partitionBy("hash")
    named = groups.join(labels, "node", "left").select("hash", "node", F.coalesce("component", "node").alias("component"))
    ends = {"low": F.min("component").over(by_hash), "high": F.max("component").over(by_hash), "rows": F.count("*").over(by_hash)}
    return named.withColumns(ends).where("low != high").drop("low", "high")


def node_components(docs: DataFrame, nodes: DataFrame, frequencies: Frequencies, n: int, threshold: tuple[int, int]) -> DataFrame:
    """``node, component`` of every node that has a link to another node."""
    groups = candidate_groups(docs, n, threshold, frequencies)
    wanted = groups.select("node").distinct()
    chosen = nodes.where("doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(wanted, "node", "left_semi")
    ids = saved(chosen.select("doc_id").distinct(), "chosen")
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").join(_checked(ids), "doc_id", "left_semi")
    found = _token_sets(texts.dropDuplicates(["doc_id", "text"]), n)
    nameless = saved(nodes.groupBy("node").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NULL").join(wanted, "node", "left_semi").select("node"), "nameless")
    if nameless.limit(1).count():  # texts whose rows all have a NULL doc_id: they may link others
        unnamed = docs.where("doc_id IS NULL").select("text").distinct()
        found = found.unionByName(_token_sets(unnamed, n).join(_checked(nameless), "node", "left_semi").dropDuplicates(["node"]))
    sets = saved(found, "sets")

    # phase 1: each node and the leader it shares most entries with
    stars = saved(groups.where("leader != node").groupBy(F.col("leader").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("shared")), "stars")
    best = stars.groupBy("b").agg(F.max(F.struct("shared", "a")).alias("m")).select("m.a", "b")
    links = saved(_verified(best, sets, threshold), "links")
    labels = connected(links)

    # phase 2: its other leaders, unless they are connected by now
    more = saved(_verified(_near(_other(stars.select("a", "b"), labels), sets, threshold), sets, threshold), "links")
    links = links.union(more)
    labels = connected(links)

    # phase 3: in large groups that still hold several components, neighbours in two shuffled orders
    for salt in (1, 2):
        shuffled = Window.partitionBy("hash").orderBy(F.xxhash64("node", "hash", F.lit(salt)), "node")
        mixed = _mixed(groups, labels).where(F.col("rows") >= LARGE_GROUP)
        pairs = mixed.select("node", "component", F.lag("node").over(shuffled).alias("a"), F.lag("component").over(shuffled).alias("ca"))
        pairs = pairs.where("ca != component").select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        links = links.union(saved(_verified(_near(pairs, sets, threshold), sets, threshold), "links"))
        labels = connected(links)

    # phase 4: all pairs of different components that share an entry and that the bitmaps do not rule out
    mixed = saved(_mixed(groups, labels), "mixed")
    buckets = max(8, mixed.count() // BUCKET_ROWS)
    brief = sets.select("node", "size", "bitmap")
    rows = mixed.join(brief, "node").select(F.pmod("hash", F.lit(buckets)).alias("bucket"), "hash", "node", "component", "size", "bitmap")
    pairs = rows.groupBy("bucket").applyInArrow(_possible_pairs(threshold), "a bigint, b bigint").distinct()
    last = saved(_verified(pairs, sets, threshold), "links")
    return connected(links.union(last))


def _possible_pairs(threshold: tuple[int, int]) -> Callable[[pa.Table], pa.Table]:
    """Pairs of nodes with an equal entry, of different components, whose sizes and bitmaps allow a link."""
    num, den = threshold

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("hash", "ascending"), ("size", "ascending")])
        h, node, component, size = (table[c].to_numpy() for c in ("hash", "node", "component", "size"))
        bitmaps = table["bitmap"].to_pylist()
        found: set[tuple[int, int]] = set()
        first = np.flatnonzero(np.diff(h, prepend=h[:1] - 1))
        for start, end in zip(first, [*first[1:], len(h)], strict=True):
            # bitmaps of the shortest length in the group: longer ones fold onto it
            shortest = min(len(x) for x in bitmaps[start:end])
            maps = np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, shortest), axis=0) for x in bitmaps[start:end]]).view(U64)
            n, c, v = size[start:end].astype(np.int64), component[start:end], node[start:end]
            for i in range(end - start - 1):
                rest = np.flatnonzero((c[i + 1 :] != c[i]) & (den * n[i] >= num * n[i + 1 :])) + i + 1
                differing = np.bitwise_count(maps[rest] ^ maps[i]).sum(axis=1, dtype=np.int64)
                for j in rest[differing <= (n[rest] + n[i]) * (den - num) // (den + num)]:
                    found.add((min(int(v[i]), int(v[j])), max(int(v[i]), int(v[j]))))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def _named(docs: DataFrame, n: int, threshold: tuple[int, int]) -> DataFrame:
    """``doc_id, n_shingles, node, component, component_id`` per row of ``docs`` (node and component are NULL for an empty set)."""
    nodes, frequencies = shingle_nodes(docs, n)
    labels = node_components(docs, nodes, frequencies, n, threshold)
    named = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.where("node IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (
        named.join(smallest, "component", "left")
        .select("doc_id", "n_shingles", "node", "component", F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def components(docs: DataFrame, n: int = SHINGLE_WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``.

    The component is the smallest doc_id that links reach, the document's own included.
    """
    return _named(docs, n, threshold).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, n: int = SHINGLE_WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without those whose group keeps another document (the smallest doc_id), unchanged.

    Rows are told apart by doc_id and text: of a doc_id that occurs with several
    texts each row goes or stays by its own text. Rows of one doc_id in one group
    stay one row (the smallest node, then the smallest values). Rows with a NULL
    doc_id all stay.
    """
    found = _named(docs, n, threshold)
    gone = saved(found.where("doc_id != component_id").select("doc_id").distinct(), "gone")
    repeated = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.limit(1).count() == 0:
        return docs.join(_checked(gone), "doc_id", "left_anti").select(*docs.columns)

    # rows whose doc_id occurs once need no node; the others are decided by (doc_id, node)
    repeated = saved(repeated, "repeated")
    once = docs.join(_checked(gone.union(repeated).distinct()), "doc_id", "left_anti").select(*docs.columns)
    stays = found.where("doc_id = component_id").join(_checked(repeated), "doc_id", "left_semi")
    stays = saved(stays.groupBy("doc_id", "component").agg(F.min("node").alias("node")).select("doc_id", "node"), "stays")

    @F.arrow_udf("bigint")
    def node(text: pa.Array) -> pa.Array:
        sets = _sets(pa.RecordBatch.from_arrays([text], ["text"]), n)
        return pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())

    again = docs.join(_checked(repeated), "doc_id", "left_semi").select(*docs.columns)
    rows = again.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), node("text").alias("node"))
    kept = rows.alias("r").join(
        _checked(stays).alias("s"), (F.col("r.doc_id") == F.col("s.doc_id")) & F.col("r.node").eqNullSafe(F.col("s.node")), "left_semi"
    )
    fixed = ["row.text", *(f"row.{f.name}" for f in docs.schema if "map<" not in f.dataType.simpleString())]
    first = Window.partitionBy("doc_id", "node").orderBy(*fixed)
    one = kept.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")
    return once.unionByName(one)
