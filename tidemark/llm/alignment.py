"""Cross-tokenizer alignment over exactly deduplicated texts (operator 13).

Two tokenizers cut the same bytes ``space + text``: A (byte-level BPE) and B
(pieces with byte fallback, which adds the space itself). Offsets where a token
of A and a token of B both end cut them into groups; the two tokens that end
there are linked. A pair of ids counts as often as the whole corpus links it.

Plan. Texts are shuffled by their full text, with a partial aggregation, so
that copies meet once: a distinct text and its multiplicity. Each distinct text
is tokenised and aligned once, its links written; pair counts are weighted by
the multiplicity and added up per partition before they are shuffled. Linked
tokens are suffixes of one another, so there are at most as many pairs as the
two vocabularies have bytes: the counts are broadcast with that bound,
whatever the corpus. A second map gives each distinct text its measures, which
are joined to the doc_ids by the text's sha256. Texts with a thousandth of all
rows or more (so at most a thousand texts) are joined by broadcast, so that no
hot text is a join key.

A is run from its vocabulary file by the same splitting pattern and merge ranks
(tests compare the ids with the file's own tokenizer). Very long texts are
tokenised in pieces, cut before a space that follows something else than white
space: A never takes such a place into a token, and no piece of B holds a space
after another character (checked when the model is loaded), so the ids are
those of the whole text.

Defined cases: NULL and empty texts, and texts whose tokens do not give
``space + text`` back (such as U+2581 in the text), have no tokens: zeros and
an empty ``groups_sha256``; repeated rows each have a result row; strings of
special tokens are plain text; other columns are ignored; whole texts are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, saved

FOLDER = "/opt/tokenizers"
MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Fixed value: how A splits a text before merging (the pattern of its vocabulary file's byte-level step).
PATTERN_A = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters from which on a text is tokenised in pieces (about), so that one text's work is bounded.
PIECE_CHARS = 1 << 16
#: Texts of at least this share of all rows are joined by broadcast: at most its inverse many.
HOT_SHARE = 1 / 1000
#: Ids of B are below 2 ** B_BITS; a pair is ``a << B_BITS | b`` and fits into 32 bits.
B_BITS = 15

#: A text may be cut before a space that follows something else than white space, and is not its last character.
CUT = re.compile(r"(?<=\S)(?= [\s\S])")


def byte_level() -> dict[str, int]:
    """Bytes of the characters of a byte-level vocabulary: visible Latin-1 stands for itself, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, folder: str):
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding

        with open(f"{folder}/{MODEL_A}", encoding="utf-8") as f:
            described = json.load(f)
        special = {t["content"] for t in described["added_tokens"]}
        chars = byte_level()
        vocabulary = sorted(described["model"]["vocab"].items(), key=lambda t: t[1])
        self.bytes_a = [t.encode() if t in special else bytes(chars[c] for c in t) for t, _ in vocabulary]
        ranks = {self.bytes_a[i]: i for t, i in vocabulary if t not in special}
        self.a = Encoding("a", pat_str=PATTERN_A, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_file=f"{folder}/{MODEL_B}")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        if [i for _, i in vocabulary] != list(range(len(vocabulary))) or len(vocabulary) > 1 << (32 - B_BITS) or len(pieces) > 1 << B_BITS:
            raise ValueError("ids do not fit into a 32-bit pair")
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece of model B crosses words")
        self.length_a = np.array([len(t) for t in self.bytes_a])
        self.length_b = np.array([len(t) for t in self.bytes_b])
        #: decimal ids with what follows them: within a group, and at the end of its A and B side
        n_a, n_b = len(vocabulary), len(pieces)
        self.written = [*(f"{i}," for i in range(n_a)), *(f"{i}|" for i in range(n_a)), *(f"{i}," for i in range(n_b)), *(f"{i};" for i in range(n_b))]

    def texts(self, texts: list[str]) -> list[tuple]:
        """``n_a, n_b, links (uint32), groups digest`` per text; zeros for a text that is not given back."""
        cut = [pieces(" " + t) for t in texts]
        flat = list(chain.from_iterable(cut))
        ids_a = [self.a.encode_to_numpy(p, disallowed_special=()) for p in flat]  # byte-level: gives any text back
        ids_b = self.b.encode([p[1:] for p in flat], num_threads=1)
        stops = np.cumsum([len(c) for c in cut])
        a, stop_a = _flat(ids_a, stops)
        b, stop_b = _flat(ids_b, stops)
        start = (np.append(0, stop_a[:-1]), np.append(0, stop_b[:-1]))
        whole = [(" " + t).encode() for t in texts]
        good = [
            i for i, t in enumerate(whole)
            if b"".join(map(self.bytes_b.__getitem__, b[start[1][i] : stop_b[i]].tolist())) == t
        ]
        out: list[tuple] = [(0, 0, b"", "")] * len(texts)
        if len(good) < len(texts):
            kept_a, kept_b = (np.concatenate([np.arange(s[i], e[i]) for i in good] or [np.zeros(0, int)]) for s, e in zip(start, (stop_a, stop_b)))
            stop_a, stop_b = np.cumsum((stop_a - start[0])[good]), np.cumsum((stop_b - start[1])[good])
            a, b = a[kept_a], b[kept_b]
        for i, row in zip(good, self._grouped(a, b, stop_a, stop_b), strict=True):
            out[i] = row
        return out

    def _grouped(self, a: np.ndarray, b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> Iterator[tuple]:
        """The ids of whole texts, cut into groups where both tokenizers end a token."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        at = np.searchsorted(ends_a, ends_b)  # both have the same last end
        shared = ends_a[at] == ends_b
        last_a, last_b = at[shared], np.flatnonzero(shared)
        links = (a[last_a] << B_BITS | b[last_b]).astype(np.uint32)

        # the written order: of each group the tokens of A, then those of B
        group_a = np.searchsorted(last_a, np.arange(len(a)))
        group_b = np.searchsorted(last_b, np.arange(len(b)))
        order = np.empty(len(a) + len(b), np.int64)
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        word_a = a + n_a * np.isin(np.arange(len(a)), last_a, assume_unique=True)
        word_b = b + 2 * n_a + n_b * shared
        order[np.arange(len(a)) + np.append(0, last_b + 1)[group_a]] = word_a
        order[np.arange(len(b)) + (last_a + 1)[group_b]] = word_b

        stop_link = np.searchsorted(last_b, stop_b - 1) + 1
        start_a = start_b = start_link = 0
        word = self.written.__getitem__
        for end_a, end_b, end_link in zip(stop_a.tolist(), stop_b.tolist(), stop_link.tolist(), strict=True):
            groups = "".join(map(word, order[start_a + start_b : end_a + end_b].tolist()))[:-1]
            yield end_a - start_a, end_b - start_b, links[start_link:end_link].tobytes(), hashlib.sha256(groups.encode()).hexdigest()
            start_a, start_b, start_link = end_a, end_b, end_link


def pieces(text: str) -> list[str]:
    """A long text in pieces of about ``PIECE_CHARS`` characters that both tokenizers treat alike apart and together."""
    out, start = [], 0
    while len(text) - start > PIECE_CHARS and (m := CUT.search(text, start + PIECE_CHARS)):
        out.append(text[start : m.start()])
        start = m.start()
    out.append(text[start:])
    return out


def _flat(ids: list, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, and where those of each text end (``stops`` counts the lists)."""
    return np.concatenate([np.zeros(0, np.int64), *(np.array(x, np.int64) for x in ids)]), np.append(0, np.cumsum([len(x) for x in ids]))[stops]


@lru_cache(maxsize=1)
def pair(folder: str) -> Pair:
    return Pair(folder)


def _blocks(texts: list[str], limit: int = 1 << 18) -> Iterator[list[str]]:
    """Texts in blocks of about ``limit`` characters."""
    block: list[str] = []
    size = 0
    for t in texts:
        block.append(t)
        size += len(t)
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


ALIGNED = "key binary, copies bigint, n_a bigint, n_b bigint, groups_sha256 string, links binary, pair bigint, times bigint"


def aligned(texts: DataFrame, folder: str) -> DataFrame:
    """Per distinct text (``text, copies, key``) its tokens, groups and links; after a partition's texts its pair counts."""
    out = arrow_schema(ALIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(folder)
        pairs, times = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for b in batches:
            copies = b.column(1).to_numpy(zero_copy_only=False)
            at = 0
            found = []
            for block in _blocks(b.column(0).to_pylist()):
                rows = both.texts(block)
                links = [np.frombuffer(r[2], np.uint32) for r in rows]
                weights = np.repeat(copies[at : at + len(rows)], [len(x) for x in links])
                seen, inverse = np.unique(np.concatenate([pairs, *links]), return_inverse=True)
                pairs, times = seen, _added(inverse, np.concatenate([times, weights]).astype(np.int64), len(seen))
                found += rows
                at += len(rows)
            cols = [[r[i] for r in found] for i in range(4)]
            none = pa.nulls(len(found), pa.int64())
            yield pa.RecordBatch.from_arrays([
                b.column(2), b.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                pa.array(cols[3], pa.string()), pa.array(cols[2], pa.binary()), none, none,
            ], schema=out)
        n = len(pairs)
        empty = [pa.nulls(n, f.type) for f in list(out)[:6]]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(pairs.astype(np.int64)), pa.array(times)], schema=out)

    return texts.select("text", "copies", "key").mapInArrow(run, ALIGNED)


def _added(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(n, np.int64)
    np.add.at(total, index, values)
    return total


class Counts:
    """Corpus-wide counts of the linked pairs, and whether a pair's count is the highest of its B id."""

    def __init__(self, pairs: np.ndarray, times: np.ndarray):
        order = np.argsort(pairs)
        self.pairs, self.times = pairs[order].astype(np.uint32), times[order]
        highest = np.zeros(1 << B_BITS, np.int64)
        b = (self.pairs & np.uint32((1 << B_BITS) - 1)).astype(np.int64)
        np.maximum.at(highest, b, self.times)
        self.best = self.times == highest[b]

    def of(self, links: bytes) -> tuple[int, int, int]:
        """``n_links, n_best, count_sum`` of a text's links."""
        at = np.searchsorted(self.pairs, np.frombuffer(links, np.uint32))
        return len(at), int(self.best[at].sum()), int(self.times[at].sum())


MEASURES = "key binary, copies bigint, n_a bigint, n_b bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def measured(rows: DataFrame, counts: Counts) -> DataFrame:
    out = arrow_schema(MEASURES)
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [shared.value.of(x) for x in b.column(4).to_pylist()]
            mine = [pa.array([g[i] for g in got], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *mine, b.column(5)], schema=out)

    return rows.select("key", "copies", "n_a", "n_b", "links", "groups_sha256").mapInArrow(run, MEASURES)


def alignment(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """Token counts, groups, links and their counts, and the digest of the groups, per document."""
    key = F.unhex(F.sha2("text", 256))
    texts = docs.where("text != ''").groupBy("text").agg(F.count("*").alias("copies")).withColumn("key", key)
    rows = saved(aligned(texts, folder), "aligned")
    # at most as many pairs as the vocabularies have bytes
    counted = rows.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("times").alias("times")).toArrow()
    counts = Counts(counted["pair"].to_numpy(), counted["times"].to_numpy())
    measures = saved(measured(rows.where("key IS NOT NULL"), counts), "measures")

    total = measures.agg(F.sum("copies")).first()[0] or 0
    often = F.col("copies") >= max(2, int(total * HOT_SHARE))
    ids = docs.select(F.col("doc_id").cast("bigint"), key.alias("key"))
    hot, keys = measures.where(often), measures.where(often).select("key")
    near = ids.join(F.broadcast(hot), "key")
    far = ids.join(F.broadcast(keys), "key", "left_anti").join(measures.where(~often), "key", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_a", "n_b", "n_links", "n_best", "count_sum")}
    both = near.unionByName(far).withColumns({**zero, "groups_sha256": F.coalesce("groups_sha256", F.lit(""))})
    return both.select("doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256")
