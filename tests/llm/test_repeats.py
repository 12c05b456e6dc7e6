import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import repeats as r


def brute(rows, length):
    """(n_bytes, n_removed, n_spans, sha) per row; rows in the order of their doc_id, then as given."""
    seen, out = set(), []
    for text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            if s in seen:
                gone[i : i + length] = True
            seen.add(s)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[False], gone])) & gone))
        left = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def result(df):
    return [tuple(x) for x in df.orderBy("doc_id").collect()]


def texts(rng, n, alphabet="ab ", size=120):
    base = ["".join(rng.choice(alphabet) for _ in range(size)) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [rng.choice(base)[rng.randrange(size // 2) :] if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4)]
        out.append("".join(parts))
    return out


def test_window_runs():
    rng = np.random.default_rng(1)
    for n in (9, 10, 11, 50, 300):
        data = rng.integers(97, 100, n).astype(np.uint8)
        start, size, key = r.window_runs(data, 10, 4)
        assert list(start) == sorted(start) and size.sum() == max(0, n - 9)
        of = np.repeat(key, size)
        same = {}
        for i in range(max(0, n - 9)):
            assert same.setdefault(bytes(data[i : i + 10]), of[i]) == of[i]
    start, size, _ = r.window_runs(np.full(200_000, 97, np.uint8), 100, 32)
    assert size.sum() == 199_901 and size.max() <= r.RUN_MAX and (start[1:] == start[:-1] + size[:-1]).all()


def test_ranks_with_equal_leading_bits():
    rng = np.random.default_rng(3)
    values = np.concatenate([np.zeros(5, np.uint64), rng.integers(1, 9, 200).astype(np.uint64), rng.integers(0, 1 << 62, 50).astype(np.uint64)])
    rng.shuffle(values)
    assert list(r.ranked(values)) == list(np.unique(values, return_inverse=True)[1])
    assert list(r.ranked(values + np.uint64(1))) == list(np.unique(values, return_inverse=True)[1] + 1)


def suffixes(data, starts, sizes, length, symbol):
    """All suffixes of the runs' strings as symbol tuples cut at the depth, by brute force."""
    depth, out = length // symbol, []
    for s, n in zip(starts, sizes, strict=True):
        for phase in range(min(n, symbol)):
            count = -(-(n - phase) // symbol) + depth - 1
            string = [bytes(data[s + phase + i * symbol : s + phase + (i + 1) * symbol]) for i in range(count)]
            out += [tuple(string[i : i + depth]) for i in range(count + 1)]
    return out


@pytest.mark.parametrize(("length", "symbol"), [(4, 1), (6, 2), (8, 4), (6, 6)])
def test_merge_is_the_order_of_all_suffixes(length, symbol):
    rng = np.random.default_rng(length)
    shards, every = [], []
    for _ in range(5):
        sizes = rng.integers(1, 14, 4)
        data = rng.integers(97, 99, int((sizes + length - 1).sum())).astype(np.uint8)
        at = np.cumsum(sizes + length - 1) - (sizes + length - 1)
        shard = r.Shard(data, at, sizes, length, symbol)
        mine = suffixes(data, at, sizes, length, symbol)
        assert len(mine) == len(shard.transform) and shard.window.sum() == sizes.sum()
        # equal windows share an interval, others do not
        of = {}
        for p, i in zip(shard.place[shard.window], shard.interval[shard.window], strict=True):
            assert of.setdefault(i, bytes(data[p : p + length])) == bytes(data[p : p + length])
        assert len(of) == len(set(of.values()))
        shards.append((shard, data))
        every += mine
    at, interval, common = r.merged([s for s, _ in shards])
    assert sorted(at) == list(range(len(every)))
    # intervals are the distinct suffixes, with their counts
    counts = sorted(np.unique(interval, return_counts=True)[1])
    assert counts == sorted(np.unique([hash(x) for x in every], return_counts=True)[1])
    # every place holds the suffix that its interval says, and common prefixes are right
    place = np.concatenate([s.place for s, _ in shards])[at]
    window = np.concatenate([s.window for s, _ in shards])[at]
    owner = np.concatenate([np.full(len(s.place), i) for i, (s, _) in enumerate(shards)])[at]
    text = [bytes(shards[o][1][p : p + length]) for o, p in zip(owner, place, strict=True)]
    for i in range(1, len(at)):
        if window[i] and window[i - 1]:
            a, b = text[i - 1], text[i]
            same = next((k for k in range(length // symbol) if a[k * symbol : (k + 1) * symbol] != b[k * symbol : (k + 1) * symbol]), length // symbol)
            assert common[i] == same and (interval[i] == interval[i - 1]) == (a == b)


def test_against_brute_force(docs):
    rng = random.Random(4)
    rows = texts(rng, 60, size=300) + ["x" * 500, "x" * 99, "x" * 100, "ñandú 漢字 🙂 " * 40, "ñandú 漢字 🙂 " * 40 + "tail"]
    got = result(r.without_repeats(docs([(i, t) for i, t in enumerate(rows)])))
    assert got == [(i, *b) for i, b in enumerate(brute(rows, 100))]
    assert sum(x[2] for x in got) > 1000


def test_texts_that_repeat_only_themselves(docs):
    rng = random.Random(9)
    block = lambda n: "".join(chr(rng.randrange(33, 127)) for _ in range(n))
    rows = ["x" * 300, "y" * 101, "ab" * 80, "\x00" * 250]
    for d in (1, 2, 3, 7, 33, 67, 68, 69, 70, 100, 130):
        rows += [(block(d) * 300)[: 100 + d], block(40) + (block(d) * 300)[: 150 + 2 * d] + block(40)]
    got = result(r.without_repeats(docs([(i, t) for i, t in enumerate(rows)])))
    assert got == [(i, *b) for i, b in enumerate(brute(rows, 100))]
    assert all(x[2] for x in got)


@pytest.mark.parametrize("symbol", [4, 10, 20])
def test_other_sizes(docs, symbol):
    rng = random.Random(symbol)
    rows = texts(rng, 40, alphabet="abcd ")
    got = result(r.without_repeats(docs([(i, t) for i, t in enumerate(rows)]), length=20, symbol=symbol, gram=8))
    assert got == [(i, *b) for i, b in enumerate(brute(rows, 20))]


def test_small_shards_and_buckets(docs, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(r, "SHARD_BYTES", 2000)
    monkeypatch.setattr(r, "BUCKET_BYTES", 500)
    monkeypatch.setattr(r, "PIECE_BYTES", 300)
    monkeypatch.setattr(r, "TEXT_BLOCK", 70)
    monkeypatch.setattr(r, "BUCKET_ENTRIES", 50)
    monkeypatch.setattr(r, "FLUSH_ENTRIES", 40)
    rows = texts(rng, 200, alphabet="abc ", size=200)
    got = result(r.without_repeats(docs([(i, t) for i, t in enumerate(rows)]).repartition(5)))
    assert got == [(i, *b) for i, b in enumerate(brute(rows, 100))]


def test_edges(docs, edge_docs):
    got = r.without_repeats(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert {x.doc_id: x.n_bytes for x in got}[0] == 0
    assert r.without_repeats(docs([])).collect() == []
    # equal rows: the first stays, the others go; a NULL id is the last; one id with two texts
    a, b = "first text of them " * 9, "second text, longer than a window too " * 5
    rows = [(None, a, None, None), (3, a), (3, a), (3, b), (1, b), (3, "short"), (3, "short")]
    got = r.without_repeats(docs(rows)).collect()
    whole = {(x.doc_id, x.n_bytes, x.n_removed) for x in got if x.n_bytes == x.n_removed}
    assert whole == {(None, len(a), len(a)), (3, len(a), len(a)), (3, len(b), len(b))}
    assert sorted(x.n_removed for x in got if x.n_bytes == 5) == [0, 0]
    first = brute([a], 100)[0]
    assert [tuple(x)[1:] for x in got if x.doc_id == 3 and x.n_bytes == len(a) and x.n_removed < len(a)] == [first]


def test_empty_suffixes_are_not_sorted(monkeypatch):
    rng = np.random.default_rng(6)
    values = np.concatenate([np.zeros(7, np.uint64), rng.integers(1, 9, 90).astype(np.uint64), rng.integers(1, 1 << 62, 40).astype(np.uint64)])
    rng.shuffle(values)
    rank, order = r.ranks_and_order(values)
    assert list(rank) == list(np.unique(values, return_inverse=True)[1])
    assert list(order) == [i for i in np.argsort(values, kind="stable") if values[i]]
    sorted_ = []
    real = r.sorted_by
    monkeypatch.setattr(r, "sorted_by", lambda v: (sorted_.append(len(v)), real(v))[1])
    sizes = np.full(10, 20)
    data = rng.integers(0, 256, int((sizes + 99).sum())).astype(np.uint8)
    shards = [r.Shard(data, np.arange(10) * 119, sizes, 100, 50) for _ in range(2)]
    assert len(shards[0].transform) == 600 and max(sorted_) == 400  # 200 windows of two symbols and an empty suffix each
    at, interval, _ = r.merged(shards)
    assert max(sorted_) <= 800 and len(sorted_) == 3  # one sort per shard, one for the second symbol of the merge
    assert sorted(at) == list(range(1200)) and interval[-1] == 400


def test_keys_are_dealt_evenly(docs):
    rng = np.random.default_rng(11)
    rows = ["".join(map(chr, rng.integers(33, 127, 4000))) for _ in range(50)]
    rows += [rows[0][:2000] + rows[i][:2000] for i in range(1, 6)]
    df = docs(list(enumerate(rows))).selectExpr("doc_id as ref", "text").coalesce(1)
    got = r._entries(df, 16, 100, 32).collect()
    assert len(got) == 16  # one row per batch and bucket
    keys = {x.bucket: np.frombuffer(x["keys"], np.uint64) for x in got}
    entries = [len(k) for k in keys.values()]
    assert sum(entries) > 5000 and max(entries) < 1.5 * sum(entries) / 16
    first = [k for x in got for k in keys[x.bucket][: x.alone + x.several]]
    assert len(first) == len(set(first)) == len(set(np.concatenate(list(keys.values()))))  # one of each key goes to the key's bucket
