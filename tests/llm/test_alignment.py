import hashlib
import itertools
import random
from collections import Counter

import pytest

from tidemark.llm import alignment as al

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    file = tokenizers.Tokenizer.from_file(f"{al.FOLDER}/{al.MODEL_A}")
    file.encode_special_tokens = True
    return al.pair(al.FOLDER), file


def groups(both, text):
    """Groups of the whole text by the vocabulary file's own tokenizer, by brute force."""
    p, file = both
    if not text:
        return None
    raw = (" " + text).encode()
    ids = (file.encode(" " + text, add_special_tokens=False).ids, p.b.encode(text))
    parts = ([p.bytes_a[i] for i in ids[0]], [p.bytes_b[i] for i in ids[1]])
    if any(b"".join(x) != raw for x in parts):
        return None
    ends = [list(itertools.accumulate(map(len, x))) for x in parts]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out, at = [], [0, 0]
    for c in cuts:
        to = [ends[k].index(c, at[k]) + 1 for k in (0, 1)]
        out.append((ids[0][at[0] : to[0]], ids[1][at[1] : to[1]]))
        at = to
    return out


def brute(both, rows):
    found = [(i, groups(both, t)) for i, t in rows]
    links = Counter((a[-1], b[-1]) for _, g in found for a, b in g or [])
    best = {}
    for (_, b), n in links.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, g in found:
        if not g:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        pairs = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((
            i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(pairs),
            sum(links[p] == best[p[1]] for p in pairs), sum(links[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = [
    "a\n  b", "▁x", "one ▁ two", "  ", " ", "\n", "tail  ", "a \n\n  b c\xa0 d", "\x1c x \x85 y 　z", "<|endoftext|> <s> hi </s> <unk> <0x0A>",
    "ﬁ é ​﻿", "\x00z", "🙂🙃 ñandú 漢字 漢字", "x" * 3000, "don't we'll 1234 12.5%", "퟿ \U0010ffff",
]


def test_rows_against_brute_force(docs, both):
    rng = random.Random(3)
    words = ["river", "stone", " walks", "unbelievable", "1999", "Straße", "naïve", "(x)", "don't", "\n", "漢字"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, rows[i % 3][1]) for i in range(30)]
    assert got(al.alignment(docs(rows))) == brute(both, rows)


def test_ids_of_the_file(both):
    """Tokenizer A gives the ids that the vocabulary file's own tokenizer gives, for every 7th code point in context."""
    p, file = both
    points = [chr(c) for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}1{c} {c}!" for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    for t in texts:
        assert p.a.encode_to_numpy(t, disallowed_special=()).tolist() == file.encode(t, add_special_tokens=False).ids


def test_long_texts_in_pieces(docs, both, monkeypatch):
    rng = random.Random(5)
    chars = ["a", "bc", " ", " ", "  ", "\n", "\t", " \n", "　", "é", "漢", "9"]
    rows = [(i, "".join(rng.choice(chars) for _ in range(800))) for i in range(25)]
    want = brute(both, rows)
    monkeypatch.setattr(al, "PIECE_CHARS", 5)
    assert max(len(al.pieces(t)) for _, t in rows) > 50 and all("".join(al.pieces(t)) == t for _, t in rows)
    p = both[0]
    texts = [t for _, t in rows]
    assert [(r[0], r[1], len(r[2]) // 4, r[3]) for r in p.texts(texts)] == [(w[1], w[2], w[3], w[7]) for w in sorted(want)]


def test_edges(docs, edge_docs, both):
    assert al.alignment(docs([])).collect() == []
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert got(al.alignment(edge_docs)) == brute(both, rows)


def test_hot_texts(docs, both, monkeypatch):
    monkeypatch.setattr(al, "HOT_SHARE", 0.2)
    rows = [(i, "the same text" if i % 2 else f"text number {i}") for i in range(40)] + [(None, "the same text"), (50, None)]
    assert got(al.alignment(docs(rows).repartition(4))) == brute(both, rows)
