import hashlib
import random

from tidemark.llm import fingerprints as fp


def test_phrases_are_the_shortest_unseen_runs():
    assert fp.phrase_ends([0, 0, 0, 1, 0, 1, 0], 2) == [1, 3, 4, 6, 7]  # 0 | 00 | 1 | 01 | 0 (incomplete)


def brute_phrases(ids):
    seen, out, run = set(), set(), ()
    for x in ids:
        run += (x,)
        if run not in seen:
            seen.add(run)
            out.add(run)
            run = ()
    return out | ({run} if run else set())


def test_phrase_ends_match_the_set_based_parse():
    rng = random.Random(3)
    for _ in range(50):
        ids = [rng.randrange(3) for _ in range(rng.randrange(40))]
        ends = fp.phrase_ends(ids, 3)
        assert {tuple(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)} == brute_phrases(ids)


def test_likeness_follows_the_jaccard_of_the_phrase_sets():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    a = rng.sample(words, 800)
    for kept in (0, 200, 400, 800):
        b = a[:kept] + rng.sample([w for w in words if w not in a], 800 - kept)
        x, y = brute_phrases(a), brute_phrases(b)
        true = len(x & y) / len(x | y)
        got = fp.likeness(fp.signature(" ".join(a).encode()), fp.signature(" ".join(b).encode()))
        assert abs(got - true) < 0.12


def test_edit_neighbours_follow_descending_ids(docs, edge_docs):
    rows = [(i, f"text number {i} " + " ".join(f"w{i}x{j}" for j in range(i % 7 * 9))) for i in range(60)]
    got = {r.doc_id: r for r in fp.edit_neighbours(docs(rows)).collect()}
    text = dict(rows)
    assert len(got) == 60
    for i in range(60):
        following = text[i - 1 if i else 59]
        half = len(text[i]) // 2
        new = text[i][: len(text[i]) - half] + following[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text[i]), hashlib.sha256(new.encode()).hexdigest())
        a, b, c = (fp.signature(t.encode()) for t in (text[i], new, following))
        assert (r.fingerprint, r.edited_fingerprint) == (a.hex(), b.hex())
        assert (r.near_edited, r.near_next) == (fp.likeness(a, b), fp.likeness(a, c))

    rows = fp.edit_neighbours(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {""}
    same = [r for r in rows if r.doc_id == 4]
    assert len(same) == 2 and same[0].fingerprint == same[1].fingerprint


def test_one_row_is_its_own_next_and_no_rows_give_none(docs):
    (r,) = fp.edit_neighbours(docs([(5, "abc def")])).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abc abc").hexdigest() and r.near_next == 1.0
    assert fp.edit_neighbours(docs([])).collect() == []
