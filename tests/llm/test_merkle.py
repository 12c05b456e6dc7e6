import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle as m


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, more=0):
    n = row["n_chars"]
    values = [row["doc_id"], row["source"], row["lang"], None if n is None else n + more, row["text"]]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout):
    """Root of a list of hashes and, per node, its list of (slot, siblings)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        groups = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for k, i in enumerate(at):
            g = groups[i // fanout]
            paths[k].append((i % fanout, g[: i % fanout] + g[i % fanout + 1 :]))
        nodes, at = [h("".join(g)) for g in groups], [i // fanout for i in at]
    return nodes[0], paths


def brute(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subs = []
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        subs.append(tree([leaf(r) for r in groups[g]], fanout))
    root, tops = tree([s for s, _ in subs], fanout)
    out = []
    for g, (sub, paths), top in zip(names, subs, tops):
        for r, path in zip(groups[g], paths):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            cur = leaf(r, int(hit))
            for slot, others in path + top:
                cur = h("".join(others[:slot] + [cur] + others[slot:]))
            proof = h("".join(x for _, others in path + top for x in others))
            out.append((r["doc_id"], leaf(r), sub, root, proof, cur, cur == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


LANGS = [None, "en", "fr", "é", "zz", ""]


@pytest.mark.parametrize(("fanout", "block"), [(2, 1024), (2, 4), (3, 9), (5, 5), (16, 1024)])
def test_against_brute_force(docs, monkeypatch, fanout, block):
    monkeypatch.setattr(m, "BLOCK_LEAVES", block)
    rows = [(i * 3 % 101, f"text {i} ñ", LANGS[0 if i % 7 == 0 else 1 if i % 3 else i % 6], "s" if i % 4 else None) for i in range(101)]
    d = docs(rows)
    want = brute([r.asDict() for r in d.collect()], fanout)
    assert got(m.verified(d, fanout)) == want
    assert 0 < sum(not r[-1] for r in want) < 40


def test_edges(docs, edge_docs):
    assert m.verified(docs([])).collect() == []
    rows = edge_docs.withColumn("lang", F.when(F.col("doc_id") > 2, F.col("lang")))
    assert got(m.verified(rows)) == brute([r.asDict() for r in rows.collect()])
    # one leaf: it is the root, and its proof is the hash of nothing
    one = m.verified(docs([(7, "x", "en", "s")]).withColumn("n_chars", F.lit(None).cast("bigint"))).collect()[0]
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == h("") and one.verified
    # the longest count is one more without overflow
    big = docs([(4, "x", "en", "s"), (5, "y", "en", "s")]).withColumn("n_chars", F.lit((1 << 63) - 1))
    assert len(m.verified(big).collect()) == 2
    # repeated rows and ids
    rows = docs([(1, "a", "en"), (1, "a", "en"), (1, "b", "en"), (2, "c", "en"), (2, "c", "en")])
    assert got(m.verified(rows)) == brute([r.asDict() for r in rows.collect()])


def test_any_change_breaks_the_proof(docs):
    rows = docs([(i, f"t{i}", "en" if i % 2 else "fr", "s") for i in range(40)])
    base = rows.select("doc_id", "lang", F.unhex(m.leaf()).alias("node"), F.unhex(m.leaf(text=F.concat("text", F.lit("!")))).alias("seen"))
    found = m.manifest(base, carry=("doc_id", "node", "seen"))
    out = found.select(
        (m.folded(F.lower(F.hex("node")), F.col("path")) == F.lower(F.hex("root"))).alias("same"),
        (m.folded(F.lower(F.hex("seen")), F.col("path")) == F.lower(F.hex("root"))).alias("changed"),
    ).collect()
    assert all(r.same for r in out) and not any(r.changed for r in out)
