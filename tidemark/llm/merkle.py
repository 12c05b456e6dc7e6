"""Merkle manifest of a dataset by slot pivots (operator 12).

A row is a leaf: the hash of its fields, each ``-`` if NULL, else its UTF-8
byte count, ``:`` and its value. Per group (``lang``) the leaves stand in
ascending doc_id; every ``fanout`` consecutive nodes (the last run may be
shorter, even one) become their hash until one node is left, the subroot. The
subroots, ordered by group (NULL first, by bytes), give the root likewise.

Slot pivot. On a level a node's parent is ``position div fanout`` and its slot
``position mod fanout``. Conditional aggregates over the rows of one parent,
``max(CASE WHEN slot = s THEN node END)``, spread its children into ``fanout``
columns. Concatenating the columns and hashing gives the parent; leaving out
the own slot's column gives the siblings.

At scale. Texts are hashed where they are read; only hashes move. Positions
come from one range shuffle by (group, doc_id, leaf): a row's number in its
partition plus the counts of the earlier partitions, so that no group has to
fit into a task. The lowest levels, ``BLOCK_LEVELS`` at a time, are pivoted
within blocks of at most ``fanout ** levels`` leaves: one shuffle by (group,
block) serves them all. Block roots are then nodes of the next, smaller round;
its paths are joined back by (group, block). The top tree joins one row per
group, so a group that holds most rows is never a join key of many rows.

A proof is a list of (slot, siblings), from the leaf to the root; folding a
leaf with it gives the root again, and gives another one if the row changed.

Defined cases: NULL fields are ``-`` and a NULL group is a group; a NULL
doc_id stands first in its group; rows with an equal doc_id stand in the order
of their leaves, equal leaves in any order (their results differ by place
only); a group with one leaf has it as subroot; without siblings the proof is
the hash of an empty string; an empty table gives an empty manifest; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
#: Most leaves of a block that one round of pivots takes.
BLOCK_LEAVES = 1024
PATH = "array<struct<slot:int,others:array<binary>>>"


def encoded(value: Column) -> Column:
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def leaf(**changed: Column) -> Column:
    """The leaf of a row, with some fields replaced."""
    return digest(*(encoded(changed.get(f, F.col(f))) for f in FIELDS))


def _hex(b: Column) -> Column:
    return F.lower(F.hex(b))


def placed(nodes: DataFrame, group: str, *order: str) -> DataFrame:
    """``nodes`` with ``pos`` (0, 1, ... within its group) and ``size`` (of its group)."""
    keys = [F.col(group).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order)]
    # equal rows may stand in any order, so that a number can spread them over the partitions
    spread = nodes.withColumn("spread", F.monotonically_increasing_id())
    ordered = spread.repartitionByRange(*keys, "spread").sortWithinPartitions(*keys, "spread").drop("spread")
    rows = saved(ordered.withColumn("row", F.monotonically_increasing_id()).withColumn("part", F.shiftright("row", 33)), "merkle-rows")
    runs = rows.groupBy("part", group).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("part").alias("run_part"), F.col(group).alias("run_group"), "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy(group)).alias("size"),
    )
    here = rows.join(runs, (F.col("part") == F.col("run_part")) & F.col(group).eqNullSafe(F.col("run_group")))
    return here.select(*nodes.columns, (F.col("row") - F.col("first") + F.col("before")).alias("pos"), "size")


def levels_of(size: int, fanout: int) -> int:
    """Levels above ``size`` nodes until one is left."""
    n = 0
    while size > 1:
        size, n = -(-size // fanout), n + 1
    return n


def pivoted(nodes: DataFrame, levels: int, fanout: int) -> DataFrame:
    """``nodes`` (grp, pos, size, node) with ``block``, its ``block_root`` and the ``path`` to it."""
    at = nodes.withColumn("block", F.floor(F.col("pos") / fanout**levels).cast("bigint")).withColumns({"path": F.array().cast(PATH), "block_root": F.col("node")})
    for level in range(levels):
        step = fanout**level
        parent = Window.partitionBy("grp", "block", F.floor(F.col("pos") / (step * fanout)))
        slot = (F.floor(F.col("pos") / step) % fanout).cast("int")
        slots = [f"slot_{s}" for s in range(fanout)]
        at = at.withColumn("slot", slot).withColumns({c: F.max(F.when(F.col("slot") == s, F.col("block_root"))).over(parent) for s, c in enumerate(slots)})
        others = F.filter(F.array(*(F.when(F.col("slot") != s, F.col(c)) for s, c in enumerate(slots))), lambda x: x.isNotNull())
        several = F.col("size") > step  # several nodes are left on this level
        at = at.withColumns({
            "path": F.when(several, F.concat("path", F.array(F.struct(F.col("slot"), others.alias("others"))))).otherwise(F.col("path")),
            "block_root": F.when(several, F.unhex(digest(*(F.coalesce(_hex(F.col(c)), F.lit("")) for c in slots)))).otherwise(F.col("block_root")),
        }).drop("slot", *slots)
    return at


def climbed(nodes: DataFrame, fanout: int, name: str, crown: Callable[[DataFrame], DataFrame] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """The nodes ``grp, pos, size, node`` and their columns ``carry``, with their ``path``, ``subroot`` and ``root``.

    ``crown`` continues the paths above the groups' roots (one row per group); without it they end there.
    """
    largest = nodes.agg(F.max("size")).first()[0] or 0
    block_levels = max(1, levels_of(BLOCK_LEAVES + 1, fanout) - 1)
    levels = min(levels_of(largest, fanout), block_levels)
    low = saved(pivoted(nodes, levels, fanout), name)
    kept = ["grp", "pos", *carry]
    step = fanout**levels
    whole = step >= largest
    if whole and crown is None:
        return low.select(*kept, "path", F.col("block_root").alias("subroot"), F.col("block_root").alias("root"))
    roots = low.where(F.col("pos") % step == 0).select(
        "grp", F.col("block").alias("pos"), F.ceil(F.col("size") / step).cast("bigint").alias("size"), F.col("block_root").alias("node")
    )
    above = crown(roots) if whole else climbed(roots, fanout, name, crown)
    above = above.select(F.col("grp").alias("grp_above"), F.col("pos").alias("block_above"), F.col("path").alias("path_above"), "subroot", "root")
    both = low.join(above, F.col("grp").eqNullSafe(F.col("grp_above")) & (F.col("block") == F.col("block_above")))
    return both.select(*kept, F.concat("path", "path_above").alias("path"), "subroot", "root")


def folded(node: Column, path: Column) -> Column:
    """The root that a node (hex) and the siblings of its path give."""

    def up(cur: Column, step: Column) -> Column:
        others = F.transform(step["others"], _hex)
        left = F.array_join(F.slice(others, F.lit(1), step["slot"]), "")
        right = F.array_join(F.slice(others, step["slot"] + 1, F.size(others)), "")
        return F.sha2(F.concat(left, cur, right), 256)

    return F.aggregate(path, node, up)


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(F.flatten(F.transform(path, lambda s: s["others"])), _hex), ""), 256)


def manifest(rows: DataFrame, group: str = "lang", fanout: int = FANOUT, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``grp, pos`` of the rows and their columns ``carry``, with ``path`` to the root, ``subroot`` and ``root`` (binary).

    ``rows`` needs ``doc_id``, ``group`` and a binary ``node``; the order within a group is (doc_id, node).
    """

    def crown(subroots: DataFrame) -> DataFrame:
        """The way of each group's subroot to the root."""
        tops = placed(subroots.select(F.lit(0).alias("all"), F.col("grp").alias("name"), F.col("node")), "all", "name")
        tops = saved(tops.withColumnRenamed("all", "grp"), "merkle-tops")
        high = climbed(tops, fanout, "merkle-top", carry=("name", "node"))
        return high.select(F.col("name").alias("grp"), F.lit(0).cast("bigint").alias("pos"), "path", F.col("node").alias("subroot"), "root")

    leaves = saved(placed(rows, group, "doc_id", "node"), "merkle-leaves")
    return climbed(leaves.withColumnRenamed(group, "grp"), fanout, "merkle-level", crown, carry)


def tampered_leaf() -> Column:
    """The leaf with n_chars one higher where 7 divides the crc32 of the decimal doc_id; NULLs stay."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    return F.when(hit, leaf(n_chars=more)).otherwise(leaf())


def verified(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether its (partly tampered) row folds to the root."""
    rows = docs.select("doc_id", "lang", F.unhex(leaf()).alias("node"), F.unhex(tampered_leaf()).alias("seen"))
    rows = rows.withColumn("leaf", F.col("node"))
    found = manifest(rows, "lang", fanout, ("doc_id", "leaf", "seen"))
    out = found.select(
        "doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), folded(_hex(F.col("seen")), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: The same with recursion over the levels; crc32 of the decimal doc_id bit by bit (its reversed polynomial is 0xEDB88320).
ORACLE_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, row_number() OVER () AS rid,
    coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') AS f1,
    coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS f2,
    coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS f3,
    coalesce(octet_length(encode((n_chars + 1)::VARCHAR)) || ':' || (n_chars + 1), '-') AS f3_more,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS f4,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), list_transform(range(8), lambda i: 0::BIGINT)),
        lambda c, i: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT) AS crc
  FROM documents
), leaves AS (
  SELECT rid, doc_id, lang, sha256(f1 || f2 || f3 || f4) AS leaf,
    CASE WHEN crc % 7 = 0 THEN sha256(f1 || f2 || f3_more || f4) ELSE sha256(f1 || f2 || f3 || f4) END AS seen
  FROM d
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), up AS (
  SELECT lang, 0 AS level, pos, leaf AS node, n FROM numbered
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM up WHERE n > 1 GROUP BY lang, level, pos // 2
), subroots AS (
  SELECT lang, node AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
), top AS (
  SELECT 0 AS level, pos, subroot AS node, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY level, pos // 2
), steps AS (
  SELECT a.rid, u.level AS step, (a.pos // (1 << u.level)) % 2 AS slot, s.node AS sibling
  FROM numbered a
  JOIN (SELECT DISTINCT lang, level FROM up WHERE n > 1) u ON u.lang IS NOT DISTINCT FROM a.lang
  LEFT JOIN up s ON s.lang IS NOT DISTINCT FROM a.lang AND s.level = u.level AND s.pos = xor((a.pos // (1 << u.level))::BIGINT, 1::BIGINT)
  UNION ALL
  SELECT a.rid, 1000 + u.level, (b.pos // (1 << u.level)) % 2, s.node
  FROM numbered a JOIN subroots b ON b.lang IS NOT DISTINCT FROM a.lang
  CROSS JOIN (SELECT DISTINCT level FROM top WHERE n > 1) u
  LEFT JOIN top s ON s.level = u.level AND s.pos = xor((b.pos // (1 << u.level))::BIGINT, 1::BIGINT)
), proofs AS (
  SELECT rid, list(struct_pack(slot := slot, sibling := coalesce(sibling, '')) ORDER BY step) AS path,
    string_agg(coalesce(sibling, ''), '' ORDER BY step) AS siblings
  FROM steps GROUP BY rid
), folds AS (
  SELECT a.rid, 0 AS level, a.seen AS node, p.path FROM numbered a LEFT JOIN proofs p USING (rid)
  UNION ALL
  SELECT rid, level + 1, sha256(CASE WHEN path[level + 1].slot = 0 THEN node || path[level + 1].sibling ELSE path[level + 1].sibling || node END), path
  FROM folds WHERE level < coalesce(len(path), 0)
)
SELECT a.doc_id, a.leaf, b.subroot, r.node AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
  f.node AS folded_root, f.node = r.node AS verified
FROM numbered a
JOIN subroots b ON b.lang IS NOT DISTINCT FROM a.lang
CROSS JOIN (SELECT node FROM top WHERE n = 1) r
LEFT JOIN proofs p USING (rid)
JOIN folds f ON f.rid = a.rid AND f.level = coalesce(len(p.path), 0)
"""
