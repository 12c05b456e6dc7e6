"""Mixing sources to target weights by Pareto order sampling (operator 5).

DataFrame functions only. A source's size is its number of words. All sources
together supply ``TOTAL_SHARE`` times all words, shared by weight; a source's
target stops at ``MOST`` times its size and the excess is shared again by
weight (a water filling, solved by one pass over the sources).

Within a source, documents get copies: ``MOST`` at most, fewer for long ones
(each doubling of the length lowers the weight a little), such that the
expected words meet the target. The whole part of the copies is certain. For
the fractional part p each document draws u from its id and text and is ranked
by its odds u/(1-u) divided by its inclusion odds p/(1-p); the first documents
whose words fit into what the target leaves are taken once more, and one
further document closes the rest of the gap if that brings the words nearer.
Rows with equal id, source and text stand together in that order and are
counted, not listed, while it is made; the cut may fall between two of them.

Scale: the ranking is not one sort per source. Ranks fall into about sqrt(n)
ranges; words are summed per range with partial aggregation, only the range
that holds the cut is sorted, and the result is one row per source and length
class (cut, closing document). The documents themselves are mapped against
that small table and never shuffled, whatever a source's share (but for the
rows of a key that the cut divides, at most two keys per source).

Defined cases: NULL text has size 0 and is never taken; NULL source is a
source of its own, the last; sources without words have target 0; rows with
one doc_id and different texts draw different numbers; of rows with equal id,
source and text any may be the ones taken, their number is fixed; a NULL
doc_id draws as the empty id; an empty table gives an empty result; extra
columns are ignored (``mix``) or kept (``taken_documents``); ties are broken
by doc_id (NULL first), then by the text's digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tidemark.llm.common import saved

#: Weights of the sources in code point order, repeating; share of all words; most copies.
WEIGHTS = (5, 2, 1)
TOTAL_SHARE, MOST = 1.5, 2
#: Lowering of a document's weight per doubling of its length.
TILT = 0.05
SEED = "mix-1"
#: Rows of one key that are listed at once.
PIECE = 4096

WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def digest(text: str) -> Column:
    return F.coalesce(F.md5(F.col(text).cast("binary")), F.lit(""))


def draw(doc_id: str, text_digest: str) -> Column:
    """A number in (0, 1) from id and text: 52 bits of a hash, the same in every run."""
    name = F.concat(F.lit(SEED + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.col(text_digest))
    return (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def fill_level(df: DataFrame, keys: list[str], total: Column, cap: Column, weight: Column, out: str) -> DataFrame:
    """Add the water level: the factor on ``weight``, cut at ``cap``, that sums to ``total``.

    Rows are ordered by cap / weight. Were row k the first below its cap, the
    level would be what earlier caps leave, over the remaining weights. The
    first row for which that holds names the level; none: NULL, all at cap.
    """
    each = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    by_cap = each.orderBy(F.try_divide("__cap", "__weight"), "__name")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = F.try_divide(total - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)), F.sum("__weight").over(after))
    return (
        df.withColumn("__cap", cap.cast("double")).withColumn("__weight", weight.cast("double")).withColumn("__level", level)
        .withColumn(out, F.min(F.when(F.col("__level") * F.col("__weight") <= F.col("__cap"), F.struct(F.try_divide("__cap", "__weight"), "__name", "__level"))).over(each)["__level"])
        .drop("__cap", "__weight", "__level")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """Length class of each document and its draw's odds."""
    return docs.withColumn("length_class", F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0)).withColumn("__u", draw("doc_id", "digest"))


def _rank() -> Column:
    """Odds of the draw over the inclusion odds, mapped to (0, 1); NULL if no fraction is to be drawn."""
    q = F.try_divide(F.col("__u") / (1 - F.col("__u")), F.col("fraction") / (1 - F.col("fraction")))
    return F.when(F.col("fraction") > 0, q / (1 + q))


def source_targets(classes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from the words per source and length class."""
    sizes = classes.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("documents").alias("documents"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("__name") - 1) % len(WEIGHTS) + 1).cast("int"))
    everything = F.lit(TOTAL_SHARE) * F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    named = sizes.withColumn("__name", place).withColumn("weight", weight).withColumn("everything", everything)
    filled = fill_level(named, [], F.col("everything"), F.col("source_size") * MOST, F.col("weight"), "level")
    cap = F.col("source_size") * F.lit(float(MOST))
    return filled.select("source", "source_size", "documents", F.coalesce(F.least(cap, F.col("level") * F.col("weight")), cap).alias("target"))


def mix_plan(docs: DataFrame) -> DataFrame:
    """One row per source and length class: target, certain copies, fraction, and the source's cut.

    ``docs`` is ``_sizes``. The cut is the first key (``edge``) whose rows do not
    all fit, and how many of them fit.
    """
    keyed = _keyed(docs)
    held = F.col("size") * F.col("rows")
    classes = saved(keyed.groupBy("source", "length_class").agg(F.sum(held).alias("words"), F.sum("rows").alias("documents")), "mix-classes")
    targets = source_targets(classes)
    same = classes["source"].eqNullSafe(targets["source"])
    both = classes.drop("documents").join(targets, same).drop(targets["source"])
    weight = F.col("words") / (1 + TILT * F.col("length_class"))
    both = fill_level(both.withColumn("__name", F.col("length_class")), ["source"], F.col("target"), F.col("words") * MOST, weight, "level").drop("__name")
    copies = F.when(F.col("words") > 0, F.coalesce(F.least(F.lit(float(MOST)), F.col("level") / (1 + TILT * F.col("length_class"))), F.lit(float(MOST)))).otherwise(0.0)
    both = both.withColumn("copies", copies).withColumn("certain", F.floor("copies")).withColumn("fraction", F.col("copies") - F.col("certain"))
    rest = F.col("target") - F.sum(F.col("certain") * F.col("words")).over(Window.partitionBy("source"))
    plan = saved(
        both.select("source", "length_class", "source_size", "target", "certain", "fraction", rest.alias("rest"), F.ceil(F.sqrt("documents")).alias("ranges")),
        "mix-plan",
    )

    # the range of ranks that holds the cut, from the words of each range
    ranked = _ranked(keyed, plan).where("rank IS NOT NULL")
    span = F.floor(F.col("rank") * F.col("ranges"))
    so_far = Window.partitionBy("source").orderBy("span")
    spans = ranked.groupBy("source", span.alias("span"), "rest").agg(F.sum(held).alias("words")).withColumn("through", F.sum("words").over(so_far))
    cut = (
        spans.where("through > rest").groupBy("source", "rest").agg(F.min(F.struct("span", "words", "through")).alias("c"))
        .select(F.col("source").alias("cut_source"), F.col("c.span").alias("cut_span"), (F.col("c.through") - F.col("c.words")).alias("before"))
    )
    cut = saved(cut, "mix-cut")

    # within that range, key by key: the first whose rows do not all fit, and how many of them do
    inside = ranked.join(cut, F.col("source").eqNullSafe(F.col("cut_source")) & (span == F.col("cut_span")))
    running = F.col("before") + F.sum(held).over(Window.partitionBy("source").orderBy("rank", "doc_id", "digest"))
    over = inside.withColumn("free", F.col("rest") - (running - held)).where(held > F.col("free"))
    edges = over.groupBy("source").agg(F.min(F.struct(_place().alias("place"), "size", "rows", "free")).alias("e"))
    fit = F.floor(F.col("e.free") / F.col("e.size"))
    fit = fit - F.when(fit * F.col("e.size") > F.col("e.free"), 1).otherwise(0)
    ends = saved(
        edges.select(
            F.col("source").alias("end_source"), F.col("e.place").alias("edge"), fit.alias("edge_fit"), F.col("e.rows").alias("edge_rows"),
            (F.col("e.free") - fit * F.col("e.size")).alias("gap"),
        ),
        "mix-ends",
    )
    # one more document, the one that closes the gap best, if it brings the words nearer
    out = ranked.join(ends, F.col("source").eqNullSafe(F.col("end_source"))).where((_place() >= F.col("edge")) & (F.col("size") > 0))
    nearest = F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), _place().alias("place"), "rows", "gap")).alias("n")
    closing = out.groupBy("source").agg(nearest).where("n.off < n.gap")
    closing = closing.select(F.col("source").alias("closing_source"), F.col("n.place").alias("closing"), F.col("n.rows").alias("closing_rows"))
    full = plan.join(ends, F.col("source").eqNullSafe(F.col("end_source")), "left").join(closing, F.col("source").eqNullSafe(F.col("closing_source")), "left")
    return saved(full.select(*plan.columns, "edge", "edge_fit", "edge_rows", "closing", "closing_rows"), "mix-final")


def _place() -> Column:
    """A key's place in its source's order (NULL ids first)."""
    return F.struct("rank", "doc_id", "digest")


def _ranked(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    p = plan.withColumnsRenamed({"source": "__source", "length_class": "__class"})
    on = F.col("source").eqNullSafe(F.col("__source")) & (F.col("length_class") == F.col("__class"))
    return keyed.join(p, on, "left").withColumn("rank", _rank()).drop("__source", "__class")


def _at(end: str) -> Column:
    return F.coalesce(_place() == F.col(end), F.lit(False))


def _more() -> Column:
    """How many rows of a key the draw takes once more; NULL: all of them."""
    some = F.when(_at("edge"), F.col("edge_fit")).otherwise(0) + F.when(_at("closing"), 1).otherwise(0)
    before = F.col("edge").isNull() | (_place() < F.col("edge"))
    return F.when(F.col("rank").isNull(), F.lit(0)).when(~before, some)


def _sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, digest`` and how many ``rows`` hold them."""
    keys = docs.select(F.col("doc_id").cast("bigint"), "source", words("text").alias("size"), digest("text").alias("digest"))
    return saved(keys.groupBy(*keys.columns).agg(F.count("*").alias("rows")), "mix-sizes")


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` per row of ``docs``."""
    sized = _sizes(docs)
    keys = _ranked(_keyed(sized), mix_plan(sized)).withColumn("more", F.coalesce(_more(), F.col("rows")))
    # one row per row of docs again: first the pieces of a key, then the rows of a piece
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1, F.lit(PIECE).cast("bigint")))
    pieces = keys.withColumn("first", first)
    last = F.least(F.col("first") + PIECE, F.col("rows"))
    each = pieces.withColumn("number", F.explode(F.sequence(F.col("first") + 1, last)))
    taken = F.col("size") * (F.col("certain") + (F.col("number") <= F.col("more")).cast("bigint"))
    return each.select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def taken_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``copies`` and ``taken`` (words) added."""
    names = {c: f"__own_{c}" for c in docs.columns}
    bare = docs.withColumnsRenamed(names).withColumns(
        {"doc_id": F.col("__own_doc_id").cast("bigint"), "source": F.col("__own_source"), "size": words("__own_text"), "digest": digest("__own_text")}
    )
    plan = mix_plan(_sizes(docs))
    ranked = _ranked(_keyed(bare), plan).withColumn("more", _more())
    # only keys of several rows can be taken in part
    divided = (F.col("more") > 0) & (_at("edge") & (F.col("edge_rows") > 1) | _at("closing") & (F.col("closing_rows") > 1))
    whole = ranked.withColumn("once_more", (F.col("more").isNull() | (F.col("more") > 0)).cast("bigint"))
    if plan.where("edge_rows > 1 OR closing_rows > 1").isEmpty():
        rows = whole
    else:
        divided = F.coalesce(divided, F.lit(False))
        comparable = [f.name for f in bare.schema.fields if not isinstance(f.dataType, MapType)]
        number = F.row_number().over(Window.partitionBy("source", "doc_id", "digest").orderBy(F.xxhash64(*comparable)))
        some = ranked.where(divided).withColumn("once_more", (number <= F.col("more")).cast("bigint"))
        rows = whole.where(~divided).unionByName(some)
    copies = F.col("certain") + F.col("once_more")
    own = [F.col(new).alias(old) for old, new in names.items() if old not in ("copies", "taken")]
    taken = rows.where((F.col("size") > 0) & (copies > 0))
    return taken.select(*own, copies.cast("int").alias("copies"), (F.col("size") * copies).cast("bigint").alias("taken"))


ORACLE_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         coalesce(md5(text), '') AS digest FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS name FROM sized GROUP BY source),
levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         (1.5::DOUBLE * (SELECT sum(source_size)::DOUBLE FROM sources)
          - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight::DOUBLE) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, name ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM sources),
best AS (SELECT arg_min(lev, row(cap / weight, name)) AS lev FROM levels WHERE lev * weight <= cap),
targets AS (SELECT source, source_size, coalesce(least(cap, (SELECT lev FROM best) * weight), cap) AS target FROM levels),
docs AS (
  SELECT s.*, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS cls,
         (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || digest), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM sized s),
classes AS (SELECT source, cls, sum(size)::BIGINT AS words FROM docs GROUP BY source, cls),
filled AS (
  SELECT c.*, t.source_size, t.target, 2.0::DOUBLE * words AS cap, words / (1 + 0.05::DOUBLE * cls) AS w
  FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source),
flev AS (
  SELECT *, (target - coalesce(sum(cap) OVER (PARTITION BY source ORDER BY cap / w, cls ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (PARTITION BY source ORDER BY cap / w, cls ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM filled WHERE words > 0),
fbest AS (SELECT source, arg_min(lev, row(cap / w, cls)) AS lev FROM flev WHERE lev * w <= cap GROUP BY source),
copies AS (
  SELECT f.source, f.cls, f.words, f.source_size, f.target,
         CASE WHEN f.words > 0 THEN coalesce(least(2.0::DOUBLE, b.lev / (1 + 0.05::DOUBLE * f.cls)), 2.0::DOUBLE) ELSE 0 END AS copies
  FROM filled f LEFT JOIN fbest b ON f.source IS NOT DISTINCT FROM b.source),
parts AS (
  SELECT *, floor(copies)::BIGINT AS certain, copies - floor(copies) AS p,
         target - sum(floor(copies) * words) OVER (PARTITION BY source) AS rest FROM copies),
ranked AS (
  SELECT d.*, k.source_size, k.target, k.certain, k.rest,
         CASE WHEN p > 0 THEN ((u / (1 - u)) / (p / (1 - p))) / (1 + (u / (1 - u)) / (p / (1 - p))) END AS rank
  FROM docs d JOIN parts k ON d.source IS NOT DISTINCT FROM k.source AND d.cls = k.cls),
cum AS (
  SELECT *, row_number() OVER ordered AS place, CASE WHEN rank IS NOT NULL THEN sum(size) OVER ordered END AS running FROM ranked
  WINDOW ordered AS (PARTITION BY source, rank IS NULL ORDER BY rank, doc_id NULLS FIRST, digest ROWS UNBOUNDED PRECEDING)),
gaps AS (
  SELECT source, any_value(rest) - coalesce(max(running) FILTER (WHERE running <= rest), 0) AS gap FROM cum WHERE rank IS NOT NULL GROUP BY source),
closing AS (
  SELECT c.source, arg_min(c.place, row(abs(g.gap - c.size), c.place)) AS place
  FROM cum c JOIN gaps g ON c.source IS NOT DISTINCT FROM g.source
  WHERE c.running > c.rest AND c.size > 0 AND abs(g.gap - c.size) < g.gap GROUP BY c.source)
SELECT c.doc_id, c.size, c.source_size, c.target,
       (c.size * (c.certain + coalesce((c.running <= c.rest OR c.place = x.place)::BIGINT, 0)))::BIGINT AS taken
FROM cum c LEFT JOIN closing x ON c.source IS NOT DISTINCT FROM x.source AND c.rank IS NOT NULL
"""
