"""Quality by ordinal cumulative-link regression (operator 3).

Labelled documents get a grade: 0 poor, 1 usable but toxic, 2 good. A text
becomes a sparse vector of hashed features: its words, their first letters
(which catch inflected forms), and how common each word shape and repetition
is in it. One weight per feature is shared by all grades; ordered thresholds
cut the score into grades: P(grade >= k) = sigmoid(score - threshold_k). The
expected grade is the sum of these tails, and the tail of ``KEEP_GRADE``
selects documents.

Training uses a bounded sample: per grade the ``SAMPLE_DOCS`` labelled
documents first in hash order. Their features are computed on the executors;
the driver fits the weights of those that the grades relate to (a score test
of ``MIN_Z`` standard errors and ``MIN_EFFECT``; the others weigh nothing, so chance words and
long texts do not add up) by full-batch gradient steps. Every document is then
scored in Arrow batches against the broadcast weights, without a shuffle.

Defined cases: NULL or wordless texts have no features and score 0; labels
with a NULL grade part, of unknown documents, or conflicting ones (the lowest
grade counts) do no harm; without labels all weights are 0 and every tail is
1, so all is kept; repeated rows give repeated result rows; extra columns
are ignored (``grade``) or kept (``select``); whole texts are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema

#: Bound of the training sample: documents per grade.
SAMPLE_DOCS = 2000
#: Buckets per grade that are ranked on their own first.
SAMPLE_BUCKETS = 256
#: Hashed features (a power of two).
FEATURES = 1 << 18
#: Grades are 0 .. GRADES - 1; documents are kept by the tail of this grade.
GRADES, KEEP_GRADE, KEEP_TAIL = 3, 2, 0.7
#: Standard errors by which the grades of a feature's documents must stand out at some
#: threshold, and the same per square root of the sample size (an effect size).
MIN_Z, MIN_EFFECT = 4.5, 0.12
#: Gradient steps, step size and L2 penalty of the fit.
STEPS, RATE, PENALTY = 400, 0.05, 1e-4

PLAIN = re.compile(r"\w+")
SENTENCE_END = re.compile(r"^[.,;:?!]$")


def features(text: str | None) -> list[int]:
    """Sorted distinct feature numbers of a text."""
    tokens = (text or "").split()
    n = len(tokens)
    if not n:
        return []
    names: set[str] = set()
    shapes: Counter[str] = Counter()
    previous = None
    for token, times in Counter(tokens).items():
        word = PLAIN.search(token)
        low = word[0].lower() if word else ""
        names.add("w" + low)
        names.add("p" + low[:4])
        names.add("q" + low[:5])
        end = SENTENCE_END.sub("", token[word.end() :]) if word else token
        case = "u" if low and word[0].isupper() and len(low) > 1 else "l"
        shapes[f"s{case}{end[:3]}"] += times
        if times > 1 and times * 20 >= n:
            shapes["often"] += times
    for token in tokens:
        shapes["again"] += token == previous
        previous = token
    # a share counts by its step: 0-1 %, 1-5 %, 5-20 %, 20-50 %, above
    names.update(f"{shape}@{np.searchsorted((0.01, 0.05, 0.2, 0.5), count / n)}" for shape, count in shapes.items() if count)
    return sorted({zlib.crc32(x.encode()) & (FEATURES - 1) for x in names})


def featured(rows: DataFrame) -> DataFrame:
    """``doc_id, grade, features`` of rows with ``doc_id``, ``grade`` and ``text``."""
    schema = "doc_id bigint, grade int, features array<int>"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([features(t) for t in b.column(2).to_pylist()], out[2].type)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), found], schema=out)

    return rows.select(F.col("doc_id").cast("bigint"), F.col("grade").cast("int"), "text").mapInArrow(run, schema)


def grades(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` from the labels: poor 0, toxic 1, good 2; the lowest of several."""
    g = F.when(F.col("quality") <= 0, 0).when(F.col("toxic") > 0, 1).when(F.col("quality") > 0, 2)
    rows = labels.select("doc_id", g.alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL")
    return rows.groupBy("doc_id").agg(F.min("grade").alias("grade"))


class Model:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, found: list[int]) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        score = float(self.weights[found].sum())
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -60, 60)))


def fit(sample: pa.Table, population: dict[int, int]) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam steps on the whole sample.

    ``sample`` is ``featured`` (kept in arrays, not in Python objects). Each grade weighs as much as it does among all labelled documents
    (``population``), however many of them are in the sample.
    """
    weights = np.zeros(FEATURES)
    lengths = pc.list_value_length(sample["features"]).to_numpy()
    y = sample["grade"].to_numpy()[lengths > 0]
    if not len(y):
        return Model(weights, np.full(GRADES - 1, -60.0))
    rows = np.repeat(np.arange(len(y), dtype=np.int32), lengths[lengths > 0])
    cols = pc.list_flatten(sample["features"]).to_numpy()
    count = np.bincount(y, minlength=GRADES)
    even = 1 / (np.count_nonzero(count) * count[y])
    share = np.array([population[int(g)] for g in y]) / count[y]
    share /= share.sum()
    # score test, per threshold: how far the share of higher grades among a feature's documents is off, the grades weighing the same
    balance = even * len(y)
    seen = np.maximum(np.bincount(cols, balance[rows], FEATURES), 1)
    z = np.zeros(FEATURES)
    for k in range(1, GRADES):
        above = (y >= k).astype(float)
        centre = float(np.sum(even * above))
        spread = max((centre * (1 - centre)) ** 0.5, 1e-9)
        z = np.maximum(z, np.abs(np.bincount(cols, ((above - centre) * balance)[rows], FEATURES)) / (spread * np.sqrt(seen)))
    kept = z[cols] >= max(MIN_Z, MIN_EFFECT * len(y) ** 0.5)
    chosen, cols = np.unique(cols[kept], return_inverse=True)
    rows, own = rows[kept], np.zeros(len(chosen))
    cut = np.arange(1.0, GRADES) - GRADES / 2  # start: ordered and one apart
    padded = np.concatenate([[-60.0], cut, [60.0]])
    moments = [np.zeros(len(own)), np.zeros(len(own)), np.zeros(GRADES - 1), np.zeros(GRADES - 1)]
    for step in range(1, STEPS + 1):
        padded[1:-1] = cut
        score = np.bincount(rows, own[cols], len(y))
        above = 1 / (1 + np.exp(np.clip(padded[:, None] - score, -60, 60)))  # P(grade >= k), k = 0 .. GRADES
        slope = above * (1 - above)
        p = np.maximum(above[y, np.arange(len(y))] - above[y + 1, np.arange(len(y))], 1e-9)
        low, high = slope[y, np.arange(len(y))] / p * share, slope[y + 1, np.arange(len(y))] / p * share
        grad_w = np.bincount(cols, (high - low)[rows], len(own)) + PENALTY * own
        grad_c = np.bincount(y, low, GRADES)[1:] - np.bincount(y + 1, high, GRADES + 1)[1:-1]
        for x, g, m, v, rate in ((own, grad_w, moments[0], moments[1], RATE), (cut, grad_c, moments[2], moments[3], RATE)):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        cut[:] = np.maximum.accumulate(cut + np.arange(GRADES - 1) * 1e-3)
    weights[chosen] = own
    return Model(weights, cut)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded sample of labelled documents."""
    graded = grades(labels)
    population = {r.grade: r.n for r in graded.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    # at most GRADES * SAMPLE_DOCS ids, so the broadcast is bounded; of the rows of one id the one with the smallest digest
    labelled = docs.select("doc_id", "text").join(F.broadcast(sampled(graded)), "doc_id")
    sample = labelled.groupBy("doc_id", "grade").agg(F.min_by("text", F.coalesce(F.md5("text"), F.lit(""))).alias("text"))
    return fit(featured(sample).toArrow().sort_by([("doc_id", "ascending"), ("grade", "ascending")]), population)


def sampled(graded: DataFrame) -> DataFrame:
    """``doc_id, grade`` of the training sample: per grade the first documents in hash order.

    Ranked inside buckets of a grade first, then over what these leave, so
    that no task sorts all labels of a grade."""
    hashed = graded.withColumn("h", F.xxhash64("doc_id"))
    for bucket in (F.pmod("h", F.lit(SAMPLE_BUCKETS)), F.lit(0)):
        w = Window.partitionBy("grade", bucket).orderBy("h", "doc_id")
        hashed = hashed.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= SAMPLE_DOCS)
    return hashed.select("doc_id", "grade")


def _scorer(docs: DataFrame, model: Model) -> Callable:
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))

    @F.arrow_udf("array<double>")
    def score(text: pa.Array) -> pa.Array:
        own = Model(*shared.value)
        return pa.array([own.tails(features(t)).tolist() for t in text.to_pylist()], pa.list_(pa.float64()))

    return score


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, expected_grade, tail_prob, selected`` per row of ``docs``."""
    tails = docs.select("doc_id", _scorer(docs, model)("text").alias("tails"))
    tail = F.col("tails")[KEEP_GRADE - 1]
    total = F.aggregate("tails", F.lit(0.0), lambda a, x: a + x)
    return tails.select("doc_id", total.alias("expected_grade"), tail.alias("tail_prob"), (tail >= KEEP_TAIL).alias("selected"))


def select(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model keeps, unchanged."""
    return docs.where(_scorer(docs, model)("text")[KEEP_GRADE - 1] >= KEEP_TAIL)
