"""Language by compression with per-language dictionaries (operator 4).

Learning takes a bounded sample of labelled rows: per language the
``SAMPLE_DOCS`` documents first in hash order, each whole, and of these, in
that order, as many as fit into ``SAMPLE_CHARS`` code points together (a
document that does not fit is passed over; a language none of whose sampled
documents fits is learnt from pieces spread evenly over the shortest of them,
``SAMPLE_CHARS`` in all). Their texts, lower-cased and without ASCII signs and digits,
form that language's zstandard raw-content dictionary. A text is encoded with
every dictionary in pieces of ``PIECE`` bytes, so that the dictionary weighs
in a long text too. A piece counts at most ``CLIP`` times its smallest
encoding, so that one passage that a dictionary happens to contain does not
decide. The smallest total names the language; a narrow margin to the second
smallest rejects the answer (``rejected``), the best guess is still named.

Defined cases: NULL text or text without a letter is ``und`` with score 0 and
is not ``rejected``; equal sizes go to the first language by name, with
margin 0 (rejected); without any labelled row every text is ``und``; one
learned language is always chosen (margin 1); repeated rows give repeated
result rows; extra columns are ignored; whole texts are encoded.
"""

from __future__ import annotations

from math import exp

import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

#: Bound of the training sample: documents per language, code points per language.
SAMPLE_DOCS = 96
SAMPLE_CHARS = 96 * 8192
#: Buckets per language that are ranked on their own first, so that no task sorts all rows of one.
SAMPLE_BUCKETS = 256
#: Bytes of a text that are encoded at once.
PIECE = 512
#: Most that a piece counts in a language, as a multiple of its smallest encoding.
CLIP = 1.2
LEVEL = 3
#: Share of its size by which the second smallest encoding must be larger.
MIN_MARGIN = 0.02
#: Steepness with which a margin raises the score.
SHARPNESS = 25.0

SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalpha())

SCHEMA = "doc_id bigint, lang_pred string, score double, margin double, rejected boolean"

Model = list[tuple[str, bytes]]


def learn(labelled: DataFrame) -> Model:
    """``(language, dictionary content)`` by name, from rows with ``doc_id``, ``text`` and ``lang``."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "doc_id", "text", F.xxhash64("doc_id").alias("h"))
    # ranked by id, length and digest, bucket by bucket first; the texts themselves are fetched last
    keys = rows.select("lang", "doc_id", "h", F.length("text").alias("n"), F.md5("text").alias("digest"))
    order = ["h", "doc_id", "n", "digest"]
    bucket = F.pmod(F.xxhash64("digest", "doc_id"), F.lit(SAMPLE_BUCKETS))
    some = keys.withColumn("rank", F.row_number().over(Window.partitionBy("lang", bucket).orderBy(*order))).where(F.col("rank") <= SAMPLE_DOCS)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= SAMPLE_DOCS)
    left: dict[str, int] = {}
    taken: dict[tuple, int] = {}
    ranked = sorted(first.select("lang", "rank", "doc_id", "n", "digest").collect(), key=lambda r: (r.lang, r.rank))
    for r in ranked:
        key = r.lang, r.doc_id, r.digest
        if key not in taken and r.n <= left.setdefault(r.lang, SAMPLE_CHARS):
            left[r.lang] -= r.n
            taken[key] = r.rank
    for lang in left.keys() - {key[0] for key in taken}:
        r = min((r for r in ranked if r.lang == lang), key=lambda r: (r.n, r.rank))
        taken[lang, r.doc_id, r.digest] = r.rank
    if not taken:
        return []
    wanted = rows.sparkSession.createDataFrame([(*key, rank) for key, rank in taken.items()], "lang string, doc_id bigint, digest string, rank int")
    on = [rows["lang"] == wanted["lang"], rows["doc_id"].eqNullSafe(wanted["doc_id"]), F.md5(rows["text"]) == wanted["digest"]]
    piece = SAMPLE_CHARS // SAMPLE_DOCS
    start = lambda i: F.floor(i * (F.length(rows["text"]) - piece) / (SAMPLE_DOCS - 1)).cast("int") + 1
    spread = F.concat_ws("\n", F.transform(F.sequence(F.lit(0), F.lit(SAMPLE_DOCS - 1)), lambda i: F.substring(rows["text"], start(i), F.lit(piece))))
    text = F.when(F.length(rows["text"]) <= SAMPLE_CHARS, rows["text"]).otherwise(spread)
    # rows of one key have one text
    found = rows.join(F.broadcast(wanted), on).select(wanted["lang"], "rank", text.alias("text")).groupBy("lang", "rank").agg(F.first("text").alias("text"))
    texts: dict[str, list[str]] = {}
    for r in sorted(found.collect(), key=lambda r: (r.lang, r.rank)):
        texts.setdefault(r.lang, []).append(r.text)
    return [(lang, b"\n".join(map(_letters, own))) for lang, own in sorted(texts.items())]


def _letters(text: str) -> bytes:
    return text.lower().encode().translate(None, SIGNS)


class Classifier:
    """Encodes with every dictionary; built from the model in each worker, once."""

    def __init__(self, model: Model):
        self.model = model
        self.encoders: list | None = None

    def __getstate__(self):
        return {"model": self.model, "encoders": None}

    def sizes(self, text: str) -> list[float]:
        """Total size of the text's pieces in each language, clipped piece by piece."""
        if self.encoders is None:
            self.encoders = []
            for _, content in self.model:
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                self.encoders.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))
        data = _letters(text)
        totals = [0.0] * len(self.encoders)
        for at in range(0, len(data), PIECE):
            piece = data[at : at + PIECE]
            sizes = [len(e.compress(piece)) for e in self.encoders]
            most = min(sizes) * CLIP
            totals = [t + min(s, most) for t, s in zip(totals, sizes, strict=True)]
        return totals

    def predict(self, doc_id: int | None, text: str | None) -> tuple:
        if text is None or not self.model or not any(map(str.isalpha, text)):
            return doc_id, "und", 0.0, 0.0, False
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = [s for i, s in enumerate(sizes) if i != best]
        margin = min(others) / sizes[best] - 1 if others else 1.0
        score = 1 / (1 + sum(exp(-SHARPNESS * (s / sizes[best] - 1)) for s in others))
        return doc_id, self.model[best][0], score, margin, margin < MIN_MARGIN


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: language, score (0 to 1), margin, rejected."""
    return map_rows(docs, ["doc_id", "text"], Classifier(model).predict, SCHEMA)
