"""Secret scan with multipart credential linking (operator 2).

A text is scanned once for parts. Base parts are strong by themselves: an
assigned password or token, an access id, a long hex string. Weak parts (a
user name, an endpoint, a random-looking token, an assigned password or token
of less than 8 characters) say little alone. An interval join within scopes
decides about them: a weak part is reported only if a part of a complementary
role lies in the same paragraph, at most ``REACH`` code points away. A short
password confirms a user name or an endpoint only if both are there. The join is a sorted sweep over one document's parts (prefix
maximum of the ends, binary search), so it needs no shuffle and m parts cost
m log m, never m * m.

Defined cases: a NULL text counts as empty; a text without parts gives zero
counts, the hash of the empty string and empty ``spans``; repeated rows give
repeated result rows; extra columns are ignored (``scan``) or kept
(``redact``); whole texts are scanned, whatever their length.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

#: Largest distance, in code points, between linked parts of one scope.
REACH = 400
#: Bits per character from which a token looks random.
MIN_ENTROPY = 3.6

FLAGS = re.ASCII | re.IGNORECASE
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", FLAGS)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
USER = re.compile(r"""(?<![A-Za-z0-9])(?:user(?:_?name|_?id)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?[^\s"',;]{3,}""", FLAGS)
HOST = re.compile(r"""(?:[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{4,})|(?<![A-Za-z0-9])(?:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[^\s"',;]{4,}""", FLAGS)
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
SCOPE_END = re.compile(r"\n[ \t]*\n")

#: Order in which kinds are listed at one start.
KINDS = ("assign", "access", "hex", "user", "endpoint", "random", "weak")
ROLE = {"assign": "secret", "hex": "secret", "random": "secret", "weak": "weak secret", "access": "id", "user": "id", "endpoint": "place"}
WEAK = {"user", "endpoint", "random", "weak"}
#: Roles that confirm a weak part of a kind: all of one of the sets.
CONFIRMED_BY = {
    "user": ({"secret"}, {"weak secret", "place"}), "endpoint": ({"secret"}, {"weak secret", "id"}),
    "random": ({"id"}, {"place"}), "weak": ({"id"}, {"place"}),
}
MIN_ASSIGNED = 8

SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_linked bigint"


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values())


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the strong parts, leftmost and non-overlapping per kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def linked_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The weak parts that a complementary part of the same scope confirms."""
    weak: list[tuple[int, int, str]] = []
    if ":" in text or "=" in text:
        weak += [(m.start(), m.end(), "user") for m in USER.finditer(text)]
        weak += [(m.start(), m.end(), "endpoint") for m in HOST.finditer(text)]
    if not any(ROLE[k] in ("id", "place") for _, _, k in [*base, *weak]):
        return []  # a random token or a short password needs an id or a place beside it
    if ":" in text or "=" in text:
        weak += [(m.start(), m.end(), "weak") for m in ASSIGN.finditer(text) if len(m[2]) < MIN_ASSIGNED]
    taken = sorted((s, e) for s, e, _ in [*base, *weak])
    starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    for m in RANDOM.finditer(text):
        i = bisect_left(starts, m.end())
        if (not i or reach[i - 1] <= m.start()) and re.search(r"\d", m[0]) and re.search(r"[A-Za-z]", m[0]) and _entropy(m[0]) >= MIN_ENTROPY:
            weak.append((m.start(), m.end(), "random"))
    if not weak:
        return []
    ends = [0, *(m.end() for m in SCOPE_END.finditer(text)), len(text) + 1]
    by_role = {}
    for role in set(ROLE.values()):
        own = sorted((s, e) for s, e, k in [*base, *weak] if ROLE[k] == role)
        by_role[role] = [s for s, _ in own], list(accumulate((e for _, e in own), max))
    kept = []
    for s, e, kind in weak:
        i = bisect_left(ends, s + 1)
        low, high = max(ends[i - 1], s - REACH), min(ends[i], e + REACH)
        near = set()
        for role, (begins, last) in by_role.items():
            i = bisect_left(begins, high)
            if i and last[i - 1] > low:
                near.add(role)
        # an endpoint beside a user name is an ordinary link: only secrets confirm either
        if any(need <= near for need in CONFIRMED_BY[kind]):
            kept.append((s, e, kind))
    return kept


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def _digest(doc_id: int | None, text: str | None) -> tuple:
    text = text or ""
    base = base_spans(text)
    linked = linked_spans(text, base)
    n = Counter(k for _, _, k in base)
    sha = hashlib.sha256(_listed(base).encode()).hexdigest()
    return doc_id, n["assign"], n["access"], n["hex"], sha, _listed(base + linked), len(linked)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts, digest of the base spans, all spans, linked spans."""
    return map_rows(docs, ["doc_id", "text"], _digest, SCHEMA)


def redact_text(text: str | None) -> str | None:
    """The text with every reported span replaced by ``[kind]``; overlapping spans become one."""
    if not text:
        return text
    base = base_spans(text)
    spans = sorted(base + linked_spans(text, base), key=lambda x: (x[0], -x[1]))
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out.append(text[at:s] + f"[{kind}]")
        at = max(at, e)
    return "".join(out) + text[at:] if spans else text


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced and ``n_chars`` brought in line; all rows stay."""

    @F.arrow_udf("string")
    def clean(text: pa.Array) -> pa.Array:
        return pa.array([redact_text(t) for t in text.to_pylist()], pa.string())

    out = docs.withColumn("text", clean("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
