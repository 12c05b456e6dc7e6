"""Format-preserving Feistel pseudonyms for personal data (operator 6).

Each validated value is replaced by another valid value of the same format: a
keyed balanced-as-possible Feistel network permutes the value's digits (or
its day number), walking on until the result is valid again. The canonical
value is permuted within its own class (a dialled number within its country
code, a date within the days above the 12th or up to it) and then written in
the layout that was found, so equal values, also when written in another
layout, get equal pseudonyms in every document, and different values of a kind
stay different. Texts are changed one by one in Arrow batches; nothing is
shuffled and there is no table of values to keep.

Kinds: card numbers (Luhn valid; the check digit is made anew), calendar
dates (1900-2099, to the same layout), social security numbers, IBANs (check
digits made anew), phone numbers (country code kept; a number written the
North American way without a code has code 1; a ``(0)`` after the code is not
part of the number), IPv4 addresses, IPv6 addresses (first group kept) and the
local part of email addresses (letter stays a letter of its alphabet, digit
stays digit).

Defined cases: NULL text stays NULL with no findings; values that fail their
validation (Luhn, calendar, octet range) are left alone; overlapping
candidates go to the leftmost; repeated rows give repeated result rows; extra
columns are ignored by ``pseudonyms``; whole texts are read.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.llm.common import map_rows

ROUNDS = 10

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# letters of email addresses beyond ASCII: Latin, Greek, Cyrillic, and accents of their own
LETTERS = "A-Za-z\u00c0-\u024f\u0300-\u036f\u0370-\u03ff\u0400-\u04ff"
# a group of a dialled number, not the start of a card number beside it
GROUP = r"(?:[ .-](?!\d{4}[ -]\d{4}[ -]\d{4})\d{1,8})"
# fixed values: the country codes of one and of two digits; all others have three
SHORT_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)


def _alphabet(first: int, last: int) -> str:
    """The lower-case letters of a range that have one upper-case letter of their own."""
    return "".join(c for c in map(chr, range(first, last + 1)) if c.islower() and len(c.upper()) == 1 and c.upper() != c and c.upper().lower() == c)


ALPHABETS = ("0123456789", _alphabet(0x61, 0x7A), _alphabet(0xC0, 0x24F), _alphabet(0x370, 0x3FF), _alphabet(0x400, 0x4FF))
#: Alphabet and place in it of every letter and digit.
PLACE = {c: (k, i) for k, a in enumerate(ALPHABETS) for i, c in enumerate(a)}

PATTERN = re.compile(
    "|".join(
        (
            rf"(?P<email>[{LETTERS}0-9._%+-]+@[{LETTERS}0-9-]+(?:\.[{LETTERS}0-9-]+)*\.[{LETTERS}]{{2,}})",
            r"(?P<ipv6>(?<![\w:.])(?:[23][0-9A-Fa-f]{3}|[fF][c-eC-E][0-9A-Fa-f]{2})(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:]|\.\d))",
            rf"(?P<ip>(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d))",
            r"(?P<date>(?<!\d)(?:\d{4}(?P<d1>[-/.])\d{2}(?P=d1)\d{2}|\d{2}(?P<d2>[-/.])\d{2}(?P=d2)\d{4})(?!\d))",
            r"(?P<phone>\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
            rf"|(?:\+|(?<![\d.,+-])00(?=[\d(]+[ .-]))[1-9]\d{{0,4}}(?:[ .-]?\(\d{{1,5}}\)[ .-]?\d{{1,8}}{GROUP}{{0,4}}|{GROUP}{{1,5}})(?!\d)"
            r"|\+[1-9]\d{7,14}(?!\d)"
            r"|(?<![\d-])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}(?P<p1>[ .-])\d{3}(?P=p1)\d{4}(?!\d))",
            r"(?P<card>(?<!\d)(?:\d{4}(?P<c1>[ -])\d{4}(?P=c1)\d{4}(?P=c1)\d{1,7}|\d{4}(?P<c2>[ -])\d{6}(?P=c2)\d{5}|\d{13,19})(?!\d))",
            r"(?P<ssn>(?<!\d)\d{3}-\d{2}-\d{4}(?!\d))",
            r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9]))",
        )
    ),
    re.ASCII,
)
DAY_0, DAY_N = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

SCHEMA = "doc_id bigint, text string, n_pii bigint, kinds string"


class Pseudonyms:
    """Keyed permutations of numbers and their use in texts."""

    def __init__(self, key: bytes):
        self.key = key

    def permute(self, kind: str, value: int, size: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        """A keyed permutation of the valid values below ``size`` (cycle walking over a Feistel network)."""
        bits = max(2, (size - 1).bit_length())
        right = bits // 2
        left = bits - right
        while True:
            a, b = value >> right, value & ((1 << right) - 1)
            la, lb = left, right
            for i in range(ROUNDS):
                f = hashlib.blake2b(f"{kind}|{size}|{i}|{b}".encode(), key=self.key, digest_size=16).digest()
                a, b = b, a ^ (int.from_bytes(f, "big") & ((1 << la) - 1))
                la, lb = lb, la
            value = a << lb | b
            if value < size and valid(value):
                return value

    def digits(self, kind: str, s: str, valid: Callable[[str], bool] = lambda _: True) -> str:
        n = len(s)
        return f"{self.permute(f'{kind}{n}', int(s), 10**n, lambda v: valid(f'{v:0{n}d}')):0{n}d}"

    # one method per kind: the replacement, or None if the candidate is not valid

    def email(self, s: str) -> str:
        local, _, domain = s.rpartition("@")
        places = [PLACE.get(c.lower()) for c in local]
        value, size = 0, 1
        for p in places:
            if p:
                base = len(ALPHABETS[p[0]])
                value, size = value * base + p[1], size * base
        if size == 1:
            return s
        # the layout (where letters, digits and signs stand) is part of the permutation's name
        layout = "".join("0abcd"[p[0]] if p else c for c, p in zip(local, places, strict=True))
        value = self.permute(f"email{layout}@{domain.lower()}", value, size)
        out = []
        for c, p in zip(reversed(local), reversed(places), strict=True):
            if p:
                value, place = divmod(value, len(ALPHABETS[p[0]]))
                new = ALPHABETS[p[0]][place]
                c = new.upper() if c.isupper() else new
            out.append(c)
        return "".join(reversed(out)) + "@" + domain

    def ip(self, s: str) -> str:
        a = [int(x) for x in s.split(".")]
        usual = lambda v: 1 <= v >> 24 < 255
        value = a[0] << 24 | a[1] << 16 | a[2] << 8 | a[3]
        same = usual(value)
        v = self.permute("ip", value, 1 << 32, lambda v: usual(v) == same)
        return f"{v >> 24}.{v >> 16 & 255}.{v >> 8 & 255}.{v & 255}"

    def ipv6(self, s: str) -> str | None:
        try:
            value = int(ipaddress.IPv6Address(s))
        except ValueError:
            return None
        head, own = value >> 112, value & ((1 << 112) - 1)
        new = ipaddress.IPv6Address(head << 112 | self.permute(f"ipv6{head:x}", own, 1 << 112))
        text = new.exploded if len(s) == 39 else str(new)
        return text.upper() if s != s.lower() else text

    def date(self, s: str) -> str | None:
        year_first = s[:4].isdigit()
        a, b, c = re.split(r"[-/.]", s)
        sign = s[4] if year_first else s[2]
        # 31/12 and 12/31 are told apart by their validity; both read as day first if they can
        orders = [(a, b, c)] if year_first else [(c, b, a), (c, a, b)]
        for k, (y, m, d) in enumerate(orders):
            try:
                day = dt.date(int(y), int(m), int(d)).toordinal()
            except ValueError:
                continue
            if not DAY_0 <= day <= DAY_N:
                return None
            # a day above the 12th stays one: a month-first date cannot be read day first afterwards
            late = dt.date.fromordinal(day).day > 12
            valid = lambda v: (dt.date.fromordinal(DAY_0 + v).day > 12) == late  # noqa: B023, E731
            new = dt.date.fromordinal(DAY_0 + self.permute("date", day - DAY_0, DAY_N - DAY_0 + 1, valid))
            parts = (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}")
            return sign.join(parts if year_first else (parts[1], parts[2], parts[0]) if k else parts[::-1])
        return None

    def phone(self, s: str) -> str | None:
        digits = re.sub(r"\D", "", s)
        coded = s[0] == "+" or s.startswith("00")
        if not coded:
            code, keep = "1", 0
        else:
            start = 0 if s[0] == "+" else 2
            code = next((digits[start : start + n] for n in (1, 2) if digits[start : start + n] in SHORT_CODES), digits[start : start + 3])
            if not 7 <= len(digits) - start <= 15:
                return None
            keep = start + len(code) + bool(re.match(rf"\+?{digits[: start + len(code)]}[ .-]?\(0\)", s))
        own = digits[keep:]
        if not own:
            return None
        usual = lambda x: code == "1" and len(x) == 10 and x[0] >= "2" and x[3] >= "2"
        same = usual(own)
        return _refill(s, digits[:keep] + self.digits(f"phone{code}.", own, lambda x: usual(x) == same))

    def card(self, s: str) -> str | None:
        digits = re.sub(r"\D", "", s)
        if _luhn(digits) or len(set(digits)) == 1:
            return None
        body = digits[0] + self.digits(f"card{digits[0]}", digits[1:-1])
        return _refill(s, body + str(-_luhn(body + "0") % 10))

    def ssn(self, s: str) -> str | None:
        def valid(x: str) -> bool:
            return x[:3] not in ("000", "666") and x[0] != "9" and x[3:5] != "00" and x[5:] != "0000"

        digits = s.replace("-", "")
        return _refill(s, self.digits("ssn", digits, valid)) if valid(digits) else None

    def iban(self, s: str) -> str | None:
        flat = s.replace(" ", "")
        if not 15 <= len(flat) <= 34 or _mod97(flat[4:] + flat[:4]) != 1:
            return None
        own = "".join(c for c in flat[4:] if c.isdigit())
        if not own:
            return None
        body = _refill(flat[4:], self.digits(f"iban{flat[:2]}", own))
        check = 98 - _mod97(body + flat[:2] + "00")
        new = iter(flat[:2] + f"{check:02d}" + body)
        return "".join(" " if c == " " else next(new) for c in s)

    def replace(self, text: str) -> tuple[str, Counter]:
        """The text with its valid values replaced, and the number of each kind."""
        found: Counter = Counter()
        if not re.search(r"[\d@]|::", text):
            return text, found

        def one(m: re.Match) -> str:
            new = getattr(self, m.lastgroup)(m[0])
            if new is None:
                return m[0]
            found[m.lastgroup] += 1
            return new

        return PATTERN.sub(one, text), found

    def row(self, doc_id: int | None, text: str | None) -> tuple:
        if text is None:
            return doc_id, None, 0, ""
        new, found = self.replace(text)
        return doc_id, new, sum(found.values()), ",".join(f"{k}:{found[k]}" for k in sorted(found))


def _refill(layout: str, digits: str) -> str:
    """``layout`` with its digits replaced, in order, by ``digits``."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in layout)


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _mod97(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s)) % 97


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """One row per row of ``docs``: doc_id, the text with pseudonyms, number and kinds of values found."""
    return map_rows(docs, ["doc_id", "text"], Pseudonyms(key).row, SCHEMA)
