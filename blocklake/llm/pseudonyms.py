"""Format-preserving pseudonyms of personal numbers and dates.

Values are found in whole texts by pattern, checked (calendar, Luhn, mod 97, number plans, octets) and only then
permuted: a keyed Feistel network over the exact set of values of their format, with cycle walking where the set
is not a rectangle. The permutation depends on the key and the format alone, so equal values get equal pseudonyms
in every document and on every executor, different values stay different, and a pseudonym is again a valid value
of its format (punctuation, check digits and calendar included).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import short_batches
from blocklake.llm.shingles import batches

ROUNDS = 10
CACHE_VALUES = 1 << 18
FIRST_DAY = dt.date(1900, 1, 1).toordinal()
DAYS = dt.date(2100, 1, 1).toordinal() - FIRST_DAY
# English month names.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December"]


class Feistel:
    """A keyed permutation of 0 .. n - 1 for every n and tweak, and its inverse."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, half: int) -> int:
        h = blake2b(b"%d:%d:%b" % (i, half, tweak), key=self.key, digest_size=16)
        return int.from_bytes(h.digest(), "big")

    def _walk(self, x: int, n: int, tweak: bytes, order: list[int], sign: int, ok: Callable[[int], bool]) -> int:
        a = isqrt(max(n - 1, 0)) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(x, b)
            for i in order:
                if i % 2:
                    right = (right + sign * self._round(tweak, i, left)) % b
                else:
                    left = (left + sign * self._round(tweak, i, right)) % a
            x = left * b + right
            if x < n and ok(x):
                return x

    def permute(self, x: int, n: int, tweak: str, ok: Callable[[int], bool] = lambda _: True) -> int:
        return self._walk(x, n, tweak.encode(), list(range(ROUNDS)), 1, ok)

    def restore(self, x: int, n: int, tweak: str, ok: Callable[[int], bool] = lambda _: True) -> int:
        return self._walk(x, n, tweak.encode(), list(range(ROUNDS))[::-1], -1, ok)


def luhn(digits: str) -> int:
    """The check sum of a whole number (0 if valid)."""
    doubled = [int(c) for c in digits[-2::-2]]
    return (sum(int(c) for c in digits[-1::-2]) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10


def _refill(text: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in text)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _grouped(change: Callable[[str, Callable], str | None]) -> Callable:
    """Try the whole match, then without its last groups: numbers may stand next to other numbers.

    Only what was changed is returned, which may be shorter than the match: the rest is searched again.
    """
    def run(m: re.Match, f: Callable) -> str | None:
        cuts = [len(m[0]), *[i for i in range(len(m[0]) - 1, 0, -1) if m[0][i] in " -"]]
        return next((new for z in cuts if (new := change(m[0][:z], f)) is not None), None)

    return run


def _card(value: str, f: Callable) -> str | None:
    d = _digits(value)
    if not 13 <= len(d) <= 19 or luhn(d) or len(set(d)) == 1:
        return None
    body = f"{f(int(d[1:-1]), 10 ** (len(d) - 2), f'card{len(d)}{d[0]}'):0{len(d) - 2}d}"
    return _refill(value, d[0] + body + str(-luhn(d[0] + body + "0") % 10))


def _iban(text: str, f: Callable) -> str | None:
    s = text.replace(" ", "")
    value = lambda x: int("".join(str(int(c, 36)) for c in x))
    if not 15 <= len(s) <= 34 or value(s[4:] + s[:4]) % 97 != 1:
        return None
    d = _digits(s[4:])
    if not d:
        return None
    shape = re.sub("[0-9]", "0", s[4:])
    body = _refill(shape, f"{f(int(d), 10 ** len(d), f'iban{s[:2]}{shape}'):0{len(d)}d}")
    check = f"{98 - value(body + s[:2] + '00') % 97:02d}"
    it = iter(s[:2] + check + body)
    return "".join(c if c == " " else next(it) for c in text)


def _ssn(m: re.Match, f: Callable) -> str | None:
    def ok(x: int) -> bool:
        area, rest = divmod(x, 10**6)
        return area not in (0, 666) and area < 900 and rest // 10**4 > 0 and rest % 10**4 > 0

    x = int(_digits(m[0]))
    return _refill(m[0], f"{f(x, 10**9, 'ssn', ok):09d}") if ok(x) else None


def _ip(m: re.Match, f: Callable) -> str | None:
    parts = [int(p) for p in m[0].split(".")]
    if any(p > 255 for p in parts) or any(p != str(int(p)) for p in m[0].split(".")):
        return None
    # Addresses that no single host has (first octet 0, or 224 and over) stay among themselves.
    host = lambda x: 1 <= x >> 24 <= 223
    x = int.from_bytes(bytes(parts), "big")
    inside = host(x)
    x = f(x, 1 << 32, "ip" if inside else "ip-other", lambda v: host(v) == inside)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _phone(m: re.Match, f: Callable) -> str | None:
    lead = m["lead"] or ""
    d = _digits(m[0][len(lead):])
    if m["nanp"]:
        # Numbers outside the plan count where the country code or brackets say what they are, among themselves.
        plan = lambda x: x // 10**9 >= 2 and x // 10**6 % 10 >= 2
        inside = plan(int(d))
        if not (inside or lead or m["nanp"][0] == "("):
            return None
        new = f(int(d), 10**10, f"nanp{inside}", lambda x: plan(x) == inside)
        return lead + _refill(m[0][len(lead):], f"{new:010d}")
    if not 8 <= len(d) <= 15:
        return None
    keep = d[:2]  # most of the country code
    return lead + _refill(m[0][len(lead):], keep + f"{f(int(d[2:]), 10 ** (len(d) - 2), f'tel{len(d)}{keep}'):0{len(d) - 2}d}")


def _day(y: int, m: int, d: int) -> int | None:
    try:
        x = dt.date(y, m, d).toordinal() - FIRST_DAY
    except ValueError:
        return None
    return x if 0 <= x < DAYS else None


def _move(x: int | None, tweak: str, f: Callable, ok: Callable[[dt.date], bool]) -> dt.date | None:
    of = lambda v: dt.date.fromordinal(v + FIRST_DAY)
    return of(f(x, DAYS, tweak, lambda v: ok(of(v)))) if x is not None and ok(of(x)) else None


def _ymd(m: re.Match, f: Callable) -> str | None:
    day = _move(_day(int(m[1]), int(m[3]), int(m[4])), "date", f, lambda _: True)
    return day and f"{day.year:04d}{m[2]}{day.month:02d}{m[2]}{day.day:02d}"


def _numeric(m: re.Match, f: Callable) -> str | None:
    """Two fields and a year. With slashes the month is first, else the day; a first field over 12 is a day.

    Forms keep apart: days over 12 move among those where the order would be read otherwise, and unpadded dates
    among those that show it, so no two dates of a text form meet.
    """
    a, sep, b, y = m[1], m[2], m[3], m[4]
    padded = len(a) == len(b) == 2
    if not padded and "0" in (a[0], b[0]):
        return None
    swapped = sep == "/" and int(a) > 12
    day, month = (a, b) if swapped or sep != "/" else (b, a)
    ok = lambda d: (d.day > 12 or not swapped) and (padded or d.day < 10 or d.month < 10)
    got = _move(_day(int(y), int(month), int(day)), f"date{swapped}{padded}", f, ok)
    if got is None:
        return None
    first, second = (got.day, got.month) if swapped or sep != "/" else (got.month, got.day)
    return f"{first:02d}{sep}{second:02d}{sep}{got.year:04d}" if padded else f"{first}{sep}{second}{sep}{got.year:04d}"


def _named(m: re.Match, f: Callable) -> str | None:
    month = MONTHS.index(m["m1"] or m["m2"]) + 1
    got = _move(_day(int(m["y1"] or m["y2"]), month, int(m["d1"] or m["d2"])), "date", f, lambda _: True)
    if got is None:
        return None
    name = MONTHS[got.month - 1]
    return f"{name} {got.day}, {got.year:04d}" if m["m1"] else f"{got.day} {name} {got.year:04d}"


_NAMES = "|".join(MONTHS)
_A, _Z = r"(?<![0-9A-Za-z.+-])", r"(?![0-9A-Za-z]|[.-][0-9])"
_TIME = r"(?!(?![Tt][0-9]{2})[0-9A-Za-z]|[.-][0-9])"  # as _Z, but the time of a timestamp may follow
#: In order of precedence where matches overlap.
KINDS: list[tuple[str, re.Pattern, Callable]] = [
    ("iban", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![0-9A-Za-z])"), _grouped(_iban)),
    # The usual groupings first, so that a number before or after a card is not taken into it by chance.
    ("card", re.compile(r"(?<![0-9A-Za-z])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?|"
                        r"[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}|[0-9]{13,19})(?![0-9A-Za-z])"), _grouped(_card)),
    ("card", re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"), _grouped(_card)),
    ("date", re.compile(_A + r"([0-9]{4})([-/.])([0-9]{2})\2([0-9]{2})" + _TIME), _ymd),
    ("date", re.compile(_A + r"([0-9]{1,2})([-/.])([0-9]{1,2})\2([0-9]{4})" + _Z), _numeric),
    ("date", re.compile(rf"\b(?:(?P<m1>{_NAMES}) (?P<d1>[1-9][0-9]?), (?P<y1>[0-9]{{4}})|"
                        rf"(?P<d2>[1-9][0-9]?) (?P<m2>{_NAMES}) (?P<y2>[0-9]{{4}}))(?![0-9])"), _named),
    ("ip", re.compile(_A + r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}" + _Z), _ip),
    ("ssn", re.compile(_A + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _Z), _ssn),
    ("phone", re.compile(r"(?<![0-9A-Za-z.+-])(?P<lead>\+1[ .-]?)?(?P<nanp>\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|"
                         r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|(?<=\+1)[0-9]{10})" + _Z
                         + r"|(?<![0-9A-Za-z+])\+(?!1)[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]\)?){6,12}" + _Z), _phone),
]
#: Kinds written in groups: where a match fails, the next group may be the first of a value.
GROUPED = {"iban", "card"}
_SOME = re.compile("[0-9]")


def _matches(pattern: re.Pattern, text: str, taken: list[tuple[int, int]], regroup: bool) -> Iterator[re.Match]:
    """Matches outside the sorted spans `taken`. The receiver sends the length it used of each, 0 for none.

    With `regroup`, the search goes on right after what was used (after the first character if nothing was), and a
    match that runs into a span is cut before it; otherwise it goes on after the whole match.
    """
    at = k = 0
    while m := pattern.search(text, at):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        at = m.end()
        if k < len(taken) and taken[k][0] < m.end():
            if not regroup:
                continue
            start, at = m.start(), m.start() + 1
            if taken[k][0] <= start:
                at = taken[k][1]
                continue
            if (m := pattern.match(text, start, taken[k][0])) is None:
                continue
        used = yield m
        if regroup:
            at = m.start() + (used or 1)


class Pseudonymizer:
    """Replaces the values of texts; remembers a bounded number of values it has met."""

    def __init__(self, key: bytes):
        self.permute = Feistel(key).permute
        self.met: dict[tuple[int, str], str | None] = {}

    def __call__(self, text: str) -> tuple[str, list[str]]:
        """(text with pseudonyms, kind of each value replaced, in order)."""
        if not _SOME.search(text):
            return text, []
        found: list[tuple[int, int, str, str]] = []
        taken: list[tuple[int, int]] = []
        for k, (kind, pattern, change) in enumerate(KINDS):
            matches, used = _matches(pattern, text, taken, kind in GROUPED), None
            while True:
                try:
                    m = matches.send(used)
                except StopIteration:
                    break
                if (k, m[0]) not in self.met:
                    if len(self.met) >= CACHE_VALUES:
                        self.met.clear()
                    self.met[k, m[0]] = change(m, self.permute)
                new, used = self.met[k, m[0]], 0
                if new is not None:
                    used = len(new) if kind in GROUPED else len(m[0])
                    found.append((m.start(), m.start() + used, new, kind))
            taken = sorted((a, z) for a, z, _, _ in found)
        out, at = [], 0
        for a, z, new, _ in sorted(found):
            out += [text[at:a], new]
            at = z
        return "".join([*out, text[at:]]), [kind for *_, kind in sorted(found)]


def pseudonymize(docs: DataFrame, key: str, text: str = "text", kinds: str = "pii") -> DataFrame:
    """All columns of `docs` with the text's personal numbers and dates replaced, and the kinds found (an array).

    Null texts stay null, with no kinds. Rows are independent: repeated rows and ids get equal results. Extra
    columns pass through; one already called `kinds` is replaced. Whole texts are read, however long.
    """
    kept = [c for c in docs.columns if c != kinds]
    source = short_batches(docs).select(*[F.col(f"`{c}`") for c in kept])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = Pseudonymizer(key.encode())
        for rb in it:
            at, i = 0, kept.index(text)
            for part in batches(x.as_buffer() if x.is_valid else None for x in rb.column(i)):
                got = [(None, []) if t is None else change(t.to_pybytes().decode("utf-8", "replace")) for t in part]
                cols = rb.slice(at, len(part)).columns
                cols[i] = pa.array([t for t, _ in got], rb.schema.field(i).type)
                yield pa.RecordBatch.from_arrays([*cols, pa.array([k for _, k in got], pa.list_(pa.string()))], [*kept, kinds])
                at += len(part)

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField(kinds, T.ArrayType(T.StringType()))]))
