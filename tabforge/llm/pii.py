"""Format-preserving pseudonyms for personal data.

A value that passes its format's check (Luhn, mod 97, calendar, octets, ...)
is numbered within the set of valid values of that format, the number goes
through a keyed Feistel permutation of that set, and the result is written
back in the same layout.  Equal values get equal pseudonyms wherever they
stand, different values different ones, and the key holder can undo it."""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tabforge.llm.common import frugal, keeps, only, prepare, slices

ROUNDS = 8
KINDS = ("email", "card", "iban", "ssn", "phone", "ip", "date", "secret")
_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

#: In the order in which they are tried where several start together.
_FORMS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}(?=@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8})",
    # The name of the mail host, without its top-level domain.
    "host": r"(?<=[A-Za-z0-9._%+-]@)[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,7}(?=\.[A-Za-z]{2,63}(?![A-Za-z0-9-]|\.[A-Za-z0-9]))",
    "iban": r"\b[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]){11,30}\b",
    "date": r"(?<![\d.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?!\d|[.-]\d)",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!-?\d)",
    "phone": r"""(?<![\w+])(?:\+\d{1,3}[ .-]?|1[ .-])?(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)
        |(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)""",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])",
    "secret": r"""(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])
        |(?<=[=:"' ])(?<![A-Za-z0-9])(?:(?=[0-9a-f]*\d)(?=[0-9a-f]*[a-f])[0-9a-f]{16,64}
            |(?=[0-9A-F]*\d)(?=[0-9A-F]*[A-F])[0-9A-F]{16,64})(?![A-Za-z0-9])""",
}
_ORDER = tuple(_FORMS)
_FORM = {kind: re.compile(form, re.X) for kind, form in _FORMS.items()}
_PATTERN = re.compile("|".join(f"(?P<{kind}>{form})" for kind, form in _FORMS.items()), re.X)
_IBAN_LENGTH = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 "
    "ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 "
    "LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 "
    "PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 "
    "YE30").split()}
_MAYBE = re.compile(r"[\d@]")


class Feistel:
    """A keyed permutation of ``range(n)`` for any ``n``: a number is a pair
    (high, low) of near-equal halves, each round adds a keyed digest of one
    half to the other, and results outside the range go round again."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        if len(key) < 16:
            raise ValueError("the key needs 16 bytes or more")
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def _digest(self, tweak: str, n: int, rnd: int, half: int, size: int) -> int:
        text = f"{tweak}/{n}/{rnd}/{half}".encode()
        out = b""
        while len(out) < (size.bit_length() + 7) // 8 + 8:
            out += hashlib.blake2b(text + bytes([len(out) & 255]), key=self.key, digest_size=32).digest()
        return int.from_bytes(out, "big") % size

    def _sizes(self, n: int) -> tuple[int, int]:
        a = math.isqrt(n - 1) + 1
        return a, -(-n // a)

    def permute(self, x: int, n: int, tweak: str) -> int:
        if n < 2:
            return x
        a, b = self._sizes(n)
        while True:
            high, low = divmod(x, b)
            for r in range(self.rounds):
                if r % 2:
                    low = (low + self._digest(tweak, n, r, high, b)) % b
                else:
                    high = (high + self._digest(tweak, n, r, low, a)) % a
            x = high * b + low
            if x < n:
                return x

    def restore(self, x: int, n: int, tweak: str) -> int:
        if n < 2:
            return x
        a, b = self._sizes(n)
        while True:
            high, low = divmod(x, b)
            for r in reversed(range(self.rounds)):
                if r % 2:
                    low = (low - self._digest(tweak, n, r, high, b)) % b
                else:
                    high = (high - self._digest(tweak, n, r, low, a)) % a
            x = high * b + low
            if x < n:
                return x


def luhn(digits: str) -> int:
    """Check digit that makes ``digits`` plus it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def _refill(layout: str, new: str) -> str:
    """``layout`` with its letters and digits replaced in order."""
    it = iter(new)
    return "".join(next(it) if c.isalnum() else c for c in layout)


def _by_class(text: str, go: Callable[[int, int], int]) -> str:
    """Permute letters and digits place by place within their classes."""
    radix = [10 if c.isdigit() else 26 for c in text]
    x = 0
    for c, r in zip(text, radix, strict=True):
        x = x * r + (ord(c) - (48 if r == 10 else 97 if c.islower() else 65))
    x, out = go(x, math.prod(radix)), []
    for c, r in zip(reversed(text), reversed(radix), strict=True):
        x, d = divmod(x, r)
        out.append(chr(d + (48 if r == 10 else 97 if c.islower() else 65)))
    return "".join(reversed(out))


def _email(v: str, go) -> str:
    return _refill(v, _by_class("".join(filter(str.isalnum, v)), go))


def _card(v: str, go) -> str | None:
    d = "".join(filter(str.isdigit, v))
    if not 13 <= len(d) <= 19 or d[0] not in "23456" or luhn(d[:-1]) != int(d[-1]):
        return None
    body = d[0] + str(go(int(d[1:-1]), 10 ** (len(d) - 2))).zfill(len(d) - 2)
    return _refill(v, body + str(luhn(body)))


def _mod97(body: str, country: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _is_iban(v: str) -> bool:
    s = v.replace(" ", "")
    return 15 <= len(s) <= 34 and _mod97(s[4:], s[:2]) == int(s[2:4])


def _iban_end(v: str) -> int | None:
    """Where ``v`` has the length of its country, if that is a boundary."""
    n = _IBAN_LENGTH.get(v[:2])
    for i, c in enumerate(v):
        if n is not None and c != " ":
            n -= 1
            if not n:
                return i + 1 if i + 1 == len(v) or v[i + 1] == " " else None
    return None


def _iban(v: str, go) -> str | None:
    if not _is_iban(v):
        return None
    s, end = v.replace(" ", ""), _iban_end(v)
    body = s[4:]
    while True:     # walk on until no shorter one is found first
        body = _by_class(body, go)
        new = _refill(v, s[:2] + f"{_mod97(body, s[:2]):02d}" + body)
        if end in (None, len(v)) or not _is_iban(new[:end]):
            return new


def _ssn(v: str, go) -> str | None:
    area, group, serial = map(int, v.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    x, serial = divmod(go(x, 898 * 99 * 9999), 9999)
    area, group = divmod(x, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(v: str, go) -> str | None:
    d = "".join(filter(str.isdigit, v))
    if not 8 <= len(d) <= 15:
        return None
    prefix = re.match(r"\+(\d{1,3})(?=[ .(-])", v)
    keep = len(prefix[1]) if prefix else 2 if v[0] == "+" else 1 if len(d) == 11 else 0
    n = len(d) - keep
    return _refill(v, d[:keep] + str(go(int(d[keep:]), 10 ** n)).zfill(n))


def _ip(v: str, go) -> str | None:
    octets = v.split(".")
    if any(int(o) > 255 or len(o) > 1 and o[0] == "0" for o in octets):
        return None
    # Within addresses of the same layout (digits per octet), so the length stays.
    spans = [(10 ** (len(o) - 1) if len(o) > 1 else 0, min(10 ** len(o), 256)) for o in octets]
    x, n = 0, 1
    for o, (low, high) in zip(octets, spans, strict=True):
        x, n = x * (high - low) + int(o) - low, n * (high - low)
    x, out = go(x, n), []
    for low, high in reversed(spans):
        x, d = divmod(x, high - low)
        out.append(str(low + d))
    return ".".join(reversed(out))


def _date(v: str, go) -> str | None:
    sep = next(c for c in v if not c.isdigit())
    a, b, c = v.split(sep)
    if sep == "-":
        order = [(a, b, c)]
    elif sep == ".":
        order = [(c, b, a)]
    else:       # month first, or day first where only that is a date
        order = [(c, a, b), (c, b, a)]
    for k, (y, m, d) in enumerate(order):
        try:
            day = datetime.date(int(y), int(m), int(d)).toordinal()
        except ValueError:
            continue
        if not _FIRST_DAY <= day <= _LAST_DAY:
            return None

        def text(x: int) -> str:
            t = datetime.date.fromordinal(x + _FIRST_DAY)
            y2, m2, d2 = f"{t.year:04d}", str(t.month), str(t.day)
            if sep == "-" or len(v) == 10:
                m2, d2 = m2.zfill(2), d2.zfill(2)
            return sep.join((y2, m2, d2) if sep == "-" else (d2, m2, y2) if sep == "." or k else (m2, d2, y2))

        # Walk on until the layout (its width, and which order it reads in)
        # is the same: still one to one within that layout.
        x = day - _FIRST_DAY
        while True:
            x = go(x, _LAST_DAY - _FIRST_DAY + 1)
            new = text(x)
            shape = [len(p) for p in new.split(sep)] == [len(p) for p in v.split(sep)]
            if shape and (sep != "/" or (int(new.split(sep)[0]) > 12) == bool(k)):
                return new
    return None


def _secret(v: str, go) -> str:
    if v.startswith("AKIA"):
        return "AKIA" + _by_class(v[4:], go)
    x = int(v, 16)
    while True:     # walk on until it has a digit and a letter again, and isn't found as an IBAN
        x = go(x, 16 ** len(v))
        new = f"{x:0{len(v)}x}"
        if v.isupper():
            new = new.upper()
        if not new.isdigit() and not new.isalpha() and not (_FORM["iban"].fullmatch(new) and _is_iban(new)):
            return new


_WORK = {"email": _email, "host": _email, "card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "ip": _ip, "date": _date,
         "secret": _secret}


class Pseudonyms:
    """Replace what is found in a text, or (``undo``) put it back."""

    def __init__(self, key: bytes, kinds: tuple[str, ...] = KINDS, undo: bool = False):
        f = Feistel(key)
        self.kinds = set(kinds)
        move = f.restore if undo else f.permute
        self.one = lru_cache(50_000)(lambda kind, v: _WORK[kind](v, lambda x, n: move(x, n, kind)))

    def _ends(self, kind: str, s: str, start: int, end: int) -> Iterator[int]:
        """Where a match that may have taken in what follows can end."""
        if kind == "iban":
            own = _iban_end(s[start:end])
            if own is not None and start + own < end:
                yield start + own
        yield end
        if kind == "phone":
            for e in range(end - 1, start, -1):
                if s[e - 1].isdigit() and not s[e].isdigit() and _FORM[kind].fullmatch(s, start, e):
                    yield e

    def _cuts(self, s: str, start: int, end: int) -> bool:
        """A valid number of a checked format starts inside and goes on behind."""
        for i in range(start + 1, end):
            if s[i].isdigit() and not s[i - 1].isalnum():
                for kind in ("card", "date", "ip", "ssn"):
                    m = _FORM[kind].match(s, i)
                    if m and m.end() > end and self.one(kind, m[0]) is not None:
                        return True
        return False

    def _value(self, kind: str, s: str, start: int) -> tuple[int, str] | None:
        """End and pseudonym of the valid value of a kind that starts here."""
        m = _FORM[kind].match(s, start)
        for end in self._ends(kind, s, start, m.end()) if m else ():
            new = self.one(kind, s[start:end])
            if new is not None and not (kind == "phone" and self._cuts(s, start, end)):
                return end, new
        return None

    def text(self, s: str) -> tuple[str, list[str]]:
        found: list[str] = []
        if not _MAYBE.search(s):
            return s, found
        out, done, at = [], 0, 0
        while m := _PATTERN.search(s, at):
            at = m.start()
            for kind in _ORDER[_ORDER.index(m.lastgroup):]:
                value = self._value(kind, s, at)
                if value:
                    break
            else:       # it only looks like one; others may start behind
                at += 1
                continue
            end, new = value
            if kind == "host":          # part of the address found before it
                if "email" in self.kinds:
                    out += s[done:at], new
                    done = end
            elif kind in self.kinds:
                found.append(kind)
                out += s[done:at], new
                done = end
            at = end
        return "".join((*out, s[done:])), found


_made: dict[tuple, Pseudonyms] = {}
keeps(_made.clear, __name__)


def pseudonymise(df: DataFrame, key: bytes, text: str = "text", keep: tuple[str, ...] | None = None,
                 kinds: tuple[str, ...] = KINDS, counts: str | None = "pii", undo: bool = False) -> DataFrame:
    """``df`` (or its ``keep`` columns and ``text``) with the personal data
    in ``text`` replaced, and ``counts map<string,int>`` (found, by kind)
    unless that is None.  ``undo`` restores the originals.

    Whole texts; null text stays null with an empty map, empty text empty.
    Of a mail address both the local part and the host's name are replaced,
    each on its own, so addresses of one host stay linked; the top-level
    domain stays.  There is no default key.
    Layout and length stay, so offsets into the text stay right.  Numbers
    that fail their format's check are left alone, and a value beside other
    digits or capitals is looked for at every end (an IBAN at its country's
    length) and from every character on.  Where such a neighbour overlaps a
    value, the pseudonym can by chance make the neighbour's own check come
    right (Luhn: one in ten), and ``undo`` then misreads the two.  Hex secrets
    are all small or all capital letters, and keep them.  One row
    in, one out, in the same columns order, no shuffle."""
    prepare(df.sparkSession)
    names = [c for c in df.columns if keep is None or c in keep or c == text]
    if counts in names:
        raise ValueError(f"column exists already: {counts}")
    own = only(df, **{c: c for c in names})
    at = names.index(text)
    setting = (key, tuple(kinds), undo)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields),
                        *([f"`{counts}` map<string,int>"] if counts else [])])

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if setting not in _made:
            _made[setting] = Pseudonyms(*setting)
        change = _made[setting].text
        for batch in slices(batches):
            texts, maps = [], []
            for s in batch.column(at).to_pylist():
                new, found = (None, []) if s is None else change(s)
                texts.append(new)
                maps.append([(k, found.count(k)) for k in sorted(set(found))])
            cols = list(batch.columns)
            cols[at] = pa.array(texts, pa.string())
            if counts:
                cols.append(pa.array(maps, pa.map_(pa.string(), pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, [*names, *([counts] if counts else [])])

    return own.mapInArrow(run, schema)
