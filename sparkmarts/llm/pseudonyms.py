"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value is found by its form and validated (check digits, calendar, octets). Its content is a number below the
size N of its format's domain, and a keyed permutation of that domain gives the pseudonym, which is written in
the value's own form: spacing, letter case, check digits that fit. The permutation depends on key and domain
alone, so equal values have equal pseudonyms in every document, however they are spaced, and different ones have
different pseudonyms. It is x -> F'(F(x) + 1 mod N), F a Feistel network with cycle walking and F' its inverse: no
value stays as it was, and the key holder can undo it (`reveal`).

Documents are independent, so nothing is shuffled; a task holds one batch of texts.

Defined cases: null text stays null with no values; empty texts have none; where forms overlap, the one that
begins first counts, then the order below; numbers that fail validation are left alone, but a shorter form that ends at a space inside them, another kind at
the same place and values that begin further on inside them are tried (where a failed number overlaps a value, the pseudonym may make
it pass, and `reveal` then reads it otherwise); an IBAN has its country's length first; repeated rows get equal
results; an empty table gives no rows.
"""

from __future__ import annotations

import calendar
import datetime
import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried

ROUNDS = 10
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


# ---------------------------------------------------------------- the permutation


class Permutation:
    """A keyed permutation of 0 .. size - 1."""

    def __init__(self, key: bytes, domain: str, size: int):
        self.size = size
        self.half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
        self.key = hashlib.blake2b(f"{domain}/{size}".encode(), key=key, digest_size=32).digest()

    def _mixed(self, round: int, half: int) -> int:
        data = round.to_bytes(2, "big") + half.to_bytes((self.half + 7) // 8, "big")
        digest = hashlib.blake2b(data, key=self.key, digest_size=(self.half + 7) // 8).digest()
        return int.from_bytes(digest, "big") & ((1 << self.half) - 1)

    def _network(self, x: int, back: bool) -> int:
        left, right = x >> self.half, x & ((1 << self.half) - 1)
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ self._mixed(r, left), left
            else:
                left, right = right, left ^ self._mixed(r, right)
        return left << self.half | right

    def _walk(self, x: int, back: bool) -> int:
        while True:
            x = self._network(x, back)
            if x < self.size:
                return x

    def moved(self, x: int, step: int = 1) -> int:
        return self._walk((self._walk(x, False) + step) % self.size, True)


@lru_cache(4096)
def permutation(key: bytes, domain: str, size: int) -> Permutation:
    return Permutation(key, domain, size)


# ---------------------------------------------------------------- kinds

Move = Callable[[str, int, int], int]  # domain, its size, a number of it -> another number of it


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _in_form(form: str, digits: str) -> str:
    """The form with its digits replaced in order."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in form)


def luhn(digits: str) -> int:
    """The check sum modulo 10: 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10


def _card(form: str, move: Move) -> str | None:
    digits = _digits(form)
    if luhn(digits) or not int(digits):
        return None
    body = f"{move('card', 10 ** (len(digits) - 1), int(digits[:-1])):0{len(digits) - 1}d}"
    return _in_form(form, body + str(-luhn(body + "0") % 10))


def _rest_97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _iban(form: str, move: Move) -> str | None:
    plain = form.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _rest_97(plain[4:] + plain[:4]) != 1:
        return None
    radix = [10 if c.isdigit() else 26 for c in plain[4:]]
    body = _letters(plain[4:].lower(), radix, move, "iban " + plain[:2]).upper()
    check = f"{98 - _rest_97(body + plain[:2] + '00'):02d}"
    left = iter(plain[:2] + check + body)
    return "".join(c if c == " " else next(left) for c in form)


def _letters(text: str, radix: list[int], move: Move, domain: str) -> str:
    """Letters a-z and digits permuted together, each staying of its sort."""
    size, number = 1, 0
    for c, base in zip(text, radix, strict=True):
        size *= base
        number = number * base + (ord(c) - (48 if base == 10 else 97))
    shape = "".join("9" if base == 10 else "a" for base in radix)
    number = move(f"{domain} {shape}", size, number)
    out = []
    for base in reversed(radix):
        number, at = divmod(number, base)
        out.append(chr(at + (48 if base == 10 else 97)))
    return "".join(reversed(out))


def _email(form: str, move: Move) -> str | None:
    local, _, host = form.rpartition("@")
    at = [i for i, c in enumerate(local) if c.isascii() and c.isalnum()]
    if not at:
        return None
    plain = "".join(local[i].lower() for i in at)
    moved = _letters(plain, [10 if c.isdigit() else 26 for c in plain], move, f"email {host.lower()}")
    signs = list(local)
    for i, c in zip(at, moved, strict=True):
        signs[i] = c.upper() if local[i].isupper() else c
    return "".join(signs) + "@" + host


def _address(form: str, move: Move) -> str | None:
    octets = form.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    n = move("address", 2**32, int.from_bytes(bytes(map(int, octets)), "big"))
    return ".".join(map(str, n.to_bytes(4, "big")))


def _social(form: str, move: Move) -> str | None:
    area, group, serial = map(int, form.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    place = (area - 1 - (area > 666)) * 99 * 9999 + (group - 1) * 9999 + serial - 1
    area, rest = divmod(move("social", 898 * 99 * 9999, place), 99 * 9999)
    area += 1 + (area >= 665)
    return f"{area:03d}-{rest // 9999 + 1:02d}-{rest % 9999 + 1:04d}"


def _phone(form: str, move: Move) -> str | None:
    lead = re.match(r"\+(?:1(?=\D)|\d{1,3}(?=\D))?", form)
    head = lead[0] if lead else ""
    digits = _digits(form[len(head) :])
    if not 7 <= len(digits) + len(_digits(head)) <= 15:
        return None
    moved = move(f"phone {head}", 10 ** len(digits), int(digits))
    return head + _in_form(form[len(head) :], f"{moved:0{len(digits)}d}")


@lru_cache(1)
def _late_days() -> tuple[list[int], dict[int, int]]:
    """Days of a month after the 12th: dates that can only be read month first."""
    days = [
        datetime.date(y, m, d).toordinal()
        for y in range(1900, 2100)
        for m in range(1, 13)
        for d in range(13, calendar.monthrange(y, m)[1] + 1)
    ]
    return days, {d: i for i, d in enumerate(days)}


def _date(form: str, move: Move) -> str | None:
    """ISO dates, and day first with . or /; month first with / where the second number can only be a day."""
    parts = [int(p) for p in re.split(r"[-./]", form)]
    month_first = form[2] == "/" and parts[1] > 12
    order = (0, 1, 2) if form[4] == "-" else (2, 0, 1) if month_first else (2, 1, 0)
    try:
        day = datetime.date(*(parts[i] for i in order)).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    if month_first:
        days, places = _late_days()
        day = days[move("late day", len(days), places[day])]
    else:
        day = FIRST_DAY + move("day", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY)
    date = datetime.date.fromordinal(day)
    fields = (date.year, date.month, date.day)
    text = ["", "", ""]
    for i, field in zip(order, fields, strict=True):
        text[i] = f"{field:04d}" if field > 31 else f"{field:02d}"
    return form[4 if order == (0, 1, 2) else 2].join(text)


#: Signs of an IBAN by country, without spaces.
IBAN_LENGTHS = {
    pair[:2]: int(pair[2:])
    for pair in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 "
        "GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 "
        "MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 "
        "TN24 TR26 UA29 VA22 VG24 XK20"
    ).split()
}
_OCTET = r"\d{1,3}"
#: Kinds in the order in which they are tried at a place.
KINDS: dict[str, tuple[str, Callable[[str, Move], str | None]]] = {
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    "date": (r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}(?P<dot>[./])\d{2}(?P=dot)\d{4})(?![./-]?\d)", _date),
    "address": (rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)", _address),
    "social": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!-?\d)", _social),
    "phone": (
        r"(?<![\d+])(?:\+1[ .-]?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\+\d{1,3}(?:[ .-]\(?\d{2,4}\)?){2,5}|\+\d{7,15}"
        r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}(?P<dash>[.-])\d{3}(?P=dash)\d{4})(?!\d)",
        _phone,
    ),
    "card": (r"(?<!\d)(?:\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}(?P<blank>[ -])\d{6}(?P=blank)\d{5}|\d{13,19})(?!\d)", _card),
}
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_SOME = re.compile(r"\d[\d(). /-]{5}|[A-Z]{2}\d{2} ?[A-Z0-9]{4}")
_VALUES = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, (pattern, _) in KINDS.items()))


_KINDS = {kind: re.compile(pattern) for kind, (pattern, _) in KINDS.items()}


def _shorter(pattern: re.Pattern, text: str, start: int, end: int) -> re.Match | None:
    """The longest match at a place that ends before `end`, at the end of a word; what follows it still counts as context."""
    for last in range(end - 1, start + 6, -1):
        if text[last] == " ":
            # A space ends the form: what is behind it is another word.
            match = pattern.match(text, start, last)
            if match and match.end() == last:
                return match
    return None


def _of_country(pattern: re.Pattern, text: str, start: int) -> re.Match | None:
    """The match at a place with the length that its country's IBANs have."""
    left, end = IBAN_LENGTHS.get(text[start : start + 2], 0), start
    while left and end < len(text):
        left -= text[end] != " "
        end += 1
    match = pattern.match(text, start, end) if end > start and not left and not text[end : end + 1].isalnum() else None
    return match if match and match.end() == end else None


def _replaced(text: str, key: bytes, step: int) -> tuple[str, list[str]]:
    def move(domain: str, size: int, x: int) -> int:
        return permutation(key, domain, size).moved(x, step)

    found: list[str] = []

    def valid_at(part: str, start: int) -> tuple[str, str, int] | None:
        """Kind, pseudonym and end of the first valid value at a place: each kind in order, its longest form first."""
        for kind, pattern in _KINDS.items():
            match = pattern.match(part, start)
            own = match and kind == "iban" and _of_country(pattern, part, start)
            if own and (new := _iban(own[0], move)) is not None:
                return kind, new, own.end()
            while match:
                new = KINDS[kind][1](match[0], move)
                if new is not None:
                    return kind, new, match.end()
                match = _shorter(pattern, part, start, match.end())
        return None

    def without_values(part: str) -> str:
        if not _SOME.search(part):
            return part
        out, last, match = [], 0, _VALUES.search(part)
        while match:
            start = match.start()
            value = valid_at(part, start)
            if value:
                kind, new, end = value
                found.append(kind)
                out += [part[last:start], new]
                last = end
            # What fails is no value: the next may begin inside it.
            match = _VALUES.search(part, value[2] if value else start + 1)
        return "".join([*out, part[last:]])

    pieces, last = [], 0
    for mail in _EMAIL.finditer(text) if "@" in text else ():
        new = _email(mail[0], move)
        if new is None:
            continue  # its text is searched for the other kinds
        pieces.append(without_values(text[last : mail.start()]))
        found.append("email")
        pieces.append(new)
        last = mail.end()
    pieces.append(without_values(text[last:]))
    return "".join(pieces), found


NAMES = ("email", *KINDS)


def _run(key: bytes, step: int, columns: list[str]):
    def run(batches):
        for batch in batches:
            texts, counts = [], []
            for text in batch.column("text").to_pylist():
                new, found = _replaced(text, key, step) if text else (text, [])
                texts.append(new)
                counts.append([found.count(kind) for kind in NAMES])
            by_kind = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(NAMES))]
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(texts, pa.string()), *by_kind], names=[*columns, "text", *(f"n_{kind}" for kind in NAMES)]
            )

    return run


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", carry: list[str] | None = None, step: int = 1) -> DataFrame:
    """Per input row: `row` (its columns, or those in `carry`), text with pseudonyms, and n_<kind> values replaced."""
    read = docs.select(carried(docs, carry).alias("row"), F.col(text).alias("text"))
    row = read.schema["row"].dataType.simpleString()
    counts = ", ".join(f"n_{kind} long" for kind in NAMES)
    return read.mapInArrow(_run(key, step, ["row"]), f"row {row}, text string, {counts}")


def reveal(docs: DataFrame, key: bytes, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The originals of pseudonymised texts."""
    return pseudonymise(docs, key, text, carry, step=-1)
