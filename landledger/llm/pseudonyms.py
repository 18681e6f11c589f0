"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value is found by its form and accepted only if it is valid: check digits of
cards and account numbers, ranges of phone numbers, network addresses and social
security numbers, the calendar for dates.  The accepted value is numbered within
all valid values of its form, the number is moved by a keyed Feistel permutation
(cycle-walking where the count of values is no power of two), and the value with
the new number is written in the old one's layout: same length, same separators,
valid check digits.  Being a permutation it maps equal values to equal pseudonyms
in every document, different ones to different ones, and can be undone with the
key.  The layout is no part of the value, so a date or a phone number written in
two ways keeps one pseudonym.

Where numbers or words that follow a value fit its form too, the longest valid value
that ends at a separator counts.

Texts are independent rows: nothing is shuffled, nothing is remembered.
"""

from __future__ import annotations

import datetime as dt
import functools
import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.common import utf8, with_result

ROUNDS = 10


def _round(key: bytes, tweak: bytes, number: int, value: int, half: int) -> int:
    size = (half + 7) // 8
    digest = blake2b(bytes([number]) + value.to_bytes(size, "big"), key=key, person=tweak,
                     digest_size=size).digest()
    return int.from_bytes(digest, "big") & ((1 << half) - 1)


def permute(value: int, size: int, key: bytes, tweak: bytes, undo: bool = False) -> int:
    """The place of ``value`` in a keyed permutation of range(size)."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        if undo:
            for number in reversed(range(ROUNDS)):
                left, right = right ^ _round(key, tweak, number, left, half), left
        else:
            for number in range(ROUNDS):
                left, right = right, left ^ _round(key, tweak, number, right, half)
        value = left << half | right
        if value < size:
            return value


def _mixed(digits, radices) -> int:
    value = 0
    for digit, radix in zip(digits, radices):
        value = value * radix + digit
    return value


def _unmixed(value: int, radices) -> list[int]:
    digits = []
    for radix in reversed(radices):
        value, digit = divmod(value, radix)
        digits.append(digit)
    return digits[::-1]


def _move(digits, radices, move) -> list[int]:
    size = functools.reduce(lambda a, b: a * b, radices, 1)
    return _unmixed(move(_mixed(digits, radices), size), radices)


def _relaid(old: str, digits: str) -> str:
    """``old`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in old)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _luhn(digits: str) -> int:
    """The digit that completes ``digits`` to a valid card number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 if i % 2 else 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def card(text: str, move) -> str | None:
    """13 to 19 digits with a valid check digit; the first digit names the network
    and stays."""
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or digits[0] == "0" or str(_luhn(digits[:-1])) != digits[-1]:
        return None
    body = _move(map(int, digits[1:-1]), [10] * (len(digits) - 2), move)
    new = digits[0] + "".join(map(str, body))
    return _relaid(text, new + str(_luhn(new)))


# Calling codes of one and two digits; all others have three.
_SHORT_CODES = frozenset("""
    1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63
    64 65 66 81 82 84 86 90 91 92 93 94 95 98
""".split())


def _american(body: str) -> list[int] | None:
    """Area, exchange and line counted from the first valid ones, if valid."""
    parts = [int(body[:3]) - 200, int(body[3:6]) - 200, int(body[6:])]
    return parts if min(parts) >= 0 else None


def phone(text: str, move) -> str | None:
    """With a plus sign or two zeros: the calling code stays and 7 to 12 digits follow,
    ten after code 1; both spellings get one pseudonym.  Ten digits without one: area and
    exchange from 200, and the same pseudonym as after code 1."""
    digits, front = _digits(text), ""
    if digits.startswith("00"):
        digits, front = digits[2:], "00"
    code = next((digits[:n] for n in (1, 2) if digits[:n] in _SHORT_CODES), digits[:3])
    if not text.startswith(("+", "00")):
        code = ""
    body = digits[len(code):]
    if code in ("", "1"):
        parts = _american(body) if len(body) == 10 else None
        if parts:
            area, exchange, line = _move(parts, [800, 800, 10_000], move)
            return _relaid(text, f"{front}{code}{area + 200}{exchange + 200}{line:04d}")
        if not code or len(body) != 10:
            return None
    if not 7 <= len(body) <= 12:
        return None
    moved = body
    while moved is body or (code == "1" and _american(moved)):  # within those of code 1
        moved = str(move(int(moved), 10 ** len(body))).zfill(len(body))
    return _relaid(text, front + code + moved)


def national(text: str, move) -> str | None:
    """A number as it is written inside France, Germany or Spain: the first two digits
    (trunk zero and area, or kind of line) stay, the others move."""
    digits = _digits(text)
    body = digits[2:]
    return _relaid(text, digits[:2] + str(move(int(body), 10 ** len(body))).zfill(len(body)))


def address(text: str, move) -> str | None:
    """A network address of four numbers up to 255 without leading zeros; each
    number keeps its count of digits."""
    parts = text.split(".")
    if any(len(p) > 1 and p[0] == "0" or int(p) > 255 for p in parts):
        return None
    first = [(0, 10, 100)[len(p) - 1] for p in parts]
    moved = _move([int(p) - f for p, f in zip(parts, first)],
                  [(10, 90, 156)[len(p) - 1] for p in parts], move)
    return ".".join(str(f + m) for f, m in zip(first, moved))


def social(text: str, move) -> str | None:
    """A social security number: area 001-899 but 666, group 01-99, serial 0001-9999."""
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    a, g, s = _move([area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999], move)
    return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"


# Countries that issue international account numbers.
_ACCOUNT_COUNTRIES = frozenset("""
    AD AE AL AT AZ BA BE BG BH BR BY CH CR CY CZ DE DK DO EE EG ES FI FO FR GB GE GI GL GR GT HR HU
    IE IL IQ IS IT JO KW KZ LB LC LI LT LU LV LY MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA
    SC SE SI SK SM ST SV TL TN TR UA VA VG XK
""".split())


def account(text: str, move) -> str | None:
    """An international account number with valid check digits, in groups or not, in any
    case; the country, the case of every letter and the separators stay."""
    plain = text.replace(" ", "").replace("-", "").upper()
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if (not 15 <= len(plain) <= 34 or plain[:2] not in _ACCOUNT_COUNTRIES
            or number(plain[4:] + plain[:4]) % 97 != 1):
        return None
    radices = [10 if c.isdigit() else 26 for c in plain[4:]]
    old = [int(c) if c.isdigit() else ord(c) - 65 for c in plain[4:]]
    body = "".join(str(d) if r == 10 else chr(65 + d)
                   for d, r in zip(_move(old, radices, move), radices))
    new = iter(f"{plain[:2]}{98 - number(body + plain[:2] + '00') % 97:02d}{body}")
    return "".join(c if c in " -" else next(new).lower() if c.islower() else next(new) for c in text)


_FIRST, _LAST = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def date(text: str, move) -> str | None:
    """A day of 1900-2099 as year-month-day, or with the year last: day first, unless
    only month first is a date.  Days and months below ten stay below ten, so that a day
    written without zeros keeps its length and its pseudonym.  (The pseudonym of a
    month-first date may read as a day-first one, so undoing is not certain for these.)"""
    mark = next(c for c in text if not c.isdigit())
    parts = text.split(mark)
    for order in ("ymd",) if len(parts[0]) == 4 else ("dmy", "mdy"):
        old = {k: int(p) for k, p in zip(order, parts)}
        try:
            day = dt.date(old["y"], old["m"], old["d"])
        except ValueError:
            continue
        if _FIRST <= day.toordinal() <= _LAST:
            new = None
            while new is None or (new.day < 10, new.month < 10) != (day.day < 10, day.month < 10):
                at = (new or day).toordinal() - _FIRST
                new = dt.date.fromordinal(_FIRST + move(at, _LAST - _FIRST + 1))
            new = {"y": new.year, "m": new.month, "d": new.day}
            return mark.join(str(new[k]).zfill(len(p)) for k, p in zip(order, parts))
    return None


def email(text: str, move) -> str | None:
    """Letters a-z and digits of the local part move, letters to letters and digits to
    digits; case, other letters, separators and domain stay."""
    local, domain = text.rsplit("@", 1)
    at = [i for i, c in enumerate(local) if c.isascii() and c.isalnum()]
    if not at:
        return None
    radices = [10 if local[i].isdigit() else 26 for i in at]
    old = [int(local[i]) if local[i].isdigit() else ord(local[i].lower()) - 97 for i in at]
    new = list(local)
    for i, radix, digit in zip(at, radices, _move(old, radices, move)):
        c = str(digit) if radix == 10 else chr(97 + digit)
        new[i] = c.upper() if local[i].isupper() else c
    return f"{''.join(new)}@{domain}"


#: Kinds in the order in which a place is tried: name, form, value.
KINDS = (
    ("email", r"(?<![\w.+%-])\w[\w.%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", email),
    ("account", r"(?<![A-Za-z0-9])[A-Za-z]{2}\d{2}(?:[ -]?[A-Za-z0-9]{4}){2,7}"
                r"(?:[ -]?[A-Za-z0-9]{1,3})?(?![A-Za-z0-9])", account),
    ("address", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", address),
    ("date", r"(?<![\d./-])(?:\d{4}(?P<a>[-/.])\d\d?(?P=a)\d\d?|\d\d?(?P<b>[-/.])\d\d?(?P=b)\d{4})"
             r"(?![-/]?\d)", date),
    ("social", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", social),
    ("phone", r"(?<![\w+])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-])|"
              r"(?<![\w+])(?:\+|(?<!\d[ .-])00[ .-]?(?=[1-9]))\d(?:\)?[ .-]?\(?\d){7,14}(?!\d)",
     phone),
    ("card", r"(?<![\w.-])\d(?:[ .-]?\d){12,18}(?!\w)", card),
    # five pairs; area and subscriber; three threes or three and three pairs
    ("national", r"(?<![\w.+-])(?<!\d[ .-])(?:0[1-9](?P<c>[ .-])\d\d(?:(?P=c)\d\d){3}|0[2-9]\d{1,3}[ /-]\d{5,8}|"
                 r"[6-9]\d\d(?P<d>[ .-])(?:\d{3}(?P=d)\d{3}|\d\d(?P=d)\d\d(?P=d)\d\d))"
                 r"(?![ .-]?\d)(?!\w)", national),
)


# Kinds whose form takes in what follows them, and where they may end.
_RUNS = frozenset(("account", "phone", "card"))
_BORDERS = frozenset(" .-")


def _longest(text: str, start: int, stop: int, form, value):
    """The longest valid value from ``start`` that ends at ``stop`` or at a border
    before: its end and pseudonym."""
    for end in range(stop, start, -1):
        if (end == stop or text[end] in _BORDERS) and form.fullmatch(text, start, end):
            new = value(text[start:end])
            if new is not None:
                return end, new
    return start, None


class Pseudonyms:
    """The forms of all kinds with one key."""

    def __init__(self, key: bytes, undo: bool = False):
        if not 16 <= len(key) <= 64:
            raise ValueError("the key must have 16 to 64 bytes")
        self.any = re.compile("|".join(f"(?P<{name}>{form})" for name, form, _ in KINDS))
        self.values = []
        for name, form, value in KINDS:
            move = functools.partial(permute, key=key, tweak=name.encode(), undo=undo)
            self.values.append((name, re.compile(form), functools.partial(value, move=move)))

    def _at(self, text: str, start: int):
        """The first kind with a valid value at a place: kind, end, pseudonym."""
        for name, form, value in self.values:
            found = form.match(text, start)
            new = value(found.group()) if found else None
            if new is not None:
                return name, found.end(), new
            if found and name in _RUNS:
                end, new = _longest(text, start, found.end(), form, value)
                if new is not None and not any(
                        (later := _longest(text, at, found.end(), form, value))[1] is not None
                        and later[0] - at > end - start
                        for at in range(start + 1, found.end() - (end - start))
                        if text[at - 1] in _BORDERS):
                    return name, end, new
        return None

    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with pseudonyms, and the spans they took the place of."""
        made, spans, done, at = [], [], 0, 0
        while found := self.any.search(text, at):
            start = found.start()
            value = self._at(text, start)
            if value is None:
                at = start + 1
                continue
            name, at, new = value
            made += (text[done:start], new)
            spans.append((start, at, name))
            done = at
        return "".join(made) + text[done:], spans


_WORTH_A_LOOK = re.compile(rb"[0-9@]").search


def _replace(texts, key, undo):
    pseudonyms = Pseudonyms(key, undo)
    new_texts, span_lists = [], []
    for raw in utf8(texts):
        spans = []
        if raw and _WORTH_A_LOOK(raw):
            text, spans = pseudonyms.replace(raw.decode("utf-8", "replace"))
            raw = text.encode() if spans else raw
        new_texts.append(raw)
        span_lists.append([{"start": a, "end": b, "kind": k} for a, b, k in spans])
    return [pa.array(new_texts, pa.binary()).view(pa.string()), span_lists]


def pseudonymised(docs: DataFrame, key: bytes, keep: list[str] | None = None,
                  out: str = "pseudonyms", undo: bool = False) -> DataFrame:
    """``keep`` columns (all by default) and the struct ``out``: the new text and the
    replaced spans (code points of the old text, end exclusive, and kind).

    One row per row of ``docs``.  A null text stays null, and a text without valid
    values stays as it is; both have no spans.  ``undo`` turns pseudonyms made with
    the same key back.  ``key`` is a secret of 16 to 64 bytes; whoever has it can
    undo the replacement.
    """
    return with_result(
        docs, ["text"], docs.columns if keep is None else keep, out,
        "text string, spans array<struct<start: int, end: int, kind: string>>",
        functools.partial(_replace, key=key, undo=undo))


def report(docs: DataFrame, key: bytes) -> DataFrame:
    """Every document's new text and its spans as kind:start:end."""
    spans = F.col("pseudonyms.spans")
    return pseudonymised(docs, key, ["doc_id"]).select(
        "doc_id", F.col("pseudonyms.text").alias("text"),
        F.size(spans).cast("bigint").alias("n_values"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
        .alias("spans"))
