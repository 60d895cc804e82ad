"""Pseudonyms for private numbers, dates and addresses that keep their format.

A value that passes its check (Luhn, calendar, octets, digits of a phone number) is written as a
number in the range its format allows, permuted within that range by a keyed Feistel network, and
written back in the same format. Equal values have equal pseudonyms in all documents, different
values different ones, and a card number still passes its check.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUNDS = 10
KINDS = ("email", "card", "phone", "ip", "ssn", "date")
FIRST_DAY, DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()
PATTERN = re.compile(
    r"""
    (?P<email> (?<![A-Za-z0-9._%+-]) [A-Za-z0-9._%+-]+ @ (?:[A-Za-z0-9-]+\.)+ [A-Za-z]{2,} )
  | (?P<date>  (?<![0-9./-]) (?: [0-9]{4}-[0-9]{2}-[0-9]{2} | [0-9]{2}[./][0-9]{2}[./][0-9]{4} ) (?![0-9]|[./-][0-9]) )
  | (?P<ip>    (?<![0-9.]) [0-9]{1,3} (?:\.[0-9]{1,3}){3} (?!\.?[0-9]) )
  | (?P<phone> (?<![0-9]) (?:\+[0-9]{1,3}[ .-]?)? (?: \([0-9]{3}\)[ ]? | [0-9]{3}[ .-] ) [0-9]{3} [ .-] [0-9]{4} (?![0-9])
             | (?<![A-Za-z0-9]) \+[1-9] (?: [ .-]?\(?[0-9]\)? ){6,14} (?![0-9]) )
  | (?P<ssn>   (?<![0-9-]) [0-9]{3}-[0-9]{2}-[0-9]{4} (?![0-9]|-[0-9]) )
  | (?P<card>  (?<![0-9]) (?: [0-9]{13,19} | [0-9]{4}(?:[ -][0-9]{4}){3} | [0-9]{4}[ -][0-9]{6}[ -][0-9]{5} ) (?![0-9]) )
    """,
    re.VERBOSE | re.ASCII,
)


# Country codes of one and two digits; all others have three.
CODES = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")


def permuted(value: int, size: int, key: bytes, kind: str) -> int:
    """A keyed permutation of 0 .. size - 1: a Feistel network over the next even number of bits, repeated until inside."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    salt = f"{kind}/{size}/".encode()
    while True:
        left, right = value >> half, value & mask
        for turn in range(ROUNDS):
            told = salt + bytes([turn]) + right.to_bytes((half + 7) // 8, "little")
            word = hashlib.blake2b(told, key=key, digest_size=(half + 7) // 8).digest()
            left, right = right, left ^ (int.from_bytes(word, "little") & mask)
        value = left << half | right
        if value < size:
            return value


def _ranges(text: str, first_digit: bool = False) -> list[tuple[int, int, int]]:
    """(place, code of the first character, number of characters) of each letter and digit."""
    found = []
    for i, c in enumerate(text):
        if "0" <= c <= "9":
            found.append((i, 49, 9) if first_digit and not found and c != "0" else (i, 48, 10))
        elif "a" <= c <= "z":
            found.append((i, 97, 26))
        elif "A" <= c <= "Z":
            found.append((i, 65, 26))
    return found


def _characters(text: str, key: bytes, kind: str, first_digit: bool = False) -> str:
    """Letters and digits permuted together, each within its class; other characters stay."""
    places = _ranges(text, first_digit)
    value, size = 0, 1
    for i, low, n in places:
        value, size = value * n + ord(text[i]) - low, size * n
    value = permuted(value, size, key, kind)
    out = list(text)
    for i, low, n in reversed(places):
        value, rest = divmod(value, n)
        out[i] = chr(low + rest)
    return "".join(out)


def check_digit(payload: str) -> str:
    """The Luhn digit that completes ``payload``."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _card(text: str, key: bytes) -> str | None:
    digits = re.sub("[ -]", "", text)
    if check_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
        return None
    payload = _characters(digits[:-1], key, "card", True)
    fresh = iter(payload + check_digit(payload))
    return "".join(next(fresh) if c.isdigit() else c for c in text)


def _phone(text: str, key: bytes) -> str:
    """The digits after the country code are permuted, the code and the layout stay."""
    digits = "".join(c for c in text if c.isdigit())
    code = 0
    if text[0] == "+":
        apart = re.match(r"[+]([0-9]{1,3})[ .(-]", text)
        known = CODES.match(digits)
        code = len(apart[1]) if apart else known.end() if known else 3
    fresh = iter(digits[:code] + _characters(digits[code:], key, "phone"))
    return "".join(next(fresh) if c.isdigit() else c for c in text)


def _ip(text: str, key: bytes) -> str | None:
    """Octets keep their number of digits."""
    octets = text.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    ranges = [{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(o)] for o in octets]
    value, size = 0, 1
    for o, (low, n) in zip(octets, ranges):
        value, size = value * n + int(o) - low, size * n
    value = permuted(value, size, key, "ip")
    out = []
    for low, n in reversed(ranges):
        value, rest = divmod(value, n)
        out.append(str(low + rest))
    return ".".join(reversed(out))


def _ssn(text: str, key: bytes) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    areas = 898  # 1 .. 899 without 666
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(permuted(value, areas * 99 * 9999, key, "ssn"), 9999)
    area, group = divmod(value, 99)
    return f"{area + 1 + (area + 1 > 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _date(text: str, key: bytes) -> str | None:
    """A day of 1900 to 2099. Day before month where dots or slashes part them, unless only the other order is a day.

    Dates that can only be read month first, those after the 12th, are permuted among themselves: what is written
    for them can only be read month first too, and is no other date's pseudonym.
    """
    layouts = ("%Y-%m-%d",) if text[4] == "-" else (f"%d{text[2]}%m{text[5]}%Y", f"%m{text[2]}%d{text[5]}%Y")
    for layout in layouts:
        try:
            day = dt.datetime.strptime(text, layout).date().toordinal() - FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < DAYS:
            continue
        while True:
            day = permuted(day, DAYS, key, "date")
            fresh = dt.date.fromordinal(FIRST_DAY + day)
            if layout == layouts[0] or fresh.day > 12:
                return fresh.strftime(layout)
    return None


def _email(text: str, key: bytes) -> str:
    """The name is permuted; the host stays."""
    name, at, host = text.rpartition("@")
    return _characters(name, key, "email") + at + host


CHANGE = {"email": _email, "card": _card, "phone": _phone, "ip": _ip, "ssn": _ssn, "date": _date}


def pseudonymised(text: str, key: bytes, counts: dict[str, int]) -> str:
    """The text with all private values replaced; ``counts`` gets how many there were of each kind."""

    def changed(match: re.Match) -> str:
        fresh = CHANGE[match.lastgroup](match[0], key)
        if fresh is None:
            return match[0]
        counts[match.lastgroup] += 1
        return fresh

    return PATTERN.sub(changed, text)


def pseudonyms(
    docs: DataFrame, key: bytes, keep: tuple[str, ...] | None = None, counts: bool = False, text: str = "text"
) -> DataFrame:
    """``docs`` with private values in ``text`` replaced; only the columns ``keep``, or all.

    With ``counts`` a column n_<kind> is added for each of KINDS; ``keep`` must not name these.
    Numbers that fail their check stay as they are. A text keeps its length. NULL and empty texts stay. Rows are
    changed one by one, so ties, repeated rows and other columns do not matter; an empty table
    stays empty.
    """
    if not key:
        raise ValueError("the key must not be empty")
    chosen = docs.select(*(keep or docs.columns))
    at = chosen.columns.index(text)
    fields = list(chosen.schema.fields)
    if counts:
        fields += [T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(at)
            found = {kind: [0] * batch.num_rows for kind in KINDS}
            new = {}
            for i in pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(old, "[0-9@]"), False)).to_pylist():
                told = dict.fromkeys(KINDS, 0)
                new[i] = pseudonymised(old[i].as_py(), key, told)
                for kind, n in told.items():
                    found[kind][i] = n
            columns = batch.columns
            if new:
                changed = pa.array([i in new for i in range(batch.num_rows)])
                columns[at] = pc.replace_with_mask(old, changed, pa.array([new[i] for i in sorted(new)], old.type))
            if counts:
                columns += [pa.array(found[kind], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return chosen.mapInArrow(run, T.StructType(fields))
