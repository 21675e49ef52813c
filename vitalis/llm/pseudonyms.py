"""Format-preserving pseudonyms for personal data.

A found value is checked (Luhn digit, calendar date, octets, block rules) and its variable
positions are permuted by a keyed Feistel network over exactly their format: digits stay digits,
letters keep their case, a card keeps a right check digit, a date stays a date. Equal values get
equal pseudonyms everywhere, whatever their separators, and the key's owner can undo them.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm.common import lean

ROUNDS = 8


def _round(key: bytes, tweak: str, n: int, value: int, modulus: int) -> int:
    digest = hmac.new(key, f"{tweak}|{n}|{value}".encode(), hashlib.sha256).digest()
    return int.from_bytes(digest, "big") % modulus


def feistel(value: int, size: int, key: bytes, tweak: str, undo: bool = False) -> int:
    """A keyed permutation of 0 .. size - 1: an alternating Feistel network, walked inside a box.

    The box is the smallest a x b that holds the domain; a value that lands outside goes through
    again until it is inside, which keeps the map one to one.
    """
    if size < 2:
        return value
    a = int(size**0.5)
    while a * a < size:
        a += 1
    b = -(-size // a)
    while True:
        left, right = divmod(value, b)
        for n in range(ROUNDS - 1, -1, -1) if undo else range(ROUNDS):
            sign = -1 if undo else 1
            if n % 2:
                right = (right + sign * _round(key, tweak, n, left, b)) % b
            else:
                left = (left + sign * _round(key, tweak, n, right, a)) % a
        value = left * b + right
        if value < size:
            return value


def _radix(c: str) -> tuple[str, int] | None:
    for first, size in (("0", 10), ("a", 26), ("A", 26)):
        if ord(first) <= ord(c) < ord(first) + size:
            return first, size
    return None


def characters(text: str, key: bytes, tweak: str, undo: bool = False) -> str:
    """ASCII letters and digits permuted together, each within its class; the rest stays."""
    kinds = [_radix(c) for c in text]
    value, size = 0, 1
    for c, kind in zip(text, kinds):
        if kind:
            value, size = value * kind[1] + ord(c) - ord(kind[0]), size * kind[1]
    shape = "".join(kind[0] if kind else c for c, kind in zip(text, kinds))
    value = feistel(value, size, key, f"{tweak}|{shape}", undo)
    out = list(text)
    for i in range(len(text) - 1, -1, -1):
        if kinds[i]:
            value, digit = divmod(value, kinds[i][1])
            out[i] = chr(ord(kinds[i][0]) + digit)
    return "".join(out)


def _digits_into(text: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in text)


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


_FIVE_GROUPS = re.compile(r"\d{4}(?:[ -]\d{4}){3}[ -]\d{3}", re.ASCII)


def card(text: str, key: bytes, undo: bool = False) -> str | None:
    """13 to 19 digits with a right Luhn digit: the others are permuted, the digit is set anew.

    Five groups that are no card of 19 digits may be one of 16 before another number: then those
    are permuted among cards that don't make one of 19 with that number.
    """

    def valid(digits: str) -> bool:
        return luhn_digit(digits[:-1]) == digits[-1]

    digits, tail = re.sub(r"\D", "", text), ""
    if not valid(digits):
        if not _FIVE_GROUPS.fullmatch(text) or not valid(digits[:16]):
            return None
        digits, tail = digits[:16], digits[16:]
    while True:
        payload = characters(digits[:-1], key, "card", undo)
        digits = payload + luhn_digit(payload)
        if not tail or not valid(digits + tail):
            return _digits_into(text, digits + tail)


#: Calling codes of one and two digits as assigned by E.164; all others have three.
_CODES = {"1", "7"} | set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)


def phone(text: str, key: bytes, undo: bool = False) -> str:
    """All digits after the country code, which its own digits tell; a trunk zero in brackets stays.

    Separators don't matter, nor whether a number is written with its country code.
    """
    digits = [k for k, c in enumerate(text) if c.isdigit()]
    if text[0] == "+":
        first = "".join(text[k] for k in digits[:3])
        digits = digits[next((n for n in (1, 2) if first[:n] in _CODES), 3) :]
        digits = [k for k in digits if text[k - 1 : k + 2] != "(0)"]
    out = list(text)
    for k, c in zip(digits, characters("".join(text[k] for k in digits), key, "phone", undo)):
        out[k] = c
    return "".join(out)


def address(text: str, key: bytes, undo: bool = False) -> str:
    """Four octets as one number of 32 bits."""
    value = 0
    for part in text.split("."):
        value = value * 256 + int(part)
    value = feistel(value, 1 << 32, key, "ipv4", undo)
    return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


def social(text: str, key: bytes, undo: bool = False) -> str | None:
    """Three, two and four digits; blocks of zeros, 666 and 9xx are not issued."""

    def issued(d: str) -> bool:
        return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

    digits = text.replace("-", "")
    if not issued(digits):
        return None
    while True:
        digits = characters(digits, key, "social", undo)
        if issued(digits):
            return _digits_into(text, digits)


_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal() - datetime.date(1900, 1, 1).toordinal()


def date(text: str, key: bytes, undo: bool = False) -> str | None:
    """A day of 1900 to 2099 in the same notation (year first, or day or month first).

    With the year last, slashes mean month first and other separators day first. What is no date
    that way is read the other way, and permuted among the dates that can only be read so.
    """
    parts = re.split(r"([-/.])", text)
    numbers = [int(p) for p in parts[::2]]
    orders = [(0, 1, 2)] if len(parts[0]) == 4 else [(2, 1, 0), (2, 0, 1)]
    if parts[1] == "/":
        orders.reverse()
    for order in orders:
        try:
            day = datetime.date(*(numbers[i] for i in order)).toordinal() - _FIRST_DAY
            break
        except ValueError:
            continue
    else:
        return None
    if not 0 <= day < _DAYS:
        return None
    while True:
        day = feistel(day, _DAYS, key, "date", undo)
        new = datetime.date.fromordinal(day + _FIRST_DAY)
        if order == orders[0] or new.day > 12:
            break
    values = dict(zip(order, (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}")))
    return parts[1].join(values[i] for i in range(3))


def _any_case(text: str, key: bytes, tweak: str, undo: bool) -> str:
    """Permuted as if in lower case, then in the text's own case: spellings of one value stay linked."""
    new = characters(text.lower(), key, tweak, undo)
    return "".join(n.upper() if "A" <= c <= "Z" else n for n, c in zip(new, text))


def mail(text: str, key: bytes, undo: bool = False) -> str:
    """The part before the at sign and the domain's first label; case doesn't matter and stays."""
    local, _, domain = text.partition("@")
    label, dot, rest = domain.partition(".")
    return f"{_any_case(local, key, 'mail', undo)}@{_any_case(label, key, 'domain', undo)}{dot}{rest}"


def secret(text: str, key: bytes, undo: bool = False) -> str:
    """A hexadecimal string: one number of as many digits, its case kept."""
    new = feistel(int(text, 16), 16 ** len(text), key, f"hex{len(text)}", undo)
    new = f"{new:0{len(text)}x}"
    return new.upper() if text.upper() == text else new


#: Kinds of values, tried in this order at every place; None leaves the text as it is.
KINDS: dict[str, tuple[str, Callable[[str, bytes, bool], str | None]]] = {
    "mail": (r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", mail),
    "secret": (r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])", secret),
    "phone": (r"\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d(])\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
              r"|(?<![\d.-])\d{3}(?:-\d{3}-|\.\d{3}\.| \d{3}-)\d{4}(?![\d-]|\.\d)", phone),
    "address": (r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)", address),
    "card": (r"(?<![\d.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{3})?|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{6}[ -]\d{13})(?![\d])", card),
    "social": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", social),
    "date": (r"(?<![\d./-])(?:\d{4}[-/.]\d{2}[-/.]\d{2}|\d{2}[-/.]\d{2}[-/.]\d{4})(?![\d/-]|\.\d)", date),
}
_ANY = re.compile("|".join(f"(?P<{name}>{pattern})" for name, (pattern, _) in KINDS.items()), re.ASCII)
#: What a text must hold for any kind to occur; most texts end here.
_HINT = re.compile(r"@|[0-9a-fA-F]{13}|\d[\d .()/-]{6}")


def replace(text: str, key: bytes, undo: bool = False) -> tuple[str, int]:
    """The text with every validated value permuted, and how many there were."""
    if not _HINT.search(text):
        return text, 0
    found = 0

    def one(match: re.Match) -> str:
        nonlocal found
        new = KINDS[match.lastgroup][1](match.group(), key, undo)
        found += new is not None
        return match.group() if new is None else new

    return _ANY.sub(one, text), found


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", found_col: str | None = None, undo: bool = False) -> DataFrame:
    """All rows and columns as they are, but for ``text_col``, where personal data is permuted.

    ``found_col`` adds the number of replaced values. Null texts stay null (0 found), empty ones
    empty; texts without such values come back unchanged; repeated rows stay; an empty table gives
    an empty one.
    """
    schema = T.StructType([*docs.schema.fields, *([T.StructField(found_col, T.LongType())] if found_col else [])])
    at = docs.columns.index(text_col)

    @lean
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [replace(x, key, undo) if x else (x, 0) for x in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([x for x, _ in done], batch.column(at).type)
            names = list(batch.schema.names)
            if found_col:
                columns.append(pa.array([n for _, n in done], pa.int64()))
                names.append(found_col)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(rewrite, schema)


def digests(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the number of replaced values and the rewritten text."""
    slim = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return pseudonymise(slim, key, text_col, found_col="n_found")
