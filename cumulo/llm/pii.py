"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation.

A found value that passes its check (a card's Luhn digit, an account number's remainder, a real date, ...)
is read as a number in the system of its format: every digit or letter may become any other of its
kind. A Feistel network keyed by a secret permutes that range, and is applied again until the value
is valid by the same check. So a pseudonym has the length, signs and validity of the original, equal
values get equal pseudonyms in all documents, whatever separators they are written with, and
different values stay different.

Null stays null; empty texts and texts without personal data stay as they are, byte by byte. Repeated
rows are treated alike.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

# A line without any of these holds nothing to replace.
_HINT = re.compile(r"[0-9@=:]")
_FORMS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+\-]*@[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "access": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}",
    "secret": r"(?i:password|passwd|secret|token|api[_\-]?key)[ ]?[=:][ ]?[\"']?(?P<hidden>[A-Za-z0-9+/_\-]{8,})",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "day": r"(?<![\d.\-/])(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}([./\-])\d{1,2}\1\d{4})(?![\d\-/])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"\+1[ .\-]?(?:\(\d{3}\)|\d{3})[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)|\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\d)"
    r"|(?<![\d.\-])(?:\(\d{3}\)[ ]?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?![\d\-])",
    "card": r"(?<!\d)\d(?:[ \-]?\d){12,18}(?!\d)",
    "address": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)",
}
_ANY = re.compile("|".join(f"(?P<{kind}>{form})" for kind, form in _FORMS.items()).replace(r"\1", r"(?P=sep)").replace(r"([./\-])", r"(?P<sep>[./\-])"))


def permute(value: int, size: int, key: bytes, label: str) -> int:
    """A keyed permutation of the numbers below ``size``: a Feistel network over the next even number
    of bits, repeated until the result is in range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    width = (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for turn in range(ROUNDS):
            salt = f"{label}:{size}:{turn}:".encode()
            digest = hashlib.blake2b(salt + right.to_bytes(width, "big"), key=key[:64], digest_size=min(64, width + 8)).digest()
            left, right = right, left ^ (int.from_bytes(digest, "big") & mask)
        value = left << half | right
        if value < size:
            return value


def _radix(char: str) -> str:
    return _DIGITS if char in _DIGITS else _LOWER if char.lower() in _LOWER else ""


def disguise(value: str, key: bytes, label: str, valid: Callable[[str], bool] = lambda _: True, alphabet: str = "") -> str:
    """The value with its digits and letters permuted within their kinds; signs and case stay. With an
    ``alphabet`` all characters in it are of one kind."""
    kinds = [alphabet if c.lower() in alphabet else _radix(c) if c.isascii() else "" for c in value]
    number, size = 0, 1
    for char, kind in zip(value, kinds):
        if kind:
            number, size = number * len(kind) + kind.index(char.lower()), size * len(kind)
    if size < 2:
        return value
    upper = [c.isupper() for c in value]
    while True:
        number = permute(number, size, key, label)
        rest, out = number, []
        for char, kind, high in zip(reversed(value), reversed(kinds), reversed(upper)):
            if kind:
                rest, at = divmod(rest, len(kind))
                char = kind[at].upper() if high else kind[at]
            out.append(char)
        found = "".join(reversed(out))
        if valid(found):
            return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def remainder_97(account: str) -> bool:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and digits[0] in "23456" and len(set(digits)) > 1 and luhn(digits)


def iban(account: str) -> bool:
    return 15 <= len(account) <= 34 and remainder_97(account)


def social(digits: str) -> bool:
    area, group, serial = digits[:3], digits[3:5], digits[5:]
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def nanp(digits: str) -> bool:
    return len(digits) == 10 and digits[0] > "1" and digits[3] > "1"


def _onto(value: str, chars: str) -> str:
    """The characters put in place of the digits and letters of ``value``, in order."""
    at = iter(chars)
    return "".join(next(at) if c.isalnum() else c for c in value)


def _bare(value: str) -> str:
    return "".join(c for c in value if c.isalnum())


def _email(value: str, key: bytes) -> str:
    local, _, domain = value.rpartition("@")
    host, _, top = domain.rpartition(".")
    return f"{disguise(local, key, 'local')}@{disguise(host, key, 'host')}.{top}"


def _card(value: str, key: bytes) -> str:
    digits = _bare(value)
    if not card(digits):
        return value
    # The last digit follows from the rest, so only that is permuted.
    body = digits[0] + disguise(digits[1:-1], key, f"card{digits[0]}")
    return _onto(value, body + next(d for d in _DIGITS if luhn(body + d)))


def _phone(value: str, key: bytes) -> str:
    country = re.match(r"\+(1(?=[ .\-(])|\d{1,3}(?=[ .\-(])|1|7|\d{2})", value)
    head = country.group() if country else ""
    digits = _bare(value[len(head) :])
    if not 7 <= len(digits) + len(_bare(head)) <= 15 or len(digits) < 6:
        return value
    north = head in ("", "+1") and nanp(digits)
    return head + _onto(value[len(head) :], disguise(digits, key, f"phone{'+1' if north else head}", lambda d: nanp(d) or not north))


def _iban(value: str, key: bytes) -> str:
    account = _bare(value)
    if not iban(account):
        return value
    # The check digits follow from the rest, so only that is permuted.
    body = disguise(account[4:], key, f"iban{account[:2]}")
    check = 98 - int("".join(str(int(c, 36)) for c in body + account[:2] + "00")) % 97
    return _onto(value, f"{account[:2]}{check:02d}{body}")


# First number and how many there are, by the digits an address part is written with.
_PARTS = {1: (0, 10), 2: (10, 90), 3: (100, 156)}


def _address(value: str, key: bytes) -> str:
    parts = value.split(".")
    if any(int(p) > 255 or len(p) > 1 and p[0] == "0" for p in parts):
        return value
    ranges = [_PARTS[len(p)] for p in parts]
    number, size = 0, 1
    for part, (low, n) in zip(parts, ranges):
        number, size = number * n + int(part) - low, size * n
    while True:
        number = permute(number, size, key, f"address{[len(p) for p in parts]}")
        rest, out = number, []
        for low, n in reversed(ranges):
            rest, at = divmod(rest, n)
            out.append(str(low + at))
        out.reverse()
        if _special(out) == _special(parts):
            return ".".join(out)


def _special(parts: list[str]) -> bool:
    first, second = int(parts[0]), int(parts[1])
    private = first in (0, 10, 127) or (first, second) in ((192, 168), (169, 254)) or first == 172 and 16 <= second < 32
    return private or first > 223


def _day(value: str, key: bytes) -> str:
    parts = re.split(r"[./\-]", value)
    sep = re.search(r"[./\-]", value).group()
    widths = [len(p) for p in parts]
    order = (0, 1, 2) if widths[0] == 4 else (2, 1, 0)
    day = _real(parts, order)
    if day is None and order == (2, 1, 0):
        order = (2, 0, 1)
        day = _real(parts, order)
    if day is None:
        return value
    number = day.toordinal() - _FIRST_DAY
    while True:
        number = permute(number, _LAST_DAY - _FIRST_DAY + 1, key, "day")
        new = dt.date.fromordinal(_FIRST_DAY + number)
        out = [""] * 3
        for place, n in zip(order, (new.year, new.month, new.day)):
            out[place] = str(n).zfill(widths[place])
        # Written without leading zeros a date keeps its length; day and month stay as they were told apart.
        plain = all(p[0] > "0" for p in parts)
        if [len(x) for x in out] == widths and (order != (2, 0, 1) or new.day > 12) and (not plain or all(x[0] > "0" for x in out) or 2 in widths[:2] and _real(out, order)):
            return sep.join(out)


def _real(parts: list[str], order: tuple[int, int, int]) -> dt.date | None:
    try:
        day = dt.date(*(int(parts[i]) for i in order))
    except ValueError:
        return None
    return day if _FIRST_DAY <= day.toordinal() <= _LAST_DAY else None


def _secret(value: str, key: bytes) -> str:
    alphabet = _DIGITS + "abcdef" if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) else ""
    return disguise(value, key, "secret", alphabet=alphabet)


def pseudonym(kind: str, value: str, key: bytes) -> str:
    """The value's pseudonym, or the value itself if it fails its kind's check."""
    if kind == "email":
        return _email(value, key)
    if kind == "access":
        return value[:4] + disguise(value[4:], key, "access")
    if kind == "ssn":
        return _onto(value, disguise(_bare(value), key, "ssn", social)) if social(_bare(value)) else value
    return {"secret": _secret, "iban": _iban, "day": _day, "phone": _phone, "card": _card, "address": _address}[kind](value, key)


def reading(kind: str, value: str) -> tuple[int, bool]:
    """How much of a match is taken, and whether it is a value. Of a card or account number that runs
    into its neighbours, the longest part from its start to the end of a group that passes the check;
    without one the first group is passed over, and the search goes on behind it."""
    if kind not in ("card", "iban"):
        return len(value), True
    ends = [m.end() for m in re.finditer(r"[A-Z0-9]+", value)]
    valid = card if kind == "card" else iban
    return next(((end, True) for end in reversed(ends) if valid(_bare(value[:end]))), (ends[0], False))


def replace(text: str, key: bytes) -> tuple[str, int]:
    """The text with pseudonyms and how many values were replaced."""
    if not _HINT.search(text):
        return text, 0
    found = 0
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if not _HINT.search(line):
            continue
        out, at = [], 0
        while match := _ANY.search(line, at):
            kind = next(k for k in _FORMS if match[k])
            start, stop = match.span("hidden" if kind == "secret" else kind)
            size, valid = reading(kind, line[start:stop])
            old = line[start : start + size]
            new = pseudonym(kind, old, key) if valid else old
            found += new != old
            out += [line[at:start], new]
            at = start + size
        lines[i] = "".join([*out, line[at:]])
    return "\n".join(lines), found


def pseudonymize(docs: DataFrame, key: bytes, column: str = "text") -> DataFrame:
    """Replace personal data in a column; adds ``n_replaced``, keeps the other columns."""
    columns = [c for c in docs.columns if c != "n_replaced"]
    schema = docs.select(*columns, F.lit(0).cast("long").alias("n_replaced")).schema

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(column)
            done = [(None, 0) if t is None else replace(t, key) for t in batch.column(at).to_pylist()]
            texts = pa.array([t for t, _ in done], batch.schema.field(at).type)
            counts = pa.array([n for _, n in done], pa.int64())
            own = [texts if c == column else batch.column(batch.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*own, counts], names=[*columns, "n_replaced"])

    return docs.mapInArrow(run, schema)
