"""Pseudonyms against planted values: where they stand, and what each form must keep, is known."""

import datetime as dt
import ipaddress
import random
import re

import pytest

from cumulo.llm import pii

KEY = b"planted values"


def luhn_sum(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled)


def iban_number(account):
    moved = account[4:] + account[:4]
    return int("".join(str("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ".index(c)) for c in moved))


def digits_of(value):
    return re.sub(r"\D", "", value)


def cards(draw):
    while True:
        body = draw.choice("3456") + "".join(draw.choice("0123456789") for _ in range(14))
        for last in "0123456789":
            if luhn_sum(body + last) % 10 == 0:
                plain = body + last
        yield draw.choice([plain, "-".join(plain[i : i + 4] for i in range(0, 16, 4)), " ".join(plain[i : i + 4] for i in range(0, 16, 4))])


def ibans(draw):
    while True:
        body = "".join(draw.choice("0123456789") for _ in range(18))
        check = 98 - iban_number("DE00" + body) % 97
        yield f"DE{check:02d}{body}"


def days(draw):
    while True:
        day = dt.date(1950, 1, 1) + dt.timedelta(draw.randrange(30_000))
        yield draw.choice([day.isoformat(), day.strftime("%d.%m.%Y")])


def real_day(value):
    return dt.datetime.strptime(value, "%Y-%m-%d" if value[4] == "-" else "%d.%m.%Y")


def addresses(draw):
    while True:
        yield ".".join(str(draw.randrange(1, 256)) for _ in range(4))


def social_numbers(draw):
    while True:
        yield f"{draw.choice([*range(1, 666), *range(667, 900)]):03d}-{draw.randrange(1, 100):02d}-{draw.randrange(1, 10_000):04d}"


def mails(draw):
    while True:
        yield f"{draw.choice(['jane', 'Max', 'x9'])}.{draw.randrange(10_000)}@mail{draw.randrange(100)}.example.org"


def secrets(draw):
    while True:
        yield "password=" + "".join(draw.choice("abcdefXYZ0123456789") for _ in range(draw.randrange(8, 20)))


def phones(draw):
    while True:
        yield f"+49 {draw.randrange(30, 1000)} {draw.randrange(100, 10_000)} {draw.randrange(100, 10_000)}"


CHECKS = {
    cards: lambda v: luhn_sum(digits_of(v)) % 10 == 0,
    ibans: lambda v: iban_number(v) % 97 == 1,
    days: lambda v: bool(real_day(v)),
    addresses: lambda v: bool(ipaddress.ip_address(v)),
    social_numbers: lambda v: v[:3] not in ("000", "666") and v < "9" and v[4:6] != "00" and v[7:] != "0000",
    mails: lambda v: v.endswith(".org") and v.count("@") == 1,
    secrets: lambda v: v.startswith("password="),
    phones: lambda v: v.startswith("+49 "),
}


def shape(value):
    head, sign, hidden = value.partition("=")
    if sign and re.fullmatch("[0-9a-f]+", hidden):
        # Hexadecimal digits are all of one kind.
        return head + "=" + "h" * len(hidden)
    return re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "0", value)))


@pytest.mark.parametrize("form", CHECKS, ids=lambda f: f.__name__)
def test_planted_values(spark, form):
    """All planted values change, to valid ones of their form; nothing else does; equal values stay equal and
    different ones different."""
    draw = random.Random(form.__name__)
    source = form(draw)
    values = list(dict.fromkeys(next(source) for _ in range(300)))
    around = ["before ", "plain words, ", "Line.\n", "é 日本 "]
    texts, planted = [], []
    for i, value in enumerate(values):
        head, tail = draw.choice(around), draw.choice([" after", ", then", "\nnext", ""])
        again = draw.choice(values[: i + 1])
        texts.append(f"{head}{value}{tail} and {again}\n")
        planted.append((len(head), value, len(head) + len(value) + len(tail) + len(" and "), again))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in pii.pseudonymize(df, KEY).collect()}
    known = {}
    for i, (at, value, later, again) in enumerate(planted):
        new = got[i]["text"]
        assert len(new) == len(texts[i])
        for start, old in ((at, value), (later, again)):
            found = new[start : start + len(old)]
            assert CHECKS[form](found) and shape(found) == shape(old)
            assert known.setdefault(old, found) == found
        rest = new[:at] + new[at + len(value) : later] + new[later + len(again) :]
        assert rest == texts[i][:at] + texts[i][at + len(value) : later] + texts[i][later + len(again) :]
    assert sum(old != new for old, new in known.items()) >= 0.99 * len(known)
    if form is not cards:
        assert len(set(known.values())) == len(known)


def test_invalid_values_and_plain_texts_stay(spark):
    texts = ["order 4111111111111112", "DE00123456789012345678", "13.13.2020 and 2021-02-30", "300.1.1.1", "000-12-3456", "a = b", "", None, "words only"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: (r["text"], r["n_replaced"]) for r in pii.pseudonymize(df, KEY).collect()}
    assert got == {i: (t, 0) for i, t in enumerate(texts)}
