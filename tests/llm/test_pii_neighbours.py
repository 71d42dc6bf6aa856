"""Personal data next to other text."""

import random
import re

import pytest

from carelake.llm import pii

KEY = b"test"


def alone(value):
    found = pii.pseudonyms(value, KEY)
    assert len(found) == 1 and found[0][:2] == (0, len(value)), (value, found)
    return found[0][2], found[0][3]


def without(text):
    """The text with its pseudonyms."""
    parts, at = [], 0
    for start, end, _, new in pii.pseudonyms(text, KEY):
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]])


@pytest.mark.parametrize("text, value, kind", [
    ("4111 1111 1111 1111 12/25", "4111 1111 1111 1111", "card"),
    ("4111111111111111 123", "4111111111111111", "card"),
    ("7 4111111111111111", "4111111111111111", "card"),
    ("7-4111111111111111-8", "4111111111111111", "card"),
    ("card-4111111111111111", "4111111111111111", "card"),
    ("paid.4111111111111111.", "4111111111111111", "card"),
    ("DE89370400440532013000 BIC COBADEFFXXX", "DE89370400440532013000", "iban"),
    ("DE89 3704 0044 0532 0130 00 A bank", "DE89 3704 0044 0532 0130 00", "iban"),
    ("AB12 DE89370400440532013000", "DE89370400440532013000", "iban"),
    ("call +14155552671 12", "+14155552671", "phone"),
    ("call +1 415 555 2671 12", "+1 415 555 2671", "phone"),
    ("call 4155552671, 3", "4155552671", "phone"),
    ("tel.4155552671", "4155552671", "phone"),
    ("7 415 555 2671", "415 555 2671", "phone"),
    ("+33 6 12 34 56 78 ou", "+33 6 12 34 56 78", "phone"),
    ("+33612345678.", "+33612345678", "phone"),
    ("at 2021-02-28T10:20:30Z", "2021-02-28", "date"),
    ("on 3/4/2020 and", "3/4/2020", "date"),
    ("am 1.12.1999.", "1.12.1999", "date"),
    ("2021-2-8", "2021-2-8", "date"),
])
def test_text_next_to_a_value(text, value, kind):
    found, new = alone(value)
    assert found == kind and new != value
    assert without(text) == text.replace(value, new)


def test_random_neighbours_hide_no_card():
    rng = random.Random(8)
    for _ in range(500):
        body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        number = body + pii.luhn_digit(body)
        beside = [str(rng.randrange(10 ** rng.randrange(1, 5))) for _ in range(2)]
        text = f"{beside[0]} {number} {beside[1]}"
        assert number not in without(text), text


def test_values_side_by_side():
    text = "415 555 2671 4111 1111 1111 1111 DE89370400440532013000 42.144.35.254 2021-02-28 123-45-6789 a.b@c.org"
    values = ["415 555 2671", "4111 1111 1111 1111", "DE89370400440532013000", "42.144.35.254", "2021-02-28", "123-45-6789", "a.b@"]
    assert not [v for v in values if v in without(text)]


def test_pseudonyms_of_the_new_forms_are_of_their_form():
    assert re.fullmatch(r"\+1[2-9]\d\d[2-9]\d{6}", alone("+14155552671")[1])
    assert alone("+14155552671")[1][2:] == alone("4155552671")[1] == re.sub(r"\D", "", alone("(415) 555-2671")[1])
    assert re.fullmatch(r"\+33 \d \d\d \d\d \d\d \d\d", alone("+33 6 12 34 56 78")[1])
    days = {f"{d}/{m}/2020" for d in range(1, 29) for m in range(1, 10)}
    assert len({alone(x)[1] for x in days}) == len(days)
    for text in ("1234567890", "2001234567", "31/4/2020", "2021-02-30T10:00", "v1.2.2020", "+1 415 555 267", "abc4041894974608795"):
        assert pii.pseudonyms(text, KEY) == [], text


def test_tables_of_numbers_end():
    text = " ".join(str(x) for x in range(1000, 9000))
    assert without(text).count(" ") == text.count(" ")
