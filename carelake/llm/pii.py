"""Personal data: keyed format-preserving pseudonyms (Feistel permutations)."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import record_batches

ROUNDS = 8


# -------------------------------------------------------------- keyed permutations

def _round(key: bytes, label: str, number: int, value: int) -> int:
    text = f"{label}/{number}/{value}".encode()
    return int.from_bytes(hashlib.blake2b(text, key=key, digest_size=16).digest(), "big")


def _feistel(key: bytes, label: str, size: int, x: int, back: bool) -> int:
    """A keyed permutation of 0..size-1, or its inverse: two digits in mixed radix take
    turns in being shifted by a hash of the other; values beyond ``size`` walk on."""
    radix = (a := max(1, math.isqrt(size)), -(-size // a))
    while True:
        halves = list(divmod(x, radix[1]))
        for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
            own = number % 2
            shift = _round(key, label, number, halves[1 - own])
            halves[own] = (halves[own] + (-shift if back else shift)) % radix[own]
        x = halves[0] * radix[1] + halves[1]
        if x < size:
            return x


def permuted(key: bytes, label: str, size: int, x: int) -> int:
    """A keyed permutation of 0..size-1 in which no value stays (for size above one):
    the next value in the keyed order."""
    return _feistel(key, label, size, (_feistel(key, label, size, x, back=True) + 1) % size, back=False)


def _digits(key: bytes, label: str, digits: str) -> str:
    """Permuted digits of the same length."""
    if not digits:
        return digits
    return str(permuted(key, f"{label}{len(digits)}", 10 ** len(digits), int(digits))).zfill(len(digits))


def _filled(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced one by one."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in shape)


# ------------------------------------------------------ formats: check and permute

def luhn_digit(body: str) -> str:
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(body)))
    return str(-total % 10)


def _card(key: bytes, m: re.Match) -> str | None:
    digits = re.sub(r"\D", "", m.group())
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = digits[0] + _digits(key, "card", digits[1:-1])
    return _filled(m.group(), body + luhn_digit(body))


def _iban_number(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text))


def _iban(key: bytes, m: re.Match) -> str | None:
    plain = m.group().replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    country, account = plain[:2], plain[4:]
    size, x = 1, 0
    for c in account:
        base, value = (10, int(c)) if c.isdigit() else (26, ord(c) - 65)
        size, x = size * base, x * base + value
    shape = "".join("9" if c.isdigit() else "A" for c in account)
    x = permuted(key, f"iban{country}{shape}", size, x)
    new = []
    for c in reversed(account):
        x, value = divmod(x, 10 if c.isdigit() else 26)
        new.append(str(value) if c.isdigit() else chr(65 + value))
    account = "".join(reversed(new))
    whole = country + f"{98 - _iban_number(account + country + '00') % 97:02d}" + account
    letters = iter(whole)
    return "".join(next(letters) if c != " " else c for c in m.group())


def _phone(key: bytes, m: re.Match) -> str | None:
    """North American numbers keep a possible area and exchange and have eleven digits
    after a plus sign; other international numbers keep their first two digits."""
    digits = re.sub(r"\D", "", m.group())
    if digits[0] == "1" and len(digits) == 11 or len(digits) == 10 and m.group()[0] != "+":
        area, exchange, line = int(digits[-10:-7]), int(digits[-7:-4]), int(digits[-4:])
        if area < 200 or exchange < 200:
            return None
        x = permuted(key, "phone", 800 * 800 * 10_000, ((area - 200) * 800 + exchange - 200) * 10_000 + line)
        x, line = divmod(x, 10_000)
        area, exchange = divmod(x, 800)
        return _filled(m.group(), digits[:-10] + f"{area + 200}{exchange + 200}{line:04d}")
    if m.group()[0] != "+" or digits[0] in "01" or not 8 <= len(digits) <= 15:
        return None
    return _filled(m.group(), digits[:2] + _digits(key, "phone+", digits[2:]))


def _national(key: bytes, m: re.Match) -> str | None:
    area, group, serial = map(int, m.group().split("-"))
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    x = permuted(key, "national", 898 * 99 * 9999, (place * 99 + group - 1) * 9999 + serial - 1)
    x, serial = divmod(x, 9999)
    place, group = divmod(x, 99)
    return f"{place + 1 + (place >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _address(key: bytes, m: re.Match) -> str | None:
    """Unicast IPv4 addresses."""
    parts = [int(x) for x in m.group().split(".")]
    if max(parts) > 255 or not 1 <= parts[0] <= 223 or any(len(x) > 1 and x[0] == "0" for x in m.group().split(".")):
        return None
    x = int.from_bytes(bytes([parts[0] - 1, *parts[1:]]), "big")
    new = permuted(key, "address", 223 << 24, x).to_bytes(4, "big")
    return f"{new[0] + 1}.{new[1]}.{new[2]}.{new[3]}"


_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def _date(key: bytes, m: re.Match) -> str | None:
    """Calendar dates of 1900 to 2099; the order of the parts and the separators stay;
    days and months have no leading zeros where one of them had one digit."""
    parts = re.split(r"([-/.])", m.group())
    year_first = len(parts[0]) == 4
    year, month, day = (parts[0], parts[2], parts[4]) if year_first else (parts[4], parts[2], parts[0])
    american = False
    try:
        when = dt.date(int(year), int(month), int(day))
    except ValueError:
        if year_first or parts[1] != "/":
            return None
        try:
            when, american = dt.date(int(year), int(day), int(month)), True
        except ValueError:
            return None
    x = when.toordinal() - _FIRST_DAY
    if not 0 <= x <= _LAST_DAY - _FIRST_DAY:
        return None
    new = dt.date.fromordinal(_FIRST_DAY + permuted(key, "date", _LAST_DAY - _FIRST_DAY + 1, x))
    first, second = (new.month, new.day) if american or year_first else (new.day, new.month)
    width = min(len(month), len(day))
    if year_first:
        return f"{new.year}{parts[1]}{first:0{width}d}{parts[3]}{second:0{width}d}"
    return f"{first:0{width}d}{parts[1]}{second:0{width}d}{parts[3]}{new.year}"


def _mail(key: bytes, m: re.Match) -> str | None:
    """The local part: letters and digits change within their kind, the rest stays."""
    local, domain = m.group().rsplit("@", 1)
    size, x = 1, 0
    for c in local:
        base, value = (10, int(c)) if c.isdigit() else (26, ord(c.lower()) - 97) if c.isalpha() else (1, 0)
        size, x = size * base, x * base + value
    if size == 1:
        return None
    shape = "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in local)
    x = permuted(key, f"mail{shape}", size, x)
    new = []
    for c in reversed(local):
        x, value = divmod(x, 10 if c.isdigit() else 26 if c.isalpha() else 1)
        new.append(str(value) if c.isdigit() else chr((65 if c.isupper() else 97) + value) if c.isalpha() else c)
    return "".join(reversed(new)) + "@" + domain


# kind -> (expression, what may follow, check and permutation), in the order in which they
# win at one place
KINDS: dict[str, tuple[re.Pattern, re.Pattern, Callable[[bytes, re.Match], str | None]]] = {
    "mail": (re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}"),
             re.compile(""), _mail),
    "iban": (re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}"), re.compile(r"(?![A-Za-z0-9])"), _iban),
    "card": (re.compile(r"(?<![\w+])(?<![0-9]\.)[0-9](?:[ -]?[0-9]){12,18}"), re.compile(r"(?!\w)"), _card),
    # a time may follow
    "date": (re.compile(r"(?<![\w./-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})"),
             re.compile(r"(?=T[0-9])|(?![\w/-])"), _date),
    "address": (re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}"), re.compile(r"(?![\w]|\.[0-9])"), _address),
    "national": (re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}"), re.compile(r"(?![\w-])"), _national),
    # in groups, after a plus sign also without, or ten digits with or without the one ahead
    "phone": (re.compile(r"(?<![\w+])(?<![0-9][.-])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{1,4}[ .-])"
                         r"(?:[0-9]{2,4}[ .-]?){1,3}[0-9]{2,4}|\+[0-9]{8,15}|1?[0-9]{10})"),
              re.compile(r"(?!\w|-\w)"), _phone),
}
_ANY = re.compile(r"[0-9@]")
# kinds whose length is bounded: shorter ends are tried
_BOUNDED = KINDS.keys() - {"mail"}
# usual groups of digits
_GROUPED = {"card": re.compile(r"[0-9]+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{3})?"
                               r"|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}")}


@lru_cache(maxsize=50_000)
def _known(key: bytes, kind: str, value: str) -> str | None:
    expression, _, change = KINDS[kind]
    # the value alone, so that a pseudonym depends on nothing around it
    m = expression.fullmatch(value)
    return change(key, m) if m else None


def _valid(text: str, key: bytes, kind: str, at: int, to: int) -> Iterator[tuple[int, int, str]]:
    """(start, end, pseudonym) of what passes its check and starts in ``at`` to ``to``,
    by start, longest first: what matches gives way to its shorter ends, then to the
    starts from the next character on."""
    expression, after, _ = KINDS[kind]
    while (m := expression.search(text, at)) and m.start() < to:
        at = m.start() + 1
        while m:
            if after.match(text, m.end()):
                new = _known(key, kind, m.group())
                if new is not None:
                    yield m.start(), m.end(), new
            m = expression.match(text, at - 1, m.end() - 1) if kind in _BOUNDED else None


def _next(text: str, key: bytes, kind: str, at: int) -> tuple[int, int, str] | None:
    """The first valid value of a kind from ``at`` on; one that is grouped oddly gives
    way to one in it that is not (a neighbour may pass the check by chance)."""
    first = next(_valid(text, key, kind, at, len(text)), None)
    if first is None or kind not in _GROUPED or _GROUPED[kind].fullmatch(text, *first[:2]):
        return first
    inside = (v for v in _valid(text, key, kind, *first[:2]) if _GROUPED[kind].fullmatch(text, *v[:2]))
    return next(inside, first)


def pseudonyms(text: str, key: bytes) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of every value found, by start, without overlap:
    the leftmost wins, of those the longest, then the kind listed first; the other
    kinds are searched again behind it."""
    if not _ANY.search(text):
        return []
    ahead = {kind: _next(text, key, kind, 0) for kind in KINDS if kind != "mail" or "@" in text}
    out = []
    while ahead := {kind: found for kind, found in ahead.items() if found}:
        kind = min(ahead, key=lambda k: (ahead[k][0], -ahead[k][1]))
        start, end, new = ahead[kind]
        out.append((start, end, kind, new))
        ahead = {k: found if found[0] >= end else _next(text, key, k, end) for k, found in ahead.items()}
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("pseudonym", pa.string())])


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans array<struct<kind,start,end,pseudonym>>, text`` for every row.

    Mail addresses, IBANs, payment cards, dates, IPv4 addresses, national and phone
    numbers that pass their format's check (Luhn, mod 97, calendar, ranges) give way to
    a keyed pseudonym of the same format that passes it too.  A value has one pseudonym
    wherever and however it is written, no two values share one, and no value is its
    own.  Text next to a value does not hide it: of what matches but fails its check,
    shorter ends and later starts are tried.  Offsets are code points of the input, end exclusive.  Null texts stay null
    without spans; repeated rows are done one by one; an empty table gives no rows;
    extra columns are ignored.  One pass, no shuffle.
    """
    if not key:
        raise ValueError("a key is needed")

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts = [], []
            for text in batch.column("text").to_pylist():
                found = pseudonyms(text, key) if text else []
                parts, at = [], 0
                for start, end, _, new in found:
                    parts += [text[at:start], new]
                    at = end
                texts.append("".join([*parts, text[at:]]) if found else text)
                spans.append([{"kind": k, "start": s, "end": e, "pseudonym": p} for s, e, k, p in found])
            yield record_batches([("doc_id", batch.schema.field("doc_id").type, batch.column("doc_id")),
                                  ("spans", pa.list_(_SPAN), spans), ("text", pa.string(), texts)])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(replaced, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,"
                                     "pseudonym:string>>, text string")
