"""Secret scan: keyword prefilter (Aho-Corasick), anchored expressions, embedded checks."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import record_batches

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "checked_token", "web_token", "private_key")

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_WEB = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]*")
_PEM = re.compile(r"-----BEGIN ([A-Z ]{0,20}PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum_text(body: str) -> str:
    """CRC-32 of a token's body as six base-62 digits, as issued tokens end with."""
    n, out = binascii.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = _BASE62[digit] + out
    return out


def _json_part(part: str) -> dict | None:
    try:
        value = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _whole_der(body: str) -> bool:
    """The decoded key is one DER sequence whose stated length is its real length."""
    try:
        raw = base64.b64decode("".join(body.split()), validate=True)
    except ValueError:
        return False
    if len(raw) < 2 or raw[0] != 0x30:
        return False
    if raw[1] < 0x80:
        return len(raw) == 2 + raw[1]
    n = raw[1] & 0x7F
    return len(raw) > 2 + n and len(raw) == 2 + n + int.from_bytes(raw[2:2 + n], "big")


def _web_ok(m: re.Match) -> bool:
    header = _json_part(m.group(1))
    return header is not None and "alg" in header and _json_part(m.group(2)) is not None


# kind -> (lower-case keywords, anchored expression, check of a match)
_RULES = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), _ASSIGN,
               lambda m: len(m.group(2)) >= 6),
    "access": (("akia",), _ACCESS, lambda m: len(m.group()) >= 20),
    "checked_token": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"), _CHECKED,
                      lambda m: checksum_text(m.group(1)) == m.group(2)),
    "web_token": (("eyj",), _WEB, _web_ok),
    "private_key": (("-----begin ",), _PEM, lambda m: _whole_der(m.group(2))),
}


# of what a failed match began in: no later start in the same run matches, since all of
# them would have to go on behind its end in the same way
_FAILED_RUN = {"web_token": re.compile(r"[A-Za-z0-9_-]+")}


def _automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for kind, (keywords, _, _) in _RULES.items():
        for word in keywords:
            out.add_word(word, (kind, len(word)))
    out.make_automaton()
    return out


def find_secrets(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every span, by start, then kind in the order of ``KINDS``.

    Per kind the leftmost non-overlapping matches are taken, then those that fail
    their check are dropped.  Hexadecimal runs have no keyword; one scan finds them.
    """
    folded = text if text.islower() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    spans = [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    free = dict.fromkeys(_RULES, 0)
    starts = sorted((end - size + 1, kind) for end, (kind, size) in automaton.iter(folded))
    for start, kind in starts:
        if start < free[kind]:
            continue
        _, expression, check = _RULES[kind]
        m = expression.match(text, start)
        if m:
            free[kind] = m.end()
            if check(m):
                spans.append((start, m.end(), kind))
        elif kind in _FAILED_RUN:
            free[kind] = _FAILED_RUN[kind].match(text, start).end()
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton()
    for batch in batches:
        spans = [[] if text is None else [{"kind": k, "start": s, "end": e} for s, e, k in find_secrets(text, automaton)]
                 for text in batch.column("text").to_pylist()]
        yield record_batches([("doc_id", batch.schema.field("doc_id").type, batch.column("doc_id")),
                              ("spans", pa.list_(_SPAN), spans)])


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans array<struct<kind,start,end>>``: secrets of every whole text.

    Offsets are code points, end exclusive.  Base kinds: ``assign`` (a secret's name,
    then a value of 6 or more characters), ``access`` (access key ids), ``hex`` (24 or
    more digits).  Added kinds carry a check of their own: ``checked_token`` (CRC-32 in
    the last six characters), ``web_token`` (decodable header and body), ``private_key``
    (a DER sequence of the stated length).  Null and empty texts have no spans, repeated
    rows are scanned one by one, an empty table gives no rows, extra columns are
    ignored.  One pass, no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_scanned, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
