"""Personal data against separate checks of every token."""

import datetime as dt
import random
import re

from carelake.llm import pii

KEY = b"test"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod_97(plain):
    return int("".join(str(ord(c) - 55) if c.isalpha() else c for c in plain[4:] + plain[:4])) % 97 == 1


def is_date(token):
    m = re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)|(\d\d)\.(\d\d)\.(\d{4})", token)
    if not m:
        return False
    y, mo, d = (m[1], m[2], m[3]) if m[1] else (m[6], m[5], m[4])
    try:
        return 1900 <= dt.date(int(y), int(mo), int(d)).year <= 2099
    except ValueError:
        return False


def kind_of(token):
    """What a token is, by rules of its own; None if its check fails."""
    digits = re.sub(r"[ -]", "", token)
    if re.fullmatch(r"[a-z0-9.]+@[a-z0-9]+\.[a-z]{2,24}", token) and re.search(r"[a-z0-9]", token.split("@")[0]):
        return "mail"
    if re.fullmatch(r"[A-Z]{2}\d\d[A-Z0-9]{11,30}", token.replace(" ", "")):
        return "iban" if mod_97(token.replace(" ", "")) else None
    if re.fullmatch(r"\d{16}|\d{4}( \d{4}){3}|\d{4}(-\d{4}){3}", token):
        return "card" if luhn(digits) and len(set(digits)) > 1 else None
    if re.fullmatch(r"\d{3}-\d\d-\d{4}", token):
        a, g, s = map(int, token.split("-"))
        return "national" if 0 < a < 900 and a != 666 and g and s else None
    if re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", token):
        parts = token.split(".")
        fine = all(p == str(int(p)) and int(p) < 256 for p in parts) and 0 < int(parts[0]) < 224
        return "address" if fine else None
    if is_date(token):
        return "date"
    if re.fullmatch(r"\+1 \d{3} \d{3} \d{4}", token):
        return "phone" if int(token[3:6]) >= 200 and int(token[7:10]) >= 200 else None
    return None


def tokens(rng):
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    body = d(15)
    card = next(body + c for c in "0123456789" if luhn(body + c))
    account = d(18)
    iban = next(f"DE{c:02d}{account}" for c in range(2, 99) if mod_97(f"DE{c:02d}{account}"))
    when = dt.date(1900, 1, 1) + dt.timedelta(days=rng.randrange(73_000))
    return rng.choice([
        card, " ".join(re.findall("....", card)), "-".join(re.findall("....", card)), body + str((int(card[-1]) + 1) % 10), "1" * 16,
        iban, " ".join(re.findall(".{1,4}", iban)), f"DE00{account}", f"{rng.randrange(1000):03d}-{rng.randrange(100):02d}-{rng.randrange(10_000):04d}",
        "666-12-3456", f"{rng.randrange(1, 224)}.{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}", "01.2.3.4", "300.1.2.3", "0.1.2.3",
        when.isoformat(), when.strftime("%d.%m.%Y"), "2021-02-30", "31.04.2020", f"+1 {d(3)} {d(3)} {d(4)}",
        f"{rng.choice(['ann', 'bo.b', 'x9'])}{rng.randrange(99)}@mail{rng.randrange(9)}.example", "word", "é", "", "v2", "@", "12"])


def test_every_token_against_its_own_check(docs_of):
    rng = random.Random(11)
    pool = [tokens(rng) for _ in range(600)]
    rows = [(i, " | ".join(rng.choices(pool, k=rng.randrange(1, 12)))) for i in range(400)] + [(900, None), (901, ""), (1, "dup"), (1, "dup")]
    df = docs_of(rows).withColumnRenamed("lang", "spans")
    found = {}
    for r in pii.pseudonymise(df, KEY).collect():
        found.setdefault(r["doc_id"], []).append(r)
    new_of, seen = {}, set()
    for doc, text in rows:
        if doc == 1:  # two rows with that id
            continue
        (row,) = found[doc]
        at, want, out = 0, [], []
        for token in (text or "").split(" | "):
            if kind := kind_of(token):
                want.append((kind, at, at + len(token)))
            at += len(token) + 3
        assert [(s["kind"], s["start"], s["end"]) for s in row["spans"]] == want, text
        if text is None:
            assert row["text"] is None
            continue
        by_start = {s["start"]: s["pseudonym"] for s in row["spans"]}
        at = 0
        for token in text.split(" | "):
            new = by_start.get(at, token)
            out.append(new)
            if at in by_start:
                kind = kind_of(token)
                seen.add(kind)
                plain, other = (re.sub(r"[ -]", "", x) if kind in ("card", "iban") else x for x in (token, new))
                # one pseudonym a value, of its format and valid as it is, never itself
                assert new_of.setdefault((kind, plain), other) == other and plain != other
                assert kind_of(new) == kind
                shape = lambda x: re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "9", x)))
                assert kind == "address" or shape(new) == shape(token)
            at += len(token) + 3
        assert row["text"] == " | ".join(out)
    assert seen == {"mail", "iban", "card", "national", "address", "date", "phone"}
    # no two values share a pseudonym
    assert len({(k, v) for (k, _), v in new_of.items()}) == len(new_of)
