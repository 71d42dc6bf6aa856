import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from carelake.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n\n b c", "x\t y", "it's we'll 'd", "é ü ñ 中文 字",
       "<|endoftext|> a <|endoftext|>", "hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|><|endoftext|>", "a<|endoftext|>b c",
       "<|endoftext|", "<<|endoftext|>>", "a <|endoftext|>  <|endoftext|>\n", "é<|endoftext|> ü", "a b  c", "1 2  33\n", "a \x1c b\x1d c", " \n \n", "a" * 3000, "!? ..  ##"]


def same_ids(tokenizer, texts):
    encoder = packing.TextIds(PATH)
    return all(np.frombuffer(encoder.encode(t), dtype="<u4").tolist() == ids_of(tokenizer, t)[:-1] for t in texts)


def test_ids_are_those_of_the_vocabulary(tokenizer, sample):
    assert same_ids(tokenizer, ODD + [t for _, t, _ in sample[1]])


def test_ids_of_every_character_and_of_white_space(tokenizer):
    """Both ways of splitting agree on what is a letter, a digit and white space."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    blocks = ["".join(every[i:i + 50]) for i in range(0, len(every), 50)]
    assert same_ids(tokenizer, [f"a{c}b {c} 1{c}  {c}\n{c}" for c in [*blocks, *every[:0x3100]]])
    rng = random.Random(3)
    pool = [chr(c) for c in (9, 10, 11, 12, 13, 28, 31, 32, 0x85, 0xA0, 0x1680, 0x180E, 0x2003, 0x200B, 0x2028, 0x3000, 0xFEFF)]
    pool += [*"aB1.'é中ß٣, ", "'s", "'ll", " the", "<|endoftext|>", "<|"]
    assert same_ids(tokenizer, ["".join(rng.choices(pool, k=rng.randrange(20))) for _ in range(20_000)])


def test_long_words_take_linear_time(tokenizer):
    started = time.monotonic()
    for unit in ("a", "é", "1", "!", " ", "\n", "aé1"):
        packing.TextIds(PATH).encode(unit * 300_000)
    assert time.monotonic() - started < 60


def test_added_tokens_are_one_id(tokenizer):
    end = tokenizer.token_to_id("<|endoftext|>")
    ids = packing.TextIds(PATH).encode("hello <|endoftext|> world")
    assert np.frombuffer(ids, dtype="<u4").tolist() == [31373, 220, end, 995] == ids_of(tokenizer, "hello <|endoftext|> world")[:-1]


def check_packing(counts, capacity):
    table = packing.packed_lengths(counts, capacity)
    used = {}
    places = {}
    for length, first, times, sequence, offset in table.tolist():
        assert first == used.get(length, 0)
        used[length] = first + times
        for i in range(times):
            places.setdefault(sequence + i, []).append((offset, length))
    assert used == {k: n for k, n in counts.items() if n}
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_of_lengths_is_valid_and_tight():
    rng = random.Random(1)
    for capacity in (1, 2, 7, 20, 50):
        for _ in range(60):
            counts = {}
            for _ in range(rng.randrange(1, 30)):
                w = rng.randrange(1, capacity + 1)
                counts[w] = counts.get(w, 0) + rng.randrange(1, 6)
            bins = check_packing(counts, capacity)
            least = -(-sum(w * n for w, n in counts.items()) // capacity)
            assert bins <= 11 / 9 * least + 4
    assert check_packing({}, 10) == 0


def fewest(items, capacity):
    best = len(items)

    def place(i, free):
        nonlocal best
        if len(free) >= best:
            return
        if i == len(items):
            best = len(free)
            return
        for k in {f: j for j, f in enumerate(free) if f >= items[i]}.values():
            place(i + 1, [*free[:k], free[k] - items[i], *free[k + 1:]])
        place(i + 1, [*free, capacity - items[i]])

    place(0, [])
    return best


def test_fixed_sets_never_cost_a_bin():
    rng = random.Random(2)
    for _ in range(150):
        capacity = rng.choice([10, 15, 20])
        items = sorted((rng.randrange(2, capacity + 1) for _ in range(rng.randrange(1, 9))), reverse=True)
        count = np.zeros(capacity + 1, dtype=np.int64)
        for w in items:
            count[w] += 1
        fixed, rest = packing.reduced(count, capacity)
        left = [w for w in range(capacity, 0, -1) for _ in range(rest[w])]
        assert fewest(items, capacity) == sum(t for _, t in fixed) + fewest(left, capacity)


def test_pieces_against_brute_force(docs_of, tokenizer, sample):
    long = " ".join(t for _, t, _ in sample[1][:12])
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b c"), (5, long)] + [(10 + i, t) for i, t in enumerate(ODD)]
    placed = packing.pack_documents(docs_of(rows).withColumnRenamed("lang", "piece"), PATH).collect()
    want = []
    for doc, text in rows:
        ids = ids_of(tokenizer, text)
        for piece, (start, length) in enumerate(packing.cuts(len(ids), 1024)):
            want.append((doc, piece, start, length, zlib.crc32(np.array(ids[start:start + length], dtype="<u4").tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(bytes(r["ids"]))) for r in placed]
    assert sorted(got, key=str) == sorted(want, key=str)
    bins = {}
    for r in placed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_cuts():
    assert list(packing.cuts(1024, 1024)) == [(0, 1024)]
    assert list(packing.cuts(2049, 1024)) == [(0, 1), (1, 1024), (1025, 1024)]
    assert list(packing.cuts(3, 1024)) == [(0, 3)]


def test_empty_table(docs_of):
    assert packing.pack_documents(docs_of([]), PATH).count() == 0
