import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scholarloom.llm import packing

from .helpers import docs, words

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ids_of = lambda t: LIBRARY.encode(t or "", add_special_tokens=False).ids


def check(rows, got, window):
    if not rows:
        assert got == []
        return
    want = sorted(((i, tuple([*ids_of(t), 1])) for i, t in rows), key=repr)
    total = sum(len(x) for _, x in want)
    covered = np.zeros(total, int)
    for r in got:
        assert 0 < r.length and 0 <= r.offset and r.offset + r.length <= window
        covered[r.sequence_id * window + r.offset : r.sequence_id * window + r.offset + r.length] += 1
    assert (covered == 1).all()
    last = max(r.sequence_id for r in got)
    short = total - last * window
    assert all(r.padded_length == (window if r.sequence_id < last or short & (short - 1) else short) for r in got)
    # Pieces in stream order make up the documents.
    order = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    found, at = [], 0
    while at < len(order):
        pieces = [order[at]]
        assert pieces[0].start == 0
        while pieces[-1].start + pieces[-1].length < pieces[0].doc_tokens:
            at += 1
            pieces.append(order[at])
            assert pieces[-1].start == pieces[-2].start + pieces[-2].length
        at += 1
        found.append(pieces)
    left = list(want)
    for pieces in found:
        match = next(x for x in left if x[0] == pieces[0].doc_id and len(x[1]) == pieces[0].doc_tokens and all(zlib.crc32(np.array(x[1][p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for p in pieces))
        left.remove(match)
    assert not left


ROWS = [(1, None), (2, ""), (3, "Hello, World! It's 2020"), (3, "Hello, World! It's 2020"), (None, "null id"), (4, words(1, 5000)), (5, "中文 ünïcode İstanbul ΣΑΣ"), (6, " \n\t "), (7, "<|endoftext|> a"), (8, "x" * 5000)]


@pytest.mark.parametrize("window", [2048, 16, 1])
def test_pieces(spark, window):
    rows = [*ROWS, *((i, words(i, random.Random(i).randrange(60))) for i in range(100, 160))]
    check(rows, packing.pack(docs(spark, rows).repartition(5), PATH, window=window).collect(), window)


def test_power_of_two_and_empty(spark):
    got = packing.pack(docs(spark, [(i, "") for i in range(4)]), PATH, window=8).collect()
    assert {r.padded_length for r in got} == {4}
    check([], packing.pack(docs(spark, []), PATH).collect(), 2048)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB'stréİΣ1½ \n\t\xa0\x1c\x85.,<|>中😀́", max_size=30), max_size=8))
def test_ids_like_the_library(texts):
    assert [x.tolist() for x in packing.ChunkTokens(PATH).encode(texts)] == [ids_of(t) for t in texts]


def thue_morse(n):
    return "".join("ab"[i.bit_count() & 1] for i in range(n))


@pytest.mark.parametrize("n", [8, 64, 256, 257, 1024, 4096])
def test_words_with_equal_polynomials(n):
    """Polynomial fingerprints modulo a power of two agree on this pair from 1,024 letters on, whatever the base."""
    one = thue_morse(n)
    texts = [one, one.translate(str.maketrans("ab", "ba")), f"{one} {one[::-1]} x"]
    own = packing.ChunkTokens(PATH)
    for _ in range(2):
        assert [x.tolist() for x in own.encode(texts)] == [ids_of(t) for t in texts]


def test_equal_fingerprints_are_told_apart(monkeypatch):
    monkeypatch.setattr(packing.Prints, "of", lambda self, lo, hi: np.zeros(len(lo), np.uint64))
    r = random.Random(3)
    texts = [" ".join("".join(r.choice("abcde") for _ in range(r.choice([3, 7, 8, 9, 15, 16, 17, 300]))) for _ in range(50)) for _ in range(20)]
    own = packing.ChunkTokens(PATH)
    for lot in (texts[:10], texts, texts[::-1]):
        assert [x.tolist() for x in own.encode(lot)] == [ids_of(t) for t in lot]


def test_random_words_of_any_length():
    r = random.Random(5)
    texts = [" ".join("".join(r.choice("abcdefghij") for _ in range(r.randrange(1, 5000))) for _ in range(4)) for _ in range(25)]
    own = packing.ChunkTokens(PATH)
    assert [x.tolist() for x in own.encode(texts)] == [ids_of(t) for t in texts]


def test_chunks_stay_right_after_thinning(monkeypatch):
    monkeypatch.setattr(packing, "_CACHE", 60)
    own = packing.ChunkTokens(PATH)
    for seed in range(30):
        texts = [words(seed, 40, 90).replace("w", "wordlike") + " " + words(seed, 40, 30)]
        assert [x.tolist() for x in own.encode(texts)] == [ids_of(t) for t in texts]
