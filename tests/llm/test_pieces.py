import hashlib
import random
import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from scholarloom.llm import piece_bpe

from .helpers import docs, words

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = piece_bpe.PieceModel(PATH)
FRESH = piece_bpe.PieceModel(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdehilnorst  ▁ \n\t123éü中文😀\x00<s>_A", max_size=60))
def test_like_the_library(text):
    ids = LIBRARY.encode(text)
    assert MODEL.encode(text) == ids
    assert MODEL.decode(ids) == LIBRARY.decode(ids) == MODEL.decode_words(MODEL.words_of(text))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31999) | st.integers(0, 300), max_size=12))
def test_decoding_any_ids(ids):
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


def test_long_words():
    for text in ("a" * 3000, "ab" * 1500, "the" * 999, "▁" * 300, " " * 301, "中" * 500, "\n" * 50, words(3, 3000)):
        assert MODEL.encode(text) == LIBRARY.encode(text)


def test_report(spark):
    rows = [(1, None), (2, ""), (3, "Hello  world\n"), (3, "Hello  world\n"), (None, "x ▁y"), (4, words(1, 20_000))]
    got = piece_bpe.encode_report(docs(spark, rows), PATH).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = LIBRARY.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert piece_bpe.encode_report(docs(spark, []), PATH).collect() == []


def test_kept_words_are_bounded_by_their_characters(monkeypatch):
    monkeypatch.setattr(piece_bpe, "_CACHE_CHARS", 20_000)
    model = piece_bpe.PieceModel(PATH)
    for seed in range(12):
        text = words(seed, 50) + " " + "".join(chr(97 + (seed * i * i) % 26) for i in range(3000))
        assert model.encode(text) == LIBRARY.encode(text)
        assert model.held < 20_000 + 40_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "aa", "the", "in", "ing", "tion", "on", "er", "st", "th", "e", "s", "é", "中", "1", "ab", "▁"]), max_size=60), st.sampled_from([2, 5, 1024]))
def test_long_parts_in_rounds_of_their_own(parts, longest):
    text = "".join(parts)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(piece_bpe, "LONG", longest)
        m.setattr(piece_bpe, "CUT", 4)
        assert piece_bpe.PieceModel.encode(FRESH, text) == LIBRARY.encode(text)
        FRESH.words.clear()


def test_unbroken_text_takes_little_time():
    r = random.Random(4)
    prose = "".join(words(7, 40_000).split(" "))
    for text in ("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000)), "".join(r.choice("etaoinshr") for _ in range(200_000)), "a" * 200_000, prose, "thequickbrownfox" * 12_000):
        start = time.process_time()
        ids = MODEL.encode(text)
        assert time.process_time() - start < 20
        assert ids == LIBRARY.encode(text)
