import hashlib
import random

import numpy as np
import pytest

from scholarloom.llm import suffix_dedup as sd

from .helpers import docs, words


def brute(rows, length=200):
    seen, raw = {}, [(t or "").encode() for _, t in rows]
    for d, t in enumerate(raw):
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i : i + length], []).append((d, i))
    gone = [np.zeros(len(t), bool) for t in raw]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + length] = True
    out = []
    for (i, _), t, g in zip(rows, raw, gone, strict=True):
        spans = int((g & ~np.r_[False, g[:-1]]).sum()) if len(g) else 0
        out.append((i, len(t), int(g.sum()), spans, hashlib.sha256(np.frombuffer(t, "u1")[~g].tobytes()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    return sorted(map(tuple, sd.repeat_report(docs(spark, rows).repartition(3), **more).collect()), key=repr)


def corpus(seed):
    r = random.Random(seed)
    passages = [words(f"p{seed}{i}", r.randrange(20, 120)) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [words(f"{seed} {i} {k}", r.randrange(0, 60)) if r.random() < 0.5 else (p := r.choice(passages))[r.randrange(20) : len(p) - r.randrange(20)] for k in range(r.randrange(5))]
        rows.append((i, r.choice((" ", "", "é")).join(parts)))
    return rows


SPECIAL = [
    (100, None), (101, ""), (102, "ab" * 300), (103, "é" * 250), (104, "x" * 199), (105, "x" * 200), (106, "x" * 200), (106, "x" * 200), (None, words("n", 80)), (107, words("n", 80)[:210]), (108, "abcdefg " * 60), (109, words("own", 4000)),
    (110, words("own", 4000)[5000:5199]), (111, words("own", 4000)[7000:7200]), (112, words("t", 60) + "|" + words("t", 60)),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rows = [*corpus(seed), *SPECIAL]
    assert run(spark, rows) == brute(rows)


def test_other_length_and_large_groups(spark, monkeypatch):
    monkeypatch.setattr(sd, "GROUP", 3)
    rows = [*corpus(5), *SPECIAL]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, length=120) == brute(rows, 120)


def test_many_contexts_by_distance(spark, monkeypatch):
    rows = [*corpus(9), *SPECIAL]
    monkeypatch.setattr(sd, "SETTLED", 2)  # before the functions are sent to the workers
    held = [(1, 7, 5 << 16 | 3 << 8 | 9, True, bytes(range(200)) + bytes(6)), (1, 8, 5 << 16 | 0 << 8 | 0, False, bytes(200))]
    assert sd.clipped(held, 4, 6) == [(1, 7, 5 << 16 | 4 << 8 | 6, True, (bytes(range(200)) + bytes(6))[3:205])]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == brute([(1, None)])


def test_texts_in_parts(monkeypatch):
    text = bytes(random.Random(1).choices(b"abc", k=5000))
    for lo, part in sd._segments(text, 200, most=1000):
        assert text[lo : lo + len(part)] == part
    starts = {s for lo, part in sd._segments(text, 200, most=1000) for s in range(lo, lo + len(part) - 199)}
    assert starts == set(range(5000 - 199))


def test_rows_keep_their_columns(spark):
    df = docs(spark, [(1, words("a", 60)), (2, "é" + words("a", 60) + "é"), (3, "own")])
    out = sd.remove_repeats(df)
    assert out.columns == df.columns
    assert {r.doc_id: (r.text, r.key) for r in out.collect()} == {1: ("", "extra key"), 2: ("éé", "extra key"), 3: ("own", "extra key")}


def test_fingerprints_and_minimum():
    r = np.random.default_rng(2)
    data = r.integers(0, 4, 3000).astype("u1")
    p = sd.Prints(data)
    lo = r.integers(0, 2900, 400)
    h = p.of(lo, lo + 5)
    same = {}
    for i, x in zip(lo.tolist(), h.tolist(), strict=True):
        assert same.setdefault(bytes(data[i : i + 5]), x) == x
    assert len(set(same.values())) == len(same)
    v = r.integers(0, 2**63, 500).astype(np.uint64)
    assert [int(np.argmin(v[i : i + 9])) + i for i in range(492)] == sd.leftmost_minimum(v, 9).tolist()


@pytest.mark.parametrize("length", [47, 304])
def test_lengths_that_do_not_fit(spark, length):
    with pytest.raises(ValueError, match="length must be 48 to 303"):
        sd.repeat_report(docs(spark, [(1, "x")]), length=length)


def test_several_rounds(spark):
    rows = [*corpus(7), *SPECIAL]
    assert run(spark, rows, length=300) == brute(rows, 300)
