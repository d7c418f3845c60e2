from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from scholarloom.llm import graph
from scholarloom.llm import near_dedup as nd

from .helpers import docs, edited, words


def brute(rows):
    """Class ids by the Jaccard similarity of five-word shingle sets of every pair."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            parent[top(a)] = top(b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[top(i)].append(rows[i][0])
    out = []
    for i in range(len(rows)):
        own = [x for x in groups[top(i)] if x is not None]
        out.append((rows[i][0], min(own) if own and sets[i] else rows[i][0], len(groups[top(i)]) if sets[i] else 1))
    return sorted(out, key=repr)


def run(spark, rows):
    return sorted(((r.doc_id, r.class_id, r.class_size) for r in nd.near_classes(docs(spark, rows)).collect()), key=repr)


ROWS = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (7, words("a", 300)), (8, words("a", 300).upper() + " "), (9, edited(words("a", 300), 0.01, 1)), (10, edited(words("a", 300), 0.4, 2)), (None, words("a", 300)), (7, words("a", 300)), (11, "x " * 20_000)]


def test_classes(spark):
    assert run(spark, ROWS) == brute(ROWS)


def test_links_that_a_head_does_not_see(spark):
    # Copies of a base text that are close to the base but not to each other, and chains of edits.
    base = words("base", 400)
    rows = [(i, edited(base, 0.016 + 0.001 * (i % 8), i)) for i in range(60)] + [(99, base)]
    chain = base2 = words("chain", 300)
    for i in range(20):
        chain = edited(chain, 0.012, 1000 + i)
        rows.append((200 + i, chain))
    rows += [(300 + i, words(f"passage", 150) + " " + words(f"own {i}", 120)) for i in range(30)] + [(400, base2)]
    assert run(spark, rows) == brute(rows)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 7)
    base = words("b", 400)
    rows = [(i, edited(base, 0.02, i)) for i in range(50)]
    assert run(spark, rows) == brute(rows)


def test_same_shingles_in_very_different_counts(spark):
    # The second text of a pair repeats a fifth of the first 20 or 100 times.
    rows = []
    for i in range(24):
        text = words(f"counts {i}", 400).split(" ")
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(text[:80] * (20 if i % 2 else 100) + text[80:]))]
    want = brute(rows)
    assert {n for *_, n in want} == {2}
    sig, _ = nd.text_signatures([t for _, t in rows])
    assert (sig[::2] == sig[1::2]).mean(axis=1).min() > 0.9
    assert run(spark, rows) == want


def test_equal_bytes_are_no_common_band():
    # Two texts differ in a component of the first band whose byte is the same in both: they meet in the second band first.
    sig = np.repeat(np.random.default_rng(3).integers(1, 2**63, (1, nd.M)).astype(np.uint64), 2, axis=0)
    byte = lambda x: (nd.mix(x) & np.uint64(255)).astype("u1")
    others = np.arange(1, 10_000, dtype=np.uint64)
    sig[1, 0] = others[(byte(others) == byte(sig[:1, 0])) & (others != sig[0, 0])][0]
    bands, low = nd.band_keys(sig), byte(sig)
    assert bands[0, 0] != bands[1, 0] and (bands[0, 1:] == bands[1, 1:]).all() and (low[0] == low[1]).all()

    def kept(b):
        rows = [{"band": int(bands[0, b]), "b": b, "i": 0, "j": 0, "side": 2, "key": k, "root": k, "first": False, "size": 300, "sig": low[x].tobytes(), "bands": bands[x].tolist()} for x, k in enumerate((b"u", b"v"))]
        return {r["u"] for out in nd._in_blocks(0.8, False)(iter([pa.RecordBatch.from_pylist(rows)])) for r in out.to_pylist()}

    assert kept(1) == {b"u", b"v"} and kept(2) == set()


def test_signatures_estimate_probability_jaccard():
    r = np.random.default_rng(5)
    h = r.integers(1, 2**63, 300).astype(np.uint64)
    wa, wb = r.uniform(0.5, 3, 300), r.uniform(0.5, 3, 300)
    wa[:60] = 0
    pa_, pb = wa / wa.sum(), wb / wb.sum()
    both = (wa > 0) & (wb > 0)
    want = sum(1 / np.maximum(wa / wa[i], wb / wb[i]).sum() for i in np.flatnonzero(both))
    m = 4000
    sig = nd.signatures(np.r_[np.zeros((wa > 0).sum(), "i8"), np.ones(300, "i8")], np.r_[h[wa > 0], h], np.r_[wa[wa > 0], wb], 2, m)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.04 and pa_.sum() == pytest.approx(pb.sum())
    share = np.array([(sig[1] == x).mean() for x in h])
    assert np.abs(share - pb).max() < 0.01  # an element is drawn with its share of the weight


def test_one_row_stays(spark):
    df = docs(spark, ROWS)
    out = nd.keep_one_of_each(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == {1, 2, 3, 4, 6, 7, 10, 11}
    assert nd.keep_one_of_each(docs(spark, [])).count() == 0 and run(spark, []) == []


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), *((i, i + 1) for i in range(100, 140)), *((200, i) for i in range(201, 260))]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {2: 1, 3: 1, 8: 7, 9: 7} | {i: 100 for i in range(101, 141)} | {i: 200 for i in range(201, 260)}
