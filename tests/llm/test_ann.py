from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from scholarloom.llm import ann
from scholarloom.llm.queries import QUERIES


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "extra", 1) for i, v in rows], "vec_id long, embedding array<float>, key string, n int")


def brute(rows, k):
    good = {i: np.array(v, "f4").astype("f8") for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)}
    out = {}
    for q in (i for i in good if i % 20 == 0):
        s = sorted((-float(good[q] @ good[i]), i) for i in good if i != q)
        out[q] = [(i, -d) for d, i in s[:k]]
    return out


def lists(got):
    out = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def random_rows(n, seed=3, scale=True):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, 8)) * (r.uniform(0.5, 2, (n, 1)) if scale else 1)
    return [(i, x[i].tolist()) for i in range(n)]


def test_recall_and_exact_scores(spark):
    rows = random_rows(3000)
    got, want = lists(ann.nearest(table(spark, rows), group=500).collect()), brute(rows, 20)
    assert set(got) == set(want)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    vectors = dict(rows)
    for q, found in got.items():
        a = np.array(vectors[q], "f4").astype("f8")
        assert all(abs(s - a @ np.array(vectors[i], "f4").astype("f8")) < 1e-12 for i, s in found)
        assert [(-s, i) for i, s in found] == sorted((-s, i) for i, s in found)


def test_few_ties_and_unusable(spark):
    one = [1.0] + [0.0] * 7
    rows = [(i, one) for i in range(0, 60)] + [(100, [0.5] * 8), (101, [0.0] * 8), (102, None), (103, [1.0, None, *[0.0] * 6]), (120, [float("nan")] * 8), (140, [float("inf")] * 8), (160, [1.0]), (None, one), (0, one), (180, [])]
    got, want = lists(ann.nearest(table(spark, rows), success=0.9999).collect()), brute(rows, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert got[0][0] == (1, 1.0) and len(got[0]) == 20 and set(got) == {0, 20, 40, 100}
    few = lists(ann.nearest(table(spark, random_rows(30, scale=False)), success=0.9999).collect())
    assert {len(v) for v in few.values()} == {20}
    assert [len(v) for v in lists(ann.nearest(table(spark, random_rows(5)), success=0.9999).collect()).values()] == [4]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(0, [1.0] * 8)]])
def test_nothing_to_find(spark, rows):
    assert ann.nearest(table(spark, rows)).collect() == []


def test_visited_buckets_reach_the_wanted_success():
    r = np.random.default_rng(0)
    p = r.dirichlet([2, 5, 5, 2], (6, 5))
    logs = np.log(p)
    least = ann.least_visited(logs, 0.8)
    codes = np.arange(4**5)
    for q in range(6):
        lp = sum(logs[q, f, codes >> 2 * f & 3] for f in range(5))
        mass = np.exp(lp[lp >= least[q]]).sum()
        assert 0.8 <= mass < 0.93  # in order of probability, and not many more than needed
        want = {int(c) % 16 for c in codes[lp >= least[q]]}
        assert set(ann.visited_groups(logs[q], least[q], 2).tolist()) == want


def test_recall_on_embeddings(spark):
    folder = Path("/root/testdata/sf0.01")
    if not folder.exists():
        pytest.skip("no tables")
    t = pq.read_table(folder / "embeddings.parquet").to_pydict()
    good = [(i, v) for i, v in zip(t["vec_id"], t["embedding"], strict=True) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good], "f4").astype("f8")
    got = lists(QUERIES["op7_ann"](spark, str(folder)).collect())
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        want = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hits += len(want & {i for i, _ in got[ids[q]]})
        total += len(want)
    assert hits / total >= 0.9


def clustered(n, centres, dims, seed):
    r = np.random.default_rng(seed)
    c = r.standard_normal((centres, dims))
    return c[r.integers(0, centres, n)] + 0.05 * r.standard_normal((n, dims))


def test_only_visited_buckets_are_scored():
    x = clustered(6000, 60, 16, 1)
    scale = np.linalg.norm(x, axis=1).max()
    index = ann.fit_index(x[:2000], scale, len(x), 20)
    weights = np.int64(4) ** np.arange(index.functions)
    bucket = index.cells(index.projections(x, False))[:, 0] @ weights
    group = ann.Group(index, np.arange(len(x)), bucket, x)
    queries = x[::20]
    visited = group.visited(queries, 0)
    scores, taken = group.scores(queries, visited)
    size = dict(zip(*np.unique(bucket, return_counts=True), strict=True))
    assert taken == sum(visited[:, j].sum() * size[b] for j, b in enumerate(sorted(size)))
    assert taken == np.isfinite(scores).sum() < 0.2 * len(queries) * len(x)
    found = [set(ids) for ids, _ in zip(*group.best(queries, 0, 21), strict=True)]
    near = np.argsort(-(queries @ x.T), axis=1)[:, :21]
    assert np.mean([len(f & set(w.tolist())) / 21 for f, w in zip(found, near, strict=True)]) >= 0.8  # of one table


def test_vectors_within_rounding_are_ranked_exactly():
    r = np.random.default_rng(2)
    base = r.standard_normal(16)
    x = np.array([base + 1e-7 * r.standard_normal(16) for _ in range(300)], "f4").astype("f8")
    index = ann.fit_index(x[:15], np.linalg.norm(x, axis=1).max(), len(x), 20)
    group = ann.Group(index, np.arange(len(x)), np.zeros(len(x), "i8"), x)
    [ids], [scores] = group.best(x[:1], 0, 20)
    exact = (x[0] * x).sum(axis=1)
    assert ids == np.lexsort((np.arange(len(x)), -exact))[:20].tolist() and scores == exact[ids].tolist()
