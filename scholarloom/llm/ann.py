"""Nearest neighbours by inner product with multiprobe p-stable hashing.

Vectors are scaled to norms of at most one and get one more component that makes all norms one, so
the largest inner product is the smallest Euclidean distance. A table hashes a vector by
floor((a.x - m) / W) for several Gaussian directions a. Instead of adding tables, a query visits in
each table, besides its own bucket, the buckets with perturbed hash values in the order of the
estimated probability of holding a neighbour, until these add up to the wanted success. Vectors lie
sorted by bucket, and a query is multiplied with the slices of its visited buckets alone. All that come
within rounding of its k best are ranked again by the exact inner product, and the tables' candidates
are merged.

Directions come from a seed; medians, widths, how a neighbour's projections follow the query's, and
with it the wanted success, are fitted on a sample of at most `sample` vectors (smallest hash of vec_id). Every vector is indexed. Buckets are
dealt out in groups of about `group` vectors; a group with more is split, each part meeting the
same queries. Equal vectors are searched once: a class holds its smallest k + 1 ids, which is all
that the k nearest of any query can need.

Defined cases: vectors that are null, zero, hold null or non-finite components or have another
length than most take no part; a query with fewer candidates than k gets them all; ties go to the
smaller vec_id; of rows that repeat a vec_id with the same vector one counts; a null vec_id takes
no part; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SAMPLE = 20_000
GROUP = 8192
BUCKET = 16
#: A bucket's hash values share one 64-bit number.
MOST_FUNCTIONS = 30


@dataclass
class Index:
    """Hash functions and the probing rule. A hash value is one of CELLS, a bucket its values as base-4 digits."""

    directions: np.ndarray  # tables x functions x (dimensions + 1)
    middle: np.ndarray  # tables x functions
    width: np.ndarray
    scale: float  # the largest norm
    #: A neighbour's projection given its query's, in widths: slope * query + shift, with this deviation.
    slope: np.ndarray  # tables x functions
    shift: np.ndarray
    spread: np.ndarray
    wanted: float  # success in one table
    group_functions: int

    @property
    def tables(self) -> int:
        return len(self.directions)

    @property
    def functions(self) -> int:
        return self.directions.shape[1]

    def projections(self, x: np.ndarray, query: bool) -> np.ndarray:
        """rows x tables x functions, in widths from the middle."""
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        if query:
            unit = np.hstack([x / norm, np.zeros((len(x), 1))])
        else:
            scaled = x / self.scale
            unit = np.hstack([scaled, np.sqrt(np.maximum(0, 1 - (norm / self.scale) ** 2))])
        return (np.einsum("nd,tfd->ntf", unit, self.directions) - self.middle) / self.width

    def cells(self, p: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(p), -2, 1).astype("i8") + 2

    def log_success(self, p: np.ndarray) -> np.ndarray:
        """rows x tables x functions x cells: log probability that a neighbour of the query has that hash value."""
        mean, spread = self.slope * p + self.shift, self.spread
        below = [_normal_below((edge - mean) / spread) for edge in (-1, 0, 1)]
        parts = [below[0], below[1] - below[0], below[2] - below[1], 1 - below[2]]
        return np.log(np.maximum(np.stack(parts, axis=-1), 1e-12))


def _normal_below(z: np.ndarray) -> np.ndarray:
    """The normal distribution function, to 1e-7."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    tail = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z > 0, 1 - tail, tail)


def fit_index(sample: np.ndarray, scale: float, total: int, k: int, *, tables: int = 2, success: float = 0.97, group: int = GROUP, seed: int = 5) -> Index:
    """functions: so many that a bucket holds about BUCKET vectors. The rule is fitted to the k nearest, in the
    sample, of some of its vectors: these lie further off than the k nearest in the whole table."""
    rng = np.random.default_rng(seed)
    functions = int(np.clip(round(math.log2(max(1, total / BUCKET))), 2, MOST_FUNCTIONS))
    directions = rng.standard_normal((tables, functions, sample.shape[1] + 1))
    one = np.ones((tables, functions))
    index = Index(directions, 0 * one, one, scale, one, 0 * one, one, 1.0, int(np.clip(math.ceil(math.log2(max(1, total / group))), 0, functions)))
    p = index.projections(sample, False)
    index.middle = np.median(p, axis=0)
    index.width = 3 * np.maximum(p.std(axis=0), 1e-6)
    p = (p - index.middle) / index.width
    asked = np.arange(0, len(sample), max(1, len(sample) // 300))
    near = sample[asked] @ sample.T
    near[np.arange(len(asked)), asked] = -np.inf
    m = min(k, len(sample) - 1)
    if m >= len(sample) - 1:
        return index  # every other vector is one of the k nearest: all buckets are visited
    found = np.argpartition(-near, m - 1, axis=1)[:, :m]
    q = index.projections(sample[asked], True)
    x, y = np.repeat(q, m, axis=0), p[found.ravel()]
    mx, my = x.mean(axis=0), y.mean(axis=0)
    index.slope = ((x - mx) * (y - my)).mean(axis=0) / np.maximum(((x - mx) ** 2).mean(axis=0), 1e-9)
    index.shift = my - index.slope * mx
    index.spread = np.maximum((y - index.slope * x - index.shift).std(axis=0), 0.02)
    # How far down a table's order each of them stands; the likelier table finds it.
    logs = index.log_success(q)
    cells = index.cells(y).reshape(len(asked), m, tables, functions)
    depth = np.ones((len(asked), m))
    for t in range(tables):
        mass = np.cumsum(binned(logs[:, t]), axis=1)
        lp = np.take_along_axis(logs[:, None, t], cells[:, :, t, :, None], axis=3)[..., 0].sum(axis=2)
        depth = np.minimum(depth, np.take_along_axis(mass, np.clip(np.round(-lp / BIN), 0, BINS - 1).astype("i8"), axis=1))
    index.wanted = float(min(1.0, np.quantile(depth, success)))
    return index


BINS, BIN = 512, 0.08


def binned(logs: np.ndarray) -> np.ndarray:
    """queries x functions x cells log probabilities of one table to how much probability buckets of each level hold, by binned logarithms."""
    n = len(logs)
    mass = np.zeros((n, BINS))
    mass[:, 0] = 1
    step = np.minimum(np.round(-logs / BIN).astype("i8"), BINS - 1)
    for f in range(logs.shape[1]):
        new = np.zeros_like(mass)
        for c in range(logs.shape[2]):
            target = np.minimum(np.arange(BINS)[None, :] + step[:, f, c, None], BINS - 1)
            flat = target + np.arange(n)[:, None] * BINS
            new += np.bincount(flat.ravel(), (mass * np.exp(logs[:, f, c])[:, None]).ravel(), n * BINS).reshape(n, BINS)
        mass = new
    return mass


def least_visited(logs: np.ndarray, wanted: float) -> np.ndarray:
    """The log probability of the last bucket that each query visits in a table.

    Buckets are visited by falling probability until these add up to `wanted`. How much lies at each
    level is summed up function by function, not bucket by bucket.
    """
    last = (np.cumsum(binned(logs), axis=1) < wanted - 1e-12).sum(axis=1)
    out = -(np.minimum(last, BINS - 1) + 0.5 * math.sqrt(logs.shape[1])) * BIN  # rounding adds up; a bucket at the border is visited
    return np.where(last >= BINS - 1, -np.inf, out)


def visited_groups(logs: np.ndarray, least: float, functions: int) -> np.ndarray:
    """Groups (values of the first functions) of one query that hold a bucket as probable as `least`."""
    rest = logs.max(axis=1)
    code, lp, left = np.zeros(1, "i8"), np.zeros(1), rest.sum()
    for f in range(functions):
        left -= rest[f]
        lp = (lp[:, None] + logs[f][None, :]).ravel()
        code = (code[:, None] + (np.arange(4, dtype="i8") << np.int64(2 * f))[None, :]).ravel()
        keep = lp + left >= least
        code, lp = code[keep], lp[keep]
    return code


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(len(column), -1).astype("f8")


def _place(index: Index, splits: dict[tuple[int, int], int]):
    """Class vectors to one row a table: (table, grp, part, side 0, id, bucket, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.int64(4) ** np.arange(index.functions)
        for batch in batches:
            ids, raw = batch.column(0).to_numpy(), batch.column(1)
            cells = index.cells(index.projections(_vectors(raw), False))
            for t in range(index.tables):
                bucket = cells[:, t] @ weights
                grp = bucket % 4**index.group_functions
                parts = np.array([splits.get((t, g), 1) for g in grp.tolist()])
                yield _rows(t, grp, ids % parts, 0, ids, bucket, raw)

    return run


def _rows(t, grp, part, side, ids, bucket, raw) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, t, "i4")), pa.array(np.asarray(grp, "i8")), pa.array(np.asarray(part, "i4")), pa.array(np.full(n, side, "i4")), pa.array(ids), pa.array(bucket), raw],
        ["table", "grp", "part", "side", "id", "bucket", "vector"],
    )


def _probe(index: Index, splits: dict[tuple[int, int], int]):
    """Query classes to one row for each table and group with visited buckets: (table, grp, part, side 1, id, -1, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                logs = index.log_success(index.projections(_vectors(some.column(1)), True))
                for t in range(index.tables):
                    least = least_visited(logs[:, t], index.wanted)
                    out = [(i, g, part) for i in range(len(least)) for g in visited_groups(logs[i, t], least[i], index.group_functions).tolist() for part in range(splits.get((t, g), 1))]
                    row, grp, part = (np.array(x, "i8") for x in zip(*out, strict=True))
                    yield _rows(t, grp, part, 1, some.column(0).to_numpy()[row], np.full(len(row), -1), some.column(1).take(pa.array(row)))

    return run


class Group:
    """The vectors of a group of buckets, sorted by bucket and divided by the largest norm."""

    def __init__(self, index: Index, ids: np.ndarray, bucket: np.ndarray, matrix: np.ndarray):
        order = np.argsort(bucket, kind="stable")
        self.index, self.ids, self.matrix = index, ids[order], matrix[order]
        kinds, first = np.unique(bucket[order], return_index=True)
        self.cuts = np.r_[first, len(bucket)].tolist()
        self.flat = (self.matrix / index.scale).astype("f4").T.copy()
        digits = kinds[None, :] >> (np.int64(2) * np.arange(index.functions))[:, None] & 3
        # Buckets as columns of ones for their hash values.
        self.hot = (digits[:, None, :] == np.arange(4)[None, :, None]).reshape(index.functions * 4, -1).astype("f8")

    def visited(self, queries: np.ndarray, table: int) -> np.ndarray:
        """queries x buckets."""
        logs = self.index.log_success(self.index.projections(queries, True))[:, table]
        return logs.reshape(len(logs), -1) @ self.hot >= least_visited(logs, self.index.wanted)[:, None]

    def scores(self, queries: np.ndarray, visited: np.ndarray) -> tuple[np.ndarray, int]:
        """queries x vectors in single precision, -inf outside visited buckets, and how many products were taken."""
        unit = (queries / np.linalg.norm(queries, axis=1, keepdims=True)).astype("f4")
        out = np.full((len(queries), len(self.ids)), -np.inf, "f4")
        taken = 0
        for bucket, (lo, hi) in enumerate(zip(self.cuts, self.cuts[1:], strict=False)):
            asking = np.flatnonzero(visited[:, bucket])
            if len(asking):
                out[asking, lo:hi] = unit[asking] @ self.flat[:, lo:hi]
                taken += len(asking) * (hi - lo)
        return out, taken

    def best(self, queries: np.ndarray, table: int, k: int) -> tuple[list[list[int]], list[list[float]]]:
        """Ids and exact scores of each query's k best in its visited buckets."""
        scores, _ = self.scores(queries, self.visited(queries, table))
        m = min(k, scores.shape[1])
        # The products of vectors of norm one at most are off by less than this; what comes so near to the last is compared exactly.
        off = (queries.shape[1] + 8) * 2.0**-23
        last = -np.partition(-scores, m - 1, axis=1)[:, m - 1]
        near = np.isfinite(scores) & (scores >= last[:, None] - 2 * off)
        ids, found = [], []
        for q, row in zip(queries, near, strict=True):
            own = np.flatnonzero(row)
            exact = (q * self.matrix[own]).sum(axis=1)
            top = np.lexsort((self.ids[own], -exact))[:k]
            ids.append(self.ids[own[top]].tolist())
            found.append(exact[top].tolist())
        return ids, found


def _search(index: Index, k: int):
    """Rows sorted by (table, grp, part, side) to each query's best k classes of the part: (query, ids, scores)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, pending, group = None, [], None
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy().astype("i8") for i in range(4)], axis=1)
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)], strict=True):
                if tuple(key[a, :3].tolist()) != where:
                    where, pending, group = tuple(key[a, :3].tolist()), [], None
                if key[a, 3] == 0:
                    some = batch.slice(a, b - a)
                    pending.append((some.column(4).to_numpy(), some.column(5).to_numpy(), _vectors(some.column(6))))
                    continue
                if not pending:
                    continue
                group = group or Group(index, *(np.concatenate(x) for x in zip(*pending, strict=True)))
                for lo in range(a, b, 256):
                    some = batch.slice(lo, min(256, b - lo))
                    ids, scores = group.best(_vectors(some.column(6)), where[0], k)
                    yield pa.RecordBatch.from_arrays([some.column(4), pa.array(ids, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64()))], ["query", "ids", "scores"])

    return run


def _merge(k: int):
    """Rows sorted by query to its best k classes over all tables and parts: (query, id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, best = None, {}
        out: list[tuple] = []

        def cut() -> None:
            nonlocal best
            best = dict(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k])

        for batch in batches:
            for query, ids, scores in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if query != last:
                    cut()
                    out += [(last, i, s) for i, s in best.items()]
                    last, best = query, {}
                best.update(zip(ids, scores, strict=True))
                if len(best) > 50 * k:
                    cut()
            if len(out) > 20_000:
                yield _found(out)
                out = []
        cut()
        yield _found(out + [(last, i, s) for i, s in best.items()])

    return run


def _found(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) if out else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], ["query", "id", "score"])


def nearest(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, tables: int = 2, success: float = 0.97, sample: int = SAMPLE, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of each row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v")).where("id is not null and size(v) > 0")
    own = own.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    empty = "query_id long, rank int, vec_id long, score double"
    lengths = own.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], empty)
    dims = lengths[0]["d"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy().astype("<f4").reshape(-1, dims)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in flat], pa.binary()), pa.array((flat.astype("f8") ** 2).sum(axis=1))], ["id", "vector", "square"])

    rows = own.where(F.size("v") == dims).mapInArrow(packed, "id long, vector binary, square double")
    # Only k + 1 ids of a vector count; the limit on dense_rank works before the shuffle, however many rows share a vector.
    rows = rows.withColumn("key", F.md5("vector"))
    held = rows.withColumn("n", F.dense_rank().over(Window.partitionBy("key").orderBy("id"))).where(F.col("n") <= k + 1).dropDuplicates(["key", "id"])
    classes = written(held.groupBy("key").agg(F.min("id").alias("id"), F.first("vector").alias("vector"), F.sort_array(F.collect_list("id")).alias("ids"), F.first("square").alias("square")), "classes")
    total = classes.count()
    scale = math.sqrt(classes.agg(F.max("square")).first()[0])
    bounded = classes.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").collect()
    index = fit_index(np.frombuffer(b"".join(r[0] for r in bounded), "<f4").reshape(-1, dims).astype("f8"), scale, total, k, tables=tables, success=success, group=group)
    del bounded
    asked = written(rows.where(F.col("id") % every == 0).select("id", "key").distinct().join(classes.select("key", F.col("id").alias("query")), "key").select(F.col("id").alias("query_id"), "query"), "asked")
    of_vectors = classes.select("id", "vector")
    schema = "table int, grp long, part int, side int, id long, bucket long, vector binary"
    # At most tables * 4**group_functions numbers, about one a group of vectors.
    counts = of_vectors.mapInArrow(_place(index, {}), schema).groupBy("table", "grp").agg(F.count("*").alias("n")).where(F.col("n") > 2 * group).collect()
    splits = {(r["table"], r["grp"]): math.ceil(r["n"] / group) for r in counts}
    placed = of_vectors.mapInArrow(_place(index, splits), schema)
    probed = asked.select(F.col("query").alias("id")).distinct().join(of_vectors, "id").mapInArrow(_probe(index, splits), schema)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.unionByName(probed).repartition(n, "table", "grp", "part").sortWithinPartitions("table", "grp", "part", "side")
    found = dealt.mapInArrow(_search(index, k + 1), "query long, ids array<long>, scores array<double>")
    best = found.repartition(n, "query").sortWithinPartitions("query").mapInArrow(_merge(k + 1), "query long, id long, score double").where("query is not null")
    # A query's own class is always among its candidates.
    own_class = asked.select("query").distinct().join(classes.select(F.col("id").alias("query"), "square"), "query").select("query", F.col("query").alias("id"), F.col("square").alias("score"))
    best = written(best.unionByName(own_class).dropDuplicates(["query", "id"]), "neighbours")
    # Classes to their ids, classes of queries to the queries.
    ids = classes.select("id", "ids")
    lists = best.join(ids, "id").groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    lists = written(lists, "lists")
    joined = asked.join(lists, "query")
    flat = F.flatten(F.transform("found", lambda x: F.transform(x["ids"], lambda i: F.struct((-x["score"]).alias("far"), i.alias("vec_id")))))
    ranked = F.slice(F.array_sort(F.filter(flat, lambda x: x["vec_id"] != F.col("query_id"))), 1, k)
    out = joined.select("query_id", F.posexplode(ranked).alias("pos", "x"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.far")).alias("score"))
