"""Near-duplicate classes by ProbMinHash.

A text's words (lower-cased, split at white space) give a set of shingles of five words, all of
weight 1. ProbMinHash assigns each shingle a Poisson process of rate its weight whose arrivals
fall on random components of the signature; each component keeps its earliest arrival, and a
process ends once it is later than every component's best. Components of two signatures agree with
the probability Jaccard of the weighted sets, which for equal weights is the Jaccard similarity that
links are verified by. Signatures are cut into bands.

Documents with the same words are one node. In every bucket of a band the nodes are compared with
the bucket's smallest node first. Where a bucket's nodes are then still in several components, all
pairs between components are left to compare: the nodes outside the largest component, in blocks,
with all nodes, in blocks, by signatures, and then by texts for the likely pairs, until the blocks'
components are joined or all these pairs are refuted.
A link counts if the Jaccard similarity of the two shingle sets, computed from the texts, is at
least 0.8. Classes are the connected components of the links; the smallest doc_id stays.

Defined cases: a null text counts as empty; texts of fewer than five words are one shingle; texts
without words share no shingle, so each is a class of its own; a null doc_id stays only if its class
has no other; repeated rows fall into one class; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import Scratch, bound_batches, tidy, written
from .graph import components
from .hashing import mix

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 26, 5
M = BANDS * ROWS
#: Signatures whose share of equal components is lower than the threshold by more are not compared: over four standard errors.
SLACK = 0.15
#: Nodes of a block; two blocks meet in one task.
BLOCK = 256

_GOLD = np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = out = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return out


_hash = WordHash()


def forget() -> None:
    """Drop what this worker has kept of its texts' words."""
    _hash.clear()


def shingles(text: str) -> np.ndarray:
    """Hashes of a normalised text's shingles, repeats included."""
    words = text.split(" ") if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hash.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - WORDS + 1)
    out = np.full(n, np.uint64(len(h) if len(h) < WORDS else WORDS))
    for k in range(min(WORDS, len(h))):
        out = mix(out * _GOLD + h[k : k + n])
    return out


def signatures(doc: np.ndarray, h: np.ndarray, w: np.ndarray, docs: int, m: int = M) -> np.ndarray:
    """ProbMinHash signatures (docs x m) of elements h with weights w of the documents doc.

    All elements draw their next arrivals at once, those whose process has passed the latest
    component of their document drop out.
    """
    best = np.full(docs * m, np.inf)
    sig = np.zeros(docs * m, np.uint64)
    x = np.zeros(len(h))
    size = np.bincount(doc, minlength=docs)
    drawn = np.uint64(0)
    first = True
    while len(h):
        # Few elements draw many arrivals a round, many elements one.
        k = 1 if first or len(h) > 50_000 else int(min(64, max(1, 100_000 // len(h))))
        first = False
        steps = (np.arange(k, dtype=np.uint64) + drawn) * _GOLD
        drawn += np.uint64(k)
        r = mix(h[:, None] + steps[None, :])
        u = ((r >> np.uint64(11)).astype("f8") + 0.5) * 2.0**-53
        at = x[:, None] + np.cumsum(-np.log(u) / w[:, None], axis=1)
        slot = doc[:, None] * m + (mix(r ^ _GOLD) % np.uint64(m)).astype("i8")
        take = at < best[slot]
        where, when = slot[take], at[take]
        value = np.broadcast_to(h[:, None], at.shape)[take]
        order = np.argsort(-when, kind="stable")
        where = where[order]
        best[where] = when[order]  # of several the earliest is written last
        sig[where] = value[order]
        latest = best.reshape(docs, m).max(axis=1)
        stay = at[:, -1] < latest[doc]
        doc, h, w, x = doc[stay], h[stay], w[stay], at[stay, -1]
    sig = sig.reshape(docs, m)
    sig[size == 0] = 0
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(len(sig), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD, (len(sig), BANDS)).copy()
    for k in range(ROWS):
        out = mix(out * _GOLD + parts[:, :, k])
    return out.view("i8")


def text_signatures(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and the number of different shingles."""
    owner, value = [], []
    for i, t in enumerate(texts):
        v = np.unique(shingles(t))
        owner.append(np.full(len(v), i, "i8"))
        value.append(v)
    h = np.concatenate(value)
    # Counts stay out: with other weights components would not agree with the Jaccard similarity of the sets.
    sig = signatures(np.concatenate(owner), h, np.ones(len(h)), len(texts))
    return sig, np.array([len(v) for v in value], "i4")


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lo = 0
        while lo < batch.num_rows:
            hi, held = lo, 0
            texts: list[str] = []
            seen: dict[bytes, int] = {}
            rows: list[int] = []
            while hi < batch.num_rows and held < 1_000_000 and hi - lo < 1024:
                key = batch.column(1)[hi].as_py()
                if key not in seen:
                    seen[key] = len(texts)
                    texts.append(batch.column(2)[hi].as_py())
                    held += len(texts[-1])
                rows.append(seen[key])
                hi += 1
            sig, full = text_signatures(texts)
            keys = band_keys(sig)
            low = (mix(sig) & np.uint64(255)).astype("u1")
            some = batch.slice(lo, hi - lo)
            bands = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype="i4") * BANDS, keys[rows].ravel())
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([low[r].tobytes() for r in rows], pa.binary()), bands, pa.array(full[rows], pa.int32())], ["doc", "key", "sig", "bands", "size"])
            lo = hi


def normal(text: str) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), "(?U)\\s+", " "))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, key, norm): key is a 128-bit digest of the words."""
    rows = docs.select(F.col(id_col).alias("doc"), normal(text_col).alias("norm"))
    return rows.select("doc", F.unhex(F.md5(F.col("norm").cast("binary"))).alias("key"), "norm")


@F.arrow_udf(DoubleType())
def jaccard(left: pa.Array, right: pa.Array) -> pa.Array:
    """Jaccard similarity of the shingle sets of two normalised texts."""
    out, last, kept = [], None, np.empty(0, np.uint64)
    for x, y in zip(left, right, strict=True):
        b = y.as_py()
        if b != last:
            last, kept = b, np.unique(shingles(b))
        own = np.unique(shingles(x.as_py()))
        common = len(np.intersect1d(own, kept, assume_unique=True))
        total = len(own) + len(kept) - common
        out.append(common / total if total else 0.0)
    return pa.array(out, pa.float64())


@F.arrow_udf(DoubleType())
def agreement(left: pa.Array, right: pa.Array) -> pa.Array:
    """Share of equal components, from one byte of each."""
    a = np.frombuffer(b"".join(left.to_pylist()), "u1").reshape(len(left), -1)
    b = np.frombuffer(b"".join(right.to_pylist()), "u1").reshape(len(right), -1)
    return pa.array((a == b).mean(axis=1))


#: What a row is in a pair of blocks: outside the largest component on the left, in it on the right, outside on both sides, outside on the right.
LEFT, LARGEST, BOTH, RIGHT = 0, 1, 2, 3


def candidates(root: np.ndarray, key: np.ndarray, head: np.ndarray, side: np.ndarray, size: np.ndarray, sig: np.ndarray, bands: np.ndarray, band: int, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """(a, others): pairs of two blocks that may be links between components, likeliest first.

    Each pair comes up in the first band whose key, all 64 bits of it, is the same for both, and there once: with two ends
    outside the largest component the smaller key stands on the left. Pairs with a bucket's head were compared before.
    """
    right = (side != LEFT) & ~head
    for a in np.flatnonzero(((side == LEFT) | (side == BOTH)) & ~head).tolist():
        fits = np.minimum(size, size[a]) >= threshold * np.maximum(size, size[a])
        others = np.flatnonzero(right & (root != root[a]) & fits & ((side == LARGEST) | (key > key[a])))
        if not len(others):
            continue
        share = (sig[others] == sig[a]).mean(axis=1)
        good = np.flatnonzero(share >= threshold - SLACK)
        good = good[(bands[others[good]] == bands[a]).argmax(axis=1) == band]
        if len(good):
            yield a, others[good[np.argsort(-share[good], kind="stable")]]


def _in_blocks(threshold: float, verify: bool):
    """Rows (band, b, i, j, side, key, root, head, size, sig, bands[, norm]) sorted by (band, i, j).

    Without texts: the rows that still have something to compare, as (band, i, j, u, null).
    With texts: links found, as (band, i, j, u, v), no more than join the block's components.
    """

    def settle(key: tuple, rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return []
        number = lambda at: np.unique(np.array([r[at].hex() for r in rows]), return_inverse=True)[1]
        root = number(6)
        side, size = np.array([r[4] for r in rows]), np.array([r[8] for r in rows])
        sig = np.frombuffer(b"".join(r[9] for r in rows), "u1").reshape(len(rows), -1)
        head = np.array([r[7] for r in rows])
        found = candidates(root, number(5), head, side, size, sig, np.array([r[10] for r in rows]), rows[0][1], threshold)
        if not verify:
            wanted = set()
            for a, others in found:
                wanted.add(a)
                wanted.update(others.tolist())
            return [(*key, rows[x][5], None) for x in wanted]
        parent = list(range(int(root.max()) + 1))
        sets: dict[int, np.ndarray] = {}

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def own(x: int) -> np.ndarray:
            if x not in sets:
                sets[x] = np.unique(shingles(rows[x][11]))
            return sets[x]

        out = []
        for a, others in found:
            for b in others.tolist():
                if top(root[a]) == top(root[b]):
                    continue
                x, y = own(a), own(b)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common >= threshold * (len(x) + len(y) - common):
                    parent[top(root[a])] = top(root[b])
                    out.append((*key, rows[a][5], rows[b][5]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, found = None, [], []

        def emit() -> pa.RecordBatch:
            cols = list(zip(*found, strict=True)) if found else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["band", "i", "j", "u", "v"])

        for batch in (b.slice(lo, 1000) for b in batches for lo in range(0, b.num_rows, 1000)):
            cols = [c.flatten().to_numpy().reshape(-1, BANDS) if pa.types.is_list(c.type) else c.to_pylist() for c in batch.columns]
            for row in zip(*cols, strict=True):
                key = (row[0], row[2], row[3])
                if key != group:
                    found += settle(group, held)
                    group, held = key, []
                    if len(found) > 20_000:
                        yield emit()
                        found.clear()
                held.append(row)
        found += settle(group, held)
        yield emit()

    return run


class NearDuplicates:
    """The stages, each written to the shared folder."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD):
        self.spark, self.threshold = docs.sparkSession, threshold
        bound_batches(self.spark)
        self.rows = keyed(docs, id_col, text_col)
        kind = dict(docs.dtypes)[id_col]
        self.signed = written(self.rows.mapInArrow(tidy(_sign, forget), f"doc {kind}, key binary, sig binary, bands array<bigint>, size int"), "signatures")
        # One node for each text; of the copies one row's text is read later, the smallest doc_id's.
        nodes = self.signed.where("size > 0").groupBy("key")
        self.scratch = Scratch(self.spark, "near")
        self.nodes = self.scratch.written(nodes.agg(F.min("doc").alias("doc"), F.first("sig").alias("sig"), F.first("bands").alias("bands"), F.first("size").alias("size")), "nodes")
        self.sigs = self.nodes.select("key", "sig", "size")

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (u, v) those that can be links by the sizes of their sets and by their signatures."""
        by = lambda name, s, n: self.sigs.select(F.col("key").alias(name), F.col("sig").alias(s), F.col("size").alias(n))
        both = pairs.join(by("u", "su", "nu"), "u").join(by("v", "sv", "nv"), "v")
        fits = F.least("nu", "nv") >= F.greatest("nu", "nv") * F.lit(self.threshold)
        return both.where(fits).where(agreement("su", "sv") >= self.threshold - SLACK).select("u", "v")

    def verified(self, likely: DataFrame) -> DataFrame:
        """Of pairs (u, v) those at the threshold, by their texts."""
        text = lambda name, t: self.texts.select(F.col("key").alias(name), F.col("norm").alias(t))
        return likely.join(text("u", "tu"), "u").join(text("v", "tv"), "v").where(jaccard("tu", "tv") >= self.threshold).select("u", "v")

    def run(self) -> DataFrame:
        """(node, root) of nodes that aren't their component's root."""
        member = self.nodes.select("key", F.posexplode("bands").alias("b", "band"))
        # Counts combine before the shuffle; a bucket of one node ends here.
        heads = self.scratch.written(member.groupBy("band").agg(F.min("key").alias("head"), F.count("*").alias("n")).where("n > 1"), "buckets")
        members = self.scratch.written(member.join(heads, "band").select("band", "b", "key", "head", "n"), "members")
        # The texts of all nodes that share a bucket, fetched once. (key, doc) spreads the copies of a text; one of them is wanted.
        wanted = members.select("key").distinct().join(self.nodes.select("key", "doc"), "key")
        same = (self.rows["key"] == wanted["key"]) & self.rows["doc"].eqNullSafe(wanted["doc"])
        self.texts = self.scratch.written(self.rows.join(wanted, same).select(wanted["key"], "norm").dropDuplicates(["key"]), "texts")
        star = members.where("key <> head").select(F.col("head").alias("u"), F.col("key").alias("v")).distinct()
        links = self.scratch.written(self.verified(self.scratch.written(self.estimated(star), "pairs")), "links")
        root = components(links, self.scratch)
        more = self.scratch.written(self.between(members, root), "links")
        if more.isEmpty():
            return root
        return components(root.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more), self.scratch)

    def between(self, members: DataFrame, root: DataFrame) -> DataFrame:
        """Links (u, v) between components within the buckets, all pairs but those with a head being looked at."""
        now = members.where("n > 2").join(root.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
        now = self.scratch.written(now, "rooted")
        shares = now.groupBy("band", "root").agg(F.count("*").alias("m"))
        open_ = shares.groupBy("band").agg(F.max(F.struct("m", "root")).alias("most"), F.sum("m").alias("all")).where("all > most.m")
        deal = lambda c: F.greatest(F.lit(1), F.ceil(c / F.lit(BLOCK))).cast("int")
        open_ = open_.select("band", F.col("most.root").alias("largest"), deal(F.col("all") - F.col("most.m")).alias("is"), deal(F.col("all")).alias("js"))
        # Written, so that both sides of the join are plain exchanges: the engine can split a large bucket.
        open_ = self.scratch.written(open_, "open")
        rows = now.join(open_, "band").withColumns({"outside": F.col("root") != F.col("largest"), "i": F.pmod(F.xxhash64("key", F.lit(1)), F.col("is")).cast("int"), "j": F.pmod(F.xxhash64("key"), F.col("js")).cast("int")})
        # Each block of the nodes outside meets each block of all nodes.
        places = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        right = F.transform(places("is"), lambda i: F.struct(i.alias("i"), F.col("j").alias("j")))
        left = F.transform(places("js"), lambda j: F.struct(F.col("i").alias("i"), j.alias("j")))
        at = F.explode(F.when(F.col("outside"), F.array_distinct(F.concat(left, right))).otherwise(right))
        on_left, on_right = F.col("at.i") == F.col("i"), F.col("at.j") == F.col("j")
        side = F.when(~F.col("outside"), LARGEST).when(on_left & on_right, BOTH).when(on_left, LEFT).otherwise(RIGHT)
        spread = rows.withColumn("at", at).select("band", "b", F.col("at.i").alias("i"), F.col("at.j").alias("j"), side.alias("side"), "key", "root", (F.col("key") == F.col("head")).alias("first"))
        sigs = self.nodes.select("key", "size", "sig", "bands")
        full = self.scratch.written(spread.join(sigs, "key").select("band", "b", "i", "j", "side", "key", "root", "first", "size", "sig", "bands"), "blocks")
        schema = "band long, i int, j int, u binary, v binary"
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = lambda df: df.repartition(n, "band", "i", "j").sortWithinPartitions("band", "i", "j")
        wanted = self.scratch.written(dealt(full).mapInArrow(tidy(_in_blocks(self.threshold, False)), schema).select("band", "i", "j", F.col("u").alias("key")), "wanted")
        some = full.join(wanted, ["band", "i", "j", "key"], "left_semi").join(self.texts, "key")
        some = some.select("band", "b", "i", "j", "side", "key", "root", "first", "size", "sig", "bands", "norm")
        return dealt(some).mapInArrow(tidy(_in_blocks(self.threshold, True)), schema).select("u", "v")


def near_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest doc_id of its class), class_size, kept, and __key."""
    job = NearDuplicates(docs, id_col, text_col, threshold)
    root = job.run().select(F.col("node").alias("key"), "root")
    rows = job.signed.select("doc", "key", "size")
    # Copies are counted by text first, so that no key's rows meet in one task.
    per_key = rows.where("size > 0").groupBy("key").agg(F.count("*").alias("n"), F.min("doc").alias("first"))
    per_key = per_key.join(root, "key", "left").withColumn("root", F.coalesce("root", "key"))
    per_class = per_key.groupBy("root").agg(F.sum("n").alias("class_size"), F.min("first").alias("class_id"))
    of = written(per_key.join(per_class, "root").select("key", "class_id", "class_size"), "classes")
    job.scratch.close()
    out = rows.join(of, "key", "left")
    lone = F.col("class_size").isNull()
    return out.select(
        F.col("doc").alias(id_col), F.when(lone, F.col("doc")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        (lone | F.col("doc").eqNullSafe(F.col("class_id"))).alias("kept"), F.col("key").alias("__key"),
    )


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that stay, with the columns of docs. Rows that repeat a doc_id with the same words are one document."""
    names = docs.columns
    # Clashing names step aside while the decision is made.
    held = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    own_id, own_text = f"__c{names.index(id_col)}", f"__c{names.index(text_col)}"
    classes = near_classes(held, id_col=own_id, text_col=own_text, threshold=threshold)
    drop = classes.where(~F.col("kept")).select(F.col(own_id).alias("__id"), "__key").distinct()
    same = F.col(own_id).eqNullSafe(F.col("__id")) & (F.unhex(F.md5(normal(own_text).cast("binary"))) == F.col("__key"))
    return held.join(drop, same, "left_anti").select(*[F.col(f"__c{i}").alias(n) for i, n in enumerate(names)])
