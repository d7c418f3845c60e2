"""Removal of repeated byte strings by prefix doubling over sampled suffixes.

Every byte covered by a string of `length` bytes that also starts elsewhere is removed. Ranking all
byte positions would shuffle many times the input a round, so suffixes are sampled: of the
length - GRAM + 1 strings of GRAM bytes that start in a window of `length` bytes, the one with the
smallest hash is the window's anchor. Equal windows have equal anchors at equal places, so only
windows whose anchors agree can be equal. Anchors start with the rank of their first GRAM bytes, and
unique ranks leave. Each round pairs a rank with that of the string which follows at the present
offset, ranks the pairs anew (equal pairs, equal rank) and drops what has become unique; offsets
double until twice the offset is past the threshold. A rank is a 64-bit fingerprint instead of an
ordinal number, so a round needs a count of each pair and no total order; the rank at the offset, where
mostly no anchor stands, is taken from the text, for all rounds in one pass. What length a unique one
had reached bounds which of its windows can still repeat. Past the threshold, an anchor's windows as a
whole (one string) are ranked by a 128-bit digest; a repeated one is settled. What is left are anchors
near the ends of repeats: their few hundred bytes of context meet by rank and each window is compared
by a 128-bit fingerprint.

Documents are first written as shards to the shared folder; later passes stream a shard beside the
sorted rows that belong to it, so texts are never shuffled. Copies of a whole text are represented
by one of them. Groups of more than GROUP contexts are compared as single (window, fingerprint) rows.

Defined cases: a null text is empty; texts shorter than `length` bytes lose nothing; a text that is
a copy of another of at least `length` bytes loses everything, repeated rows too; a null doc_id is
carried; an empty table gives an empty result; extra columns are carried by `remove_repeats`.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bound_batches, drop_path, fresh_path, tidy, written
from .hashing import BASE, Prints, mix
from .warc import open_store

LENGTH, GRAM = 200, 48
SHARD_BYTES = 48 << 20
CHUNK_BYTES = 1 << 19
#: Contexts of one rank that are compared in one task; more go by single windows.
GROUP = 4_000
#: Contexts whose windows are compared at once; of more only some distances at a time.
SETTLED = 1_000

def leftmost_minimum(h: np.ndarray, w: int) -> np.ndarray:
    """For each p the place of the smallest of h[p : p + w], the leftmost of equal ones by their upper 38 bits."""
    n = len(h)
    v = (h & ~np.uint64((1 << 26) - 1)) | np.arange(n, dtype=np.uint64)
    pad = -n % w
    full = np.concatenate([v, np.full(pad + w, np.uint64(2**64 - 1))])
    rows = full[: n + pad].reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - w + 1
    least = np.minimum(behind[:count], ahead[w - 1 : w - 1 + count])
    return (least & np.uint64((1 << 26) - 1)).astype("i8")


def anchors(data: np.ndarray, starts: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Anchors of documents laid end to end: (document, place in it, low and high distance to its windows' starts, rank of its first k bytes).

    starts: offsets of the documents and the end.
    """
    none = np.empty(0, "i8")
    if len(data) < length:
        return none, none, none, none, none.view(np.uint64)
    w = length - k + 1
    h = Prints(data).grams(k)
    at = leftmost_minimum(h, w)[: len(data) - length + 1]
    size = np.diff(starts)
    doc = np.repeat(np.arange(len(size)), size)[: len(at)]
    p = np.arange(len(at))
    good = p + length <= starts[doc + 1]
    p, at, doc = p[good], at[good], doc[good]
    if not len(p):
        return none, none, none, none, none.view(np.uint64)
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])])
    last = np.r_[first[1:], len(p)] - 1
    a = at[first]
    return doc[first], a - starts[doc[first]], a - p[last], a - p[first], h[a]


# Shards: Parquet files of whole rows in the shared folder.


def _shard_writer(folder: str, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        writer, name, n, held, roll, part = None, "", 0, 0, -1, TaskContext.get().partitionId()
        try:
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    some = batch.slice(lo, 256)
                    texts = some.column(text_at).to_pylist()
                    if writer is None or held >= SHARD_BYTES:
                        if writer is not None:
                            writer.close()
                        name, n, held, roll = f"shard-{uuid.uuid4().hex}.parquet", 0, 0, roll + 1
                        writer = pq.ParquetWriter(f"{base}/{name}", some.schema, filesystem=store, compression="zstd", compression_level=1)
                    writer.write_batch(some)
                    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * len(raw), pa.int32()), pa.array([roll] * len(raw), pa.int32()), pa.array([name] * len(raw)), pa.array(range(n, n + len(raw)), pa.int32()), pa.array([hashlib.sha256(r).digest() for r in raw], pa.binary()), pa.array([len(r) for r in raw], pa.int64())],
                        ["part", "roll", "name", "ord", "digest", "bytes"],
                    )
                    n, held = n + len(raw), held + sum(map(len, raw))
        finally:
            if writer is not None:
                writer.close()

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            yield from zip(*(c.to_pylist() for c in batch.slice(lo, 1000).columns), strict=True)


def _beside(folder: str, batches: Iterator[pa.RecordBatch], rows_at: int = 256) -> Iterator[tuple[int, int, pa.RecordBatch, dict[int, list[tuple]]]]:
    """(shard, first row number, rows of the shard, ord to the sorted rows that belong to it).

    batches are sorted by shard and ord; a row with ord -1 stands first for each shard and holds its file's name.
    """
    store, base = open_store(folder)
    rows = _rows(batches)
    row = next(rows, None)
    while row is not None:
        shard, name, n = row[0], row[2], 0
        row = next(rows, None)
        with store.open_input_file(f"{base}/{name}") as f:
            for some in pq.ParquetFile(f).iter_batches(batch_size=rows_at):
                own: dict[int, list[tuple]] = {}
                while row is not None and row[0] == shard and row[1] < n + some.num_rows:
                    if row[1] >= 0:
                        own.setdefault(row[1], []).append(row[3:])
                    row = next(rows, None)
                yield shard, n, some, own
                n += some.num_rows


def _bytes(some: pa.RecordBatch, at: int) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in some.column(at).to_pylist()]


def _laid(texts: list[bytes]) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
    """Texts end to end in chunks: (number of the first, texts, bytes, offsets)."""
    lo = 0
    while lo < len(texts):
        hi, held = lo, 0
        while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= CHUNK_BYTES):
            held += len(texts[hi])
            hi += 1
        some = texts[lo:hi]
        yield lo, some, np.frombuffer(b"".join(some), "u1"), np.r_[0, np.cumsum([len(t) for t in some])]
        lo = hi


def _segments(text: bytes, length: int, most: int = 1 << 21) -> Iterator[tuple[int, bytes]]:
    """A very long text in overlapping parts that share length - 1 bytes."""
    if len(text) <= most:
        yield 0, text
        return
    for lo in range(0, len(text) - length + 1, most - length + 1):
        yield lo, text[lo : lo + most]


def _anchor_pass(folder: str, text_at: int, length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, n, some, own in _beside(folder, batches):
            texts = [t if i + n not in own and len(t) >= length else b"" for i, t in enumerate(_bytes(some, text_at))]
            parts, owner, shift = [], [], []
            for i, t in enumerate(texts):
                for lo, part in _segments(t, length):
                    parts.append(part), owner.append(i + n), shift.append(lo)
            for first, held, data, offsets in _laid(parts):
                doc, place, near, far, rank = anchors(data, offsets, length, k)
                if not len(doc):
                    continue
                ords = np.array(owner[first : first + len(held)], "i8")[doc]
                place = place + np.array(shift[first : first + len(held)], "i8")[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rank.view("i8")), pa.array(np.int64(shard) << 32 | ords), pa.array(place << 16 | near << 8 | far)], ["rank", "loc", "span"]
                )

    return run


def _rank_pass(folder: str, text_at: int, length: int, offsets_at: list[int]):
    """Sorted (shard, ord, rank, span) to the ranks at each offset, of as many bytes, and a digest of all the anchor's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, n, some, own in _beside(folder, batches):
            if not own:
                continue
            raw = _bytes(some, text_at)
            parts: list[tuple[int, int, list[tuple]]] = []  # of a long text only what its anchors need
            for i in sorted(own):
                for rank, span in sorted(own[i], key=lambda x: x[1]):
                    a = span >> 16
                    if not parts or parts[-1][0] != i or a - parts[-1][1] > 1 << 20:
                        parts.append((i, a - (span & 255), []))
                    parts[-1][2].append((rank, span))
            reach = max(length, 2 * offsets_at[-1])
            texts = [raw[i - n][lo : (rows[-1][1] >> 16) + reach] for i, lo, rows in parts]
            for first, held, data, offsets in _laid(texts):
                now = parts[first : first + len(held)]
                count = [len(rows) for _, _, rows in now]
                rank = np.array([r for _, _, rows in now for r, _ in rows], "i8")
                span = np.array([s for _, _, rows in now for _, s in rows], "i8")
                base = np.repeat(offsets[:-1] - np.array([lo for _, lo, _ in now], "i8"), count)
                end = base + np.repeat(np.array([len(raw[i - n]) for i, _, _ in now], "i8"), count)
                a, near, far = base + (span >> 16), span >> 8 & 255, span & 255
                p = Prints(data)
                nexts = []
                for h in offsets_at:
                    fits = a + 2 * h <= end
                    value = p.of(np.where(fits, a + h, 0), np.where(fits, a + 2 * h, 0)).view("i8")
                    nexts.append(pa.array(value, mask=~fits))
                laid = data.tobytes()
                whole = [hashlib.blake2b(laid[x:y], digest_size=16).digest() for x, y in zip((a - far).tolist(), (a - near + length).tolist(), strict=True)]
                loc = np.int64(shard) << 32 | np.repeat(np.array([i for i, _, _ in now], "i8"), count)
                yield pa.RecordBatch.from_arrays([pa.array(rank), pa.array(loc), pa.array(span), *nexts, pa.array(whole, pa.binary())], ["rank", "loc", "span", *(f"next{h}" for h in offsets_at), "whole"])

    return run


def _context_pass(folder: str, text_at: int, length: int):
    """Sorted (shard, ord, rank, span, active) to the bytes of the anchor's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, n, some, own in _beside(folder, batches):
            if not own:
                continue
            raw = _bytes(some, text_at)
            out: list[tuple] = []
            for i in sorted(own):
                for rank, span, active, big in own[i]:
                    a, near, far = span >> 16, span >> 8 & 255, span & 255
                    out.append((rank, shard << 32 | i, span, active, big, raw[i - n][a - far : a - near + length]))
            cols = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["rank", "loc", "span", "active", "big", "bytes"])

    return run


def window_prints(rows: list[tuple], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows (rank, loc, span, active, bytes) to (row, distance, two fingerprints) of each window; rank and distance are part of them."""
    span = np.array([r[2] for r in rows], "i8")
    near, far = span >> 8 & 255, span & 255
    size = np.array([len(r[4]) for r in rows], "i8")
    base = np.cumsum(size) - size
    count = far - near + 1
    row = np.repeat(np.arange(len(rows)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    lo = base[row] + nth
    distance = far[row] - nth
    data = np.frombuffer(b"".join(r[4] for r in rows), "u1")
    tag = mix(np.array([r[0] for r in rows], "i8").view(np.uint64)[row] + distance.astype(np.uint64) * BASE[1])
    return row, distance, mix(Prints(data, 0).of(lo, lo + length) ^ tag), mix(Prints(data, 1).of(lo, lo + length) + tag)


def _runs(rows: list[tuple], row: np.ndarray, distance: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Windows (a row's, by falling distance) to maximal runs (loc, first start, last start)."""
    if not len(row):
        return
    a = np.array([r[2] >> 16 for r in rows], "i8")[row] - distance
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (a[1:] != a[:-1] + 1)])
    last = np.r_[new[1:], len(a)] - 1
    for i, j in zip(new.tolist(), last.tolist(), strict=True):
        yield rows[row[i]][1], int(a[i]), int(a[j])


def _starts(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*found, strict=True)) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["loc", "lo", "hi"])


def clipped(rows: list[tuple], lo: int, hi: int) -> list[tuple]:
    """Rows (rank, loc, span, active, bytes) with their windows at distances lo to hi only."""
    out = []
    for rank, loc, span, active, data in rows:
        near, far = span >> 8 & 255, span & 255
        a, b = max(near, lo), min(far, hi)
        if a <= b:
            out.append((rank, loc, span >> 16 << 16 | a << 8 | b, active, data[far - b : len(data) - (a - near)]))
    return out


def _compare(length: int):
    """Contexts sorted by rank to the repeated starts of the active ones. Only windows at the same distance can be equal, so many contexts are compared distance by distance."""

    def settle(rows: list[tuple]) -> list[tuple[int, int, int]]:
        if len(rows) <= SETTLED:
            return settled(rows)
        width = max(1, 256 * SETTLED // len(rows))
        return [x for lo in range(0, 256, width) if (some := clipped(rows, lo, lo + width - 1)) for x in settled(some)]

    def settled(rows: list[tuple]) -> list[tuple[int, int, int]]:
        row, distance, one, two = window_prints(rows, length)
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        twice = np.zeros(len(row), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        twice &= np.array([r[3] for r in rows])[row]
        return list(_runs(rows, row[twice], distance[twice]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for rank, loc, span, active, data in _rows(batches):
            if rank != last and len(held) > SETTLED:
                yield _starts(settle(held))
                held = []
            held.append((rank, loc, span, active, data))
            last = rank
        if held:
            yield _starts(settle(held))

    return run


def _single_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                rows = list(_rows([batch.slice(lo, 2000)]))
                row, distance, one, two = window_prints(rows, length)
                a = np.array([r[2] >> 16 for r in rows], "i8")[row] - distance
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view("i8")), pa.array(two.view("i8")), pa.array(np.array([r[1] for r in rows], "i8")[row]), pa.array(a), pa.array(np.array([r[3] for r in rows])[row])],
                    ["one", "two", "loc", "lo", "active"],
                )

    return run


class Repeats:
    """The passes over one table; `starts` are the repeated strings found, `gone` the copies of whole texts."""

    def __init__(self, docs: DataFrame, text_col: str, length: int = LENGTH, gram: int = GRAM):
        if not gram <= length <= gram + 255:
            raise ValueError(f"length must be {gram} to {gram + 255}: the places of an anchor in its windows take one byte")
        self.spark, self.docs, self.length, self.k = docs.sparkSession, docs, length, gram
        self.scratch = Scratch(self.spark, "repeats")
        bound_batches(self.spark)
        self.text_at = docs.columns.index(text_col)
        self.folder = fresh_path(self.spark, "shards")
        store, base = open_store(self.folder)
        store.create_dir(base, recursive=True)
        held = written(docs.mapInArrow(tidy(_shard_writer(self.folder, self.text_at)), "part int, roll int, name string, ord int, digest binary, bytes long"), "shard-rows")
        parts, rolls = held.agg(F.coalesce(F.max("part"), F.lit(-1)) + 1, F.coalesce(F.max("roll"), F.lit(0)) + 1).first()
        self.shards = parts * rolls
        held = held.withColumn("shard", F.col("part") * rolls + F.col("roll"))
        self.rows = held.select("shard", "ord", "digest", "bytes")
        self.files = held.where("ord = 0").select("shard", F.lit(-1).alias("ord"), "name")

    def beside(self, rows: DataFrame | None, run, schema: str) -> DataFrame:
        """run over all shards, each with its rows (shard, ord, ...)."""
        fields = rows.schema.fields[2:] if rows is not None else []
        first = self.files.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
        every = first if rows is None else first.unionByName(rows.select("shard", "ord", F.lit(None).cast("string").alias("name"), *[f.name for f in fields]))
        return every.repartitionById(max(1, self.shards), F.col("shard")).sortWithinPartitions("shard", "ord").mapInArrow(tidy(run), schema)

    @staticmethod
    def _placed(rows: DataFrame, *cols: str) -> DataFrame:
        return rows.select(F.shiftright("loc", 32).cast("int").alias("shard"), F.col("loc").bitwiseAND(2**32 - 1).cast("int").alias("ord"), *cols)

    def copies(self) -> tuple[DataFrame, DataFrame]:
        """Places of copies of whole texts, and of those that represent none. Texts under the length take no part."""
        long = self.rows.where(F.col("bytes") >= self.length)
        firsts = long.groupBy("digest").agg(F.min(F.struct("shard", "ord")).alias("best"), F.count("*").alias("n")).where("n > 1")
        firsts = self.scratch.written(firsts.select("digest", "best"), "copies")
        gone = self.scratch.written(long.join(firsts, "digest").select("shard", "ord", ((F.col("shard") == F.col("best.shard")) & (F.col("ord") == F.col("best.ord"))).alias("first")), "gone")
        return gone, gone.where(~F.col("first")).select("shard", "ord")

    def find(self) -> DataFrame:
        """(loc, lo, hi): every string of the length that starts in lo..hi of a document is repeated."""
        length, k, written = self.length, self.k, self.scratch.written
        self.gone, skip = self.copies()
        # Round 0.
        path = fresh_path(self.spark, "anchors")
        self.beside(skip, _anchor_pass(self.folder, self.text_at, length, k), "rank long, loc long, span long").write.parquet(path)
        found = self.spark.read.schema("rank long, loc long, span long").parquet(path)
        again = written(found.groupBy("rank").agg(F.count("*").alias("n")).where("n > 1").select("rank"), "ranks")
        alive = written(found.join(again, "rank").select("rank", "loc", "span"), "alive")
        drop_path(self.spark, path)
        # The ranks at the next offsets, for those alone.
        offsets = [k]
        while 4 * offsets[-1] <= length:
            offsets.append(2 * offsets[-1])
        ranked = self.beside(
            self._placed(alive, "rank", "span"), _rank_pass(self.folder, self.text_at, length, offsets),
            f"rank long, loc long, span long, {', '.join(f'next{h} long' for h in offsets)}, whole binary",
        )
        rows = written(ranked.withColumns({"now": F.col("rank"), "reach": F.lit(2 * k - 1)}), "ranked")
        for h in offsets:
            # Pairs (rank, rank at the offset) of those still alive; a unique one, or one whose text ends, has reached less than twice the offset.
            going = F.col("now").isNotNull() & F.col(f"next{h}").isNotNull()
            rows = rows.withColumn("now", F.when(going, F.xxhash64("now", f"next{h}")))
            again = rows.where("now is not null").groupBy("now").agg(F.count("*").alias("n")).where("n > 1")
            again = written(again.select("now", F.lit(True).alias("goes_on")), "round")
            rows = rows.join(again, "now", "left").withColumn("reach", F.when(F.col("goes_on"), length if h == offsets[-1] else 4 * h - 1).otherwise(F.col("reach")))
            rows = rows.withColumn("now", F.when(F.col("goes_on"), F.col("now"))).drop("goes_on", f"next{h}")
            rows = written(rows, "ranked") if h != offsets[-1] else rows
        # A window at distance d needs length - d bytes from the anchor on.
        near = F.shiftright("span", 8).bitwiseAND(255)
        far = F.col("span").bitwiseAND(255)
        rows = rows.select("rank", "loc", "span", "whole", F.greatest(near, F.lit(length) - F.col("reach")).alias("low"), far.alias("far"), near.alias("near"))
        # Past the threshold: all windows of an anchor as one string.
        shape = F.col("span").bitwiseAND(65535)
        rows = written(rows.withColumn("shape", shape), "reached")
        wholes = written(rows.groupBy("rank", "whole", "shape").agg(F.count("*").alias("n"), F.min(F.struct("loc", "span")).alias("best")).where("n > 1"), "wholes")
        same = rows.join(wholes.select("rank", "whole", "shape", "best"), ["rank", "whole", "shape"], "left")
        same = written(same, "same")
        a = F.shiftright("span", 16)
        settled = same.where("best is not null").select("loc", (a - F.col("far")).alias("lo"), (a - F.col("near")).alias("hi"))
        first = (F.col("loc") == F.col("best.loc")) & (F.col("span") == F.col("best.span"))
        left = same.where(F.col("best").isNull() | first).where("low <= far").withColumn("active", F.col("best").isNull())
        # Ranks with something to settle and something to compare it with.
        some = left.groupBy("rank").agg(F.count("*").alias("n"), F.max("active").alias("any")).where("n > 1 and any")
        some = written(some.select("rank", (F.col("n") > GROUP).alias("big")), "open")
        trimmed = F.shiftleft(a, 16).bitwiseOR(F.shiftleft("low", 8)).bitwiseOR(F.col("far"))
        todo = left.join(some, "rank").select("loc", "rank", trimmed.alias("span"), "active", "big")
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        context = self.beside(self._placed(todo, "rank", "span", "active", "big"), _context_pass(self.folder, self.text_at, length), "rank long, loc long, span long, active boolean, big boolean, bytes binary")
        context = written(context, "contexts")
        usual = context.where(~F.col("big")).drop("big").repartition(n, "rank").sortWithinPartitions("rank").mapInArrow(tidy(_compare(length)), "loc long, lo long, hi long")
        starts = settled.unionByName(usual)
        if not context.where("big").limit(1).isEmpty():
            single = written(context.where("big").drop("big").mapInArrow(_single_windows(length), "one long, two long, loc long, lo long, active boolean"), "windows")
            more = written(single.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "window-ranks")
            starts = starts.unionByName(single.where("active").join(more, ["one", "two"]).select("loc", "lo", F.col("lo").alias("hi")))
        return starts

    def cut(self, run, schema: str) -> DataFrame:
        """run over all shards beside the removed runs (ord, lo, hi); hi -1 is a whole text."""
        starts = self._placed(self.find(), F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"))
        gone = self.gone.select("shard", "ord", F.lit(0).cast("long").alias("lo"), F.lit(-1).cast("long").alias("hi"))
        removed = written(starts.unionByName(gone), "removed")
        self.scratch.close()
        return self.beside(removed, run, schema)


def removed_runs(rows: list[tuple[int, int]], n: int, length: int) -> list[tuple[int, int]]:
    """Merged (from, to) of the starts' strings."""
    out: list[list[int]] = []
    for lo, hi in sorted(rows):
        to = n if hi < 0 else hi + length
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], to)
        else:
            out.append([lo, to])
    return [tuple(x) for x in out]


def _kept(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    if not runs:
        return text
    edges = [0, *(x for r in runs for x in r), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def repeat_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    kind = dict(docs.dtypes)[id_col]
    job = Repeats(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), "text", length)
    folder = job.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, n, some, own in _beside(folder, batches):
            size, removed, spans, digest = [], [], [], []
            for i, t in enumerate(_bytes(some, 1)):
                runs = removed_runs(own.get(i + n, []), len(t), length)
                size.append(len(t)), removed.append(sum(b - a for a, b in runs)), spans.append(len(runs))
                digest.append(hashlib.sha256(_kept(t, runs)).hexdigest())
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return job.cut(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, *, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """docs with the repeated bytes taken out of the text; characters of which only a part stays go too."""
    job = Repeats(docs, text_col, length)
    folder, at = job.folder, job.text_at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, n, some, own in _beside(folder, batches):
            texts = some.column(at).to_pylist()
            for i, t in enumerate(texts):
                if i + n in own:
                    raw = (t or "").encode("utf-8", "surrogatepass")
                    texts[i] = _kept(raw, removed_runs(own[i + n], len(raw), length)).decode("utf-8", "ignore")
            columns = [pa.array(texts, pa.string()) if c == at else some.column(c) for c in range(some.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, some.schema.names)

    return job.cut(run, docs.schema)
