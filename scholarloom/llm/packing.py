"""Concatenate and cut: documents as one long token stream, cut every `window` tokens.

First pass: each partition tokenizes its documents and writes them with their offset inside the
partition. The partition totals, one number a partition, are summed up on the driver; the prefix
sums give every partition its global offset. Second pass: each document is cut where the windows
of the stream end; the records at a window's border are the only ones in two sequences. All
sequences but the last are full; the last is padded to `window` unless its length is a power of two.
The bases of the partitions, one number each, come to the documents by a broadcast join.

Defined cases: a null text counts as empty and is the end token alone; rows are never merged, so
repeated rows are packed twice; a null doc_id is carried; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, drop_path, fresh_path, tidy
from .hashing import Prints

WINDOW = 2048
#: Characters for which lower-casing, NFC and the classes of the two regex engines agree.
_PLAIN = regex.compile(r"[\x09-\x0d\x20-\x7eÀ-ÖØ-öø-įı-ɏ]*")
#: Bytes of such texts: 0 white space, 1 letters and digits, 2 other signs, 3 the apostrophe, which may belong to either side.
_KIND = np.ones(256, "u1")
_KIND[:128] = [0 if c in b" \t\n\x0b\x0c\r" else 3 if c == 39 else 1 if chr(c).isalnum() else 2 for c in range(128)]
#: The pre-tokenizer's pattern, as its file states it.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_CACHE, _KEPT = 300_000, 30_000
#: Characters that are tokenized at once.
_LOT = 1_000_000
#: Chunks of up to _SHORT bytes are their own keys; those over _LONG are never kept.
_SHORT, _LONG = 7, 256
_MASK = np.array([(1 << 8 * n) - 1 for n in range(_SHORT + 1)], np.uint64)
_loaded: dict[str, "ChunkTokens"] = {}


def words_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number."""
    return np.ndarray(max(0, len(data) - 7), "<u8", data, strides=(1,))[at]


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start .. start + size of each range, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


class ChunkTokens:
    """Token ids of a word-level BPE file.

    Texts are cut at white space and around signs, which no token crosses. Each distinct chunk is tokenized by the
    library once and kept in one flat array of ids; a text's ids are gathered from there. A short chunk is found by
    its own bytes, a longer one by a fingerprint and a comparison of all its bytes with the kept chunk's: one that
    differs, and any very long one, is tokenized by itself. Texts with unusual characters go to the library whole.
    """

    def __init__(self, path: str, cache: int | None = None):
        from tokenizers import Tokenizer

        self.most = cache or _CACHE
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(False)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.flat, self.used = np.zeros(1 << 19, "<u4"), 0
        self.text, self.filled = np.zeros(1 << 19, "u1"), 0
        # Of each kept chunk: where its ids start and their number, where its bytes start and their number, key, uses.
        self.start, self.size, self.at, self.bytes, self.keys, self.hits = (np.zeros(1 << 18, t) for t in ("i8", "i8", "i8", "i8", "u8", "i8"))

    def _thin(self, most: int) -> None:
        """Keep the chunks that came up most often, at most so many of them."""
        n = len(self.known)
        over = n - most
        least = max(2, int(np.partition(self.hits[:n], over)[over]) + 1) if over > 0 else 2
        keep = np.flatnonzero(self.hits[:n] >= least)
        keys, size, length = self.keys[keep], self.size[keep], self.bytes[keep]
        ids, text = self.flat[spread(self.start[keep], size)], self.text[spread(self.at[keep], length)]
        self._clear()
        self._keep(keys, ids, size, text, length)

    def _keep(self, keys: np.ndarray, ids: np.ndarray, size: np.ndarray, text: np.ndarray, length: np.ndarray) -> None:
        n, m = len(self.known), len(keys)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.r_[self.flat, np.zeros_like(self.flat)]
        while self.filled + len(text) > len(self.text):
            self.text = np.r_[self.text, np.zeros_like(self.text)]
        while n + m > len(self.start):
            self.start, self.size, self.at, self.bytes, self.keys, self.hits = (np.r_[x, np.zeros_like(x)] for x in (self.start, self.size, self.at, self.bytes, self.keys, self.hits))
        self.flat[self.used : self.used + len(ids)] = ids
        self.text[self.filled : self.filled + len(text)] = text
        own = slice(n, n + m)
        self.start[own], self.size[own] = self.used + np.cumsum(size) - size, size
        self.at[own], self.bytes[own], self.keys[own] = self.filled + np.cumsum(length) - length, length, keys
        self.used += len(ids)
        self.filled += len(text)
        self.known.update(zip(keys.tolist(), range(n, n + m), strict=True))

    def _tokenize(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their number for each chunk. Many chunks make one text; ids that end a word tell them apart."""
        words = np.fromiter(map(len, map(_WORD.findall, chunks)), "i8", len(chunks))
        flat, sizes = [], []
        for lo in range(0, len(chunks), 512):
            e = self.tokenizer.encode_batch_fast([" ".join(chunks[lo : lo + 512])], add_special_tokens=False)[0]
            ids, own = np.asarray(e.ids, "<u4"), words[lo : lo + 512]
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == own.sum() and own.all():
                flat.append(ids)
                sizes.append(np.diff(np.r_[0, cuts[np.cumsum(own) - 1]]))
            else:
                each = [np.asarray(x.ids, "<u4") for x in self.tokenizer.encode_batch(chunks[lo : lo + 512], add_special_tokens=False)]
                flat += each
                sizes.append(np.array([len(x) for x in each], "i8"))
        return np.concatenate(flat), np.concatenate(sizes)

    def _keys(self, data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The bytes of short chunks, and fingerprints with the top bit set for the others."""
        size = hi - lo
        long = np.flatnonzero(size > _SHORT)
        keys = words_at(data, lo) & _MASK[np.minimum(size, _SHORT)]
        keys[long] = Prints(data).of(lo[long], hi[long]) | np.uint64(1 << 63)
        return keys

    def _differing(self, data: np.ndarray, lo: np.ndarray, hi: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Numbers of the chunks that aren't byte for byte the ones kept at `place`; all have 8 bytes or more."""
        size, held = hi - lo, self.at[place]
        unlike = self.bytes[place] != size
        left, step = np.flatnonzero(~unlike), 0
        while len(left):
            at = np.minimum(step, size[left] - 8)  # the last word overlaps the one before
            same = words_at(data, lo[left] + at) == words_at(self.text, held[left] + at)
            unlike[left[~same]] = True
            step += 8
            left = left[same & (size[left] > step)]
        return np.flatnonzero(unlike)

    def _gathered(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of plain texts."""
        raw = [t.lower().encode() for t in texts]
        joined = b"\n".join(raw) + bytes(8)
        data = np.frombuffer(joined, "u1")
        first = np.cumsum([0, *(len(r) + 1 for r in raw)])
        kind = np.r_[np.uint8(0), _KIND[data[:-8]], np.uint8(0)]
        before, after = kind[:-1], kind[1:]
        # White space ends a chunk, and so does a change between letters or digits and other signs.
        edge = (before != after) & ((before == 0) | (after == 0) | (before + after == 3) & (before != 0) & (after != 0))
        lo, hi = np.flatnonzero(edge & (after != 0)), np.flatnonzero(edge & (before != 0))
        if not len(lo):
            return [np.empty(0, "<u4")] * len(texts)
        usual = hi - lo <= _LONG
        some = slice(None) if usual.all() else np.flatnonzero(usual)
        a, b = lo[some], hi[some]
        if len(self.known) > self.most:
            self._thin(self.most // 3)
        keys, at, inverse, times = np.unique(self._keys(data, a, b), return_index=True, return_inverse=True, return_counts=True)
        place = np.fromiter((self.known.get(k, -1) for k in keys.tolist()), "i8", len(keys))
        fresh = np.flatnonzero(place < 0)
        if len(fresh):
            x, y = a[at[fresh]], b[at[fresh]]
            ids, size = self._tokenize([joined[i:j].decode() for i, j in zip(x.tolist(), y.tolist(), strict=True)])
            place[fresh] = len(self.known) + np.arange(len(fresh))
            self._keep(keys[fresh], ids, size, data[spread(x, y - x)], y - x)
        self.hits[place] += times
        where, count = np.zeros(len(lo), "i8"), np.zeros(len(lo), "i8")
        chunk = place[inverse]
        where[some], count[some] = self.start[chunk], self.size[chunk]
        long = np.flatnonzero(b - a > _SHORT)
        unlike = long[self._differing(data, a[long], b[long], chunk[long])]
        alone = np.r_[np.flatnonzero(~usual), np.arange(len(lo))[some][unlike]]
        flat = self.flat
        if len(alone):
            ids, size = self._tokenize([joined[i:j].decode() for i, j in zip(lo[alone].tolist(), hi[alone].tolist(), strict=True)])
            where[alone], count[alone] = self.used + np.cumsum(size) - size, size
            flat = np.r_[flat[: self.used], ids]
        ids = flat[spread(where, count)]
        cuts = np.r_[0, np.cumsum(count)][np.searchsorted(lo, first)]
        return [ids[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [bool(_PLAIN.fullmatch(t)) and "<|" not in t for t in texts]
        easy = iter(self._gathered([t for t, p in zip(texts, plain, strict=True) if p]))
        odd = iter(self.tokenizer.encode_batch([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        return [next(easy) if p else np.asarray(next(odd).ids, "<u4") for p in plain]


def tokens_of(path: str, cache: int | None = None) -> ChunkTokens:
    """One for each Python worker and file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _loaded:
        _loaded[path] = ChunkTokens(path, cache)
    _loaded[path].most = cache or _CACHE
    return _loaded[path]


def forget() -> None:
    """Keep only the chunks that the tokenizers of this worker have met most often."""
    for x in _loaded.values():
        x._thin(_KEPT)


def lots(texts: list[str | None], most: int = _LOT) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of at most about `most` characters, with the number of the first."""
    lo, held, some = 0, 0, []
    for i, t in enumerate(texts):
        some.append(t or "")
        held += len(some[-1])
        if held >= most or i == len(texts) - 1:
            yield lo, some
            lo, held, some = i + 1, 0, []


def _tokenized(tokenizer_path: str, end_id: int, cache: int | None, lot: int):
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at, part = tokens_of(tokenizer_path, cache), 0, TaskContext.get().partitionId()
        for batch in batches:
            for lo, texts in lots(batch.column(1).to_pylist(), lot):
                some = batch.slice(lo, len(texts))
                ids = [x.tobytes() + end for x in own.encode(texts)]
                n = np.array([len(x) // 4 for x in ids], "i8")
                start = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(np.full(len(ids), part, "i4")), pa.array(start), pa.array(n), pa.array(ids, pa.binary())], ["doc_id", "part", "local", "n", "ids"])

    return run


def _cut(total: int, window: int):
    last = total // window if total % window else -1
    short = total % window
    padded_last = short if short & (short - 1) == 0 else window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(3).to_numpy()
            start = batch.column(2).to_numpy() + batch.column(1).to_numpy()
            pieces = (start + n - 1) // window - start // window + 1
            row = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            seq = start[row] // window + nth
            lo = np.maximum(start[row], seq * window)
            hi = np.minimum(start[row] + n[row], (seq + 1) * window)
            at, length = lo - start[row], hi - lo
            ids = batch.column(4)
            held = [memoryview(x.as_buffer()) for x in ids]
            crc = [zlib.crc32(held[r][4 * a : 4 * (a + k)]) for r, a, k in zip(row.tolist(), at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(at), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(seq), pa.array(lo - seq * window), pa.array(np.where(seq == last, padded_last, window))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length"],
            )

    return run


def pack(docs: DataFrame, tokenizer_path: str, *, window: int = WINDOW, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", cache: int | None = None, lot: int = _LOT) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length.

    cache: chunks that a worker keeps; lot: characters that it tokenizes at once. Less of both takes less memory and more time.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    path = fresh_path(spark, "tokens")
    rows.mapInArrow(tidy(_tokenized(tokenizer_path, end_id, cache, lot), forget), f"doc_id {kind}, part int, local long, n long, ids binary").write.parquet(path)
    held = spark.read.schema(f"doc_id {kind}, part int, local long, n long, ids binary").parquet(path)
    totals = sorted(held.groupBy("part").agg(F.max(F.col("local") + F.col("n"))).collect())  # one number a partition
    ends = list(accumulate((n for _, n in totals), initial=0))
    if not ends[-1]:
        drop_path(spark, path)
        held = spark.createDataFrame([], held.schema)
    bases = spark.createDataFrame([(p, base) for (p, _), base in zip(totals, ends, strict=False)], "part int, base long")
    placed = held.join(F.broadcast(bases), "part").select("doc_id", "base", "local", "n", "ids")
    return placed.mapInArrow(tidy(_cut(ends[-1], window)), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long")
