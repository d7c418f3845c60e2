"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

A batch of texts is cut into words that no piece of the vocabulary crosses; each distinct word is
encoded once. The words' characters lie in one flat array of symbol numbers. A round looks up the
rank of every adjacent pair, takes the smallest rank of each word by a segmented minimum, merges
all leftmost non-overlapping pairs of that rank in all words at once, and compacts the arrays,
until no pair is left. Merging equal pairs together is only done where no pair that arises has a
smaller rank; else that word merges its leftmost pair alone, so the order is always the library's.

Text without breaks is cut further where no piece of the vocabulary holds the two characters side by
side. A part that is still longer than LONG goes through the same rounds by itself, with links instead
of compaction and its pairs waiting by rank, so that a round costs what it changes and not the length.

Defined cases: a null text counts as empty and has no ids; repeated rows are encoded each; a null
doc_id is carried; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, tidy

SPACE = "▁"
#: Words that a worker keeps, and their characters with those of their ids and decoded forms.
_CACHE_WORDS, _CACHE_CHARS = 500_000, 32_000_000
_NONE = np.int32(2**31 - 1)
#: Words over CUT characters are cut between characters that no piece holds side by side; parts over LONG are merged by themselves.
CUT, LONG = 64, 1024
_loaded: dict[str, "PieceModel"] = {}


class PieceModel:
    """The vocabulary of a BPE model file with byte fallback and an identity normaliser."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        usual = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.bytes = np.full(256, -1, "i8")
        for i in range(n):
            if sp.is_byte(i):
                self.bytes[int(self.pieces[i][1:-1], 16)] = i
        self.byte_of = {int(i): b for b, i in enumerate(self.bytes)}
        self.skipped = {i for i in range(n) if sp.is_control(i)}
        self.unknown = sp.unk_id()
        self.special = self.skipped | {self.unknown}
        own = {self.pieces[i]: i for i in usual}
        # The order of merging: higher scores first; equal scores count as one rank.
        scores = np.array([sp.get_score(i) for i in usual])
        ranks = dict(zip(usual, np.unique(-scores, return_inverse=True)[1].tolist(), strict=True))
        # Symbols: the ids of pieces, then characters that are no piece.
        pairs = {}
        for text, i in own.items():
            for k in range(1, len(text)):
                a, b = own.get(text[:k]), own.get(text[k:])
                if a is not None and b is not None:
                    pairs[a * n + b] = (ranks[i], i)
                # A character that is no piece itself may still be half of one.
                elif (a is not None or k == 1) and (b is not None or k == len(text) - 1):
                    raise ValueError("a piece with a part that is no piece is not supported")
        self.n, self.own = n, own
        # Pairs in an open-addressing table: key, rank and merged symbol.
        self.slots = 1 << max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(self.slots, -1, "i8")
        self.ranks = np.full(self.slots, _NONE, "i4")
        self.made = np.full(self.slots, -1, "i4")
        for key, (rank, made) in pairs.items():
            at = self._slot(np.int64(key))
            while self.keys[at] >= 0:
                at = (at + 1) % self.slots
            self.keys[at], self.ranks[at], self.made[at] = key, rank, made
        self.text = [p.replace(SPACE, " ") for p in self.pieces]
        self.digits = [str(i) for i in range(n)]
        self.first = {text[k] + text[k + 1] for text in own for k in range(len(text) - 1)}
        self.beside = np.unique(np.array([ord(a) << 21 | ord(b) for a, b in self.first], "i8"))
        left = {c for c in map(lambda ab: ab[0], self.first)}
        if any(ab[1] == SPACE and ab[0] != SPACE for ab in self.first) or "\n" in left:
            raise ValueError("pieces cross word borders")
        self.cut = re.compile(f"{SPACE}+[^{SPACE}\\n]*|[^{SPACE}\\n]+|\\n")
        #: A word's ids joined by commas, their number, and what they decode to.
        self.words: dict[str, tuple[str, int, str]] = {}
        self.held = 0

    def _slot(self, key):
        return (key * 0x9E3779B1 >> 15) % self.slots

    def _ranked(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or _NONE) and merged symbol of pairs."""
        key = a.astype("i8") * self.n + b
        key[(a < 0) | (b < 0)] = -2
        at = self._slot(key)
        found = self.keys[at]
        rank, made = np.where(found == key, self.ranks[at], _NONE), self.made[at]
        left = np.flatnonzero((found != key) & (found >= 0) & (key >= 0))
        while len(left):
            at[left] = (at[left] + 1) % self.slots
            found = self.keys[at[left]]
            hit = found == key[left]
            rank[left[hit]], made[left[hit]] = self.ranks[at[left[hit]]], self.made[at[left[hit]]]
            left = left[~hit & (found >= 0)]
        return rank, made

    def parts_of(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """Words cut where no piece can lie across, and the word of each part."""
        parts, owner, done = [], [], 0
        for i in [i for i, w in enumerate(words) if len(w) > CUT]:
            parts += words[done:i]
            owner += range(done, i)
            w, done = words[i], i + 1
            code = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), "<u4").astype("i8")
            key = code[:-1] << 21 | code[1:]
            at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
            cuts = (np.flatnonzero(self.beside[at] != key) + 1).tolist()
            parts += [w[x:y] for x, y in zip([0, *cuts], [*cuts, len(w)], strict=True)]
            owner += [i] * (len(cuts) + 1)
        return parts + words[done:], np.array([*owner, *range(done, len(words))], "i4")

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat symbols (an id, or -1 - code point for a character that is no piece) and the word of each."""
        parts, owner = self.parts_of(words)
        lengths = np.fromiter(map(len, parts), "i8", len(parts))
        code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4").astype("i4")
        kinds, inverse = np.unique(code, return_inverse=True)
        sym = np.array([self.own.get(chr(c), -1 - int(c)) for c in kinds.tolist()], "i4")[inverse] if len(code) else code
        part = np.repeat(np.arange(len(parts), dtype="i4"), lengths)
        found = []
        if (lengths > LONG).any():
            ends = np.cumsum(lengths)
            for i in np.flatnonzero(lengths > LONG).tolist():
                own = self._merge_long(sym[ends[i] - lengths[i] : ends[i]].copy())
                found.append((own, np.full(len(own), i, "i4")))
            short = lengths[part] <= LONG
            sym, part = sym[short], part[short]
        found.append(self._merge_rounds(sym, part))
        sym, part = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(part, kind="stable")
        return sym[order], owner[part[order]]

    def _merge_long(self, sym: np.ndarray) -> np.ndarray:
        """The rounds of one long word. Places are linked to the next and the last one still there."""
        n = len(sym)
        after, before, there = np.arange(1, n + 1), np.arange(-1, n), np.ones(n, bool)
        rank, made = np.full(n, _NONE), np.full(n, -1, "i4")
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def look(places: np.ndarray) -> None:
            rank[places], made[places] = self._ranked(sym[places], sym[after[places]])

        def wait(places: np.ndarray) -> None:
            places = places[rank[places] < _NONE]
            if not len(places):
                return
            order = np.argsort(rank[places], kind="stable")
            kinds, first = np.unique(rank[places][order], return_index=True)
            for r, own in zip(kinds.tolist(), np.split(places[order], first[1:]), strict=True):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(own)

        def join(at: np.ndarray) -> np.ndarray:
            """Merges the pairs that start at these places; returns those that start a new pair."""
            gone = after[at]
            sym[at] = made[at]
            there[gone] = False
            after[at] = after[gone]
            before[after[at]] = at  # the place behind the end takes part, and is never read
            left = before[at]
            return np.unique(np.concatenate([left[left >= 0], at[after[at] < n]]))

        look(np.arange(n - 1))
        wait(np.arange(n - 1))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[there[at] & (rank[at] == r)]
            if not len(at):
                continue
            near = after[at[:-1]] == at[1:]
            chain = np.flatnonzero(np.r_[True, ~near])
            some = at[(np.arange(len(at)) - np.repeat(chain, np.diff(np.r_[chain, len(at)]))) % 2 == 0]
            gone, old = after[some], sym[some]
            new = join(some)
            ranks = self._ranked(sym[new], sym[after[new]])[0]
            if len(some) > 1 and (ranks <= r).any():  # an early pair arose: only the leftmost one is merged
                rest, lost = some[1:], gone[1:]
                sym[rest], there[lost] = old[1:], True
                for x, y in zip(rest[::-1].tolist(), lost[::-1].tolist(), strict=True):  # from the right, as the links stand
                    after[y] = after[x]
                    before[after[y]], before[y], after[x] = y, x, y
                new = np.array([x for x in (before[some[0]], some[0]) if x >= 0 and after[x] < n], "i8")
                waiting.setdefault(r, []).append(rest)
                if r not in heap:
                    heapq.heappush(heap, r)
            rank[some] = np.where(after[some] < n, rank[some], _NONE)
            rank[some[0]] = _NONE
            look(new)
            wait(new)
        return sym[there]

    def _merge_rounds(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rounds of all other words at once."""
        rank, made = np.full(len(sym), _NONE), np.full(len(sym), -1, "i4")
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner], made[inner] = self._ranked(sym[inner], sym[inner + 1])
        done_sym, done_word = [], []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[starts, len(sym)])
            least = np.minimum.reduceat(rank, starts)
            alive = least < _NONE
            if not alive.all():  # words without pairs leave
                stay = np.repeat(alive, size)
                done_sym.append(sym[~stay]), done_word.append(word[~stay])
                sym, word, rank, made = sym[stay], word[stay], rank[stay], made[stay]
                least, size = least[alive], size[alive]
                if not len(sym):
                    break
            bound = np.repeat(least, size)
            where = np.flatnonzero(rank == bound)
            near = np.diff(where) == 1
            if near.any():  # of overlapping candidates every second counts, from the left of its chain
                chain = np.flatnonzero(np.r_[True, ~near])
                place = np.arange(len(where)) - np.repeat(chain, np.diff(np.r_[chain, len(where)]))
                where = where[place % 2 == 0]
            merged = self._apply(sym, word, rank, made, where, bound)
            if merged[4] is not None:  # an early pair arose: those words merge their leftmost pair alone
                bad, of = merged[4], word[where]
                lone = np.r_[True, of[1:] != of[:-1]]
                merged = self._apply(sym, word, rank, made, where[lone | ~np.isin(of, bad)], bound)
            sym, word, rank, made = merged[:4]
        return np.concatenate([*done_sym, sym]), np.concatenate([*done_word, word])  # a word's symbols leave together and in order

    def _apply(self, sym, word, rank, made, where, bound):
        """Merge at where; the fifth result names words in which a pair arose that is not later than the one merged."""
        stay = np.ones(len(sym), bool)
        stay[where + 1] = False
        sym = sym.copy()
        sym[where] = made[where]
        limit = bound[where]
        sym, word, rank, made = sym[stay], word[stay], rank[stay], made[stay]
        at = where - np.arange(len(where))  # places after compaction
        rank[at] = _NONE
        right = at[at + 1 < len(sym)]
        right = right[word[right] == word[right + 1]]
        left = at[at > 0] - 1
        left = left[word[left] == word[left + 1]]
        spots = np.concatenate([left, right])
        rank[spots], made[spots] = self._ranked(sym[spots], sym[spots + 1])
        over = np.full(len(sym), -1, "i4")
        over[at] = limit
        early = (rank[right] <= over[right]) & (over[right] >= 0)
        early_left = (rank[left] <= over[left + 1]) & (over[left + 1] >= 0)
        bad = np.concatenate([word[right[early]], word[left[early_left]]])
        return sym, word, rank, made, bad if len(bad) else None

    def encode_words(self, words: list[str]) -> list[list[int]]:
        sym, word = self.merge(words)
        if (sym < 0).any():  # byte fallback
            parts, owners = [], []
            for s, w in zip(sym.tolist(), word.tolist(), strict=True):
                ids = [s] if s >= 0 else self.bytes[list(chr(-1 - s).encode("utf-8", "surrogatepass"))].tolist()
                parts += ids
                owners += [w] * len(ids)
            sym, word = np.array(parts, "i8"), np.array(owners, "i8")
        ends = np.searchsorted(word, np.arange(len(words)), "right")
        flat = sym.tolist()
        lo, out = 0, []
        for hi in ends.tolist():
            out.append(flat[lo:hi])
            lo = hi
        return out

    def words_of(self, text: str) -> list[str]:
        return self.cut.findall((SPACE + text).replace(" ", SPACE)) if text else []

    def learn(self, split: list[list[str]]) -> None:
        if len(self.words) > _CACHE_WORDS or self.held > _CACHE_CHARS:
            self.words.clear()
            self.held = 0
        fresh = list(set().union(*split).difference(self.words))
        digits, text, raw = self.digits, self.text, self.byte_of
        for w, ids in zip(fresh, self.encode_words(fresh) if fresh else [], strict=True):
            plain = raw.keys().isdisjoint(ids) and self.special.isdisjoint(ids)
            back = "".join([text[i] for i in ids]) if plain else self.decode(ids, False)
            joined = ",".join([digits[i] for i in ids])
            self.words[w] = joined, len(ids), back
            self.held += len(w) + len(joined) + len(back)

    def encode(self, text: str) -> list[int]:
        ws = self.words_of(text)
        self.learn([ws])
        return [int(i) for w in ws for i in self.words[w][0].split(",")]

    def decode_words(self, words: list[str]) -> str:
        """What decode gives for the words' ids in a row: no character's bytes lie in two words."""
        return self._trimmed([self.words[w][2] for w in words])

    @staticmethod
    def _trimmed(parts: list[str]) -> str:
        text = "".join(parts)
        return text[1:] if text.startswith(" ") else text

    def decode(self, ids: list[int], first: bool = True) -> str:
        """The text of ids: bytes join to characters, broken ones become U+FFFD; of the first piece the leading space goes."""
        out, raw = [], bytearray()

        def flush() -> None:
            while raw:
                head, size = raw[0], 1
                size = 1 if head < 0x80 else 2 if 0xC2 <= head < 0xE0 else 3 if 0xE0 <= head < 0xF0 else 4 if 0xF0 <= head < 0xF5 else 0
                try:
                    out.append(bytes(raw[:size]).decode() if size and len(raw) >= size else "�")
                    step = size if size and len(raw) >= size else 1
                except UnicodeDecodeError:
                    out.append("�")
                    step = 1
                del raw[:step]

        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                first = False
                continue
            flush()
            if i in self.skipped:
                continue
            piece = " ⁇ " if i == self.unknown else self.pieces[i].replace(SPACE, " ")
            if first and piece.startswith(" ") and i != self.unknown:
                piece = piece[1:]
            first = False
            out.append(piece)
        flush()
        return "".join(out)


def model_of(path: str) -> PieceModel:
    """One for each Python worker and file."""
    if path not in _loaded:
        _loaded[path] = PieceModel(path)
    return _loaded[path]


def forget() -> None:
    """Drop what this worker has kept of its texts' words."""
    for m in _loaded.values():
        m.words.clear()
        m.held = 0


def _report(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(model_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                split = [m.words_of(t or "") for t in some.column(1).to_pylist()]
                m.learn(split)
                count, joined, back = [], [], []
                for ws in split:
                    ids, ns, texts = zip(*map(m.words.__getitem__, ws), strict=True) if ws else ((), (), ())
                    count.append(sum(ns))
                    joined.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
                    back.append(hashlib.sha256(m._trimmed(texts).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(count, pa.int64()), pa.array(joined), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_report(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    bound_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(_report(model_path), forget), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
