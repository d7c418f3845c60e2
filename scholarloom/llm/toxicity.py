"""Toxicity by a weighted finite-state grammar over clauses.

Two transducers are composed. The lexical one is a trie over letters: it reads a word and emits
its class with a weight (insult, threat, target, negation, reported speech). The clause one reads
these classes: its state holds whether a negation is near, whether the clause reports speech and
whether it names a target, and each matched insult or threat is emitted in the mode of its state.
A clause's score is the weighted sum of what it emits; a document is scored by its clauses.

Insults are learned from labels: whole words and word stems whose share among toxic documents is
higher beyond chance (log-likelihood ratio), besides a short seed list. How much each mode counts
is a logistic fit with a Gaussian prior at the grammar's hand-set weights. Both use a sample of at
most `max_train` labelled rows, those with the smallest hash of doc_id; rows with
crc32(doc_id as text) mod 3 = 1 are never learned from. Only the text enters a score. Bounds of the fit
besides `max_train`: of the words and stems with the wanted odds the `max_candidates` in the most toxic
rows are tested, and the best `max_lexicon` of them become entries.

Defined cases: null or empty texts get the score of a text without matches; labels that are null
or of unknown documents are ignored, of several labels for a document the largest counts; without
usable labels the seed list and the prior stand; of several rows with a labelled doc_id the one whose
text has the smallest hash is learned from; labelled rows with the same hash of doc_id are taken by doc_id;
a null doc_id is not held out; repeated rows are scored each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bound_batches, tidy

MAX_TRAIN = 20_000
MAX_CANDIDATES, MAX_LEXICON = 200_000, 4_000
#: A feature needs this log-likelihood ratio (two-sided chance about 3e-6), documents and log odds.
LEAST_G2, LEAST_DOCS, LEAST_ODDS = 22.0, 3, 2.0
STEMS = range(3, 9)

# Seed words of each class.
INSULTS = "idiot moron stupid worthless pathetic loser scum trash clown disgusting".split()
THREATS = "kill hurt destroy burn beat punch stab shoot attack murder".split()
TARGETS = "you your yours he she they them his her their du ihr tu vous vosotros".split()
NEGATIONS = "not no never nobody nothing neither without isn aren wasn don doesn didn".split()
REPORTS = "said says say told claimed wrote quoted called reported according".split()

I, T, Y, N, R = range(5)
#: Modes of a match: plain, with a target, negated, in reported speech, a threat at a target.
MODES = ("plain", "targeted", "negated", "reported", "threat")
PRIOR = np.array([-4.0, 1.3, 1.5, 0.6, 0.6, 1.0, 0.5])  # bias, the modes, the best clause
SEED_WEIGHT = 4.0
NEAR = 3

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
_WORD = re.compile(r"[^\W\d_]+")


class Lexicon:
    """The lexical transducer. entries: word or stem to (is a whole word, class, weight)."""

    def __init__(self, entries: dict[str, tuple[bool, int, float]]):
        self.trie: dict = {}
        for text, (whole, kind, weight) in entries.items():
            node = self.trie
            for c in text:
                node = node.setdefault(c, {})
            node["="[:whole] or "*"] = (kind, weight)
        self.cache: dict[str, tuple[int, float] | None] = {}

    def read(self, word: str) -> tuple[int, float] | None:
        """What the word emits: a whole-word arc first, then the longest stem's."""
        if word in self.cache:
            return self.cache[word]
        node, best = self.trie, None
        for c in word:
            node = node.get(c)
            if node is None:
                break
            best = node.get("*", best)
        else:
            best = node.get("=", best)
        if len(self.cache) > 100_000:
            self.cache.clear()
        self.cache[word] = best
        return best


def clause_emissions(classes: list[tuple[int, int, float]]) -> list[tuple[int, float]]:
    """The clause transducer: (place, class, weight) of a clause's words to (mode, weight)."""
    reported = any(k == R for _, k, _ in classes)
    target = any(k == Y for _, k, _ in classes)
    negated_until, out = -1, []
    for place, kind, weight in classes:
        if kind == N:
            negated_until = place + NEAR
        elif kind in (I, T):
            if place <= negated_until:
                mode = 2
            elif reported:
                mode = 3
            elif kind == T:
                if not target:
                    continue  # a threat verb without a target is ordinary prose
                mode = 4
            else:
                mode = 1 if target else 0
            out.append((mode, weight))
    return out


def features(lexicon: Lexicon, text: str | None) -> np.ndarray:
    """1, log1p of the summed weights of each mode, and the heaviest clause."""
    x = np.zeros(len(PRIOR))
    x[0] = 1
    if not text:
        return x
    tokens = _TOKEN.findall(text.lower())
    read = lexicon.read
    found = [(i, c) for i, w in enumerate(tokens) if (c := read(w))]
    if not any(c[0] in (I, T) for _, c in found):
        return x
    ends = [i for i, w in enumerate(tokens) if len(w) == 1 and w in ".!?;:\n"]
    at, clause, best = 0, [], 0.0
    sums = np.zeros(len(MODES))

    def close() -> None:
        nonlocal best
        if clause:
            emitted = clause_emissions(clause)
            for mode, weight in emitted:
                sums[mode] += weight
            best = max(best, sum(w for m, w in emitted if m not in (2, 3)))
            clause.clear()

    for i, (kind, weight) in found:
        while at < len(ends) and ends[at] < i:
            close()
            at += 1
        clause.append((i, kind, weight))
    close()
    x[1:-1] = np.log1p(sums)
    x[-1] = math.log1p(best)
    return x


class Model:
    def __init__(self, entries: dict[str, tuple[bool, int, float]], weights: np.ndarray):
        self.entries, self.weights, self.lexicon = entries, weights, None

    def __getstate__(self):
        return self.entries, self.weights

    def __setstate__(self, state):
        self.entries, self.weights = state
        self.lexicon = None

    def score(self, text: str | None) -> float:
        self.lexicon = self.lexicon or Lexicon(self.entries)
        z = float(features(self.lexicon, text) @ self.weights)
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def seed_entries() -> dict[str, tuple[bool, int, float]]:
    kinds = ((INSULTS, I, SEED_WEIGHT), (THREATS, T, SEED_WEIGHT), (TARGETS, Y, 0.0), (NEGATIONS, N, 0.0), (REPORTS, R, 0.0))
    return {w: (True, k, x) for words, k, x in kinds for w in words}


def word_features(text: str) -> set[str]:
    """Whole words, as =word, and stems."""
    words = set(_WORD.findall(text.lower()))
    return {"=" + w for w in words} | {w[:k] for w in words for k in STEMS if len(w) >= k}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a feature, in part sums of bounded size."""
    hits = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        names = list(hits[1].keys() | hits[0].keys())
        out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([hits[1][f] for f in names], pa.int64()), pa.array([hits[0][f] for f in names], pa.int64())], ["feature", "toxic", "clean"])
        hits[0].clear(), hits[1].clear()
        return out

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
            hits[toxic.as_py()].update(word_features(text.as_py() or ""))
            if len(hits[0]) + len(hits[1]) > 100_000:
                yield flush()
    yield flush()


def log_ratio(a: float, b: float, m: float, n: float) -> float:
    """Log-likelihood ratio of a of m against b of n."""
    part = lambda k, of, p: 0.0 if p <= 0 or p >= 1 else k * math.log(p) + (of - k) * math.log(1 - p)
    p, p1, p2 = (a + b) / (m + n), a / m, b / n
    return 2 * (part(a, m, p1) + part(b, n, p2) - part(a, m, p) - part(b, n, p))


def choose(counts: list[tuple[str, int, int]], toxic: int, clean: int, most: int = MAX_LEXICON) -> dict[str, tuple[bool, int, float]]:
    """The learned entries: best first, none that is a stem or an extension of a better one."""
    found = []
    for f, a, b in counts:
        odds = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        g = log_ratio(a, b, toxic, clean)
        if odds >= LEAST_ODDS and g >= LEAST_G2:
            found.append((g, f.startswith("="), len(f), f, odds))
    found.sort(reverse=True)
    out: dict[str, tuple[bool, int, float]] = {}
    stems: set[str] = set()
    above: set[str] = set()
    for _, whole, _, f, odds in found:
        text = f.removeprefix("=")
        if text in out or text in above or any(text[:k] in stems for k in STEMS if k <= len(text)):
            continue
        out[text] = (whole, I, min(odds, 8.0))
        if not whole:
            stems.add(text)
        above.update(text[:k] for k in STEMS if k < len(text))
        if len(out) >= most:
            break
    return out


def fit_weights(x: np.ndarray, y: np.ndarray, strength: float = 0.3) -> np.ndarray:
    """Logistic regression with a Gaussian prior at PRIOR, by Newton's method."""
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + strength * (w - PRIOR)
        hess = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def remainder(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_train: int = MAX_TRAIN, max_candidates: int = MAX_CANDIDATES, max_lexicon: int = MAX_LEXICON) -> Model:
    spark = docs.sparkSession
    bound_batches(spark)
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)").where(remainder(F.col("id")) != 1)
    chosen = usable.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_train).collect()
    if not chosen:
        return Model(seed_entries(), PRIOR.copy())
    # At most max_train rows.
    sample = F.broadcast(spark.createDataFrame([tuple(r) for r in chosen], f"id {dict(labels.dtypes)[id_col]}, y int"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(sample, "id")
    # One row an id; written, so that the documents are read once.
    scratch = Scratch(spark, "training")
    rows = scratch.written(rows.groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("y").alias("y")).select("text", "y"), "rows")
    counts = rows.mapInArrow(tidy(_count), "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    per = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    entries = seed_entries()
    if per.get(0) and per.get(1):
        # By the rates that choose() tests, whatever the share of toxic rows; it decides again, so rounding is given room.
        odds = F.log((F.col("toxic") + 0.5) / (per[1] + 1)) - F.log((F.col("clean") + 0.5) / (per[0] + 1))
        likely = counts.where((F.col("toxic") >= LEAST_DOCS) & (odds >= LEAST_ODDS - 1e-9)).orderBy(F.desc("toxic"), "feature").limit(max_candidates).collect()
        entries |= choose([tuple(r) for r in likely], per[1], per[0], max_lexicon)
    model = Model(entries, PRIOR.copy())

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.entries)
        for batch in batches:
            x = [features(lexicon, t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    # At most max_train rows of seven numbers, in an order that doesn't depend on the tasks.
    data = sorted(rows.mapInArrow(tidy(featurise), "x array<double>, y int").collect())
    scratch.close()
    if per.get(0) and per.get(1):
        model.weights = fit_weights(np.array([r["x"] for r in data]), np.array([r["y"] for r in data], float))
    return model


def scorer(model: Model):
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return score


def toxicity_report(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    scored = docs.select(F.col(id_col), F.coalesce(remainder(F.col(id_col)) == 1, F.lit(False)).alias("held_out"), scorer(model)(F.col(text_col).cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_civil(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows scored under the threshold, with the columns of docs."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    return docs.where(scorer(model)(F.col(text_col).cast("string")) < threshold)
