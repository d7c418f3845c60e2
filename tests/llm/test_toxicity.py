import random
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scholarloom.llm import toxicity as tox
from scholarloom.llm.queries import QUERIES

from .helpers import docs, words


def corpus(n=400):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = words(i, 80)
        if bad:
            parts = text.split(" ")
            for _ in range(3):
                parts.insert(r.randrange(80), r.choice(("idiot", "grumblix" + r.choice("abcd"), "Moron")))
            text = " ".join(parts)
        rows.append((i, text))
        labels.append((i, int(bad)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame([(i, 1, t, "x") for i, t in labels], "doc_id long, quality int, toxic int, score string")


def test_learns_and_holds_out(spark):
    rows, labels = corpus()
    rows += [(10_000, None), (10_001, ""), (None, "idiot you"), (10_002, "Grumblix " * 50_000), (0, rows[0][1])]
    got = tox.toxicity_report(docs(spark, rows), labelled(spark, [*labels, (77_777, 1), (3, None)])).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and sum(truth[r.doc_id] == r.predicted for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert by[10_000].score == by[10_001].score < 0.5 and by[10_002].predicted == 1 and by[None].held_out is False
    crc = {r[0]: r[1] for r in spark.range(50).select("id", F.crc32(F.col("id").cast("string").cast("binary")) % 3).collect()}
    assert all(by[i].held_out == (crc[i] == 1) for i in range(50))


def test_held_out_labels_are_not_learned(spark):
    rows, labels = corpus(150)
    df = docs(spark, rows)
    one = tox.train(df, labelled(spark, labels))
    out = {r.doc_id for r in df.where(tox.remainder(F.col("doc_id")) == 1).collect()}
    two = tox.train(df, labelled(spark, [(i, 1 - t if i in out else t) for i, t in labels]))
    assert one.entries == two.entries and (one.weights == two.weights).all()


def test_without_labels_or_rows(spark):
    empty = labelled(spark, [])
    assert tox.toxicity_report(docs(spark, []), empty).collect() == []
    got = {r.doc_id: r.score for r in tox.toxicity_report(docs(spark, [(1, "you are an idiot and a moron"), (2, "a fine day")]), empty).collect()}
    assert got[1] > 0.5 > got[2]


def test_grammar_modes():
    lex = tox.Lexicon(tox.seed_entries())
    modes = lambda text: [m for m, (f) in enumerate(tox.features(lex, text)[1:-1]) if f > 0]
    assert modes("the idiot left") == [0] and modes("you idiot") == [1] and modes("not an idiot") == [2] and modes("they said idiot") == [3] and modes("i will kill you") == [4]
    assert modes("kill the lights") == [] and modes("Not now. An idiot") == [0] and tox.Lexicon({"abc": (False, tox.I, 2.0), "abcd": (True, tox.I, 3.0)}).read("abcd") == (tox.I, 3.0)


def test_civil_rows(spark):
    rows, labels = corpus(200)
    df = docs(spark, rows)
    out = tox.keep_civil(df, labelled(spark, labels))
    assert out.columns == df.columns
    ids = {r.doc_id for r in out.collect()}
    assert len(ids & {i for i, t in labels if not t}) == 160 and len(ids & {i for i, t in labels if t}) <= 2


def test_few_toxic_labels(spark):
    # 3% toxic: the word is in half of the toxic and a thirtieth of the clean texts, in more clean ones by number.
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 3 != 1][:1000]
    rows = [(i, words(i, 40) + (" grumblix" if (k % 2 if k < 30 else k % 30 == 0) else "")) for k, i in enumerate(ids)]
    model = tox.train(docs(spark, rows), labelled(spark, [(i, int(k < 30)) for k, i in enumerate(ids)]))
    assert any("grumblix".startswith(e) for e in set(model.entries) - set(tox.seed_entries()))


def test_repeated_ids_and_one_row_an_id(spark):
    rows, labels = corpus(200)
    one = tox.train(docs(spark, rows), labelled(spark, labels))
    two = tox.train(docs(spark, rows[::-1] * 3).repartition(7), labelled(spark, labels * 2))
    assert one.entries == two.entries and (one.weights == two.weights).all()


def test_held_out_documents_of_the_tables(spark):
    folder = Path("/root/testdata/sf0.1")
    if not folder.exists():
        pytest.skip("no tables")
    got = {r.doc_id: r for r in QUERIES["op4_toxicity"](spark, str(folder)).collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(str(folder / "labels.parquet")).collect()}
    held = [(truth[i], r.predicted) for i, r in got.items() if r.held_out and truth.get(i) is not None]
    toxic, clean = [p for t, p in held if t], [p for t, p in held if not t]
    assert len(toxic) >= 100 and sum(toxic) / len(toxic) >= 0.85 and sum(clean) / len(clean) <= 0.01
