import hashlib
import os
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from scholarloom.llm import toxicity
from scholarloom.llm.queries import ORACLE_SQL, QUERIES, tokenizer_file

from .helpers import docs
from .test_near_dedup import brute as near
from .test_suffix import brute as repeats

SF = "/root/testdata/sf0.001"
UP = {c: c + 32 for c in range(65, 91)}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "exact_dedup", "minhash_near_dedup", "suffix_array_dedup", "packing"]
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(table, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in table.collect() if model.score(r.text) < 0.7]
    best = {}
    for i, t in rows:
        k = (t or "").translate(UP)
        best[k] = max(best.get(k, (i, t)), (i, t))
    rows = sorted(best.values())
    rows = [(i, t) for (i, t), (_, c, _) in zip(rows, sorted(near(rows), key=lambda x: x[0]), strict=True) if i == c]
    kept = {x[0]: x[4] for x in repeats(rows)}
    docs = table
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == table.columns, name
    got = {r.doc_id: r for r in docs.collect()}
    assert set(got) == set(kept)
    whole = [i for i in kept if hashlib.sha256((got[i].text or "").encode()).hexdigest() == kept[i]]
    assert len(whole) >= len(kept) - 2  # the others were cut inside a character
    assert all(r.n_chars == len(r.text) for r in got.values())
    library = Tokenizer.from_file(tokenizer_file(spark, "word_bpe_49k.json"))
    pieces = cp.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == set(kept)
    ids = {i: np.r_[library.encode(got[i].text, add_special_tokens=False).ids, 1].astype("<u4") for i in kept}
    covered = {i: np.zeros(len(x), int) for i, x in ids.items()}
    for p in pieces:
        own = ids[p.doc_id]
        assert p.doc_tokens == len(own) and p.ids_crc32 == zlib.crc32(own[p.start : p.start + p.length].tobytes())
        covered[p.doc_id][p.start : p.start + p.length] += 1
    assert all((c == 1).all() for c in covered.values())


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (2, ""), (None, None)]])
def test_stages_on_empty_tables_and_texts(spark, tmp_path, rows):
    table = docs(spark, rows)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    held = table
    for name, stage in cp.STAGES[:-1]:
        held = stage(spark, held, str(tmp_path))
        assert held.columns == table.columns, name
    pieces = cp.run(spark, str(tmp_path)).collect()
    assert sorted(p.doc_id for p in pieces) == ([2] if rows else []) and all(p.doc_tokens == 1 for p in pieces)


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11)) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_like_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    r = c.execute(ORACLE_SQL[name])
    cols = [x[0] for x in r.description]
    df = QUERIES[name](spark, SF)
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*cols).collect()))) == sorted(map(repr, r.fetchall()))
