import hashlib
from collections import defaultdict

from scholarloom.llm import exact_dedup as ed

from .helpers import docs

UP = {c: c + 32 for c in range(65, 91)}
ROWS = [(1, "Abc"), (2, "aBC"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "x" * 100_000), (8, "X" * 100_000), (9, "9"), (None, "abc"), (None, "only"), (2, "abc"), (2, "abc")]


def check(rows, got):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(UP)].append(i)
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        [members] = [m for t, m in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
        real = [m for m in members if m is not None]
        assert r.keep_id == (max(real) if real else None) and r.group_size == len(members)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_report(spark):
    check(ROWS, ed.dedup_report(docs(spark, ROWS)).collect())


def test_heavy_groups_take_the_broadcast_path(spark):
    rows = [*ROWS, *((i, "HOT") for i in range(100, 400)), *((500, "hot") for _ in range(3)), *((i, f"t{i}") for i in range(600, 900))]
    df = ed.dedup_report(docs(spark, rows), support=0.05)
    assert "BroadcastHashJoin" in df._jdf.queryExecution().toString()
    check(rows, df.collect())


def test_empty(spark):
    assert ed.dedup_report(docs(spark, [])).collect() == []
    assert ed.keep_first_copies(docs(spark, [])).count() == 0


def test_kept_rows_keep_their_columns(spark):
    df = docs(spark, ROWS)
    out = ed.keep_first_copies(df, support=0.2)
    assert out.columns == df.columns and out.schema == df.schema
    assert sorted((r.doc_id or -1, r.keep_id) for r in out.collect()) == sorted((i, "extra keep_id") for i in (2, 3, 4, 6, 8, 9, -1))


def test_native_plan(spark):
    plan = ed.dedup_report(docs(spark, ROWS))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
