import hashlib
import random
import time

from scholarloom.llm import line_dedup as ld

from .helpers import docs

UP = {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip("\x20\t\n\x0b\x0c\r").translate(UP)


def brute(rows):
    first, seen = {}, {}
    low = lambda i: (i is None, i or 0)
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= 10:
                seen.setdefault(k, set()).add(i)
                first[k] = min(first.get(k, i), i, key=low)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(seen[key(x)]) > 1 and first[key(x)] != i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    return sorted(map(tuple, ld.line_report(docs(spark, rows), **more).collect()), key=repr)


ROWS = [
    (5, "A common line\n\nshort\n\tA COMMON LINE \n"), (2, " a common line\nown line of two"), (9, None), (7, ""), (8, "a common line"), (8, "a common line\nother text 8"), (None, "a common line\nnull's line ..."), (3, "Ünïcode line é\n"),
    (4, "ünïcode line é"), (6, "Ünïcode line é\r"), (1, "twice in one doc\ntwice in one doc"), (10, " 1234567890 "), (11, "1234567890"), (12, "123456789\n"), (13, "123456789"), (14, "\n" * 5000 + "a common line"), (2, " a common line\nown line of two"),
]


def test_cases(spark):
    assert run(spark, ROWS) == brute(ROWS)


def test_random_and_hot(spark):
    r = random.Random(4)
    rows = [(i, "\n".join(r.choice(("The very common line", f"line number {r.randrange(60)}", f"unique {i} {r.random()}", "x")) for _ in range(r.randrange(200)))) for i in range(150)]
    assert run(spark, rows) == brute(rows)


def test_bitmaps_are_words(spark):
    b = ld.drop_bitmaps(docs(spark, [(1, "the same line"), (2, "\n" * 130 + "the same line")])).collect()
    assert [(r.doc, [(w.w, w.bits) for w in r.words]) for r in b] == [(2, [(2, 1 << 2)])]


def test_empty(spark):
    assert run(spark, []) == []


def test_native_plan(spark):
    plan = ld.line_report(docs(spark, ROWS))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_a_million_lines(spark):
    text = "\n".join(f"line number {i} of the long one" if i % 3 else "x" for i in range(1_000_000))
    rows = [(1, text), (2, text), (3, "line number 4 of the long one\nown line of three")]
    start = time.monotonic()
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in ld.line_report(docs(spark, rows, clashing=False)).collect()}
    assert got == {1: (1_000_000, 0), 2: (1_000_000, 666_666), 3: (2, 1)}
    assert time.monotonic() - start < 60
