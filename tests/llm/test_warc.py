import base64
import gzip
import hashlib
import io
import json
import tracemalloc

import pytest

from scholarloom.llm import warc
from scholarloom.llm.common import fresh_path

ROWS = [(3, "http://a/b c", "<p>x</p>"), (1, "u", "<p>x</p>"), (2, None, None), (None, "n", "<p>x</p>"), (5, "e", ""), (5, "e", ""), (7, "l", "é" * 300_000), (8, "z\r\nWARC-Type: x", "a\r\n\r\nb\r\n\r\n")]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, archive string, digest int")


def expected(rows):
    first = {}
    for i, _, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(t or "", i)
    seen, out = set(), []
    for i, _, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (t or "").encode()
        response = (t or "") not in seen
        seen.add(t or "")
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if response else "revisit", None if response else first[t or ""]))
    return sorted(out, key=repr)


def test_round_trip(spark):
    got = warc.archive_pages(pages(spark, ROWS), roll_bytes=1000).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == expected(ROWS)


def test_empty_table(spark):
    assert warc.archive_pages(pages(spark, [])).collect() == []


def test_small_payloads_are_all_responses(spark):
    got = warc.archive_pages(pages(spark, ROWS), min_bytes=5).collect()
    assert sum(r.record_type == "revisit" for r in got) == 2


def test_files_are_members_with_an_index(spark):
    folder = fresh_path(spark, "warc-test")
    warc.archive_pages(pages(spark, ROWS[:6]), folder=folder).collect()
    store, base = warc.open_store(f"{folder}/records")
    from pyarrow import fs

    files = sorted(f.path for f in store.get_file_info(fs.FileSelector(base)) if f.size)
    seen = 0
    for path in (f for f in files if f.endswith(".warc.gz")):
        data = store.open_input_file(path).read()
        index = [json.loads(x) for x in store.open_input_file(path.replace(".warc.gz", ".index.jsonl")).read().splitlines()]
        assert sum(x["length"] for x in index) == len(data)
        for x in index:
            fields, _, _ = warc.parse(gzip.decompress(data[x["offset"] : x["offset"] + x["length"]]))
            assert fields["warc-record-id"] == x["id"] and fields["warc-type"] == x["type"]
            seen += 1
        assert len(list(warc.records(iter([data])))) == len(index)  # the members are a stream too
    assert seen == 6


@pytest.mark.parametrize("chunk", [1, 7, 100_000])
def test_stream_parser(chunk):
    rows = [warc.record("response", i, f"u{i}", "D", b"\r\n\r\n" * i, 4 * i) for i in range(5)]
    data = gzip.compress(b"".join(rows[:3])) + b"".join(gzip.compress(r) for r in rows[3:])
    assert list(warc.records(iter(data[i : i + chunk] for i in range(0, len(data), chunk)))) == rows
    with pytest.raises(ValueError):
        list(warc.records(iter([gzip.compress(rows[0] + rows[1][:-9])])))
    assert list(warc.records(iter(io.BytesIO(b"")))) == []


def test_string_ids_of_any_characters(spark):
    ids = ["a\r\nWARC-Type: revisit", " padded ", "100%25", "é\xa0", "", None, "x"]
    rows = [(i, "u", f"p{n // 2}") for n, i in enumerate(ids)]
    got = warc.archive_pages(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()
    assert sorted((r.page_id or "none") for r in got) == sorted((i or "none") for i in ids)
    by = {r.page_id: r for r in got}
    assert by["a\r\nWARC-Type: revisit"].record_type == "revisit" and by["a\r\nWARC-Type: revisit"].refers_to == " padded "


def test_expanding_streams_are_inflated_in_slices():
    raw = warc.record("response", 1, "u", "D", bytes(50_000_000), 50_000_000)
    tracemalloc.start()
    assert [len(r) for r in warc.records(iter([gzip.compress(raw * 4)]))] == [len(raw)] * 4
    assert tracemalloc.get_traced_memory()[1] < 6 * len(raw)
    tracemalloc.stop()
