import io
import json
import threading
import urllib.error
import zipfile
import zlib
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from scholarloom.operators import manifest
from scholarloom.plans.papers import Options, batch_manifest, process, qa_json
from scholarloom.sources import http, landed
from scholarloom.sources.requests import SCHEMA
from scholarloom.streaming import landing

PDF = b"%PDF-1.7\n1 0 obj << /Type /Page >> endobj\n%%EOF"
CONTENT = {"is_full_document": True, "pages": [{"blocks": [{"type": "doc_title", "content": "T"}, {"type": "paragraph_title", "content": "References"}]}]}


def zipped(name=landed.MEMBER, data=None):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(name, json.dumps(data or CONTENT))
    return out.getvalue()


def test_work_list(spark, tmp_path):
    (tmp_path / "l.txt").write_text("﻿10.1016/A\r\n# no\n\n 10.1016/a \n10.1038/b\n", encoding="utf-8")
    assert [r.doi_raw for r in landed.read_doi_list(spark, str(tmp_path / "l.txt")).orderBy("pos").collect()] == ["10.1016/A", "10.1038/b"]


def test_landed_files(spark, tmp_path):
    for name, data in (("p1/paper.xml", b"<a/>"), ("p1/Any.PDF", PDF), ("p2/mineru.zip", zipped()), ("p3/mineru.zip", zipped("other.json")), ("p4/mineru.zip", b"no zip")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    a = landed.read_artifacts(spark, str(tmp_path))
    assert {(r.paper_id, r.kind) for r in a.collect()} == {("p1", "publisher_xml"), ("p1", "local_pdf"), ("p2", "content_zip"), ("p3", "content_zip"), ("p4", "content_zip")}
    z = {r.paper_id: (r.content_json is not None, r.zip_error) for r in landed.read_content_zips(a.where("kind = 'content_zip'")).collect()}
    assert z == {"p2": (True, None), "p3": (False, "member_missing"), "p4": (False, "invalid_zip")}
    assert landed.with_page_count(a.where("kind = 'local_pdf'")).first().actual_pages == 1


def test_page_count():
    packed = b"%PDF-1.5\n5 0 obj << /Type /ObjStm >> stream\n" + zlib.compress(b"<< /Type /Page >> << /Type/Page /x >> << /Type /Pages >>") + b"\nendstream\n%%EOF"
    assert landed.count_pages(packed) == 2 and landed.count_pages(b"<html>") is None and landed.count_pages(PDF[:-6]) is None and landed.count_pages(None) is None
    assert landed.count_pages(b"%PDF-1 /Encrypt /Type /Page %%EOF") is None


def test_page_tree():
    old = b"3 0 obj << /Type /Page /Parent 2 0 R >> endobj\n"
    tree = b"%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n2 0 obj << /Type /Pages /Count 3 /Kids [3 0 R 4 0 R] >> endobj\n" + old + b"4 0 obj << /Type /Pages /Kids 7 0 R >> endobj\n5 0 obj << /Type/Page >> endobj\n6 0 obj << /Type /Page >> endobj\n7 0 obj [5 0 R 6 0 R 2 0 R] endobj\n"
    assert landed.count_pages(tree + b"%%EOF") == 3
    # An update replaces the root and leaves old pages behind.
    assert landed.count_pages(tree + b"%%EOF\n2 0 obj << /Type /Pages /Kids [3 0 R] >> endobj\n" + old + b"%%EOF") == 1
    inner = [b"<< /Type /Catalog /Pages 11 0 R >>", b"<< /Type /Pages /Kids [12 0 R 13 0 R] >>", b"<< /Type /Page >>", b"<< /Type /Page >>", b"<< /Type /Page /Lost true >>"]
    at, head = 0, b""
    for i, x in enumerate(inner):
        head += b"%d %d " % (10 + i, at)
        at += len(x) + 1
    packed = zlib.compress(head + b"\n" + b" ".join(inner))
    assert landed.count_pages(b"%PDF-1.5\n9 0 obj << /Type /ObjStm /N 5 /First " + str(len(head) + 1).encode() + b" /Filter /FlateDecode >> stream\n" + packed + b"\nendstream endobj\n%%EOF") == 2


def test_parser_failures_are_values(spark):
    df = spark.createDataFrame([(b"ok",), (b"bad",)], "content binary")

    def parser(b):
        if b == b"bad":
            raise RuntimeError("exit code 7")
        return "{}"

    assert [(r.content_json, r.parser_error) for r in landed.parse_pdfs(df, parser).collect()] == [("{}", None), (None, "RuntimeError: exit code 7")]


def test_local_pdf_choice(spark):
    df = spark.createDataFrame([("a", "x.txt", None), ("b", "One.PDF", None), ("c", "1.pdf", None), ("c", "2.pdf", None), ("d", "1.pdf", "e.pdf"), ("e", "1.pdf", "e.doc")], "directory string, name string, given string")
    got = {r.directory: (r.pdf, r.error) for r in manifest.find_local_pdf(df, explicit="given").collect()}
    assert got == {"a": (None, None), "b": ("One.PDF", None), "c": (None, "multiple_local_pdf"), "d": ("e.pdf", None), "e": (None, "explicit_not_pdf")}


def test_process(spark, tmp_path):
    dois = spark.createDataFrame([(0, "10.1038/s1"), (1, "DOI:10.1007/s12273-2"), (2, "bad"), (3, "10.1016/none"), (4, "10.5555/x"), (5, "10.1038/s6"), (6, "10.1007/s12273-7")], "pos int, doi_raw string")
    meta = json.dumps({"records": [{"doi": "10.1007/s12273-2", "title": "Only metadata"}]}).encode()
    a = spark.createDataFrame([
        ("10.1038/s1", "local_pdf", PDF), ("10.1038/s1", "content_zip", zipped()), ("10.1007/s12273-2", "metadata_json", meta), ("10.1038/s6", "local_pdf", b"<html>"), ("10.1007/s12273-7", "local_pdf", PDF), ("10.1007/s12273-7", "content_json", json.dumps(CONTENT).encode()),
    ], "doi string, kind string, content binary")
    results = process(dois, a).cache()
    r = {x.doi: x for x in results.collect()}
    assert (r["10.1038/s1"].source, r["10.1038/s1"].status, r["10.1038/s1"].fallback_used, r["10.1038/s1"].markdown) == ("local_pdf_mineru", "success", True, "# T\n\n## References\n")
    assert r["10.1007/s12273-2"].source == "springer_restricted_partial" and "# Only metadata" in r["10.1007/s12273-2"].markdown
    assert r["10.1038/s6"].source == "springer_restricted_partial" and r["10.1007/s12273-7"].fallback_used is False
    assert r["bad"].error == "invalid DOI: invalid" and r["10.5555/x"].error == "unsupported route" and r["10.1016/none"].error.startswith("no usable source")
    items = batch_manifest(results, Options("lib"))
    assert [x["index"] for x in items.orderBy("index").collect()] == [1, 2, 3, 4, 5, 6, 7]
    assert tuple(manifest.summary(items).first()) == (7, 2, 2, 3)
    manifest.write_manifest(items, str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).columns == list(manifest.FIELDS)
    assert '"status" : "failed"' in qa_json(results).where("doi = 'bad'").first().qa


def test_upsert(spark):
    log = spark.createDataFrame([("a", {"status": "restricted_access", "reason": "r"}), ("b", None), ("c", {"status": "x"})], "doi string, payload map<string,string>")
    new = spark.createDataFrame([("a", "local", "p.pdf"), ("b", "local", "q.pdf"), ("z", "local", "z.pdf")], "doi string, recovered_source string, recovered_pdf string")
    got = {r.doi: r.payload for r in manifest.upsert_access(log, new).collect()}
    assert got["a"]["status"] == manifest.RECOVERED and got["a"]["reason"] == "r" and got["b"]["recovered_pdf"] == "q.pdf" and got["c"] == {"status": "x"} and len(got) == 3


class Reply(io.BytesIO):
    status = 200
    headers = {"Content-Type": "application/pdf"}


def test_fetch_retries():
    calls, waits = [], []

    def opener(request, timeout):
        calls.append(request.full_url)
        if len(calls) < 3:
            raise urllib.error.URLError("down")
        return Reply(PDF)

    assert http.fetch("http://x", {}, opener=opener, sleep=waits.append)[:3] == (PDF, "application/pdf", 200) and len(calls) == 3 and waits == [1.0, 2.0]

    def refused(request, timeout):
        calls.append("again")
        raise urllib.error.HTTPError("http://x", 403, "no", {}, None)

    calls.clear()
    assert http.fetch("http://x", {}, opener=refused, sleep=waits.append)[2:] == (403, "HTTP 403") and calls == ["again"]


class Handler(BaseHTTPRequestHandler):
    def do_GET(self):
        body = {"/p.pdf": PDF, "/page": b"<html>", "/x.xml": b" <a/>"}.get(self.path.partition("?")[0])
        self.send_response(200 if body else 404)
        self.end_headers()
        self.wfile.write(body or b"")

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def server():
    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_http_source(spark, tmp_path, server):
    rows = [("d1", "public_pdf", f"{server}/p.pdf", None, None, "pdf", 3), ("d2", "public_pdf", f"{server}/page", None, None, "pdf", 3), ("d3", "publisher_xml", f"{server}/x.xml", "text/xml", "metadata", "xml", 1), ("d4", "x", f"{server}/none", None, None, None, 3), ("d5", "x", f"{server}/page", None, "publisher", None, 1)]
    wanted = spark.createDataFrame(rows, SCHEMA)
    want = {"d1": (PDF, None), "d2": (None, "body_not_pdf"), "d3": (b" <a/>", None), "d4": (None, "HTTP 404"), "d5": (None, "no key: publisher")}
    got = http.fetch_rows(wanted, {"metadata": "secret"}).collect()
    assert {r.doi: (r.content and bytes(r.content), r.error) for r in got} == want
    assert not any("secret" in str(v) for r in got for v in r)
    wanted.write.parquet(str(tmp_path / "requests"))
    spark.dataSource.register(http.ArtifactSource)
    read = spark.read.format("artifact_http").option("requests", str(tmp_path / "requests")).option("keys", json.dumps({"metadata": "secret"})).load()
    assert {r.doi: (r.content and bytes(r.content), r.error) for r in read.collect()} == want


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps({"paper_id": "p", "content_json": json.dumps(CONTENT)}))
    for _ in range(2):  # the second run finds nothing new
        landing.run(landing.landed_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [(r.paper_id, r.status) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("p", "success")]


def test_cli(capsys):
    from scholarloom import cli

    assert cli.main(["version"]) == 0 and capsys.readouterr().out.strip() == cli.VERSION
    with pytest.raises(SystemExit):
        cli.main([])
