"""Batches over a library folder: files written, sources asked for in order, archives read once."""

import io
import json
import os
import urllib.error

import pytest
from pyspark.sql import functions as F

from scholarloom import cli
from scholarloom.plans import batch as bt
from scholarloom.plans.papers import Options, numbered, process, sources_used
from scholarloom.sources import http, landed, library
from scholarloom.sources.requests import KINDS, pdf_requests, requests
from scholarloom.sources.settings import ConfigError, Settings, dotenv, load_settings

from .test_plan import CONTENT, PDF, zipped
from .test_xml import ARTICLE, xml

META = {"query": "q", "apiKey": "secret", "records": [{"doi": "10.1007/s12273-2", "title": "Only metadata"}]}
OA = ARTICLE.partition("<article")
RESPONSE = "<response><records><article" + OA[2].replace("10.1038/A1", " 10.1038/s2 ") + "</records></response>"


def stub(answers):
    """An opener over fixed answers: the longest key that the address starts with counts."""

    def opener(request, timeout):
        found = [k for k in answers if request.full_url.startswith(k)]
        if not found:
            raise urllib.error.HTTPError(request.full_url, 403, "no", {}, None)
        body = answers[max(found, key=len)]

        class Reply(io.BytesIO):
            status, headers, url = 200, {"Content-Type": "x"}, request.full_url.partition("&api_key")[0]

        return Reply(body)

    return opener


def fetcher(answers, keys=("publisher", "open_access", "metadata")):
    opener = stub(answers)
    return lambda rows: http.fetch_rows(rows, dict.fromkeys(keys, "secret"), opener=opener)


def work(spark, *dois):
    return spark.createDataFrame(list(enumerate(dois)), "pos int, doi_raw string")


def nothing(spark):
    return spark.createDataFrame([], "doi string, kind string, content binary")


def test_requests(spark):
    papers = spark.createDataFrame([("10.1016/j.a(1)", "elsevier"), ("10.1038/s1", "nature"), ("10.1007/s12273-1", "building_simulation"), ("10.5555/x", "unsupported")], "doi string, route string")
    got = {k: {r.doi: (r.url, r.accept, r.key, r.body, r.attempts) for r in requests(papers, k).collect()} for k in KINDS}
    api = "https://api.elsevier.com/content/article/doi/10.1016/j.a%281%29"
    assert got["publisher_xml"] == {"10.1016/j.a(1)": (api, "text/xml", "publisher", "xml", 3)}
    assert got["publisher_metadata"] == {"10.1016/j.a(1)": (api, "application/json", "publisher", "json", 3)}
    assert got["publisher_pdf"] == {"10.1016/j.a(1)": (api + "?view=FULL", "application/pdf", "publisher", "pdf", 3)}
    assert got["oa_response"] == {"10.1038/s1": ("https://api.springernature.com/openaccess/jats?q=doi%3A10.1038%2Fs1&p=10", "application/xml,text/xml", "open_access", "any", 3)}
    assert got["metadata_json"]["10.1007/s12273-1"] == ("https://api.springernature.com/meta/v2/json?q=doi%3A10.1007%2Fs12273-1&p=1", "application/json", "metadata", "json", 1)
    assert got["article_html"]["10.1038/s1"][0] == "https://www.nature.com/articles/s1" and set(got["article_html"]) == {"10.1038/s1", "10.1007/s12273-1"}


def test_pdf_requests(spark):
    page = '<a href="/articles/s1_reference.pdf">Download PDF</a><a href="/s1_MOESM1_ESM.pdf">Supplementary</a>'
    pages = spark.createDataFrame([("10.1038/s1", "nature", page, "https://www.nature.com/articles/s1"), ("10.1038/s2", "nature", "<p>none</p>", "https://www.nature.com/articles/s2"), ("10.1007/s12273-1", "building_simulation", "<p/>", "https://l/a")], "doi string, route string, html string, page_url string")
    assert {r.doi: r.url for r in pdf_requests(pages).collect()} == {
        "10.1038/s1": "https://www.nature.com/articles/s1_reference.pdf", "10.1038/s2": "https://www.nature.com/articles/s2.pdf", "10.1007/s12273-1": "https://link.springer.com/content/pdf/10.1007/s12273-1.pdf",
    }


def test_bodies():
    assert [http.body_error(k, b) for k, b in (("xml", b" \n<a"), ("xml", b"{"), ("pdf", PDF), ("pdf", b"<html>"), ("json", b"{}"), ("json", b"[]"), ("json", b"x"), (None, b""))] == [None, "body_not_xml", None, "body_not_pdf", None, "body_not_json_object", "body_not_json", None]


def test_settings(spark, tmp_path):
    (tmp_path / ".env").write_text("# c\nELSEVIER_API_KEY='a'\nexport MINERU_TIER=basic\n\nbad\n")
    assert dotenv(tmp_path / ".env") == {"ELSEVIER_API_KEY": "a", "MINERU_TIER": "basic"} and dotenv(tmp_path / "none") == {}
    s = load_settings(env={"ELSEVIER_API_KEY": "topsecret"}, file=tmp_path / ".env")
    assert s.require("publisher_key") == "topsecret" and s.parser_tier == "basic" and s.keys() == {"publisher": "topsecret"} and "topsecret" not in repr(s)
    for name, variable in (("publisher_key", "ELSEVIER_API_KEY"), ("open_access_key", "SPRINGER_OA_API_KEY"), ("metadata_key", "SPRINGER_META_API_KEY"), ("parser_executable", "MINERU_EXECUTABLE")):
        with pytest.raises(ConfigError, match=f"{variable} is not configured"):
            Settings().require(name)


def test_numbering(spark, monkeypatch):
    from scholarloom.plans import papers

    monkeypatch.setattr(papers, "NUMBERED_AT_ONCE", 3)
    places = [0, 2, 3, 4, 9, 10, 30]
    got = numbered(spark.createDataFrame([(p, "x") for p in places], "pos int, doi_raw string").repartition(3))
    assert {r.pos: r["index"] for r in got.collect()} == {p: i for i, p in enumerate(places, 1)}


def test_each_archive_is_opened_once(spark, tmp_path):
    log = str(tmp_path / "opened")

    def unzip(b):
        with open(log, "a") as f:
            f.write(".")
        return landed.member_of(b)

    rows = [(f"10.1038/s{i}", k, c) for i in range(6) for k, c in (("local_pdf", PDF), ("explicit_pdf", PDF) if i % 2 else ("article_html", b"x"), ("content_zip", zipped()))]
    rows += [("10.1038/other", "content_zip", zipped()), ("10.1007/s12273-1", "content_zip", zipped())]
    a = spark.createDataFrame(rows, "doi string, kind string, content binary")
    got = process(work(spark, *[f"10.1038/s{i}" for i in range(6)], "10.1007/s12273-1"), a, Options(unzip=unzip))
    assert sorted(r.source for r in got.collect()) == ["local_pdf_mineru"] * 6 + ["springer_restricted_partial"]
    assert got.count() == 7 and os.path.getsize(log) == 6


def test_sources_in_order(spark):
    answers = {
        "https://api.elsevier.com/content/article/doi/10.1016/a": xml().encode(), "https://api.elsevier.com/content/article/doi/10.1016/b": b"{}",
        "https://api.springernature.com/openaccess/jats?q=doi%3A10.1038%2Fs2": RESPONSE.encode(), "https://api.springernature.com/openaccess/jats?q=doi%3A10.1038%2Fs3": b"<response/>",
        "https://www.nature.com/articles/s3": b'<a href="/articles/s3_reference.pdf">Download PDF</a>', "https://www.nature.com/articles/s3_reference.pdf": PDF, "https://www.nature.com/articles/s3.pdf": b"<html>",
        "https://api.springernature.com/meta/v2/json?q=doi%3A10.1007%2Fs12273-2": json.dumps(META).encode(),
    }
    asked = fetcher(answers)
    options = Options(fetch=asked, parser=lambda b: json.dumps(CONTENT))
    got = {r.doi: r for r in process(work(spark, "10.1016/a", "10.1016/b", "10.1038/s2", "10.1038/s3", "10.1007/s12273-2", "10.1016/c"), nothing(spark), options).collect()}
    assert (got["10.1016/a"].source, got["10.1016/a"].error) == (None, "no usable source: references_missing")
    assert got["10.1016/b"].error == "no usable source: elsevier_xml_unavailable" and got["10.1016/c"].error == "no usable source: elsevier_xml_unavailable"
    assert (got["10.1038/s2"].source, got["10.1038/s2"].status, got["10.1038/s2"].fallback_used) == ("springer_nature_jats", "success", False)
    assert (got["10.1038/s3"].source, got["10.1038/s3"].fallback_used, got["10.1038/s3"].markdown, got["10.1038/s3"].fallback_reason) == ("nature_pdf_mineru", True, "# T\n\n## References\n", "articles in the response: 0")
    r = got["10.1007/s12273-2"]
    access = json.loads(r.files["access.json"])
    assert r.source == "springer_restricted_partial" and access["sources_used"] == ["springer_meta_v2"] and access["available_fields"] == ["title"] and access["metadata_json"].endswith("/springer_meta.json") and access["partial_xml"] is None
    assert "secret" not in r.files["springer_meta.json"] and "Only metadata" in r.files["springer_meta.json"]


def test_sources_used(spark):
    df = spark.createDataFrame([("x", "m"), ("x", None), (None, "m"), (None, None)], "p string, m string").select(sources_used("p", "m").alias("u"))
    assert [r.u for r in df.collect()] == [["partial_jats_xml", "springer_meta_v2"], ["partial_jats_xml"], ["springer_meta_v2"], []]


def test_batch_writes_a_library(spark, tmp_path):
    root, results = str(tmp_path / "lib"), str(tmp_path / "out/results.csv")
    for name, data in (("10.1038_s1/My.PDF", PDF), ("10.1038_s1/mineru.zip", zipped()), ("10.1038_s1/access.json", b'{"reason": "r", "status": "restricted_access"}'), ("10.1038_two/a.pdf", PDF), ("10.1038_two/b.pdf", PDF), ("other/mineru.zip", b"bad")):
        (tmp_path / "lib" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "lib" / name).write_bytes(data)
    seen = []
    dois = work(spark, "10.1038/s1", "bad", "10.1038/two", "10.1038/s2")
    options = Options(root=root, fetch=fetcher({"https://api.springernature.com/openaccess/jats?q=doi%3A10.1038%2Fs2": RESPONSE.encode()}))
    items = bt.run_batch(spark, dois, options, results, wave=3, on_result=lambda r, n: seen.append(cli.item_line(r, n)))
    assert [(r["index"], r.status) for r in items.orderBy("index").collect()] == [(1, "success"), (2, "failed"), (3, "warning"), (4, "success")]
    assert seen == ["[1/4] 10.1038/s1 -> success (local_pdf_mineru)", "[2/4] bad -> FAILED\n    invalid DOI: invalid", "[3/4] 10.1038/two -> warning (restricted access; partial XML/metadata)", "[4/4] 10.1038/s2 -> success (springer_nature_jats)"]
    raw = open(results, "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfindex,doi,route,source,status,fallback_used,llm_markdown,qa,error\r\n") and raw.count(b"\r\n") == 5 and not os.path.exists(results + ".parts")
    paper = tmp_path / "lib/10.1038_s1"
    assert {p.name for p in paper.iterdir()} == {"My.PDF", "mineru.zip", "access.json", "paper_llm.md", "qa.json", "structured_content.json"}
    assert (paper / "paper_llm.md").read_text() == "# T\n\n## References\n" and json.loads((paper / "structured_content.json").read_text()) == CONTENT
    qa = json.loads((paper / "qa.json").read_text())
    assert (qa["status"], qa["details"]["audit"]["has_references"], qa["details"]["pdf"]["actual_pages"]) == ("success", True, 1)
    log = json.loads((paper / "access.json").read_text())
    assert log["reason"] == "r" and log["status"] == "recovered_with_pdf" and log["full_text_available"] is True
    assert {p.name for p in (tmp_path / "lib/10.1038_s2").iterdir()} == {"paper.jats.xml", "springer_oa_response.xml", "paper_llm.md", "paper_raw.md", "qa.json"}
    assert {p.name for p in (tmp_path / "lib/10.1038_two").iterdir()} == {"a.pdf", "b.pdf", "access.json", "paper_llm.md", "paper_raw.md", "qa.json"}


def test_interrupted_batch_goes_on(spark, tmp_path):
    root, results = str(tmp_path / "lib"), str(tmp_path / "r.csv")
    dois = work(spark, "10.1016/a", "10.1016/b", "10.1016/c")

    def stop(row, total):
        if row["index"] == 2:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        bt.run_batch(spark, dois, Options(root=root), results, wave=1, on_result=stop)
    assert open(results, encoding="utf-8-sig").read().count("\n") == 3
    seen = []
    assert bt.run_batch(spark, dois, Options(root=root), results, wave=1, on_result=lambda r, n: seen.append(r["index"])).count() == 3 and seen == [1, 2, 3]
    with pytest.raises(ValueError, match="no DOI"):
        bt.run_batch(spark, dois.limit(0), Options(root=root), results)
    with pytest.raises(FileNotFoundError):
        landed.read_doi_list(spark, str(tmp_path / "none.txt"))


def test_rerender(spark, tmp_path):
    for name, data in (("a/mineru.zip", zipped()), ("b/mineru.zip", b"no zip"), ("c/paper.xml", b"x")):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_bytes(data)
    got = {r.paper_id: r for r in bt.rerender(spark, str(tmp_path)).collect()}
    assert set(got) == {"a", "b"} and got["b"].error == "invalid_zip" and got["a"].has_references
    assert (tmp_path / "a/paper_llm.md").read_text() == "# T\n\n## References\n" and set(json.loads((tmp_path / "a/qa_rerender.json").read_text())) == {"render", "audit"}
    with pytest.raises(FileNotFoundError):
        bt.rerender(spark, str(tmp_path / "c"))


def test_external_parser(tmp_path):
    program = tmp_path / "tool"
    archive = tmp_path / "made.zip"
    archive.write_bytes(zipped())

    def tool(script):
        program.write_text("#!/bin/sh\nfor last; do :; done\n" + script)
        program.chmod(0o755)
        return landed.external_parser(str(program))

    assert json.loads(tool(f'cp {archive} "$last/paper.zip"; cp {archive} "$last/x.zip"')(PDF)) == CONTENT
    assert json.loads(tool(f'cp {archive} "$last/any.zip"')(PDF)) == CONTENT
    with pytest.raises(ValueError, match="expected one archive, found 2: a.zip, b.zip"):
        tool(f'cp {archive} "$last/a.zip"; cp {archive} "$last/b.zip"')(PDF)
    with pytest.raises(ValueError, match="found 0"):
        tool("true")(PDF)
    with pytest.raises(RuntimeError, match="exit code 7\nout\nerr"):
        tool("echo out; echo err >&2; exit 7")(PDF)
    with pytest.raises(ValueError, match="tier"):
        landed.external_parser("x", " ")


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "any.pdf").write_bytes(PDF)
    (tmp_path / "lib/10.1007_s12273-1").mkdir(parents=True)
    (tmp_path / "lib/10.1007_s12273-1/structured_content.json").write_text(json.dumps(CONTENT))
    root = ["--library-root", str(tmp_path / "lib"), "--offline"]
    assert cli.main(["process", "10.1007/s12273-1", "--pdf", str(tmp_path / "any.pdf"), *root]) == 0
    out = capsys.readouterr().out
    assert "Source = local_pdf_mineru" in out and "Fallback used = no" in out and (tmp_path / "lib/10.1007_s12273-1/paper.pdf").read_bytes() == PDF
    assert cli.main(["process", "10.1007/s12273-1", "--pdf", str(tmp_path / "any.doc"), *root]) == 1 and "ERROR: ValueError" in capsys.readouterr().err
    (tmp_path / "list.txt").write_text("# x\n10.1016/none\n10.1007/s12273-1\n")
    assert cli.main(["process-list", str(tmp_path / "list.txt"), *root]) == 1
    out = capsys.readouterr().out
    assert "[1/2] 10.1016/none -> FAILED" in out and "[2/2] 10.1007/s12273-1 -> success (local_pdf_mineru)" in out and "total 2 success 1 warning 0 failed 1" in out
    assert cli.main(["rerender", str(tmp_path / "lib")]) == 1 and "ERROR: FileNotFoundError" in capsys.readouterr().err


def test_files_are_whole_or_absent(spark, tmp_path):
    files = spark.createDataFrame([("p", "a.txt", b"x"), ("p", "b.txt", None), ("q", "a.txt", b"")], "paper_id string, name string, data binary")
    for _ in range(2):
        assert {(r.paper_id, r.name, r.bytes) for r in library.write_files(files, str(tmp_path)).collect()} == {("p", "a.txt", 1), ("q", "a.txt", 0)}
    assert sorted(os.listdir(tmp_path / "p")) == ["a.txt"]
    assert library.artifact_files(spark.createDataFrame([("p", "metadata_json", b"secret"), ("p", "jats_xml", b"x")], "paper_id string, kind string, content binary")).select(F.col("name")).collect()[0].name == "paper.jats.xml"
