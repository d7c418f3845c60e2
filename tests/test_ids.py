from pyspark.sql import functions as F

from scholarloom.functions import ids

CASES = {
    "10.1016/j.buildenv.2025.113229": "10.1016/j.buildenv.2025.113229",
    " DOI:10.1016/J.BUILDENV.2025.113229 ": "10.1016/j.buildenv.2025.113229",
    "https://doi.org/10.1007/s12273-026-1484-2": "10.1007/s12273-026-1484-2",
    "http://dx.doi.org/10.1007/s12273-026-1484-2": "10.1007/s12273-026-1484-2",
    "<https://doi.org/10.1016/j.buildenv.2026.114205>": "10.1016/j.buildenv.2026.114205",
    "10.1038/s41467-019-11026-x": "10.1038/s41467-019-11026-x",
    "10.5555/a+b%2Fc%zz": "10.5555/a+b/c%zz",
    "": None, "hello": None, "10.123": None, "https://example.com/10.1007/test": None, "not-a-doi": None, "10.12/x": None,
}


def test_normalize(spark):
    rows = spark.createDataFrame([(k,) for k in [*CASES, None]], "raw string").select("raw", ids.normalize_doi("raw").alias("doi"), ids.doi_error("raw").alias("e")).collect()
    assert {r.raw: r.doi for r in rows} == CASES | {None: None}
    errors = {r.raw: r.e for r in rows}
    assert errors[""] == errors[None] == "empty" and errors["hello"] == "invalid" and errors["https://example.com/10.1007/test"] == "unsupported_host" and errors["10.5555/a+b%2Fc%zz"] is None


def test_route_and_urls(spark):
    want = {
        "10.1016/x": ("elsevier", "elsevier", True), "10.1007/s12273-1": ("springer_nature", "building_simulation", True), "10.1038/s4": ("springer_nature", "nature", True),
        "10.1007/s00134": ("springer_nature", "unsupported", False), "10.5555/e": ("unknown", "unsupported", False), None: (None, None, None),
    }
    df = ids.article_urls(ids.with_route(spark.createDataFrame([(k,) for k in want], "doi string")))
    rows = {r.doi: r for r in df.collect()}
    assert {k: (r.publisher, r.route, r.supported) for k, r in rows.items()} == want
    assert rows["10.1038/s4"].pdf_url == "https://www.nature.com/articles/s4.pdf"
    assert rows["10.1007/s12273-1"].article_url == "https://link.springer.com/article/10.1007/s12273-1"
    assert rows["10.5555/e"].article_url is None


def test_names_and_paths(spark):
    df = spark.createDataFrame([("10.1007/s12273-026-1484-2",), ("10.1234/" + "a" * 300,), ("10.1/x. .",)], "doi string")
    one, two, three = [r.n for r in df.select(ids.dirname("doi").alias("n")).collect()]
    assert one == "10.1007_s12273-026-1484-2" and len(two) == 120 and "--" in two and three == "10.1_x"
    p = ids.paper_paths(df.limit(1), "lib/").first()
    assert p.qa_json == "lib/10.1007_s12273-026-1484-2/qa.json" and p.jats_xml.endswith("paper.jats.xml")
    assert ids.workspace_paths("w/")["logs"] == "w/logs"


def test_join_url(spark):
    df = spark.createDataFrame([("https://h/a/b?x", h) for h in ("c.pdf", "/c.pdf", "//o/c.pdf", "http://o/c", "")], "b string, h string")
    assert [r[0] for r in df.select(ids.join_url("b", "h")).collect()] == ["https://h/a/c.pdf", "https://h/c.pdf", "https://o/c.pdf", "http://o/c", "https://h/a/b?x"]
    assert df.select(ids.directly_in(F.lit("/a/b/c.pdf"), F.lit("/a/b/"))).first()[0]


def test_normalize_in_workers():
    assert {k: ids.plain_doi(k) for k in CASES} == CASES and ids.plain_doi(None) is None
