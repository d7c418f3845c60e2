import json

from pyspark.sql import functions as F

from scholarloom.operators import metadata as md

RECORD = {
    "identifier": "doi:10.1007/S1", "title": " T ", "creators": [{"creator": "Smith, Alice"}, {"name": "Bob"}, "Smith, Alice", 3, {"creator": 7, "name": "no"}], "publicationName": "J", "onlineDate": "2020", "volume": 5, "number": "2", "startingPage": "1",
    "endingPage": "1", "publisher": "P", "abstract": " ", "keyword": ["k", {"value": "v"}, {"subject": " "}], "openaccess": False, "rights": "c", "url": [{"format": "pdf", "value": "https://a"}, {"format": "HTML", "value": "https://b"}],
}


def select(spark, *payloads):
    return md.select_record(spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p), "10.1007/s1") for p in payloads], "payload string, doi string"))


def test_selection_and_fields(spark):
    df = select(spark, {"query": "q", "apiKey": "secret", "records": [{"doi": "10.1/x"}, RECORD, {"doi": "10.1007/s1"}]})
    f = md.meta_fields(df, name="f").select("f", md.safe_artifact("payload", "record").alias("a")).first()
    assert f.f.asDict() == {
        "title": "T", "authors": ["Smith, Alice", "Bob"], "journal": "J", "publication_date": "2020", "volume": "5", "issue": "2", "pages": "1", "publisher": "P", "abstract": None,
        "keywords": ["k", "v"], "open_access": "false", "copyright": "c", "url": "https://b",
    }
    assert "secret" not in f.a and "10.1007/S1" in f.a


def test_selection_errors(spark):
    rows = select(spark, "x", "[1]", {"records": 5}, {"records": [{"doi": "10.1/x"}, "t"]}, {"records": [{"doi": "https://doi.org/10.1007/s1"}]}).collect()
    assert [r.metadata_error for r in rows] == ["not_json", "unexpected_structure", "no_records_list", "doi_not_in_response", None]


def test_partial_xml(spark):
    xml = "<a><article-id>10.1007/s1</article-id><article-title>X <i>y</i></article-title><contrib contrib-type='author'><surname>Jones</surname><given-names>Bob</given-names></contrib><contrib contrib-type='editor'><surname>E</surname></contrib><fpage>1</fpage><lpage>9</lpage><pub-date><year>2020</year><month>3</month></pub-date><self-uri href='https://s'/></a>"
    one, two, three = [r.partial for r in md.read_partial(spark.createDataFrame([(xml, "10.1007/s1"), (xml, "10.1007/other"), ("<b", "10.1007/s1")], "xml string, doi string")).collect()]
    assert (one.title, one.authors, one.pages, one.publication_date, one.url) == ("X y", ["Bob Jones"], "1-9", "2020-3", "https://s") and two is None and three is None


def test_merge_and_markdown(spark):
    j = {f: None for f in md.FIELDS} | {"title": "J", "authors": ["Alice Smith"], "abstract": "ab", "open_access": "x", "keywords": []}
    m = {f: None for f in md.FIELDS} | {"title": "M", "authors": ["Smith, Alice", "Alice Smith"], "abstract": "cd", "open_access": "false", "url": "https://u", "keywords": ["k"]}
    df = spark.createDataFrame([(j, m)], f"j {md.FIELD_TYPE}, m {md.FIELD_TYPE}").withColumn("f", md.merge_fields("j", "m"))
    r = df.select("f.*", md.available_fields("f").alias("names"), md.partial_markdown(F.lit("10.1/x"), "f", F.lit("lib/x"), F.lit("run")).alias("md")).first()
    assert (r.title, r.authors, r.abstract, r.open_access) == ("J", ["Alice Smith", "Smith, Alice"], "ab", "false") and r.names == ["title", "authors", "abstract", "keywords", "open_access", "url"]
    assert r.md.startswith("# J\n\nDOI: 10.1/x\nAuthors: Alice Smith; Smith, Alice\nOpen access metadata: false\nKeywords: k\n\n## Abstract\n\nab\n\n## Publisher link\n\nhttps://u\n\n## Access status\n\n> The complete") and r.md.endswith("> `run`\n")
    only = df.select(md.merge_fields("j", F.lit(None).cast(md.FIELD_TYPE)).alias("f")).first().f
    assert only.title == "J" and only.authors == ["Alice Smith"]
