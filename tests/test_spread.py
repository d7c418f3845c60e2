"""Work on rows of small files: every core has a part of it, and none is done before the rows are dealt out."""

import os

import pytest
from pyspark.sql import functions as F

from scholarloom.operators import jats
from scholarloom.plans import article_queries, papers, queries
from scholarloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", ["q33_meta_select", "q34_meta_fields", "q46_jats_markdown", "q47_jats_front", "q48_partial_xml", "q63_publisher_markdown"])
def test_rows_are_spread(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    below = df._jdf.queryExecution().optimizedPlan().toString().split("Repartition", 1)[1]
    assert "parse_json" not in below and "concat" not in below


def test_only_wanted_parts():
    table = '<article><body><sec><table-wrap><table><tbody><tr><td{}>1</td></tr></tbody></table></table-wrap></sec></body></article>'
    for span in ("", ' rowspan="1"', ' colspan="2"'):
        whole = jats.read_article(table.format(span))
        for part in jats.PARTS:
            one = jats.read_article(table.format(span), parts=(part,))
            assert one[part] == whole[part] and all(one[p] is None for p in jats.PARTS if p not in (part, "render_error"))
    assert jats.read_article(table.format(' colspan="2"'), parts=("render_error",))["render_error"] == "a table has spanning cells"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_run_is_dealt(spark, monkeypatch):
    monkeypatch.setattr(article_queries, "process", lambda dois, artifacts, options: (dois, artifacts.where("kind = 'publisher_xml'")))
    for df in article_queries._run(spark, SF):
        assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    monkeypatch.setattr(article_queries, "RUN_ROWS", 10)
    assert article_queries._run(spark, SF)[0].rdd.getNumPartitions() == -(-spark.read.parquet(f"{SF}/customer.parquet").count() // 10)


def test_best_candidates_without_sorting_texts(spark):
    work = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, "d"), (6, None)], "index long, doi string")
    work = work.selectExpr("index", "concat('raw', index) AS doi_raw", "doi", "if(doi is null, 'odd', null) AS doi_error", "'nature' AS route", "doi is not null AS supported")
    rows = [("a", 2, True, "late"), ("a", 1, False, "bad"), ("a", 2, True, "late"), ("b", 9, True, "last"), ("b", 3, True, "first"), ("c", 1, False, "bad")]
    given = spark.createDataFrame(rows, "doi string, priority int, ok boolean, source string").withColumn("markdown", F.concat(F.lit("text of "), "source")).withColumn("failures", F.array(F.lit("f")))
    types = dict(c.split() for c in papers.RESULT.split(", "))
    out = papers.Batch(work, work)._joined(work, given.select(*[(F.col(c) if c in given.columns else F.lit(None)).cast(types[c]).alias(c) for c in papers.COLUMNS]))
    got = {r["index"]: (r["doi"], r["source"], r["markdown"], r["fallback_reason"]) for r in out.collect()}
    assert out.count() == 6 and got == {
        1: ("a", "late", "text of late", "f"), 2: ("a", "late", "text of late", "f"), 3: ("b", "first", "text of first", None), 4: ("c", None, None, "f"), 5: ("d", None, None, None), 6: ("raw6", None, None, None),
    }
    alone = out._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(alone) if "ShuffledHashJoin" in line)
    assert "LeftOuter, BuildLeft" in alone[at] and not any("Sort" in line and "markdown" in line for line in alone[:at])


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", ["q19_table_numeric_audit", "q22_table_markdown", "q23_table_source_cells"])
def test_table_rows_are_dealt(spark, monkeypatch, name):
    monkeypatch.setattr(queries, "TABLE_ROWS", 100)
    parts = -(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 100)
    df = queries.QUERIES[name](spark, SF)
    assert df.rdd.getNumPartitions() == parts
    first = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert first.count("Exchange") == 1


def test_cells_of_prefixed_names():
    for ns in ('xmlns:p="u"', 'xmlns = "u"', 'xmlns:p="u" xmlns:q="v"'):
        name = "p:td" if "p=" in ns else "td"
        text = f"<article {ns}><body><table-wrap><table><tbody><tr><{name}> a|b </{name}><{name}/></tr></tbody></table></table-wrap></body></article>"
        assert jats.read_article(text)["cells"] == ["a|b", ""]
    assert jats.pipe_table([["a|b"]], [["1", "2|\n"], []]) == "| a\\|b |  |\n| --- | --- |\n| 1 | 2\\|  |\n|  |  |"
