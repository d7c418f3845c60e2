from pyspark.sql import functions as F

from scholarloom.functions.text import structured_numbers
from scholarloom.operators import audit, jats, markdown_clean, publisher_xml

P = "<p>" + "word " * 110 + "</p>"
ARTICLE = f"""<?xml version="1.0"?><!DOCTYPE article [<!ENTITY x "y">]><article xmlns:xlink="http://www.w3.org/1999/xlink"><front><article-meta><journal-title>Journal</journal-title><article-id pub-id-type="doi">10.1038/A1</article-id>
<article-title>A <italic>fine</italic> title</article-title><contrib contrib-type="author"><name><surname>Doe</surname><given-names>Jo</given-names></name></contrib><contrib contrib-type="editor"><name><surname>Ed</surname></name></contrib>
<pub-date date-type="pub"><day>5</day><month>3</month><year>2020</year></pub-date><abstract abstract-type="short"><p>no</p></abstract><abstract><p>Two <sub>x</sub>.</p></abstract></article-meta></front>
<body><p>Loose.</p><sec><title>Intro</title>{P * 6}<sec><title>Deep</title>{P * 5}<p>Text<sup><xref ref-type="bibr">1</xref></sup> m<sup>2</sup> <!-- c -->tail <ext-link xlink:href="http://u"/> <inline-formula><alternatives><tex-math>\\begin{{document}}$$a_1$$\\end{{document}}</tex-math><math>a1</math></alternatives></inline-formula> before
<disp-formula>gone</disp-formula> after <list list-type="order"><list-item><p>one</p></list-item><list-item><p> </p></list-item><list-item><p>three</p></list-item></list></p></sec></sec>
<sec><title>Results</title><table-wrap><label>Table 1</label><caption><p>Values</p></caption><table><thead><tr><th>A</th><th>B</th></tr></thead><tbody><tr><td>18.5</td><td/></tr><tr><td>p &lt; 0.05</td><td>a|b</td></tr></tbody></table></table-wrap>
<fig><label>Fig. 1.</label><caption><p>Cap</p></caption><graphic/></fig><boxed-text><p>dropped</p></boxed-text></sec></body>
<back><ack><p>Thanks.</p></ack><ref-list><ref><label>1.</label><mixed-citation><name><surname>Doe</surname><given-names>J</given-names></name><etal/> Paper <year>2020</year></mixed-citation></ref></ref-list></back></article>"""


def test_jats(spark):
    df = jats.read_jats(spark.createDataFrame([(1, ARTICLE)], "id int, xml string"))
    r = df.first()
    m = r.markdown
    assert m.startswith("# A fine title\n\n- DOI: 10.1038/A1\n- Journal: Journal\n- Published: 2020-03-05\n- Authors: Jo Doe\n\n## Abstract\n\nTwo <sub>x</sub>.\n\n## Intro\n\n")
    for part in ("### Deep", "Text[1] m<sup>2</sup> tail http://u $a_1$ before\n\nafter\n\n1. one\n3. three", "**Table 1.** Values\n\n| A | B |\n| --- | --- |\n| 18.5 |  |\n| p < 0.05 | a\\|b |", "**Fig. 1.** Cap", "## Acknowledgements\n\nThanks.", "## References\n\n1. Doe J et al. Paper 2020\n"):
        assert part in m, part
    assert "gone" not in m and "dropped" not in m and m.index("## Results") < m.index("Loose.") < m.index("## Acknowledgements")
    s = r.stats
    assert (s.doi, s.section_count, s.paragraph_count, s.reference_count, s.table_count, s.figure_count, s.display_formula_count, s.candidate_full_text) == ("10.1038/a1", 3, 19, 1, 1, 1, 1, True)
    got = df.select(F.flatten(F.transform("cells", structured_numbers)).alias("a"), audit.markdown_numbers("markdown").alias("b")).first()
    assert got.a == got.b == ["18.5", "< 0.05"]
    gate = audit.jats_gate(df.select("stats.reference_count", "stats.table_count", F.lit(False).alias("values_match"))).first()
    assert gate.fallback_reason == "jats_table_numeric_values_mismatch" and gate.status == "success"


def test_jats_errors(spark):
    spans = "<article><body><table-wrap><table><tr><td rowspan='2'>1</td></tr></table></table-wrap><sec><table-wrap><table><tr><td colspan='3'/></tr></table></table-wrap></sec></body></article>"
    rows = jats.read_jats(spark.createDataFrame([("<broken>",), ("<r><article/><article/></r>",), (spans,), (None,), ("",), ("<response><article><body/></article></response>",)], "xml string")).collect()
    assert [r.error for r in rows] == ["not_well_formed", "expected one article, found 2", None, "not_well_formed", "not_well_formed", None]
    assert rows[2].render_error and rows[5].markdown == "# Untitled article\n"
    picked = jats.pick_articles(spark.createDataFrame([("<r><article><article-id pub-id-type='doi'> 10.1/A </article-id></article><article/></r>", "10.1/a"), ("<r/>", "10.1/a")], "response_xml string, doi string")).collect()
    assert picked[0].article_count == 2 and "10.1/A" in picked[0].article_xml and picked[1].article_xml is None


def xml(n_para=13, root="full-text-retrieval-response"):
    return f"<{root} xmlns:ce='u'><ce:sections>" + "<ce:section><ce:section-title>S</ce:section-title>" + "<ce:para>" + "x" * 500 + "</ce:para>" * 1 + "<ce:para>y</ce:para>" * (n_para - 1) + "</ce:section><ce:section/></ce:sections>" + "z" * 6000 + f"<bib-reference>r</bib-reference></{root}>"


def test_publisher_xml(spark):
    r, thin, broken = publisher_xml.read_publisher_xml(spark.createDataFrame([(xml(),), ("<abstract-response/>",), ("<a",)], "xml string")).collect()
    assert r.is_full_text and (r.section_count, r.paragraph_count, r.reference_count) == (2, 13, 1)
    assert thin.reason == "unexpected root element: abstract-response; too few sections: 0; too few paragraphs: 0; too little textual content: 0 chars"
    assert broken.xml_error and not broken.is_full_text


def test_expectation_and_floats(spark):
    web = "<r><web-pdf><web-pdf-purpose>SUPPLEMENT</web-pdf-purpose><filename>s.pdf</filename></web-pdf><web-pdf><web-pdf-purpose>main</web-pdf-purpose><filename>m.pdf</filename><web-pdf-page-count>23</web-pdf-page-count><filesize>11180168</filesize></web-pdf></r>"
    r = publisher_xml.read_publisher_xml(spark.createDataFrame([(web,)], "xml string")).first()
    assert (r.expectation.filename, r.expectation.expected_pages, r.expectation.expected_bytes) == ("m.pdf", 23, 11180168)
    floats = "<r><float-anchor refid='t1'/><float-anchor refid='t2'/><float-anchor refid='t3'/><float-anchor/><table id='t2'><link locator='fx'/></table><table id='t3'><link/><tgroup><row/></tgroup></table></r>"
    d = publisher_xml.read_publisher_xml(spark.createDataFrame([(floats,)], "xml string"))
    m = publisher_xml.missing_tables(d.withColumn("missing", F.col("float_table_ids"))).first()
    assert m.image_only_float_table_ids == ["t2"] and m.missing_float_table_ids == ["t1", "t3"]


def test_own_markdown_is_what_the_cleaner_reads(spark):
    source = (
        "<full-text-retrieval-response><title>T</title><section><label>1</label><section-title>Results</section-title><para>See <cross-ref refid='t1'>Table 1</cross-ref>.</para><para>After <display><formula id='e1'><math>x</math></formula></display></para></section>"
        "<float-anchor refid='t1'/><table id='t1'><label>Table 1</label><caption>Cap</caption><tgroup><thead><row><entry>A</entry></row></thead><tbody><row><entry><bold>1.5</bold></entry></row></tbody></tgroup></table>"
        "<bibliography><bib-reference id='b1'>Ref one</bib-reference></bibliography></full-text-retrieval-response>"
    )
    r = markdown_clean.clean(publisher_xml.read_publisher_xml(spark.createDataFrame([(source,)], "xml string"))).first()
    assert r.display_equations_removed == 1 and r.remaining_display_math == 0 and r.missing == [] and r.has_references and r.has_results and r.reference_count_markdown == 1 and r.table_count_markdown == 1
    assert "| 1.5 |" in r.llm_markdown and r.llm_markdown.index("See [Table 1](#t1).") < r.llm_markdown.index('<a id="t1"></a>') < r.llm_markdown.index("After") and r.relocated == ["t1"]
