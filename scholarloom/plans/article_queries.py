"""Queries of gates, articles, metadata, requests and whole runs, see queries.py."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as tx
from ..functions.rows import dealt, spread
from ..operators import audit, blocks, jats, markdown_clean, metadata, publisher_xml
from ..sources.landed import with_page_count
from ..sources.requests import KINDS, pdf_requests, requests
from .papers import Options, numbered, process, qa_json, sources_used
from .queries import DOI_SQL, _dois, query, read

# Gates.

CONTENT_FLAGS = """o_orderkey, o_orderkey % 2 <> 0 AS table_content_exact_match, o_orderkey % 3 <> 0 AS table_numeric_values_match, o_orderkey % 5 <> 0 AS has_references, CAST(o_orderkey % 7 = 0 AS BIGINT) AS remaining_images, CAST(o_orderkey % 11 = 0 AS BIGINT) AS remaining_base64,
    CAST(o_orderkey % 13 = 0 AS BIGINT) AS remaining_display_equations, o_orderkey % 17 = 0 AS mojibake, CAST(o_orderkey % 4 = 1 AS BIGINT) AS private_use_characters, CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_full_document"""
UNKNOWN = "o_orderkey % 6 = 1"


def _codes(*checks: str) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {test} THEN '{code}' END" for code, test in (c.split(": ") for c in checks)) + ")"


CONTENT_FAILURES = _codes("table_content_mismatch: NOT table_content_exact_match", "table_numeric_values_mismatch: NOT table_numeric_values_match", "references_missing: NOT has_references", "remaining_images: remaining_images > 0", "remaining_base64: remaining_base64 > 0", "remaining_display_equations: remaining_display_equations > 0", "mojibake: mojibake")
CONTENT_WARNINGS = _codes("private_use_characters: private_use_characters > 0", f"unknown_block_types: {UNKNOWN}", "mineru_not_marked_full_document: is_full_document = false")


def _status_sql(rows: str) -> str:
    return f"SELECT *, CASE WHEN failures <> '' THEN 'failed' WHEN warnings <> '' THEN 'warning' ELSE 'success' END AS status FROM ({rows})"


def _joined(*columns: str) -> list[Column]:
    return [F.array_join(c, ",").alias(c) for c in columns]


@query(_status_sql(f"SELECT o_orderkey, {CONTENT_FAILURES} AS failures, {CONTENT_WARNINGS} AS warnings FROM (SELECT {CONTENT_FLAGS} FROM orders)"))
def q42_content_gate(spark, sf_dir):
    d = read(spark, sf_dir, "orders").selectExpr(*[x.strip() for x in CONTENT_FLAGS.split(",")], f"IF({UNKNOWN}, array('odd'), array()) AS unknown_block_types")
    return audit.content_gate(d).select("o_orderkey", *_joined("failures", "warnings"), "status")


@query(_status_sql(f"""SELECT o_orderkey, {_codes("display_math_remaining: o_orderkey % 2 = 0", "missing_float_tables: o_orderkey % 3 = 0", "references_missing: o_orderkey % 4 > 0 AND o_orderkey % 5 = 0")} AS failures,
    {_codes("image_only_tables: o_orderkey % 7 = 0", "reference_count_mismatch: o_orderkey % 4 > 0 AND o_orderkey % 4 <> o_orderkey % 3")} AS warnings FROM orders"""))
def q43_publisher_gate(spark, sf_dir):
    d = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("cast(o_orderkey % 2 = 0 as bigint)").alias("remaining_display_math"), F.expr("if(o_orderkey % 3 = 0, array('t1'), array())").alias("missing_float_table_ids"), F.expr("if(o_orderkey % 7 = 0, array('t2'), array())").alias("image_only_float_table_ids"),
        F.expr("o_orderkey % 4").alias("reference_count"), F.expr("o_orderkey % 3").alias("reference_count_markdown"), F.expr("o_orderkey % 5 <> 0").alias("has_references"),
    )
    return audit.publisher_gate(d).select("o_orderkey", *_joined("failures", "warnings"), "status")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 AND o_orderkey % 2 = 0 THEN 'jats_table_numeric_values_mismatch' END AS fallback_reason, CASE WHEN o_orderkey % 4 = 0 THEN 'references_not_detected' ELSE '' END AS warnings,
    CASE WHEN o_orderkey % 4 = 0 THEN 'warning' ELSE 'success' END AS status FROM orders""")
def q44_jats_gate(spark, sf_dir):
    d = read(spark, sf_dir, "orders").select("o_orderkey", F.expr("o_orderkey % 3").alias("table_count"), F.expr("o_orderkey % 2 <> 0").alias("values_match"), F.expr("o_orderkey % 4").alias("reference_count"))
    return audit.jats_gate(d).select("o_orderkey", "fallback_reason", *_joined("warnings"), "status")


# Articles.

RESPONSE = """CASE WHEN o_orderkey % 5 = 0 THEN 'no xml' ELSE concat('<response><records><article><front><article-id pub-id-type="pmid">10.1/K', o_orderkey, '</article-id></front></article>',
    CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('<article n="2"><article-id pub-id-type="doi"> 10.1/K', o_orderkey, ' </article-id><b>&amp;</b></article>tail') END, '</records></response>') END"""


@query("""SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 5 = 0 THEN 0 WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS INTEGER) AS article_count,
    CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 3 > 0 THEN '<article n="2"><article-id pub-id-type="doi"> 10.1/K' || o_orderkey || ' </article-id><b>&amp;</b></article>' END AS article_xml FROM orders""")
def q45_jats_pick(spark, sf_dir):
    d = read(spark, sf_dir, "orders").select("o_orderkey", F.expr(RESPONSE).alias("response_xml"), F.expr("concat('10.1/k', o_orderkey)").alias("doi"))
    return jats.pick_articles(d).select("o_orderkey", "article_count", "article_xml")


ARTICLE = """concat('<?xml version="1.0"?><!DOCTYPE article><article xmlns:xlink="http://www.w3.org/1999/xlink"><front><journal-meta><journal-title>Journal of ', p_brand, '</journal-title></journal-meta><article-meta>',
    '<article-id pub-id-type="doi">10.1/', p_partkey, '</article-id><title-group><article-title>On <italic>', p_name, '</italic></article-title></title-group>',
    '<contrib contrib-type="author"><name><surname>Doe</surname><given-names>Jo ', p_size, '</given-names></name></contrib><contrib contrib-type="editor"><name><surname>Ed</surname></name></contrib><contrib contrib-type="author"><name><surname>Roe</surname></name></contrib>',
    '<pub-date date-type="pub">', CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '<day>3</day>' END, '<month>', p_size % 12 + 1, '</month><year>2020</year></pub-date>',
    '<abstract abstract-type="short"><p>no</p></abstract><abstract><p>One <sub>', p_size, '</sub>.</p><p>Two.</p></abstract></article-meta></front><body><p>Loose ', p_partkey, '.</p><sec><title>First</title><p>Text<sup><xref ref-type="bibr">', p_size, '</xref></sup> m<sup>2</sup>',
    ' at <ext-link xlink:href="http://u/', p_partkey, '"/> <inline-formula><alternatives><tex-math>\\\\begin{document}$a_', p_size, '$\\\\end{document}</tex-math><math>x</math></alternatives></inline-formula> before <disp-formula>gone</disp-formula> mid ',
    '<list list-type="', CASE WHEN p_partkey % 2 = 0 THEN 'order' ELSE 'bullet' END, '"><list-item><p>', p_type, '</p></list-item><list-item><p> </p></list-item><list-item>last</list-item></list> end</p><sec><title>Deep</title><sec><p>Under.</p></sec></sec></sec>',
    '<sec><title>Results</title><fig><label>Fig. ', p_size, '</label><caption><p>Cap <bold>b</bold></p></caption><graphic/></fig><boxed-text><p>dropped</p></boxed-text></sec></body>',
    '<back><ack><p>Thanks, ', p_brand, '.</p></ack><sec><title>Data</title><p>None.</p></sec><ref-list><ref><label>', p_size, '</label><mixed-citation><name><surname>Doe</surname><given-names>J</given-names></name><etal/> On ', p_name, ' <year>2020</year></mixed-citation></ref>',
    '<ref><element-citation><source>S</source></element-citation></ref></ref-list></back></article>')"""
PUBLISHED = "'2020-' || lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0') || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '-03' END"


def _part_articles(spark, sf_dir, part):
    p = spread(read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    return jats.read_jats(p.select("p_partkey", F.expr(ARTICLE).alias("xml")), parts=(part,))


@query(f"""SELECT p_partkey, '# On ' || p_name || x || x || '- DOI: 10.1/' || p_partkey || x || '- Journal: Journal of ' || p_brand || x || '- Published: ' || {PUBLISHED} || x || '- Authors: Jo ' || p_size || ' Doe, Roe' || x || x || '## Abstract' || x || x || 'One <sub>' || p_size || '</sub>.' || x || x || 'Two.'
    || x || x || '## First' || x || x || 'Text[' || p_size || '] m<sup>2</sup> at http://u/' || p_partkey || ' $a_' || p_size || '$ before' || x || x || 'mid' || x || x
    || CASE WHEN p_partkey % 2 = 0 THEN '1. ' || p_type || x || '3. last' ELSE '- ' || p_type || x || '- last' END || x || x || 'end' || x || x || '### Deep' || x || x || 'Under.' || x || x || '## Results' || x || x || '**Fig. ' || p_size || '.** Cap b' || x || x || 'Loose ' || p_partkey || '.'
    || x || x || '## Acknowledgements' || x || x || 'Thanks, ' || p_brand || '.' || x || x || '## Data' || x || x || 'None.' || x || x || '## References' || x || x || p_size || ' Doe J et al. On ' || p_name || ' 2020' || x || x || 'S' || x AS markdown FROM part, (SELECT chr(10) AS x)""")
def q46_jats_markdown(spark, sf_dir):
    return _part_articles(spark, sf_dir, "markdown").select("p_partkey", "markdown")


@query(f"""SELECT p_partkey, 'On ' || p_name AS title, '- DOI: 10.1/' || p_partkey || '|- Journal: Journal of ' || p_brand || '|- Published: ' || {PUBLISHED} || '|- Authors: Jo ' || p_size || ' Doe, Roe' AS facts,
    'One <sub>' || p_size || '</sub>.' || chr(10) || chr(10) || 'Two.' AS abstract, '1:On ' || p_name || '|2:Abstract|2:First|3:Deep|2:Results|2:Acknowledgements|2:Data|2:References' AS headings FROM part""")
def q47_jats_front(spark, sf_dir):
    d = _part_articles(spark, sf_dir, "blocks")
    of = lambda kind: F.filter("blocks", lambda b: b["kind"] == kind)
    text = lambda c: F.transform(c, lambda b: b["text"])
    return d.select(
        "p_partkey", F.get(text(of("heading")), F.lit(0)).alias("title"), F.array_join(text(of("fact")), "|").alias("facts"), F.get(text(of("text")), F.lit(0)).alias("abstract"),
        F.array_join(F.transform(of("heading"), lambda b: F.concat_ws(":", b["level"].cast("string"), b["text"])), "|").alias("headings"),
    )


PARTIAL = """concat('<a><journal-title> J', c_nationkey, '</journal-title><article-id>https://doi.org/10.1234/C', c_custkey, '</article-id><article-title>', CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE concat('About <i>', c_name, '</i>') END, '</article-title><title>Other</title>',
    CASE WHEN c_custkey % 2 = 0 THEN '<creator> A, B </creator><creator>C</creator><creator>C</creator>' ELSE '' END, '<contrib contrib-type="Author"><surname>Doe</surname><given-names>Jo</given-names></contrib><contrib contrib-type="editor"><surname>E</surname></contrib><contrib>Group</contrib>',
    '<pub-date><year> </year></pub-date><pub-date><year>2021</year><month>5</month></pub-date><volume>', c_nationkey, '</volume><issueId>i</issueId><fpage>', c_custkey, '</fpage><lpage>', c_custkey + c_custkey % 2, '</lpage><publisher-name>P</publisher-name><abstract><p>Text</p> <p>more</p></abstract>',
    '<kwd>k</kwd><kwd> k </kwd><keyword>', c_mktsegment, '</keyword><openAccess>true</openAccess><license-p>L</license-p><url><format>x</format><value>ftp://no</value></url>', CASE WHEN c_custkey % 5 = 0 THEN '' ELSE concat('<url>http://u/', c_custkey, '</url>') END,
    '<self-uri xmlns:l="http://www.w3.org/1999/xlink" l:href="https://self/', c_custkey, '"/></a>')"""


@query("""SELECT c_custkey, c_custkey % 4 > 0 AS has_doi, CASE WHEN c_custkey % 4 > 0 THEN CASE WHEN c_custkey % 3 = 0 THEN 'Other' ELSE 'About ' || c_name END END AS title, CASE WHEN c_custkey % 4 > 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'A, B;C' ELSE 'Jo Doe;Group' END END AS authors,
    CASE WHEN c_custkey % 4 > 0 THEN 'J' || c_nationkey END AS journal, CASE WHEN c_custkey % 4 > 0 THEN '2021-5' END AS publication_date, CASE WHEN c_custkey % 4 > 0 THEN CAST(c_nationkey AS VARCHAR) END AS volume, CASE WHEN c_custkey % 4 > 0 THEN 'i' END AS issue,
    CASE WHEN c_custkey % 4 > 0 THEN c_custkey || CASE WHEN c_custkey % 2 = 1 THEN '-' || (c_custkey + 1) ELSE '' END END AS pages, CASE WHEN c_custkey % 4 > 0 THEN 'P' END AS publisher, CASE WHEN c_custkey % 4 > 0 THEN 'Text more' END AS abstract,
    CASE WHEN c_custkey % 4 > 0 THEN 'k;' || c_mktsegment END AS keywords, CASE WHEN c_custkey % 4 > 0 THEN 'true' END AS open_access, CASE WHEN c_custkey % 4 > 0 THEN 'L' END AS copyright,
    CASE WHEN c_custkey % 4 > 0 THEN CASE WHEN c_custkey % 5 = 0 THEN 'https://self/' || c_custkey ELSE 'http://u/' || c_custkey END END AS url FROM customer""")
def q48_partial_xml(spark, sf_dir):
    c = spread(read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    d = c.select("c_custkey", F.expr(PARTIAL).alias("xml"), F.expr("concat('10.1234/c', c_custkey, if(c_custkey % 4 = 0, 'x', ''))").alias("doi"))
    p = metadata.read_partial(d)
    return p.select("c_custkey", F.col("partial").isNotNull().alias("has_doi"), *[(F.array_join(f"partial.{f}", ";") if f in metadata.LISTS else F.col(f"partial.{f}")).alias(f) for f in metadata.FIELDS])


WEB_PDFS = """concat('<r><web-pdf><web-pdf-purpose>SUPPLEMENT</web-pdf-purpose><filename>s.pdf</filename><web-pdf-page-count>1</web-pdf-page-count></web-pdf>', CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('<web-pdf><attachment-eid>e', o_orderkey, '</attachment-eid><web-pdf-purpose> main </web-pdf-purpose><filename>m.pdf</filename><web-pdf-page-count>',
    CASE WHEN o_orderkey % 4 = 0 THEN 'many' ELSE concat(' ', o_orderkey % 50) END, '</web-pdf-page-count><filesize>', o_orderkey, '</filesize></web-pdf>') END, '</r>')"""


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN 'e' || o_orderkey END AS attachment_eid, CASE WHEN o_orderkey % 3 = 0 THEN 's.pdf' ELSE 'm.pdf' END AS filename,
    CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 4 > 0 THEN o_orderkey % 50 END AS BIGINT) AS expected_pages, CAST(CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS BIGINT) AS expected_bytes FROM orders""")
def q49_pdf_expectation(spark, sf_dir):
    return publisher_xml.read_publisher_xml(read(spark, sf_dir, "orders").select("o_orderkey", F.expr(WEB_PDFS).alias("xml")), markdown=False).select("o_orderkey", "expectation.*")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS index FROM orders WHERE o_orderkey % 3 > 0")
def q50_numbering(spark, sf_dir):
    return numbered(read(spark, sf_dir, "orders").where("o_orderkey % 3 > 0").select("o_orderkey"), "o_orderkey")


# Functions.

TEX = r"""CASE o_orderkey % 7 WHEN 0 THEN concat(' $x_', o_orderkey, '$ ') WHEN 1 THEN concat('\documentclass[12pt]{minimal} \usepackage{amsmath} \setlength{\oddsidemargin}{-69pt} \begin{document}$$ y  ', o_orderkey, ' $$\end{document}')
    WHEN 2 THEN concat('\(a+', o_orderkey, '\)') WHEN 3 THEN concat('\[ b ', o_orderkey, '\]') WHEN 4 THEN concat('\usepackage{x} c', o_orderkey) WHEN 5 THEN concat('$', o_orderkey) ELSE '' END"""


@query(r"""SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'x_' || o_orderkey WHEN 1 THEN 'y ' || o_orderkey WHEN 2 THEN 'a+' || o_orderkey WHEN 3 THEN 'b ' || o_orderkey WHEN 4 THEN 'c' || o_orderkey WHEN 5 THEN '$' || o_orderkey ELSE '' END AS tex FROM orders""")
def q51_inline_tex(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", tx.inline_tex(F.expr(TEX.replace("\\", "\\\\"))).alias("tex"))


BASE = "concat('https://h.org/a/b', page_id, '.html?x=1#y')"
HREF = "CASE page_id % 6 WHEN 0 THEN concat('/r/', page_id, '.pdf') WHEN 1 THEN concat('s', page_id, '.pdf?q=1') WHEN 2 THEN concat('http://o.net/', page_id) WHEN 3 THEN concat('//cdn/', page_id) WHEN 4 THEN ' ' ELSE concat('d/%7Ee+', page_id) END"


@query("""SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'https://h.org/r/' || page_id || '.pdf' WHEN 1 THEN 'https://h.org/a/s' || page_id || '.pdf?q=1' WHEN 2 THEN 'http://o.net/' || page_id WHEN 3 THEN 'https://cdn/' || page_id WHEN 4 THEN 'https://h.org/a/b' || page_id || '.html?x=1#y'
    ELSE 'https://h.org/a/d/%7Ee+' || page_id END AS url, CASE page_id % 6 WHEN 5 THEN 'd/~e+' || page_id END AS plain FROM pages""")
def q52_url_join(spark, sf_dir):
    p = read(spark, sf_dir, "pages").select("page_id", F.expr(BASE).alias("base"), F.expr(HREF).alias("href"))
    return p.select("page_id", ids.join_url("base", "href").alias("url"), F.when(F.col("page_id") % 6 == 5, ids.unquote(F.col("href"))).alias("plain"))


PDF_FILE = """CASE WHEN o_orderkey % 6 = 0 THEN concat('<html>', o_orderkey) WHEN o_orderkey % 6 = 1 THEN concat('%PDF-1.4 /Type /Page ', o_orderkey) WHEN o_orderkey % 6 = 2 THEN '%PDF-1.4 /Encrypt /Type /Page %%EOF'
    ELSE concat('%PDF-1.7', chr(10), '1 0 obj << /Type /Pages /Count 9 >> endobj', chr(10), repeat('<< /Type/Page /R 1 >> ', CAST(o_orderkey % 40 AS INT)), 'trailer', chr(10), '%%EOF', chr(10)) END"""


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 6 < 3 THEN NULL ELSE o_orderkey % 40 END AS BIGINT) AS actual_pages FROM orders")
def q53_pdf_page_count(spark, sf_dir):
    d = read(spark, sf_dir, "orders").select("o_orderkey", F.expr(PDF_FILE).cast("binary").alias("content"))
    return with_page_count(d).select("o_orderkey", "actual_pages")


CONTENT_JSON = """CASE o_orderkey % 6 WHEN 0 THEN '[]' WHEN 1 THEN concat('{"pages": [{"page_idx": ', o_orderkey, ', "blocks": []}]}') WHEN 2 THEN '{"pages": 5}' WHEN 3 THEN '{"x": 1}' WHEN 4 THEN 'no json' ELSE '{"pages": []}' END"""


@query("SELECT o_orderkey, o_orderkey % 6 IN (1, 5) AS valid FROM orders")
def q54_content_valid(spark, sf_dir):
    d = read(spark, sf_dir, "orders").select("o_orderkey", blocks.parse_content(F.expr(CONTENT_JSON)).alias("c"))
    return d.select("o_orderkey", blocks.is_valid("c").alias("valid"))


@query("SELECT o_orderkey, o_orderkey % 3 = 0 AS inside FROM orders")
def q55_file_in_directory(spark, sf_dir):
    d = read(spark, sf_dir, "orders").select("o_orderkey", F.expr("concat('/lib/p', o_custkey, CASE o_orderkey % 3 WHEN 0 THEN '/a b.PDF' WHEN 1 THEN '/sub/a.pdf' ELSE '0/a.pdf' END)").alias("path"), F.expr("concat('/lib/p', o_custkey, '/')").alias("directory"))
    return d.select("o_orderkey", ids.directly_in("path", "directory").alias("inside"))


ANCHORED = """concat('<a id="t', o_orderkey % 3, '"></a> x <a id="t', o_orderkey % 2, '"></a>', chr(10), '<a id="b', o_orderkey % 5, '"></a>', chr(10), '<a id="b9"></a>  ', chr(10), ' <a id="b8"></a>', chr(10), '<a id="b9"></a>')"""


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = o_orderkey % 2 THEN 1 ELSE 2 END AS BIGINT) AS tables, CAST(2 AS BIGINT) AS reference_anchors FROM orders")
def q56_anchor_counts(spark, sf_dir):
    d = read(spark, sf_dir, "orders").select("o_orderkey", F.expr(ANCHORED).alias("m"))
    return d.select("o_orderkey", audit.anchor_count("m", markdown_clean.TABLE_ANCHOR).alias("tables"), audit.anchor_count("m", markdown_clean.REFERENCE_ANCHOR).alias("reference_anchors"))


WHOLE = "CASE o_orderkey % 6 WHEN 0 THEN concat(' ', o_orderkey, ' ') WHEN 1 THEN concat('-', o_orderkey) WHEN 2 THEN concat(o_orderkey, '.0') WHEN 3 THEN '' WHEN 4 THEN concat('+', o_orderkey) ELSE 'x' END"


@query("SELECT o_orderkey, CAST(CASE o_orderkey % 6 WHEN 0 THEN o_orderkey WHEN 1 THEN -o_orderkey WHEN 4 THEN o_orderkey END AS BIGINT) AS whole FROM orders")
def q57_safe_whole_number(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", tx.safe_long(F.expr(WHOLE)).alias("whole"))


# Whole runs.

#: Entries a part: a task holds the articles of so many.
RUN_ROWS = 20_000
RUN_DOI = "CASE c_custkey % 8 WHEN 0 THEN concat('10.1038/s', c_custkey) WHEN 1 THEN concat('10.1007/s12273-', c_custkey) WHEN 2 THEN concat('10.1016/p', c_custkey) WHEN 3 THEN concat('DOI:10.1038/S', c_custkey) WHEN 4 THEN concat('10.1007/s12273-', c_custkey) WHEN 5 THEN concat('10.5555/', c_custkey) WHEN 6 THEN concat('bad ', c_custkey) ELSE concat('10.1016/q', c_custkey) END"
ONE_PAGE = "'%PDF-1.7 /Type /Page %%EOF'"
RUN_CONTENT = """concat('{"is_full_document": true, "pages": [{"blocks": [{"type": "doc_title", "content": "Paper ', c_custkey, '"}, {"type": "paragraph_title", "content": "References"}]}]}')"""
RUN_XML = """concat('<full-text-retrieval-response><title>P', c_custkey, '</title><section><section-title>Results</section-title>', repeat(concat('<para>', repeat('word ', 99), c_custkey, '</para>'), 12), '</section><section/></full-text-retrieval-response>')"""
RUN_META = """concat('{"records": [{"doi": "10.1007/s12273-', c_custkey, '", "title": "Meta ', c_custkey, '"}]}')"""


def _run(spark, sf_dir):
    c = dealt(read(spark, sf_dir, "customer").select("c_custkey"), RUN_ROWS).select("c_custkey", F.expr(RUN_DOI).alias("doi_raw"))
    made = lambda rest, kind, data: c.where(f"c_custkey % 8 = {rest}").select(ids.normalize_doi("doi_raw").alias("doi"), F.lit(kind).alias("kind"), F.expr(data).cast("binary").alias("content"))
    a = made(0, "local_pdf", ONE_PAGE)
    for rest, kind, data in ((0, "content_json", RUN_CONTENT), (1, "explicit_pdf", ONE_PAGE), (1, "content_json", RUN_CONTENT), (2, "publisher_xml", RUN_XML), (3, "local_pdf", "'<html>'"), (4, "metadata_json", RUN_META), (7, "publisher_xml", "'<abstract-response/>'")):
        a = a.unionByName(made(rest, kind, data))
    return process(c.select(F.col("c_custkey").alias("pos"), "doi_raw"), a, Options("lib"))


RUN_SQL = f"""r AS (SELECT c_custkey, c_custkey % 8 AS k, CASE c_custkey % 8 WHEN 3 THEN '10.1038/s' || c_custkey ELSE {RUN_DOI} END AS doi FROM customer),
    s AS (SELECT *, CASE k WHEN 0 THEN 'local_pdf_mineru' WHEN 1 THEN 'local_pdf_mineru' WHEN 2 THEN 'elsevier_xml' WHEN 3 THEN 'springer_restricted_partial' WHEN 4 THEN 'springer_restricted_partial' END AS source FROM r)"""


@query(f"""WITH {RUN_SQL} SELECT c_custkey + 1 AS index, doi, CASE k WHEN 0 THEN 'nature' WHEN 3 THEN 'nature' WHEN 1 THEN 'building_simulation' WHEN 4 THEN 'building_simulation' WHEN 2 THEN 'elsevier' WHEN 7 THEN 'elsevier' WHEN 5 THEN 'unsupported' END AS route, source,
    CASE WHEN k < 3 THEN 'success' WHEN k < 5 THEN 'warning' END AS status, CASE WHEN k IN (0, 3, 4) THEN true WHEN k IN (1, 2) THEN false END AS fallback_used,
    CASE k WHEN 0 THEN '# Paper ' || c_custkey WHEN 1 THEN '# Paper ' || c_custkey WHEN 2 THEN '# P' || c_custkey WHEN 3 THEN '# ' || doi WHEN 4 THEN '# Meta ' || c_custkey END AS first_line,
    CASE k WHEN 5 THEN 'unsupported route' WHEN 6 THEN 'invalid DOI: invalid' WHEN 7 THEN 'no usable source: elsevier_xml_not_full_text' END AS error FROM s""")
def q58_process(spark, sf_dir):
    return _run(spark, sf_dir).select("index", "doi", "route", "source", "status", "fallback_used", F.substring_index("markdown", "\n", 1).alias("first_line"), "error")


@query("""SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 2 = 0 THEN 'partial_jats_xml' END, CASE WHEN c_custkey % 3 = 0 THEN 'springer_meta_v2' END) AS sources_used FROM customer""")
def q59_sources_used(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, "x").alias("partial"), F.when(F.col("c_custkey") % 3 == 0, "m").alias("record"))
    return c.select("c_custkey", F.array_join(sources_used("partial", "record"), ",").alias("sources_used"))


@query("""SELECT o_orderkey, concat_ws(chr(10), '{', '  "doi" : "10.1/' || o_orderkey || '",', '  "route" : "nature",', '  "source" : ' || CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE '"s"' END || ',', '  "status" : "' || CASE WHEN o_orderkey % 3 = 0 THEN 'failed' ELSE 'warning' END || '",', '  "fallback_used" : ' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END || ',',
    '  "warnings" : [ "w", "ü" ],', '  "failures" : [ ],', '  "error" : ' || CASE WHEN o_orderkey % 3 = 0 THEN '"no \\"x\\""' ELSE 'null' END, '}') AS qa FROM orders""")
def q60_qa_document(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    failed = F.col("o_orderkey") % 3 == 0
    d = o.select("o_orderkey", F.concat(F.lit("10.1/"), "o_orderkey").alias("doi"), F.lit("nature").alias("route"), F.when(~failed, "s").alias("source"), F.lit("warning").alias("status"), (F.col("o_orderkey") % 2 == 0).alias("fallback_used"), F.array(F.lit("w"), F.lit("ü")).alias("warnings"), F.array().cast("array<string>").alias("failures"), F.when(failed, 'no "x"').alias("error"))
    return qa_json(d).select(F.expr("cast(substring(doi, 6) as bigint)").alias("o_orderkey"), "qa")


REQUEST_SQL = """h AS (SELECT o_orderkey, route, doi, replace(url_encode(doi), '%2F', '/') AS path, url_encode(doi) AS whole, url_encode(regexp_replace(doi, '^[^/]*/', '')) AS suffix FROM g)"""


@query(f"""WITH {DOI_SQL}, {REQUEST_SQL}
    SELECT o_orderkey, 'publisher_xml' AS kind, 'https://api.elsevier.com/content/article/doi/' || path AS url, 'text/xml' AS accept, 'publisher' AS key, 'xml' AS body, CAST(3 AS INTEGER) AS attempts FROM h WHERE route = 'elsevier'
    UNION ALL SELECT o_orderkey, 'publisher_metadata', 'https://api.elsevier.com/content/article/doi/' || path, 'application/json', 'publisher', 'json', 3 FROM h WHERE route = 'elsevier'
    UNION ALL SELECT o_orderkey, 'publisher_pdf', 'https://api.elsevier.com/content/article/doi/' || path || '?view=FULL', 'application/pdf', 'publisher', 'pdf', 3 FROM h WHERE route = 'elsevier'
    UNION ALL SELECT o_orderkey, 'oa_response', 'https://api.springernature.com/openaccess/jats?q=doi%3A' || whole || '&p=10', 'application/xml,text/xml', 'open_access', 'any', 3 FROM h WHERE route = 'nature'
    UNION ALL SELECT o_orderkey, 'article_html', CASE route WHEN 'nature' THEN 'https://www.nature.com/articles/' || suffix ELSE 'https://link.springer.com/article/' || path END, 'text/html,application/xhtml+xml', NULL, 'any', 3 FROM h WHERE route IN ('nature', 'building_simulation')
    UNION ALL SELECT o_orderkey, 'metadata_json', 'https://api.springernature.com/meta/v2/json?q=doi%3A' || whole || '&p=1', 'application/json', 'metadata', 'json', 1 FROM h WHERE route IN ('nature', 'building_simulation')""")
def q61_requests(spark, sf_dir):
    papers = ids.with_route(_dois(spark, sf_dir)).select("o_orderkey", "doi", "route")
    out = None
    for kind in KINDS:
        one = requests(papers.select("doi", "route").distinct(), kind)
        out = one if out is None else out.unionByName(one)
    return papers.select("o_orderkey", "doi").join(out, "doi").drop("doi")


LINK_PAGE = "concat('<p>', coalesce(html, ''), '</p>', CASE WHEN page_id % 3 = 0 THEN concat('<a href=\"/articles/s', page_id, '_reference.pdf\">Download PDF</a>') ELSE '' END)"


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://www.nature.com/articles/s' || page_id || '_reference.pdf' ELSE 'https://www.nature.com/articles/s' || page_id || '.pdf' END AS url, 'application/pdf' AS accept, 'pdf' AS body FROM pages""")
def q62_page_to_pdf(spark, sf_dir):
    p = read(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("10.1038/s"), "page_id").alias("doi"), F.lit("nature").alias("route"), F.expr(LINK_PAGE).alias("html"), F.concat(F.lit("https://www.nature.com/articles/s"), "page_id").alias("page_url"))
    return pdf_requests(p).select(F.expr("cast(substring(doi, 10) as bigint)").alias("page_id"), "url", "accept", "body")


PUBLISHER = """concat('<full-text-retrieval-response><title>On ', p_name, '</title><abstract><para>Abs ', p_size, '.</para></abstract><section><label>1</label><section-title>Intro</section-title><para>See <cross-ref refid="t1">Table 1</cross-ref> and <bold>b</bold> <italic>i</italic> x<sup>2</sup>y<inf>', p_size, '</inf>.</para>',
    '<para>Form <display><formula id="e7"><math>a  ', p_size, '</math></formula></display> after</para><section><section-title>Deep</section-title><para>d</para></section></section><figure><label>Fig. 1</label><caption>C</caption></figure>',
    '<table id="t1"><label>Table 1</label><caption>Cap</caption><tgroup><thead><row><entry>A</entry><entry>B|C</entry></row></thead><tbody><row><entry>', p_size, '</entry></row></tbody></tgroup></table><bibliography><bib-reference id="b1">Ref <i>', p_type, '</i></bib-reference></bibliography></full-text-retrieval-response>')"""


@query("""SELECT p_partkey, '# On ' || p_name || x || x || '## Abstract' || x || x || 'Abs ' || p_size || '.' || x || x || '## 1 Intro' || x || x || 'See [Table 1](#t1) and **b** *i* x<sup>2</sup>y<sub>' || p_size || '</sub>.' || x || x || 'Form after' || x || x || '<a id="e7"></a>' || x || '$$' || x || 'a ' || p_size || x || '$$ (1)'
    || x || x || '### 1.1 Deep' || x || x || 'd' || x || x || '**Fig. 1 C**' || x || x || '<a id="t1"></a>' || x || x || '**Table 1** Cap' || x || x || '| A | B\\|C |' || x || '| --- | --- |' || x || '| ' || p_size || ' |  |' || x || x || '## References' || x || x || '<a id="b1"></a>' || x || x || 'Ref ' || p_type || x AS markdown
    FROM part, (SELECT chr(10) AS x)""")
def q63_publisher_markdown(spark, sf_dir):
    return publisher_xml.read_publisher_xml(spread(read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")).select("p_partkey", F.expr(PUBLISHER).alias("xml"))).select("p_partkey", F.col("raw_markdown").alias("markdown"))
