"""One query per operator over the driver's tables, and the SQL whose rows it must equal.

The tables hold no articles, so inputs are made from their columns. Expressions that both engines
read the same way are shared as text; what is checked is always computed twice, here by the
library's operators and there by plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as tx
from ..functions.rows import dealt, selected, spread
from ..operators import audit, blocks, jats, links, manifest, markdown_clean, metadata, publisher_xml

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Identifiers.

RAW = """CASE o_orderkey % 9
    WHEN 0 THEN concat('10.1016/J.Test.', o_orderkey) WHEN 1 THEN concat(' DOI:10.1007/S12273-', o_orderkey, '-2 ')
    WHEN 2 THEN concat('https://doi.org/10.1038/S41467-', o_orderkey, '?x=1') WHEN 3 THEN concat('<http://dx.doi.org/10.1007/s00134-', o_orderkey, '>')
    WHEN 4 THEN concat('10.5555/a%2Fb+', o_orderkey) WHEN 5 THEN concat('https://example.com/10.1007/', o_orderkey)
    WHEN 6 THEN concat('doi: 10.1016/(SICI)', o_orderkey, '%20') WHEN 7 THEN 'not-a-doi' ELSE '  ' END"""

DOI_SQL = rf"""
    a AS (SELECT o_orderkey, {RAW} AS raw FROM orders),
    b AS (SELECT *, trim(trim(trim(raw), '<>')) AS u FROM a),
    c AS (SELECT *, u LIKE 'http://%' OR u LIKE 'https://%' AS is_url, regexp_extract(lower(u), '^https?://([^/?#:]*)', 1) AS host FROM b),
    d AS (SELECT *, NOT is_url OR host IN ('doi.org', 'www.doi.org', 'dx.doi.org') AS known, CASE WHEN is_url THEN ltrim(regexp_extract(u, '^https?://[^/?#]*([^?#]*)', 1), '/') ELSE u END AS v FROM c),
    e AS (SELECT *, lower(trim(url_decode(CASE WHEN lower(v) LIKE 'doi:%' THEN trim(substr(v, 5)) ELSE v END))) AS w FROM d),
    f AS (SELECT *, CASE WHEN known AND regexp_full_match(w, '10[.][0-9]{{4,9}}/[^ \t\r\n]+') THEN w END AS doi FROM e),
    g AS (SELECT *, CASE WHEN doi IS NULL THEN NULL WHEN doi LIKE '10.1016/%' THEN 'elsevier' WHEN doi LIKE '10.1007/s12273%' THEN 'springer_nature' WHEN doi LIKE '10.1038/%' THEN 'springer_nature'
                         WHEN doi LIKE '10.1007/%' THEN 'springer_nature' ELSE 'unknown' END AS publisher,
                 CASE WHEN doi IS NULL THEN NULL WHEN doi LIKE '10.1016/%' THEN 'elsevier' WHEN doi LIKE '10.1007/s12273%' THEN 'building_simulation' WHEN doi LIKE '10.1038/%' THEN 'nature' ELSE 'unsupported' END AS route FROM f)"""


def _dois(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", F.expr(RAW).alias("raw")).withColumn("doi", ids.normalize_doi("raw"))


@query(f"""WITH {DOI_SQL} SELECT o_orderkey, raw, doi, CASE WHEN trim(raw) = '' THEN 'empty' WHEN NOT known THEN 'unsupported_host' WHEN doi IS NULL THEN 'invalid' END AS error FROM f""")
def q01_doi_normalize(spark, sf_dir):
    return _dois(spark, sf_dir).withColumn("error", ids.doi_error("raw"))


@query(f"WITH {DOI_SQL} SELECT o_orderkey, doi, publisher, route, CASE WHEN doi IS NOT NULL THEN route <> 'unsupported' END AS supported FROM g")
def q02_doi_route(spark, sf_dir):
    return ids.with_route(_dois(spark, sf_dir)).drop("raw")


@query(f"WITH {DOI_SQL} SELECT coalesce(route, 'invalid') AS route, count(*) AS n FROM g GROUP BY 1")
def q03_route_summary(spark, sf_dir):
    return ids.with_route(_dois(spark, sf_dir)).groupBy(F.coalesce("route", F.lit("invalid")).alias("route")).agg(F.count("*").alias("n"))


LIST_LINE = """CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN concat('# note ', o_orderkey) WHEN o_orderkey % 2 = 0 THEN concat('  10.1016/ABC.', o_custkey, ' ')
    ELSE concat('10.1016/abc.', o_custkey) END"""


@query(f"""
    WITH l AS (SELECT o_orderkey AS pos, trim({LIST_LINE}) AS doi_raw FROM orders), k AS (SELECT *, row_number() OVER (PARTITION BY lower(doi_raw) ORDER BY pos) AS n FROM l WHERE doi_raw <> '' AND doi_raw NOT LIKE '#%')
    SELECT pos, doi_raw FROM k WHERE n = 1""")
def q04_doi_list_load(spark, sf_dir):
    return manifest.doi_list(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos"), F.expr(LIST_LINE).alias("line")))


LONG_DOI = "concat('10.1234/', CASE WHEN o_orderkey % 3 = 0 THEN repeat('a', 200) ELSE 'x:y*z' END, o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '.' ELSE '' END)"


@query(rf"""
    WITH d AS (SELECT o_orderkey, {LONG_DOI} AS doi FROM orders), n AS (SELECT *, rtrim(regexp_replace(doi, '[<>:"/\\|?*\x00-\x1f]', '_', 'g'), ' .') AS name FROM d)
    SELECT o_orderkey, CASE WHEN length(name) <= 120 THEN name ELSE substr(name, 1, 106) || '--' || substr(sha256(doi), 1, 12) END AS paper_id FROM n""")
def q05_doi_dirname(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", ids.dirname(F.expr(LONG_DOI)).alias("paper_id"))


@query(f"""WITH {DOI_SQL}, h AS (SELECT o_orderkey, route, doi, CASE route WHEN 'nature' THEN 'https://www.nature.com/articles/' || url_encode(regexp_replace(doi, '^[^/]*/', '')) END AS n, replace(url_encode(doi), '%2F', '/') AS q FROM g)
    SELECT o_orderkey, CASE route WHEN 'elsevier' THEN 'https://api.elsevier.com/content/article/doi/' || q WHEN 'nature' THEN n WHEN 'building_simulation' THEN 'https://link.springer.com/article/' || q END AS article_url,
           CASE route WHEN 'nature' THEN n || '.pdf' WHEN 'building_simulation' THEN 'https://link.springer.com/content/pdf/' || q || '.pdf' END AS pdf_url FROM h""")
def q06_article_urls(spark, sf_dir):
    return ids.article_urls(ids.with_route(_dois(spark, sf_dir))).select("o_orderkey", "article_url", "pdf_url")


# Source choice, status, manifest.

SOURCES = "VALUES ('explicit_pdf', 1), ('jats', 2), ('local_pdf', 3), ('public_pdf', 4), ('restricted', 9)"
USABLE = "(o_orderkey % 6 < p AND (o_orderkey + p) % 4 <> 0) OR p = 9"


@query(f"""WITH c AS (SELECT o_orderkey, s.source, s.p FROM orders, ({SOURCES}) AS s(source, p) WHERE {USABLE})
    SELECT o_orderkey, arg_min(source, p) AS source, CAST(min(p) AS INTEGER) AS priority FROM c GROUP BY o_orderkey""")
def q07_source_priority(spark, sf_dir):
    known = F.array(*[F.struct(F.lit(n).alias("source"), F.lit(p).alias("p")) for n, p in (("explicit_pdf", 1), ("jats", 2), ("local_pdf", 3), ("public_pdf", 4), ("restricted", 9))])
    c = read(spark, sf_dir, "orders").select("o_orderkey", F.inline(known)).withColumn("ok", F.expr(USABLE))
    return manifest.choose_source(c.withColumnRenamed("p", "priority"), "o_orderkey").select("o_orderkey", "source", "priority")


FLAGS = "o_orderkey, o_orderkey % 5 = 0 AS f1, o_orderkey % 7 = 0 AS f2, o_orderkey % 3 = 0 AS w1, o_orderkey % 4 = 0 AS w2"


def _status(spark, sf_dir):
    f = read(spark, sf_dir, "orders").selectExpr(*FLAGS.split(", "))
    f = f.withColumns({"failures": audit.codes(("table_content_mismatch", F.col("f1")), ("references_missing", F.col("f2"))), "warnings": audit.codes(("private_use_characters", F.col("w1")), ("unknown_block_types", F.col("w2")))})
    return f.withColumn("status", audit.status("failures", "warnings"))


STATUS_SQL = f"""s AS (SELECT *, CASE WHEN f1 OR f2 THEN 'failed' WHEN w1 OR w2 THEN 'warning' ELSE 'success' END AS status,
    concat_ws(',', CASE WHEN f1 THEN 'table_content_mismatch' END, CASE WHEN f2 THEN 'references_missing' END) AS failures,
    concat_ws(',', CASE WHEN w1 THEN 'private_use_characters' END, CASE WHEN w2 THEN 'unknown_block_types' END) AS warnings FROM (SELECT {FLAGS} FROM orders))"""


@query(f"WITH {STATUS_SQL} SELECT o_orderkey, status, failures, warnings FROM s")
def q08_status_rollup(spark, sf_dir):
    return _status(spark, sf_dir).select("o_orderkey", "status", F.array_join("failures", ",").alias("failures"), F.array_join("warnings", ",").alias("warnings"))


def _manifest(spark, sf_dir):
    s = _status(spark, sf_dir)
    failed = F.col("status") == "failed"
    return manifest.manifest(s.select(
        F.col("o_orderkey").alias("index"), F.concat(F.lit("10.1016/x."), "o_orderkey").alias("doi"), F.lit("elsevier").alias("route"), F.lit("elsevier_xml").alias("source"), "status",
        (F.col("o_orderkey") % 2 == 0).alias("fallback_used"), F.concat(F.lit("lib/"), "o_orderkey", F.lit("/paper_llm.md")).alias("llm_markdown"), F.lit("qa.json").alias("qa"),
        F.when(failed, F.concat(F.lit("PipelineContentError: "), F.array_join("failures", ", "))).alias("error"),
    ))


@query(f"""WITH {STATUS_SQL} SELECT o_orderkey AS index, '10.1016/x.' || o_orderkey AS doi, CASE WHEN status = 'failed' THEN '' ELSE 'elsevier' END AS route, CASE WHEN status = 'failed' THEN '' ELSE 'elsevier_xml' END AS source, status,
    CASE WHEN status <> 'failed' AND o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS fallback_used, CASE WHEN status = 'failed' THEN '' ELSE 'lib/' || o_orderkey || '/paper_llm.md' END AS llm_markdown,
    CASE WHEN status = 'failed' THEN '' ELSE 'qa.json' END AS qa, CASE WHEN status = 'failed' THEN 'PipelineContentError: ' || replace(failures, ',', ', ') ELSE '' END AS error FROM s""")
def q09_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir)


@query(f"""WITH {STATUS_SQL} SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success_count, count(*) FILTER (WHERE status = 'warning') AS warning_count, count(*) FILTER (WHERE status = 'failed') AS failed_count FROM s""")
def q10_batch_summary(spark, sf_dir):
    return manifest.summary(_manifest(spark, sf_dir))


# Page content: a block for each line of a document, its type by the line's number.

TYPES = ("paragraph_title", "text", "text", "header", "table", "text", "list", "image", "text", "equation", "text", "side_note", "text", "doc_title")
CONT = (2, 5, 8, 10)


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, content): the JSON is written and parsed again."""
    kinds = "array(" + ", ".join(f"'{t}'" for t in TYPES) + ")"
    d = read(spark, sf_dir, "documents").select("doc_id", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("ls"))
    made = d.withColumn("bs", F.expr(f"""transform(ls, (l, i) -> named_struct(
        'type', {kinds}[i % {len(TYPES)}], 'sub_type', IF(i % 28 = 6, 'ref_text', 'plain'), 'content', IF(i % {len(TYPES)} = 0, concat(cast(i AS string), '.1 ', l), IF(i % {len(TYPES)} = 4, concat('<table>', l, '<img src="x"/></table>'), l)),
        'continues_prev', i % {len(TYPES)} IN {CONT}, 'captions', IF(i % {len(TYPES)} IN (4, 7), array(named_struct('content', concat('Cap ', cast(i AS string)))), NULL),
        'footnotes', IF(i % {len(TYPES)} = 4 AND i % 4 = 0, array(named_struct('content', concat('note ', cast(i AS string)))), NULL)))"""))
    pages = F.expr("transform(sequence(0, (size(bs) - 1) div 10), p -> named_struct('page_idx', p, 'blocks', slice(bs, p * 10 + 1, 10)))")
    json = F.to_json(F.struct((F.col("doc_id") % 3 != 0).alias("is_full_document"), pages.alias("pages")))
    return made.select("doc_id", blocks.parse_content(json).alias("content"))


BLOCKS_SQL = f"""
    l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
    b AS (SELECT doc_id, i, [{", ".join(f"'{t}'" for t in TYPES)}][1 + i % {len(TYPES)}] AS type, i % 28 = 6 AS is_ref,
                 trim(CASE i % {len(TYPES)} WHEN 0 THEN i || '.1 ' || line WHEN 4 THEN '<table>' || line || '<img src="x"/></table>' ELSE line END) AS content, i % {len(TYPES)} IN {CONT} AS cont FROM l),
    c AS (SELECT doc_id, i, 0 AS s, 'caption' AS kind, '**Cap ' || i || '**' AS text, false AS cont FROM b WHERE type IN ('table', 'image')
          UNION ALL SELECT doc_id, i, 1, CASE type WHEN 'paragraph_title' THEN 'heading' WHEN 'doc_title' THEN 'heading' WHEN 'list' THEN 'list' WHEN 'table' THEN 'table' ELSE 'text' END,
                           CASE type WHEN 'paragraph_title' THEN '### ' || content WHEN 'doc_title' THEN '# ' || content WHEN 'table' THEN replace(content, '<img src="x"/>', '') ELSE content END, type = 'text' AND cont
                    FROM b WHERE type NOT IN ('header', 'equation', 'image') AND content <> ''
          UNION ALL SELECT doc_id, i, 2, 'text', 'note ' || i, false FROM b WHERE type = 'table' AND i % 4 = 0),
    d AS (SELECT *, coalesce(kind = 'text' AND cont AND lag(kind) OVER (PARTITION BY doc_id ORDER BY i, s) = 'text', false) AS joins FROM c),
    m AS (SELECT doc_id, trim(string_agg(CASE WHEN joins THEN ' ' ELSE chr(10) || chr(10) END || text, '' ORDER BY i, s), chr(10)) || chr(10) AS markdown FROM d GROUP BY doc_id),
    md AS (SELECT doc_id, coalesce(m.markdown, chr(10)) AS markdown FROM documents LEFT JOIN m USING (doc_id))"""


@query(f"WITH {BLOCKS_SQL} SELECT doc_id, i // 10 AS page_idx, i % 10 AS block_idx, type, content FROM b WHERE type NOT IN ('header', 'equation') AND content <> ''")
def q11_block_scan(spark, sf_dir):
    pages = _content(spark, sf_dir).select("doc_id", F.explode("content.pages").alias("p"))
    rows = pages.select("doc_id", F.col("p.page_idx").cast("long").alias("page_idx"), F.posexplode("p.blocks").alias("n", "b"))
    out = rows.select("doc_id", "page_idx", F.col("n").cast("long").alias("block_idx"), F.col("b.type").alias("type"), tx.strip("b.content").alias("content"))
    return out.where(~F.col("type").isin(*blocks.IGNORED, *blocks.EQUATIONS) & (F.col("content") != ""))


@query(f"WITH {BLOCKS_SQL} SELECT doc_id, type, count(*) AS n FROM b GROUP BY doc_id, type")
def q12_block_histogram(spark, sf_dir):
    return blocks.histogram(_content(spark, sf_dir), "doc_id")


TITLE = "CASE p_partkey % 5 WHEN 0 THEN concat(p_size, '.', p_partkey % 9, '.1 ', p_name) WHEN 1 THEN concat(p_size, ' ', p_name) WHEN 2 THEN concat('Note A', p_size, ' ', p_name) WHEN 3 THEN concat('1.2.3.4.5.6.7 ', p_name) ELSE p_name END"


@query(f"""SELECT p_partkey, CAST(CASE WHEN regexp_matches(t, '^\\s*\\d+(\\.\\d+)*\\s') THEN least(6, 2 + length(split_part(ltrim(t), ' ', 1)) - length(replace(split_part(ltrim(t), ' ', 1), '.', ''))) WHEN regexp_matches(t, '(?i)^\\s*note\\s+[a-z]\\d+') THEN 3 ELSE 2 END AS INTEGER) AS level
    FROM (SELECT p_partkey, {TITLE} AS t FROM part)""")
def q13_heading_level(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", tx.heading_level(F.expr(TITLE)).cast("int").alias("level"))


@query(f"""WITH {BLOCKS_SQL}, g AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i, s) - 1 AS item FROM d)
    SELECT doc_id, CAST(item AS BIGINT) AS item, first(kind ORDER BY i, s) AS kind, string_agg(text, ' ' ORDER BY i, s) AS text FROM g GROUP BY doc_id, item""")
def q14_continuation_merge(spark, sf_dir):
    return blocks.paragraphs(blocks.with_pieces(_content(spark, sf_dir)), "doc_id")


@query(f"WITH {BLOCKS_SQL} SELECT doc_id, markdown FROM md")
def q15_render_markdown(spark, sf_dir):
    return blocks.render(_content(spark, sf_dir)).select("doc_id", "markdown")


@query(f"""WITH {BLOCKS_SQL} SELECT doc_id, count(DISTINCT i // 10) AS page_count, count(*) FILTER (WHERE type = 'table') AS table_count, count(*) FILTER (WHERE type = 'image') AS image_count,
    count(*) FILTER (WHERE type = 'equation') AS display_equations_removed, bool_or(is_ref AND type = 'list') AS references_present, coalesce(string_agg(DISTINCT CASE WHEN type = 'side_note' THEN type END, ','), '') AS unknown_block_types FROM b GROUP BY doc_id""")
def q16_render_stats(spark, sf_dir):
    r = blocks.render(_content(spark, sf_dir))
    return r.select("doc_id", "page_count", "table_count", "image_count", "display_equations_removed", "references_present", F.array_join("unknown_block_types", ",").alias("unknown_block_types"))


# Tables made from lineitem: rows of an order numbered by all their columns, since keys repeat.

ROWS_SQL = """r AS (SELECT l_orderkey, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) AS price, CAST(CAST(l_quantity AS DECIMAL(15,2)) AS STRING) AS qty, l_returnflag AS flag,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS n FROM lineitem)"""


#: Rows of tables a part.
TABLE_ROWS = 250_000


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, rows): array<struct<n, qty, price, flag>> in order."""
    li = read(spark, sf_dir, "lineitem")
    money = lambda c: F.col(c).cast("decimal(15,2)").cast("string")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    packed = dealt(li.select("l_orderkey", *order), TABLE_ROWS, "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("x"))
    return packed.select("l_orderkey", F.transform("x", lambda r, i: F.struct((i + 1).alias("n"), r["l_quantity"].cast("decimal(15,2)").cast("string").alias("qty"), r["l_extendedprice"].cast("decimal(15,2)").cast("string").alias("price"), r["l_returnflag"].alias("flag"))).alias("rows"))


@query(f"""WITH {ROWS_SQL} SELECT l_orderkey, count(*) AS source_table_count, count(*) FILTER (WHERE n % 3 <> 0) AS matched_table_count, bool_and(n % 3 <> 0) AS table_content_exact_match,
    CAST(3 * count(*) AS BIGINT) AS source_numeric_tokens, CAST(3 * count(*) FILTER (WHERE n % 3 <> 0) AS BIGINT) AS final_numeric_tokens FROM r GROUP BY l_orderkey""")
def q17_table_alignment(spark, sf_dir):
    t = _rows(spark, sf_dir)
    table = lambda r: F.concat(F.lit("<table>#"), r["n"], F.lit(": "), r["qty"], F.lit(" | "), r["price"], F.lit("</table>"))
    t = t.withColumn("source_tables", F.transform("rows", table))
    md = F.array_join(F.transform(F.filter("rows", lambda r: r["n"] % 3 != 0), lambda r: F.concat(F.lit("Text\n\n"), table(r))), "\n\n")
    out = audit.content_audit(t.withColumn("markdown", md))
    return out.select("l_orderkey", "source_table_count", "matched_table_count", "table_content_exact_match", "source_numeric_tokens", "final_numeric_tokens")


@query(r"""SELECT page_id, CAST(len(regexp_extract_all(coalesce(html, ''), '[+−\-±]?(?:\d+(?:\.\d+)?|\.\d+)(?:[Ee][+−\-]?\d+)?%?')) AS BIGINT) AS n,
    array_to_string(regexp_extract_all(coalesce(html, ''), '[+−\-±]?(?:\d+(?:\.\d+)?|\.\d+)(?:[Ee][+−\-]?\d+)?%?'), ' ') AS tokens FROM pages""")
def q18_numeric_tokens(spark, sf_dir):
    t = tx.content_numbers(F.coalesce("html", F.lit("")))
    return read(spark, sf_dir, "pages").select("page_id", F.size(t).cast("long").alias("n"), F.array_join(t, " ").alias("tokens"))


def _table_xml(spanning: bool = False) -> str:
    """SQL of an article whose one table holds an order's rows; flags of N are empty cells."""
    span = """IF(l_orderkey % 4 = 0, concat(' rowspan="', cast(l_orderkey % 8 + 1 AS string), '"'), IF(l_orderkey % 4 = 1, ' colspan="1"', ''))""" if spanning else "''"
    row = "concat('<tr><td>', r.qty, '</td><td>', IF(r.flag = 'N', '', concat('<bold>', r.flag, '</bold> &amp; <italic>x|y</italic>')), '</td><td>', r.price, '</td></tr>')"
    return f"""concat('<!DOCTYPE article><article xmlns:x="u"><body><sec><title>T</title><table-wrap><label>Table ', l_orderkey, '</label><caption><p>Rows of the order</p></caption><table><thead><tr><th', {span}, '>Quantity</th><th>Flag</th></tr></thead><tbody>',
        array_join(transform(rows, r -> {row}), ''), '</tbody></table><table-wrap-foot><p>Note: ', size(rows), '</p></table-wrap-foot></table-wrap></sec></body></article>')"""


@query(f"""WITH {ROWS_SQL}, t AS (SELECT l_orderkey, count(*) AS k, string_agg('| ' || qty || ' | ' || CASE WHEN flag = 'N' THEN '' ELSE flag || ' & x\\|y' END || ' | ' || price || ' |', chr(10) ORDER BY n) AS body FROM r GROUP BY l_orderkey)
    SELECT l_orderkey, '# Untitled article' || chr(10) || chr(10) || '## T' || chr(10) || chr(10) || '**Table ' || l_orderkey || '.** Rows of the order' || chr(10) || chr(10) || '| Quantity | Flag |  |' || chr(10) || '| --- | --- | --- |' || chr(10)
        || body || chr(10) || chr(10) || 'Note: ' || k || chr(10) AS markdown FROM t""")
def q22_table_markdown(spark, sf_dir):
    return jats.read_jats(_rows(spark, sf_dir).select("l_orderkey", F.expr(_table_xml()).alias("xml")), parts=("markdown",)).select("l_orderkey", "markdown")


@query(f"""WITH {ROWS_SQL} SELECT l_orderkey, CAST(2 + 3 * count(*) AS BIGINT) AS n_cells, string_agg(qty || ' ' || price, ' ' ORDER BY n) AS tokens FROM r GROUP BY l_orderkey""")
def q23_table_source_cells(spark, sf_dir):
    d = jats.read_jats(_rows(spark, sf_dir).select("l_orderkey", F.expr(_table_xml()).alias("xml")), parts=("cells",))
    return d.select("l_orderkey", F.size("cells").cast("long").alias("n_cells"), F.array_join(F.flatten(F.transform("cells", tx.structured_numbers)), " ").alias("tokens"))


@query(f"""WITH {ROWS_SQL}, t AS (SELECT l_orderkey, count(*) AS k FROM r GROUP BY l_orderkey) SELECT l_orderkey, l_orderkey % 3 <> 0 AS values_match, CAST(2 * k AS BIGINT) AS n_source, CAST(2 * k AS BIGINT) AS n_markdown FROM t""")
def q19_table_numeric_audit(spark, sf_dir):
    d = jats.read_jats(_rows(spark, sf_dir).select("l_orderkey", "rows", F.expr(_table_xml()).alias("xml")), parts=("cells", "markdown")).withColumn("source", F.flatten(F.transform("cells", tx.structured_numbers)))
    # One digit of one price changes in every third order.
    price = F.get("rows", F.lit(0))["price"]
    broken = F.regexp_replace("markdown", F.concat(F.lit(r"\Q"), price, F.lit(r"\E \|")), F.concat(F.lit("9"), price, F.lit(" |")))
    d = d.withColumn("final", audit.markdown_numbers(F.when(F.col("l_orderkey") % 3 == 0, broken).otherwise(F.col("markdown"))))
    return d.select("l_orderkey", audit.values_match("source", "final").alias("values_match"), F.size("source").cast("long").alias("n_source"), F.size("final").cast("long").alias("n_markdown"))


ODD = "concat(coalesce(text, ''), CASE doc_id % 6 WHEN 0 THEN ' ![a](b) data:image/png <IMG src=x>' WHEN 1 THEN ' \ue001\uf8ff Ã' WHEN 2 THEN ' $$ x $$ ```math' WHEN 3 THEN ' image_source Data:Image' ELSE '' END)"


@query(rf"""SELECT doc_id, CAST((length(t) - length(replace(t, '![', ''))) // 2 + (length(t) - length(replace(t, 'image_source', ''))) // 12 + len(regexp_extract_all(t, '(?i)<img\b')) AS BIGINT) AS remaining_images,
    CAST((length(t) - length(replace(lower(t), 'data:image', ''))) // 10 AS BIGINT) AS remaining_base64, CAST((length(t) - length(replace(t, '$$', ''))) // 2 + (length(t) - length(replace(t, '```math', ''))) // 7 AS BIGINT) AS remaining_display_equations,
    CAST(len(regexp_extract_all(t, '[\x{{e000}}-\x{{f8ff}}]')) AS BIGINT) AS private_use_characters, contains(t, 'Ã') OR contains(t, 'Â') OR contains(t, 'â€') OR contains(t, chr(65533)) AS mojibake FROM (SELECT doc_id, {ODD} AS t FROM documents)""")
def q20_audit_counters(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.expr(ODD).alias("t"))
    return d.select("doc_id", *[c.alias(n) for n, c in audit.counters(F.col("t")).items()])


HEADED = "concat(coalesce(text, ''), CASE doc_id % 6 WHEN 0 THEN '\n## References\nx' WHEN 1 THEN '\n# 5.1 Results  ' WHEN 2 THEN '\n## bibliography ' WHEN 3 THEN '\n## Conclusions' WHEN 4 THEN '\n####### References' ELSE '' END)"


@query(rf"""SELECT doc_id, regexp_matches(t, '(?mi)^#{{1,6}}\s+(References|Bibliography)\s*$') AS has_references, regexp_matches(t, '(?mi)^#{{1,6}}\s+(\d+(\.\d+)*\s+)?Results\s*$') AS has_results,
    regexp_matches(t, '(?mi)^#{{1,6}}\s+(\d+(\.\d+)*\s+)?Conclusion\s*$') AS has_conclusion FROM (SELECT doc_id, {HEADED.replace(chr(92) + 'n', "' || chr(10) || '")} AS t FROM documents)""")
def q21_has_references(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.expr(HEADED).alias("t"))
    return d.select("doc_id", tx.has_references("t").alias("has_references"), tx.has_heading("t", "Results").alias("has_results"), tx.has_heading("t", "Conclusion").alias("has_conclusion"))


# XML statistics: orders of a customer as sections with paragraphs of a fixed length.

ORDERS_SQL = "o AS (SELECT o_custkey, count(*) AS n, CAST(sum(length(CAST(o_orderkey AS STRING))) AS BIGINT) AS digits FROM orders GROUP BY o_custkey)"


def _articles(spark: SparkSession, sf_dir: str, publisher: bool) -> DataFrame:
    o = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("ks"))
    if publisher:
        part = "concat('<section><section-title>S</section-title><para>', repeat('word ', 99), 'word ', k, '</para></section>')"
        xml = f"concat('<', IF(o_custkey % 5 = 0, 'abstract-response', 'full-text-retrieval-response'), '>', array_join(transform(ks, k -> {part}), ''), '<bib-reference>R</bib-reference></', IF(o_custkey % 5 = 0, 'abstract-response', 'full-text-retrieval-response'), '>')"
    else:
        part = "concat('<sec><title>S</title><p>', repeat('word ', 99), 'word ', k, '</p><fig><label>F</label></fig></sec>')"
        xml = f"concat('<response><article><front><article-id pub-id-type=\"doi\"> 10.1/A', o_custkey, ' </article-id></front><body>', array_join(transform(ks, k -> {part}), ''), '</body><back><ref-list><ref><label>1</label></ref></ref-list></back></article></response>')"
    return o.select("o_custkey", F.expr(xml).alias("xml"))


@query(f"""WITH {ORDERS_SQL}, s AS (SELECT *, CAST((499 + 1) * n + digits + 4 * n + (n - 1) AS BIGINT) AS chars FROM o)
    SELECT o_custkey, '10.1/a' || o_custkey AS doi, n AS section_count, n AS paragraph_count, CAST(1 AS BIGINT) AS reference_count, n AS figure_count, chars AS body_characters, n >= 10 AND chars >= 5000 AS candidate_full_text FROM s""")
def q24_jats_stats(spark, sf_dir):
    return jats.read_jats(_articles(spark, sf_dir, False), parts=("stats",)).select("o_custkey", *[f"stats.{c}" for c in ("doi", "section_count", "paragraph_count", "reference_count", "figure_count", "body_characters", "candidate_full_text")])


@query(f"""WITH {ORDERS_SQL}, s AS (SELECT *, CAST((499 + 1) * n + digits + 2 * n + n + 1 AS BIGINT) AS chars FROM o)
    SELECT o_custkey, n AS section_count, n AS paragraph_count, CAST(1 AS BIGINT) AS reference_count, chars AS text_characters, o_custkey % 5 <> 0 AND n >= 10 AND chars >= 5000 AS is_full_text,
           concat_ws('; ', CASE WHEN o_custkey % 5 = 0 THEN 'unexpected root element: abstract-response' END, CASE WHEN n < 2 THEN 'too few sections: ' || n END, CASE WHEN n < 10 THEN 'too few paragraphs: ' || n END,
                     CASE WHEN chars < 5000 THEN 'too little textual content: ' || chars || ' chars' END) AS reason FROM s""")
def q25_xml_stats(spark, sf_dir):
    return publisher_xml.read_publisher_xml(_articles(spark, sf_dir, True), markdown=False).select("o_custkey", "section_count", "paragraph_count", "reference_count", "text_characters", "is_full_text", "reason")


@query("SELECT l_orderkey, NOT (l_orderkey % 4 = 0 AND l_orderkey % 8 <> 0) AS is_simple FROM (SELECT DISTINCT l_orderkey FROM lineitem)")
def q26_simple_table_guard(spark, sf_dir):
    d = jats.read_jats(_rows(spark, sf_dir).select("l_orderkey", F.expr(_table_xml(True)).alias("xml")), parts=("render_error",))
    return d.select("l_orderkey", F.col("render_error").isNull().alias("is_simple"))


FLOATS = "concat('<r><float-anchor refid=\"t1\"/><float-anchor refid=\"t1\"/><float-anchor refid=\"f9\"/><float-anchor refid=\"t', o_orderkey % 10 + 2, '\"/><table id=\"t', o_orderkey % 10 + 2, '\">', CASE WHEN o_orderkey % 3 = 0 THEN '<link locator=\"x\"/>' WHEN o_orderkey % 3 = 1 THEN '<link/><tgroup/>' ELSE '' END, '</table></r>')"
FLOAT_MD = "concat('Text (#t1).', chr(10), chr(10), 'More.', chr(10), chr(10), '<a id=\"t1\"></a>', chr(10), chr(10), '**Table 1** c', chr(10), chr(10), '| a |', chr(10), '| --- |', chr(10), '| ', o_orderkey, ' |', chr(10))"


@query("""SELECT o_orderkey, 't1' AS relocated, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 't' || (o_orderkey % 10 + 2) END AS missing, CASE WHEN o_orderkey % 3 = 0 THEN 't' || (o_orderkey % 10 + 2) ELSE '' END AS image_only,
    'Text (#t1).' || chr(10) || chr(10) || '<a id="t1"></a>' || chr(10) || chr(10) || '**Table 1** c' || chr(10) || chr(10) || '| a |' || chr(10) || '| --- |' || chr(10) || '| ' || o_orderkey || ' |' || chr(10) || chr(10) || 'More.' || chr(10) AS markdown FROM orders""")
def q27_float_table_status(spark, sf_dir):
    d = publisher_xml.read_publisher_xml(read(spark, sf_dir, "orders").select("o_orderkey", F.expr(FLOATS).alias("xml"), F.expr(FLOAT_MD).alias("md")), markdown=False)
    d = publisher_xml.missing_tables(markdown_clean.clean(d, "md"))
    return d.select("o_orderkey", F.array_join("relocated", ",").alias("relocated"), F.array_join("missing_float_table_ids", ",").alias("missing"), F.array_join("image_only_float_table_ids", ",").alias("image_only"), F.col("llm_markdown").alias("markdown"))


MENTION = "concat(repeat('x', CAST(o_orderkey % 50 AS INT)), CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE concat(' see [Table](#t', o_orderkey, ') ok') END, CASE WHEN o_orderkey % 4 = 1 THEN '' ELSE concat(chr(10), ' ', chr(10)) END, 'next', CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat(chr(10), chr(10), '## References (#t', o_orderkey, ')') END)"


@query(f"""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL WHEN 1 THEN CAST(o_orderkey % 50 + length(' see [Table](#t' || o_orderkey || ') ok') + 4 + 2 + 1 AS INTEGER) ELSE CAST(o_orderkey % 50 + length(' see [Table](#t' || o_orderkey || ') ok') + 3 + 1 AS INTEGER) END AS paragraph_end FROM (SELECT o_orderkey, {MENTION} AS m FROM orders)""")
def q28_mention_anchor(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", markdown_clean.mention_end(F.expr(MENTION), F.concat(F.lit("t"), "o_orderkey")).alias("paragraph_end"))


# Display formulas behind and within the whole text: a line between its halves and two blocks at its end.
MATH = """concat(coalesce(text, ''), chr(10), CASE WHEN doc_id % 2 = 0 THEN concat('<a id="e', doc_id, '"></a>', chr(10)) ELSE '' END, CASE WHEN doc_id % 5 = 0 THEN '' ELSE concat('$$', chr(10), 'x = y', chr(10), coalesce(text, ''), chr(10), '$$ (', doc_id, ')', chr(10)) END,
    'B', chr(10), '  $$', chr(10), 'z', chr(10), '  $$', chr(10), 'C ', coalesce(text, ''))"""
# The same blocks as RE2 reads them.
MATH_RE2 = r"""(?m)(?:^[ \t]*<a id="e[^"]+"></a>[ \t]*\r?\n)?^[ \t]*\$\$[ \t]*\r?\n(?s:.*?)^[ \t]*\$\$(?:[ \t]+\([^)]+\))?[ \t]*(?:\r?\n)?"""


@query(f"""SELECT doc_id, CAST(len(regexp_extract_all(m, '{MATH_RE2}')) AS BIGINT) AS removed, regexp_replace(m, '{MATH_RE2}', chr(10) || chr(10), 'g') AS markdown FROM (SELECT doc_id, {MATH} AS m FROM documents)""")
def q29_display_math(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.expr(MATH).alias("m"))
    return d.select("doc_id", markdown_clean.display_math_count("m").alias("removed"), markdown_clean.remove_display_math("m").alias("markdown"))


CELL = r"""CASE p_partkey % 9 WHEN 0 THEN concat('**', p_name, '**') WHEN 1 THEN concat('\*', p_name, ' \*') WHEN 2 THEN concat(p_name, '*') WHEN 3 THEN concat(p_name, '<br/>x') WHEN 4 THEN concat('**', p_name, ' ** / **b**')
    WHEN 5 THEN concat('***', p_name) WHEN 6 THEN concat('\boldsymbol{x} ', p_name, '   y') WHEN 7 THEN concat(p_name, '**') ELSE concat(' *a* ', p_name, ' *b* ') END"""


@query(rf"""SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN p_name || '*' WHEN 3 THEN p_name || ' x' WHEN 4 THEN p_name || ' / b' WHEN 5 THEN '***' || p_name
    WHEN 6 THEN '\mathbf{{x}} ' || p_name || ' y' WHEN 7 THEN p_name || '**' ELSE 'a ' || p_name || ' b' END AS cell FROM part""")
def q30_cell_normalize(spark, sf_dir):
    text = CELL.replace("\\", "\\\\")
    return read(spark, sf_dir, "part").select("p_partkey", markdown_clean.clean_cell(F.expr(text)).alias("cell"))


# Links.

NATURE_DOI = "concat('10.1038/s', page_id)"
NATURE_PAGE = """concat('<a href="/x.pdf">other</a>', CASE WHEN page_id % 4 < 3 THEN concat('<a class="c" href="/articles/s', page_id, '.pdf">Article <b>text</b></a>') ELSE '' END, CASE WHEN page_id % 4 = 1 THEN concat('<A HREF=''/articles/S', page_id, '_reference.pdf''>pdf</A>') ELSE '' END,
    CASE WHEN page_id % 4 = 2 THEN concat('<a href="/m/s', page_id, '.pdf?a=1&amp;b=2">Download  PDF</a>') ELSE '' END, '<a href="/s', page_id, '_ESM.pdf">Download PDF</a><a href="/s', page_id, '.pdf">Peer review file</a>', coalesce(html, ''))"""


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/articles/s' || page_id || '.pdf' WHEN 1 THEN '/articles/S' || page_id || '_reference.pdf' WHEN 2 THEN '/m/s' || page_id || '.pdf?a=1&b=2' END AS href FROM pages""")
def q31_nature_pdf_link(spark, sf_dir):
    p = read(spark, sf_dir, "pages").select("page_id", F.expr(NATURE_PAGE).alias("h"), F.expr(NATURE_DOI).alias("doi"))
    return p.select("page_id", links.nature_pdf_href("h", "doi").alias("href"))


SPRINGER_DOI = "concat('10.1007/s12273-', page_id)"
SPRINGER_PAGE = """concat('<a href="/a.pdf">Article PDF</a>', CASE WHEN page_id % 3 = 0 THEN concat('<a href="/content/pdf/10.1007%2Fs12273-', page_id, '.pdf">x</a>') ELSE '' END, CASE WHEN page_id % 3 = 1 THEN '<a href="/b.pdf">Download PDF</a>' ELSE '' END,
    '<a href="/c.pdf">Electronic supplementary material</a><a href="/none.html">Download PDF</a>', coalesce(html, ''))"""


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN '/content/pdf/10.1007%2Fs12273-' || page_id || '.pdf' WHEN 1 THEN '/b.pdf' ELSE '/a.pdf' END AS href FROM pages""")
def q32_building_pdf_link(spark, sf_dir):
    p = read(spark, sf_dir, "pages").select("page_id", F.expr(SPRINGER_PAGE).alias("h"), F.expr(SPRINGER_DOI).alias("doi"))
    return p.select("page_id", links.springer_pdf_href("h", "doi").alias("href"))


# Metadata.

PAYLOAD = """CASE WHEN c_custkey % 7 = 0 THEN '{"records": 5}' WHEN c_custkey % 7 = 1 THEN 'no json' ELSE concat('{"query":"doi:q","apiKey":"secret","records":[{"doi":"10.1/other"},"text",{"identifier":"doi:10.1234/C', c_custkey, '","title":" ', c_name, ' ","volume":', c_nationkey,
    ',"openaccess":', CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE '"false"' END, ',"creators":[{"creator":"A, B"},{"name":"C"},"A, B",7],"keyword":"', c_mktsegment, '","startingPage":"1","endingPage":"', CASE WHEN c_custkey % 3 = 0 THEN '1' ELSE '9' END,
    '","url":[{"format":"pdf","value":"https://p/', c_custkey, '"},{"format":"HTML","value":"http://h/', c_custkey, '"}]},{"doi":"10.1234/c', c_custkey, '","title":"second"}]}') END"""


def _meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    c = spread(read(spark, sf_dir, "customer").select(*own)).select(*own, F.expr(PAYLOAD).alias("payload"), F.expr("concat('10.1234/c', c_custkey)").alias("doi"))
    return metadata.select_record(c)


@query("""SELECT c_custkey, c_custkey % 7 > 1 AS found, CASE c_custkey % 7 WHEN 0 THEN 'no_records_list' WHEN 1 THEN 'not_json' END AS metadata_error, CASE WHEN c_custkey % 7 > 1 THEN c_name END AS title FROM customer""")
def q33_meta_select(spark, sf_dir):
    m = metadata.meta_fields(_meta(spark, sf_dir))
    return m.select("c_custkey", F.col("record").isNotNull().alias("found"), "metadata_error", "fields.title")


@query("""SELECT c_custkey, c_name AS title, 'A, B; C' AS authors, CAST(c_nationkey AS VARCHAR) AS volume, CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS open_access, c_mktsegment AS keywords,
    CASE WHEN c_custkey % 3 = 0 THEN '1' ELSE '1-9' END AS pages, 'http://h/' || c_custkey AS url, CAST(NULL AS VARCHAR) AS journal FROM customer WHERE c_custkey % 7 > 1""")
def q34_meta_fields(spark, sf_dir):
    m = metadata.meta_fields(_meta(spark, sf_dir), name="f")
    return selected(m, F.col("record").isNotNull(), "c_custkey", "f.title", F.array_join("f.authors", "; ").alias("authors"), "f.volume", "f.open_access", F.array_join("f.keywords", "; ").alias("keywords"), "f.pages", "f.url", "f.journal")


def _sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    none = "cast(null as string)"
    jats_side = f"""named_struct('title', IF(c_custkey % 2 = 0, c_name, '  '), 'authors', array('A', ' B '), 'journal', IF(c_custkey % 3 = 0, 'J', {none}), 'publication_date', {none}, 'volume', '1', 'issue', {none}, 'pages', {none}, 'publisher', 'P',
        'abstract', repeat('a', cast(c_custkey % 10 as int)), 'keywords', array('k'), 'open_access', 'j', 'copyright', {none}, 'url', 'http://j')"""
    meta_side = f"""named_struct('title', 'M', 'authors', array('B', 'C', ''), 'journal', 'K', 'publication_date', '2020', 'volume', '2', 'issue', '3', 'pages', '4', 'publisher', 'Q', 'abstract', repeat('b', 5), 'keywords', array('l', 'k'),
        'open_access', IF(c_custkey % 4 = 0, 'm', {none}), 'copyright', 'c', 'url', {none})"""
    j = c.where("c_custkey % 5 <> 0").select("c_custkey", F.expr(jats_side).cast(metadata.FIELD_TYPE).alias("jats"))
    m = c.where("c_custkey % 6 <> 0").select("c_custkey", F.expr(meta_side).cast(metadata.FIELD_TYPE).alias("meta"))
    return j.join(m, "c_custkey", "full_outer").withColumn("f", metadata.merge_fields("jats", "meta"))


SIDES_SQL = """s AS (SELECT c_custkey, c_custkey % 5 <> 0 AS j, c_custkey % 6 <> 0 AS m, c_name FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 6 <> 0),
    f AS (SELECT *, CASE WHEN j AND c_custkey % 2 = 0 THEN c_name WHEN m THEN 'M' END AS title, CASE WHEN j AND m THEN 'A; B; C' WHEN j THEN 'A; B' ELSE 'B; C' END AS authors, CASE WHEN j AND c_custkey % 3 = 0 THEN 'J' WHEN m THEN 'K' END AS journal,
        CASE WHEN j THEN '1' ELSE '2' END AS volume, CASE WHEN j AND (NOT m OR c_custkey % 10 >= 5) THEN nullif(repeat('a', c_custkey % 10), '') WHEN m THEN 'bbbbb' END AS abstract,
        CASE WHEN j AND m THEN 'k; l' WHEN j THEN 'k' ELSE 'l; k' END AS keywords, CASE WHEN m AND c_custkey % 4 = 0 THEN 'm' WHEN j THEN 'j' END AS open_access, CASE WHEN j THEN 'http://j' END AS url FROM s)"""


@query(f"""WITH {SIDES_SQL} SELECT c_custkey, title, authors, journal, volume, abstract, keywords, open_access, url,
    concat_ws(',', CASE WHEN title IS NOT NULL THEN 'title' END, 'authors', CASE WHEN journal IS NOT NULL THEN 'journal' END, CASE WHEN m THEN 'publication_date' END, 'volume', CASE WHEN m THEN 'issue' END, CASE WHEN m THEN 'pages' END, 'publisher',
              CASE WHEN abstract IS NOT NULL THEN 'abstract' END, 'keywords', CASE WHEN open_access IS NOT NULL THEN 'open_access' END, CASE WHEN m THEN 'copyright' END, CASE WHEN url IS NOT NULL THEN 'url' END) AS available FROM f""")
def q35_metadata_merge(spark, sf_dir):
    d = _sides(spark, sf_dir)
    return d.select("c_custkey", "f.title", F.array_join("f.authors", "; ").alias("authors"), "f.journal", "f.volume", "f.abstract", F.array_join("f.keywords", "; ").alias("keywords"), "f.open_access", "f.url", F.array_join(metadata.available_fields("f"), ",").alias("available"))


@query(f"""WITH {SIDES_SQL}, n(x) AS (SELECT chr(10)) SELECT c_custkey, '# ' || coalesce(title, '10.1234/c' || c_custkey) || x || x || 'DOI: 10.1234/c' || c_custkey || x || 'Authors: ' || authors || coalesce(x || 'Journal: ' || journal, '')
    || CASE WHEN m THEN x || 'Published: 2020' ELSE '' END || x || 'Volume: ' || volume || CASE WHEN m THEN x || 'Issue: 3' || x || 'Pages: 4' ELSE '' END || x || 'Publisher: ' || CASE WHEN j THEN 'P' ELSE 'Q' END || coalesce(x || 'Open access metadata: ' || open_access, '')
    || x || 'Keywords: ' || keywords || coalesce(x || x || '## Abstract' || x || x || abstract, '') || CASE WHEN m THEN x || x || '## Rights information' || x || x || 'c' ELSE '' END || coalesce(x || x || '## Publisher link' || x || x || url, '')
    || x || x || '## Access status' || x || x || '{metadata.NOTE[0]}' || x || '{metadata.NOTE[1]}' || x || x || '> If you legally obtain the main article PDF, place exactly ONE `.pdf` file in:' || x || '> `lib/' || c_custkey || '`' || x
    || '> The PDF filename can be anything.' || x || x || '> Then rerun:' || x || '> `process ' || c_custkey || '`' || x AS markdown FROM f, n""")
def q36_partial_markdown(spark, sf_dir):
    d = _sides(spark, sf_dir)
    doi, folder, rerun = (F.concat(F.lit(x), F.col("c_custkey").cast("string")) for x in ("10.1234/c", "lib/", "process "))
    return d.select("c_custkey", metadata.partial_markdown(doi, "f", folder, rerun).alias("markdown"))


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '{manifest.RECOVERED}' ELSE 'restricted_access' END AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END AS full_text_available, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'because' END AS reason,
    CASE WHEN o_orderkey % 3 = 0 THEN 'lib/' || o_orderkey || '.pdf' END AS recovered_pdf FROM orders WHERE o_orderkey % 4 <> 0 OR o_orderkey % 3 = 0""")
def q37_access_upsert(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("10.1/"), "o_orderkey").alias("doi"))
    old = F.create_map(F.lit("status"), F.lit("restricted_access"), F.lit("full_text_available"), F.lit("false"), F.lit("reason"), F.lit("because"))
    log = o.select("doi", F.when(F.col("o_orderkey") % 4 != 0, old).alias("payload"))
    fresh = o.where("o_orderkey % 3 = 0").select("doi", F.lit("local_pdf_mineru").alias("recovered_source"), F.concat(F.lit("lib/"), "o_orderkey", F.lit(".pdf")).alias("recovered_pdf"))
    out = manifest.upsert_access(log, fresh).where(F.size("payload") > 0)
    get = lambda k: F.try_element_at("payload", F.lit(k)).alias(k)
    return out.select(F.expr("cast(substring(doi, 6) as bigint)").alias("o_orderkey"), get("status"), get("full_text_available"), get("reason"), get("recovered_pdf"))


PDF = "concat(CASE WHEN o_orderkey % 5 = 0 THEN '<html>' ELSE '%PDF-1.7' END, repeat('x', CAST(o_orderkey % 90 AS INT)))"
PAGES = "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 0 ELSE o_orderkey % 4 END"
EXPECTED = "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 6 END"


@query(f"""WITH x AS (SELECT o_orderkey, CAST({PAGES} AS BIGINT) AS found, CAST({EXPECTED} AS BIGINT) AS wanted, CAST(length({PDF}) AS BIGINT) AS actual_bytes, o_orderkey % 5 <> 0 AS sig FROM orders)
    SELECT o_orderkey, CASE WHEN NOT sig THEN 'invalid_not_pdf' WHEN found IS NULL THEN 'invalid_parse_error' WHEN found <= 0 THEN 'invalid_page_count' WHEN wanted IS NULL THEN 'candidate' WHEN wanted <> found THEN 'invalid_page_count' ELSE 'valid' END AS pdf_status,
        sig AND coalesce(found > 0, false) AS pdf_acceptable, CASE WHEN sig AND found > 0 AND wanted IS NOT NULL THEN wanted = found END AS pages_match_expected, actual_bytes, actual_bytes / CAST(50 AS DOUBLE) AS byte_ratio_expected FROM x""")
def q38_pdf_state(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.expr(PDF).cast("binary").alias("content"), F.expr(PAGES).cast("long").alias("actual_pages"), F.expr(EXPECTED).cast("long").alias("expected_pages"), F.lit(50).cast("long").alias("expected_bytes"))
    return audit.pdf_state(o).select("o_orderkey", "pdf_status", "pdf_acceptable", "pages_match_expected", "actual_bytes", "byte_ratio_expected")


FILE = "concat('f', o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '.PDF' WHEN 1 THEN '.pdf' WHEN 2 THEN '.xml' ELSE '.txt' END)"


@query(f"""WITH x AS (SELECT o_custkey, {FILE} AS name FROM orders), g AS (SELECT o_custkey, count(*) FILTER (WHERE lower(name) LIKE '%.pdf') AS n_pdf, min(name) FILTER (WHERE lower(name) LIKE '%.pdf') AS one, coalesce(string_agg(name, ',' ORDER BY name) FILTER (WHERE lower(name) LIKE '%.pdf'), '') AS pdfs FROM x GROUP BY o_custkey)
    SELECT o_custkey, n_pdf, pdfs, CASE WHEN n_pdf = 1 THEN one END AS pdf, CASE WHEN n_pdf > 1 THEN 'multiple_local_pdf' END AS error FROM g""")
def q39_local_pdf_choice(spark, sf_dir):
    return manifest.find_local_pdf(read(spark, sf_dir, "orders").select("o_custkey", F.expr(FILE).alias("name")), "o_custkey").withColumn("pdfs", F.array_join("pdfs", ","))


@query("""WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN ' ' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS y, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'May' ELSE CAST(month(o_orderdate) AS VARCHAR) END AS m, CAST(day(o_orderdate) AS VARCHAR) AS d FROM orders)
    SELECT o_orderkey, CASE WHEN trim(y) <> '' THEN concat_ws('-', y, CASE WHEN m = 'May' THEN m ELSE lpad(m, 2, '0') END, lpad(d, 2, '0')) END AS padded, concat_ws('-', nullif(trim(y), ''), m, d) AS plain FROM x""")
def q40_pub_date(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("IF(o_orderkey % 6 = 0, ' ', cast(year(o_orderdate) as string))").alias("y"),
        F.expr("CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'May' ELSE cast(month(o_orderdate) as string) END").alias("m"), F.expr("cast(day(o_orderdate) as string)").alias("d"),
    )
    return o.select("o_orderkey", tx.date_text("y", "m", "d").alias("padded"), tx.date_text("y", "m", "d", False).alias("plain"))


@query("SELECT min(doc_id) AS doc_id, sha256(lower(coalesce(text, ''))) AS key FROM documents GROUP BY lower(coalesce(text, ''))")
def q41_first_occurrence(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.sha2(F.lower(F.coalesce("text", F.lit(""))).cast("binary"), 256).alias("key"))
    return manifest.first_occurrence(d, F.col("key"), "doc_id")


from . import article_queries  # noqa: E402, F401  registers more of them
