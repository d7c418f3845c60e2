import json

from pyspark.sql import functions as F

from scholarloom.operators import audit, blocks

TABLE = '<table><tr><td rowspan="2">42.5</td><td>-3</td></tr></table>'


def rendered(spark, *docs):
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "id int, j string").withColumn("content", blocks.parse_content("j"))
    df = blocks.render(df.withColumn("is_full_document", F.col("content.is_full_document"))).withColumn("source_tables", blocks.source_tables("blocks"))
    return audit.content_gate(audit.content_audit(df)).orderBy("id").collect()


def doc(*bs, **more):
    return {"pages": [{"page_idx": 0, "blocks": list(bs)}]} | more


def b(kind, content=None, **more):
    return {"type": kind, "content": content} | more


def test_full_document(spark):
    d = doc(
        b("doc_title", "Title"), b("header", "x"), b("paragraph_title", "1 Introduction", level=1), b("text", " See CO<sup>2</sup> "), b("page_number", "3"), b("text", "and more", continues_prev=True),
        b("table", TABLE, captions=[{"content": "Table 1"}], footnotes=[{"content": "note"}]), b("text", "goes on", continues_prev=True), b("image", "~0.9", captions=[{"content": "Fig"}]), b("interline_equation", "x"),
        b("paragraph_title", "References"), b("list", "[1] A", sub_type="ref_text"), is_full_document=True,
    )
    [r] = rendered(spark, d)
    assert r.markdown == f"# Title\n\n## 1 Introduction\n\nSee CO<sup>2</sup> and more\n\n**Table 1**\n\n{TABLE}\n\nnote goes on\n\n**Fig**\n\n## References\n\n[1] A\n"
    assert (r.table_count, r.image_count, r.display_equations_removed, r.references_present, r.unknown_block_types) == (1, 1, 1, True, [])
    assert r.table_numeric_values_match and r.source_numeric_tokens == 3 and r.failures == [] and r.warnings == [] and r.status == "success"
    assert r.block_counts["text"] == 3


def test_image_in_cell_and_gates(spark):
    one, two, three = rendered(
        spark,
        doc(b("table", '<td><img src="images/12_1.jpg"/></td><td>42.5</td>'), b("paragraph_title", "Bibliography"), is_full_document=False),
        doc(b("text", "Ã and \ue000 ![x](y)"), b("odd_kind", "kept"), b("list", "r", sub_type="ref_text")),
        doc(b("table", "<img/>"), b("text", "x", continues_prev=True), b("paragraph_title", "References")),
    )
    assert "<td></td>" in one.markdown and one.source_numeric_tokens == 1 and one.status == "warning" and one.warnings == ["mineru_not_marked_full_document"]
    assert two.failures == ["references_missing", "remaining_images", "mojibake"] and two.references_present and two.warnings == ["private_use_characters", "unknown_block_types"] and "kept" in two.markdown
    assert three.markdown == "x\n\n## References\n" and three.status == "success"


def test_continuation_skips_what_renders_nothing(spark):
    one, two = rendered(spark, doc(b("text", "a"), b("header", "h"), b("text", " "), b("text", "b", continues_prev=True)), doc(b("list", "a"), b("text", "b", continues_prev=True)))
    assert one.markdown == "a b\n" and two.markdown == "a\n\nb\n"


def test_odd_content(spark):
    df = spark.createDataFrame([("[1]",), ('{"pages": 5}',), ("not json",), (None,), ('{"pages": []}',), ('{"pages":[{"page_idx":0},{"blocks":[{"type":"text","content":5},null]}]}',)], "j string").withColumn("content", blocks.parse_content("j"))
    assert [bool(r[0]) for r in df.select(blocks.is_valid("content")).collect()] == [False, False, False, False, True, True]
    assert [r.markdown for r in blocks.render(df.where(blocks.is_valid("content"))).collect()] == ["\n", "5\n"]


def test_corrupted_table_is_found(spark):
    df = spark.createDataFrame([([TABLE, "<b>7</b>", "<b>7</b>"], f"a {TABLE} <b>7</b> b"), ([TABLE], TABLE.replace("42.5", "42.6"))], "source_tables array<string>, markdown string")
    one, two = audit.content_audit(df).collect()
    assert (one.matched_table_count, one.table_content_exact_match) == (2, False) and two.matched_table_count == 0 and not two.table_numeric_values_match


def test_paragraphs(spark):
    df = spark.createDataFrame([(1, json.dumps(doc(b("text", "a"), b("text", "b", continues_prev=True), b("list", "c"))))], "id int, j string").withColumn("content", blocks.parse_content("j"))
    assert [tuple(r)[1:] for r in blocks.paragraphs(blocks.with_pieces(df), "id").orderBy("item").collect()] == [(0, "text", "a b"), (1, "list", "c")]


def test_paragraphs_keep_any_character(spark):
    """A control character is text, and a document that renders nothing has no items."""
    docs = [doc(b("text", "a\u0001b\u0002"), b("text", "\u0001c", continues_prev=True), b("paragraph_title", "0.1 ")), doc(b("text", " "))]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, j string").withColumn("content", blocks.parse_content("j"))
    assert [tuple(r) for r in blocks.paragraphs(blocks.with_pieces(df), "id").orderBy("item").collect()] == [(0, 0, "text", "a\u0001b\u0002 \u0001c"), (0, 1, "heading", "### 0.1")]


def test_pdf_states(spark):
    rows = [(b"<html>", None, None, 10), (b"%PDF-1", None, None, None), (b"%PDF-1", 0, None, None), (b"%PDF-1", 3, 3, 12), (b"%PDF-1", 1, 23, None), (b"%PDF-1", 2, None, None), (None, 1, 1, None)]
    got = audit.pdf_state(spark.createDataFrame(rows, "content binary, actual_pages long, expected_pages long, expected_bytes long")).collect()
    assert [g.pdf_status for g in got] == ["invalid_not_pdf", "invalid_parse_error", "invalid_page_count", "valid", "invalid_page_count", "candidate", "invalid_not_pdf"]
    assert [g.pdf_acceptable for g in got] == [False, False, False, True, True, True, False] and got[3].byte_ratio_expected == 0.5 and got[5].pages_match_expected is None
