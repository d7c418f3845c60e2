"""Audits of rendered Markdown and the gates that turn them into a status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, content_numbers, has_mojibake, has_references, occurrences, strip, structured_numbers


def codes(*checks: tuple[str, Column]) -> Column:
    """The codes of the checks that hold, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(code)) for code, test in checks]))


def status(failures: Column | str, warnings: Column | str) -> Column:
    return F.when(F.size(col(failures)) > 0, "failed").when(F.size(col(warnings)) > 0, "warning").otherwise("success")


def matched_tables(tables: Column | str, markdown: Column | str) -> Column:
    """array<int>: the table's place in the Markdown behind the table matched before it, 0 if it isn't there."""
    m = col(markdown)

    def step(state: Column, table: Column) -> Column:
        at = F.when(table == "", state["next"]).otherwise(F.call_function("locate", table, m, state["next"]))
        return F.struct(F.when(at > 0, at + F.char_length(table)).otherwise(state["next"]).alias("next"), F.concat(state["places"], F.array(at)).alias("places"))

    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("places"))
    return F.aggregate(col(tables), start, step, lambda s: s["places"])


def content_audit(df: DataFrame, tables: str = "source_tables", markdown: str = "markdown") -> DataFrame:
    """Adds the audit of a rendered document against its source tables."""
    out = df.withColumn("__places", matched_tables(tables, markdown))
    flat = F.flatten(F.transform(tables, content_numbers))
    found = F.filter(F.arrays_zip(F.col(tables).alias("t"), F.col("__places").alias("at")), lambda x: x["at"] > 0)
    final = F.flatten(F.transform(found, lambda x: content_numbers(x["t"])))
    m = F.col(markdown)
    out = out.withColumns({
        "source_table_count": F.size(tables).cast("long"),
        "matched_table_count": F.size(found).cast("long"),
        "source_numeric_tokens": F.size(flat).cast("long"),
        "final_numeric_tokens": F.size(final).cast("long"),
        "table_content_exact_match": F.size(found) == F.size(tables),
        "table_numeric_values_match": (F.size(found) == F.size(tables)) & (flat == final),
        "has_references": has_references(m),
        **counters(m),
    })
    return out.drop("__places")


def counters(m: Column) -> dict[str, Column]:
    """What must not be left in a Markdown text."""
    return {
        "remaining_images": occurrences(m, "![") + occurrences(m, "image_source") + F.regexp_count(m, F.lit(r"(?i)<img\b")).cast("long"),
        "remaining_base64": occurrences(F.lower(m), "data:image"),
        "remaining_display_equations": occurrences(m, "$$") + occurrences(m, "```math"),
        "private_use_characters": F.regexp_count(m, F.lit(r"[\uE000-\uF8FF]")).cast("long"),
        "mojibake": has_mojibake(m),
    }


def content_gate(df: DataFrame) -> DataFrame:
    """Adds failures, warnings and status of the page-content route; is_full_document must be in df."""
    failures = codes(
        ("table_content_mismatch", ~F.col("table_content_exact_match")), ("table_numeric_values_mismatch", ~F.col("table_numeric_values_match")), ("references_missing", ~F.col("has_references")),
        ("remaining_images", F.col("remaining_images") > 0), ("remaining_base64", F.col("remaining_base64") > 0), ("remaining_display_equations", F.col("remaining_display_equations") > 0), ("mojibake", F.col("mojibake")),
    )
    warnings = codes(
        ("private_use_characters", F.col("private_use_characters") > 0), ("unknown_block_types", F.size("unknown_block_types") > 0),
        ("mineru_not_marked_full_document", F.col("is_full_document") == F.lit(False)),
    )
    return df.withColumns({"failures": failures, "warnings": warnings}).withColumn("status", status("failures", "warnings"))


def publisher_gate(df: DataFrame) -> DataFrame:
    """The same of the publisher-XML route, from the cleaner's and the XML's statistics."""
    some = F.col("reference_count") > 0
    failures = codes(("display_math_remaining", F.col("remaining_display_math") != 0), ("missing_float_tables", F.size("missing_float_table_ids") > 0), ("references_missing", some & ~F.col("has_references")))
    warnings = codes(("image_only_tables", F.size("image_only_float_table_ids") > 0), ("reference_count_mismatch", some & (F.col("reference_count_markdown") != F.col("reference_count"))))
    return df.withColumns({"failures": failures, "warnings": warnings}).withColumn("status", status("failures", "warnings"))


def jats_gate(df: DataFrame) -> DataFrame:
    """Adds fallback_reason, warnings and status of the JATS route: a table whose numbers differ sends the paper to the next source."""
    reason = F.when((F.col("table_count") > 0) & ~F.col("values_match"), "jats_table_numeric_values_mismatch")
    warnings = codes(("references_not_detected", F.col("reference_count") <= 0))
    return df.withColumns({"fallback_reason": reason, "warnings": warnings, "failures": F.array().cast("array<string>")}).withColumn("status", status("failures", "warnings"))


def markdown_table_lines(markdown: Column | str) -> Column:
    """Lines of pipe tables without separator rows (three dashes and more)."""
    lines = F.transform(F.split(col(markdown), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), strip)
    bars = F.filter(lines, lambda x: x.startswith("|") & x.endswith("|"))
    return F.filter(bars, lambda x: ~x.rlike(r"(?U)^\|*\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)*\|*$"))


def markdown_numbers(markdown: Column | str) -> Column:
    """Number tokens of all table rows in order."""
    return F.flatten(F.transform(markdown_table_lines(markdown), structured_numbers))


def values_match(source: Column | str, final: Column | str) -> Column:
    """Equal as sequences, and so as multisets."""
    return col(source) == col(final)


def anchor_count(markdown: Column | str, pattern: str) -> Column:
    return F.size(F.array_distinct(F.regexp_extract_all(col(markdown), F.lit(pattern), F.lit(1)))).cast("long")


def pdf_state(df: DataFrame, content: str = "content", pages: str = "actual_pages", expected_pages: str = "expected_pages", expected_bytes: str = "expected_bytes") -> DataFrame:
    """Adds the state of PDF bytes; pages is what a page counter found, null if it could not read them."""
    size = F.octet_length(content).cast("long")
    signature = F.coalesce(F.col(content).startswith(F.lit(b"%PDF-")), F.lit(False))
    found, wanted, amount = F.col(pages), F.col(expected_pages), F.col(expected_bytes)
    parsed = signature & found.isNotNull()
    state = (
        F.when(~signature, "invalid_not_pdf").when(found.isNull(), "invalid_parse_error").when(found <= 0, "invalid_page_count")
        .when(wanted.isNull(), "candidate").when(wanted != found, "invalid_page_count").otherwise("valid")
    )
    return df.withColumns({
        "pdf_status": state, "is_valid": state == "valid", "signature_ok": signature, "parseable": parsed,
        "pages_match_expected": F.when(parsed & (found > 0) & wanted.isNotNull(), wanted == found),
        "actual_bytes": size, "byte_ratio_expected": F.when(amount > 0, size / amount), "pdf_acceptable": parsed & F.coalesce(found > 0, F.lit(False)),
    })
