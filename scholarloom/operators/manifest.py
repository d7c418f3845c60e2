"""Work lists, source choice, manifests, summaries and the access log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import casefold, strip

FIELDS = ("index", "doi", "route", "source", "status", "fallback_used", "llm_markdown", "qa", "error")


def first_occurrence(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key. The limit on row_number is applied before the shuffle, so a frequent key stays cheap."""
    n = F.row_number().over(Window.partitionBy("__key").orderBy(order))
    return df.withColumn("__key", key).withColumn("__n", n).where("__n = 1").drop("__key", "__n")


def doi_list(lines: DataFrame, line: str = "line", pos: str = "pos") -> DataFrame:
    """Lines of a work list without blanks, comments and repeats in any case; the first spelling stays."""
    text = strip(F.regexp_replace(F.col(line), "^﻿", ""))
    kept = lines.withColumn("doi_raw", text).where((F.col("doi_raw") != "") & ~F.col("doi_raw").startswith("#"))
    return first_occurrence(kept, casefold("doi_raw"), pos).select(pos, "doi_raw")


def choose_source(candidates: DataFrame, key: str = "doi", priority: str = "priority") -> DataFrame:
    """The candidate of lowest priority number that is usable (ok), one per key."""
    best = F.min_by(F.struct(*[c for c in candidates.columns if c != key]), F.col(priority))
    return candidates.where("ok").groupBy(key).agg(best.alias("best")).select(key, "best.*")


def find_local_pdf(files: DataFrame, directory: str = "directory", name: str = "name", explicit: str | None = None) -> DataFrame:
    """Per directory: n_pdf, pdfs by name, pdf (the explicit one, else the only one) and error."""
    pdf = F.lower(name).endswith(".pdf")
    found = files.groupBy(directory, *([explicit] if explicit else [])).agg(F.count_if(pdf).alias("n_pdf"), F.array_sort(F.collect_list(F.when(pdf, F.col(name)))).alias("pdfs"))
    given = F.col(explicit) if explicit else F.lit(None).cast("string")
    bad = given.isNotNull() & ~F.lower(given).endswith(".pdf")
    return found.select(
        directory, F.col("n_pdf").cast("long").alias("n_pdf"), "pdfs",
        F.when(given.isNotNull() & ~bad, given).when(given.isNull() & (F.col("n_pdf") == 1), F.get("pdfs", F.lit(0))).alias("pdf"),
        F.when(bad, "explicit_not_pdf").when(given.isNull() & (F.col("n_pdf") > 1), "multiple_local_pdf").alias("error"),
    )


def manifest(results: DataFrame) -> DataFrame:
    """Result rows (index, doi, route, source, status, fallback_used, llm_markdown, qa, error) as text, a failed row with its error only."""
    failed = F.col("error").isNotNull()
    text = lambda c: F.when(failed, F.lit("")).otherwise(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return results.select(
        F.col("index").cast("long").alias("index"), "doi", text("route").alias("route"), text("source").alias("source"),
        F.when(failed, "failed").otherwise(F.col("status")).alias("status"),
        F.when(~failed & F.coalesce("fallback_used", F.lit(False)), "true").otherwise("false").alias("fallback_used"),
        text("llm_markdown").alias("llm_markdown"), text("qa").alias("qa"), F.coalesce("error", F.lit("")).alias("error"),
    )


def summary(items: DataFrame) -> DataFrame:
    count = lambda s: F.count_if(F.col("status") == s).cast("long").alias(f"{s}_count")
    return items.agg(F.count("*").cast("long").alias("total"), count("success"), count("warning"), count("failed"))


def write_manifest(items: DataFrame, path: str) -> None:
    """CSV with a header in the fixed order of columns."""
    items.select(*FIELDS).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


RECOVERED = "recovered_with_pdf"
RECOVERY_NOTE = "A PDF was processed successfully through the page-content route."


def upsert_access(log: DataFrame, recovered: DataFrame) -> DataFrame:
    """The access log (doi, payload: a map of texts) with six entries laid over those of recovered papers (doi, recovered_source, recovered_pdf).

    Papers without a log entry get none; other entries of a payload stay; an unreadable payload counts as empty.
    """
    new = F.create_map(
        F.lit("doi"), F.col("doi"), F.lit("status"), F.lit(RECOVERED), F.lit("full_text_available"), F.lit("true"),
        F.lit("recovered_source"), F.col("recovered_source"), F.lit("recovered_pdf"), F.col("recovered_pdf"), F.lit("recovery_note"), F.lit(RECOVERY_NOTE),
    )
    old = F.coalesce("payload", F.create_map().cast("map<string,string>"))
    rest = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(F.col("fresh")), k))
    merged = F.when(F.col("fresh").isNotNull(), F.map_concat(rest, "fresh")).otherwise(old)
    return log.join(recovered.withColumn("fresh", new).select("doi", "fresh"), "doi", "left").select("doi", merged.alias("payload"))
