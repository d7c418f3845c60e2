"""Whole jobs over a library folder: a batch in waves with an incremental manifest, and rendering landed content again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import dirname, normalize_doi, paper_paths
from ..operators import audit, blocks
from ..operators.manifest import FIELDS
from ..sources import landed, library
from .papers import HELD, Batch, Options, audit_stats, batch_manifest, numbered, qa_json, release, render_stats, settled

WAVE = 10_000
ITEM = "index long, doi string, route string, source string, status string, fallback_used string, llm_markdown string, qa string, error string"


def artifacts_of(spark: SparkSession, root: str, dois: DataFrame, pdf: str | None = None) -> DataFrame:
    """(doi, kind, content) of what has landed for the work list's papers; pdf is an explicitly named file for a list of one."""
    names = dois.select(normalize_doi("doi_raw").alias("doi")).where("doi is not null").distinct().withColumn("paper_id", dirname("doi"))
    out = landed.read_artifacts(spark, root).join(names, "paper_id").select("doi", "kind", "content") if library.exists(root) else spark.createDataFrame([], "doi string, kind string, content binary")
    if pdf is not None:
        if not pdf.lower().endswith(".pdf"):
            raise ValueError(f"not a PDF file name: {pdf}")
        if not library.exists(pdf):
            raise FileNotFoundError(f"the PDF does not exist: {pdf}")
        named = spark.read.format("binaryFile").load(pdf).select(F.lit("explicit_pdf").alias("kind"), "content")
        only = names.collect()
        if len(only) != 1:
            raise ValueError("a named PDF belongs to one paper")
        out = out.unionByName(named.select(F.lit(only[0]["doi"]).alias("doi"), "kind", "content"))
    return out


def write_results(batch: Batch, results: DataFrame) -> int:
    """Writes the files of a batch's papers; returns how many."""
    rows = paper_paths(results.where("error is null"), batch.options.root).select("paper_id", "doi", "markdown", "raw_markdown", "files")
    every = paper_paths(results.select("doi").distinct(), batch.options.root).select("paper_id", "doi").join(rows.drop("doi"), "paper_id", "left")
    files = library.result_files(every, qa_json(results)).unionByName(batch.recovered(results))
    for got in batch.fetched:
        files = files.unionByName(library.artifact_files(got.withColumn("paper_id", dirname("doi")).select("paper_id", "kind", "content")))
    named = batch.artifacts.where("kind = 'explicit_pdf'").select(dirname("doi").alias("paper_id"), "kind", "content")
    files = files.unionByName(library.artifact_files(named))
    return library.write_files(files, batch.options.root).agg(F.count("*")).first()[0]


def run_batch(spark: SparkSession, dois: DataFrame, options: Options, results_path: str, *, artifacts: DataFrame | None = None, wave: int = WAVE, on_result: Callable[[Row, int], None] | None = None) -> DataFrame:
    """Processes a work list (pos, doi_raw) in waves of so many entries; returns the manifest's rows.

    A finished wave's rows lie in results_path.parts until the whole list is done, so a job that was
    interrupted goes on behind them; the CSV file holds all finished waves, also when a later one fails.
    """
    listed = settled(numbered(dois))
    total = landed.some_dois(listed, results_path)
    parts, done, own = f"{results_path}.parts", [], len(HELD)
    try:
        for first in range(1, total + 1, wave):
            part = f"{parts}/from-{first}"
            if not library.exists(f"{part}/_SUCCESS"):
                some = listed.where(F.col("index").between(first, first + wave - 1)).select(F.col("index").alias("pos"), "doi_raw")
                batch = Batch(some, artifacts if artifacts is not None else artifacts_of(spark, options.root, some), options)
                results = settled(batch.run())
                write_results(batch, results)
                items = batch_manifest(results, options)
                items.withColumn("index", F.col("index") + (first - 1)).select(*FIELDS).write.mode("overwrite").parquet(part)
                release(own)
            done.append(part)
            if on_result is not None:
                for row in spark.read.schema(ITEM).parquet(part).orderBy("index").toLocalIterator():
                    on_result(row, total)
    finally:
        if done:
            library.write_manifest_csv(spark.read.schema(ITEM).parquet(*done), results_path)
    library.remove(parts)
    return library.read_manifest_csv(spark, results_path, ITEM)


def rerender(spark: SparkSession, root: str) -> DataFrame:
    """Renders all landed archives below root again, writes paper_llm.md and qa_rerender.json beside them and returns the audits by paper_id."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "mineru.zip").load(f"{root.rstrip('/')}/*/").select(F.element_at(F.split("path", "/"), -2).alias("paper_id"), "content")
    read = settled(landed.read_content_zips(found).drop("content").withColumn("content", blocks.parse_content("content_json")))
    if read.isEmpty():
        raise FileNotFoundError(f"no content archives below {root}")
    rendered = blocks.render(read.where("content.pages is not null")).withColumn("source_tables", blocks.source_tables("blocks"))
    done = settled(audit.content_audit(rendered).select("paper_id", "markdown", render_stats().alias("render"), audit_stats().alias("audit")))
    qa = done.select("paper_id", F.lit("qa_rerender.json").alias("name"), F.to_json(F.struct("render", "audit"), {"pretty": "true", "ignoreNullFields": "false"}).cast("binary").alias("data"))
    text = done.select("paper_id", F.lit("paper_llm.md").alias("name"), F.col("markdown").cast("binary").alias("data"))
    library.write_files(text.unionByName(qa), root).agg(F.count("*")).first()
    bad = read.where("content.pages is null").select("paper_id", F.coalesce("zip_error", F.lit("content_invalid")).alias("error"))
    return done.select("paper_id", "render.*", "audit.*", F.lit(None).cast("string").alias("error")).unionByName(bad, allowMissingColumns=True)


__all__ = ["artifacts_of", "rerender", "run_batch", "write_results"]
