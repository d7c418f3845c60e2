"""Incremental processing of landed files: each micro-batch runs the batch plan and appends its results.

Finished papers are kept as they finish, so an interrupted run loses nothing and goes on from its
checkpoint. The micro-batch id is part of the output path, so a repeated batch overwrites itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.blocks import parse_content, render, source_tables
from ..operators.audit import content_audit, content_gate


def content_results(rows: DataFrame, key: str = "paper_id", json: str = "content_json") -> DataFrame:
    """(paper_id, markdown, status, failures, warnings) of page content."""
    parsed = rows.withColumn("content", parse_content(json)).where("content.pages is not null").withColumn("is_full_document", F.col("content.is_full_document"))
    done = content_gate(content_audit(render(parsed).withColumn("source_tables", source_tables("blocks"))))
    return done.select(key, "markdown", "status", "failures", "warnings")


def landed_stream(spark: SparkSession, folder: str, schema: str = "paper_id string, content_json string", files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def run(stream: DataFrame, out: str, checkpoint: str, plan: Callable[[DataFrame], DataFrame] = content_results, once: bool = True) -> StreamingQuery:
    def batch(df: DataFrame, batch_id: int) -> None:
        plan(df).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
