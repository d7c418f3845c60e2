"""Writing results as files: one folder per paper, and the batch manifest as one CSV file."""

from __future__ import annotations

import csv
import io
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.manifest import FIELDS

#: Files of fetched artifacts. Metadata answers are kept as their safe part only. Fixed values.
RAW = {"publisher_xml": "paper.xml", "oa_response": "springer_oa_response.xml", "jats_xml": "paper.jats.xml", "article_html": "paper.html", "public_pdf": "paper.pdf", "explicit_pdf": "paper.pdf", "content_zip": "mineru.zip"}


def open_store(path: str):
    """File system and base path of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Writes (paper_id, name, data) as root/paper_id/name; returns (paper_id, name, bytes).

    Each file is written under a name of its own and then moved, so a task that is run again leaves
    whole files with the same content. Reading the result writes again; cache or write it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(root)
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                folder = f"{base.rstrip('/')}/{r['paper_id']}"
                store.create_dir(folder, recursive=True)
                part = f"{folder}/.{r['name']}.{uuid.uuid4().hex}"
                with store.open_output_stream(part, compression=None) as out:
                    out.write(r["data"])
                store.move(part, f"{folder}/{r['name']}")
            yield pa.RecordBatch.from_arrays([pa.array([r["paper_id"] for r in rows], pa.string()), pa.array([r["name"] for r in rows], pa.string()), pa.array([len(r["data"]) for r in rows], pa.int64())], ["paper_id", "name", "bytes"])

    return files.select("paper_id", "name", F.col("data").cast("binary").alias("data")).where("data is not null").mapInArrow(run, "paper_id string, name string, bytes long")


def result_files(results: DataFrame, qa: DataFrame) -> DataFrame:
    """(paper_id, name, data) of results (paper_id, doi, markdown, raw_markdown, files) and their QA documents (doi, qa)."""
    text = lambda name, c: results.select("paper_id", F.lit(name).alias("name"), F.col(c).alias("data"))
    more = results.where("files is not null").select("paper_id", F.explode("files").alias("name", "data"))
    own = qa.join(results.select("doi", "paper_id"), "doi").select("paper_id", F.lit("qa.json").alias("name"), F.col("qa").alias("data"))
    return text("paper_llm.md", "markdown").unionByName(text("paper_raw.md", "raw_markdown")).unionByName(more).unionByName(own).where("data is not null").withColumn("data", F.col("data").cast("binary"))


def artifact_files(artifacts: DataFrame) -> DataFrame:
    """(paper_id, name, data) of artifacts (paper_id, kind, content) that have a canonical file."""
    names = F.create_map(*[F.lit(x) for kv in RAW.items() for x in kv])
    return artifacts.select("paper_id", F.try_element_at(names, "kind").alias("name"), F.col("content").alias("data")).where("name is not null and data is not null")


def write_manifest_csv(items: DataFrame, path: str) -> int:
    """One CSV file in the order of index, with a byte order mark. Rows come partition by partition."""
    store, target = open_store(path)
    folder = target.rpartition("/")[0]
    if folder:
        store.create_dir(folder, recursive=True)
    n = 0
    with store.open_output_stream(target + ".part", compression=None) as out:
        text = io.TextIOWrapper(out, encoding="utf-8-sig", newline="")
        writer = csv.writer(text)
        writer.writerow(FIELDS)
        for r in items.select(*FIELDS).orderBy("index").toLocalIterator():
            writer.writerow(r)
            n += 1
        text.flush()
        text.detach()
    store.move(target + ".part", target)
    return n


def exists(path: str) -> bool:
    from pyarrow import fs

    store, target = open_store(path)
    return store.get_file_info(target).type != fs.FileType.NotFound


def remove(path: str) -> None:
    store, target = open_store(path)
    store.delete_dir(target)


def read_manifest_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    rows = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("emptyValue", "").csv(path)
    return rows.fillna("")
