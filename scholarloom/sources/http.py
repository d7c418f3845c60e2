"""Fetching artifacts over HTTP in Spark tasks, with bounded retries.

fetch_rows sends the rows of a request table (see requests.py). The same is there as a Python data
source over a Parquet table of requests, one partition a row group:

    spark.dataSource.register(ArtifactSource)
    spark.read.format("artifact_http").option("requests", path).load()

Only transport errors are tried again, an HTTP status never is; both end up in the error column, and
so does a body that isn't what the request expects. Keys are arguments or options, never columns.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "doi string, kind string, url string, page_url string, content binary, content_type string, http_status int, error string"
# Three attempts, waits of one to five seconds, a minute's timeout.
ATTEMPTS, SHORTEST_WAIT, LONGEST_WAIT, TIMEOUT = 3, 1.0, 5.0, 60.0
AGENT = "scholarloom/0.1 (academic paper processing)"
#: How each key is sent: as a header or as a query parameter. Fixed values.
KEYS = {"publisher": ("header", "X-ELS-APIKey"), "open_access": ("param", "api_key"), "metadata": ("param", "api_key")}


class Answer(NamedTuple):
    content: bytes | None
    content_type: str | None
    status: int | None
    error: str | None
    url: str | None = None


def exchange(url: str, headers: dict[str, str], timeout: float = TIMEOUT, attempts: int = ATTEMPTS, opener=urllib.request.urlopen, sleep=time.sleep) -> Answer:
    wait = SHORTEST_WAIT
    for attempt in range(1, attempts + 1):
        try:
            with opener(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
                return Answer(r.read(), r.headers.get("Content-Type"), r.status, None, getattr(r, "url", None) or url)
        except urllib.error.HTTPError as e:
            return Answer(None, None, e.code, f"HTTP {e.code}")
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            if attempt == attempts:
                return Answer(None, None, None, f"{type(e).__name__}: {e}")
            sleep(min(wait, LONGEST_WAIT))
            wait *= 2
    return Answer(None, None, None, "not asked")


def fetch(url: str, headers: dict[str, str], timeout: float = TIMEOUT, opener=urllib.request.urlopen, sleep=time.sleep) -> tuple[bytes | None, str | None, int | None, str | None]:
    """Content, content type, status and error."""
    return exchange(url, headers, timeout, opener=opener, sleep=sleep)[:4]


def body_error(body: str | None, content: bytes) -> str | None:
    """What is wrong with an answer that should be xml, pdf or json."""
    if body == "xml" and not content.lstrip().startswith(b"<"):
        return "body_not_xml"
    if body == "pdf" and not content.startswith(b"%PDF-"):
        return "body_not_pdf"
    if body == "json":
        try:
            if not isinstance(json.loads(content), dict):
                return "body_not_json_object"
        except ValueError:
            return "body_not_json"
    return None


def send(request: dict, keys: dict[str, str], timeout: float, opener=urllib.request.urlopen, sleep=time.sleep) -> tuple:
    """A request row to a row of SCHEMA. The url column stays without the key."""
    url, headers = request["url"], {"User-Agent": AGENT}
    if request.get("accept"):
        headers["Accept"] = request["accept"]
    if name := request.get("key"):
        if not keys.get(name):
            return request["doi"], request["kind"], url, None, None, None, None, f"no key: {name}"
        how, field = KEYS[name]
        if how == "header":
            headers[field] = keys[name]
        else:
            url += ("&" if "?" in url else "?") + urllib.parse.urlencode({field: keys[name]})
    a = exchange(url, headers, timeout, int(request.get("attempts") or ATTEMPTS), opener, sleep)
    error = a.error or body_error(request.get("body"), a.content)
    page = request["url"] if a.url in (None, url) else a.url
    return request["doi"], request["kind"], request["url"], page, None if error else a.content, a.content_type, a.status, error


def fetch_rows(requests: DataFrame, keys: dict[str, str] | None = None, *, timeout: float = TIMEOUT, opener=urllib.request.urlopen, sleep=time.sleep) -> DataFrame:
    """Request rows to rows of SCHEMA, one answer in memory at a time. Write or checkpoint the result: reading it again asks again."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    held, kinds = dict(keys or {}), to_arrow_schema(StructType.fromDDL(SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(send(row, held, timeout, opener, sleep), kinds, strict=True)], schema=kinds)

    return requests.mapInArrow(run, SCHEMA)


class Part(InputPartition):
    """A row group of the request table."""

    def __init__(self, path: str, group: int):
        self.path, self.group = path, group


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["requests"]
        self.keys = json.loads(options.get("keys", "{}"))
        self.timeout = float(options.get("timeout", TIMEOUT))

    def partitions(self) -> list[Part]:
        import pyarrow.parquet as pq
        from pyarrow import dataset, fs

        store, base = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        files = dataset.dataset(base, filesystem=store, format="parquet", exclude_invalid_files=False).files
        return [Part(f, g) for f in files for g in range(pq.ParquetFile(store.open_input_file(f)).metadata.num_row_groups)]

    def read(self, partition: Part) -> Iterator[tuple]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
        with store.open_input_file(partition.path) as f:
            for row in pq.ParquetFile(f).read_row_group(partition.group).to_pylist():
                yield send(row, self.keys, self.timeout)


class ArtifactSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "artifact_http"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)
