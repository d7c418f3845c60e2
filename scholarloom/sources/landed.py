"""Readers of landed files. Paths may be in any store that Spark reads; nothing is opened on the driver."""

from __future__ import annotations

import io
import re
import subprocess
import tempfile
import zipfile
import zlib
from functools import reduce
from pathlib import Path

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.blocks import parse_content
from ..operators.manifest import doi_list

MEMBER = "structured_content.json"
KINDS = {"paper.xml": "publisher_xml", "paper.jats.xml": "jats_xml", "paper.html": "article_html", "springer_meta.json": "metadata_json", "access.json": "access_json", "mineru.zip": "content_zip", "structured_content.json": "content_json"}


def read_doi_list(spark: SparkSession, path: str) -> DataFrame:
    """(pos, doi_raw) of a UTF-8 text file, a byte order mark allowed."""
    try:
        whole = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"the work list does not exist: {path}") from None
        raise
    lines = whole.select(F.posexplode(F.split("value", r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")).alias("pos", "line"))
    return doi_list(lines)


def some_dois(dois: DataFrame, path: str) -> int:
    """How many entries a work list has; none is an error."""
    n = dois.count()
    if not n:
        raise ValueError(f"no DOI in the work list: {path}")
    return n


def read_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """(paper_id, name, kind, content, bytes) of all files of known names below root/<paper_id>/; any *.pdf is a local_pdf.

    Each kind is a scan of its own that lists its names only, so a filter on kind reads no other files.
    """

    def files(pattern: str) -> DataFrame:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)

    parts = [files(name).withColumn("kind", F.lit(kind)) for name, kind in KINDS.items()]
    parts.append(files("*.[pP][dD][fF]").withColumn("kind", F.lit("local_pdf")))
    place = F.split("path", "/")
    return reduce(DataFrame.unionByName, parts).select(F.element_at(place, -2).alias("paper_id"), F.element_at(place, -1).alias("name"), "kind", "content", F.col("length").alias("bytes"))


def member_of(content: bytes | None) -> tuple[str | None, str | None]:
    """The content JSON of an archive, or why there is none."""
    try:
        with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
            return z.read(MEMBER).decode("utf-8"), None
    except KeyError:
        return None, "member_missing"
    except (zipfile.BadZipFile, UnicodeDecodeError, zlib.error, OSError, EOFError):
        return None, "invalid_zip"


def read_content_zips(artifacts: DataFrame, content: str = "content", unzip=member_of) -> DataFrame:
    """Adds content_json and zip_error of zipped page content. Each archive is opened once, whatever is used of it."""
    out = StructType([StructField("content_json", StringType()), StructField("zip_error", StringType())])

    run = F.pandas_udf(lambda s: pd.DataFrame([unzip(b) for b in s], columns=["content_json", "zip_error"]), out).asNondeterministic()
    return artifacts.withColumn("__m", run(content)).select("*", "__m.*").drop("__m")


def read_content_json(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of JSON files, one document each."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), parse_content("value").alias("content"))


# PDF pages without a PDF library.

_OBJECT = re.compile(rb"(?<!\d)(\d{1,10})\s+\d{1,5}\s+obj\b(.*?)(?=\bendobj\b)", re.S)
_STREAM = re.compile(rb"/ObjStm\b.*?stream\r?\n(.*?)\r?\nendstream", re.S)
_PAGE = re.compile(rb"/Type\s*/Page(?![A-Za-z])")
_REF = re.compile(rb"(\d+)\s+\d+\s+R\b")


def _number(body: bytes, name: bytes) -> int | None:
    m = re.search(rb"/" + name + rb"\s+(\d+)(?!\s+\d+\s+R)", body)
    return int(m[1]) if m else None


def pdf_objects(data: bytes) -> dict[int, bytes]:
    """Objects by number, those in compressed object streams included; of several versions the last counts."""
    out: dict[int, bytes] = {}
    for m in _OBJECT.finditer(data):
        number, body = int(m[1]), m[2]
        out[number] = body
        packed = _STREAM.search(body + b"\nendstream" if b"/ObjStm" in body and b"endstream" not in body else body)
        n, first = (_number(body, k) for k in (b"N", b"First")) if packed else (None, None)
        if n is None or first is None:
            continue
        try:
            text = zlib.decompress(packed[1])
            head = list(map(int, text[:first].split()))[: 2 * n]
        except (zlib.error, ValueError):
            continue
        places = [*head[1::2], len(text) - first]
        for own, lo, hi in zip(head[::2], places, places[1:], strict=False):
            out[own] = text[first + lo : first + hi]
    return out


def page_leaves(objects: dict[int, bytes]) -> int | None:
    """Pages below the catalogue's page tree; null if there is no such tree."""
    roots = [m for body in objects.values() if re.search(rb"/Type\s*/Catalog\b", body) and (m := re.search(rb"/Pages\s+(\d+)\s+\d+\s+R", body))]
    if not roots:
        return None
    todo, seen, n = [int(roots[-1][1])], set(), 0
    while todo:
        number = todo.pop()
        if number in seen or number not in objects:
            continue
        seen.add(number)
        body = objects[number]
        kids = re.search(rb"/Kids\s*(?:\[(.*?)\]|(\d+)\s+\d+\s+R)", body, re.S)
        if kids:
            todo += map(int, _REF.findall(kids[1] if kids[1] is not None else objects.get(int(kids[2]), b"")))
        else:
            n += bool(_PAGE.search(body))
    return n


def count_pages(content: bytes | None) -> int | None:
    """Pages of a PDF: the leaves of its page tree, or all page objects where it has none; null if it is no readable PDF.

    A damaged file, one without an end mark or an encrypted one counts as unreadable.
    """
    data = bytes(content or b"")
    if not data.startswith(b"%PDF-") or b"%%EOF" not in data[-2048:] or b"/Encrypt" in data:
        return None
    leaves = page_leaves(pdf_objects(data))
    if leaves is not None:
        return leaves
    n = len(_PAGE.findall(data))
    for m in _STREAM.finditer(data):
        try:
            n += len(_PAGE.findall(zlib.decompress(m[1])))
        except zlib.error:
            continue
    return n


def with_page_count(df: DataFrame, content: str = "content", counter=count_pages) -> DataFrame:
    """Adds actual_pages by a counter of bytes; any callable can take the place of the built-in one."""
    from pyspark.sql.types import LongType

    count = F.pandas_udf(lambda s: s.map(counter).astype("Int64"), LongType())
    return df.withColumn("actual_pages", count(content))


def parse_pdfs(df: DataFrame, parser, content: str = "content") -> DataFrame:
    """Adds content_json by a callable from PDF bytes to JSON text, such as a wrapper of an external program; its failures are error values."""
    out = StructType([StructField("content_json", StringType()), StructField("parser_error", StringType())])

    def one(b):
        try:
            return parser(bytes(b)), None
        except Exception as e:  # noqa: BLE001  a row's failure is its value
            return None, f"{type(e).__name__}: {e}"

    run = F.pandas_udf(lambda s: pd.DataFrame([one(b) for b in s], columns=["content_json", "parser_error"]), out).asNondeterministic()
    return df.withColumn("__p", run(content)).select("*", "__p.*").drop("__p")


def external_parser(executable: str, tier: str = "advanced"):
    """A parser that runs an external program: PDF bytes to content JSON, by way of the archive that it writes into a folder of its own."""
    if not tier.strip():
        raise ValueError("the parser's tier is empty")

    def parse(content: bytes) -> str:
        with tempfile.TemporaryDirectory() as folder:
            pdf, out = Path(folder) / "paper.pdf", Path(folder) / "out"
            pdf.write_bytes(content)
            out.mkdir()
            done = subprocess.run([executable, "parse", str(pdf), "--pages", "all", "--tier", tier, "--format", "zip", "-o", str(out)], capture_output=True, text=True, encoding="utf-8", errors="replace", check=False)
            if done.returncode:
                raise RuntimeError("\n".join(x for x in (f"exit code {done.returncode}", done.stdout.strip(), done.stderr.strip()) if x))
            text, error = member_of(chosen_zip(out, pdf.stem).read_bytes())
            if error:
                raise ValueError(error)
            return text

    return parse


def chosen_zip(folder: Path, stem: str) -> Path:
    """The archive named after the PDF, else the only one there is."""
    if (folder / f"{stem}.zip").is_file():
        return folder / f"{stem}.zip"
    found = sorted(folder.glob("*.zip"))
    if len(found) != 1:
        raise ValueError(f"expected one archive, found {len(found)}: {', '.join(p.name for p in found)}")
    return found[0]
