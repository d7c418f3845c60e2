"""Article identifiers: normal form, route, names and addresses."""

from __future__ import annotations

import re
from urllib.parse import unquote as unquoted
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col, strip

# Resolver hosts, and prefixes in the order in which they are tried.
HOSTS = ("doi.org", "www.doi.org", "dx.doi.org")
ROUTES = (
    ("10.1016/", "elsevier", "elsevier", True),
    ("10.1007/s12273", "springer_nature", "building_simulation", True),
    ("10.1038/", "springer_nature", "nature", True),
    ("10.1007/", "springer_nature", "unsupported", False),
)
OTHERWISE = ("unknown", "unsupported", False)


def unquote(c: Column) -> Column:
    """Percent-decoding that leaves + and broken escapes alone."""
    whole = F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(F.replace(whole, F.lit("+"), F.lit("%2B")))


def _doi_parts(value: Column | str) -> tuple[Column, Column, Column]:
    text = strip(F.regexp_replace(strip(value), "^[<>]+|[<>]+$", ""))
    is_url = F.lower(text).rlike("^https?://")
    host = F.lower(F.regexp_extract(text, r"(?i)^https?://(?:[^/?#]*@)?([^/?#:]*)", 1))
    path = F.regexp_replace(F.regexp_extract(text, r"(?i)^https?://[^/?#]*([^?#]*)", 1), "^/+", "")
    known = ~is_url | host.isin(*HOSTS)
    bare = F.when(is_url, path).otherwise(text)
    bare = F.when(F.lower(bare).startswith("doi:"), strip(F.substr(bare, F.lit(5)))).otherwise(bare)
    return strip(value), known, F.lower(strip(unquote(bare)))


def normalize_doi(value: Column | str) -> Column:
    """The canonical lower-case DOI, or null."""
    _, known, doi = _doi_parts(value)
    return F.when(known & doi.rlike(r"(?U)^10[.]\d{4,9}/\S+\z"), doi)


def plain_doi(text: str | None) -> str | None:
    """normalize_doi for one text inside a worker."""
    t = (text or "").strip().strip("<>").strip()
    if re.match("https?://", t, re.I):
        parts = urlsplit(t)
        if (parts.hostname or "").lower() not in HOSTS:
            return None
        t = parts.path.lstrip("/")
    if t[:4].lower() == "doi:":
        t = t[4:].strip()
    t = unquoted(t).strip().lower()
    return t if re.fullmatch(r"10[.]\d{4,9}/\S+", t) else None


def doi_error(value: Column | str) -> Column:
    """Why there is no DOI: empty, unsupported_host or invalid; null if there is one."""
    text, known, doi = _doi_parts(value)
    return F.when(text.isNull() | (text == ""), "empty").when(~known, "unsupported_host").when(~doi.rlike(r"(?U)^10[.]\d{4,9}/\S+\z"), "invalid")


def with_route(df: DataFrame, doi: str = "doi") -> DataFrame:
    """Adds publisher, route and supported. A null DOI has null ones."""
    d = F.col(doi)

    def pick(at: int) -> Column:
        out = F.when(d.isNull(), None)
        for prefix, *values in ROUTES:
            out = out.when(d.startswith(prefix), F.lit(values[at]))
        return out.otherwise(F.lit(OTHERWISE[at]))

    return df.withColumns({"publisher": pick(0), "route": pick(1), "supported": pick(2)})


def dirname(doi: Column | str, longest: int = 120) -> Column:
    """A directory name: reserved characters become _, a long name ends in a hash of the DOI."""
    d = col(doi)
    name = F.regexp_replace(F.regexp_replace(d, r'[<>:"/\\|?*\x00-\x1f]', "_"), "[ .]+$", "")
    short = F.concat(F.left(name, F.lit(longest - 14)), F.lit("--"), F.left(F.sha2(d, 256), F.lit(12)))
    return F.when(F.char_length(name) <= longest, name).otherwise(short)


def quote(c: Column, safe: str = "") -> Column:
    """Percent-encoding of everything but letters, digits, - . _ ~ and safe."""
    out = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    for raw, code in (("~", "%7E"),):
        out = F.replace(out, F.lit(code), F.lit(raw))
    out = F.replace(out, F.lit("*"), F.lit("%2A"))
    for raw in safe:
        if raw not in "-._~":
            out = F.replace(out, F.lit(f"%{ord(raw):02X}"), F.lit(raw))
    return out


# publishers' addresses.
ARTICLE_API = "https://api.elsevier.com/content/article/doi"
NATURE_ARTICLES = "https://www.nature.com/articles"
SPRINGER_ARTICLES = "https://link.springer.com/article"
SPRINGER_PDFS = "https://link.springer.com/content/pdf"


def article_urls(df: DataFrame, doi: str = "doi", route: str = "route") -> DataFrame:
    """Adds article_url and pdf_url of the route; a family the route does not cover has nulls."""
    d, r = F.col(doi), F.col(route)
    suffix = F.regexp_replace(d, "^[^/]*/", "")
    nature = F.concat(F.lit(NATURE_ARTICLES + "/"), quote(suffix))
    whole = quote(d, "/")
    return df.withColumns({
        "article_url": F.when(r == "elsevier", F.concat(F.lit(ARTICLE_API + "/"), whole)).when(r == "nature", nature).when(r == "building_simulation", F.concat(F.lit(SPRINGER_ARTICLES + "/"), whole)),
        "pdf_url": F.when(r == "nature", F.concat(nature, F.lit(".pdf"))).when(r == "building_simulation", F.concat(F.lit(SPRINGER_PDFS + "/"), whole, F.lit(".pdf"))),
    })


#: Canonical files of a paper's directory. Fixed values.
FILES = {
    "metadata_json": "metadata.json", "pdf": "paper.pdf", "xml": "paper.xml", "jats_xml": "paper.jats.xml", "html": "paper.html", "raw_md": "paper_raw.md",
    "llm_md": "paper_llm.md", "tables_md": "tables.md", "tables_json": "tables.json", "qa_json": "qa.json",
}
FOLDERS = ("input", "library", "manifests", "logs", "cache")


def paper_paths(df: DataFrame, root: str, doi: str = "doi") -> DataFrame:
    """Adds paper_id, directory and the path of each canonical file."""
    out = df.withColumn("paper_id", dirname(doi)).withColumn("directory", F.concat_ws("/", F.lit(root.rstrip("/")), "paper_id"))
    return out.withColumns({k: F.concat_ws("/", "directory", F.lit(v)) for k, v in FILES.items()})


def workspace_paths(root: str = "workspace") -> dict[str, str]:
    return {"root": root} | {name: f"{root.rstrip('/')}/{name}" for name in FOLDERS}


def directly_in(path: Column | str, directory: Column | str) -> Column:
    return F.regexp_extract(col(path), "^(.*)/[^/]+$", 1) == F.regexp_replace(col(directory), "/+$", "")


def join_url(base: Column | str, href: Column | str) -> Column:
    """An href resolved against the page it stands on, for absolute, host-relative, root-relative and plain ones."""
    b, h = col(base), strip(href)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    host = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(b, "[?#].*$", ""), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*(?:/.*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(host, F.lit("/")))
    return F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h).when(h.startswith("//"), F.concat(scheme, h)).when(h.startswith("/"), F.concat(host, h)).when(h == "", b).otherwise(F.concat(folder, h))
