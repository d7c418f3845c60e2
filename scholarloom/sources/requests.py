"""What is asked of publishers: one row per request, without keys; these are put in by the worker that sends it.

Columns: doi, kind (of the artifact that comes back), url, accept, key (name of the access key, if any),
body (what the answer must look like) and attempts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import article_urls, join_url, quote
from ..operators.links import nature_pdf_href, springer_pdf_href

# Addresses and what they are asked with.
OPEN_ACCESS_API = "https://api.springernature.com/openaccess/jats"
METADATA_API = "https://api.springernature.com/meta/v2/json"
PAGES, PDFS = "text/html,application/xhtml+xml", "application/pdf"


def _search(api: str, most: int) -> Column:
    return F.concat(F.lit(f"{api}?q=doi%3A"), quote(F.col("doi")), F.lit(f"&p={most}"))


#: kind: routes, address, Accept, key, body, attempts.
KINDS = {
    "publisher_xml": (("elsevier",), lambda: F.col("article_url"), "text/xml", "publisher", "xml", 3),
    "publisher_metadata": (("elsevier",), lambda: F.col("article_url"), "application/json", "publisher", "json", 3),
    "publisher_pdf": (("elsevier",), lambda: F.concat("article_url", F.lit("?view=FULL")), PDFS, "publisher", "pdf", 3),
    "oa_response": (("nature",), lambda: _search(OPEN_ACCESS_API, 10), "application/xml,text/xml", "open_access", "any", 3),
    "article_html": (("nature", "building_simulation"), lambda: F.col("article_url"), PAGES, None, "any", 3),
    "metadata_json": (("nature", "building_simulation"), lambda: _search(METADATA_API, 1), "application/json", "metadata", "json", 1),
}
SCHEMA = "doi string, kind string, url string, accept string, key string, body string, attempts int"


def _request(kind: str, url: Column, accept: str, key: str | None, body: str, attempts: int) -> list[Column]:
    return ["doi", F.lit(kind).alias("kind"), url.alias("url"), F.lit(accept).alias("accept"), F.lit(key).cast("string").alias("key"), F.lit(body).alias("body"), F.lit(attempts).alias("attempts")]


def requests(papers: DataFrame, kind: str) -> DataFrame:
    """papers (doi, route) to the requests for a kind of artifact; routes that have no such request give none."""
    routes, url, accept, key, body, attempts = KINDS[kind]
    return article_urls(papers.where(F.col("route").isin(*routes))).select(*_request(kind, url(), accept, key, body, attempts))


def pdf_requests(pages: DataFrame) -> DataFrame:
    """Fetched article pages (doi, route, html, page_url) to the requests for their main PDF: the page's link, else the address made from the DOI."""
    p = article_urls(pages)
    href = F.when(F.col("route") == "nature", nature_pdf_href("html", "doi")).otherwise(springer_pdf_href("html", "doi"))
    return p.withColumn("href", href).select(*_request("public_pdf", F.coalesce(join_url("page_url", F.col("href")), F.col("pdf_url")), PDFS, None, "pdf", 3))
