"""The main PDF link of an article page, from its anchors, without parsing the page in Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.ids import unquote
from ..functions.text import col, collapse, strip

# Words that mark supplementary files.
NATURE_OTHER = "supplementary|peer review|transparent peer|source data|moesm|_esm[.]pdf"
SPRINGER_OTHER = "supplement|electronic supplementary|esm|moesm|peer review"
_ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)[^>]*>.*?(?=</a\s*>|<a\b|$)"


def anchors(html: Column | str) -> Column:
    """array<struct<href, text>> in page order."""
    found = F.regexp_extract_all(col(html), F.lit(_ANCHOR), F.lit(0))
    value = lambda a: F.regexp_replace(F.regexp_extract(a, r"(?is)\bhref\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1), "^[\"']|[\"']$", "")
    entity = lambda x: F.replace(F.replace(F.replace(F.replace(F.replace(x, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&quot;"), F.lit('"')), F.lit("&#39;"), F.lit("'")), F.lit("&amp;"), F.lit("&"))
    return F.transform(found, lambda a: F.struct(strip(entity(value(a))).alias("href"), collapse(entity(F.regexp_replace(F.regexp_replace(a, r"(?s)^<a\b[^>]*>", ""), r"(?s)<[^>]*>", ""))).alias("text")))


def _path(href: Column) -> Column:
    return F.regexp_extract(href, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#;]*)", 1)


def _best(html: Column | str, score) -> Column:
    """The href of the highest score, the first of equal ones; a null score takes no part."""
    scored = F.transform(anchors(html), lambda a, i: F.struct((-score(a)).alias("low"), i.alias("at"), a["href"].alias("href")))
    return F.array_min(F.filter(scored, lambda s: s["low"].isNotNull() & (s["href"] != "")))["href"]


def nature_pdf_href(html: Column | str, doi: Column | str) -> Column:
    suffix = F.lower(F.regexp_replace(col(doi), "^[^/]*/", ""))

    def score(a: Column) -> Column:
        path, text = F.lower(_path(a["href"])), F.lower(a["text"])
        points = F.when(text == "download pdf", 100).otherwise(0) + F.when(path.endswith(F.concat(F.lit("/"), suffix, F.lit("_reference.pdf"))), 50).otherwise(0) + F.when(path.endswith(F.concat(F.lit("/"), suffix, F.lit(".pdf"))), 40).otherwise(0)
        wanted = path.endswith(".pdf") & ~F.concat(text, F.lit(" "), path).rlike(NATURE_OTHER) & path.contains(suffix)
        return F.when(wanted, F.greatest(points, F.lit(1)))

    return _best(html, score)


def springer_pdf_href(html: Column | str, doi: Column | str) -> Column:
    d = F.lower(col(doi))

    def score(a: Column) -> Column:
        path, text = F.lower(unquote(_path(a["href"]))), F.lower(a["text"])
        points = (
            F.when(path == F.concat(F.lit("/content/pdf/"), d, F.lit(".pdf")), 100).otherwise(0) + F.when(text == "download pdf", 50).otherwise(0)
            + F.when(text == "article pdf", 40).otherwise(0) + F.when(path.contains("/content/pdf/") & path.contains(d), 25).otherwise(0)
        )
        return F.when(path.endswith(".pdf") & ~F.concat(text, F.lit(" "), path).rlike(SPRINGER_OTHER) & (points > 0), points)

    return _best(html, score)
