"""Metadata records: selection from a response, typed fields, merging with partial XML, Markdown."""

from __future__ import annotations

from xml.etree import ElementTree as ET

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import normalize_doi, plain_doi
from ..functions.text import col, collapse, first_available, longest_available, nonempty, strip
from ..functions.trees import HREF, below, inside, parse, trimmed
from .jats import _map

TEXTS = ("title", "journal", "publication_date", "volume", "issue", "pages", "publisher", "abstract", "open_access", "copyright", "url")
LISTS = ("authors", "keywords")
#: The order in which fields are named.
FIELDS = ("title", "authors", "journal", "publication_date", "volume", "issue", "pages", "publisher", "abstract", "keywords", "open_access", "copyright", "url")


#: The keys of a record that fields are read from.
KEYS = (
    "title", "creators", "authors", "journalTitle", "publicationName", "publicationDate", "onlineDate", "volume", "issue", "number", "startingPage", "startPage", "firstPage", "endingPage", "endPage", "lastPage",
    "publisherName", "publisher", "abstract", "keyword", "keywords", "openaccess", "copyright", "rights", "url",
)


def _variants(*keys: str) -> str:
    return f"struct<{','.join(f'{k}:variant' for k in keys)}>"


def _parts(v: Column, *keys: str) -> Column:
    """The values of an object's keys, each read once; null for anything but an object."""
    return F.try_variant_get(v, "$", _variants(*keys))


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _raw(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _string(v: Column) -> Column:
    """A JSON string's text, stripped; null for anything else or a blank one."""
    return F.when(_kind(v) == "STRING", nonempty(_raw(v)))


def _scalar(v: Column) -> Column:
    """A string, or a boolean or number as text."""
    return F.when(_kind(v).rlike("^(STRING|BOOLEAN|BIGINT|DECIMAL|DOUBLE|FLOAT)"), nonempty(_raw(v)))


def _items(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _list_field(v: Column, inner: tuple[str, ...]) -> Column:
    """Distinct texts of a string or of a list of strings and objects."""
    # An item's kind and text, and the same of an object's values; the first value that is not empty counts, and only if it is a string.
    value = lambda x: F.struct(_kind(x).alias("kind"), _raw(x).alias("text"))
    opened = F.transform(_items(v), lambda i: F.struct(value(i).alias("own"), _parts(i, *inner).alias("parts")))
    read = F.transform(opened, lambda x: F.struct(x["own"].alias("own"), F.array(*[value(x["parts"][k]) for k in inner]).alias("values")))
    filled = lambda y: (y["kind"] != "VOID") & (F.coalesce(y["text"], F.lit("x")) != "") & ~((y["kind"] == "BOOLEAN") & F.coalesce(y["text"] == "false", F.lit(False)))
    text = lambda y: F.when(y["kind"] == "STRING", nonempty(y["text"]))
    chosen = F.transform(read, lambda x: F.when(x["own"]["kind"] == "STRING", x["own"]).otherwise(F.get(F.filter(x["values"], filled), F.lit(0))))
    many = F.array_distinct(F.filter(F.transform(chosen, text), lambda x: x.isNotNull()))
    return F.when(_kind(v) == "STRING", F.array_compact(F.array(nonempty(_raw(v))))).otherwise(F.coalesce(many, F.array().cast("array<string>")))


def joined_pages(first: Column, last: Column) -> Column:
    return F.when(first.isNotNull() & last.isNotNull() & (first != last), F.concat_ws("-", first, last)).otherwise(F.coalesce(first, last))


def _url(v: Column) -> Column:
    web = lambda x: F.when(x.rlike("^https?://"), x)
    opened = F.transform(_items(v), lambda i: F.struct(_string(i).alias("own"), _parts(i, "value", "format").alias("parts")))
    entries = F.transform(opened, lambda x: F.struct(web(F.coalesce(x["own"], _string(x["parts"]["value"]))).alias("url"), F.lower(_string(x["parts"]["format"])).alias("format")))
    good = F.filter(entries, lambda e: e["url"].isNotNull())
    # An entry marked as HTML comes before any other.
    best = F.array_sort(F.transform(good, lambda e, n: F.struct((~F.coalesce(e["format"] == "html", F.lit(False))).alias("later"), n.alias("n"), e["url"].alias("url"))))
    return F.coalesce(web(_string(v)), F.get(best, F.lit(0))["url"])


def select_record(df: DataFrame, payload: str = "payload", doi: str = "doi") -> DataFrame:
    """Adds record, the first of the response's records that has the DOI, and metadata_error."""
    bare = lambda x: normalize_doi(F.regexp_replace(x, r"(?i)^doi:\s*", ""))
    out = df.withColumn("__body", F.try_parse_json(F.col(payload)))
    out = out.withColumn("__records", F.try_variant_get("__body", "$.records", "variant"))
    opened = F.transform(_items(F.col("__records")), lambda r: F.struct(r.alias("record"), _parts(r, "doi", "identifier").alias("ids")))
    named = F.transform(opened, lambda x: F.struct(x["record"].alias("record"), _string(x["ids"]["doi"]).alias("a"), _string(x["ids"]["identifier"]).alias("b")))
    own = F.filter(named, lambda x: F.coalesce(F.coalesce(bare(x["a"]), bare(x["b"])) == F.col(doi), F.lit(False)))
    out = out.withColumn("record", F.get(own, F.lit(0))["record"])
    error = (
        F.when(F.col("__body").isNull(), "not_json").when(~_kind(F.col("__body")).startswith("OBJECT"), "unexpected_structure")
        .when(F.col("__records").isNull() | ~_kind(F.col("__records")).startswith("ARRAY"), "no_records_list").when(F.col("record").isNull(), "doi_not_in_response")
    )
    return out.withColumn("metadata_error", error).drop("__body", "__records")


def meta_fields(df: DataFrame, record: str = "record", name: str = "fields") -> DataFrame:
    """Adds the thirteen fields of a metadata record, null without one.

    All keys are read in one go into a column of their own, which the optimiser doesn't copy into the fields' expressions.
    """
    out = df.withColumn("__parts", _parts(F.col(record), *KEYS))
    at = lambda key: F.col("__parts")[key]
    some = lambda *keys: F.coalesce(*[F.when(_kind(at(k)) != "VOID", at(k)) for k in keys])
    out = out.withColumns({"__authors": some("creators", "authors"), "__keywords": some("keyword", "keywords")})
    text = lambda *keys: F.coalesce(*[_string(at(k)) for k in keys])
    scalar = lambda *keys: F.coalesce(*[_scalar(at(k)) for k in keys])
    out = out.withColumns({"__first": text("startingPage", "startPage", "firstPage"), "__last": text("endingPage", "endPage", "lastPage")})
    fields = F.struct(
        text("title").alias("title"), _list_field(F.col("__authors"), ("creator", "name", "author")).alias("authors"),
        text("journalTitle", "publicationName").alias("journal"), text("publicationDate", "onlineDate").alias("publication_date"),
        scalar("volume").alias("volume"), scalar("issue", "number").alias("issue"), joined_pages(F.col("__first"), F.col("__last")).alias("pages"),
        text("publisherName", "publisher").alias("publisher"), text("abstract").alias("abstract"),
        _list_field(F.col("__keywords"), ("keyword", "value", "subject")).alias("keywords"),
        # A struct's fields can't differ in case alone, so the second spelling is read by itself.
        F.coalesce(scalar("openaccess"), _scalar(F.try_variant_get(record, "$.openAccess", "variant"))).alias("open_access"), text("copyright", "rights").alias("copyright"), _url(at("url")).alias("url"),
    )
    return out.withColumn(name, F.when(F.col("__parts").isNotNull(), fields)).drop("__parts", "__authors", "__keywords", "__first", "__last")


def safe_artifact(payload: Column | str, record: Column | str) -> Column:
    """What may be kept of a response: the query and the chosen record, never the rest, which can hold credentials."""
    query = F.try_variant_get(F.try_parse_json(col(payload)), "$.query", "string")
    return F.to_json(F.struct(query.alias("query"), col(record).alias("record")), {"ignoreNullFields": "false"})


# Partial XML.


def _first(root: ET.Element, *names: str) -> str | None:
    return next((t for n in names for e in inside(root, n) if (t := trimmed(e))), None)


def _persons(root: ET.Element) -> list[str]:
    found = [trimmed(e) for e in inside(root, "creator")]
    if not any(found):
        found = []
        for c in inside(root, "contrib"):
            if (c.get("contrib-type") or "author").lower() == "author":
                parts = [_first(c, "given-names", "givenName", "firstName"), _first(c, "surname")]
                found.append(" ".join(p for p in parts if p) or trimmed(c))
    return list(dict.fromkeys(x for x in found if x))


def _date(root: ET.Element) -> str | None:
    direct = _first(root, "publicationDate", "publication-date")
    dates = ("-".join(p for p in (_first(d, n) for n in ("year", "month", "day")) if p) for d in inside(root, "pub-date"))
    return direct or next((d for d in dates if d), None) or _first(root, "year")


def _address(root: ET.Element) -> str | None:
    web = ("http://", "https://")
    for e in inside(root, "url"):
        for t in [*(trimmed(v) for v in inside(e, "value")), trimmed(e)]:
            if t.startswith(web):
                return t
    return next((v for e in inside(root, "self-uri") for k, v in e.attrib.items() if (k == HREF or k.endswith("}href") or k == "href") and v.startswith(web)), None)


def partial_fields(source: str | bytes | None, doi: str | None) -> dict | None:
    """The thirteen fields of an article XML that names the DOI; null for another or a broken one."""
    root = parse(source)
    if root is None:
        return None
    wanted = plain_doi(doi) or (doi or "").lower()
    if not any(wanted in (plain_doi(t), t.lower()) for t in (trimmed(e) for e in inside(root, "doi", "identifier", "article-id"))):
        return None
    one, two = _first(root, "fpage", "startingPage", "startPage"), _first(root, "lpage", "endingPage", "endPage")
    return {
        "title": _first(root, "article-title", "title"), "authors": _persons(root), "journal": _first(root, "journal-title", "publicationName", "publication-name", "journalTitle"),
        "publication_date": _date(root), "volume": _first(root, "volume", "volumeId"), "issue": _first(root, "issue", "issueId", "number"),
        "pages": f"{one}-{two}" if one and two and one != two else one or two, "publisher": _first(root, "publisher-name", "publisher"),
        "abstract": _first(root, "abstract", "description"), "keywords": list(dict.fromkeys(t for n in ("kwd", "keyword") for e in inside(root, n) if (t := trimmed(e)))),
        "open_access": _first(root, "openAccess", "open-access"), "copyright": _first(root, "copyright-statement", "copyright", "license-p"), "url": _address(root),
    }


FIELD_TYPE = "struct<" + ",".join(f"{f}:{'array<string>' if f in LISTS else 'string'}" for f in FIELDS) + ">"


def read_partial(df: DataFrame, xml: str = "xml", doi: str = "doi") -> DataFrame:
    both = df.withColumn("__pair", F.struct(F.col(xml).alias("x"), F.col(doi).alias("d")))
    return _map(both, "__pair", lambda p: {"partial": partial_fields(p["x"], p["d"])}, f"partial {FIELD_TYPE}").drop("__pair")


# Merging.


def union_texts(a: Column, b: Column) -> Column:
    """Stripped texts of both lists, each once, in order."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.transform(F.concat(F.coalesce(a, none), F.coalesce(b, none)), strip), lambda x: x != ""))


def merge_fields(jats: Column | str, meta: Column | str) -> Column:
    """JATS first, but for open access and address the record; the longer abstract and rights; both lists."""
    j, m = col(jats), col(meta)
    out = []
    for f in FIELDS:
        if f in LISTS:
            c = union_texts(j[f], m[f])
        elif f in ("abstract", "copyright"):
            c = longest_available(j[f], m[f])
        elif f in ("open_access", "url"):
            c = first_available(m[f], j[f])
        else:
            c = first_available(j[f], m[f])
        out.append(c.alias(f))
    return F.struct(*out)


def available_fields(fields: Column | str) -> Column:
    c = col(fields)
    return F.array_compact(F.array(*[F.when(F.size(c[f]) > 0 if f in LISTS else nonempty(c[f]).isNotNull(), F.lit(f)) for f in FIELDS]))


NOTE = (
    "> The complete publisher full text/PDF is not currently available through the configured publisher access.",
    "> This Markdown contains all useful bibliographic/abstract information that could be recovered from available structured sources. Missing article sections were not inferred or invented.",
)


def partial_markdown(doi: Column | str, fields: Column | str, directory: Column | str, rerun: Column | str) -> Column:
    """A paper known by its metadata only."""
    d, c = col(doi), col(fields)
    fact = lambda name, f: F.when(nonempty(c[f]).isNotNull(), F.concat(F.lit(f"{name}: "), nonempty(c[f])))
    names = lambda name, f: F.when(F.size(c[f]) > 0, F.concat(F.lit(f"{name}: "), F.array_join(c[f], "; ")))
    part = lambda title, f: F.when(nonempty(c[f]).isNotNull(), F.concat(F.lit(f"\n## {title}\n\n"), nonempty(c[f])))
    return F.concat(F.concat_ws(
        "\n", F.concat(F.lit("# "), F.coalesce(nonempty(c["title"]), d), F.lit("\n")), F.concat(F.lit("DOI: "), d), names("Authors", "authors"), fact("Journal", "journal"),
        fact("Published", "publication_date"), fact("Volume", "volume"), fact("Issue", "issue"), fact("Pages", "pages"), fact("Publisher", "publisher"),
        fact("Open access metadata", "open_access"), names("Keywords", "keywords"), part("Abstract", "abstract"), part("Rights information", "copyright"), part("Publisher link", "url"),
        F.lit("\n## Access status\n"), *[F.lit(x) for x in NOTE], F.lit("\n> If you legally obtain the main article PDF, place exactly ONE `.pdf` file in:"),
        F.concat(F.lit("> `"), col(directory), F.lit("`")), F.lit("> The PDF filename can be anything.\n\n> Then rerun:"), F.concat(F.lit("> `"), col(rerun), F.lit("`")),
    ), F.lit("\n"))


__all__ = ["available_fields", "below", "collapse", "merge_fields", "meta_fields", "partial_markdown", "read_partial", "safe_artifact", "select_record"]
