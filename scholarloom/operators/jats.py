"""JATS articles: blocks, Markdown, statistics and table cells from one parse.

Mixed content cannot be read with from_xml, so a document is parsed once in an Arrow-batched
function that returns everything later columns need.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from functools import partial
from itertools import islice
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.trees import HREF, below, first, inside, parse, spaced, squash, trimmed

#: Elements that interrupt a paragraph; a display formula is dropped.
FLOATING = ("fig", "table-wrap", "list", "disp-formula")
CELLS = ("th", "td")
#: Elements whose text is more than that of their content.
MARKED = ("inline-formula", "sup", "sub", "xref", "ext-link")


class UnsafeTable(ValueError):
    """A table with spanning cells, which a pipe table cannot hold."""


@dataclass
class Out:
    """Rendered blocks in order: (kind, level, text)."""

    blocks: list[tuple[str, int, str]] = field(default_factory=list)

    def add(self, kind: str, text: str, level: int = 0) -> None:
        if text:
            self.blocks.append((kind, level, text))

    def markdown(self) -> str:
        parts = []
        for i, (kind, level, text) in enumerate(self.blocks):
            text = f"{'#' * level} {text}" if kind == "heading" else text
            tight = kind == "fact" and i and self.blocks[i - 1][0] == "fact"
            parts.append(("" if not i else "\n" if tight else "\n\n") + text)
        whole = "".join(parts)
        return (re.sub(r"\n{3,}", "\n\n", whole) if "\n\n\n" in whole else whole).strip() + "\n"


# Inline text.


def _tex(raw: str) -> str:
    """The formula of a TeX document or fragment, without one pair of delimiters."""
    body = re.search(r"\\begin\{document\}(.*?)\\end\{document\}", raw, re.S)
    text = body[1] if body else re.sub(r"\\(?:(?:documentclass|usepackage)(?:\[[^\]]*\])?\{[^}]*\}|setlength\{[^}]*\}\{[^}]*\}|(?:begin|end)\{document\})", "", raw)
    text = squash(text)
    for left, right in (("$$", "$$"), (r"\[", r"\]"), (r"\(", r"\)"), ("$", "$")):
        if text.startswith(left) and text.endswith(right):
            return text[len(left) : len(text) - len(right)].strip() or text
    return text


def _formula(e: ET.Element) -> str:
    for name, clean in (("tex-math", _tex), ("math", squash)):
        found = next(inside(e, name), None)
        text = clean("".join(found.itertext())) if found is not None else ""
        if text:
            return f"${text}$"
    return squash("".join(e.itertext()))


def _inline(e: ET.Element) -> str:
    if e.tag not in MARKED:
        return _flow(e)
    if e.tag == "inline-formula":
        return _formula(e)
    text = _flow(e)
    if e.tag == "sup":
        text = squash(text)
        cites = any(x.get("ref-type") == "bibr" for x in inside(e, "xref"))
        return text and (f"[{text}]" if cites else f"<sup>{text}</sup>")
    if e.tag == "sub":
        text = squash(text)
        return text and f"<sub>{text}</sub>"
    if e.tag == "xref":
        return squash(text)
    return squash(text) or e.get(HREF, "")


def _flow(e: ET.Element) -> str:
    """Content without the floating elements in it."""
    if not len(e):
        return e.text or ""
    text = e.text or ""
    for c in e:
        if c.tag not in FLOATING:
            text += _inline(c) if len(c) or c.tag in MARKED else c.text or ""
        text += c.tail or ""
    return text


# Blocks.


def _captioned(e: ET.Element) -> str:
    label, caption = spaced(e.find("label")), spaced(e.find("caption"))
    if label and caption:
        return f"**{label if label[-1] in '.:' else label + '.'}** {caption}"
    return f"**{label or caption}**" if label or caption else ""


def _cells(row: ET.Element) -> list[str]:
    return [" ".join((_flow(c) if len(c) else c.text or "").split()) for c in row if c.tag in CELLS]


def pipe_table(head: list[list[str]], body: list[list[str]]) -> str:
    """Rows of equal width. The first head row is the header, more of them become rows; without one the header is empty."""
    width = max(map(len, head + body), default=1)
    lines = []
    for row in (head[0] if head else [], ["---"] * width, *head[1:], *body):
        line = " | ".join(row if len(row) == width else row + [""] * (width - len(row)))
        if line.count("|") >= width or "\n" in line:
            line = " | ".join([c.replace("|", "\\|").replace("\n", " ") for c in row] + [""] * (width - len(row)))
        lines.append(f"| {line} |")
    return "\n".join(lines)


def _table(e: ET.Element) -> str:
    for name in CELLS:
        for c in e.iter(name):
            if c.keys() and any((c.get(a) or "").strip() not in ("", "1") for a in ("rowspan", "colspan")):
                raise UnsafeTable("a table has spanning cells")
    parts = [_captioned(e)]
    table = e.find("table")
    if table is not None:
        parts.append(pipe_table(*([_cells(r) for r in below(table, part, "tr")] for part in ("thead", "tbody"))))
    parts.append(spaced(e.find("table-wrap-foot")))
    return "\n\n".join(p for p in parts if p)


def _list(e: ET.Element) -> str:
    lines = []
    for n, item in enumerate(below(e, "list-item"), 1):
        own = below(item, "p")
        text = squash(" ".join(map(_flow, own)) if own else _flow(item))
        if text:
            lines.append(f"{n}. {text}" if (e.get("list-type") or "").lower() == "order" else f"- {text}")
    return "\n".join(lines)


_RENDER = {"fig": ("figure", _captioned), "table-wrap": ("table", _table), "list": ("list", _list)}


def _floating(out: Out, e: ET.Element) -> None:
    if e.tag in _RENDER:
        kind, render = _RENDER[e.tag]
        out.add(kind, render(e))


def _paragraph(out: Out, e: ET.Element) -> None:
    held = [e.text or ""]
    for c in e:
        if c.tag in FLOATING:
            out.add("text", squash("".join(held)))
            held = []
            _floating(out, c)
        else:
            held.append(_inline(c))
        held.append(c.tail or "")
    out.add("text", squash("".join(held)))


def _section(out: Out, e: ET.Element, level: int) -> None:
    title = spaced(first(below(e, "title")))
    out.add("heading", title, min(max(level, 2), 6))
    for c in e:
        if c.tag == "p":
            _paragraph(out, c)
        elif c.tag == "sec":
            _section(out, c, min(level + bool(title), 6))
        else:
            _floating(out, c)


def _citation(e: ET.Element) -> str:
    parts: list[str] = []

    def walk(x: ET.Element) -> None:
        parts.append(x.text or "")
        for c in x:
            if c.tag == "etal":
                parts.append(" et al. ")
            else:
                walk(c)
            parts.append(c.tail or " ")

    walk(e)
    return squash("".join(parts))


def _reference(e: ET.Element) -> str:
    cited = first([c for c in e if c.tag in ("mixed-citation", "element-citation")])
    return " ".join(x for x in (spaced(first(below(e, "label"))), _citation(e if cited is None else cited)) if x)


def front_fields(article: ET.Element) -> dict:
    fronts = below(article, "front")
    if not fronts:
        return {"title": "", "doi": "", "journal": "", "published": "", "authors": [], "abstract": ""}
    find = lambda name, key=None, value=None: next((x for f in fronts for x in inside(f, name) if key is None or x.get(key) == value), None)
    date = find("pub-date", "date-type", "pub")
    parts = [spaced(first(below(date, n))) for n in ("year", "month", "day")] if date is not None else ["", "", ""]
    published = "-".join([parts[0], *(p.zfill(2) if p.isdigit() else p for p in parts[1:] if p)]) if parts[0] else ""
    authors = []
    for f in fronts:
        for c in inside(f, "contrib"):
            if c.get("contrib-type") == "author":
                name = " ".join(x for x in (spaced(first(below(c, "name", n))) for n in ("given-names", "surname")) if x)
                authors += [name] if name else []
    abstract = find("abstract", "abstract-type", None)
    text = "\n\n".join(x for x in (squash(_flow(p)) for p in below(abstract, "p")) if x) if abstract is not None else ""
    return {"title": spaced(find("article-title")), "doi": spaced(find("article-id", "pub-id-type", "doi")), "journal": spaced(find("journal-title")), "published": published, "authors": authors, "abstract": text}


def render_article(article: ET.Element) -> Out:
    """Front matter, sections, then paragraphs loose in the body, then back matter."""
    out, front = Out(), front_fields(article)
    out.add("heading", front["title"] or front["doi"] or "Untitled article", 1)
    for name, value in (("DOI", front["doi"]), ("Journal", front["journal"]), ("Published", front["published"]), ("Authors", ", ".join(front["authors"]))):
        out.add("fact", value and f"- {name}: {value}")
    if front["abstract"]:
        out.add("heading", "Abstract", 2)
        out.add("text", front["abstract"])
    body, back = first(below(article, "body")), first(below(article, "back"))
    if body is not None:
        for s in below(body, "sec"):
            _section(out, s, 2)
        for p in below(body, "p"):
            _paragraph(out, p)
    if back is not None:
        ack = first(below(back, "ack"))
        if ack is not None:
            out.add("heading", spaced(first(below(ack, "title"))) or "Acknowledgements", 2)
            for p in below(ack, "p"):
                _paragraph(out, p)
        for s in below(back, "sec"):
            _section(out, s, 2)
        listed = first(below(back, "ref-list"))
        if listed is not None:
            out.add("heading", "References", 2)
            for r in below(listed, "ref"):
                out.add("reference", _reference(r))
    return out


def article_of(source: str | bytes | None) -> tuple[ET.Element | None, str | None]:
    """The one article of a document, or why there is none."""
    root = parse(source)
    if root is None:
        return None, "not_well_formed"
    if root.tag == "article":
        return root, None
    found = list(inside(root, "article"))
    return (found[0], None) if len(found) == 1 else (None, f"expected one article, found {len(found)}")


def pick_article(source: str | bytes | None, doi: str) -> tuple[str | None, int]:
    """The article of a response whose DOI it is, as XML, and how many articles there are."""
    root = parse(source)
    if root is None:
        return None, 0
    found = [root] if root.tag == "article" else list(inside(root, "article"))
    for a in found:
        for x in inside(a, "article-id"):
            if x.get("pub-id-type") == "doi" and "".join(x.itertext()).strip().lower() == doi.strip().lower():
                a.tail = None
                return ET.tostring(a, encoding="unicode"), len(found)
    return None, len(found)


def inspect(article: ET.Element) -> dict:
    bodies = below(article, "body")
    body = first(bodies)
    tags = Counter(e.tag for b in bodies for e in islice(b.iter(), 1, None))
    chars = len(trimmed(body)) if body is not None else 0
    doi = next(("".join(x.itertext()).strip().lower() for f in below(article, "front") for x in inside(f, "article-id") if x.get("pub-id-type") == "doi" and x.text), None)
    paragraphs = tags["p"]
    return {
        "doi": doi, "has_body": body is not None, "section_count": tags["sec"], "paragraph_count": paragraphs,
        "reference_count": sum(len(below(r, "ref")) for b in below(article, "back") for r in inside(b, "ref-list")),
        "table_count": tags["table-wrap"], "figure_count": tags["fig"], "display_formula_count": tags["disp-formula"],
        "body_characters": chars, "candidate_full_text": body is not None and paragraphs >= 10 and chars >= 5000,
    }


def table_cells(article: ET.Element) -> list[str]:
    """Text of every cell of every table of the body, footers and further tables included."""
    wraps = [w for b in article.findall("body") for w in b.iter("table-wrap")]
    cells = [c for w in wraps for c in w.iter() if c.tag in CELLS]
    return [trimmed(c) if len(c) else (c.text or "").strip() for c in ({id(c): c for c in cells}.values() if len(wraps) > 1 else cells)]


STATS = "doi string, has_body boolean, section_count long, paragraph_count long, reference_count long, table_count long, figure_count long, display_formula_count long, body_characters long, candidate_full_text boolean"
#: What a document can be read for, with the types. An error is always told.
PARTS = {"stats": f"struct<{STATS.replace(' ', ':').replace(',:', ',')}>", "cells": "array<string>", "markdown": "string", "blocks": "array<struct<kind:string,level:int,text:string>>", "render_error": "string"}
RENDERED = ("markdown", "blocks", "render_error")


def read_article(source: str | bytes | None, markdown: bool = True, parts: tuple[str, ...] = tuple(PARTS)) -> dict:
    article, error = article_of(source)
    out = dict.fromkeys(("error", *PARTS)) | {"error": error}
    if article is None:
        return out
    if "stats" in parts:
        out["stats"] = inspect(article)
    if "cells" in parts:
        out["cells"] = table_cells(article)
    wanted = [p for p in RENDERED if p in parts]
    # A table can only be refused for an attribute that the text must hold as it is.
    if not markdown or not wanted or (wanted == ["render_error"] and isinstance(source, str) and "span" not in source):
        return out
    try:
        done = render_article(article)
    except UnsafeTable as e:
        return out | {"render_error": str(e)}
    if "markdown" in parts:
        out["markdown"] = done.markdown()
    if "blocks" in parts:
        out["blocks"] = [{"kind": k, "level": n, "text": t} for k, n, t in done.blocks]
    return out


def _map(df: DataFrame, column: str, read, schema: str) -> DataFrame:
    """df with the fields that read returns for a column's value. Only that column travels to Python, in Arrow batches.

    Marked as non-deterministic, the function runs once a row, whichever fields are used or filtered on later.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    extra = StructType.fromDDL(schema)
    fields = list(to_arrow_type(extra))

    @F.arrow_udf(extra)
    def run(values: pa.Array) -> pa.Array:
        rows = [read(v) for v in values.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in fields], fields=fields)

    out = df.withColumn("__read", run.asNondeterministic()(column))
    return out.select(*df.columns, *[F.col(f"__read.{f.name}").alias(f.name) for f in extra.fields])


def read_jats(df: DataFrame, xml: str = "xml", markdown: bool = True, parts: tuple[str, ...] = tuple(PARTS)) -> DataFrame:
    """Adds error, stats, cells, markdown, blocks and render_error, the last three null if no Markdown is wanted. Malformed XML is an error value, never a failed job.

    With parts, only error and those are made and added.
    """
    schema = ", ".join(["error string", *(f"{p} {PARTS[p]}" for p in PARTS if p in parts)])
    return _map(df, xml, partial(read_article, markdown=markdown, parts=tuple(parts)), schema)


def pick_articles(df: DataFrame, response: str = "response_xml", doi: str = "doi") -> DataFrame:
    """Adds article_xml (null if no article has the DOI) and article_count."""
    both = df.withColumn("__pair", F.struct(F.col(response).alias("x"), F.col(doi).alias("d")))
    return _map(both, "__pair", lambda p: dict(zip(("article_xml", "article_count"), pick_article(p["x"], p["d"] or ""), strict=True)), "article_xml string, article_count int").drop("__pair")
