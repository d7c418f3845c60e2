"""Publisher XML: completeness, floating tables, expectations about the PDF, and Markdown of our own contract.

The Markdown has `<a id="..."></a>` before tables, formulas and references, `**Table N.** caption`
over pipe tables, `$$` fences around display formulas, `[text](#id)` for mentions and numbered
headings; the cleaner in markdown_clean reads exactly that.
"""

from __future__ import annotations

from collections import Counter
from functools import partial
from xml.etree import ElementTree as ET

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col
from ..functions.trees import below, first, inside, parse, spaced, squash, trimmed
from .jats import _map, pipe_table

LEAST_SECTIONS, LEAST_PARAGRAPHS, LEAST_CHARACTERS = 2, 10, 5000
ROOT = "full-text-retrieval-response"


def full_text_reason(root: Column | str, sections: Column | str, paragraphs: Column | str, characters: Column | str) -> Column:
    """What speaks against full text, joined by "; "; empty if nothing does."""
    r, s, p, c = map(col, (root, sections, paragraphs, characters))
    return F.concat_ws(
        "; ",
        F.when(r != ROOT, F.concat(F.lit("unexpected root element: "), r)),
        F.when(s < LEAST_SECTIONS, F.concat(F.lit("too few sections: "), s.cast("string"))),
        F.when(p < LEAST_PARAGRAPHS, F.concat(F.lit("too few paragraphs: "), p.cast("string"))),
        F.when(c < LEAST_CHARACTERS, F.concat(F.lit("too little textual content: "), c.cast("string"), F.lit(" chars"))),
    )


def float_tables(root: ET.Element) -> list[str]:
    ids = [e.get("refid") or "" for e in inside(root, "float-anchor")]
    return list(dict.fromkeys(i for i in ids if i.startswith("t")))


def is_image_only(table: ET.Element) -> bool:
    has = lambda *names: any(True for _ in inside(table, *names))
    return has("link", "graphic", "inline-graphic") and not has("tgroup", "entry", "row")


def _text(e: ET.Element) -> str:
    out = [e.text or ""]
    for c in e:
        inner = _text(c)
        if c.tag in ("cross-ref", "float-anchor", "cross-refs"):
            inner = f"[{squash(inner)}](#{c.get('refid', '')})" if squash(inner) else ""
        elif c.tag == "bold":
            inner = f"**{squash(inner)}**" if squash(inner) else ""
        elif c.tag == "italic":
            inner = f"*{squash(inner)}*" if squash(inner) else ""
        elif c.tag in ("sup", "inf"):
            inner = f"<{'sup' if c.tag == 'sup' else 'sub'}>{squash(inner)}</{'sup' if c.tag == 'sup' else 'sub'}>"
        elif c.tag == "math":
            inner = f"${squash(inner)}$"
        elif c.tag in ("display", "table", "figure"):
            inner = ""
        out += [inner, c.tail or ""]
    return "".join(out)


def _publisher_table(e: ET.Element, number: int) -> str:
    label = spaced(first(below(e, "label"))) or f"Table {number}"
    caption = spaced(first(below(e, "caption")))
    parts = [f'<a id="{e.get("id", f"t{number}")}"></a>', f"**{label}**" + (f" {caption}" if caption else "")]
    head = [[squash(_text(c)) for c in below(r, "entry")] for h in inside(e, "thead") for r in below(h, "row")]
    body = [[squash(_text(c)) for c in below(r, "entry")] for h in inside(e, "tbody") for r in below(h, "row")]
    if head or body:
        parts.append(pipe_table(head, body))
    return "\n\n".join(parts)


def to_markdown(root: ET.Element) -> str:
    title = next((spaced(e) for e in inside(root, "title", "article-title") if spaced(e)), "")
    out = [f"# {title or 'Untitled article'}"]
    equations, tables = 0, 0

    def block(e: ET.Element, number: str, level: int) -> None:
        nonlocal equations, tables
        if e.tag in ("section", "abstract"):
            heading = spaced(first(below(e, "section-title")))
            label = spaced(first(below(e, "label"))) or number
            out.append(f"{'#' * min(level, 6)} " + " ".join(x for x in (label if e.tag == "section" else "", heading or ("Abstract" if e.tag == "abstract" else "")) if x))
            n = 0
            for c in e:
                if c.tag in ("section-title", "label"):
                    continue
                n += c.tag == "section"
                block(c, f"{label}.{n}" if label else str(n), level + 1)
        elif e.tag in ("para", "simple-para", "p"):
            text = squash(_text(e))
            if text:
                out.append(text)
            for c in e:
                if c.tag in ("display", "table", "figure"):
                    block(c, number, level)
        elif e.tag in ("display", "formula"):
            for c in [e] if e.tag == "formula" else below(e, "formula"):
                equations += 1
                body = next((squash("".join(m.itertext())) for m in inside(c, "math", "tex-math")), squash("".join(c.itertext())))
                out.append(f'<a id="{c.get("id", f"e{equations}")}"></a>\n$$\n{body}\n$$ ({equations})')
            for c in e if e.tag == "display" else []:
                if c.tag in ("table", "figure"):
                    block(c, number, level)
        elif e.tag == "table":
            tables += 1
            out.append(_publisher_table(e, tables))
        elif e.tag == "figure":
            text = " ".join(x for x in (spaced(first(below(e, "label"))), spaced(first(below(e, "caption")))) if x)
            if text:
                out.append(f"**{text}**")
        elif e.tag == "bibliography":
            out.append("## References")
            for n, r in enumerate(inside(e, "bib-reference", "ref"), 1):
                out.append(f'<a id="{r.get("id", f"b{n}")}"></a>\n\n{trimmed(r)}')
        else:
            n = 0
            for c in e:
                n += c.tag == "section"
                block(c, str(n), level)

    block(root, "", 2)
    return "\n\n".join(x for x in out if x) + "\n"


NO_EXPECTATION = {"attachment_eid": None, "filename": None, "expected_pages": None, "expected_bytes": None}


def expectation(root: ET.Element) -> dict:
    """What the XML says about the main PDF: the first one with purpose MAIN, else the first."""
    found = list(inside(root, "web-pdf"))
    own = lambda e, n: next((x for x in ((c.text or "").strip() for c in below(e, n)) if x), None)
    whole = lambda x: int(x) if x and x.lstrip("+-").isdigit() else None
    chosen = next((e for e in found if (own(e, "web-pdf-purpose") or "").upper() == "MAIN"), first(found))
    if chosen is None:
        return NO_EXPECTATION
    return {"attachment_eid": own(chosen, "attachment-eid"), "filename": own(chosen, "filename"), "expected_pages": whole(own(chosen, "web-pdf-page-count")), "expected_bytes": whole(own(chosen, "filesize"))}


SCHEMA = (
    "xml_error string, root_name string, section_count long, paragraph_count long, reference_count long, text_characters long, float_table_ids array<string>,"
    " table_kinds map<string,boolean>, raw_markdown string, expectation struct<attachment_eid:string,filename:string,expected_pages:long,expected_bytes:long>"
)


def read_xml(source: str | bytes | None, markdown: bool = True) -> dict:
    root = parse(source)
    if root is None:
        return {"xml_error": "not_well_formed", "root_name": None, "section_count": None, "paragraph_count": None, "reference_count": None, "text_characters": None, "float_table_ids": None, "table_kinds": None, "raw_markdown": None, "expectation": None}
    tags = Counter(e.tag for e in root.iter())
    count = lambda *names: sum(tags[n] for n in names)
    kinds: dict[str, bool] = {}
    for t in root.iter("table"):
        if t.get("id"):
            kinds.setdefault(t.get("id"), is_image_only(t))
    return {
        "xml_error": None, "root_name": root.tag, "section_count": count("section"), "paragraph_count": count("para", "p", "simple-para"),
        "reference_count": count("bib-reference", "ref"), "text_characters": len(trimmed(root)), "float_table_ids": float_tables(root) if tags["float-anchor"] else [],
        "table_kinds": list(kinds.items()), "raw_markdown": to_markdown(root) if markdown else None, "expectation": expectation(root) if tags["web-pdf"] else NO_EXPECTATION,
    }


def read_publisher_xml(df: DataFrame, xml: str = "xml", markdown: bool = True) -> DataFrame:
    """Adds statistics, floating tables, raw Markdown if wanted, the PDF expectation, reason and is_full_text."""
    out = _map(df, xml, partial(read_xml, markdown=markdown), SCHEMA)
    out = out.withColumn("reason", full_text_reason("root_name", "section_count", "paragraph_count", "text_characters"))
    return out.withColumn("is_full_text", F.col("xml_error").isNull() & (F.col("reason") == ""))


def missing_tables(df: DataFrame, missing: str = "missing") -> DataFrame:
    """Splits ids that the Markdown lacks: tables that are images only, and the rest."""
    image = F.filter(missing, lambda i: F.coalesce(F.try_element_at("table_kinds", i), F.lit(False)))
    return df.withColumns({"image_only_float_table_ids": image, "missing_float_table_ids": F.filter(missing, lambda i: ~F.coalesce(F.try_element_at("table_kinds", i), F.lit(False)))})
