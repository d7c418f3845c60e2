"""Page-structured content: JSON to ordered chunks to Markdown, without leaving the row.

A document's blocks become an array of chunks (kind, text, cont) by higher-order functions, so
rendering needs no shuffle, window or Python at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_references, heading_level, strip, without_images

CONTENT_SCHEMA = (
    "struct<is_full_document:boolean,metadata:struct<producer:struct<name:string,version:string>>,pages:array<struct<page_idx:int,blocks:array<struct<"
    "type:string,sub_type:string,level:int,content:string,continues_prev:boolean,image_source:string,"
    "captions:array<struct<content:string>>,footnotes:array<struct<content:string>>>>>>>"
)

# Block types.
IGNORED = ("header", "page_number", "page_footnote", "aside_text")
EQUATIONS = ("equation", "display_equation", "interline_equation")
PICTURES = ("image", "chart")
KNOWN = (*IGNORED, *EQUATIONS, *PICTURES, "doc_title", "paragraph_title", "text", "list", "table")


def parse_content(json: Column | str) -> Column:
    """The content struct; its pages are null if the text is no JSON object with a list of pages."""
    return F.from_json(json if isinstance(json, Column) else F.col(json), CONTENT_SCHEMA)


def is_valid(content: Column | str) -> Column:
    c = F.col(content) if isinstance(content, str) else content
    return c["pages"].isNotNull()


def blocks(content: Column | str) -> Column:
    """All blocks in page order; type and content stripped, null as empty."""
    c = F.col(content) if isinstance(content, str) else content
    text = lambda x: strip(F.coalesce(x, F.lit("")))
    # A page without blocks would make the whole list null.
    flat = F.flatten(F.filter(F.transform(c["pages"], lambda p: p["blocks"]), lambda b: b.isNotNull()))
    flat = F.filter(flat, lambda b: b.isNotNull())
    return F.transform(
        flat,
        lambda b: F.struct(
            text(b["type"]).alias("type"), b["sub_type"].alias("sub_type"), text(b["content"]).alias("content"),
            F.coalesce(b["continues_prev"], F.lit(False)).alias("cont"), b["captions"].alias("captions"), b["footnotes"].alias("footnotes"),
        ),
    )


def _chunk(kind: str, text: Column, cont: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("kind"), text.alias("text"), (cont if cont is not None else F.lit(False)).alias("cont"))


def _parts(b: Column, field: str, kind: str, mark: str) -> Column:
    texts = F.filter(F.transform(b[field], lambda x: strip(F.coalesce(x["content"], F.lit("")))), lambda t: t != "")
    return F.coalesce(F.transform(texts, lambda t: _chunk(kind, F.concat(F.lit(mark), t, F.lit(mark)))), F.slice(F.array(_chunk(kind, F.lit(""))), 1, 0))


def chunks(flat: Column | str) -> Column:
    """Blocks to array<struct<kind, text, cont>>. cont: the chunk goes on with the paragraph before it."""
    flat = F.col(flat) if isinstance(flat, str) else flat

    def of(b: Column) -> Column:
        kind, text = b["type"], b["content"]
        none = F.slice(F.array(_chunk("text", F.lit(""))), 1, 0)
        some = lambda c: F.when(text != "", F.array(c)).otherwise(none)
        captions, footnotes = _parts(b, "captions", "caption", "**"), _parts(b, "footnotes", "text", "")
        return (
            F.when(kind.isin(*IGNORED, *EQUATIONS), none)
            .when(kind == "doc_title", some(_chunk("heading", F.concat(F.lit("# "), text))))
            .when(kind == "paragraph_title", some(_chunk("heading", F.concat(F.repeat(F.lit("#"), heading_level(text)), F.lit(" "), text))))
            .when(kind == "text", some(_chunk("text", text, b["cont"])))
            .when(kind == "list", some(_chunk("list", text)))
            .when(kind == "table", F.concat(captions, some(_chunk("table", without_images(text))), footnotes))
            .when(kind.isin(*PICTURES), F.concat(captions, footnotes))
            .otherwise(some(_chunk("text", text)))
        )

    return F.flatten(F.transform(flat, of))


def with_pieces(df: DataFrame, content: str = "content") -> DataFrame:
    """Adds blocks, chunks and pieces: chunks with joins, which tells those glued to the paragraph before."""
    out = df.withColumn("blocks", blocks(content))
    out = out.withColumn("chunks", chunks("blocks"))
    before = F.concat(F.array(F.lit("start")), F.transform("chunks", lambda c: c["kind"]))
    pairs = F.arrays_zip(F.col("chunks").alias("c"), before.alias("before"))
    pieces = F.transform(
        F.filter(pairs, lambda p: p["c"].isNotNull()),
        lambda p: F.struct(p["c"]["kind"].alias("kind"), p["c"]["text"].alias("text"), ((p["c"]["kind"] == "text") & p["c"]["cont"] & (p["before"] == "text")).alias("joins")),
    )
    return out.withColumn("pieces", pieces)


def markdown(pieces: Column | str) -> Column:
    """Pieces to Markdown: one space before a joined one, a blank line before any other."""
    p = F.filter(F.col(pieces) if isinstance(pieces, str) else pieces, lambda x: x["text"] != "")
    body = F.array_join(F.transform(p, lambda x: F.concat(F.when(x["joins"], F.lit(" ")).otherwise(F.lit("\n\n")), x["text"])), "")
    return F.concat(strip(body), F.lit("\n"))


def paragraphs(pieces_df: DataFrame, key: str) -> DataFrame:
    """One row per rendered item: key, item (from 0), kind, text, joined pieces merged. An outer explode, see histogram."""
    held = pieces_df.select(key, F.filter("pieces", lambda x: x["text"] != "").alias("p"))
    # Places where an item begins, and the place behind the last one; an item is a slice between two of them.
    begins = F.filter(F.transform("p", lambda x, i: F.when(~x["joins"], i + 1)), lambda i: i.isNotNull())
    ends = F.concat(F.slice("b", 2, F.greatest(F.size("b") - 1, F.lit(0))), F.array(F.size("p") + 1))
    held = held.withColumn("b", begins).withColumn("e", ends)
    one = lambda n, i: F.struct(F.element_at("p", n)["kind"].alias("kind"), F.array_join(F.transform(F.slice("p", n, F.get("e", i) - n), lambda x: x["text"]), " ").alias("text"))
    items = held.select(key, F.posexplode_outer(F.transform("b", one)).alias("item", "x")).where("item is not null")
    return items.select(key, F.col("item").cast("long").alias("item"), "x.kind", "x.text")


def counted(values: Column) -> Column:
    """How often each value occurs, in one pass over the array."""
    one = lambda m, v: F.map_concat(F.map_filter(m, lambda k, _: k != v), F.create_map(v, F.coalesce(F.try_element_at(m, v), F.lit(0)) + 1))
    return F.aggregate(values, F.create_map().cast("map<string,int>"), one)


def render(df: DataFrame, content: str = "content") -> DataFrame:
    """Adds markdown and the render statistics."""
    out = with_pieces(df, content)
    count = lambda test: F.size(F.filter("blocks", test)).cast("long")
    kinds = F.array_distinct(F.transform("blocks", lambda b: b["type"]))
    return out.withColumns({
        "markdown": markdown("pieces"),
        "page_count": F.size(F.col(content)["pages"]).cast("long"),
        "block_counts": counted(F.transform("blocks", lambda b: b["type"])),
        "table_count": count(lambda b: b["type"] == "table"),
        "image_count": count(lambda b: b["type"] == "image"),
        "chart_count": count(lambda b: b["type"] == "chart"),
        "display_equations_removed": count(lambda b: b["type"].isin(*EQUATIONS)),
        "references_present": F.exists("blocks", lambda b: ((b["type"] == "paragraph_title") & F.lower(b["content"]).isin("references", "bibliography")) | ((b["type"] == "list") & F.coalesce(b["sub_type"] == "ref_text", F.lit(False)))),
        "unknown_block_types": F.array_sort(F.filter(kinds, lambda k: (k != "") & ~k.isin(*KNOWN))),
    })


def histogram(df: DataFrame, key: str, content: str = "content") -> DataFrame:
    """(key, type, n): how often each block type occurs in a document.

    An outer explode: for an inner one the optimiser adds a filter on the map's size, which parses the content twice more.
    """
    counts = counted(F.transform(blocks(content), lambda b: b["type"]))
    return df.select(key, F.explode_outer(counts).alias("type", "n")).where("type is not null").withColumn("n", F.col("n").cast("long"))


def source_tables(flat: Column | str) -> Column:
    """What each table must be in the Markdown: its content without images."""
    flat = F.col(flat) if isinstance(flat, str) else flat
    return F.transform(F.filter(flat, lambda b: (b["type"] == "table") & (b["content"] != "")), lambda b: without_images(b["content"]))


__all__ = ["blocks", "chunks", "has_references", "histogram", "is_valid", "markdown", "paragraphs", "parse_content", "render", "source_tables", "with_pieces"]
