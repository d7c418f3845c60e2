"""Line dedup, in DataFrame functions only.

A line's key is the line stripped of [\\x20\\x09-\\x0D] at both ends with A-Z lower-cased. Keys of
at least `min_chars` code points that occur in at least two documents lose all their lines except
those in the smallest doc_id that holds them.

Lines leave the documents as (hash, document, position) only. The hashes are range-partitioned
and each range is sorted by hash, document and position, so the first row of a run is the first
occurrence and all later documents of the run are dropped as it streams by. A hash that holds
over `support` of all lines is dealt out by document as well; the first rows of its parts, a few
per frequent hash, are merged and broadcast. What comes back per document is a compressed bitmap
of the dropped positions: the non-zero 64-bit words with their indexes.

Defined cases: null or empty text is one empty line, which is kept; rows with the same doc_id are
one document, a null doc_id comes after all others; equal lines inside one document stay; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, written
from .exact_dedup import frequent_keys

#: Characters stripped from a line's ends.
BLANKS = " \t\n\x0b\x0c\r"
PARTS = 256


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, th, pos, h) for each line with a key long enough; th tells apart rows with one doc_id."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # The hash is taken below the generator: beside it, it would be taken anew for each line.
    texts = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))
    lines = texts.select("doc", "th", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc", "th", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keyed.select("doc", "th", "pos", F.unhex(F.md5(F.col("key").cast("binary"))).alias("h"))


def drop_bitmaps(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, support: float = 0.0005) -> DataFrame:
    """(doc, th, words): words is array<struct<w: int, bits: long>>, the set bits are lines to drop."""
    spark = docs.sparkSession
    lines = written(line_hashes(docs, id_col, text_col, min_chars), "lines")
    hot = frequent_keys(lines, F.xxhash64("h"), support)
    is_hot = F.xxhash64("h").isin(hot) if hot else F.lit(False)
    lines = lines.withColumn("part", F.when(is_hot, F.pmod(F.xxhash64("doc"), F.lit(PARTS)).cast("int")).otherwise(0))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = lines.repartitionByRange(n, "h", "part")
    run = Window.partitionBy("h", "part").orderBy(F.col("doc").asc_nulls_last(), "pos")
    seen = ranged.withColumn("first_doc", F.first("doc").over(run))
    if hot:
        # The parts of a frequent hash each have a first row; the smallest of them decides.
        cut = lines.where(is_hot).groupBy("h").agg(F.min("doc").alias("best"))
        cut = spark.createDataFrame(cut.collect(), cut.schema)  # at most about 1/support hashes
        seen = seen.join(F.broadcast(cut), ["h"], "left").withColumn("first_doc", F.coalesce("best", "first_doc"))
    dropped = seen.where(~F.col("doc").eqNullSafe(F.col("first_doc"))).select("doc", "th", "pos")
    words = (
        dropped.repartition("doc", "th")
        .groupBy("doc", "th", F.shiftright("pos", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits"))
        .groupBy("doc", "th").agg(F.sort_array(F.collect_list(F.struct("w", "bits"))).alias("words"))
    )
    return words


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_lines, n_dropped and the kept text of each row of docs."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc"), text.alias("t")).withColumn("th", F.xxhash64("t"))
    # Unpacked below the join, so that it is done once a document: dense[i >> 6] is then constant-time. The words
    # are sorted; zeros fill the gap before each, so unpacking is linear in the lines.
    dense = bitmaps.select(
        F.col("doc").alias("bdoc"), F.col("th").alias("bth"),
        F.expr("flatten(transform(words, (x, i) -> concat(array_repeat(0L, x.w - if(i = 0, 0, words[i - 1].w + 1)), array(x.bits))))").alias("dense"),
        F.expr("aggregate(words, 0L, (n, x) -> n + bit_count(x.bits))").alias("n_dropped"),
    )
    joined = rows.join(dense, F.col("doc").eqNullSafe(F.col("bdoc")) & (F.col("th") == F.col("bth")), "left")
    kept = F.expr("array_join(filter(split(t, '\n', -1), (x, i) -> (coalesce(get(dense, shiftright(i, 6)), 0L) & shiftleft(1L, i & 63)) = 0), '\n')")
    return joined.select(
        F.col("doc").alias(id_col),
        (F.char_length("t") - F.char_length(F.translate("t", "\n", "")) + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dense").isNull(), F.col("t")).otherwise(kept).alias("kept_text"),
    )


def line_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256."""
    bitmaps = drop_bitmaps(docs, id_col=id_col, text_col=text_col, min_chars=min_chars)
    out = apply_bitmaps(docs, bitmaps, id_col=id_col, text_col=text_col)
    return out.select(id_col, "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
