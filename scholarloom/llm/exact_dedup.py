"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the largest
doc_id stays. A Misra-Gries summary (Spark's native freqItems, 1/support counters, merged over
partitions) names the digests that may hold more than a `support` share of all rows; an exact
count verifies them, and their winners, at most 1/support rows, are broadcast, so the rows of
large groups are decided where they are read. All other digests take one ordinary shuffle.

Defined cases: a null text counts as empty and empty texts form one group; a null doc_id is
smaller than any other; of repeated rows with the same doc_id and text exactly one stays; an
empty table gives an empty result; columns of the input that the result also has are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, written

RESULT = ("keep_id", "group_size", "kept")
DIGEST = "__digest"
#: Summaries that are merged in one task: at most SUMMARIES / support counters.
SUMMARIES = 1024


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("binary"), 256))


def frequent_keys(rows: DataFrame, key: Column, support: float) -> list[int]:
    """At most about 1/support values of a long key; none held by over support of all rows is missing.

    One task merges the summaries of all partitions, so there are at most SUMMARIES of them, each over several partitions.
    """
    found = rows.select(key.alias("k")).coalesce(SUMMARIES).stat.freqItems(["k"], support).first()
    return [k for k in (found[0] if found else None) or [] if k is not None]


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", support: float = 0.001, digests: DataFrame | None = None) -> DataFrame:
    """Rows of docs with keep_id, group_size, kept and the 32-byte __digest.

    digests: a narrow written copy (id_col, __digest) of the same rows, if there is one, from which
    the frequent digests are taken instead of reading the texts twice.
    """
    spark = docs.sparkSession
    rows = docs.drop(*RESULT)
    rows = rows if DIGEST in rows.columns else rows.withColumn(DIGEST, text_digest(text_col))
    narrow = digests if digests is not None else rows.select(id_col, DIGEST)
    # An exact count of what Misra-Gries suggests; false positives fall below the share.
    suggested = frequent_keys(narrow, F.xxhash64(DIGEST), support)
    total = narrow.count() if suggested else 0
    verified = (
        narrow.where(F.xxhash64(DIGEST).isin(suggested)).groupBy(DIGEST).agg(F.max(id_col).alias("keep_id"), F.count("*").alias("group_size"))
        .where(F.col("group_size") > max(1, int(support * total)))
        .collect()
        if suggested
        else []
    )
    plain = rows
    parts = []
    if verified:
        winners = F.broadcast(spark.createDataFrame([tuple(r) for r in verified], f"{DIGEST} binary, keep_id {dict(rows.dtypes)[id_col]}, group_size long"))
        hot = rows.join(winners, DIGEST)
        won = F.col(id_col).eqNullSafe(F.col("keep_id"))
        first = F.row_number().over(Window.partitionBy(DIGEST).orderBy(F.col(id_col)))
        parts = [hot.where(~won).withColumn("kept", F.lit(False)), hot.where(won).withColumn("kept", first == 1)]
        plain = rows.join(winners, DIGEST, "left_anti")
    same = Window.partitionBy(DIGEST)
    order = same.orderBy(F.col(id_col).desc_nulls_last())
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = plain.withColumns({"keep_id": F.first(id_col).over(everything), "group_size": F.count("*").over(everything), "kept": F.row_number().over(order) == 1})
    for p in parts:
        out = out.unionByName(p)
    return out


def dedup_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", support: float = 0.001) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. Texts are read once."""
    narrow = written(docs.select(F.col(id_col), text_digest(text_col).alias(DIGEST)), "digests")
    out = exact_dedup(narrow, id_col=id_col, support=support, digests=narrow)
    return out.select(id_col, "keep_id", "group_size", "kept", F.lower(F.hex(DIGEST)).alias("text_sha256"))


def keep_first_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", support: float = 0.001) -> DataFrame:
    """The rows that stay, with the columns of docs.

    Decided on (id, digest) alone. Texts meet the marks of rows that may go: the join is on both id and
    digest, so no group of copies meets in one task, and it is a broadcast where the marks are small.
    """
    names = docs.columns
    # Clashing names step aside while the decision is made.
    held = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    own, text = f"__c{names.index(id_col)}", f"__c{names.index(text_col)}"
    narrow = written(held.select(F.col(own).alias("id"), text_digest(text).alias(DIGEST)), "digests")
    decided = exact_dedup(narrow, id_col="id", support=support, digests=narrow).where("group_size > 1")
    # Rows that repeat both id and text are alike in all that is decided on: one of the winning ones stays.
    marks = decided.groupBy("id", DIGEST).agg(F.max("kept").alias("wins"), F.count("*").alias("n")).where("n > 1 or not wins")
    marks = written(marks.select(F.col("id").alias("__id"), F.col(DIGEST).alias("__d"), "wins"), "marks")
    rows = held.withColumn(DIGEST, text_digest(text))
    same = F.col(own).eqNullSafe(F.col("__id")) & (F.col(DIGEST) == F.col("__d"))
    stay = rows.join(marks, same, "left_anti")
    if not marks.where("wins").isEmpty():
        twice = rows.join(marks.where("wins"), same, "left_semi")
        first = F.row_number().over(Window.partitionBy(own, DIGEST).orderBy(F.lit(1)))
        stay = stay.unionByName(twice.withColumn("__n", first).where("__n = 1").drop("__n"))
    return stay.select(*[F.col(f"__c{i}").alias(n) for i, n in enumerate(names)])
