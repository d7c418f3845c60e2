"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; run()
writes every stage's result as Parquet into the shared folder and reads it back for the next.
All stages but the last return the columns of documents.

Cases common to all stages: a null text counts as empty; an empty table gives an empty result; extra
columns, whatever their names, are carried; whole texts count, however long. Nothing is dropped but
what a stage's rule names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarloom.llm import exact_dedup, near_dedup, packing, suffix_dedup, toxicity
from scholarloom.llm.common import Scratch, table
from scholarloom.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go. The labels are those of the source folder.

    Null and empty texts score like texts without matches and stay; a null doc_id is scored as any other; repeated rows
    share their fate; without usable labels the seed words decide; labels of documents that are not there count for nothing.
    """
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays.

    A-Z counts as a-z; null and empty texts are equal; a null doc_id is smaller than any other; of rows that repeat doc_id
    and text one stays, whichever other columns it has.
    """
    return exact_dedup.keep_first_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the smallest doc_id stays.

    Texts without words are near to none and all stay; texts of fewer than five words are one shingle; a null doc_id stays
    only where its class has no other; rows that repeat the smallest doc_id with the same words all stay.
    """
    return near_dedup.keep_one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes and more that occur again are taken out of the texts; n_chars follows, if there is such a column.

    Texts under 200 bytes stay as they are; copies of a longer text lose all of it and stay as empty documents; a null text
    becomes an empty one only where something was cut; characters of which only a part is left go.
    """
    out = suffix_dedup.remove_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, one row per piece of a document.

    A null or empty text is its end token; repeated rows are packed each; a null doc_id is carried; other columns end here.
    """
    # Workers of the stages before may still be there: less memory for kept chunks than where packing runs alone.
    return packing.pack(docs, tokenizer_file(spark, "word_bpe_49k.json"), cache=100_000, lot=300_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("packing", pack),
]

#: Shingle signatures, byte fingerprints and token ids have no SQL form; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        own = Scratch(spark, f"stage-{name}")
        docs = own.written(stage(spark, docs, sf_dir), "documents")
        if before is not None:
            before.close()  # its rows have been read
        before = own
    return STAGES[-1][1](spark, docs, sf_dir)
