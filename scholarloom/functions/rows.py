"""How rows are dealt out to tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """df in so many parts that every core has work, whatever files it is read from.

    Narrow rows that much is made of lie in files of a few MB, which the engine reads in one task or two. To be called before
    the wide columns are made; a number given here is not coalesced by their size.
    """
    session = df.sparkSession
    return df.repartition(max(2 * session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions"))))


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df in parts of about so many rows, and one for every core at least. Rows of equal keys come together, if some are given.

    For rows that go through many stages: there, more parts than the rows need cost more than they save. Rows are counted for it.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows)), *keys)


def selected(df: DataFrame, test: Column, *columns: Column | str) -> DataFrame:
    """These columns of the rows that pass the test, which is made where it stands.

    The optimiser moves a filter down to the files, there does the test's work before rows are spread, and does it again for the columns.
    """
    return df.select(F.explode_outer(F.when(test, F.array(F.struct(*columns)))).alias("__row")).where("__row is not null").select("__row.*")
