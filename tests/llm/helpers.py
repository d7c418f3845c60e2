"""Small inputs shared by the operators' tests."""

import random

from pyspark.sql import functions as F

#: Extra columns whose names clash with what operators return or use inside.
CLASHES = ("keep_id", "kept", "score", "key", "text_sha256", "n", "part", "doc", "h", "__digest")


def docs(spark, rows, clashing=True):
    """(doc_id, text) rows as a table with lang, source, n_chars and clashing extra columns."""
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    df = df.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.char_length("text").cast("long")})
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES}) if clashing else df


def words(seed, n, vocabulary=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def edited(text, share, seed):
    r = random.Random(seed)
    out = text.split(" ")
    for i in range(len(out)):
        if r.random() < share:
            out[i] = f"x{r.randrange(10**6)}"
    return " ".join(out)
