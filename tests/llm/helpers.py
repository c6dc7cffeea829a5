"""Small fixtures for the operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def clashing(df, *names):
    """df with extra columns called like results or intermediates."""
    from pyspark.sql import functions as F

    for n in names:
        if n not in df.columns:
            df = df.withColumn(n, F.lit("extra"))
    return df


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, share):
    out = text.split()
    for _ in range(int(len(out) * share)):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10 ** 6)}"
    return " ".join(out)


def rng(seed=1):
    return random.Random(seed)
