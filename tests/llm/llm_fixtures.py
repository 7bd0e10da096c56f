"""Small tables with the awkward cases that every operator must take."""

import random

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 97} tail{i % 89}" for i in range(15_000))
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as columns of the input.
CLASHING = ("fp", "base", "spans", "folded", "label", "score", "count", "row", "id", "shard", "piece", "_base", "_salt", "h")


def words(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghilmnoprstu") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def awkward_docs(spark, extra=True):
    texts = [None, "", "   ", "a", "one two three", LONG, words(1, 60), words(1, 60), words(1, 60) + " end", words(2, 40),
             "Grüße an né@example.com ß", "mail a.b@example.com or +1 (234) 567-8901 and 10.0.0.255", "!!! ... ???", "\n\n\t",
             "4111 1111 1111 1111", words(3, 300)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[6], (None, words(4, 30), None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    for name in CLASHING if extra else ():
        df = df.withColumn(name, F.lit("x"))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
