"""Small frames for the operator tests."""

import os

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD_TEXTS = [None, "", " ", "\n\n", "a", "x" * 70_000, "word " * 30_000, "  ", "é퟿😀", "▁ a", "tab\tand\r\nlines\n"]


def docs(spark, texts, ids=None, extra=False):
    """documents rows; ``extra`` adds columns named like internal ones."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None if k % 2 else "en", "src", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("_sha", "_own", "_hash", "_id", "text_hash", "fingerprint", "score", "class", "hash", "_text", "a.b", "s", "item_id", "ids"):
            df = df.withColumn(name, __import__("pyspark.sql.functions", fromlist=["lit"]).lit("mine"))
    return df


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], T._parse_datatype_string(schema) if isinstance(schema, str) else schema)


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def bag(rows):
    return sorted(map(repr, rows))


def tokenizer(name):
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
