"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark: SparkSession, texts: list[str | None], ids: list[int | None] | None = None) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed: int, words: int, vocabulary: int = 3000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(words))


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls, empty, white space, one word, very long, copies, a repeated row, columns of other operators' names."""
    long = prose(1, 30_000)
    texts = [None, "", " \t\n", "word", "two words", long, long, prose(2, 40), prose(2, 40), "éà ñ 日本語 😀", "12 34 !!"]
    frame = docs(spark, texts)
    frame = frame.unionByName(docs(spark, [prose(2, 40)], [8]))
    return frame.selectExpr("*", "'x' AS shard", "1 AS size", "2 AS fp", "3 AS label", "4 AS row", "'k' AS list")
