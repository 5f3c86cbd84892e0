"""A training corpus from raw documents, in five stages.

Each stage reads what the one before has kept, whole, and its decisions take effect:

1. ``language``: documents without letters, or in none of the learned languages, go. A score
   is judged by how many characters it rests on: it may fall short of the least one by one over the
   root of their number.
2. ``near_duplicates``: of the documents that fingerprints within 3 bits link, one stays.
3. ``repeats``: words of passages that a document with a smaller doc_id has are cut out; a
   document of which nothing is left goes.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``tokens``: the rest is encoded; one row with its ids and digests for each document.

All but the last return the columns of documents. A null text counts as empty and an empty
table passes through. Stages judge rows, not ids: rows that repeat a doc_id with another
text, and rows without one, are documents of their own. Of a group in ``near_duplicates`` the
row with the smallest doc_id stays, of several with that id the one with the least
fingerprint, of those the least text; rows without doc_id come last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import bpe, decontamination, language, simhash, substring
from factloom.llm.store import broadcast_if_small, new_path, shipped, stored

#: No stage but the language filter could be put in SQL: fingerprints, the model and the encoder cannot.
ORACLE_SQL = None
#: Rows of ids or digests that are broadcast (some 50 MB); beyond them the join shuffles.
BROADCAST_ROWS = 500_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    found = language.identify(docs, language.fit(docs))
    least = language.LEAST_SCORE - 1 / F.sqrt(F.length("text"))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    found = stored(simhash.near_duplicates(docs, with_group=True), "near-duplicates")
    # an id of several rows, or of none, does not tell which row is meant
    shared = stored(found.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select("doc_id"), "shared-ids")
    gone = stored(found.where("doc_id <> component_id").select("doc_id").unionByName(shared.where("doc_id IS NOT NULL")).distinct(), "gone")
    named = docs.where("doc_id IS NOT NULL").join(broadcast_if_small(gone, gone.count(), BROADCAST_ROWS), "doc_id", "left_anti")
    if shared.isEmpty():
        return named.select(docs.columns)
    return named.select(docs.columns).unionByName(_one_of_each_group(docs, found, shared))


def _one_of_each_group(docs: DataFrame, found: DataFrame, shared: DataFrame) -> DataFrame:
    """Of the rows whose id is null or repeated, those that stay."""
    least = found.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "fingerprint")).alias("first"))
    first = least.select(F.col("first.doc_id").alias("first_id"), F.col("first.fingerprint").alias("first_print"))
    which = shared.select(F.col("doc_id").alias("shared_id"))
    unclear = docs.join(which, F.col("doc_id").eqNullSafe(F.col("shared_id")), "left_semi")
    marked = simhash.with_fingerprints(unclear.select(F.struct(*docs.columns).alias("row"), "doc_id", "text"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("fingerprint") == F.col("first_print"))
    stay = marked.join(first, same, "left_semi").groupBy("doc_id", "fingerprint").agg(
        F.min_by("row", F.coalesce("text", F.lit(""))).alias("row"))
    return stay.select("row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = substring.remove_repeats(docs, keep_text=True, keep=rest).where("n_removed = 0 OR kept <> ''")
    columns = [F.col(f"input_{c}").alias(c) for c in rest] + [F.col("doc_id"), F.col("kept").alias("text")]
    if "n_chars" in rest:
        length = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("input_n_chars"))
        columns[rest.index("n_chars")] = length.alias("n_chars")
    return found.select(*columns).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    # a document is known by its text, so ids need be neither given nor unique
    digest = F.sha2(F.col("text"), 256)
    leaks = stored(
        decontamination.contaminated(docs.select(digest.alias("doc_id"), "text"), items).select(F.col("doc_id").alias("leak")).distinct(),
        "leaks")
    return docs.join(broadcast_if_small(leaks, leaks.count(), BROADCAST_ROWS), digest == F.col("leak"), "left_anti")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shipped(spark)
    encoded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", decontaminate),
    ("tokens", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
