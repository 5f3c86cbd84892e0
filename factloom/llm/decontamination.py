"""Benchmark decontamination: short test items found inside long documents.

Containment search with size-partitioned MinHash sketches. Items are put into classes by
the number of their word shingles (powers of two). An item's sketch is its shingles of
least hash, as many as its class allows to be missing at the threshold and one more, so a
document that holds enough of the item holds a part of its sketch (no document is missed).
Documents are not sketched, as a short item would vanish in a long document's sketch:
their shingles are looked up in the sketches. Pairs with the guaranteed number of hits are
candidates, and each is verified on the shingles themselves.

Words are runs without white space, lower-cased. A text with fewer words than a shingle is
one shingle of all its words; one without words has none. Items without shingles match
nothing. Null ids keep their rows as an id of their own; repeated rows add nothing; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.store import broadcast_if_small, stored

WORDS = 5
THRESHOLD = 0.8
#: Sketch rows and candidate pairs up to these numbers are broadcast (some 30 and 50 MB);
#: larger tables are joined by shuffle.
BROADCAST_SKETCH, BROADCAST_PAIRS = 1_000_000, 1_000_000
_SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPACE), lambda w: w != "")


def _starts(words: Column, n: int) -> Column:
    """The places where shingles start; a short text has one, an empty text none."""
    size = F.size(words)
    last = F.greatest(size - n, F.lit(0))
    return F.when(size > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words: Column, n: int) -> Column:
    """A hash of each shingle; missing words of a short text count as null."""
    return F.transform(_starts(words, n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))


def shingles(words: Column, n: int) -> Column:
    return F.array_distinct(F.transform(_starts(words, n), lambda i: F.array_join(F.slice(words, i + 1, n), " ")))


def sketches(items: DataFrame, n: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """(item_id, hash, least): each item's sketch and how many of it a match must hit."""
    hashed = items.select("item_id", words_of(F.col("text")).alias("words")).select(
        "item_id", F.array_sort(F.array_distinct(shingle_hashes(F.col("words"), n))).alias("hashes"))
    size = F.size("hashes")
    upper = F.pow(F.lit(2.0), F.floor(F.log2(size)) + 1) - 1  # the largest size of the item's class
    missing = lambda of: F.floor(of * (1 - threshold) + 1e-9)
    sized = hashed.where(size > 0).select(
        "item_id", "hashes", F.least(missing(upper) + 1, size).cast("int").alias("k"), missing(size).alias("may_miss"))
    return sized.select(
        "item_id", F.explode(F.slice("hashes", F.lit(1), F.col("k"))).alias("hash"),
        F.greatest(F.col("k") - F.col("may_miss"), F.lit(1)).alias("least"))


def contaminated(
    docs: DataFrame, items: DataFrame, n: int = WORDS, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) of all pairs at or over the threshold."""
    sketch = stored(sketches(items, n, threshold), "sketches")
    hits = (
        docs.select("doc_id", words_of(F.col("text")).alias("words"))
        .select("doc_id", F.explode(shingle_hashes(F.col("words"), n)).alias("hash"))
        .join(broadcast_if_small(sketch, sketch.count(), BROADCAST_SKETCH), "hash")
    )
    candidates = stored(
        hits.groupBy("doc_id", "item_id", "least").agg(F.count_distinct("hash").alias("hits"))
        .where("hits >= least").select("doc_id", "item_id"), "candidates")
    pairs = broadcast_if_small(candidates, candidates.count(), BROADCAST_PAIRS)
    item_shingles = items.select("item_id", shingles(words_of(F.col("text")), n).alias("wanted"))
    by_text = docs.select(F.col("doc_id").alias("id"), "text").join(pairs, F.col("id").eqNullSafe(F.col("doc_id")))
    found = (
        by_text.select("doc_id", "item_id", words_of(F.col("text")).alias("words"))
        .select("doc_id", "item_id", shingles(F.col("words"), n).alias("held"))
        .join(item_shingles.withColumnRenamed("item_id", "item"), F.col("item_id").eqNullSafe(F.col("item")))
        .select("doc_id", "item_id", F.size("wanted").alias("n_shingles"),
                F.size(F.array_intersect("held", "wanted")).alias("n_found"))
        .where(F.col("n_found") >= threshold * F.col("n_shingles") - 1e-9)
    )
    return found.groupBy("doc_id", "item_id").agg(
        F.max("n_shingles").cast("long").alias("n_shingles"), F.max("n_found").cast("long").alias("n_found"),
        F.max(F.col("n_found") / F.col("n_shingles")).alias("containment"))
