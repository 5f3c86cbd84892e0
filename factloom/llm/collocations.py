"""Phrase collocations by dynamic itemset counting.

Documents are dealt to ``SHARDS`` shards, which are scanned in a cycle, one in each step. A step
counts phrases of all lengths that are active: words from the start, and a longer phrase from the
step after both of its subphrases, without its last and without its first word, have reached
the threshold. A phrase is counted for one full cycle from its own first step, so its count is exact
although lengths interleave; no pass waits for the shorter phrases to end. The job ends when no
phrase is in its cycle and none can be activated.

Running counts lie in a table that each step replaces: phrases whose cycle is over leave it, those
under the threshold for good. Workers learn the first step of a phrase from an array of 2**bits bytes:
at the hash of a subphrase it holds the step from which it may be built upon, which is never before
the subphrase's own first step, whatever its place holds. Two phrases in one place only make a longer
one active early, from one step that all workers agree on, so its cycle is still one full cycle. The array grows with the corpus up to ``MOST_BITS``; when it is full,
more is counted, and no result changes.

Of each candidate the cut into two parts with the least score floor(``SCALE`` * a / (l + r)) counts,
ties to the shortest first part; candidates within a longer one that is at least ``SHARE`` per cent as
frequent are dropped; each lang's first ``TOP`` by score, frequency and phrase remain.

A-Z are lower-cased. Pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+`` within them. A null
text is empty, a null lang is ``und``. Rows count as often as they stand there; doc_id is not read,
nor are other columns; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.store import new_path, stored

LENGTHS, LEAST, SCALE, SHARE, TOP = 4, 30, 2_000_000, 80, 2000
SHARDS = 3
#: Text that is counted at once, and the bounds of the array of first steps (bits; text bytes for each place).
CHUNK_BYTES, LEAST_BITS, MOST_BITS, BYTES_A_PLACE = 8 << 20, 16, 26, 64
#: So many chunks are held at most while each lang's text is gathered; then the largest is counted before it is full.
HELD_CHUNKS = 4
#: Parts of a lang whose best phrases are ranked before those of the whole lang.
SALTS = 64
UNKNOWN = "und"
#: A key is lang, tab and phrase; a state is 256 times the step from which the phrase is built upon, and its own first step.
COUNTS = "key string, n long, state int"
#: Letters to lower case, ends of pieces to full stops, tabs to spaces.
_PLAIN = bytes(46 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c in (9, 32) else c + 32 if 65 <= c <= 90 else c for c in range(256))
_MULTIPLY, _FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def _longer(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of phrases from those of all their words but one, and of the last."""
    x = (head * _FOLD) ^ word
    return (x ^ (x >> np.uint64(29))) * _MULTIPLY


def _place(hashes: np.ndarray, lang: str, bits: int) -> np.ndarray:
    x = (hashes ^ np.uint64(_hash(lang.encode()))) * _MULTIPLY
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def place_of(key: str, bits: int) -> int:
    """Where the first step of what builds on a phrase stands."""
    lang, _, phrase = key.rpartition("\t")
    hashes = np.array([_hash(w) for w in phrase.encode().split(b" ")], np.uint64)
    h = hashes[:1]
    for k in range(1, len(hashes)):
        h = _longer(h, hashes[k : k + 1])
    return int(_place(h, lang, bits)[0])


def _chunks(texts: list[bytes]) -> Iterator[bytes]:
    """Plain text of some ``CHUNK_BYTES``; a long text is cut where a piece ends."""
    held, size = [], 0
    for text in texts:
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > CHUNK_BYTES:
                stop = text.find(b".", at + CHUNK_BYTES)
                end = end if stop < 0 else stop + 1
            held.append(text[at:end])
            size += end - at
            at = end
            if size >= CHUNK_BYTES:
                yield b".".join(held)
                held, size = [], 0
    if held:
        yield b".".join(held)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key the number of its value, and of each value a place and how often it stands."""
    coded = pa.array(keys).dictionary_encode()
    back = coded.indices.to_numpy().astype(np.int64)
    at = np.empty(len(coded.dictionary), np.int64)
    at[back] = np.arange(len(back))
    return back, at, np.bincount(back, minlength=len(at))


def count_chunk(text: bytes, lang: str, step: int, shards: int, firsts: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """(first step, counts, phrases) of the active phrases in a chunk; the empty phrase stands for all words."""
    spaced = pa.array([text.replace(b".", b" . ").decode()], pa.large_string())
    coded = pc.ascii_trim_whitespace(spaced).cast(pa.large_string())
    coded = pc.list_flatten(pc.ascii_split_whitespace(coded)).dictionary_encode()
    names, w = coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int64)
    listed = names.cast(pa.binary()).to_pylist()
    breaks = pc.is_in(names, pa.array([".", ""], names.type)).to_numpy(zero_copy_only=False)
    if step < shards:
        counts = np.bincount(w, minlength=len(listed))
        real = np.flatnonzero(~breaks)
        yield 0, counts[real].sum(keepdims=True), pa.array([""], pa.string())
        yield 0, counts[real], names.take(pa.array(real))
    h = np.fromiter(map(_hash, listed), np.uint64, len(listed))
    begun = firsts[_place(h, lang, bits)]
    begun[breaks] = 0
    # at each place: when what builds on the phrase that starts there may start; and its hash, if so
    head, may = None, begun[w]
    for size in range(2, LENGTHS + 1):
        # both parts have reached the threshold, and no piece ends within
        alive = np.flatnonzero((may[:-1] > 0) & (may[1:] > 0))
        if not len(alive):
            return
        first = np.maximum(may[alive], may[alive + 1])
        for f in np.flatnonzero(np.bincount(first)).tolist():
            if f <= step < f + shards:  # its cycle is not over
                places = alive[first == f]
                keys = w[places]
                for k in range(1, size):
                    keys = (keys if k == 1 else _distinct(keys)[0]) * len(listed) + w[places + k]
                _, at, counts = _distinct(keys)
                places = places[at]
                yield f, counts, pc.binary_join_element_wise(*[names.take(pa.array(w[places + k])) for k in range(size)], " ")
        if size == LENGTHS:
            return
        longer = _longer(h[w[alive]] if head is None else head[alive], h[w[alive + size - 1]])
        n = len(may) - 1
        head, may = np.empty(n, np.uint64), np.zeros(n, np.uint8)
        head[alive] = longer
        own = firsts[_place(longer, lang, bits)]
        # another phrase may have marked the place before this one was counted at all
        may[alive] = np.where(own > 0, np.maximum(own, first), 0)


def _counting(step: int, shards: int, given, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = np.frombuffer(given.value, np.uint8)
        by_lang: dict[str, list[bytes]] = defaultdict(list)
        sizes: dict[str, int] = defaultdict(int)

        def counted(lang: str) -> Iterator[pa.RecordBatch]:
            del sizes[lang]
            for chunk in _chunks(by_lang.pop(lang)):
                for first, counts, phrases in count_chunk(chunk, lang, step, shards, firsts, bits):
                    keys = pc.binary_join_element_wise(pa.scalar(lang), phrases, "\t")
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.array(counts, pa.int64()), pa.array(np.full(len(keys), first), pa.int32())], ["key", "n", "state"])

        held = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                by_lang[lang].append(text.translate(_PLAIN))
                sizes[lang] += len(text)
                held += len(text)
                # a chunk of one lang repeats its phrases oftener than a chunk of all
                full = lang if sizes[lang] >= CHUNK_BYTES else max(sizes, key=sizes.get) if held >= HELD_CHUNKS * CHUNK_BYTES else None
                if full is not None:
                    held -= sizes[full]
                    yield from counted(full)
        for lang in list(by_lang):
            yield from counted(lang)

    return run


def _places(bits: int):
    """The places of phrases, each partition's as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [place_of(key, bits) for b in batches for key in b.column("key").to_pylist()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([np.unique(np.array(found, np.int32)).tobytes()], pa.binary())], ["places"])

    return run


def count_phrases(docs: DataFrame, least: int = LEAST, shards: int = SHARDS) -> DataFrame:
    """(lang, size, phrase, n): phrases of up to four words with at least ``least`` occurrences, and the words of a lang as size 0."""
    spark = docs.sparkSession
    path = new_path(spark, "shards")
    dealt = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    # by its own hash, so that a recomputed task deals alike; the file of a shard is written in the same task
    shard = F.pmod(F.xxhash64("text", "lang"), F.lit(shards)).cast("int").alias("shard")
    dealt.select("*", shard).write.partitionBy("shard").option("compression", "zstd").parquet(path)
    table = spark.read.schema("lang string, text string, shard int").parquet(path) if not docs.isEmpty() else dealt.select("*", shard)
    size = table.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits = min(max((size // BYTES_A_PLACE).bit_length(), LEAST_BITS), MOST_BITS)
    firsts = np.zeros(1 << bits, np.uint8)
    running = spark.createDataFrame([], COUNTS)
    done: list[DataFrame] = []
    step, until = 0, shards
    while step < until:
        given = spark.sparkContext.broadcast(firsts.tobytes())
        counted = table.where(F.col("shard") == step % shards).select("lang", "text").mapInArrow(_counting(step, shards, given, bits), COUNTS)
        sums = running.unionByName(counted).groupBy("key").agg(F.sum("n").alias("n"), F.max("state").alias("state"))
        over = F.col("state") % 256 + shards - 1 <= step
        reached = F.when((F.col("n") >= least) & (F.col("state") < 256), F.col("state") + 256 * (step + 1)).otherwise(F.col("state"))
        kept = stored(
            sums.withColumn("over", over).where(~over | (F.col("n") >= least) | F.col("key").endswith("\t")).withColumn("state", reached),
            f"counts-{step}", {"parquet.enable.dictionary": "false"})
        done.append(kept.where("over").select("key", "n"))
        running = kept.where("NOT over").select("key", "n", "state")
        size_of = F.size(F.split(F.substring_index("key", "\t", -1), " "))
        new = kept.where((F.col("state") >= 256 * (step + 1)) & ~F.col("key").endswith("\t") & (size_of < LENGTHS)).select("key")
        for (places,) in new.mapInArrow(_places(bits), "places binary").collect():  # at most 4 bytes a place of the array and task
            at = np.frombuffer(bytes(places), np.int32)
            at = at[firsts[at] == 0]
            firsts[at] = step + 1
            if len(at):
                until = step + 1 + shards
        given.unpersist()
        step += 1
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    phrase = F.substring_index("key", "\t", -1)
    lang = F.expr("left(key, length(key) - length(phrase) - 1)")
    size = F.when(F.col("phrase") == "", 0).otherwise(F.regexp_count("phrase", F.lit(" ")) + 1)
    return found.select("key", phrase.alias("phrase"), "n").select(lang.alias("lang"), size.alias("size"), "phrase", "n")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, scale: int = SCALE, share: int = SHARE, shards: int = SHARDS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each lang's first ``top`` phrases."""
    counts = stored(count_phrases(docs, least, shards), "phrases")
    phrases = counts.where("size > 0")
    candidates = phrases.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    exact = "decimal(38,0)"
    part = lambda start, n: F.array_join(F.slice("words", start, n), " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    of = lambda name, n: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    scored = cuts.join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"]).withColumn(
        "score", F.expr(f"(CAST(a AS decimal(28,0)) * {scale}BD) div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))"))
    best = scored.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # every candidate's parts that are candidates, each with the most that a longer one has
    inner = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> array_join(slice(words, i, m), ' '))))")
    within = (
        candidates.where("size > 2").select("lang", F.col("a").alias("longer"), F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    free = best.join(within, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast(exact) * 100 < F.col("a").cast(exact) * share))
    order = "ORDER BY score DESC, a DESC, phrase"
    ranked = free.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))
    salted = ranked.selectExpr("*", f"row_number() OVER (PARTITION BY lang, pmod(xxhash64(phrase), {SALTS}) {order}) AS place").where(F.col("place") <= top)
    placed = salted.selectExpr("*", f"row_number() OVER (PARTITION BY lang {order}) AS final").where(F.col("final") <= top)
    words = counts.where("size = 0").select("lang", "n")
    return placed.join(words, "lang").select("lang", F.col("final").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
