"""SimHash near-duplicates through an inverted index of fingerprint bytes.

A fingerprint has 8 bytes. Two that differ in at most 3 bits agree in at least 5 of
their bytes, by position, so three of them lie in the first or in the last four
positions: the posting lists are keyed by three bytes of one half with their positions
(8 lists for each fingerprint). For the pairs within a list the shared positional bytes
are tallied; pairs with the guaranteed minimum of 5 are verified on their bits.

Documents with one fingerprint are one entry of the index. A list of more than ``BLOCK``
entries is dealt as pairs of blocks, so no task holds a whole hot list. A task keeps, of
the links it verifies, a spanning forest: no link between components is lost and no task
writes more links than it has read entries.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document with fewer words
than a shingle is one shingle, one without words has fingerprint zero, and so has a null
text. Rows with a null doc_id keep their row; repeated rows keep theirs; other columns of
the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.components import components
from factloom.llm.store import partitions_for, stored

SEED = 42
BITS_APART = 3
#: 8 bytes less one for each differing bit.
LEAST_SHARED = 8 - BITS_APART
LISTS = [c for half in (range(4), range(4, 8)) for c in combinations(half, LEAST_SHARED - 2)]
BLOCK = 4096
ENTRIES_PER_TASK = 400_000
_CHUNK = 1 << 16


def shingles(text: str | None, words: int) -> list[bytes]:
    """The word shingles of a text, repeats included; none of a text without words."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return []
    joined = b" ".join(parts)
    if len(parts) <= words:
        return [joined]
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = [0, *ends[: len(parts) - words].tolist()]
    return [joined[i:j] for i, j in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)]


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included, as a signed integer."""
    pieces = shingles(text, words)
    if not pieces:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in pieces], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        piece = hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(piece, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def with_fingerprints(docs: DataFrame, words: int = 3, column: str = "fingerprint") -> DataFrame:
    """The rows and columns of ``docs`` with the fingerprint as 16 hex digits."""
    rest = [c for c in docs.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [f"{fingerprint(t.as_py(), words) % 2**64:016x}" for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(values, pa.string())], [*rest, column])

    return docs.select(*rest).mapInArrow(run, docs.select(*rest).schema.add(column, "string"))


def _links_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links of the pairs within runs of one list, as a spanning forest.

    The rows of a task come sorted by list; all its pairs at distance 1 in their run are
    judged together, then those at distance 2, until no run is that long.
    """
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows)
    listed = table.column("list").to_numpy()
    side = table.column("side").to_numpy()
    nodes, at = np.unique(table.column("fp").to_numpy(), return_inverse=True)
    bits = nodes.view(np.uint64)
    starts = np.flatnonzero(np.r_[True, listed[1:] != listed[:-1]])
    ends = np.repeat(np.r_[starts[1:], len(listed)], np.diff(np.r_[starts, len(listed)]))
    root = np.arange(len(nodes))
    forest: list[np.ndarray] = []
    first = np.arange(len(listed))
    apart = 0
    while True:
        apart += 1
        first = first[first + apart < ends[first]]
        if not len(first):
            break
        second = first + apart
        # the two sides of a pair of blocks meet; each block's own pairs are elsewhere
        meet = (side[first] < 0) | (side[first] != side[second])
        a, b = at[first[meet]], at[second[meet]]
        differ = bits[a] ^ bits[b]
        nonzero = ((differ & np.uint64(0x7F7F7F7F7F7F7F7F)) + np.uint64(0x7F7F7F7F7F7F7F7F) | differ) & np.uint64(0x8080808080808080)
        shared = 8 - np.bitwise_count(nonzero)
        keep = shared >= LEAST_SHARED
        keep[keep] = np.bitwise_count(differ[keep]) <= BITS_APART
        a, b = a[keep], b[keep]
        root, kept = _joined(root, a, b)
        if len(kept):
            forest.append(np.stack([a[kept], b[kept]]))
    if forest:
        pairs = np.concatenate(forest, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[pairs[0]]), pa.array(nodes[pairs[1]])], ["a", "b"])


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The forest's roots after links a-b, and which of the links it needed."""
    used: list[np.ndarray] = []
    left = np.arange(len(a))
    while True:
        x, y = root[a[left]], root[b[left]]
        left = left[x != y]
        if not len(left):
            return root, np.concatenate(used) if used else np.empty(0, np.int64)
        x, y = root[a[left]], root[b[left]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        # one link for each higher root: hooking to a lower one makes no circle
        _, pick = np.unique(high, return_index=True)
        root = root.copy()
        root[high[pick]] = low[pick]
        used.append(left[pick])
        while not np.array_equal(jumped := root[root], root):
            root = jumped


def links(distinct: DataFrame, rows: int) -> DataFrame:
    """(a, b): fingerprints that link; every component of links is spanned.

    ``distinct`` has one row for each fingerprint ``fp``, ``rows`` in all.
    """

    def list_of(n: int, positions: tuple[int, ...]):
        byte = lambda p: F.shiftrightunsigned(F.col("fp"), 8 * p).bitwiseAND(F.lit(255))
        key = F.lit(n).cast("long")
        for p in positions:
            key = key * 256 + byte(p)
        return key

    entries = distinct.select("fp", F.explode(F.array(*[list_of(n, c) for n, c in enumerate(LISTS)])).alias("list"))
    sizes = entries.groupBy("list").agg(F.count("*").alias("n")).where("n > 1")
    sized = entries.join(sizes, "list")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    small = sized.where(f"n <= {BLOCK}").select("fp", "list", F.lit(-1).alias("side"), F.lit(0).alias("i"), F.lit(0).alias("j"))
    large = (
        sized.where(f"n > {BLOCK}").withColumn("m", mine)
        .select("fp", "list", "m", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        .select("fp", "list", F.when(F.col("m") == F.col("other"), -1).otherwise(F.col("m")).alias("side"),
                F.least("m", "other").alias("i"), F.greatest("m", "other").alias("j"))
    )
    dealt = small.unionByName(large).select("fp", "side", F.xxhash64("list", "i", "j").alias("list"))
    tasks = partitions_for(len(LISTS) * rows, ENTRIES_PER_TASK)
    conf = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(max(tasks, conf), "list").sortWithinPartitions("list").mapInArrow(_links_of_runs, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, with_group: bool = False) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    ``component_id`` is the smallest doc_id that links of at most 3 bits reach. Where ids repeat
    or are null it does not name one component; ``with_group`` adds a column ``group`` that does.
    """
    prints = stored(fingerprints(docs, words), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    found = links(distinct.select("fp"), distinct.count())
    labels = components(found)
    rooted = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))
    lowest = rooted.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = rooted.join(lowest, "label").select("fp", "component_id", *(["label"] if with_group else []))
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        *([F.col("label").alias("group")] if with_group else []))
