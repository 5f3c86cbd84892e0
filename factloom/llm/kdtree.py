"""Sharding by a k-d tree over document metadata.

Every node that still holds more than one shard is split along its widest metadata
dimension (spread over the spread of all rows) at a weighted median, the weights being
sizes in bytes. Medians are found by narrowing: rows are summed into cells of the
ordering key's leading bits, and only the cell that the median falls into is looked at
more finely, so no node is ever sorted or gathered, and equal metadata values are split
by a hash of the row. A shard's size is off its share by at most ``TOLERANCE`` of it
and one document for each split.

Defined cases: a null text has size 1 and checksum 0; null metadata sorts first;
repeated rows are rows of their own; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.store import partitions_for, stored

_BITS = 30
_ROUNDS = ((46, 16), (30, 16), (14, 16), (0, 14))  # of the key's 62 bits: shift and width
TOLERANCE = 1e-4
#: The driver holds a few numbers for each node of the tree, so their count is bounded.
MOST_SHARDS = 1 << 14
ROWS_PER_SLOT_GROUP = 50_000


def _metadata(docs: DataFrame, text: str) -> dict[str, Column]:
    """The tree's dimensions as numbers; text values lie by their hash."""
    return {
        "by_source": F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")),
        "by_lang": F.crc32(F.coalesce(F.col("lang"), F.lit("")).cast("binary")),
        "by_size": F.log2(F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1),
        "by_id": F.coalesce(F.col("doc_id"), F.lit(0)),
    }


def _of_node(values: dict[int, object], otherwise: object, kind: str) -> Column:
    """A value for each node, from an array that lies in the plan as one constant."""
    each = [F.lit(values.get(n, otherwise)).cast(kind) for n in range(max(values, default=-1) + 1)]
    return F.coalesce(F.get(F.array(*each), F.col("node")), F.lit(otherwise).cast(kind)) if each else F.lit(otherwise).cast(kind)


def _medians(rows: DataFrame, shares: dict[int, float], weights: dict[int, int]) -> dict[int, int]:
    """For each node the key below which ``shares`` of its weight lies."""
    need = {n: shares[n] * weights[n] for n in shares}
    low = dict.fromkeys(shares, 0)  # first key of the cell that holds the median
    done: dict[int, int] = {}
    for shift, width in _ROUNDS:
        open_nodes = {n: low[n] for n in shares if n not in done}
        if not open_nodes:
            break
        start, span = _of_node(open_nodes, -1, "bigint"), 1 << (shift + width)
        cells = (
            rows.where((start >= 0) & (F.col("key") >= start) & (F.col("key") < start + F.lit(span)))
            .groupBy("node", F.shiftright(F.col("key") - start, shift).alias("cell"))
            .agg(F.sum("size").alias("weight"), F.count("*").alias("n"))
        )
        # at most 2^16 cells a node, whatever the number of rows
        total = "sum(weight) OVER (PARTITION BY node ORDER BY cell)"
        needed = _of_node({n: need[n] for n in open_nodes}, 0.0, "double")
        crossing = (
            cells.selectExpr("node", "cell", "weight", "n", f"{total} AS upto")
            .where(F.col("upto") >= needed)
            .groupBy("node")
            .agg(F.min_by(F.struct("cell", "weight", "n", "upto"), "cell").alias("c"))
            .collect()
        )
        for row in crossing:
            node, c = row["node"], row["c"]
            first = low[node] + (c["cell"] << shift)
            before = c["upto"] - c["weight"]
            small = c["weight"] <= TOLERANCE * weights[node]
            if c["n"] == 1 or shift == 0 or small:
                nearer = need[node] - before <= c["upto"] - need[node]
                done[node] = first if nearer else first + (1 << shift)
            else:
                need[node] -= before
                low[node] = first
    return done


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each document.

    Either the number of shards is given or the bytes that a shard should hold.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    dims = _metadata(docs, text)
    narrow = docs.select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), *[v.cast("double").alias(k) for k, v in dims.items()],
        # tells repeated rows apart; fixed once the table is written
        F.monotonically_increasing_id().alias("place"),
    )
    rows = stored(narrow, "kdtree-rows")
    stats = rows.agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"),
        *[f(k).alias(f"{k}_{n}") for k in dims for n, f in (("min", F.min), ("max", F.max))],
    ).first()
    total = stats["bytes"] or 0
    leaves = shards or max(1, math.ceil(total / (target_bytes or 1 << 30)))
    if leaves > MOST_SHARDS:
        raise ValueError(f"{leaves} shards; at most {MOST_SHARDS}")

    def scaled(k: str) -> Column:
        lo, hi = stats[f"{k}_min"] or 0.0, stats[f"{k}_max"] or 0.0
        return F.floor((F.col(k) - lo) / ((hi - lo) or 1.0) * ((1 << _BITS) - 1)).cast("long")

    tree = rows.select("doc_id", "size", "text_crc32", "place", *[scaled(k).alias(k) for k in dims],
                       F.lit(0).alias("node"))
    holds = {0: leaves}  # node: shards below it; a node's number is its first shard
    while any(n > 1 for n in holds.values()):
        open_nodes = {n: k for n, k in holds.items() if k > 1}
        nodes = tree.where(F.col("node").isin(*open_nodes)).groupBy("node").agg(
            F.sum("size").alias("weight"), *[(F.max(k) - F.min(k)).alias(k) for k in dims]
        ).collect()
        widest = {r["node"]: max(dims, key=lambda k: r[k]) for r in nodes}
        weights = {r["node"]: r["weight"] for r in nodes}
        value = F.lit(0).cast("long")
        for k in dims:
            mine = [n for n, d in widest.items() if d == k]
            value = F.when(F.col("node").isin(*mine), F.col(k)).otherwise(value) if mine else value
        spread = F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "place"), 32)  # splits equal values
        keyed = tree.withColumn("key", F.shiftleft(value, 32).bitwiseOR(spread))
        shares = {n: (open_nodes[n] // 2) / open_nodes[n] for n in weights}
        cuts = _medians(keyed, shares, weights)
        right = {n: n + open_nodes[n] // 2 for n in cuts}
        beyond = F.col("key") >= _of_node(cuts, (1 << 62), "bigint")
        tree = keyed.withColumn(
            "node", F.when(beyond, _of_node(right, 0, "int")).otherwise(F.col("node"))
        ).drop("key")
        for n, k in open_nodes.items():
            holds[n] = k // 2
            holds[n + k // 2] = k - k // 2
    return _slots(tree.select("doc_id", "size", "text_crc32", "place", F.col("node").alias("shard")), stats["rows"])


def _slots(placed: DataFrame, rows: int) -> DataFrame:
    """A gapless number for each row of a shard, made of counts of small groups of its rows."""
    groups = partitions_for(rows, ROWS_PER_SLOT_GROUP)
    grouped = placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "place"), F.lit(groups)).cast("int"))
    counts = grouped.groupBy("shard", "part").agg(F.count("*").alias("n"))
    bases = counts.selectExpr(
        "shard", "part", "sum(n) OVER (PARTITION BY shard ORDER BY part) - n AS base"
    )
    number = "row_number() OVER (PARTITION BY shard, part ORDER BY doc_id, place) - 1"
    numbered = grouped.selectExpr("doc_id", "size", "text_crc32", "shard", "part", f"{number} AS at")
    return numbered.join(bases, ["shard", "part"]).selectExpr(
        "doc_id", "size", "text_crc32", "shard", "CAST(base + at AS bigint) AS slot"
    )
