"""Exact top-k search by inner product with two cover trees.

Vectors become integers, floor(64 * x). Rows with equal vectors are one point that keeps
its k + 1 smallest ids: more can never be among k best. The upper level of both trees is
shared: centres found by farthest-first choice from a bounded sample, to which every vector
is dealt by distance; a cell with many points is dealt as several blocks. Below, each block
is a cover tree of its own, whose nodes halve the covering radius of the one above; it is built
once, and stored with the block, whose points lie in the tree's order.

The search goes down a tree of queries and a tree of data at once, level by level. Two nodes with centres
q and r, radii a and b, hold no pair with a product above q.r + a|r| + b|q| + ab; the pair is
left out where that is under the worst k-th score that the queries of the node have so far. The
leaves of data that a leaf of queries has to meet come in order of their bounds, several in one
product of matrices.
A first round on one block of the cell that promises most gives each query a k-th score to
start from; the second round meets the cells that are left. Equal scores are never cut off,
so ties go to the smaller id.

Null vectors and those with a null or non-finite component take no part. A shorter vector
goes on with zeros. Rows repeated with one id and vector count once; a query never finds
its own id. Scores beyond 64 bits stop at the ends of the range. Null ids take no part; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.store import partitions_for, stored

SCALE = 64.0
#: Bounds: sampled vectors for the centres, centres, points of a block, queries of a block, points of a leaf.
SAMPLE, MOST_CELLS, BLOCK, QUERIES, LEAF = 4096, 512, 4096, 512, 64
#: Points of the first product of matrices of a leaf of queries, and how many times as many the next has.
FIRST, MORE = 256, 4
#: Whole numbers up to these are exact in 32 and 64 bits.
_SINGLE, _EXACT = 2.0**24, 2.0**52
#: Scores stop here, and so do their bounds.
_LEAST = -(2.0**63)


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = [], []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if vec_id is None or not vector.is_valid or vector.values.null_count:
                continue
            x = np.floor(np.asarray(vector.values.to_numpy(zero_copy_only=False), np.float64) * SCALE)
            if np.isfinite(x).all():
                ids.append(vec_id)
                out.append(x.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["vec_id", "vec"])


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        x = np.frombuffer(v)
        out[i, : len(x)] = x
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit integers."""
    most = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * max(a.shape[1], 1)
    if most < _EXACT:
        return np.rint(a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(a).dot(whole(b).T)
    ends = np.iinfo(np.int64)
    return np.clip(exact, ends.min, ends.max).astype(np.int64)


class CoverTree:
    """Nodes as arrays: points first..last of the reordered block, the first of which is the centre, a covering radius, children."""

    def __init__(self, points: np.ndarray, nodes: bytes | None = None) -> None:
        if nodes is None:
            self._build(points)
        else:
            self.points = points
            first, last, radius, parent = np.frombuffer(nodes).reshape(4, -1)
            self.first, self.last, self.parent = (x.astype(np.int64) for x in (first, last, parent))
            self.radius = radius
        self.centres = self.points[self.first]
        self.norms = np.sqrt((self.centres**2).sum(1))
        # the children of a node lie together in ``below``
        self.below = np.argsort(self.parent, kind="stable")
        self.cuts = np.searchsorted(self.parent[self.below], np.arange(len(self.first) + 1))
        self.many = np.diff(self.cuts)
        self.width = np.abs(self.points).max(initial=0.0)
        self._single: np.ndarray | None = None

    @property
    def children(self) -> list[list[int]]:
        return [self.below[a:b].tolist() for a, b in zip(self.cuts[:-1].tolist(), self.cuts[1:].tolist(), strict=True)]

    def packed(self) -> bytes:
        """All but the points."""
        return np.array([self.first, self.last, self.radius, self.parent], np.float64).tobytes()

    def single(self) -> np.ndarray:
        if self._single is None:
            self._single = self.points.astype(np.float32)
        return self._single

    def _build(self, points: np.ndarray) -> None:
        self.order = np.arange(len(points))
        nodes: list[tuple[int, int, float, int]] = []
        todo = [(0, len(points), -1)]
        while todo:
            first, last, parent = todo.pop()
            mine = points[self.order[first:last]]
            node = len(nodes)
            away = np.sqrt(((mine - mine[0]) ** 2).sum(1))
            # a little more than measured, for rounding
            nodes.append((first, last, float(away.max()) * (1 + 1e-9), parent))
            if last - first <= LEAF or away.max() == 0:
                continue
            nearest, best = np.zeros(len(mine), np.int64), away
            for k in range(1, 16):  # centres, farthest first, until half the radius covers all
                if best.max() <= away.max() / 2:
                    break
                far = int(best.argmax())
                other = np.sqrt(((mine - mine[far]) ** 2).sum(1))
                closer = other < best
                nearest[closer], best = k, np.minimum(best, other)
            by_child = np.argsort(nearest, kind="stable")
            self.order[first:last] = self.order[first:last][by_child]
            cuts = np.searchsorted(nearest[by_child], np.arange(int(nearest.max()) + 2))
            todo += [(first + a, first + b, node) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) if b > a]
        self.points = points[self.order]
        first, last, radius, parent = zip(*nodes, strict=True)
        self.first, self.last, self.parent = (np.array(x, np.int64) for x in (first, last, parent))
        self.radius = np.array(radius)


def bound(qc: np.ndarray, qr: float, rc: np.ndarray, rr: float | np.ndarray) -> np.ndarray:
    """The largest product that points within the two radii of the centres may have."""
    top = rc @ qc + qr * np.sqrt((rc**2).sum(-1)) + rr * np.sqrt((qc**2).sum()) + qr * rr
    return np.maximum(top + 1e-9 * np.abs(top) + 1.0, _LEAST)


def _bounds(own: CoverTree, other: CoverTree) -> np.ndarray:
    """``bound`` of every pair of nodes."""
    top = own.centres @ other.centres.T + np.outer(own.radius, other.norms) + np.outer(own.norms, other.radius) + np.outer(own.radius, other.radius)
    return np.maximum(top + 1e-9 * np.abs(top) + 1.0, _LEAST)


def _below(tree: CoverTree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The children of each of the nodes, and whose they are by place."""
    many = tree.many[nodes]
    whose = np.repeat(np.arange(len(nodes)), many)
    return tree.below[np.arange(many.sum()) + np.repeat(tree.cuts[nodes] - np.cumsum(many) + many, many)], whose


def _leaves(own: CoverTree, other: CoverTree, tops: np.ndarray, kth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of leaves that no bound on the way to them leaves out."""
    low = np.array([kth[a:b].min() for a, b in zip(own.first.tolist(), own.last.tolist(), strict=True)])
    a, b, done = np.zeros(1, np.int64), np.zeros(1, np.int64), []
    while len(a):
        kept = tops[a, b] >= low[a]
        a, b = a[kept], b[kept]
        down = (own.many[a] > 0) & ((own.radius[a] >= other.radius[b]) | (other.many[b] == 0))
        over = ~down & (other.many[b] > 0)
        ends = ~down & ~over
        done.append((a[ends], b[ends]))
        below, whose = _below(own, a[down])
        across, from_ = _below(other, b[over])
        a, b = np.concatenate([below, a[over][from_]]), np.concatenate([b[down][whose], across])
    return np.concatenate([x for x, _ in done]), np.concatenate([y for _, y in done])


def _best(i: np.ndarray, s: np.ndarray, n: int, k: int) -> np.ndarray:
    """The k-th highest score of each of ``n`` queries, the least number where there are fewer."""
    order = np.lexsort((~s, i))  # no number has its negative out of range
    starts = np.searchsorted(i[order], np.arange(n + 1))
    kth = np.full(n, np.iinfo(np.int64).min)
    full = np.diff(starts) >= k
    kth[full] = s[order[starts[:-1][full] + k - 1]]
    return kth


def search(own: CoverTree, worst: np.ndarray, other: CoverTree, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dual-tree search: (query, point, score) of all pairs that may be among a query's k best.

    Queries and points are numbered in their trees' order. ``worst`` holds each query's k-th
    score so far; it rises as the search goes on.
    """
    kth = worst.copy()
    tops = _bounds(own, other)
    a, b = _leaves(own, other, tops, kth)
    most = max(own.width * other.width * max(own.points.shape[1], 1), float(kth.max(initial=0)))
    q, p = (own.single(), other.single()) if most < _SINGLE else (own.points, other.points)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for leaf in np.unique(a).tolist():
        rows = slice(own.first[leaf], own.last[leaf])
        left = b[a == leaf]
        # the most promising leaves come first
        left = left[np.argsort(-tops[leaf, left], kind="stable")]
        size = FIRST
        while len(left := left[tops[leaf, left] >= kth[rows].min()]):
            sizes = other.last[left] - other.first[left]
            n = int(np.searchsorted(np.cumsum(sizes), size)) + 1
            at = np.arange(sizes[:n].sum()) + np.repeat(other.first[left[:n]] - np.cumsum(sizes[:n]) + sizes[:n], sizes[:n])
            left, size = left[n:], size * MORE
            scores = q[rows] @ p[at].T if most < _EXACT else products(q[rows], p[at])
            limit = kth[rows].astype(scores.dtype) if most < _EXACT else kth[rows]
            i, j = np.nonzero(scores >= limit[:, None])
            if len(i):
                found.append((i + own.first[leaf], at[j], scores[i, j].astype(np.int64)))
                kth[rows] = np.maximum(kth[rows], _best(i, found[-1][2], len(limit), k))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    i, j, s = (np.concatenate([f[n] for f in found]) for n in range(3))
    keep = s >= np.maximum(kth, _best(i, s, len(kth), k))[i]
    return i[keep], j[keep], s[keep]


def _centres(points: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first centres."""
    chosen = [0]
    away = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < n and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def _packing(width: int, by: list[str]):
    """One row for each block: its vectors, ids, and the sphere around its middle."""

    def run(table: pa.Table) -> pa.Table:
        tree = CoverTree(_matrix(table["vec"].to_pylist(), width))
        points = tree.points
        middle = points.mean(0)
        radius = float(np.sqrt(((points - middle) ** 2).sum(1)).max()) * (1 + 1e-9)
        ids = table["ids"].combine_chunks().take(pa.array(tree.order)).to_pylist()
        return pa.table({
            **{c: table[c].slice(0, 1) for c in by}, "n": pa.array([len(points)], pa.int64()), "vecs": pa.array([points.tobytes()], pa.binary()),
            "nodes": pa.array([tree.packed()], pa.binary()),
            "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))), "middle": pa.array([middle.tobytes()], pa.binary()), "radius": pa.array([radius])})

    return run


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries, the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = stored(vectors.select(F.col(id).cast("long").alias("vec_id"), vector)
                  .mapInArrow(_integers, "vec_id long, vec binary").distinct(), "vectors")
    shape = rows.agg(F.max(F.octet_length("vec")).alias("bytes"), F.count("*").alias("n")).first()
    result = "query_id long, rank int, vec_id long, score long"
    if not shape["n"]:
        return spark.createDataFrame([], result)
    width = shape["bytes"] // 8
    ranked = rows.selectExpr("vec", "vec_id", "row_number() OVER (PARTITION BY vec ORDER BY vec_id) AS place")
    points = stored(ranked.where(F.col("place") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "points")
    total = points.count()
    part = F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) / float(1 << 30)
    sample = points.where(part < SAMPLE / total).select("vec").limit(2 * SAMPLE).collect() or points.select("vec").limit(1).collect()
    centres = _centres(_matrix([bytes(r["vec"]) for r in sample], width), min(MOST_CELLS, partitions_for(total, BLOCK // 2)))
    shared = spark.sparkContext.broadcast(centres)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vec").to_pylist(), width)
            c = shared.value
            away = (c**2).sum(1)[None, :] - 2 * x @ c.T
            cell = pa.array(away.argmin(1) if len(x) else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec"), batch.column("ids"), cell], ["vec", "ids", "cell"])

    def blocks(of: DataFrame, most: int, name: str) -> tuple[DataFrame, dict[int, int]]:
        dealt = stored(of.mapInArrow(deal, "vec binary, ids array<long>, cell long"), f"{name}-cells")
        sizes = {r["cell"]: partitions_for(r["count"], most) for r in dealt.groupBy("cell").count().collect()}  # MOST_CELLS rows
        parts = F.get(F.array(*[F.lit(sizes.get(c, 1)) for c in range(len(centres))]), F.col("cell").cast("int"))
        chunk = F.pmod(F.xxhash64("vec", F.lit("chunk")), parts).cast("long")
        packed = dealt.withColumn("chunk", chunk).groupBy("cell", "chunk").applyInArrow(
            _packing(width, ["cell", "chunk"]), "cell long, chunk long, n long, vecs binary, nodes binary, ids array<array<long>>, middle binary, radius double")
        return stored(packed, name), sizes

    data, chunks = blocks(points, BLOCK, "data-blocks")
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).select("vec", F.array("vec_id").alias("ids"))
    queries, _ = blocks(asked, QUERIES, "query-blocks")
    spheres = {}
    around = data.select("cell", "middle", "radius").mapInArrow(_far_from(shared), "cell long, radius double")
    for r in around.groupBy("cell").agg(F.max("radius").alias("radius")).collect():  # MOST_CELLS rows
        spheres[r["cell"]] = r["radius"]

    def meetings(first: bool):
        """Cells that a block of queries has to meet: the most promising one, or all that may matter."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = sorted(spheres)
            c, radius = shared.value[names], np.array([spheres[n] for n in names])
            for batch in batches:
                for i, row in enumerate(batch.to_pylist()):
                    tops = bound(np.frombuffer(row["middle"]), row["radius"], c, radius)
                    if first:
                        middle = c @ np.frombuffer(row["middle"])
                        pairs = [(names[int(middle.argmax())], 0)]
                    else:
                        worst = np.frombuffer(row["kth"], np.int64).min()
                        pairs = [(names[j], h) for j in np.flatnonzero(tops >= worst).tolist() for h in range(chunks[names[j]])]
                    one = pa.Table.from_batches([batch.slice(i, 1)])
                    for x, h in pairs:
                        yield from one.append_column("at_cell", pa.array([x], pa.int64())).append_column("at_chunk", pa.array([h], pa.int64())).to_batches()

        return run

    near = data.select(F.col("cell").alias("at_cell"), F.col("chunk").alias("at_chunk"), F.col("n").alias("m"),
                       F.col("vecs").alias("points"), F.col("nodes").alias("point_nodes"), F.col("ids").alias("point_ids"), F.col("middle").alias("at"), F.col("radius").alias("reach"))
    def meeting(of: DataFrame, first: bool) -> DataFrame:
        kind = of.select("*").schema.add("at_cell", "long").add("at_chunk", "long")
        return of.mapInArrow(meetings(first), kind).join(near, ["at_cell", "at_chunk"])

    def met(batch: pa.RecordBatch, n: int, worst: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """The queries of a row, and (query's place, vec_id, score) of what its search finds but the queries themselves."""
        of = lambda c: batch.column(c)[n]
        q, p = (CoverTree(np.frombuffer(of(v).as_buffer()).reshape(-1, width), of(t).as_py()) for v, t in (("vecs", "nodes"), ("points", "point_nodes")))
        own = pc.list_flatten(of("ids").values).to_numpy()
        # one more, as a query's own point may be among them
        i, j, s = search(q, np.full(len(own), np.iinfo(np.int64).min) if worst is None else worst, p, k + 1)
        ids = of("point_ids").values.take(pa.array(j))
        many = pc.list_value_length(ids).to_numpy()
        i, s, ids = np.repeat(i, many), np.repeat(s, many), pc.list_flatten(ids).to_numpy()
        others = ids != own[i]
        return own, i[others], ids[others], s[others]

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k-th scores that each query of a block reaches in one block of data."""
        for batch in batches:
            for n in range(batch.num_rows):
                own, i, _, s = met(batch, n, None)
                one = batch.slice(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [one.column("cell"), one.column("chunk"), pa.array([_best(i, s, len(own), k).tobytes()], pa.binary())], ["cell", "chunk", "kth"])

    starts = stored(meeting(queries, True).mapInArrow(start, "cell long, chunk long, kth binary"), "first-scores")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                r = {c: batch.column(c)[n].as_py() for c in ("kth", "middle", "radius", "at", "reach")}
                kth = np.frombuffer(r["kth"], np.int64)
                if bound(np.frombuffer(r["middle"]), r["radius"], np.frombuffer(r["at"]), r["reach"]) < kth.min():
                    continue
                own, i, ids, s = met(batch, n, kth)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (own[i], ids, s)], ["query_id", "vec_id", "score"])

    found = meeting(queries.join(starts, ["cell", "chunk"]), False).mapInArrow(finish, "query_id long, vec_id long, score long")
    placed = found.distinct().selectExpr(
        "query_id", "CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS int) AS rank", "vec_id", "score")
    return placed.where(F.col("rank") <= k)


def _far_from(centres):
    """How far each block reaches from its cell's centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [float(np.sqrt(((np.frombuffer(m) - centres.value[c]) ** 2).sum())) + r
                   for c, m, r in zip(*(batch.column(x).to_pylist() for x in ("cell", "middle", "radius")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("cell"), pa.array(out, pa.float64())], ["cell", "radius"])

    return run
