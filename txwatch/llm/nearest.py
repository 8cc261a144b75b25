"""Exact nearest neighbours by inner product: a block matrix join of int8 tiles.

Vectors are packed into blocks.  Query blocks and candidate blocks meet in the cells of a
grid (one Spark key a cell), each pair of blocks once.  In a cell a tile is the product of
two int8 blocks; with u = s*q + e (s: scale, q: int8, e: what rounding left) it gives the
inner product up to |u||e_v| + |e_u||v^|, so a pair whose upper bound lies under the best
lower bounds met is done with.  The pairs that survive are computed again from the original
vectors in double precision (products added in component order) and go into heaps; a query's
heaps of all cells are merged by heaps once more.  No pair is left out on the bounds' account:
the result is exact.

Defined results: vectors null, zero, empty, or holding null or non-finite components take no
part, nor do rows without id.  Rows that repeat an id count once, with the least of their
vectors.  A vector only meets vectors of its own length.  Ties go to the smaller id.  Equal
vectors under many ids are one candidate (its k + 1 smallest ids are all that can be among
the nearest) and one query, so a crowd of copies costs one row.  Extra columns are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Rows of a block; rows of a tile's query side; a slab of components whose int8 products
#: add up exactly in 32-bit floats (127 * 127 * 1024 < 2 ** 24).
BLOCK, TILE_ROWS, SLAB = 1024, 512, 1024
#: Bytes of query vectors that a cell holds, and of candidate vectors that pass through it.
QUERY_BYTES, CANDIDATE_BYTES = 32 << 20, 256 << 20
#: Pairs computed again at once.
EXACT_PAIRS = 1 << 17


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def _packed(rows: DataFrame, side: int) -> DataFrame:
    """Blocks of at most ``BLOCK`` vectors of one length: their bytes and their ids (of each
    vector a list, as counts and ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            vectors, refs = b.column("v"), b.column("refs")
            sizes = np.diff(vectors.offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dim)
                for at in range(0, len(own), BLOCK):
                    rows_at = pa.array(own[at:at + BLOCK])
                    v, r = vectors.take(rows_at), refs.take(rows_at)
                    flat = v.flatten().to_numpy(zero_copy_only=False)
                    counts = np.diff(r.offsets.to_numpy()).astype("<i4")
                    ids = r.flatten().to_numpy(zero_copy_only=False).astype("<i8")
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([part * 1_000_003 + seq], pa.int64()),
                        "side": pa.array([side], pa.int32()), "dim": pa.array([dim], pa.int32()),
                        "kind": [flat.dtype.str], "data": pa.array([flat.tobytes()], pa.binary()),
                        "counts": pa.array([counts.tobytes()], pa.binary()),
                        "ids": pa.array([ids.tobytes()], pa.binary())})
                    seq += 1

    return rows.select("v", "refs").mapInArrow(
        run, "block bigint, side int, dim int, kind string, data binary, counts binary, ids binary")


class Quantised:
    """Vectors as int8 with one scale each, and the norms that the error bound needs."""

    def __init__(self, v: np.ndarray) -> None:
        self.scale = np.abs(v).max(axis=1) / 127
        # a scale can underflow where components are subnormal: then all rounds to zero
        safe = np.where(self.scale > 0, self.scale, 1.0)
        self.q = np.rint(v / safe[:, None]).clip(-127, 127).astype(np.int8)
        self.q[self.scale == 0] = 0
        near = self.q * self.scale[:, None]
        self.norm, self.near_norm = np.linalg.norm(v, axis=1), np.linalg.norm(near, axis=1)
        self.error = np.linalg.norm(v - near, axis=1)

    def tile(self, other: Quantised, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of rows lo to hi with all of ``other``, and how far off each may be."""
        total = 0.0
        for d in range(0, self.q.shape[1], SLAB):
            total = total + (self.q[lo:hi, d:d + SLAB].astype(np.float32)
                             @ other.q[:, d:d + SLAB].astype(np.float32).T).astype(np.float64)
        near = total * self.scale[lo:hi, None] * other.scale
        bound = self.norm[lo:hi, None] * other.error + self.error[lo:hi, None] * other.near_norm
        # the bound itself and the double sums are rounded: a slack far above that
        return near, bound + 1e-12 * (self.norm[lo:hi, None] * other.norm) + 1e-300


def exact(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products row by row in double precision, products added in component order."""
    out = np.zeros(len(u))
    for d in range(u.shape[1]):
        out += u[:, d] * v[:, d]
    return out


class Cell:
    """Query vectors of a cell and their heaps of the best (score, -id) so far."""

    def __init__(self, keep: int) -> None:
        self.keep, self.parts, self.q = keep, [], None

    def add(self, v: np.ndarray, refs: np.ndarray) -> None:
        self.parts.append((v, refs))

    def meet(self, v: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        if not self.parts and self.q is None:
            return
        if self.q is None:
            self.vectors = np.concatenate([p[0] for p in self.parts])
            self.refs = np.concatenate([p[1] for p in self.parts])
            self.q, self.heaps = Quantised(self.vectors), [[] for _ in self.refs]
            self.least = np.full(len(self.refs), -np.inf)
            self.parts = []
        own, first = Quantised(v), np.concatenate(([0], np.cumsum(counts)))
        for lo in range(0, len(self.refs), TILE_ROWS):
            hi = min(lo + TILE_ROWS, len(self.refs))
            near, off = self.q.tile(own, lo, hi)
            least = self.least[lo:hi]
            if len(v) >= self.keep:      # so many candidates lie at least this high
                lower = np.partition(near - off, len(v) - self.keep, axis=1)[:, len(v) - self.keep]
                least = np.maximum(least, lower)
            rows, cols = np.nonzero(~(near + off < least[:, None]))     # what overflows stays
            for at in range(0, len(rows), EXACT_PAIRS):
                r, c = rows[at:at + EXACT_PAIRS] + lo, cols[at:at + EXACT_PAIRS]
                scores = exact(self.vectors[r], v[c])
                good = scores >= self.least[r]
                for i, j, score in zip(r[good].tolist(), c[good].tolist(), scores[good].tolist()):
                    heap = self.heaps[i]
                    for x in ids[first[j]:first[j + 1]].tolist():
                        if len(heap) < self.keep:
                            heapq.heappush(heap, (score, -x))
                        elif (score, -x) > heap[0]:
                            heapq.heapreplace(heap, (score, -x))
                    if len(heap) == self.keep:
                        self.least[i] = heap[0][0]

    def results(self) -> Iterator[tuple[int, list]]:
        if self.q is not None:
            yield from ((ref, heap) for ref, heap in zip(self.refs.tolist(), self.heaps) if heap)


def _in_cells(blocks: DataFrame, keep: int) -> DataFrame:
    """Best of each query in each cell.  A cell's query blocks come first, then its candidate
    blocks one at a time, so a task holds the queries of one cell and one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(cell: Cell) -> Iterator[pa.RecordBatch]:
            found = list(cell.results())
            for at in range(0, len(found), 4096):
                part = found[at:at + 4096]
                yield pa.RecordBatch.from_pydict({
                    "q": pa.array([r for r, _ in part], pa.int64()),
                    "score": pa.array([[s for s, _ in h] for _, h in part], pa.list_(pa.float64())),
                    "id": pa.array([[-x for _, x in h] for _, h in part], pa.list_(pa.int64()))})

        at, cell = None, Cell(keep)
        for b in batches:
            for row in b.to_pylist():
                if (row["cell"], row["dim"]) != at:
                    yield from handed(cell)
                    at, cell = (row["cell"], row["dim"]), Cell(keep)
                v = np.frombuffer(row["data"], row["kind"]).reshape(-1, row["dim"]).astype(np.float64)
                ids = np.frombuffer(row["ids"], "<i8")
                if row["side"]:
                    cell.meet(v, np.frombuffer(row["counts"], "<i4"), ids)
                else:
                    cell.add(v, ids)
        yield from handed(cell)

    return blocks.mapInArrow(run, "q bigint, score array<double>, id array<bigint>")


def _merged(found: DataFrame, keep: int) -> DataFrame:
    """A query's heaps of all cells merged into one; nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list] = {}
        for b in batches:
            for q, scores, ids in zip(*(b.column(c).to_pylist() for c in ("q", "score", "id"))):
                heap = heaps.setdefault(q, [])
                for pair in zip(scores, (-x for x in ids)):
                    if len(heap) < keep:
                        heapq.heappush(heap, pair)
                    elif pair > heap[0]:
                        heapq.heapreplace(heap, pair)
        keys = list(heaps)
        for at in range(0, len(keys), 4096):
            best = [sorted(heaps[q], reverse=True) for q in keys[at:at + 4096]]
            yield pa.RecordBatch.from_pydict({
                "q": pa.array(keys[at:at + 4096], pa.int64()),
                "near": pa.array([[{"vec_id": -x, "score": s} for s, x in h] for h in best],
                                 pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())])))})

    return found.repartition("q").mapInArrow(run, "q bigint, near array<struct<vec_id:bigint,score:double>>")


def nearest(vectors: DataFrame, query: Column, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding", query_bytes: int = QUERY_BYTES,
            candidate_bytes: int = CANDIDATE_BYTES) -> DataFrame:
    """The ``k`` rows of largest inner product for each row that ``query`` (a condition on the
    id) holds for: query_id, rank, vec_id, score."""
    spark, keep = vectors.sparkSession, k + 1          # one more, as a query's own row goes
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    v = F.col(f"`{vector_col}`") if kind == "float" else F.col(f"`{vector_col}`").cast("array<double>")
    width = 4 if kind == "float" else 8
    rows = (vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("v"),
                           F.coalesce(query, F.lit(False)).alias("is_query"))
            .where(F.col("id").isNotNull() & _usable(F.col("v")))
            .groupBy("id").agg(F.min("v").alias("v"), F.max("is_query").alias("is_query"))
            .withColumn("h", F.xxhash64("v")))
    rows = staged(rows, "vectors")

    # equal vectors are one candidate; the limit on the rank is applied before the shuffle
    of_vector = Window.partitionBy("h", "v").orderBy("id")
    candidates = (rows.withColumn("at", F.row_number().over(of_vector)).where(F.col("at") <= keep)
                  .groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("refs")))
    candidates = staged(candidates, "candidates")
    queries = staged(rows.where("is_query").select("h", "v").distinct()
                     .withColumn("q", F.monotonically_increasing_id()), "queries")
    size = lambda df: df.agg(F.sum(F.size("v").cast("bigint") * width)).first()[0] or 0
    across = max(1, math.ceil(size(queries) / query_bytes))
    down = max(1, math.ceil(size(candidates) / candidate_bytes),
               math.ceil(2 * spark.sparkContext.defaultParallelism / across))

    asked = _packed(queries.withColumn("refs", F.array("q")), 0)
    asked = asked.withColumn("row", F.pmod(F.xxhash64("block"), F.lit(across)).cast("int")) \
        .withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    given = _packed(candidates, 1)
    given = given.withColumn("col", F.pmod(F.xxhash64("block"), F.lit(down)).cast("int")) \
        .withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    blocks = asked.unionByName(given).withColumn("cell", F.col("row") * down + F.col("col")).drop("row", "col")
    blocks = blocks.repartition(across * down, "cell").sortWithinPartitions("cell", "dim", "side", "block")
    best = _merged(_in_cells(blocks, keep), keep)

    members = rows.where("is_query").select("h", "v", F.col("id").alias("query_id")) \
        .join(queries, ["h", "v"]).select("query_id", "q")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (members.join(best, "q").select("query_id", F.posexplode(others).alias("rank", "found"))
            .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "found.vec_id", "found.score"))
