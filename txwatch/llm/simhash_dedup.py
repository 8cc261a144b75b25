"""SimHash near-dedup: 64-bit fingerprints linked within a Hamming radius, exactly.

Fingerprints: 4-word shingles (repeats included) hashed with XXH64 (seed 42); a bit is
set if it is set in over half of the hashes.  Equal fingerprints collapse to one row each
before anything is compared, so groups of copies cost nothing.

Links come from vantage-point trees over shards:

* The top of the tree is shared by all fingerprints.  It measures the Hamming distance on
  ``take`` of ``blocks`` bit blocks only, and its balls have radius 0: a shard holds the
  fingerprints that agree on the chosen blocks.  Two fingerprints that differ in at most
  ``radius`` bits agree on at least ``blocks - radius`` blocks, so with
  ``take <= blocks - radius`` every linked pair shares a shard; shards overlap, and
  nothing is lost at their boundaries.
* A shard larger than ``SHARD_ROWS`` is split further as a vantage-point node, before it
  reaches a task: a vantage point and the median distance cut it into an inner and an
  outer part, and the fingerprints within ``radius`` beyond the cut go to both.
* Inside a task each shard is a vantage-point tree: branches are pruned by the triangle
  bound.  A leaf grows its components breadth first: a point is compared only with those
  that no component has reached yet, so a dense group costs one pass, not all its pairs.

A task emits only a spanning forest of its shard's links (never all pairs of a group);
connected components follow by min-label propagation with pointer jumping over staged
tables, no links or labels ever reach the driver.

Null and blank texts have no words: fingerprint zero, linked like any other.  Repeated
rows share a component.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, staged, whole_row

SHINGLE_WORDS = 4
RADIUS = 4
BLOCKS = 6           # 64 bits as 10 or 11 bits each
TAKE = 2             # blocks that have to agree: BLOCKS - RADIUS
LEAF = 1024          # fingerprints of a tree's leaf
SHARD_ROWS = 200_000  # beyond it a shard is split by a vantage point before it is a task's

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of one text."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())]
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[at:at + (1 << 14)], dtype="<u8")
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, fp): fingerprints as signed longs, one row per input row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t if isinstance(t, str) else None, size) for t in b["text"]], dtype="<u8")
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fp.view("<i8")})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, fp bigint")


def _grow(points: np.ndarray, at: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links among ``points[at]``, breadth first."""
    while len(at):
        front, at = [int(at[0])], at[1:]
        while front and len(at):
            x = front.pop()
            near = np.bitwise_count(points[at] ^ points[x]) <= radius
            if near.any():
                new, at = at[near], at[~near]
                front.extend(new.tolist())
                yield np.full(len(new), x), new


def forest(points: np.ndarray, radius: int = RADIUS, leaf: int = LEAF) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (pairs of positions) that connect what the links among ``points`` connect.

    A vantage-point tree, walked without recursion.  ``inner`` holds the boundary band
    too, so every pair within the radius stays together in one branch.
    """
    stack = [np.arange(len(points))]
    while stack:
        at = stack.pop()
        if len(at) > leaf:
            far = np.bitwise_count(points[at] ^ points[at[0]]).astype(np.int16)
            cut = int(np.median(far))
            inner, outer = at[far <= cut + radius], at[far > cut]
            if 4 * len(inner) <= 3 * len(at):
                stack += [inner, outer]
                continue
        yield from _grow(points, at, radius)  # a leaf, or a crowd that the bound can't prune


def _shard_keys(fp, blocks: int, take: int):
    """One key per choice of blocks: the choice's number and the bits of its blocks."""
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), take)):
        mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in chosen)
        mask -= (mask >> 63) << 64  # as a signed long
        keys.append(F.xxhash64(F.lit(n), fp.bitwiseAND(F.lit(mask))))
    return F.array(*keys)


def _split_large(shards: DataFrame, radius: int, limit: int, rounds: int = 12) -> DataFrame:
    """Vantage-point nodes above the tasks: cut shards of over ``limit`` rows in two, the
    boundary band going to both, until they fit or a cut no longer makes them smaller."""
    small = None
    for _ in range(rounds):
        sizes = shards.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("v"))
        large = staged(sizes.where(F.col("n") > limit), "large")
        if large.isEmpty():
            break
        far = F.bit_count(F.col("fp").bitwiseXOR(F.col("v")))
        # at most rows / limit shards are large, one small row each; Spark picks the join
        own = shards.join(large, "shard").withColumn("far", far)
        cuts = own.groupBy("shard").agg(F.percentile_approx("far", 0.5).alias("cut"))
        parts = staged(own.join(cuts, "shard").select("shard", "fp", "n", F.explode(F.array_compact(F.array(
            F.when(F.col("far") <= F.col("cut") + radius, F.lit(0)),
            F.when(F.col("far") > F.col("cut"), F.lit(1))))).alias("side")), "parts")
        after = parts.groupBy("shard", "n").agg(F.max("side").alias("sides"), F.sum(1 - F.col("side")).alias("inner"))
        stuck = after.where((F.col("sides") == 0) | (F.col("inner") * 4 > F.col("n") * 3)).select("shard")
        done = shards.join(large.select("shard"), "shard", "left_anti").unionByName(
            shards.join(stuck, "shard", "left_semi"))
        small = done if small is None else small.unionByName(done)
        shards = staged(parts.join(stuck, "shard", "left_anti").select(
            F.xxhash64("shard", "side").alias("shard"), "fp"), "shards")
    return shards if small is None else small.unionByName(shards)


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, take: int = TAKE,
          leaf: int = LEAF, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Rows (a, b), a < b, of distinct fingerprints ``fps`` (column fp): linked pairs that
    connect everything that pairs within ``radius`` connect."""
    if take > blocks - radius:
        raise ValueError("a linked pair agrees on blocks - radius blocks; take no more")
    shards = staged(fps.select("fp", F.explode(_shard_keys(F.col("fp"), blocks, take)).alias("shard")), "shards")
    shards = _split_large(shards, radius, shard_rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def solve(df: pd.DataFrame) -> pd.DataFrame:
            shard, fp = df["shard"].to_numpy(), df["fp"].to_numpy().view("<u8")
            starts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(shard)])))
            left, right = [], []
            small = np.repeat(sizes <= 6, sizes)
            for lag in range(1, 6):  # small shards, all at once
                same = small[lag:] & (shard[lag:] == shard[:-lag]) & (np.bitwise_count(fp[lag:] ^ fp[:-lag]) <= radius)
                at = np.flatnonzero(same)
                left.append(fp[at])
                right.append(fp[at + lag])
            for k in np.flatnonzero(sizes > 6).tolist():
                own = fp[starts[k]:starts[k] + sizes[k]]
                for x, y in forest(own, radius, leaf):
                    left.append(own[x])
                    right.append(own[y])
            a, b = np.concatenate(left).view("<i8"), np.concatenate(right).view("<i8")
            return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

        for batch in batches:
            if not len(batch):
                continue
            last = batch["shard"].iloc[-1]
            ended = int(np.searchsorted((batch["shard"] == last).to_numpy(), True))
            if ended or held and held[-1]["shard"].iloc[-1] != last:
                yield solve(pd.concat([*held, batch.iloc[:ended]]))
                held = []
            held.append(batch.iloc[ended:])
        if held:
            yield solve(pd.concat(held))

    return (shards.repartition("shard").sortWithinPartitions("shard")
            .mapInPandas(run, "a bigint, b bigint").distinct())


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, label): each node of ``edges`` (a, b) but the least of its component, with that one.

    Large-star and small-star steps in turn; each round's edges are a staged table.  The
    rounds end when a round changes nothing (count and hash of the edges).
    """
    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b").distinct()
        # small star: each node b hands its smaller neighbours and itself to the least one
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(least, "b")
        small = (joined.where(F.col("a") != F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b"))
                 .unionByName(least.select(F.col("m").alias("a"), "b")).distinct())
        edges = staged(small, "edges")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))


def grouped(docs: DataFrame, size: int = SHINGLE_WORDS, radius: int = RADIUS, **tree) -> DataFrame:
    """Rows (doc_id, fp, component_id), one per row of ``docs``.

    ``component_id`` is the least doc_id of all documents that links reach (null only if
    all of them are null).
    """
    own = staged(fingerprints(docs, size), "fingerprints")
    fps = staged(own.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    labels = components(links(fps.select("fp"), radius, **tree))
    named = fps.join(labels, fps["fp"] == labels["node"], "left").select(
        "fp", "rep", F.coalesce("label", "fp").alias("label"))
    named = staged(named, "named")
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    return own.join(named.join(least, "label").select("fp", "component_id"), "fp")


def deduplicated(docs: DataFrame, size: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the least
    doc_id, and of repeated rows with that id one (the least by all columns' hash)."""
    stay = grouped(docs, size, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = stay.groupBy("doc_id").agg(F.count(F.lit(1)).alias("s_rows")).withColumnRenamed("doc_id", "s_doc")
    rows = docs.select(whole_row(docs).alias("s_whole"), F.col("doc_id").alias("s_id"))
    kept = rows.join(stay, F.col("s_id").eqNullSafe(F.col("s_doc")))
    once = kept.where("s_rows = 1").select("s_whole")
    # repeated rows of one id: the least by its text's and source columns' hash
    more = kept.where("s_rows > 1").groupBy("s_doc").agg(
        F.min_by("s_whole", F.xxhash64("s_whole")).alias("s_whole")).select("s_whole")
    return once.unionByName(more).select("s_whole.*")
