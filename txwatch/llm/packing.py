"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm.

Pieces of equal length are interchangeable, so a packing problem of any size is a
histogram over at most ``capacity`` lengths, and a solution is a set of bin patterns with
multiplicities.  Both stay small however many documents there are:

1. Texts are tokenized, cut into pieces and staged with their rank among the pieces of
   their length (counted inside each partition; partition totals give the rest).
2. Islands (Spark tasks) evolve solutions of the histogram.  Crossover injects whole
   well-filled bins of one parent into the other; bins of the other that would use a piece
   twice are dissolved; displaced pieces are put back best fit, longest first.  After each
   epoch the best solution of an island migrates to the next island.
3. The best solution's patterns become slots (length, rank range, sequence, offset), and
   each piece looks up its slot by length and rank.  No group of documents is gathered.

Null text: the end id alone.  Repeated rows are packed each.  Empty table: no rows.
"""

from __future__ import annotations

import pickle
import random
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged
from .tokens import BARE, worker_encoder

CAPACITY = 2048
END_ID = 0
HELD_CHUNKS = 600_000      # chunks that a Python worker holds; an executor has several workers
ISLANDS = 4
EPOCHS = 2
GENERATIONS = 4
POPULATION = 5

Solution = dict[tuple[int, ...], int]   # lengths in a bin, longest first -> how many such bins


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, part, rank)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer, BARE, HELD_CHUNKS)
        end, part, seen = struct.pack("<I", end_id), TaskContext.get().partitionId(), Counter()
        for b in batches:
            if not b.num_rows:
                continue
            keys, texts = b.columns
            rows = []
            for at_row, text in enumerate(texts):         # one text at a time leaves Arrow's memory
                ids = (encoder.ids(text.as_py()) if text.is_valid else b"") + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    size = len(own) // 4
                    rows.append((at_row, n, at // 4, size, zlib.crc32(own), seen[size]))
                    seen[size] += 1
            at_row, piece, start, length, crc, rank = (np.array(x, np.int64) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(at_row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                 pa.array(crc), pa.array(np.full(len(rank), part, np.int32)), pa.array(rank)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint")


def best_fit(kept: Solution, left: dict[int, int], capacity: int) -> Solution:
    """``kept`` bins plus the ``left`` pieces, longest first, each into the fullest bin that
    takes it; equal bins and equal pieces move together."""
    done: Counter = Counter()
    rooms: dict[int, Counter] = {}
    bits = 0

    def put(bin_: tuple[int, ...], count: int) -> None:
        nonlocal bits
        room = capacity - sum(bin_)
        if room:
            rooms.setdefault(room, Counter())[bin_] += count
            bits |= 1 << room
        else:
            done[bin_] += count

    for bin_, count in kept.items():
        put(bin_, count)
    for size in sorted(left, reverse=True):
        count = left[size]
        while count:
            fits = bits >> size
            if not fits:
                each = capacity // size
                full, rest = divmod(count, each)
                if full:
                    put((size,) * each, full)
                if rest:
                    put((size,) * rest, 1)
                break
            room = size + (fits & -fits).bit_length() - 1
            held = rooms[room]
            bin_, many = held.popitem()
            moved = min(many, count)
            if moved < many:
                held[bin_] = many - moved
            elif not held:
                del rooms[room]
                bits &= ~(1 << room)
            put((*bin_, size) if size <= bin_[-1] else tuple(sorted((*bin_, size), reverse=True)), moved)
            count -= moved
    for held in rooms.values():
        done.update(held)
    return dict(done)


def _fit(solution: Solution, capacity: int) -> tuple[int, float]:
    """Bins, then (as in grouping genetic algorithms) how unevenly they are filled."""
    return (sum(solution.values()), -sum(m * (sum(b) / capacity) ** 2 for b, m in solution.items()))


def _keep(bins: list[tuple[tuple[int, ...], int]], left: dict[int, int]) -> Solution:
    """As many of the bins, in this order, as the pieces left allow; takes them from left."""
    kept: Solution = {}
    for bin_, many in bins:
        need = Counter(bin_)
        many = min(many, *(left.get(size, 0) // n for size, n in need.items()))
        if many > 0:
            kept[bin_] = kept.get(bin_, 0) + many
            for size, n in need.items():
                left[size] -= n * many
    return kept


def crossover(one: Solution, other: Solution, histogram: dict[int, int], capacity: int, rng: random.Random) -> Solution:
    """A child: well-filled bins of ``other``, the bins of ``one`` that use no piece twice,
    the displaced pieces best fit."""
    left = dict(histogram)
    filled = [(b, m) for b, m in other.items() if sum(b) * 50 >= capacity * 49]
    injected = [(b, rng.randint(1, m)) for b, m in filled if rng.random() < 0.5]
    child = _keep(injected, left)
    for bin_, many in _keep(sorted(one.items(), key=lambda x: -sum(x[0])), left).items():
        child[bin_] = child.get(bin_, 0) + many
    return best_fit(child, {s: n for s, n in left.items() if n}, capacity)


def mutated(one: Solution, histogram: dict[int, int], capacity: int, rng: random.Random) -> Solution:
    """Dissolves the worst-filled bins and some others, and puts their pieces back."""
    left = dict(histogram)
    bins = [(b, m) for b, m in sorted(one.items(), key=lambda x: -sum(x[0]))
            if sum(b) * 100 >= capacity * 97 and rng.random() > 0.05]
    return best_fit(_keep(bins, left), {s: n for s, n in left.items() if n}, capacity)


def _evolve(population: list[Solution], histogram: dict[int, int], capacity: int, seed: int,
            generations: int, size: int) -> list[Solution]:
    rng = random.Random(seed)
    total = sum(s * n for s, n in histogram.items())
    bound = -(-total // capacity)
    while len(population) < size:
        if not population:
            population.append(best_fit({}, dict(histogram), capacity))
        else:
            population.append(mutated(population[0], histogram, capacity, rng))
    for _ in range(generations):
        population.sort(key=lambda s: _fit(s, capacity))
        if sum(population[0].values()) <= bound:
            break
        one, other = population[0], rng.choice(population[1:])
        children = [crossover(one, other, histogram, capacity, rng), crossover(other, one, histogram, capacity, rng),
                    mutated(rng.choice(population), histogram, capacity, rng)]
        population = sorted(population + children, key=lambda s: _fit(s, capacity))[:size]
    return population


def solve(spark: SparkSession, histogram: dict[int, int], capacity: int = CAPACITY, islands: int = ISLANDS,
          epochs: int = EPOCHS, generations: int = GENERATIONS, size: int = POPULATION) -> Solution:
    """The best packing that the islands find; all they exchange is bounded by the number
    of different lengths."""
    if not histogram:
        return {}
    populations: list[list[Solution]] = [[] for _ in range(islands)]
    for epoch in range(epochs):
        rows = [(i, pickle.dumps((populations[i], histogram))) for i in range(islands)]

        def run(batches: Iterator[pd.DataFrame], epoch: int = epoch) -> Iterator[pd.DataFrame]:
            for b in batches:
                for row in b.itertuples(index=False):
                    population, counts = pickle.loads(row.state)
                    best = _evolve(population, counts, capacity, 1000 * epoch + row.island, generations, size)
                    yield pd.DataFrame({"island": [row.island], "state": [pickle.dumps(best[:2])]})

        frame = spark.createDataFrame(rows, "island int, state binary").repartition(islands)
        found = {r["island"]: pickle.loads(r["state"]) for r in frame.mapInPandas(run, frame.schema).collect()}
        populations = [found[i] + [found[(i - 1) % islands][0]] for i in range(islands)]
        best = min((p[0] for p in populations), key=lambda s: _fit(s, capacity))
        if sum(best.values()) <= -(-sum(s * n for s, n in histogram.items()) // capacity):
            break
    return best


def _slots(solution: Solution) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first rank, first sequence and offset of each run of slots."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for bin_, many in sorted(solution.items()):
        offset = 0
        for size in bin_:
            runs.setdefault(size, []).append((used[size], sequence, offset))
            used[size] += many
            offset += size
        sequence += many
    return {size: tuple(np.array(x, np.int64) for x in zip(*own)) for size, own in runs.items()}


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, **search) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    own = staged(pieces(docs, tokenizer, capacity), "pieces")
    parts = own.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in own.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(solve(spark, histogram, capacity, **search)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sequence, offset = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            rank = (b["rank"] + b["before"]).to_numpy()
            for size, at in b.groupby("length").indices.items():
                first, number, place = slots.value[int(size)]
                run_ = np.searchsorted(first, rank[at], "right") - 1
                sequence[at] = number[run_] + rank[at] - first[run_]
                offset[at] = place[run_]
            yield b.drop(columns=["part", "rank", "before"]).assign(sequence_id=sequence, offset=offset)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return own.join(bases, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", "part", "rank", "before").mapInPandas(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
