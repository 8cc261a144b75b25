"""Token-id files: ids of whole texts with Elias-Fano coded document boundaries.

``write`` lays out shards in ascending doc_id order.  A shard is a run of blocks; a block
is one Parquet row whose ``ids`` hold the concatenated token ids (2 bytes each where the
vocabulary allows, else 4) and whose ``bounds`` hold the ends of its documents as an
Elias-Fano sequence with a select directory.  Parquet is the container because it is
written and committed by Spark, so any shared store works and a lost task leaves nothing.

Block layout of ``bounds`` (little endian): u32 documents, u64 ids, u8 low bits; then the
low bits packed, the high bits in unary, and a u32 position for every 64th one.

Offsets need no table of 64-bit numbers: a block's ``base`` counts the ids before it in
its shard, and the shards' totals (one number a shard) give the rest.

Null text is an empty text (its document is the end id alone).  Rows with equal doc_id are
ordered by text; a null doc_id comes first.  An empty table gives no blocks and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder
from .tokens import SPACED, worker_encoder

END_ID = 0
BLOCK_IDS = 1 << 20      # ids of a block, unless one document has more
SAMPLE = 64              # ones between two entries of the select directory
_HEAD = "<IQB"


def _pack(values: np.ndarray, width: int) -> bytes:
    if not width or not len(values):
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


class EliasFano:
    """A non-decreasing sequence below or at ``universe`` in about 2 + log2(u/n) bits each."""

    def __init__(self, data: bytes) -> None:
        self.n, self.universe, self.low = struct.unpack_from(_HEAD, data)
        at = struct.calcsize(_HEAD)
        size = (self.n * self.low + 7) // 8
        self.lows = np.frombuffer(data, np.uint8, size, at)
        at += size
        size = (self.n + (self.universe >> self.low) + 8) // 8
        self.highs = np.frombuffer(data, np.uint8, size, at)
        self.samples = np.frombuffer(data, "<u4", -(-self.n // SAMPLE), at + size)

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> bytes:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        low = max(0, (universe // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        upper = np.zeros((n + (universe >> low) + 8) // 8 * 8, np.uint8)
        upper[ones] = 1
        return (struct.pack(_HEAD, n, universe, low) + _pack(values & np.uint64((1 << low) - 1), low)
                + np.packbits(upper, bitorder="little").tobytes() + ones[::SAMPLE].astype("<u4").tobytes())

    def _lows(self, lo: int, hi: int) -> np.ndarray:
        if not self.low:
            return np.zeros(hi - lo, np.int64)
        first, last = lo * self.low // 8, (hi * self.low + 7) // 8
        bits = np.unpackbits(self.lows[first:last], bitorder="little")[lo * self.low - first * 8:]
        bits = bits[:(hi - lo) * self.low].reshape(-1, self.low).astype(np.int64)
        return (bits << np.arange(self.low)).sum(1)

    def select(self, i: int) -> int:
        """The i-th value: from the nearest directory entry, the next ones are counted."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skip = at // 8, at % 8
        while True:
            ones = np.flatnonzero(np.unpackbits(self.highs[byte:byte + 64], bitorder="little"))
            ones = ones[ones >= skip]
            if len(ones) > left:
                high = byte * 8 + int(ones[left]) - i
                return (high << self.low) | int(self._lows(i, i + 1)[0])
            left, byte, skip = left - len(ones), byte + 64, 0

    def selected(self, lo: int, hi: int) -> np.ndarray:
        """The values lo to hi - 1: the select of all values of a directory entry at a time."""
        if not 0 <= lo <= hi <= self.n:
            raise IndexError((lo, hi))
        out = [np.zeros(0, np.int64)]
        for entry in range(lo // SAMPLE, -(-hi // SAMPLE)):
            first, last = entry * SAMPLE, min((entry + 1) * SAMPLE, self.n)
            at = int(self.samples[entry])
            stop = int(self.samples[entry + 1]) if last < self.n else len(self.highs) * 8
            byte = at // 8
            ones = np.flatnonzero(np.unpackbits(self.highs[byte:(stop + 7) // 8], bitorder="little")) + byte * 8
            ones = ones[ones >= at][:last - first]
            own = ((ones - np.arange(first, last)) << self.low) | self._lows(first, last)
            out.append(own[max(lo - first, 0):hi - first])
        return np.concatenate(out)

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[:self.n]
        return ((ones - np.arange(self.n)) << self.low) | self._lows(0, self.n)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
          block_ids: int = BLOCK_IDS) -> None:
    """Write the token files of ``docs`` (doc_id, text) below ``path``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = worker_encoder(tokenizer, SPACED)
        width = "<u2" if encoder.whole.get_vocab_size() <= 1 << 16 else "<u4"
        end = struct.pack("<I", end_id)
        shard, seq, base = TaskContext.get().partitionId(), 0, 0
        keys, ids, ends, held = [], [], [], 0

        def block() -> pd.DataFrame:
            return pd.DataFrame([{
                "shard": shard, "seq": seq, "base": base, "n_ids": held, "doc_ids": keys,
                "width": int(width[-1]), "bounds": EliasFano.encode(np.array(ends), held),
                "ids": np.frombuffer(b"".join(ids), "<u4").astype(width).tobytes()}])

        for b in batches:
            for key, text in zip(b["doc_id"].astype(object).where(b["doc_id"].notna(), None), b["text"]):
                own = (encoder.ids(text) if isinstance(text, str) else b"") + end
                keys.append(key)
                ids.append(own)
                held += len(own) // 4
                ends.append(held)
                if held >= block_ids:
                    yield block()
                    seq, base = seq + 1, base + held
                    keys, ids, ends, held = [], [], [], 0
        if keys:
            yield block()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (ordered.mapInPandas(run, f"shard int, seq int, base bigint, n_ids bigint, doc_ids array<{kind}>, width int, "
                              "bounds binary, ids binary")
     .write.option("compression", "zstd").parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, and where it
    lies (shard, seq)."""
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # a row per shard
    before, firsts = 0, []
    for row in totals:
        firsts.append((row["shard"], before))
        before += row["n"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples(index=False):
                bounds = EliasFano(row.bounds)
                ends = bounds.selected(0, bounds.n)
                starts = np.concatenate(([0], ends[:-1]))
                ids = np.frombuffer(row.ids, "<u2" if row.width == 2 else "<u4").astype("<u4")
                yield pd.DataFrame({
                    "doc_id": pd.Series(list(row.doc_ids), dtype="Int64" if kind in ("bigint", "int") else object),
                    "at": starts + row.base, "n_tokens": ends - starts,
                    "ids_crc32": [zlib.crc32(ids[a:z]) for a, z in zip(starts.tolist(), ends.tolist())],
                    "shard": row.shard, "seq": row.seq})

    rows = blocks.select("shard", "seq", "base", "width", "doc_ids", "bounds", "ids").mapInPandas(
        run, f"doc_id {kind}, at bigint, n_tokens bigint, ids_crc32 bigint, shard int, seq int")
    bases = spark.createDataFrame(firsts, "shard int, first bigint")
    return rows.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "shard", "seq")


def written(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files into the shared folder and read them back."""
    path = f"{shared_folder(docs.sparkSession)}/token-files"
    write(docs, path, tokenizer)
    return read(docs.sparkSession, path)
