"""Index of stored keys: sorted runs with fences, read only where a batch's keys can be.

Every micro-batch adds its new keys as one run: Parquet files sorted by key, each with a
Bloom filter on the key and at most ``keys_per_file`` keys, and a fence (lowest and highest
key) per file.  A version file names the live runs; a new version is claimed with
``put_if_absent``, so a reader sees a run whole or not at all.  Runs of a level are merged
into one of the next when there are more than ``fan_out`` of them: the live runs stay
``fan_out`` times the logarithm of the history.

A lookup picks files by their fences: a batch of m keys opens at most m files of a run,
however many the run has, and none where keys are in time order and the batch is new.  Up to
``LOOKUP_KEYS`` keys are pushed into the scan as well, where Bloom filters and page statistics
skip what holds none of them.  Larger batches (backfills) join the files that overlap them.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txwatch.sinks.claims import hadoop, names, put_if_absent, text_of

#: Keys of a batch that are compared with fences one by one and filter the scan.
LOOKUP_KEYS = 10_000
#: Of these, keys pushed down one by one; more are pushed as their range.  Parquet nests one
#: level per key, and some thousand levels overflow a task's stack.
PUSH_KEYS = 256
PUSH_DOWN = "spark.sql.parquet.pushdown.inFilterThreshold"


@dataclass(frozen=True)
class Fence:
    """One file of a run: its lowest and highest key and its rows."""
    file: str
    lo: str
    hi: str
    n: int


class KeyIndex:
    """The index below ``root``: rows of ``schema``, whose first column is the key (text)."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType,
                 keys_per_file: int = 4_000_000, fan_out: int = 8) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.key, self.keys_per_file, self.fan_out = schema.fieldNames()[0], keys_per_file, fan_out

    # ---- versions -----------------------------------------------------------------------

    def _live(self) -> tuple[int, dict[str, list[dict]]]:
        """The newest version and its runs, each a list of fences."""
        for name in reversed(names(self.spark, f"{self.root}/versions")):
            text = text_of(self.spark, f"{self.root}/versions/{name}")
            if text.endswith("\n"):               # else its writer stopped half-way
                return int(name), json.loads(text)
        return 0, {}

    def _publish(self, version: int, runs: dict[str, list[dict]]) -> None:
        number = version + 1
        while not put_if_absent(self.spark, f"{self.root}/versions/{number:012d}", json.dumps(runs) + "\n"):
            now, others = self._live()
            if now != version and now >= number:
                raise RuntimeError(f"{self.root}: another writer published version {now}; an index has one writer")
            number += 1                           # a version cut short by a crash

    def runs(self) -> dict[str, list[Fence]]:
        return {name: [Fence(**f) for f in fences] for name, fences in self._live()[1].items()}

    # ---- lookup -------------------------------------------------------------------------

    def files_for(self, keys: list[str]) -> list[str]:
        """The files whose fences enclose one of the sorted ``keys``."""
        found = []
        for name, fences in self.runs().items():
            for f in fences:
                at = bisect_left(keys, f.lo)
                if at < len(keys) and keys[at] <= f.hi:
                    found.append(f"{self.root}/{name}/{f.file}")
        return found

    def is_empty(self) -> bool:
        return not self._live()[1]

    def _nothing(self) -> DataFrame:
        """No rows, as the optimizer can see: a join with them is no join."""
        return self.spark.createDataFrame([], self.schema).limit(0)

    def known(self, batch: DataFrame) -> DataFrame:
        """Stored rows that ``batch``'s keys can match (and maybe others): each once."""
        runs = self.runs()
        if not runs:
            return self._nothing()
        keys = batch.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        own = [r[0] for r in keys.limit(LOOKUP_KEYS + 1).collect()]
        few = len(own) <= LOOKUP_KEYS
        if few:
            own.sort(key=lambda k: k.encode())
            files = self.files_for(own)
        else:
            lo, hi = batch.agg(F.min(self.key), F.max(self.key)).first()
            files = [f"{self.root}/{name}/{f.file}" for name, fences in runs.items()
                     for f in fences if f.lo <= hi and f.hi >= lo]
        if not files:
            return self._nothing()
        stored = self.spark.read.schema(self.schema).parquet(*files)
        if few:
            if int(self.spark.conf.get(PUSH_DOWN, "10")) < PUSH_KEYS:
                self.spark.conf.set(PUSH_DOWN, str(PUSH_KEYS))
            stored = stored.where(F.col(self.key).isin(own))
        return stored.distinct()

    # ---- adding and merging -------------------------------------------------------------

    def _write(self, rows: DataFrame, name: str, n: int) -> list[dict]:
        """Rows as sorted files of a run, and their fences."""
        path, files = f"{self.root}/{name}", max(1, -(-n // self.keys_per_file))
        rows = rows.repartitionByRange(files, self.key) if files > 1 else rows.coalesce(1)
        (rows.sortWithinPartitions(self.key).write.mode("overwrite")
         .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
         .option(f"parquet.bloom.filter.expected.ndv#{self.key}", str(min(n, self.keys_per_file)))
         .parquet(path))
        # a file's fence is its first and its last row
        own = self.spark.read.schema(self.schema).parquet(path).select(
            F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), self.key)
        sizes = own.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
        ends = (own.join(F.broadcast(sizes), "file").where((F.col("at") == 0) | (F.col("at") == F.col("n") - 1))
                .collect())
        fences = {}
        for r in sorted(ends, key=lambda r: r["at"]):
            fences.setdefault(r["file"], {"file": r["file"], "lo": r[self.key]}).update(hi=r[self.key], n=r["n"])
        return sorted(fences.values(), key=lambda f: f["lo"].encode())

    def add(self, rows: DataFrame, n: int | None = None) -> None:
        """New keys as one run.  Keys that are there already (a retried batch) do no harm."""
        rows = rows.select(*self.schema.fieldNames())
        n = rows.count() if n is None else n
        if not n:
            return
        version, runs = self._live()
        name = f"run-0-{uuid.uuid4().hex}"
        runs[name] = self._write(rows, name, n)
        self._publish(version, runs)
        self.merge()

    def merge(self) -> None:
        """Merge the runs of a level with more than ``fan_out`` of them into one of the next."""
        level = 0
        while True:
            version, runs = self._live()
            own = [r for r in runs if r.split("-")[1] == str(level)]
            if not own:
                return
            if len(own) > self.fan_out:
                rows = self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{r}" for r in own]).distinct()
                name = f"run-{level + 1}-{uuid.uuid4().hex}"
                fences = self._write(rows, name, sum(f["n"] for r in own for f in runs[r]))
                self._publish(version, {**{r: f for r, f in runs.items() if r not in own}, name: fences})
                self._forget(own, version)
            level += 1

    def _forget(self, merged: list[str], version: int) -> None:
        """Delete runs that the newest version no longer names, and older versions."""
        for name in merged:
            target, fs = hadoop(self.spark, f"{self.root}/{name}")
            fs.delete(target, True)
        for name in names(self.spark, f"{self.root}/versions"):
            if int(name) < version:
                target, fs = hadoop(self.spark, f"{self.root}/versions/{name}")
                fs.delete(target, False)
