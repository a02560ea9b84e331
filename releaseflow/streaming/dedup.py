"""First deliveries across micro-batches, without dropping late ones.

A batch keeps the rows whose key no earlier batch holds, however late they come;
rows behind the newest bus time of earlier batches by more than the watermark are
marked ``is_late``. The keys seen so far are an index of three parts below ``path``:

* ``recent/batch_id=N``: the keys of the last batches, one small file each. Every batch
  reads them all; ``MERGE_BATCHES`` of them become a run;
* ``runs/run=L-A-B/slot=S``: keys of batches A to B, in slots by a hash of the key.
  ``MERGE_RUNS`` runs of level L become one of level L + 1, so their number grows with
  the logarithm of the batches;
* ``filter``: a Bloom filter of the keys in the runs, ``BLOCKS`` bitmaps of 32,768 bits. A key sets ``PROBES``
  bits of the one bitmap that its hash names.

A batch's keys are held against the filter first. Only slots of keys with all bits set are
read from the runs; with about ten bits a key that is one new key in a hundred, and a filter too
small for its keys costs reads, never rows. So a batch reads a number of files and bytes that
doesn't follow the batches before it.

A replayed batch ignores its own entries and finds the same rows again: runs are made of batches before it, are
used only once complete, and what they replace is removed after that. The key decides the slot, so
a re-delivery is found whatever else of the event has changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from releaseflow.session import delete_path, partition_values, path_exists
from releaseflow.sources.versions import VersionedBuckets

SLOTS, BLOCKS, PROBES = 64, 2048, 5
MERGE_BATCHES, MERGE_RUNS = 32, 8
_BITS = 1 << 15


@dataclass
class SeenEvents:
    spark: SparkSession
    path: str
    key: str
    watermark: str
    merge_batches: int = MERGE_BATCHES
    merge_runs: int = MERGE_RUNS

    def __post_init__(self):
        self.filter = VersionedBuckets(self.spark, f"{self.path}/filter")
        self.marks = VersionedBuckets(self.spark, f"{self.path}/marks")

    # -- the parts of the index -------------------------------------------------------------------
    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(SLOTS)).cast("int")

    def _block(self) -> Column:
        return F.pmod(F.xxhash64(self.key, F.lit(0)), F.lit(BLOCKS)).cast("int")

    def _bit(self, probe: int) -> Column:
        return F.pmod(F.xxhash64(self.key, F.lit(probe)), F.lit(_BITS))

    def _runs(self, before_batch: int) -> list[tuple[int, int, int]]:
        """Complete runs ``(level, first batch, last batch)`` that no larger run holds."""
        names = partition_values(self.spark, f"{self.path}/runs", "run")
        runs = sorted((tuple(map(int, n.split("-"))) for n in names), key=lambda r: (-r[0], r[1]))
        out: list[tuple[int, int, int]] = []
        for r in runs:
            held = any(o[1] <= r[1] and r[2] <= o[2] for o in out)
            if r[2] < before_batch and not held and path_exists(self.spark, f"{self._run_path(r)}/_SUCCESS"):
                out.append(r)
        return out

    def _run_path(self, run: tuple[int, int, int]) -> str:
        return f"{self.path}/runs/run={'-'.join(map(str, run))}"

    def _recent(self, before_batch: int, runs: list[tuple[int, int, int]]) -> list[int]:
        done = max((r[2] for r in runs), default=-1)
        ids = (int(b) for b in partition_values(self.spark, f"{self.path}/recent", "batch_id"))
        return sorted(b for b in ids if done < b < before_batch)

    def _keys(self, paths: list[str]) -> DataFrame | None:
        return self.spark.read.schema(f"{self.key} string").parquet(*paths) if paths else None

    def _recent_keys(self, batches: list[int]) -> DataFrame | None:
        return self._keys([f"{self.path}/recent/batch_id={b}" for b in batches])

    def _slot_paths(self, run: tuple[int, int, int], slots: set[str]) -> list[str]:
        have = partition_values(self.spark, self._run_path(run), "slot") & slots
        return [f"{self._run_path(run)}/slot={s}" for s in sorted(have)]

    # -- a batch --------------------------------------------------------------------------------------
    def fresh(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows of first deliveries, with ``is_late``. ``batch`` is read several times: persist it first."""
        first = Window.partitionBy(self.key).orderBy("kafka_ts", "partition", "offset")
        rows = batch.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
        runs = self._runs(batch_id)
        known = [self._recent_keys(self._recent(batch_id, runs))]
        covered = self.filter.newest(0, batch_id)
        for run in runs:
            if covered is None or run[2] > covered:  # written, but not in the filter yet
                known.append(self._keys(self._slot_paths(run, {str(s) for s in range(SLOTS)})))
        old = [r for r in runs if covered is not None and r[2] <= covered]
        if old:
            slots = {str(r[0]) for r in self._suspects(batch, batch_id).select(self._slot()).distinct().collect()}
            known.append(self._keys([p for r in old for p in self._slot_paths(r, slots)]))
        for keys in known:
            if keys is not None:
                rows = rows.join(keys, self.key, "left_anti")
        newest = self._newest(batch_id)
        late = F.lit(False) if newest is None else F.coalesce(
            F.col("kafka_ts") < F.lit(newest) - F.expr(f"INTERVAL {self.watermark}"), F.lit(False))
        return rows.withColumn("is_late", late)

    def _suspects(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Keys of the batch whose bits are all set in the filter."""
        asked = batch.select(self.key).distinct().withColumn("block", self._block())
        for k in range(1, PROBES + 1):
            asked = asked.withColumn(f"_p{k}", self._bit(k))
        maps = self.filter.read([0], batch_id).select("block", "bits")
        hits = asked.join(maps, "block")
        for k in range(1, PROBES + 1):
            byte = F.conv(F.hex(F.substring("bits", (F.expr(f"_p{k} div 8") + 1).cast("int"), F.lit(1))), 16, 10)
            hits = hits.filter(F.getbit(byte.cast("int"), (F.col(f"_p{k}") % 8).cast("int")) == 1)
        return hits.select(self.key)

    def _newest(self, batch_id: int):
        mark = self.marks.read([0], batch_id)
        return mark.first()["newest"] if mark is not None else None

    def commit(self, fresh: DataFrame, batch_id: int) -> None:
        """Record the batch's keys and the newest bus time so far; merge older parts when they are many."""
        self._merge(batch_id)
        (fresh.select(self.key).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/recent/batch_id={batch_id}"))
        newest = self._newest(batch_id)
        mark = fresh.agg(F.greatest(F.max("kafka_ts"), F.lit(newest).cast("timestamp")).alias("newest"))
        self.marks.write(mark.withColumn("bucket", F.lit(0)), [0], batch_id)

    # -- merging ----------------------------------------------------------------------------------------
    def _merge(self, batch_id: int) -> None:
        runs = self._runs(batch_id)
        recent = self._recent(batch_id, runs)
        if len(recent) >= self.merge_batches:
            run = (1, recent[0], recent[-1])
            self._write_run(run, self._recent_keys(recent))
            runs.append(run)
        level = 1
        while True:
            same = sorted(r for r in runs if r[0] == level)
            if len(same) < self.merge_runs:
                break
            run = (level + 1, same[0][1], same[-1][2])
            self._write_run(run, self._keys([p for r in same for p in self._slot_paths(r, {str(s) for s in range(SLOTS)})]))
            runs = [r for r in runs if r[0] != level] + [run]
            level += 1
        self._extend_filter(batch_id, runs)
        self._sweep(batch_id, runs)

    def _write_run(self, run: tuple[int, int, int], keys: DataFrame) -> None:
        (keys.withColumn("slot", self._slot()).repartition("slot")
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("slot").parquet(self._run_path(run)))

    def _extend_filter(self, batch_id: int, runs: list[tuple[int, int, int]]) -> None:
        """Set the bits of runs that the filter doesn't hold."""
        covered = self.filter.newest(0, batch_id)
        new = [r for r in runs if covered is None or r[2] > covered]
        if not new:
            return
        every = {str(s) for s in range(SLOTS)}
        keys = self._keys([p for r in new for p in self._slot_paths(r, every)])
        bits = keys.select(self._block().alias("block"), F.explode(F.array(
            *(self._bit(k) for k in range(1, PROBES + 1)))).alias("bit"))
        maps = bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
        before = self.filter.read([0], batch_id)
        if before is not None:
            maps = maps.unionByName(before.select("block", "bits"))
        maps = maps.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
        self.filter.write(maps.withColumn("bucket", F.lit(0)), [0], max(r[2] for r in new))

    def _sweep(self, batch_id: int, runs: list[tuple[int, int, int]]) -> None:
        """Remove parts that a complete run holds."""
        done = max((r[2] for r in runs), default=-1)
        for b in partition_values(self.spark, f"{self.path}/recent", "batch_id"):
            if int(b) <= done:
                delete_path(self.spark, f"{self.path}/recent/batch_id={b}")
        keep = {"-".join(map(str, r)) for r in runs}
        for name in partition_values(self.spark, f"{self.path}/runs", "run"):
            if name not in keep and int(name.split("-")[2]) < batch_id:
                delete_path(self.spark, f"{self.path}/runs/run={name}")
