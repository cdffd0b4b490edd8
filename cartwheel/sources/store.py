"""Feature table: the newest value per metric name, with expiry.

Every write goes to a part of its own, named by run, batch and a stamp that no other write has, so no write
can replace another run's rows. A batch that is written again (after a failure) supersedes its own earlier
part. ``compact`` folds the parts so far into a snapshot whose manifest lists them by name; whatever it does
not list is read on top, also a batch number that was folded before. Parts folded one compaction ago are
removed. ``upsert`` compacts by itself once ``compact_after`` parts wait.

Rows are spread over hash buckets of the name; a lookup by a list of names reads their buckets only.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import DEFAULT_TTL_SECONDS

ROW = "name string, value string, emit_ts timestamp, expires_at timestamp, batch bigint, written bigint, bucket int"
COMPACT_AFTER = 32
# rows are dropped once they have been expired for so long, by the table's newest emit time
GRACE_SECONDS = 86_400


def newest(rows: DataFrame) -> DataFrame:
    """Last write per name: newest emit time, then newest batch, then the later write."""
    rank = F.struct("emit_ts", "batch", "written", "value", "expires_at")
    return rows.groupBy("bucket", "name").agg(F.max(rank).alias("_r")).select("bucket", "name", "_r.*")


def expiry(default_ttl: int = DEFAULT_TTL_SECONDS) -> Column:
    ttl = F.coalesce("ttl_seconds", F.lit(default_ttl).cast("long"))
    return F.timestamp_micros(F.unix_micros("emit_ts") + ttl * 1_000_000)


class FeatureStore:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        buckets: int = 64,
        default_ttl: int = DEFAULT_TTL_SECONDS,
        compact_after: int = COMPACT_AFTER,
        run: str | None = None,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.default_ttl = default_ttl
        self.compact_after = compact_after
        self.run = run or uuid.uuid4().hex

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("name"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _save(self, rows: DataFrame, part: str) -> None:
        """Files follow the volume: large buckets are split over tasks, small ones share a task."""
        rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/part={part}")

    def _place(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _finished(self, kind: str) -> list[str]:
        """Names of the completely written ``part=`` or ``manifest=`` folders, in the order of their stamps."""
        root, fs = self._place(self.path)
        if not fs.exists(root):
            return []
        folders = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(f"{kind}=")]
        done = [p.getName().split("=", 1)[1] for p in folders if fs.exists(self._place(f"{p}/_SUCCESS")[0])]
        return sorted(done, key=lambda name: name.rsplit("_", 1)[-1])

    def _manifest(self) -> tuple[str | None, set[str]]:
        """The current snapshot and the parts it holds."""
        versions = self._finished("manifest")
        if not versions:
            return None, set()
        rows = self.spark.read.parquet(f"{self.path}/manifest={versions[-1]}").collect()
        return rows[0]["snapshot"], {r["part"] for r in rows if r["part"]}

    def _waiting(self) -> list[str]:
        """Parts that no snapshot holds; of a batch written again only the last one."""
        _, folded = self._manifest()
        last = {p.rsplit("_", 1)[0]: p for p in self._finished("part") if not p.startswith("snapshot_") and p not in folded}
        return sorted(last.values())

    def upsert(self, metrics: DataFrame, batch_id: int, run: str | None = None) -> None:
        """Usable as a ``foreachBatch`` function; ``run`` names whose batch numbers these are."""
        stamp = time.time_ns()
        rows = metrics.select(
            self._bucket(),
            "name",
            "value",
            "emit_ts",
            expiry(self.default_ttl).alias("expires_at"),
            F.lit(batch_id).cast("long").alias("batch"),
            F.lit(stamp).cast("long").alias("written"),
        )
        name = re.sub(r"[^A-Za-z0-9-]", "-", run or self.run)
        self._save(newest(rows), f"{name}_{batch_id}_{stamp:020d}")
        if len(self._waiting()) >= self.compact_after:
            self.compact()

    def rows(self) -> DataFrame:
        """The snapshot and the parts on top of it."""
        snapshot, _ = self._manifest()
        places = [f"{self.path}/part={p}" for p in ([snapshot] if snapshot else []) + self._waiting()]
        if not places:
            return self.spark.createDataFrame([], ROW)
        return self.spark.read.schema(ROW).option("basePath", self.path).parquet(*places)

    def latest(self, as_of: Column | None = None) -> DataFrame:
        table = newest(self.rows())
        return table if as_of is None else table.where(F.col("expires_at") > as_of)

    def lookup(self, names: Sequence[str] | DataFrame, as_of: Column) -> DataFrame:
        """Live values of the wanted names, as a list or as a frame with a ``name`` column.

        Of a list the buckets are known beforehand, so only these are read; a frame is joined.
        """
        rows = self.rows()
        if not isinstance(names, DataFrame):
            names = self.spark.createDataFrame([(n,) for n in names], "name string")
            buckets = [r["bucket"] for r in names.select(self._bucket()).distinct().collect()]
            rows = rows.where(F.col("bucket").isin(buckets))
        wanted = names.select("name", self._bucket()).distinct()
        found = newest(rows.join(wanted, ["bucket", "name"], "left_semi"))
        return found.where(F.col("expires_at") > as_of).select("name", "value", "emit_ts", "expires_at")

    def compact(self, as_of: Column | None = None) -> None:
        """Fold all waiting parts into a new snapshot, without rows expired by ``as_of`` (else by the grace time)."""
        waiting = self._waiting()
        if not waiting:
            return
        before, folded = self._manifest()
        table = newest(self.rows())
        if as_of is None:
            clock = self.rows().agg(F.max("emit_ts").alias("_clock"))
            table = table.crossJoin(F.broadcast(clock)).where(
                F.col("expires_at") > F.col("_clock") - F.expr(f"INTERVAL {GRACE_SECONDS} SECONDS")
            ).drop("_clock")
        else:
            table = table.where(F.col("expires_at") > as_of)
        stamp = f"{time.time_ns():020d}"
        snapshot = f"snapshot_{stamp}"
        self._save(table, snapshot)
        # parts that were written again before being folded go with their successor
        again = {p.rsplit("_", 1)[0] for p in waiting}
        held = [p for p in self._finished("part") if p in waiting or (p.rsplit("_", 1)[0] in again and p <= max(waiting))]
        rows = [(snapshot, p) for p in held]
        self.spark.createDataFrame(rows, "snapshot string, part string").coalesce(1).write.parquet(f"{self.path}/manifest={stamp}")
        self._remove([f"part={p}" for p in folded] + [f"manifest={m}" for m in self._finished("manifest")[:-2]])
        older = [p for p in self._finished("part") if p.startswith("snapshot_") and p not in (snapshot, before)]
        self._remove([f"part={p}" for p in older])

    def _remove(self, names: list[str]) -> None:
        for name in names:
            place, fs = self._place(f"{self.path}/{name}")
            fs.delete(place, True)
