"""A keyed table in buckets: a batch rewrites the buckets that it touches, and a read costs one version of each."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from millrace.operators.running import latest_per_key
from millrace.sources.committed import opened
from millrace.sources.sinks import run_of

MANIFEST = "_manifest-"


@dataclass(frozen=True)
class BucketedTable:
    """Latest row per key, in ``buckets`` parts by the key's hash; one writer at a time, any number of readers.

    A batch is reduced to one row per key, merged with the current versions of its buckets and written beside
    them. A manifest then names the version of each bucket; it appears by one rename, so a reader sees all of a batch
    or nothing. The manifest also names the last batch of each run (see :func:`millrace.sources.sinks.run_of`):
    a repeated batch changes nothing. Versions that neither the newest manifest nor the one before names are
    removed, so readers have until the second next batch to end. A row replaces one of equal or lower ``order``.

    Choose ``buckets`` by the table's size: a bucket is one task's work, and a batch that touches all of them
    rewrites the table.
    """

    folder: str
    key: tuple[str, ...]
    order: tuple[str, ...]
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).alias("__bucket")

    def _manifests(self) -> list[str]:
        system, root = opened(self.folder)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(i.path for i in found if i.base_name.startswith(MANIFEST))

    def _manifest(self, path: str | None) -> dict:
        if path is None:
            return {"number": 0, "versions": {}, "done": {}, "schema": None}
        system, _ = opened(self.folder)
        with system.open_input_stream(path) as f:
            return json.loads(f.read())

    def _newest(self) -> dict:
        return self._manifest(next(reversed(self._manifests()), None))

    def _rows(self, spark: SparkSession, state: dict, buckets: list[int] | None = None) -> DataFrame | None:
        wanted = [f"{self.folder}/{v}/__bucket={b}" for b, v in state["versions"].items() if buckets is None or int(b) in buckets]
        if not wanted:
            return None
        return spark.read.schema(T.StructType.fromJson(json.loads(state["schema"]))).parquet(*wanted)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark, state = batch.sparkSession, self._newest()
        run = run_of(spark)
        if state["done"].get(run, -1) >= batch_id:
            return
        touched = sorted(r[0] for r in batch.select(self._bucket()).distinct().collect())
        if not touched:
            return
        # What came later wins where the order is equal; the batch's own rows are told apart by it alone.
        incoming = batch.withColumn("__new", F.lit(1))
        current = self._rows(spark, state, touched)
        merged = incoming if current is None else incoming.unionByName(current.withColumn("__new", F.lit(0)))
        latest = latest_per_key(merged, list(self.key), [*self.order, "__new"]).drop("__new")
        version = f"version={state['number'] + 1}-{run}-{batch_id}"
        placed = latest.withColumn("__bucket", self._bucket()).repartition(len(touched), "__bucket")
        placed.write.mode("overwrite").partitionBy("__bucket").parquet(f"{self.folder}/{version}")
        self._commit(
            {
                "number": state["number"] + 1,
                "versions": state["versions"] | {str(b): version for b in touched},
                "done": state["done"] | {run: batch_id},
                "schema": batch.schema.json() if state["schema"] is None else state["schema"],
            }
        )

    def _commit(self, state: dict) -> None:
        system, root = opened(self.folder)
        with system.open_output_stream(f"{root}/_new-manifest") as f:
            f.write(json.dumps(state).encode())
        system.move(f"{root}/_new-manifest", f"{root}/{MANIFEST}{state['number']:012d}.json")
        *old, before, _ = [None, *self._manifests()]
        named = {(b, v) for p in (before, None) for b, v in self._manifest(p)["versions"].items()} | set(state["versions"].items())
        for path in filter(None, old):
            for b, v in self._manifest(path)["versions"].items():
                stale = f"{root}/{v}/__bucket={b}"
                if (b, v) not in named and system.get_file_info(stale).type != fs.FileType.NotFound:
                    system.delete_dir(stale)
            system.delete_file(path)

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of its last batch. A table without one can't be read, as its columns aren't known."""
        state = self._newest()
        if state["schema"] is None:
            raise FileNotFoundError(f"nothing was written to {self.folder}")
        return self._rows(spark, state)
