"""A running result as a log of batches with compaction.

Every micro-batch writes a delta folder; after ``every`` deltas they are merged
with the last snapshot into a new one. A manifest (one small file a batch, put in
place by a rename) names the snapshot and the deltas that make up the result, so a
reader opens a bounded number of folders however long the stream has run, and never
sees half a batch. A replayed batch starts from the manifest before it and replaces
its own delta, snapshot and manifest. What a compaction replaced is deleted by the
next one, so readers of the previous manifest are not disturbed.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

EVERY = 16


class Files:
    """The few file operations of a manifest, on any store that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a file under another name and rename it, replacing an older one."""
        part = f"{name}.part"
        stream = self.fs.create(self.path(part), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        kind = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        at = self.fs.makeQualified(self.path(name))
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self.conf).rename(
            self.fs.makeQualified(self.path(part)), at, how)

    def drop(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class BatchLog:
    """Deltas of ``schema`` under ``path``. ``merge`` turns the rows of any number of
    batches into the running result, and its own result may be merged again."""

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame],
                 every: int = EVERY):
        if every < 1:
            raise ValueError("every must be at least 1")
        self.spark, self.path, self.schema, self.merge, self.every = spark, path, schema, merge, every
        self.files = Files(spark, path)

    def manifest(self, before: int | None = None) -> dict:
        """The newest manifest, or the newest of the batches before one."""
        ids = [int(n) for n in self.files.names("manifest") if n.isdigit()]
        ids = [i for i in ids if before is None or i < before]
        if not ids:
            return {"snapshot": None, "deltas": [], "replaced": []}
        return json.loads(self.files.read(f"manifest/{max(ids):012d}"))

    def _rows(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{p}" for p in parts])

    @staticmethod
    def _parts(state: dict) -> list[str]:
        return [state["snapshot"]] * bool(state["snapshot"]) + state["deltas"]

    def _old_manifests(self, batch_id: int) -> list[str]:
        """Manifests that no replay and no reader needs any more."""
        return [f"manifest/{i:012d}" for n in self.files.names("manifest")
                if n.isdigit() and (i := int(n)) < batch_id - 2 * self.every]

    def put(self, batch: DataFrame, batch_id: int) -> None:
        """Add the rows of a batch (again, if it is replayed)."""
        now = self.manifest(before=batch_id)
        delta = f"deltas/{batch_id:012d}"
        batch.write.mode("overwrite").parquet(f"{self.path}/{delta}")
        now["deltas"] = [*now["deltas"], delta]
        gone = []
        if len(now["deltas"]) >= self.every:
            snapshot = f"snapshots/{batch_id:012d}"
            self.merge(self._rows(self._parts(now))).write.mode("overwrite").parquet(f"{self.path}/{snapshot}")
            gone = now["replaced"] + self._old_manifests(batch_id)
            now = {"snapshot": snapshot, "deltas": [], "replaced": self._parts(now)}
        self.files.put(f"manifest/{batch_id:012d}", json.dumps(now))
        for part in gone:
            self.files.drop(part)

    def read(self) -> DataFrame:
        """The running result as of the last batch that is in place."""
        return self.merge(self._rows(self._parts(self.manifest())))


class TieredLog(BatchLog):
    """A batch log whose rows stay apart (``merge`` does not make them fewer), so a
    snapshot of everything would be written again and again. Here ``every`` deltas
    become one folder of the first tier, ``every`` of those one of the second, and so
    on: a row is written once a tier, and a reader opens fewer than ``every`` folders
    a tier, with tiers growing as the logarithm of the batches."""

    def __init__(self, spark: SparkSession, path: str, schema: str,
                 merge: Callable[[DataFrame], DataFrame] = lambda rows: rows, every: int = EVERY):
        super().__init__(spark, path, schema, merge, every)
        if every < 2:
            raise ValueError("every must be at least 2")

    @staticmethod
    def _parts(state: dict) -> list[str]:
        return [part for tier in state.get("tiers", []) for part in tier]

    def put(self, batch: DataFrame, batch_id: int) -> None:
        now = self.manifest(before=batch_id)
        tiers = now.get("tiers") or [[]]
        delta = f"deltas/{batch_id:012d}"
        batch.write.mode("overwrite").parquet(f"{self.path}/{delta}")
        tiers[0].append(delta)
        replaced: list[str] = []
        for k in range(len(tiers)):                     # a full tier fills the next one
            if len(tiers[k]) < self.every:
                break
            merged = f"tier{k + 1}/{batch_id:012d}"
            self.merge(self._rows(tiers[k])).write.mode("overwrite").parquet(f"{self.path}/{merged}")
            replaced += tiers[k]
            tiers[k] = []
            tiers[k + 1:] = [[*tiers[k + 1], merged], *tiers[k + 2:]] if k + 1 < len(tiers) else [[merged]]
        gone = now["replaced"] + self._old_manifests(batch_id) if replaced else []
        state = {"tiers": tiers, "replaced": replaced or now["replaced"]}
        self.files.put(f"manifest/{batch_id:012d}", json.dumps(state))
        for part in gone:
            self.files.drop(part)
