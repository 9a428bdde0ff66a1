"""A stream sink for reports that holds every batch exactly once.

Each task writes its rows as JSON lines into a file of its own; the commit of a batch
puts a manifest in place that names the batch's files. A batch that is replayed finds
its manifest and drops the new files; a batch that fails drops what its tasks have
written. Readers see the files that manifests name and nothing else. Paths are those
of the shared folder, opened through Arrow's file systems on driver and executors.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

from fairstream.session import scratch_path
from fairstream.streaming.stream import StreamJob

FORMAT = "fairstream_reports"


def _open(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


@dataclass
class PartWritten(WriterCommitMessage):
    name: str
    rows: int


class ReportWriter(DataSourceStreamWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator) -> PartWritten:
        store, root = _open(self.path)
        lines = [json.dumps(row.asDict(recursive=True), default=str) for row in iterator]
        name = f"{uuid.uuid4().hex}.json"
        if lines:
            store.create_dir(f"{root}/parts", recursive=True)
            with store.open_output_stream(f"{root}/parts/{name}") as out:
                out.write("".join(f"{line}\n" for line in lines).encode())
        return PartWritten(name, len(lines))

    def _drop(self, messages: list) -> None:
        store, root = _open(self.path)
        for m in messages:
            if m is not None and m.rows:
                store.delete_file(f"{root}/parts/{m.name}")

    def commit(self, messages: list, batchId: int) -> None:     # noqa: N803  (Spark's name)
        from pyarrow import fs
        store, root = _open(self.path)
        manifest = f"{root}/batches/{batchId:012d}.json"
        if store.get_file_info(manifest).type == fs.FileType.File:
            self._drop(messages)                                # replayed: the batch is there already
            return
        store.create_dir(f"{root}/batches", recursive=True)
        with store.open_output_stream(f"{manifest}.part") as out:
            out.write(json.dumps({"batch": batchId, "parts": [m.name for m in messages if m and m.rows]}).encode())
        store.move(f"{manifest}.part", manifest)

    def abort(self, messages: list, batchId: int) -> None:      # noqa: N803
        self._drop(messages)


class ReportSink(DataSource):
    """``format(FORMAT).option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> ReportWriter:    # noqa: N802
        return ReportWriter(self.options["path"])


def write_reports(stream: DataFrame, out: str | None = None, mode: str = "complete",
                  trigger: str | None = None) -> StreamJob:
    """Write what each batch of ``stream`` (an aggregate, for ``complete``) gives to a
    report log under ``out``."""
    spark = stream.sparkSession
    out = out or scratch_path(spark, "reports")
    spark.dataSource.register(ReportSink)
    writer = (stream.writeStream.format(FORMAT).outputMode(mode).option("path", f"{out}/reports")
              .option("checkpointLocation", f"{out}/_checkpoint"))
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return StreamJob(writer.start(), out)


def read_reports(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The rows of all committed batches: ``batch`` and the columns of ``schema``."""
    from pyarrow import fs
    store, root = _open(f"{out}/reports")
    found = store.get_file_info(fs.FileSelector(f"{root}/batches", allow_not_found=True))
    parts = []
    for info in sorted(found, key=lambda i: i.path):            # one small file for each batch
        if info.path.endswith(".json"):
            with store.open_input_stream(info.path) as f:
                one = json.loads(f.read())
            parts += [(one["batch"], name) for name in one["parts"]]
    names = spark.createDataFrame(parts, "batch bigint, _file string")
    if not parts:
        return spark.createDataFrame([], f"batch bigint, {schema}")
    rows = spark.read.schema(schema).json([f"{out}/reports/parts/{name}" for _, name in parts])
    rows = rows.select("*", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("_file"))
    return names.join(rows, "_file").select("batch", *[c for c in rows.columns if c != "_file"])
