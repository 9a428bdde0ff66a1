"""A stream of text lines from a landing log, with replayable offsets.

The log is a folder of segments, taken in the order of their names; only the last one
may still grow. An offset is a place in it (segment, bytes, and how many segments lie
up to there), always at the end of a whole line, so the lines between two offsets are
the same whenever they are read, and a restarted query replays its batch to the byte.
Large segments are cut into byte ranges, one task each; a line belongs to the range
it starts in. The driver sees names, sizes and the tail of the last segment.

Defined results: an empty or absent folder gives no rows; an empty line is an empty
string; a ``\\r`` before the line feed is dropped; bytes that are not UTF-8 become
U+FFFD; the last line of a segment that is no longer the last needs no line feed; a
line of any length is one row. Files whose names start with ``_`` or ``.`` are no
segments. A segment that appears in front of the read position fails the query,
since its lines could only be lost.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "fairstream_line_log"
RANGE_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20
START = {"segment": "", "bytes": 0, "segments": 0}


def _open(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def segments(path: str) -> list[tuple[str, int]]:
    """``(name, bytes)`` of the log's segments, in order."""
    from pyarrow import fs
    store, root = _open(path)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted((i.base_name, i.size) for i in found
                  if i.type == fs.FileType.File and not i.base_name.startswith(("_", ".")))


def _line_end(path: str, name: str, size: int, low: int = 0) -> int:
    """The end of the last whole line of a segment's first ``size`` bytes, or
    ``low`` if none ends behind it."""
    store, root = _open(path)
    with store.open_input_file(f"{root}/{name}") as f:
        while size > low:
            at = max(low, size - BLOCK_BYTES)
            f.seek(at)
            cut = f.read(size - at).rfind(b"\n")
            if cut >= 0:
                return at + cut + 1
            size = at
    return low


def _next_line(path: str, name: str, at: int, stop: int) -> int:
    """The first place at or behind ``at`` where a line starts (``stop`` if none)."""
    store, root = _open(path)
    with store.open_input_file(f"{root}/{name}") as f:
        at -= 1                                     # a line feed right before starts a line here
        f.seek(at)
        while at < stop:
            block = f.read(min(BLOCK_BYTES, stop - at))
            cut = block.find(b"\n")
            if cut >= 0:
                return at + cut + 1
            at += len(block)
    return stop


def _place(offset: dict) -> tuple[str, int]:
    return offset["segment"], offset["bytes"]


class Range(InputPartition):
    """Bytes ``low`` to ``high`` of a segment; its batch's lines there are those of
    ``first`` to ``stop``."""

    def __init__(self, name: str, first: int, low: int, high: int, stop: int):
        self.name, self.first, self.low, self.high, self.stop = name, first, low, high, stop


class LineLogReader(DataSourceStreamReader):
    def __init__(self, path: str, batch_bytes: int | None, range_bytes: int):
        self.path, self.batch_bytes, self.range_bytes = path.rstrip("/"), batch_bytes, range_bytes
        self.at = dict(START)                       # up to where batches have been planned

    def initialOffset(self) -> dict:                # noqa: N802  (Spark's name)
        return dict(START)

    def latestOffset(self) -> dict:                 # noqa: N802
        """The end of the last whole line, or of the last one that ``batch_bytes``
        from the position holds (one line at least)."""
        log = segments(self.path)
        if not log:
            return dict(self.at)
        end = self._end(log)
        if self.batch_bytes is not None:
            end = self._within(log, end)
        self.at = end
        return dict(end)

    def _end(self, log: list[tuple[str, int]]) -> dict:
        name, size = log[-1]
        low = self.at["bytes"] if self.at["segment"] == name else 0
        return {"segment": name, "bytes": _line_end(self.path, name, size, low), "segments": len(log)}

    def _within(self, log: list[tuple[str, int]], end: dict) -> dict:
        """``end``, or an earlier line end once ``batch_bytes`` have been passed."""
        left = self.batch_bytes
        for i, (name, size) in enumerate(log):
            if name < self.at["segment"]:
                continue
            low = self.at["bytes"] if name == self.at["segment"] else 0
            high = end["bytes"] if name == end["segment"] else size
            if high - low > left:
                cut = high if low + left <= 0 else _next_line(self.path, name, max(low + left, 1), high)
                return {"segment": name, "bytes": cut, "segments": i + 1}
            left -= high - low
        return end

    def partitions(self, start: dict, end: dict) -> list[Range]:
        """Byte ranges of the lines between two offsets. A restarted query tells its
        position by a call with its last offset as both."""
        if _place(end) < _place(start):
            raise ValueError(f"{self.path}: the log ends before {start}, which has been read already")
        if _place(end) > _place(self.at):
            self.at = dict(end)
        log = segments(self.path)
        if bisect_right([n for n, _ in log], start["segment"]) > start["segments"]:
            raise ValueError(f"{self.path}: a segment has appeared at or before {start['segment']!r}, "
                             "which has been read already; name new segments behind the last one")
        out = []
        for name, size in log:
            if not start["segment"] <= name <= end["segment"]:
                continue
            low = start["bytes"] if name == start["segment"] else 0
            stop = end["bytes"] if name == end["segment"] else size
            out += [Range(name, low, at, min(at + self.range_bytes, stop), stop)
                    for at in range(low, stop, self.range_bytes)]
        return out

    def read(self, partition: Range) -> Iterator:
        """The lines that start in the range, in Arrow batches."""
        import pyarrow as pa
        p = partition
        low = p.low if p.low == p.first else _next_line(self.path, p.name, p.low, p.stop)
        high = p.high if p.high == p.stop else _next_line(self.path, p.name, p.high, p.stop)
        store, root = _open(self.path)
        with store.open_input_file(f"{root}/{p.name}") as f:
            f.seek(low)
            rest: list[bytes] = []                  # the start of a line longer than a block
            while low < high:
                block = f.read(min(BLOCK_BYTES, high - low))
                if not block:
                    raise OSError(f"{p.name} ends before byte {high}")
                low += len(block)
                cut = block.rfind(b"\n") + 1
                if cut:
                    yield _lines(pa, b"".join([*rest, block[:cut - 1]]))
                    rest = []
                rest.append(block[cut:])
            if any(rest):
                yield _lines(pa, b"".join(rest))    # a closed segment without a last line feed

    def commit(self, end: dict) -> None:
        pass                                        # segments stay; nothing to release


def _lines(pa, text: bytes):
    lines = [line[:-1] if line.endswith("\r") else line
             for line in text.decode(errors="replace").split("\n")]
    return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])


class LineLog(DataSource):
    """``format(FORMAT).option("path", ...)``, optionally ``batch_bytes`` and
    ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> LineLogReader:            # noqa: N802
        limit = self.options.get("batch_bytes")
        return LineLogReader(self.options["path"], int(limit) if limit else None,
                             int(self.options.get("range_bytes", RANGE_BYTES)))


def line_log_stream(spark: SparkSession, path: str, batch_bytes: int | None = None,
                    range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A streaming DataFrame ``value string`` over the log at ``path``.

    ``batch_bytes`` bounds a batch (it ends with the line that reaches the bound); use
    it with a processing-time trigger, since ``availableNow`` asks a source of this kind
    for one batch only. Without it a batch is all that has arrived."""
    if (batch_bytes is not None and batch_bytes < 1) or range_bytes < 1:
        raise ValueError("batch_bytes and range_bytes must be positive")
    spark.dataSource.register(LineLog)
    r = spark.readStream.format(FORMAT).option("path", path).option("range_bytes", range_bytes)
    return (r.option("batch_bytes", batch_bytes) if batch_bytes else r).load()


def log_copy(df: DataFrame, column: str, key: str, parts: int, path: str) -> str:
    """Write a column of ``df`` as a log of ``parts`` segments by ranges of ``key``
    (Spark numbers its files by partition). A replay harness, as ``stream.split_copy``."""
    df.repartitionByRange(parts, key).select(df[column].cast("string").alias("value")).write.text(path)
    return path
