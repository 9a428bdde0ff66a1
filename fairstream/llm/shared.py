"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairstream.session import scratch_path

#: White space of the contracts, as a character class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage with files that every executor can read, so a lost
    executor costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def drop_clashing(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add (any case)."""
    taken = {n.lower() for n in names}
    return df.select(*[column(c) for c in df.columns if c.lower() not in taken])


def free_name(name: str, taken: list[str]) -> str:
    """``name``, longer if a column has it already (any case)."""
    used = {n.lower() for n in taken}
    while name.lower() in used:
        name += "_"
    return name


class Renamed:
    """A table whose columns are called ``c0``, ``c1``, ... while an operator adds its
    own, so that no name of the caller's can clash with a helper."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.df = df.toDF(*[f"c{i}" for i in range(len(self.names))])

    def of(self, name: str) -> str:
        """What the column ``name`` is called inside."""
        wanted = [i for i, n in enumerate(self.names) if n == name] or [
            i for i, n in enumerate(self.names) if n.lower() == name.lower()]
        return f"c{wanted[0]}"

    def back(self, out: DataFrame, new: list[str] = ()) -> DataFrame:
        """``out`` with the caller's names, those of the columns ``new`` replaced."""
        taken = {n.lower() for n in new}
        kept = [F.col(f"c{i}").alias(n) for i, n in enumerate(self.names) if n.lower() not in taken]
        return out.select(*kept, *new)


def add_arrow_columns(
    df: DataFrame,
    fields: list[T.StructField],
    make: Callable[[], Callable[[pa.RecordBatch], list]],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` plus ``fields``, computed batch by batch from Arrow batches.

    ``make()`` runs once in each task and returns a function from a batch to
    one list (or Arrow array) for each field. Input columns that have the name
    of a new one are replaced; ``drop`` are read but not returned.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    new = {f.name.lower() for f in fields}
    keep = [c for c in df.columns if c.lower() not in new and c not in drop]
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    kinds = [to_arrow_type(f.dataType) for f in fields]
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            made = work(batch)
            arrays = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, k)
                      for x, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + arrays, names=names)

    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.large_binary()).to_pylist()
