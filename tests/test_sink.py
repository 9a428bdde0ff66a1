"""The report sink: replayed and failing batches leave one report each."""
import pytest
from pyspark.sql import functions as F

from fairstream.session import scratch_path
from fairstream.streaming import sink
from fairstream.streaming import stream as S


class Row(dict):
    def asDict(self, recursive=False):
        return dict(self)


def parts(out):
    store, root = sink._open(f"{out}/reports")
    from pyarrow import fs
    return [i.path for i in store.get_file_info(fs.FileSelector(f"{root}/parts", allow_not_found=True))]


def test_replayed_and_aborted_batches(spark):
    out = scratch_path(spark, "reports")
    w = sink.ReportWriter(f"{out}/reports")
    assert sink.read_reports(spark, out, "n bigint").count() == 0
    w.commit([w.write(iter([Row(n=1)])), w.write(iter([])), w.write(iter([Row(n=2)]))], 0)
    w.commit([w.write(iter([Row(n=1)])), w.write(iter([Row(n=2)]))], 0)             # the batch again
    w.abort([w.write(iter([Row(n=9)])), None], 1)                                   # one task failed
    w.write(iter([Row(n=8)]))                                                       # its task died before the commit
    assert {tuple(r) for r in sink.read_reports(spark, out, "n bigint").collect()} == {(0, 1), (0, 2)}
    w.commit([w.write(iter([Row(n=3)]))], 1)
    assert sorted(tuple(r) for r in sink.read_reports(spark, out, "n bigint").collect()) == [(0, 1), (0, 2), (1, 3)]
    assert len(parts(out)) == 4


def test_failing_task_leaves_the_committed_reports(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    def land(values):
        spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").text(landing)
    def run():
        items = S.line_stream(spark, landing).select(F.col("value").cast("bigint").alias("item"))
        return sink.write_reports(items.agg(F.sum("item").alias("total")), out).wait()
    land(["1", "2"])
    run()
    land(["x"])
    with pytest.raises(Exception):
        run()
    got = sink.read_reports(spark, out, "total bigint")
    assert [tuple(r) for r in got.collect()] == [(0, 3)]
