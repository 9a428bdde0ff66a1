"""The line log: whole lines, replayable offsets, ranges, restarts."""
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fairstream.session import scratch_path
from fairstream.sources import linelog
from fairstream.sources.items import parse_items
from fairstream.streaming import stream as S


def land(folder, name, data):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data)


def read_all(reader, start, end):
    return [v for p in reader.partitions(start, end) for b in reader.read(p) for v in b.column(0).to_pylist()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=12), max_size=8), min_size=1, max_size=4),
       st.integers(1, 30), st.integers(1, 40), st.integers(1, 9))
def test_every_line_once_whatever_the_cuts(tmp_path_factory, logs, range_bytes, batch_bytes, block):
    folder = tmp_path_factory.mktemp("log")
    expected = []
    for i, lines in enumerate(logs):
        lines = [line.replace(b"\n", b"").replace(b"\r", b"") for line in lines]
        land(folder, f"part-{i}", b"".join(line + b"\n" for line in lines))
        expected += [line.decode(errors="replace") for line in lines]
    blocks, linelog.BLOCK_BYTES = linelog.BLOCK_BYTES, block
    try:
        r = linelog.LineLogReader(folder.as_uri(), batch_bytes, range_bytes)
        got, at = [], r.initialOffset()
        while (end := r.latestOffset()) != at:
            got.append(read_all(r, at, end))
            assert read_all(linelog.LineLogReader(folder.as_uri(), None, 7), at, end) == got[-1]   # a replay
            at = end
    finally:
        linelog.BLOCK_BYTES = blocks
    assert [v for part in got for v in part] == expected


def test_a_growing_segment_gives_whole_lines_only(tmp_path):
    r = linelog.LineLogReader(tmp_path.as_uri(), None, 10)
    start = r.initialOffset()
    assert r.latestOffset() == start                            # nothing has landed
    land(tmp_path, "a", b"1\n\n2\r\n3")
    land(tmp_path, "_SUCCESS", b"9\n")
    one = r.latestOffset()
    assert read_all(r, start, one) == ["1", "", "2"]
    land(tmp_path, "a", b"1\n\n2\r\n34\n5")
    two = r.latestOffset()
    assert read_all(r, one, two) == ["34"]
    land(tmp_path, "b", b"6\n")                                 # closes segment a
    three = r.latestOffset()
    assert read_all(r, two, three) == ["5", "6"]
    assert read_all(r, start, one) == ["1", "", "2"]            # the first batch again


def test_a_very_long_line_is_one_row(tmp_path):
    line = b"x" * (3 * linelog.BLOCK_BYTES + 5)
    land(tmp_path, "a", b"1\n" + line + b"\n2\n")
    r = linelog.LineLogReader(tmp_path.as_uri(), 3, 1 << 20)
    got, at = [], r.initialOffset()
    while (end := r.latestOffset()) != at:
        got += read_all(r, at, end)
        at = end
    assert got == ["1", line.decode(), "2"]


def test_a_late_segment_fails_the_query(tmp_path):
    land(tmp_path, "b", b"1\n")
    r = linelog.LineLogReader(tmp_path.as_uri(), None, 10)
    one = r.initialOffset() and r.latestOffset()
    land(tmp_path, "a", b"2\n")
    with pytest.raises(ValueError, match="already"):
        r.partitions(one, one)


def test_restarts_go_on_at_the_offset(spark, tmp_path):
    out = scratch_path(spark, "line-log")
    rnd = random.Random(3)
    seen = []

    def run(n, segment):
        values = [rnd.randrange(20) for _ in range(n)]
        seen.extend(values)
        land(tmp_path, segment, "".join(f" {v} \n" for v in values).encode())
        lines = linelog.line_log_stream(spark, tmp_path.as_uri(), batch_bytes=500, range_bytes=100)
        job = S.running_counts(parse_items(lines), out, trigger=S.BATCH_INTERVAL).drain()
        got = {r["item"]: r["cnt"] for r in S.counts_snapshot(spark, out).collect()}
        assert got == {v: seen.count(v) for v in set(seen)}
        return [n for _, _, n in job.progress_log()]

    first = run(400, "part-0")
    assert len(first) >= 3 and sum(first) == 400 and max(first) <= 130      # 4 or 5 bytes a line
    second = run(300, "part-1")
    assert len(second) >= 2 and sum(second) == 300 and max(second) <= 130   # the bound holds after a restart


def test_a_bad_line_fails_the_query(spark, tmp_path):
    land(tmp_path, "part-0", b"1\nx\n")
    lines = linelog.line_log_stream(spark, tmp_path.as_uri())
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|failed"):
        S.running_counts(parse_items(lines), scratch_path(spark, "line-log")).wait()
