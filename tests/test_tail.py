"""Growing logs: each full line once over triggers, restarts, partial lines, renames and replaced files."""

import json
import os
from collections import Counter

import pytest

from playback_qos.sources.tables import read_table
from playback_qos.sources.tail import Range, TailReader, tail_lines
from playback_qos.streaming import jobs
from playback_qos.streaming.layout import Layout


def line(i, session="s"):
    return json.dumps({"event_type": "buffering_start", "sessionId": session, "viewerId": "v", "eventId": f"e{i}", "timestamp": i})


def append(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "ab") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def drain(spark, base, incoming, **options):
    q = (tail_lines(spark, incoming, **options).writeStream.format("parquet").option("checkpointLocation", f"{base}/ck")
         .trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    return Counter(r.value for r in read_table(spark, f"{base}/out").collect())


def test_job_reads_lines_appended_to_a_log(spark, tmp_dir):
    """The receiver appends to one log; ten lines, then fifteen more and a line in two halves."""
    layout, log = Layout(tmp_dir), f"{tmp_dir}/in/telemetry.log"
    append(log, "".join(line(i) + "\n" for i in range(10)))
    run = lambda: jobs.await_all([jobs.stream_telemetry(spark, log, layout, trigger="available_now")])
    run()
    append(log, "".join(line(i) + "\n" for i in range(10, 25)) + line(25)[:30])
    run()
    assert read_table(spark, layout.telemetry).count() == 25
    append(log, line(25)[30:] + "\nno json\n")
    run()
    run()
    got = sorted(r.timestamp for r in read_table(spark, layout.telemetry).collect())
    assert got == list(range(26))
    assert [r.reason for r in read_table(spark, layout.telemetry_quarantine).collect()] == ["malformed"]
    rows = read_table(spark, layout.telemetry).orderBy("timestamp").collect()
    assert [r.log_line for r in rows] == sorted(r.log_line for r in rows) and len({r.log_file for r in rows}) == 1


def test_rotation_truncation_and_new_logs(spark, tmp_dir):
    log = f"{tmp_dir}/in/a.log"
    want = Counter()

    def put(path, *lines):
        append(path, "".join(f"{x}\r\n" if x.startswith("cr") else f"{x}\n" for x in lines))
        want.update(lines)

    put(log, *[f"line {i}" for i in range(50)])
    assert drain(spark, tmp_dir, f"{tmp_dir}/in", split_bytes=41) == want
    os.rename(log, f"{log}.1")
    put(f"{log}.1", "written after the rename")
    put(log, "first of the new log", "äöü 日本", "cr at the end", "")
    put(f"{tmp_dir}/in/b.log", "b" * 300, "b" * 300)
    append(f"{tmp_dir}/in/.hidden", "not read\n")
    assert drain(spark, tmp_dir, f"{tmp_dir}/in", split_bytes=41) == want
    os.rename(f"{log}.1", f"{log}.2")
    os.rename(log, f"{log}.1")  # every log has the name that another had
    put(log, "third log")
    assert drain(spark, tmp_dir, f"{tmp_dir}/in") == want
    os.truncate(log, 0)
    put(log, "3", "after truncation")
    append(log, b"bad \xff byte\n")
    want["bad � byte"] += 1
    assert drain(spark, tmp_dir, f"{tmp_dir}/in") == want
    assert drain(spark, tmp_dir, f"{tmp_dir}/in", pattern="*.log*") == want


def test_budget_of_a_trigger(spark, tmp_dir):
    append(f"{tmp_dir}/in/a", "".join(f"a{i:04d}\n" for i in range(100)) + "x" * 5000 + "\n" + "end\n")
    append(f"{tmp_dir}/in/b", "".join(f"b{i:04d}\n" for i in range(100)))
    q = (tail_lines(spark, f"{tmp_dir}/in", max_bytes_per_trigger=100).writeStream.format("parquet")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(processingTime="0 seconds").start(f"{tmp_dir}/out"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = Counter(r.value for r in read_table(spark, f"{tmp_dir}/out").collect())
    assert len(got) == 202 and set(got.values()) == {1}
    assert len([n for n in os.listdir(f"{tmp_dir}/ck/commits") if n[0] != "."]) > 10


def reader(path, **options):
    return TailReader({"path": path, "splitbytes": "7", **options})


def values(r, parts):
    return [v for p in parts for b in r.read(p) for v in b.column("value").to_pylist()]


def test_replay_after_a_rename_reads_the_same_lines(tmp_dir):
    log = f"{tmp_dir}/a"
    append(log, "one\ntwo\n")
    r = reader(tmp_dir)
    first = r.latestOffset()
    append(log, "three\nfour\nfi")
    second = r.latestOffset()
    planned = r.partitions(first, second)
    os.rename(log, f"{log}.1")
    append(log, "something else\n")
    assert sorted(values(r, planned)) == ["four", "three"]  # planned before the rename
    again = reader(tmp_dir)
    assert again.partitions(second, second) == []
    assert sorted(values(again, again.partitions(first, second))) == ["four", "three"]
    assert sorted(values(again, again.partitions(second, again.latestOffset()))) == ["something else"]


def test_a_log_that_went_unread_is_an_error(tmp_dir):
    append(f"{tmp_dir}/a", "one\n")
    r = reader(tmp_dir)
    end = r.latestOffset()
    os.rename(f"{tmp_dir}/a", f"{tmp_dir}/_a")
    with pytest.raises(FileNotFoundError):
        r.partitions(r.initialOffset(), end)
    assert reader(tmp_dir, failondataloss="false").partitions(r.initialOffset(), end) == []
    with pytest.raises(FileNotFoundError):
        list(r.read(Range("a", "one\n", 0, 4, 4, True)))
    assert reader(f"{tmp_dir}/missing").latestOffset() == {"files": {}}


@pytest.mark.parametrize("split", [1, 2, 3, 5, 64])
def test_splits_cut_lines_anywhere(tmp_dir, split):
    text = "a\n\nbb\nccc\n\n\ndddddddd\ne\n"
    append(f"{tmp_dir}/a", text + "rest")
    r = TailReader({"path": tmp_dir, "splitbytes": str(split)})
    parts = r.partitions(r.initialOffset(), r.latestOffset())
    assert values(r, parts) == text.split("\n")[:-1]
