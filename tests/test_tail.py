"""Growing files: appends, partial lines, rotation, restart, the flush, and a forest-scored stream."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import learning as L
from tidewatch.sources.events import event_lines_tail
from tidewatch.sources.tail import Range, TailReader
from tidewatch.streaming.scoring import read_scored, start_scoring_stream


def reader(path, **options):
    return TailReader({"path": str(path), "startingOffsets": "earliest", "minLines": "1"} | options)


def read_all(r, start, end):
    return [x[0].decode() for p in r.partitions(start, end) for x in r.read(p)]


def put(path, text, mode="ab"):
    with open(path, mode) as f:
        f.write(text.encode())


def test_appends_partial_lines_and_rotation(tmp_path):
    log = tmp_path / "eve.json"
    r = reader(log)
    o0 = r.initialOffset()
    assert r.latestOffset() == {"files": {}}  # the file isn't there yet
    put(log, "a1\na2\npart")
    o1 = r.latestOffset()
    assert read_all(r, o0, o1) == ["a1", "a2"]
    put(log, "ial\n")
    o2 = r.latestOffset()
    assert read_all(r, o1, o2) == ["partial"]
    put(log, "late\nlost?")  # a line behind the last look, then the file is moved away and finished there
    os.rename(log, tmp_path / "eve.json.1")
    put(tmp_path / "eve.json.1", " no\n")
    put(log, "b1\n")
    put(tmp_path / "eve.json.2", "an older log\n")
    o3 = reader(log).latestOffset()  # a restarted reader finds the same
    assert sorted(read_all(r, o2, o3)) == ["b1", "late", "lost? no"]
    put(log, "c", "wb")  # emptied in place, the new first line isn't whole
    o4 = r.latestOffset()
    put(log, "c1\n", "wb")
    o5 = r.latestOffset()
    assert read_all(r, o3, o4) == [] and read_all(r, o4, o5) == ["c1"]


def test_ranges_cut_anywhere_give_each_line_once(tmp_path):
    log = tmp_path / "log"
    lines = ["x" * (i * 7 % 23) for i in range(200)]
    put(log, "\n".join(lines) + "\nrest")
    for size in (1, 5, 64, 10_000):
        r = reader(log, bytesPerPartition=str(size))
        parts = r.partitions({"files": {}}, r.latestOffset())
        assert [x[0].decode() for p in parts for x in r.read(p)] == lines
    assert isinstance(parts[0], Range)


def test_moved_after_planning(tmp_path):
    log = tmp_path / "log"
    put(log, "one\ntwo\n")
    r = reader(tmp_path)
    end = r.latestOffset()
    os.rename(log, tmp_path / "log.old")
    put(log, "three\n")
    assert read_all(r, {"files": {}}, end) == ["one", "two"]
    os.remove(tmp_path / "log.old")
    with pytest.raises(FileNotFoundError):
        read_all(r, {"files": {}}, end)


def test_flush_by_count_or_time(tmp_path):
    log = tmp_path / "log"
    put(log, "x 0\n")
    r = reader(log, minLines="3", maxDelaySeconds="0.6", countPattern="x")
    r.initialOffset()
    first = r.latestOffset()
    assert first["files"]  # what waits at the start goes at once
    put(log, "x 1\nother\nother\nx 2\n")
    assert r.latestOffset() == first  # two lines count
    put(log, "x 3\n")
    second = r.latestOffset()
    assert second != first  # by count
    put(log, "x 4\n")
    assert r.latestOffset() == second
    time.sleep(0.7)
    assert r.latestOffset() != second  # by time


def flow(i, cls):
    return json.dumps({"timestamp": "2024-01-01T00:00:00.000000+0000", "event_type": "flow", "flow_id": i, "src_ip": "10.0.0.1", "dest_ip": "10.0.0.2", "dest_port": 22 + 1000 * cls, "proto": "TCP",
                       "flow": {"pkts_toserver": 1 + 100 * cls, "pkts_toclient": 1 + 50 * cls, "bytes_toserver": 10 + 10_000 * cls, "bytes_toclient": 10 + 5000 * cls, "start": "2024-01-01T00:00:00.000000+0000", "end": "2024-01-01T00:00:01.000000+0000"}})


def test_forest_scores_a_growing_file(spark, tmp_path):
    """Lines written while the stream runs and while it is down: none lost, none doubled, scored as a batch is."""
    from tidewatch.operators import features as FX
    from tidewatch import schemas
    from tidewatch.sources.events import parse_event_lines, typed_events

    def frame(lines):
        rows = spark.createDataFrame([(x, ("f", 0, i)) for i, x in enumerate(lines)], "value string, ord struct<file:string,block:long,pos:long>")
        return FX.flow_features_stream_rules(typed_events(parse_event_lines(rows)), keep=("ord", "flow_id"))

    lines = [flow(i, i % 2) for i in range(60)]
    train = frame(lines).withColumn("label", F.when(F.col("flow_id") % 2 == 1, "DDoS").otherwise("BENIGN"))
    model = L.train_forest(train, schemas.CIC_18, label="label", num_trees=5, max_depth=3)
    score = lambda f: L.score(model, f)
    log, out, ckpt = tmp_path / "eve.json", str(tmp_path / "out"), str(tmp_path / "ckpt")
    put(log, "old line, skipped\n" + flow(999, 1) + "\n")

    def start():
        source = event_lines_tail(spark, str(log), maxDelaySeconds="0.5")
        return start_scoring_stream(spark, source, out, ckpt, score, ordinal=True)

    def wait_for(n):
        for _ in range(120):
            try:
                if read_scored(spark, out).count() >= n:
                    return
            except Exception:  # noqa: BLE001  nothing written yet
                pass
            time.sleep(0.5)

    q = start()
    for _ in range(60):
        if q.lastProgress:
            break
        time.sleep(0.5)
    put(log, "\n".join(lines[:25]) + "\n" + lines[25][:40])
    wait_for(25)
    q.stop()
    put(log, lines[25][40:] + "\nnot json\n\n" + "\n".join(lines[26:40]) + "\n")  # while it is down
    os.rename(log, tmp_path / "eve.json.1")
    put(log, "\n".join(lines[40:50]) + "\n")
    q = start()
    wait_for(50)
    put(log, "\n".join(lines[50:]) + "\n")
    wait_for(60)
    q.stop()
    got = read_scored(spark, out).collect()
    assert sorted(r.flow_id for r in got) == list(range(60))
    want = {r.flow_id: (r.model_label, r.model_confidence_pct) for r in score(frame(lines)).collect()}
    assert {r.flow_id: (r.model_label, r.model_confidence_pct) for r in got} == want
    batches = {}
    for r in got:
        batches.setdefault(r.batch_id, []).append((r.batch_ordinal, (r.ord.file != str(log) + ".1", r.flow_id)))
    assert all(sorted(o for o, _ in b) == list(range(1, len(b) + 1)) for b in batches.values())
    assert not any("rdd-" in d for d, _, _ in os.walk(out))
