"""Growing logs, job state files, timers and expiry."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from rillflow.streaming import growing, live, watch


def test_no_line_is_lost_or_repeated(spark, tmp_path, monkeypatch):
    """Appends between runs, a half line, a new file, a file written anew; pieces end within lines."""
    folder, state = tmp_path / "logs" / "j", str(tmp_path / "state")
    folder.mkdir(parents=True)
    a = folder / "a.log"
    a.write_bytes(b"one\ntwo\r\nhal")
    seen = []

    def run():
        got = live.run_available(live.tail(spark, str(tmp_path / "logs")).select("job", "file", "place", "line"), state=state).collect()
        seen.append(sorted((os.path.basename(r.file), r.place, r.line) for r in got))
        return seen[-1]

    assert run() == [("a.log", 0, "one"), ("a.log", 4, "two")]
    assert run() == []
    with a.open("ab") as f:
        f.write("f\nthree é\n\nopen".encode())
    (folder / "b.log").write_text("x\n")
    assert run() == [("a.log", 9, "half"), ("a.log", 14, "three é"), ("a.log", 23, ""), ("b.log", 0, "x")]
    with a.open("ab") as f:
        f.write(b" end\n")
    assert run() == [("a.log", 24, "open end")]
    (folder / "b.log").write_text("")
    assert run() == []
    reader = growing.GrowingReader(str(tmp_path / "logs"))
    monkeypatch.setattr(growing, "PIECE", 5)
    pieces = reader.partitions({}, reader.latestOffset())
    lines = [x for p in pieces for b in reader.read(p) for x in zip(b.column("place").to_pylist(), b.column("line").to_pylist(), strict=True)]
    assert len(pieces) > 4 and lines == [(0, "one"), (4, "two"), (9, "half"), (14, "three é"), (23, ""), (24, "open end")]
    monkeypatch.setattr(growing, "BACK", 3)
    assert list(reader.latestOffset().values()) == [a.stat().st_size]


def test_state_files(spark, tmp_path):
    folder = tmp_path / "logs" / "j"
    folder.mkdir(parents=True)
    (folder / "a.log").write_text("INFO step:10 loss:0.5\n")
    out, state = tmp_path / "out", str(tmp_path / "state")

    def run():
        live.state_sink(live.metric_states(live.tail(spark, str(tmp_path / "logs")), "append"), str(out), state, available=True).awaitTermination()
        return json.loads((out / "j.json").read_text())["step"], int((out / "_batch").read_text())

    assert run()[0] == 10
    with (folder / "a.log").open("a") as f:
        f.write("INFO step:12 loss:0.4\n")
    step, batch = run()
    assert step == 12 and not list((out / "_staged").iterdir())
    # a batch that is tried again changes nothing; one that fails leaves nothing
    writer = growing.StateWriter(str(out), "job", ["job", "step"])
    again = writer.write(iter([{"job": "j", "step": 99}]))
    writer.commit([again, None], batch)
    assert json.loads((out / "j.json").read_text())["step"] == 12 and not list((out / "_staged").iterdir())
    writer.abort([writer.write(iter([{"job": "j", "step": 98}]))], batch + 1)
    assert not list((out / "_staged").iterdir())
    writer.commit([writer.write(iter([{"job": "j", "step": 97}, {"job": "k/l", "step": 1}, {"job": "j", "step": 98}]))], batch + 1)
    assert json.loads((out / "j.json").read_text()) == {"job": "j", "step": 98} and (out / "k_l.json").exists()


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    watch.store(spark)
    yield spark
    spark.conf.unset(key)


def signs(spark, folder):
    kind = "job string, ts timestamp, step long, code long"
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).json(str(folder))


def say(folder, n, *rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{n}.json").write_text("\n".join(json.dumps({"job": j, "ts": f"2024-01-01T00:00:{t:02d}Z", "step": s, "code": c}) for j, t, s, c in rows))


def test_a_silent_job_ends_by_its_timer(rocks, tmp_path):
    folder, state = tmp_path / "signs", str(tmp_path / "state")
    say(folder, 1, ("a", 1, 5, None), ("a", 2, 4, None), ("b", 1, None, None), ("c", 2, 1, None))

    def run():
        got = live.run_available(watch.watched(signs(rocks, folder), 10_000), state=state).collect()
        return sorted((r.job, r.event, r.step, r.detail) for r in got)

    first = run()
    assert first == [("a", "progress", 5, None), ("a", "started", 5, None), ("b", "started", None, None), ("c", "progress", 1, None), ("c", "started", 1, None)]
    say(folder, 2, ("b", 6, 3, 0), ("c", 7, None, 2))  # restarted on its checkpoint
    assert run() == [("b", "done", 3, "0"), ("b", "progress", 3, None), ("c", "failed", 1, "2")]
    say(folder, 3, ("d", 40, 1, None))  # the watermark passes what a waited for
    got = run()
    assert ("a", "lost", 5, None) in got and not [x for x in got if x[0] in "bc"]


@pytest.fixture
def no_empty_batches(spark):
    """By processing time Spark always wants another batch, and availableNow wouldn't end."""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def test_an_answer_expires(rocks, no_empty_batches, tmp_path):
    folder, state = tmp_path / "asked", str(tmp_path / "state")
    folder.mkdir()

    def ask(n, answer, ttl=15_000):
        (folder / f"{n}.json").write_text(json.dumps({"question": "q", "answer": answer}))
        asked = rocks.readStream.schema("question string, answer string").json(str(folder))
        return [(r.answer, r.hit) for r in live.run_available(watch.cached(asked, ttl), state=state).collect()]

    began = time.time()
    assert ask(1, "x") == [("x", False)]
    second = ask(2, "y")
    assert second == [("x", True)] or time.time() - began > 15
    time.sleep(max(0.0, 16 - (time.time() - began)))
    assert ask(3, "z") == [("z", False)]


def test_a_gap_of_just_the_limit_is_one_burst(spark, tmp_path):
    rows = [(1, "v", 0), (1, "v", 48 * 3600), (1, "v", 96 * 3600 + 1), (2, "v", 5)]
    df = spark.createDataFrame(rows, "user_id int, event_type string, s long").select("user_id", "event_type", F.timestamp_seconds("s").alias("ts"))
    df.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    got = sorted((r.user_id, int(r.start_ts.timestamp()), r.n) for r in live.closed_bursts(stream, "48 hours", "1 hour").collect())
    assert [(u, n) for u, _, n in got] == [(1, 2), (1, 1), (2, 1)]
