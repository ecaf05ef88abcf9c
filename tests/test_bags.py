"""Recordings built here, read back: rows, push-down, damaged files."""

import sqlite3
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from rillflow.sources import bags


def text(s):
    return struct.pack("<I", len(s.encode())) + s.encode()


def record(code, body):
    return struct.pack("<BQ", code, len(body)) + body


def mcap(path, chunks, topics, method=""):
    """chunks: lists of (channel, seq, t, payload)."""
    heads = b"".join(record(3, struct.pack("<H", i + 1) + text(f"pkg/msg/K{i}") + text("ros2msg") + struct.pack("<I", 3) + b"int") for i in range(len(topics)))
    heads += b"".join(record(4, struct.pack("<HH", i + 1, i + 1) + text(t) + text("cdr") + struct.pack("<I", 0)) for i, t in enumerate(topics))
    out, index = bags.MAGIC + record(1, text("") + text("")), b""
    for messages in chunks:
        raw = b"".join(record(5, struct.pack("<HIQQ", c, s, t, t) + p) for c, s, t, p in messages)
        packed = zstandard.ZstdCompressor().compress(raw) if method == "zstd" else raw
        times = [m[2] for m in messages]
        body = struct.pack("<QQQI", min(times), max(times), len(raw), 0) + text(method) + struct.pack("<Q", len(packed)) + packed
        own = sorted({m[0] for m in messages})
        offsets = b"".join(struct.pack("<HQ", c, 0) for c in own)
        index += record(8, struct.pack("<QQQQI", min(times), max(times), len(out), len(body) + 9, len(offsets)) + offsets + struct.pack("<Q", 0) + text(method) + struct.pack("<QQ", len(packed), len(raw)))
        out += record(6, body)
    start = len(out)
    out += heads + index
    path.write_bytes(out + record(2, struct.pack("<QQI", start, 0, 0)) + bags.MAGIC)


def db3(path, rows, topics):
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE topics (id INTEGER PRIMARY KEY, name TEXT, type TEXT, serialization_format TEXT, offered_qos_profiles TEXT)")
        con.execute("CREATE TABLE messages (id INTEGER PRIMARY KEY, topic_id INTEGER, timestamp INTEGER, data BLOB)")
        con.executemany("INSERT INTO topics VALUES (?, ?, ?, 'cdr', '')", topics)
        con.executemany("INSERT INTO messages VALUES (?, ?, ?, ?)", rows)


@pytest.fixture
def folder(tmp_path):
    for d in ("one", "two", "three"):
        (tmp_path / d).mkdir()
    mcap(tmp_path / "one" / "a.mcap", [[(1, 0, 10, b"x"), (2, 0, 12, b"y")], [(1, 1, 20, b"z")], [(2, 1, 30, b"w" * 500)]], ["/a", "/b"], "zstd")
    db3(tmp_path / "two" / "b.db3", [(i, 1 + i % 2, i * 10, bytes([i])) for i in range(1, 8)], [(1, "/a", "sensor_msgs/msg/Image"), (2, "/c", "own/msg/Cmd")])
    (tmp_path / "two" / "b.mcap").write_bytes(b"not read: the folder has a .db3")
    mcap(tmp_path / "three" / "c.mcap", [[(1, 5, 11, b"q")]], ["/a"])
    return tmp_path


def test_rows_and_push_down(spark, folder, monkeypatch):
    df = bags.read_bags(spark, str(folder))
    rows = lambda d: sorted((r.bag.rpartition("/")[2], r.topic, r.seq, r.t, bytes(r.raw)) for r in d.collect())
    every = rows(df)
    assert len(every) == 4 + 7 + 1 and ("one", "/b", 1, 30, b"w" * 500) in every and ("two", "/c", 1, 10, b"\x01") in every
    assert {r.kind for r in df.where("topic = '/a'").collect()} == {"pkg/msg/K0", "sensor_msgs/msg/Image"}
    assert rows(df.where("topic = '/a' AND t >= 11 AND t < 41")) == [x for x in every if x[1] == "/a" and 11 <= x[3] < 41]
    assert rows(df.where(F.col("topic").isin("/b", "/c") & (F.col("t") > 30))) == [x for x in every if x[1] in ("/b", "/c") and x[3] > 30]
    assert rows(df.where("topic = '/nothing'")) == []
    # unwanted chunks and messages aren't read
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual

    reader = bags.BagReader(bags.files(str(folder)))
    assert list(reader.pushFilters([EqualTo(("topic",), "/a"), GreaterThanOrEqual(("t",), 15), EqualTo(("kind",), "k")])) == [EqualTo(("kind",), "k")]
    parts = [p for p in reader.partitions() if p.path.endswith(".mcap")]
    assert len(parts) == 1 and [x[4] for x in reader.read(parts[0])] == [20]
    monkeypatch.setattr(bags, "ROWS", 3)
    assert len([p for p in bags.BagReader([str(folder / "two" / "b.db3")]).partitions()]) == 3


def test_damaged_and_undefined(spark, folder):
    path = folder / "one" / "a.mcap"
    path.write_bytes(path.read_bytes()[:-20])
    with pytest.raises(ValueError, match="footer"):
        bags.summary(str(path))
    good = str(folder / "two" / "b.db3")
    assert bags.intact(good)
    (folder / "bad.db3").write_bytes(b"SQLite format 3\x00" + b"\x07" * 3000)
    assert not bags.intact(str(folder / "bad.db3"))
    with pytest.raises(ValueError, match="own/msg/Cmd"):
        bags.definitions(good)
    assert bags.definitions(good, {"own/msg/Cmd": "float64 x"})["own/msg/Cmd"] == "float64 x"
    assert bags.definitions(str(folder / "three" / "c.mcap")) == {"pkg/msg/K0": "int"}
    empty = folder / "none"
    empty.mkdir()
    assert bags.read_bags(spark, str(empty)).count() == 0


def stamped(ms, values=(), names=None):
    """A message: header, then a joint message (``names``) or plain doubles."""
    out = bytearray(b"\x00\x01\x00\x00" + struct.pack("<II", ms // 1000, ms % 1000 * 1_000_000) + struct.pack("<I", 1) + b"\x00")

    def align(n):
        out.extend(b"\x00" * (-(len(out) - 4) % n))

    if names is not None:
        align(4)
        out.extend(struct.pack("<I", len(names)))
        for n in names:
            align(4)
            out.extend(struct.pack("<I", len(n) + 1) + n.encode() + b"\x00")
    for part in ([values, [], []] if names is not None else [values]):
        if names is not None:
            align(4)
            out.extend(struct.pack("<I", len(part)))
        if part:
            align(8)
            out.extend(struct.pack(f"<{len(part)}d", *part))
    return bytes(out)


def test_a_bag_is_aligned_by_its_profile(spark, tmp_path):
    """From the file to control rows: joints come in another order than the profile's, the gripper without header."""
    import json

    from rillflow.operators.profiled import align
    from rillflow.sources.config import alignment
    from rillflow.sources.profiles import load_profile

    arm = {"joint_states_topic": "/s", "joint_names": ["x", "y"], "command_topics": ["/c"], "command_dim": 2}
    effector = {"name": "G", "kind": "gripper", "dim": 1, "command_topic": "/g", "command_kind": "float32"}
    profile = load_profile(json.dumps({"name": "p", "arm": arm, "cameras": {"head": "/h"}, "end_effectors": [effector]}))
    rows, n = [], 0
    for ms in range(1000, 1500, 50):
        every = [("/s", stamped(ms, [ms / 100, -1.0], ["y", "x"])), ("/g", b"\x00\x01\x00\x00" + struct.pack("<f", 0.5)), ("/junk", b"?")]
        every += [("/h", stamped(ms))] if ms % 100 == 0 else []
        every += [("/c", stamped(ms + 5, [1.0, 2.0]))] if ms >= 1100 else []
        for topic, raw in every:
            n += 1
            rows.append((n, {"/s": 1, "/g": 2, "/h": 3, "/c": 4, "/junk": 5}[topic], (ms + 5) * 1_000_000, raw))
    (tmp_path / "bag").mkdir()
    db3(tmp_path / "bag" / "b.db3", rows, [(1, "/s", "j"), (2, "/g", "f"), (3, "/h", "i"), (4, "/c", "c"), (5, "/junk", "u")])
    msgs = bags.decoded(bags.read_bags(spark, str(tmp_path)), profile)
    settings = alignment({"mode": "capture", "fps": 10, "invalid_frame_policy": "drop", "action_tolerance_ms": 60})
    out, status = align(msgs, profile, settings)
    got = sorted(((r.t // 1_000_000, list(r.state), list(r.action)) for r in out.collect()))
    assert status.collect()[0].status == "converted"
    assert got == [(ms, [-1.0, ms / 100, 0.5], [1.0, 2.0, 0.5]) for ms in (1100, 1200, 1300, 1400)]
    bad = bags.decoded(bags.read_bags(spark, str(tmp_path)), load_profile(json.dumps({"name": "p", "arm": arm | {"joint_names": ["x", "z"]}, "cameras": {"head": "/h"}})))
    assert {r.topic for r in bad.where("values IS NULL").select("topic").distinct().collect()} == {"/h", "/s"}
