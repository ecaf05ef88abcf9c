"""Operators against small models on edge cases."""

import os
import random
import struct

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from rillflow.functions import cdr, frames, logs
from rillflow.operators import align, buckets, cuts, qc
from rillflow.operators.buckets import spread
from rillflow.operators.asof import asof, interpolated, nearest
from rillflow.operators.quantiles import grouped, quantiles
from rillflow.operators.sequence import bursts, first_of_equal, islands, numbered, previous, running_sum, segments, velocity_of
from rillflow.plans import registry
from rillflow.plans.training_logs import latest_state, states
from rillflow.sources import sinks


def tables(spark, seed):
    r = random.Random(seed)
    source = [(b, r.randrange(0, 60), i, float(i)) for b in (1, 2) for i in range(r.randrange(0, 25))]
    ticks = [(b, k, r.randrange(-5, 65)) for b in (1, 2, 3) for k in range(20)]
    return ticks, source, spark.createDataFrame(ticks, "b int, k int, t long"), spark.createDataFrame(source or [(9, 0, 0, 0.0)], "b int, t long, seq int, v double")


def test_asof_directions_with_duplicates(spark, monkeypatch):
    for seed, most in ((1, 10**9), (2, 10**9), (1, 4), (2, 4)):
        monkeypatch.setattr(buckets, "ROWS", most)
        ticks, source, left, right = tables(spark, seed)
        for direction, strict in (("backward", False), ("backward", True), ("forward", False)):
            got = {(x.b, x.k): x.src and (x.src.t, x.src.seq) for x in asof(left, right, ["b"], ["v"], direction=direction, strict=strict).collect()}
            for b, k, t in ticks:
                own = [(s[1], s[2]) for s in source if s[0] == b]
                if direction == "forward":
                    fit = [s for s in own if s[0] >= t]
                    want = min(fit) if fit else None
                else:
                    fit = [s for s in own if (s[0] < t if strict else s[0] <= t)]
                    want = max(fit) if fit else None
                assert got[b, k] == want


def test_nearest_and_interpolation(spark):
    ticks, source, left, right = tables(spark, 3)
    near = {(x.b, x.k): x.src and x.src.t for x in nearest(left, right, ["b"], []).collect()}
    line = {(x.b, x.k): x.y for x in interpolated(left, right, ["b"], "v", 5, "y").collect()}
    for b, k, t in ticks:
        own = sorted((s[1], s[2], s[3]) for s in source if s[0] == b)
        want = min(own, key=lambda s: (abs(s[0] - t), s[0])) if own else None
        assert near[b, k] == (want and want[0])
        before, after = [s for s in own if s[0] <= t], [s for s in own if s[0] >= t]
        if before and before[-1][0] == t:
            assert line[b, k] == before[-1][2]
        elif before and after and t - before[-1][0] <= 5 and after[0][0] - t <= 5:
            p, n = before[-1], after[0]
            assert abs(line[b, k] - (p[2] + (t - p[0]) / (n[0] - p[0]) * (n[2] - p[2]))) < 1e-9
        else:
            assert line[b, k] is None


def test_islands_and_bursts(spark, monkeypatch):
    flags = [k in (0, 1, 4, 6) for k in range(7)]
    rows = spark.createDataFrame([(1, k, k * 10, f) for k, f in enumerate(flags)] + [(2, 0, 5, False)], "b int, k int, t long, f boolean")
    for most in (10**9, 2):
        monkeypatch.setattr(buckets, "ROWS", most)
        got = sorted((x["first"], x["last"], x.seg, x.end_us - x.start_us) for x in segments(islands(rows, ["b"], "f", "k"), ["b"]).collect())
        assert got == [(0, 1, 0, 10), (4, 4, 1, 0), (6, 6, 2, 0)]
    stream = spark.createDataFrame([(1, 0, 0), (1, 10, 1), (1, 21, 2), (2, 5, 0)], "b int, t long, seq int")
    for most in (10**9, 1):
        monkeypatch.setattr(buckets, "ROWS", most)
        got = sorted((x.b, x.start_us, x.end_us, x.n) for x in bursts(stream, ["b"], 10).collect())
        assert got == [(1, 0, 10, 2), (1, 21, 21, 1), (2, 5, 5, 1)]


def test_ordered_helpers_across_buckets(spark, monkeypatch):
    """Previous rows, sums and numbers of keys cut into many buckets, null keys included, against a plain loop."""
    r = random.Random(4)
    rows = [(r.choice([1, 1, 1, 2, None]), r.randrange(0, 90), i, r.choice([None, 1, 2]), r.random() < 0.3) for i in range(300)]
    df = spark.createDataFrame(rows, "b int, t long, seq long, v long, ok boolean").repartition(5)
    before, total, place = {}, {}, {}
    for b in (1, 2, None):
        last, last_ok, sum_, n = None, None, 0, 0
        for x in sorted((x for x in rows if x[0] == b), key=lambda x: (x[1], x[2])):
            before[x[2]] = (last, last_ok)
            last, last_ok = (x[1], x[3]), (x[1], x[3]) if x[4] else last_ok
            sum_ += x[3] or 0
            total[x[2]], place[x[2]] = sum_, n
            n += 1
    tup = lambda s: s and tuple(s)
    for most in (9, 10**9):
        monkeypatch.setattr(buckets, "ROWS", most)
        assert spread(df, ["b"]).split == (most == 9)
        got = previous(df, ["b"], ["t", "v"], {"p": None, "q": df.ok}).collect()
        assert {x.seq: (tup(x.p), tup(x.q)) for x in got} == before
        assert {x.seq: x.s or 0 for x in running_sum(df, ["b"], "v", "s").collect()} == total
        assert {x.seq: x.v for x in numbered(df, ["b"], "v").collect()} == place
    assert {x.seq for x in first_of_equal(spark.createDataFrame([(1, i, i, s) for i, s in enumerate([5, 5, 7, 5])], "b int, t long, seq long, s long"), ["b"], "s").collect()} == {0, 2, 3}


def test_a_minute_with_a_third_of_all_rows_spreads(spark, monkeypatch):
    """One recording of a minute has a third of the messages, most of them in one second; no bucket holds many of them."""
    r = random.Random(6)
    dense = [(1, 30_000_000 + int(r.random() ** 4 * 60e6), i) for i in range(4000)]
    rows = dense + [(2 + i % 40, r.randrange(10**15), 4000 + i) for i in range(8000)]
    df = spark.createDataFrame(rows, "b int, t long, seq long").repartition(6)
    monkeypatch.setattr(buckets, "ROWS", 100)
    found = spread(df, ["b"])
    limit = 12_000 // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    sizes = found.place(df).groupBy("b", "_b").count().collect()
    assert max(x["count"] for x in sizes) <= 1.5 * limit and len([x for x in sizes if x.b == 1]) >= 5
    assert all(x["_b"] == 0 for x in sizes if x.b != 1)
    order = found.place(df).where("b = 1").orderBy("t").collect()
    assert [x["_b"] for x in order] == sorted(x["_b"] for x in order)
    got = {x.seq: x.n for x in numbered(df, ["b"], "n").collect()}
    for b in (1, 7):
        assert [got[x[2]] for x in sorted((x for x in rows if x[0] == b), key=lambda x: (x[1], x[2]))] == list(range(sum(x[0] == b for x in rows)))


def test_window_anchor_and_silent_streams(spark):
    """By hand: the newest frame before the command opens the window; a silent command stream matters to holding only."""

    def bounds(policy, *streams):
        rows = [(1, topic, t, i) for topic, times in streams for i, t in enumerate(times)]
        got = align.window_bounds(spark.createDataFrame(rows, "bag_id int, topic string, t long, seq long"), policy).collect()
        return got and (got[0].anchor_us, got[0].start_us, got[0].end_us)

    view, click = ("view", [0, 30, 60, 90]), ("click", [5, 20, 95])
    assert bounds("joint-state-fill", view, click, ("purchase", [40, 80])) == (30, 30, 80)
    assert bounds("hold-last-command", view, click, ("purchase", [40, 80])) == []
    assert bounds("hold-last-command", view, click, ("purchase", [40, 80]), ("signup", [10, 70])) == (30, 30, 70)
    assert bounds("joint-state-fill", view, click, ("purchase", [40, 80]), ("signup", [10, 70])) == (0, 5, 80)
    assert bounds("joint-state-fill", view, click, ("purchase", [40, 80]), ("error", [50, 75])) == (30, 50, 75)  # an optional stream counts if recorded
    assert bounds("joint-state-fill", ("view", [50, 90]), click, ("purchase", [40, 80])) == (40, 50, 80)  # no frame before the command
    assert bounds("joint-state-fill", view, ("purchase", [40, 80])) == [] and bounds("joint-state-fill", view, click, ("purchase", [40])) == []


def test_header_timeline(spark):
    """By hand: headers every 10 that arrive in bursts; without valid headers, or in a stream that has none, receive times count."""
    rows = [(1, "view", t, i, h) for i, (t, h) in enumerate([(100, 10), (101, 20), (102, 0), (150, 40), (151, 50)])]
    rows += [(1, "error", t, i, t - 5) for i, t in enumerate([100, 120, 160])] + [(1, "click", t, i, 0) for i, t in enumerate([100, 140])]
    msgs = spark.createDataFrame(rows, "bag_id int, topic string, t long, seq long, h long")
    got = {r.topic: r for r in qc.timelines(qc.stepped(msgs)).collect()}
    assert (got["view"].source, got["view"].m, got["view"].active, got["view"].mid, got["view"].most, got["view"].receive_most) == ("header", 4, 40, 10, 20, 48)
    assert (got["error"].source, got["error"].active, got["error"].mid, got["error"].invalid_headers) == ("receive", 60, 30, 0)
    assert (got["click"].source, got["click"].mid, got["click"].invalid_headers) == ("receive", 40, 2)
    drop = {r.topic: (r.gap_count, r.est_drops, r.drop_ratio) for r in qc.drops(msgs, ("view", "click", "error")).collect()}
    assert drop["view"] == (1, 1, 0.2) and drop["error"] == (0, 0, 0.0)
    claims = spark.createDataFrame([(1, "view", True), (1, "lidar", True), (1, "depth", False), (1, "error", False)], "bag_id int, topic string, required boolean")
    status = {r.topic: r.status for r in qc.stream_status(msgs, claims, ("view", "error"), 0.01, 0.05).collect()}
    assert status == {"view": "FAIL", "lidar": "FAIL", "depth": "SKIP", "error": "PASS"}


def test_teleop_and_sync(spark):
    def report(policy, a, b):
        rows = [(1, topic, t, i) for topic, times in (("purchase", a), ("signup", b)) for i, t in enumerate(times)]
        r = qc.teleop_report(spark.createDataFrame(rows, "bag_id int, topic string, t long, seq long"), ("purchase", "signup"), 20, policy).first()
        return r.overlap_us, r.status, r.issue

    assert report("hold-last-command", [0, 10, 20], [5, 15, 25]) == (15, "PASS", None)
    assert report("hold-last-command", [0, 10], [20, 30]) == (-10, "FAIL", "spans_do_not_overlap")
    assert report("hold-last-command", [0, 60], [5, 15, 25, 35, 45]) == (40, "FAIL", "silent_across_overlap")
    assert report("joint-state-fill", [0, 60], [5, 15, 25, 35, 45])[1] == "WARN"
    assert report("hold-last-command", [0, 30, 60, 90], [0, 10, 20, 30, 45, 60, 75, 90]) == (90, "WARN", "command_gap")
    assert report("hold-last-command", [0, 60], [5]) == (None, "FAIL", "command_stream_missing")
    rows = [(1, "view", 0, 0, 100), (1, "view", 0, 1, 200), (1, "view", 0, 2, 0), (1, "click", 0, 3, 130), (1, "click", 0, 4, 190)]
    sync = qc.sync_report(spark.createDataFrame(rows, "bag_id int, topic string, t long, seq long, h long"), "view", ("click", "signup"), 0.02)
    assert {r.target: (r.max_ms, r.status) for r in sync.collect()} == {"click": (0.03, "WARN"), "signup": (None, "SKIP")}


def test_velocity_edges(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, 3.0), (2, 0, 5.0)], "b int, k int, v double")
    got = {(x.b, x.k): x.w for x in velocity_of(df, ["b"], ["k"], "v", 10.0, "w").collect()}
    assert got == {(1, 0): 20.0, (1, 1): 20.0, (2, 0): 0.0}


def test_running_state_moves_forward_only():
    state = {"step": 0, "total": None, "eta": None, "loss": None}
    rows = [(1234, 10000, 270, None, None), (None, None, None, 1000, 0.3), (100, 10000, None, None, None)]
    assert latest_state(iter(rows[:2]), dict(state)) == {"step": 1234, "total": 10000, "eta": 270, "loss": 0.3}
    assert latest_state(iter(rows), dict(state))["step"] == 100


def test_progress_line(spark):
    df = spark.createDataFrame([("Training:  10%|#  | 100/1000 [01:00<04:30, 1.0step/s]",), ("nothing",)], "line string")
    got = df.select(*[c.alias(k) for k, c in logs.progress(df.line).items()]).collect()
    assert tuple(got[0]) == (100, 1000, 270) and tuple(got[1]) == (None, None, None)


def plain_ssim(a, b):
    """Window by window, with weights of a Gaussian and mirrored borders."""
    taps = np.exp(-(np.arange(-5, 6) ** 2) / (2 * 1.5**2))
    weights = np.outer(taps, taps) / taps.sum() ** 2
    pa, pb = (np.pad(x.astype(float), 5, mode="reflect") for x in (a, b))
    scores = []
    for y in range(a.shape[0]):
        for x in range(a.shape[1]):
            u, v = pa[y : y + 11, x : x + 11], pb[y : y + 11, x : x + 11]
            mu, mv = (weights * u).sum(), (weights * v).sum()
            su, sv, c = (weights * u * u).sum() - mu * mu, (weights * v * v).sum() - mv * mv, (weights * u * v).sum() - mu * mv
            scores.append((2 * mu * mv + 6.5025) * (2 * c + 58.5225) / ((mu * mu + mv * mv + 6.5025) * (su + sv + 58.5225)))
    return np.mean(scores)


def test_ssim_against_windows():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 256, (2, 14, 16)), r.integers(0, 256, (2, 14, 16))
    assert np.allclose(frames.ssim(a, b), [plain_ssim(x, y) for x, y in zip(a, b, strict=True)]) and np.allclose(frames.ssim(a, a), 1.0)
    three = np.stack([a, b, a], axis=-1)
    assert np.allclose(frames.ssim(three, np.stack([a, a, b], axis=-1)), np.mean([np.ones(2), frames.ssim(b, a), frames.ssim(a, b)], axis=0))


def test_resizing():
    out = frames.letterbox(np.ones((1, 8, 8)), 12, 20)
    assert out.shape == (1, 12, 20) and out.sum() == 144 and out[0, 0, 4] == 1 and out[0, 0, 3] == 0
    r = np.random.default_rng(2)
    a = r.integers(0, 256, (2, 5, 7, 3)).astype(np.uint8)
    got = frames.bilinear(a, 9, 4)
    for y in range(9):
        for x in range(4):
            sy, sx = (y + 0.5) * 5 / 9 - 0.5, (x + 0.5) * 7 / 4 - 0.5
            y0, x0 = int(np.floor(sy)), int(np.floor(sx))
            pick = lambda i, j: a[:, min(max(i, 0), 4), min(max(j, 0), 6)].astype(float)
            top = pick(y0, x0) * (1 - (sx - x0)) + pick(y0, x0 + 1) * (sx - x0)
            low = pick(y0 + 1, x0) * (1 - (sx - x0)) + pick(y0 + 1, x0 + 1) * (sx - x0)
            assert (got[:, y, x] == np.floor(top * (1 - (sy - y0)) + low * (sy - y0) + 0.5)).all()
    assert (frames.bilinear(a, 5, 7) == a).all() and frames.letterbox(a, 10, 10, frames.bilinear).shape == (2, 10, 10, 3)
    assert (frames.crop(a, 1, 2, 4, 5) == a[:, 2:5, 1:4]).all()


def test_frame_queries_against_plain_numpy(spark):
    e = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()}
    tile = lambda v, n: np.clip(np.rint(128 + 40 * np.resize(v, n * n)), 0, 255).reshape(n, n)
    for r in registry.queries()["ssim"](spark, DATA).where("vec_id < 12").collect():
        a = tile(e[r.vec_id], 16)
        assert abs(r.ssim - plain_ssim(a, np.roll(a, 1, axis=1))) < 1e-6
    for r in registry.queries()["crop_resize"](spark, DATA).where("vec_id < 40").collect():
        a = tile(e[r.vec_id], 8)
        rows = np.minimum((np.arange(12) * 8 / 12).astype(int), 7)
        big = a[rows][:, rows]
        assert (r.pixels, r.total) == ((big > 0).sum(), big.sum()) and abs(r.middle - frames.bilinear(a[None, 2:6, 2:6], 6, 6).sum()) < 1e-4


def test_messages_and_markers(spark):
    raw = cdr.joint_state(["a", "bb"], [1.0, 2.0], [0.0, 0.5])
    head = cdr.header(7, 5, True, "base")
    command = head + b"\0" * (-(len(head) - 4) % 8) + struct.pack("<2d", 1.5, -2.0)
    values = struct.pack("<4xI", 1) + struct.pack("<I2s2xIII", 2, b"x\0", 3, 3, 0) + struct.pack("<I3f", 3, 1.0, 2.0, 3.0)
    values = b"\0\1\0\0" + values[4:]
    rows = [(0, raw, command, b"\0\1\0\0" + struct.pack("<f", 2.5), values), (1, raw + b"zz", command[:-1], b"\0\1\0\0\0", values[:-2]), (2, b"\0\1", None, None, None), (3, None, None, None, b"")]
    df = spark.createDataFrame([(i, *[x if x is None else bytearray(x) for x in r]) for i, *r in rows], "i int, joint binary, command binary, one binary, many binary")
    got = df.select("i", cdr.parse_joint_state()("joint").alias("j"), cdr.parse_joint_command(2)("command").alias("c"), cdr.parse_float()("one").alias("f"), cdr.parse_float_array()("many").alias("m")).orderBy("i").collect()
    assert got[0].j.asDict() == {"stamp_ns": 1_000_000_002, "name": ["a", "bb"], "position": [1.0, 2.0], "velocity": [0.0, 0.5], "effort": [], "trailing": 0}
    assert got[1].j.position == [1.0, 2.0] and got[1].j.trailing == 2 and got[2].j.name is None and got[3].j.name is None
    assert (got[0].c.stamp_ns, got[0].c.position) == (7_000_000_005, [1.5, -2.0]) and got[1].c.position is None
    assert got[0].f.value == 2.5 and got[1].f.value is None and got[0].m.data == [1.0, 2.0, 3.0] and got[1].m.data is None and got[3].m.data is None
    parsed = df.select(cdr.parse_joint_state()("joint").alias("j"))
    assert tuple(parsed.agg(*cdr.decode_report(parsed.j)).first()) == (4, 2, 1)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x10\x00\x10\x03\x01\x22\x00\x02\x11\x01\x03\x11\x01"
    df = spark.createDataFrame([(bytearray(jpeg),), (bytearray(b"\xff\xd8"),), (None,)], "raw binary")
    assert [r[0] for r in df.select(frames.jpeg_subsampling("raw")).collect()] == ["4:2:0", "unknown", "unknown"]


def test_raw_images(spark):
    rows = [(bytearray(np.array([1000, 0], "<u2").tobytes()), "16UC1"), (bytearray(np.array([1.5, -1, np.nan], "<f4").tobytes()), "32FC1"), (None, "16UC1"), (bytearray(b"abc"), "mono16"), (bytearray(b"ab"), "jpeg")]
    got = spark.createDataFrame(rows, "raw binary, kind string").select(frames.depth_metres("raw", "kind").alias("d")).collect()
    assert np.allclose(got[0].d, [1, 0]) and np.allclose(got[1].d, [1.5, 0, 0]) and [g.d for g in got[2:]] == [None, None, None]
    rows = [
        (bytearray(b"RGBrgb--XYZxyz--"), "rgb8", 2, 2, 8), (bytearray(b"BGRbgr"), "bgr8", 1, 2, 0), (bytearray(b"BGRA"), "bgra8", 1, 1, 0), (bytearray(b"ab"), "mono8", 1, 2, 0),
        (bytearray(b"abc"), "rgb8", 1, 2, 0), (bytearray(b"abc"), "yuv", 1, 1, 0), (None, "rgb8", 1, 1, 0), (bytearray(b"abc"), "rgb8", 0, 1, 0),
    ]
    df = spark.createDataFrame(rows, "raw binary, kind string, h int, w int, step int")
    got = [r[0] and bytes(r[0]) for r in df.select(frames.colour_image("raw", "kind", "h", "w", "step")).collect()]
    assert got == [b"RGBrgbXYZxyz", b"RGBrgb", b"RGB", b"aaabbb", None, None, None, None]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, True), (1, 1, False)], "bag_id int, k int, hold boolean")
    sinks.write_episodes(rows, str(tmp_path / "e"), codec="gzip")
    back = spark.read.parquet(str(tmp_path / "e"))
    assert back.count() == 2 and "timestamp" in back.columns
    assert sinks.manifest(rows, {"mode": "loop"}).collect()[0].manifest == '{"rows":2,"held":1,"mode":"loop"}'
    assert sinks.same_schema(rows, rows.drop("hold")) == ["hold"]
    msgs = spark.createDataFrame([("a", b"1"), ("b", b"2")], "topic string, raw binary")
    assert {(r.topic, bytes(r.raw)) for r in sinks.rewrite_topic(msgs, "a", "new", F.lit(b"x")).collect()} == {("new", b"x"), ("b", b"2")}
    eps = spark.createDataFrame([(1, 30, 7, 7, ["h", "w"]), (2, 30, 7, 7, ["w", "h"]), (3, 20, 7, 8, ["h"])], "bag_id int, fps int, state_dim int, action_dim int, cameras array<string>")
    assert [(r.bag_id, r.what) for r in sinks.differing(eps).collect()] == [(3, "action_dim,cameras,fps")]


def test_batch_conversion(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "bag_id int, k int")
    status = spark.createDataFrame([(1, "converted", None), (2, "failed", "too_few_frames")], "bag_id int, status string, error string")
    out = str(tmp_path / "set")
    got = {r.bag_id: r.manifest for r in sinks.convert(rows, status, out).collect()}
    assert got == {1: '{"bag_id":1,"status":"converted"}', 2: '{"bag_id":2,"status":"failed","error":"too_few_frames"}'}
    assert spark.read.parquet(f"{out}/data").count() == 2 and spark.read.json(f"{out}/meta/conversion").count() == 2
    with pytest.raises(ValueError, match="recording 2: too_few_frames"):
        sinks.convert(rows, status, str(tmp_path / "other"), on_error="fail")
    with pytest.raises(ValueError, match="no recording"):
        sinks.convert(rows, status.where("bag_id = 2"), str(tmp_path / "other"))
    assert not (tmp_path / "other").exists()


def test_stream_state(spark, tmp_path):
    """Lines count in the order of their files; a stream without files gives an empty table."""
    from rillflow.streaming import live

    folder = tmp_path / "logs" / "j"
    folder.mkdir(parents=True)
    assert live.run_available(live.metric_states(live.tail(spark, str(tmp_path / "logs"))), "update").count() == 0
    for i, text in enumerate(["INFO step:10 loss:0.5\nTraining:  1%|#| 20/100 [00:01<00:30, 1step/s]\n", "Training:  2%|#| 15/100 [00:01<00:20, 1step/s]\nINFO step:12 loss:0.4\n"]):
        (folder / f"{i}.txt").write_text(text)
        os.utime(folder / f"{i}.txt", (1000 + i, 1000 + i))
    lines = live.tail(spark, str(tmp_path / "logs"))
    got = live.run_available(live.metric_states(lines), "update").collect()
    assert [(r.job, r.step, r.total, r.eta_s, r.loss) for r in got] == [("j", 15, 100, 20, 0.4)]
    for _ in range(2):  # what was read isn't written again
        live.log_sink(lines, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 4


def test_states_by_aggregation(spark):
    """Aggregated states against the fold, line by line."""
    r = random.Random(6)
    rows = []
    for job in range(30):
        for pos in range(r.randrange(1, 25)):
            kind = r.randrange(4)
            bar = f"Training:  1%|#| {r.randrange(90)}/{r.choice([0, 50, 100])} [00:01<{r.choice(['00:30', '?', '1:00:05'])}, 1step/s]"
            rows.append((f"j{job}", pos, [bar, f"INFO step:{r.randrange(90)} loss:{r.choice(['0.5', 'x', '0.25'])}", "INFO step:2K loss:1.0", "note"][kind]))
    df = spark.createDataFrame(rows, "job string, pos long, line string")
    c = F.col("line")
    each = df.select("job", "pos", *[v.alias(k) for k, v in logs.progress(c).items()], *[v.alias(k) for k, v in logs.metrics(c).items() if k in ("step", "loss")]).orderBy("pos").collect()
    want = {}
    for x in each:
        want[x.job] = latest_state(iter([(x.bar_step, x.bar_total, x.eta_s, x.step, x.loss)]), want.get(x.job, {"step": 0, "total": None, "eta": None, "loss": None}))
    got = {x.job: {"step": x.step, "total": x.total, "eta": x.eta_s, "loss": x.loss} for x in states(df).collect()}
    assert got == want


def test_intermediate_tables(spark):
    df = cuts.cut(spark.range(5))
    path = df._cut_path
    assert df.count() == 5 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") != "true"
    cuts.drop(df, spark.range(2))
    assert not os.path.exists(path.removeprefix("file://"))
    one = cuts.cut(spark.range(3))
    cuts.clear(spark)
    assert not os.path.exists(one._cut_path.removeprefix("file://"))


def test_quantiles_of_large_groups(spark):
    """Narrowed groups give what Spark's percentile gives: ties, outliers, tiny spans, null keys, NaN."""
    r = random.Random(12)
    rows = [(r.choice([1, 1, 1, 2, None]), r.choice([r.gauss(0, 1), r.expovariate(1e-6), 5.0, -1e300, 1e-300 * r.random(), None])) for _ in range(3000)]
    rows += [(3, 7.0)] * 500 + [(4, None)] * 3 + [(5, float("nan")), (5, 2.0), (6, 0.0), (6, 1.0)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(4)
    points = {"a": 0.0, "b": 0.05, "m": 0.5, "c": 0.95, "z": 1.0}
    plain = df.where("v IS NOT NULL AND NOT isnan(v)").groupBy("g").agg(*[F.percentile("v", p).alias(n) for n, p in points.items()])
    want = sorted(map(repr, map(tuple, plain.collect())))
    assert sorted(map(repr, map(tuple, quantiles(df, ["g"], "v", points, most=20).collect()))) == want
    assert sorted(map(repr, map(tuple, quantiles(df, ["g"], "v", points).collect()))) == want
    both = grouped(df, ["g"], [F.count("*").alias("n")], {"m": (F.col("v"), 0.5), "k": (F.col("v") * 2, 0.5)}, most=20).collect()
    assert {x.g: x.n for x in both} == {g: sum(y[0] == g for y in rows) for g in (1, 2, None, 3, 4, 5, 6)}
    assert all(x.k == 2 * x.m for x in both if x.g == 3) and [x.m for x in both if x.g == 4] == [None]
