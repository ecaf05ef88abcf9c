"""Alignment from profiles: golden rows made by hand on each clock, and what keeps recordings from converting."""

import json

import pytest

from rillflow.operators.profiled import Alignment, align
from rillflow.sources.config import alignment, chosen_profile, layered, limits, load_recipe, name_and_topic
from rillflow.sources.profiles import load_profile

ARM = {"joint_states_topic": "/s", "joint_names": ["x", "y"], "command_topics": ["/c"], "command_dim": 2}
ONE = {"name": "one", "arm": ARM, "cameras": {"head": "/h"}}
BASE = 5000
SCHEMA = "bag_id int, topic string, seq long, t long, h long, values array<double>, velocities array<double>"


def run(spark, rows, profile, settings):
    """rows: (topic, t, h, values, velocities) of recording 1, in order; a millisecond is one tick of time."""
    floats = lambda x, i: [float(v) for v in x[i]] if len(x) > i and x[i] is not None else None
    # 0 would be a header that was never set
    numbered = [(1, x[0], i, x[1] + BASE, None if x[2] is None else x[2] + BASE, floats(x, 3), floats(x, 4)) for i, x in enumerate(rows)]
    out, status = align(spark.createDataFrame(numbered, SCHEMA).repartition(3), load_profile(json.dumps(profile)), alignment(settings), 1)
    got = status.collect()
    return sorted(out.withColumn("t", out.t - BASE).collect(), key=lambda r: r.frame), got[0] if got else None


def test_capture_clock_by_hand(spark):
    """Header stamps 1000 before receipt; state between its neighbours, an exact stamp itself; nearest image; next command in reach."""
    images = [("/h", t + 1000, t) for t in (0, 100, 200, 300)]
    states = [("/s", t + 1000, t, [t / 10, -t / 10], [1.0, 2.0]) for t in (-20, 50, 100, 180, 260, 320)]
    commands = [("/c", t + 1000, t, [t, 1.0]) for t in (90, 130, 240, 330)]
    settings = {"mode": "capture", "fps": 10, "state_tolerance_ms": 100, "action_tolerance_ms": 45, "invalid_frame_policy": "drop"}
    rows, status = run(spark, images + states + commands, ONE, settings)
    # the window opens at the newest frame (0) at the first command (90), ends with the last frame (300); frame 300 has state between 260 and 320
    assert [(r.t, list(r.state), list(r.action), r.hold) for r in rows] == [
        (0, [0.0, 0.0], [90.0, 1.0], True), (100, [10.0, -10.0], [130.0, 1.0], False), (200, [20.0, -20.0], [240.0, 1.0], False), (300, [30.0, -30.0], [330.0, 1.0], False),
    ]
    assert [list(r.velocity) for r in rows] == [[1.0, 2.0]] * 4 and (status.status, status.kept, status.held) == ("converted", 4, 1)
    assert [r.images["head"]["t"] - BASE for r in rows] == [0, 100, 200, 300]


def test_loop_clock_by_hand(spark):
    """The same kind of recording by receipt: what was last there before the tick; headers don't matter."""
    images = [("/h", t, 7) for t in (0, 100, 200, 300)]
    states = [("/s", t, None, [t / 10, 0.5]) for t in (-20, 50, 90, 180, 260, 320)]
    commands = [("/c", t, 5, [t, 1.0]) for t in (90, 130, 240, 330)]
    settings = {"mode": "lerobot-loop", "fps": 10, "state_tolerance_ms": 60, "action_tolerance_ms": 45, "invalid_frame_policy": "drop", "max_tick_rate_deviation": 0.01}
    rows, _ = run(spark, images + states + commands, ONE, settings)
    assert [(r.t, list(r.state)) for r in rows] == [(0, [-2.0, 0.5]), (100, [9.0, 0.5]), (200, [18.0, 0.5]), (300, [26.0, 0.5])]
    # velocities weren't measured: differences of kept rows at 10 a second, the first frame has the second's
    assert [round(r.velocity[0], 3) for r in rows] == [110.0, 110.0, 90.0, 80.0]
    off, status = run(spark, images + states + commands, ONE, settings | {"fps": 12})
    assert not off and status.error == "tick_rate_off"
    tight, status = run(spark, images + states + commands, ONE, settings | {"state_tolerance_ms": 15})
    assert [r.t for r in tight] == [100] and status.invalid == 3
    refused, status = run(spark, images + states + commands, ONE, settings | {"state_tolerance_ms": 15, "invalid_frame_policy": "fail"})
    assert not refused and status.error == "invalid_rows"


TWO = {
    "name": "two", "cameras": {"head": "/m", "left": "/m"}, "camera_tiles": {"head": {"right": 0.5}, "left": {"left": 0.5}}, "anchor_camera": "left",
    "arm": {"joint_states_topic": "/s", "joint_names": ["a", "b"], "command_topics": ["/c", "/d"], "command_dim": 1},
    "end_effectors": [{"name": "G", "kind": "gripper", "dim": 1, "command_topic": "/g", "command_kind": "float32"}, {"name": "H", "kind": "dexhand", "dim": 2, "command_topic": "/k", "state_topic": "/f"}],
}


def test_silent_arm_effectors_and_shared_images(spark):
    """A silent arm repeats its measured joint; a gripper without feedback echoes its command, a hand that was never commanded its state."""
    rows = [("/m", t, t) for t in range(0, 500, 100)] + [("/s", t, t, [t / 1.0, t / 2.0]) for t in range(0, 500, 20)]
    rows += [("/c", t, t, [9.0]) for t in (100, 200, 300, 400)] + [("/g", t, None, [t / 100]) for t in range(0, 500, 50)] + [("/f", t, t, [t, 1.0]) for t in range(0, 500, 50)]
    settings = {"mode": "lerobot-loop", "fps": 10, "action_gap_policy": "joint-state-fill", "missing_topic_policy": "fill", "invalid_frame_policy": "drop"}
    got, status = run(spark, rows, TWO, settings)
    assert [(r.t, list(r.state), list(r.action)) for r in got] == [(t, [t, t / 2, t / 100, t, 1.0], [9.0, t / 2, t / 100, t, 1.0]) for t in (100, 200, 300, 400)]
    assert all(r.images["head"] == r.images["left"] for r in got) and status.status == "converted"
    for policy, why in (({"missing_topic_policy": "fail"}, "missing_topic"), ({"action_gap_policy": "hold-last-command", "missing_topic_policy": "fail"}, "missing_topic")):
        assert run(spark, rows, TWO, settings | policy)[1].error == why
    assert run(spark, [x for x in rows if x[0] != "/s"], TWO, settings)[1].error == "missing_topic"
    assert run(spark, [x for x in rows if x[0] not in ("/k", "/f")], TWO, settings)[1].error == "no_effector_stream"
    assert run(spark, [x for x in rows if x[0] != "/c"], TWO, settings)[1].error == "no_arm_command"
    bad = [*rows, ("/s", 501, 501, [1.0, float("nan")])]
    assert run(spark, bad, TWO, settings)[1].error == "decode_errors" and run(spark, bad, TWO, settings | {"max_decode_errors": 1})[1].status == "converted"
    assert run(spark, [], TWO, settings) == ([], None)


def test_strict_policy_and_clock_order(spark):
    images, states = [("/h", t, t) for t in range(0, 700, 100)], [("/s", t, t, [t / 10, 1.0]) for t in range(0, 700, 10)]
    commands = [("/c", t, t, [1.0, 2.0]) for t in (100, 190, 390, 500, 600)]
    settings = {"mode": "capture", "fps": 10, "action_gap_policy": "fail", "invalid_frame_policy": "drop", "action_tolerance_ms": 30}
    rows, status = run(spark, images + states + commands, ONE, settings)
    assert [r.t for r in rows] == [100, 500, 600] and (status.rows, status.invalid) == (6, 3)
    back = [(*x[:2], 40, *x[3:]) if x[:2] == ("/s", 300) else x for x in images + states + commands]
    assert run(spark, back, ONE, settings)[1].error == "not_monotonic" and run(spark, back, ONE, settings | {"mode": "lerobot-loop"})[1].status == "converted"
    unset = [(*x[:2], -BASE, *x[3:]) if x[:2] == ("/h", 300) else x for x in images + states + commands]
    assert run(spark, unset, ONE, settings)[1].error == "decode_errors"
    held, status = run(spark, images + states + commands, ONE, settings | {"action_gap_policy": "hold-last-command", "max_hold_fraction": 0.2})
    assert not held and status.error == "too_much_hold"
    _, status = run(spark, images + states + commands, ONE, settings | {"action_gap_policy": "hold-last-command", "max_hold_run_s": 0.05})
    assert status.error == "hold_too_long"
    same = [(*x[:3], [x[1] / 10, 1.0]) if x[0] == "/c" else x for x in images + states + [("/c", t, t, None) for t in range(0, 700, 100)]]
    assert run(spark, same, ONE, settings)[1].error == "action_is_state"
    grid, _ = run(spark, images + states + commands, ONE, settings | {"grid_anchor": "first-command", "fps": 20, "action_gap_policy": "hold-last-command", "image_tolerance_ms": 100})
    assert [r.t for r in grid] == list(range(100, 601, 50))


def test_settings_are_checked():
    plan = lambda **s: Alignment(load_profile(json.dumps(ONE)), alignment(s), 1000)
    assert plan(mode="capture").tolerances()["image"] == round(500 / 30 * 1000) and plan().tolerances() == {"image": 50_000, "action": round(1000 / 30 * 1000), "pair": 5000, "effector": 100_000}
    bad = [{"fps": 0}, {"mode": "x"}, {"action_tolerance_ms": -1}, {"max_hold_fraction": 1.5}, {"missing_topic_policy": "fill"}, {"grid_anchor": "x"}, {"image_height": 5}]
    for settings in [*bad, {"max_decode_errors": -1}, {"state_tolerance_periods": 0}, {"max_tick_rate_deviation": -0.1}, {"speed": 1}]:
        with pytest.raises(ValueError):
            alignment(settings)
    assert layered({"fps": 20.0, "mode": "capture"}, {"fps": 25.0, "mode": None}) == alignment({"fps": 25.0, "mode": "capture"})
    for settings in ({"gap_factor": 1}, {"warn_drop_ratio": 0.5}, {"warn_latency_ms": 900}):
        with pytest.raises(ValueError):
            limits(settings)


def test_recipes_and_profiles():
    recipe = load_recipe('{"profile": "arm", "alignment": {"fps": 20}, "video": {"crf": 20}, "cameras": {"head": "/x"}}')
    assert recipe["alignment"] == {"fps": 20} and chosen_profile(recipe, None) == ("arm", {"cameras": {"head": "/x"}}) and chosen_profile(recipe, "other") == ("other", {})
    for text in ("{}", '{"profile": "a", "colour": 1}', '{"profile": "a", "alignment": {"speed": 1}}', '{"profile": "a", "video": {"fps": 1}}'):
        with pytest.raises(ValueError):
            load_recipe(text)
    p = load_profile(json.dumps(TWO))
    assert [r[1] for r in p.roles()] == ["camera", "arm_state", "arm_command", "arm_command", "ee_command", "ee_command", "ee_state"]
    assert p.state_names() == ["a", "b", "gripper_G", "H_joint1", "H_joint2"] and p.anchor_camera == "left"
    assert load_profile(json.dumps(ONE), {"cameras": {"top": "/t"}}).cameras == {"top": "/t"}
    wrong = [{"cameras": {}}, {"cameras": {"head": "h"}}, {"cameras": {"a": "/m", "b": "/m"}}, {"anchor_camera": "no"}, {"depths": {"no": "/d"}}, {"arm": ARM | {"command_dim": 3}}, {"arm": {}},
             {"end_effectors": [{"name": "a", "dim": 1, "command_topic": "/g", "command_kind": "x"}]}, {"end_effectors": [{"name": "a", "dim": 2, "command_topic": "/g"}]}]
    for doc in wrong:
        with pytest.raises(ValueError):
            load_profile(json.dumps(ONE), doc)
    assert name_and_topic("a=/b") == ("a", "/b")
    with pytest.raises(ValueError):
        name_and_topic("a=b")
