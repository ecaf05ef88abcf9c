"""Profiles: what a recording holds, from the JSON files that users have."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

#: Payloads without a header; the receive time is their only clock.
HEADERLESS_KINDS = ("float32", "float32multiarray")
PAYLOADS = ("float32", "jointstate", "float32multiarray")


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclass(frozen=True)
class Side:
    """A stream of an effector: its topic, whether its messages have headers, and which of their values count (all, if empty)."""

    topic: str
    header: bool = True
    pick: tuple[int, ...] = ()


@dataclass(frozen=True)
class Effector:
    """What is at the end of an arm: always commanded, sometimes measured."""

    name: str
    width: int
    command: Side
    state: Side | None = None
    names: tuple[str, ...] = ()


@dataclass(frozen=True)
class Profile:
    """Cameras and depth streams by name, the arm's joints and the topics that command them in order, effectors, crops of shared images."""

    name: str
    cameras: Mapping[str, str]
    state_topic: str
    joints: tuple[str, ...]
    commands: tuple[str, ...]
    effectors: tuple[Effector, ...] = ()
    depths: Mapping[str, str] = field(default_factory=dict)
    anchor: str = ""
    crops: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    robot: str = "unknown"
    definitions: Mapping[str, str] = field(default_factory=dict)
    #: Whether joints are told apart by name; otherwise by place.
    named: bool = True

    def __post_init__(self) -> None:
        _need(bool(self.cameras), "a profile has a camera at least")
        _need(bool(self.joints) and len(set(self.joints)) == len(self.joints), "joint names must be there, each once")
        _need(bool(self.commands) and len(set(self.commands)) == len(self.commands), "command topics must be there, each once")
        _need(len(self.joints) % len(self.commands) == 0, "each command topic drives as many joints")
        _need(not self.anchor or self.anchor in self.cameras, "the anchor must be one of the cameras")
        _need(set(self.depths) <= set(self.cameras), "a depth stream belongs to a camera")
        _need(set(self.crops) <= set(self.cameras) and not set(self.crops) & set(self.depths), "a crop belongs to a camera without depth")
        _need(len({e.name for e in self.effectors}) == len(self.effectors), "effectors need names of their own")
        for topic in (*self.cameras.values(), *self.depths.values(), *self.sides()):
            _need(topic.startswith("/"), f"{topic} is not an absolute topic")
        for topic in self.cameras.values():
            own = [c for c, t in self.cameras.items() if t == topic]
            _need(len(own) == 1 or set(own) <= set(self.crops), f"cameras {', '.join(own)} share {topic} without a crop each")
        for crop in self.crops.values():
            for low, high in (("left", "right"), ("top", "bottom")):
                _need(0 <= crop.get(low, 0.0) < crop.get(high, 1.0) <= 1, "a crop lies inside its image")
            _need(bool(crop.get("width", 0)) == bool(crop.get("height", 0)), "a crop has both width and height, or none")

    def sides(self) -> list[str]:
        """All topics but images."""
        return [self.state_topic, *self.commands, *[s.topic for e in self.effectors for s in (e.command, e.state) if s]]

    @property
    def anchor_camera(self) -> str:
        return self.anchor or next(iter(self.cameras))

    @property
    def command_width(self) -> int:
        return len(self.joints) // len(self.commands)

    def state_names(self) -> list[str]:
        """Names of the state's values: joints, then effectors."""
        return [*self.joints, *[n for e in self.effectors for n in e.names]]

    def roles(self) -> list[tuple[str, str, bool]]:
        """(topic, role, required), for a broadcast dimension table."""
        out = [(t, "camera", True) for t in dict.fromkeys(self.cameras.values())] + [(t, "depth", False) for t in self.depths.values()]
        out += [(self.state_topic, "arm_state", True), *[(t, "arm_command", True) for t in self.commands]]
        for e in self.effectors:
            out += [(e.command.topic, "ee_command", True), *([(e.state.topic, "ee_state", False)] if e.state else [])]
        return out


def _side(doc: Mapping, what: str, width: int) -> Side | None:
    topic = doc.get(f"{what}_topic")
    if not topic:
        return None
    kind, pick = doc.get(f"{what}_kind", "jointstate"), tuple(doc.get(f"{what}_indices") or ())
    _need(kind in PAYLOADS, f"{what}_kind must be one of {', '.join(PAYLOADS)}")
    _need(kind != "float32" or width == 1, "a float32 payload has one value")
    _need(len(pick) == (width if kind == "float32multiarray" else 0) and min(pick, default=0) >= 0, f"{what}_indices name each value of a float32multiarray, and of nothing else")
    return Side(topic, kind not in HEADERLESS_KINDS, pick)


def _effector(doc: Mapping) -> Effector:
    name, width, names = doc["name"], int(doc["dim"]), tuple(doc.get("joint_names") or ())
    _need(bool(name) and width > 0 and doc.get("kind", "gripper") in ("gripper", "dexhand"), "an effector has a name, a width and a known kind")
    _need(doc.get("kind", "gripper") != "gripper" or width == 1, "a gripper has one value")
    _need(not names or len(names) == width, "an effector has as many names as values")
    # fixed values: how values without names are called
    names = names or ((f"gripper_{name}",) if doc.get("kind", "gripper") == "gripper" else tuple(f"{name}_joint{i + 1}" for i in range(width)))
    command = _side(doc, "command", width)
    _need(command is not None, "an effector has a command topic")
    return Effector(name, width, command, _side(doc, "state", width), names)


def load_profile(text: str, overrides: Mapping | None = None) -> Profile:
    """A profile from users' JSON, with the fields of a recipe that stand in for its own."""
    doc = {**json.loads(text), **(overrides or {})}
    try:
        arm = doc["arm"]
        _need(arm.get("joint_state_order", "named") in ("named", "positional"), "joint_state_order must be named or positional")
        _need(int(arm["command_dim"]) * len(arm["command_topics"]) == len(arm["joint_names"]), "command topics by their width must make up the joints")
        return Profile(
            name=doc["name"], robot=doc.get("robot_type") or "unknown", cameras=dict(doc["cameras"]), depths=dict(doc.get("depths") or {}), anchor=doc.get("anchor_camera") or "",
            crops=dict(doc.get("camera_tiles") or {}), state_topic=arm["joint_states_topic"], joints=tuple(arm["joint_names"]), commands=tuple(arm["command_topics"]),
            effectors=tuple(map(_effector, doc.get("end_effectors") or ())), definitions=dict(doc.get("message_definitions") or {}),
            named=arm.get("joint_state_order", "named") == "named",
        )
    except KeyError as e:
        raise ValueError(f"the profile has no {e.args[0]}") from e
