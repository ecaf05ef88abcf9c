"""Alignment settings, quality limits and recipes: tables of settings and one checker."""

from __future__ import annotations

import json
from collections.abc import Mapping
from types import MappingProxyType

#: The settings that users' files and recipes hold.  Name: default, least value (None: any), greatest value or the allowed words.
ALIGNMENT = {
    "mode": ("lerobot-loop", None, ("capture", "lerobot-loop")),
    "grid_anchor": ("anchor-camera-ticks", None, ("anchor-camera", "anchor-camera-ticks", "first-command")),
    "action_gap_policy": ("hold-last-command", None, ("fail", "hold-last-command", "joint-state-fill")),
    "invalid_frame_policy": ("fail", None, ("fail", "drop")),
    "missing_topic_policy": ("fail", None, ("fail", "fill")),
    "fps": (30, 1e-9, None),
    "image_tolerance_ms": (None, 0, None),
    "state_tolerance_ms": (None, 0, None),
    "state_tolerance_periods": (1.5, 1e-9, None),
    "action_tolerance_ms": (None, 0, None),
    "action_pair_tolerance_ms": (5.0, 0, None),
    "end_effector_tolerance_ms": (100.0, 0, None),
    "max_hold_fraction": (None, 0, 1),
    "max_hold_run_s": (None, 0, None),
    "max_tick_rate_deviation": (0.1, 0, None),
    "max_decode_errors": (0, 0, None),
    "include_depth": (False, None, None),
    "image_height": (0, 0, None),
    "image_width": (0, 0, None),
}
LIMITS = {
    "gap_factor": (1.5, 1 + 1e-9, None),
    "warn_drop_ratio": (0.01, 0, 1),
    "fail_drop_ratio": (0.05, 0, 1),
    "sync_warn_ms": (20.0, None, None),
    "warn_latency_ms": (100.0, 0, None),
    "fail_latency_ms": (500.0, 0, None),
    "command_gap_warn_s": (1.0, None, None),
}
#: Pairs of which the first mustn't be the greater one.
RISING = (("warn_drop_ratio", "fail_drop_ratio"), ("warn_latency_ms", "fail_latency_ms"))


def checked(table: Mapping, given: Mapping) -> Mapping:
    """All settings of ``table``: those given, else the defaults.  Unknown names and values out of bounds are errors."""
    if unknown := given.keys() - table.keys():
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    out = {name: given.get(name, default) for name, (default, _, _) in table.items()}
    for name, (_, least, most) in table.items():
        value = out[name]
        if isinstance(most, tuple):
            if value not in most:
                raise ValueError(f"{name} must be one of {', '.join(most)}")
        elif value is not None and (least is not None and value < least or most is not None and value > most):
            raise ValueError(f"{name} is {value}, out of bounds")
    for low, high in RISING:
        if low in out and out[low] > out[high]:
            raise ValueError(f"{low} must not be over {high}")
    return MappingProxyType(out)


def alignment(given: Mapping | None = None) -> Mapping:
    """Checked alignment settings.  Tolerances are in milliseconds; null ones follow from the frame rate."""
    out = checked(ALIGNMENT, given or {})
    if bool(out["image_height"]) != bool(out["image_width"]):
        raise ValueError("image_height and image_width must both be given or both be zero")
    if out["missing_topic_policy"] == "fill" and out["action_gap_policy"] != "joint-state-fill":
        raise ValueError("missing topics can be filled only with action_gap_policy joint-state-fill")
    return out


def limits(given: Mapping | None = None) -> Mapping:
    """Checked thresholds of a recording's verdict."""
    return checked(LIMITS, given or {})


def layered(recipe: Mapping | None = None, given: Mapping | None = None) -> Mapping:
    """Alignment settings: what was given, else the recipe's, else the default; nulls count as not given."""
    return alignment({k: v for layer in (recipe, given) for k, v in (layer or {}).items() if v is not None})


#: Fields of a recipe beside its alignment, and of its video block.
RECIPE_FIELDS = {"name", "description", "storage", "profile", "cameras", "depths", "anchor_camera", "robot_type", "alignment", "video", "notes", "_comment"}
VIDEO_FIELDS = {"codec", "pixel_format", "crf", "gop", "preset", "fast_decode", "encoder_threads"}
#: Fields of a recipe that stand in for those of its own profile.
OVERRIDES = ("cameras", "depths", "anchor_camera", "robot_type")


def load_recipe(text: str) -> dict:
    """A recipe from JSON: a profile's name with defaults of alignment and video; unknown fields are errors."""
    doc = json.loads(text)
    if "profile" not in doc:
        raise ValueError("a recipe names a profile")
    for where, known, found in (("recipe", RECIPE_FIELDS, doc), ("alignment", ALIGNMENT, doc.get("alignment") or {}), ("video", VIDEO_FIELDS, doc.get("video") or {})):
        if unknown := set(found) - set(known):
            raise ValueError(f"unknown {where} fields: {', '.join(sorted(unknown))}")
    return doc


def chosen_profile(recipe: Mapping | None, given: str | None) -> tuple[str, dict]:
    """The profile's name, and the recipe's overrides of it; a profile that was given discards those, as they belong to another one."""
    if given:
        return given, {}
    if not recipe:
        raise ValueError("neither a recipe nor a profile was given")
    return recipe["profile"], {k: recipe[k] for k in OVERRIDES if recipe.get(k) is not None}


def name_and_topic(text: str) -> tuple[str, str]:
    """NAME=/topic."""
    name, sep, topic = text.partition("=")
    if not sep or not name.strip() or not topic.strip().startswith("/"):
        raise ValueError(f"expected NAME=/topic, got {text!r}")
    return name.strip(), topic.strip()
