"""Alignment compiled from a profile and settings: any number of cameras, arms and effectors, on either clock.

All streams of a tick are picked in one as-of join, the effectors' actions in a second
one.  Values are arrays; a state is the arm's joints followed by the effectors' values, an
action the commands of all arms in the order of their joints, followed by the effectors' actions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.profiles import Profile, Side
from .asof import asof_many
from .buckets import spread
from .cuts import cut, drop
from .quantiles import quantiles
from .sequence import islands, numbered, previous

FILL = "joint-state-fill"


def both(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def either(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def joined(arrays: list[Column]) -> Column:
    return arrays[0] if len(arrays) == 1 else F.concat(*arrays)


def line(a: Column, b: Column, share: Column) -> Column:
    """Values between two arrays."""
    return F.zip_with(a, b, lambda x, y: x + share * (y - x))


@dataclass(frozen=True)
class Alignment:
    """``profile`` and ``settings`` (``sources.config.alignment``) over messages with ``per_ms`` ticks of time a millisecond.

    Messages have bag_id, topic, seq, t (receipt), h (header stamp, null or 0 if none), values and
    velocities (arrays of doubles; null for images).
    """

    profile: Profile
    settings: Mapping
    per_ms: int = 1_000_000

    # -- streams -----------------------------------------------------------------

    @property
    def capture(self) -> bool:
        return self.settings["mode"] == "capture"

    @property
    def fill(self) -> bool:
        return self.settings["action_gap_policy"] == FILL

    @property
    def depths(self) -> dict[str, str]:
        return dict(self.profile.depths) if self.settings["include_depth"] else {}

    def ticks_of(self, name: str, otherwise: float) -> int:
        """A tolerance in ticks of time, rounded half even."""
        ms = self.settings[name]
        return round((otherwise if ms is None else ms) * self.per_ms)

    def tolerances(self) -> dict[str, int]:
        """Images may be half a frame off around a capture time, one and a half behind a loop tick; actions a frame ahead."""
        fps = self.settings["fps"]
        image = self.ticks_of("image_tolerance_ms", (500 if self.capture else 1500) / fps)
        action, pair = self.ticks_of("action_tolerance_ms", 1000 / fps), self.ticks_of("action_pair_tolerance_ms", 0)
        return {"image": image, "action": action, "pair": pair, "effector": self.ticks_of("end_effector_tolerance_ms", 0)}

    def streams(self) -> list[tuple[str, str, int, bool, tuple[int, ...]]]:
        """name, topic, width (0: image), header, picked places of each stream; a topic shared by cameras is one stream."""
        p = self.profile
        out = [(f"image_{i}", t, 0, True, ()) for i, t in enumerate(dict.fromkeys(p.cameras.values()))]
        out += [(f"depth_{i}", t, 0, True, ()) for i, t in enumerate(self.depths.values())]
        out += [("arm", p.state_topic, len(p.joints), True, ()), *[(f"command_{i}", t, p.command_width, True, ()) for i, t in enumerate(p.commands)]]

        def side(name: str, s: Side, width: int) -> tuple:
            return name, s.topic, width, s.header, s.pick

        for i, e in enumerate(p.effectors):
            out += [side(f"acts_{i}", e.command, e.width), *([side(f"state_{i}", e.state, e.width)] if e.state else [])]
        return out

    def messages(self, msgs: DataFrame) -> DataFrame:
        """bag_id, stream, seq, at (receipt), t (the clock of the mode), values, velocities, bad: the profile's messages.

        Capture mode takes header stamps, where a stream has them; loop mode times of receipt.
        Bad ones have no stamp, too few values or values that aren't finite.
        """
        kinds = []
        for name, topic, width, header, pick in self.streams():
            stamp = F.col("t")
            if self.capture and header:  # an image whose header was never set has no capture time
                stamp = F.col("h") if width else F.nullif("h", F.lit(0))
            values = F.array(*[F.get("values", i) for i in pick]) if pick else F.col("values")
            kinds.append(F.when(F.col("topic") == topic, F.struct(F.lit(name).alias("stream"), stamp.alias("t"), (values if width else F.lit(None).cast("array<double>")).alias("values"), F.lit(width).alias("width"))))
        # a topic can serve several streams
        found = F.explode(F.filter(F.array(*kinds), lambda x: x.isNotNull()))
        df = msgs.where(F.col("topic").isin(*[s[1] for s in self.streams()])).select("bag_id", "seq", F.col("t").alias("at"), "velocities", found.alias("s"))
        df = df.select("bag_id", "s.stream", "seq", "at", "s.t", "s.values", F.when((F.col("s.stream") == "arm") & (F.size("velocities") == F.col("s.width")), F.col("velocities")).alias("velocities"), "s.width")
        good = lambda c: ~F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        whole = F.coalesce((F.size("values") == F.col("width")) & good("values"), F.lit(False))
        df = df.withColumn("bad", F.col("t").isNull() | ((F.col("width") > 0) & ~whole))
        return df.withColumn("moving", F.coalesce(good("velocities"), F.lit(False))).drop("width")

    # -- recordings --------------------------------------------------------------

    def recordings(self, clean: DataFrame) -> DataFrame:
        """One row a recording of ``messages``: what its streams hold, its window, and ``error``, the first reason that keeps it from converting."""
        names = [s[0] for s in self.streams()]
        p, s = self.profile, self.settings
        ok, stream, when = ~F.col("bad"), F.col("stream"), F.struct("t", "seq", "values")
        aggregates = []
        for n in names:
            mine = stream == n
            aggregates += [F.count_if(mine).alias(f"all_{n}"), F.count_if(mine & ~ok).alias(f"bad_{n}"), F.min(F.when(mine & ok, F.col("t"))).alias(f"a_{n}"), F.max(F.when(mine & ok, F.col("t"))).alias(f"b_{n}")]
        commands = [f"command_{i}" for i in range(len(p.commands))]
        aggregates += [F.min(F.when((stream == n) & ok, when)).alias(f"first_{n}") for n in commands]
        aggregates.append(F.bool_and(F.when((stream == "arm") & ok, F.col("moving"))).alias("moving"))
        df = clean.groupBy("bag_id").agg(*aggregates)
        if self.capture:  # receipt is in order as it is read; header stamps needn't be
            steps = previous(clean.where("NOT bad").select("bag_id", "stream", F.col("at").alias("t"), "seq", F.col("t").alias("x")), ["bag_id", "stream"], ["x"], {"_p": None})
            back = steps.where(F.col("x") < F.col("_p.x")).select("bag_id", F.lit(True).alias("back")).distinct()
            df = df.join(back, "bag_id", "left")
        else:
            df = df.withColumn("back", F.lit(None).cast("boolean"))
        there = {n: F.col(f"a_{n}").isNotNull() for n in names}
        effectors = range(len(p.effectors))
        measured = {i: there[f"state_{i}"] if p.effectors[i].state else F.lit(False) for i in effectors}
        images = [n for n in names if n.startswith(("image_", "depth_"))]
        essential, fillable = [*images, "arm"], [*commands, *[f"acts_{i}" for i in effectors]]
        lacking = lambda which: either([F.col(f"all_{n}") == 0 for n in which])
        empty = lambda which: either([~there[n] for n in which])
        errors = either([F.col(f"bad_{n}") > (0 if n in images else s["max_decode_errors"]) for n in names])
        strict = F.lit(s["missing_topic_policy"] != "fill")
        low, high = (F.array_min, F.array_max) if self.fill else (F.array_max, F.array_min)
        df = df.withColumn("cmd_start", low(F.array(*[F.col(f"a_{n}") for n in commands]))).withColumn("cmd_end", high(F.array(*[F.col(f"b_{n}") for n in commands])))
        observed = [(f"a_{n}", f"b_{n}") for n in essential]
        firsts, lasts = [F.col(a) for a, _ in observed], [F.col(b) for _, b in observed]
        for i in effectors:  # whichever stream gives its observation
            for edge, into in (("a", firsts), ("b", lasts)):
                own = F.col(f"{edge}_acts_{i}")
                into.append(F.when(measured[i], F.col(f"{edge}_state_{i}")).otherwise(own) if p.effectors[i].state else own)
        anchor = F.lit(None).cast("long").alias("anchor")
        if s["grid_anchor"] != "first-command":
            frames = clean.where((stream == self.anchor_stream) & ok).select("bag_id", "t")
            newest = frames.join(df.select("bag_id", "cmd_start"), "bag_id").where("t <= cmd_start").groupBy("bag_id").agg(F.max("t").alias("anchor"))
            df = df.join(newest, "bag_id", "left")
        else:
            df = df.select("*", anchor)
        df = df.withColumn("start", F.greatest(F.coalesce("anchor", "cmd_start"), *firsts)).withColumn("end", F.least("cmd_end", *lasts))
        reasons = [
            (lacking(essential), "missing_topic"), (strict & lacking(fillable), "missing_topic"), (errors, "decode_errors"), (empty(essential), "no_valid_message"),
            (strict & empty(fillable), "no_valid_message"), (both([~there[n] for n in commands]), "no_arm_command"), (F.coalesce("back", F.lit(False)), "not_monotonic"),
            (~F.coalesce(F.col("cmd_start") < F.col("cmd_end"), F.lit(False)), "no_command_span"), (~F.coalesce(F.col("start") < F.col("end"), F.lit(False)), "window_off_observations"),
            (either([~measured[i] & ~there[f"acts_{i}"] for i in effectors]), "no_effector_stream"),
        ]
        error = reduce(lambda c, r: c.when(r[0], r[1]), reasons[1:], F.when(*reasons[0]))
        keep = ["bag_id", "start", "end", "cmd_start", "cmd_end", "moving", *[f"first_{n}" for n in commands]]
        live = [there[n].alias(f"live_{n}") for n in [*commands, *[f"acts_{i}" for i in effectors]]]
        return df.select(*keep, *live, *[measured[i].alias(f"measured_{i}") for i in effectors], error.alias("error"))

    @property
    def anchor_stream(self) -> str:
        topics = list(dict.fromkeys(self.profile.cameras.values()))
        return f"image_{topics.index(self.profile.cameras[self.profile.anchor_camera])}"

    # -- ticks -------------------------------------------------------------------

    def ticks(self, clean: DataFrame, good: DataFrame) -> DataFrame:
        """bag_id, k, t, tick (seq of the frame, null on a grid) of recordings with a window."""
        if self.settings["grid_anchor"] == "anchor-camera-ticks":
            df = clean.where((F.col("stream") == self.anchor_stream) & ~F.col("bad")).join(good.select("bag_id", "start", "end"), "bag_id").where("t BETWEEN start AND end")
            return numbered(df.select("bag_id", "t", "seq"), ["bag_id"], "k").select("bag_id", "k", "t", F.col("seq").alias("tick"))
        second = 1000.0 * self.per_ms
        fps = float(self.settings["fps"])
        n = F.floor((F.col("end") - F.col("start")) * fps / second)
        df = good.select("bag_id", "start", F.explode(F.sequence(F.lit(0).cast("long"), n)).alias("k"))
        return df.select("bag_id", "k", (F.col("start") + F.rint(F.col("k") * second / fps).cast("long")).alias("t"), F.lit(None).cast("long").alias("tick"))

    # -- rows --------------------------------------------------------------------

    def rows(self, msgs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """All control rows, and one row a recording with its ``error`` so far; both are written tables.

        A row has bag_id, k, t, tick, state, action, velocity (null where it follows from neighbours), hold,
        real (of each arm), skew, images and depths (structs by camera of the message's seq and t), parts (a
        struct of what has to hold) and valid.
        """
        clean = cut(self.messages(msgs))
        found = cut(self.recordings(clean))
        good = found.where("error IS NULL")
        fps = float(self.settings["fps"])
        one = cut(self.ticks(clean, good))
        steps = previous(one.withColumn("seq", F.col("k")), ["bag_id"], ["t"], {"_p": None}).select("bag_id", (F.col("t") - F.col("_p.t")).alias("dt"))
        rate = quantiles(steps, ["bag_id"], "dt", {"tick_period": 0.5})
        counts = one.groupBy("bag_id").agg(F.count("*").alias("candidates"))
        arm = clean.where((F.col("stream") == "arm") & ~F.col("bad")).select("bag_id", "t", "seq")
        periods = previous(arm, ["bag_id"], ["t"], {"_p": None}).select("bag_id", (F.col("t") - F.col("_p.t")).alias("dt"))
        arm_period = quantiles(periods, ["bag_id"], "dt", {"arm_period": 0.5})
        found = found.join(rate, "bag_id", "left").join(counts, "bag_id", "left").join(arm_period, "bag_id", "left")
        measured = 1000.0 * self.per_ms / F.col("tick_period")
        off = F.lit(self.settings["grid_anchor"] == "anchor-camera-ticks") & (F.col("tick_period") > 0) & (F.abs(measured - fps) / fps > self.settings["max_tick_rate_deviation"])
        late = F.when(F.coalesce("candidates", F.lit(0)) < 2, "too_few_frames").when(F.coalesce(off, F.lit(False)), "tick_rate_off")
        found = cut(found.withColumn("error", F.coalesce("error", late)).withColumn("state_tolerance", self.state_tolerance(F.col("arm_period"))))
        ticks = cut(one.join(found.where("error IS NULL").drop("error", "start", "end"), "bag_id"))
        out = cut(self.picked(ticks, clean))
        drop(clean, one, ticks)
        return out, found

    def state_tolerance(self, period: Column) -> Column:
        """In ticks: a few periods of the arm's stream, half a frame at least, or what is set."""
        s = self.settings
        if s["state_tolerance_ms"] is not None:
            return F.lit(round(s["state_tolerance_ms"] * self.per_ms))
        frame = 1000.0 / s["fps"]
        ms = F.coalesce(period / self.per_ms, F.lit(frame))
        return F.rint(F.greatest(ms * s["state_tolerance_periods"], F.lit(0.5 * frame), F.lit(1.0)) * self.per_ms).cast("long")

    def picks(self) -> dict[str, tuple[Column, str]]:
        stream, out = F.col("stream"), {}
        for name, *_ in self.streams():
            mine = stream == name
            if name.startswith(("image_", "depth_")) or name == "arm":
                if self.capture:
                    out |= {f"p_{name}": (mine, "before"), f"n_{name}": (mine, "forward")}
                else:
                    out[f"p_{name}"] = (mine, "backward")
            elif name.startswith("command_"):
                out |= {f"p_{name}": (mine, "backward"), f"n_{name}": (mine, "forward")}
            else:
                out[f"p_{name}"] = (mine, "backward")
        return out

    def picked(self, ticks: DataFrame, clean: DataFrame) -> DataFrame:
        p, tol, t = self.profile, self.tolerances(), F.col("t")
        source = clean.where("NOT bad").select("bag_id", "stream", "t", "seq", "values", "velocities")
        buckets = spread(source.select("bag_id", "t").unionByName(ticks.select("bag_id", "t")), ["bag_id"])
        df = asof_many(ticks, source, ["bag_id"], ["values", "velocities"], self.picks(), buckets)
        parts: dict[str, Column] = {}

        def image(name: str) -> Column:
            before, after = F.col(f"p_{name}"), F.col(f"n_{name}") if self.capture else None
            if after is None:
                return before
            nearer = after.isNotNull() & (before.isNull() | (after["t"] - t < t - before["t"]))
            return F.when(nearer, after).otherwise(before)

        topics = list(dict.fromkeys(p.cameras.values()))
        shown = {"image": {c: f"image_{topics.index(x)}" for c, x in p.cameras.items()}, "depth": {c: f"depth_{i}" for i, c in enumerate(self.depths)}}
        media = {}
        for kind, cameras in shown.items():
            chosen = {c: image(n) for c, n in cameras.items()}
            media[kind] = F.struct(*[F.struct(x["seq"].alias("seq"), x["t"].alias("t")).alias(c) for c, x in chosen.items()]) if chosen else F.lit(None).cast("string")
            parts |= {f"{kind}_{c}": F.coalesce(F.abs(t - x["t"]) <= tol["image"], F.lit(False)) for c, x in chosen.items()}

        # the arm: between its neighbours (an exact stamp is itself), or its last state
        before, limit = F.col("p_arm"), F.col("state_tolerance")
        if self.capture:
            after = F.col("n_arm")
            hit = F.coalesce(after["t"] == t, F.lit(False))
            share = (t - before["t"]) / (after["t"] - before["t"])
            near = F.coalesce((t - before["t"] <= limit) & (after["t"] - t <= limit), F.lit(False))
            of = lambda c: F.when(hit, after[c]).otherwise(line(before[c], after[c], share))
            parts["arm_state"], qpos, qvel = hit | near, of("values"), F.when(F.col("moving"), of("velocities"))
        else:
            parts["arm_state"], qpos, qvel = F.coalesce(t - before["t"] <= limit, F.lit(False)), before["values"], before["velocities"]
        df = df.withColumn("qpos", qpos).withColumn("qvel", qvel)

        # effectors: measured, or the command's echo
        seen = []
        for i, e in enumerate(p.effectors):
            own = F.when(F.col(f"measured_{i}"), F.col(f"p_state_{i}")).otherwise(F.col(f"p_acts_{i}")) if e.state else F.col(f"p_acts_{i}")
            seen.append(own["values"])
            parts[f"state_{e.name}"] = F.coalesce(t - own["t"] <= tol["effector"], F.lit(False))

        # commands: the next one in reach, else the last before, else the first
        policy, real, chosen, live = self.settings["action_gap_policy"], [], [], []
        for i in range(len(p.commands)):
            n = f"command_{i}"
            live.append(F.col(f"live_{n}"))
            real.append(F.coalesce(F.col(f"n_{n}.t") - t <= tol["action"], F.lit(False)))
            plain = lambda c: F.struct(F.col(f"{c}.t").alias("t"), F.col(f"{c}.seq").alias("seq"), F.col(f"{c}.values").alias("values"))
            held = lambda c: F.when(F.col(c).isNotNull(), plain(c))
            next_, last = held(f"n_{n}"), held(f"p_{n}")
            chosen.append(F.coalesce(next_, last) if policy == "fail" else F.coalesce(F.when(real[i], next_), last, held(f"first_{n}")))
            if policy == "fail":
                parts[f"command_{i}"] = ~live[i] | real[i]
        df = df.withColumns({f"cmd_{i}": c for i, c in enumerate(chosen)} | {f"real_{i}": r for i, r in enumerate(real)})
        real, times = [F.col(f"real_{i}") for i in range(len(real))], F.array(*[F.col(f"cmd_{i}.t") for i in range(len(real))])
        # null times are those of arms that never spoke
        skew, all_real, any_real = F.array_max(times) - F.array_min(times), both(real), either(real)
        pair = ~all_real | (skew <= tol["pair"])
        if policy == "fail":
            parts["command_pair_skew"] = F.coalesce(pair, F.lit(True))
        hold = ~any_real if self.fill else ~(all_real & pair)
        blocks = []
        for i in range(len(real)):
            block, w = F.col(f"cmd_{i}.values"), p.command_width
            blocks.append(F.when(real[i], block).otherwise(F.slice("qpos", i * w + 1, w)) if self.fill else F.coalesce(block, F.array_repeat(F.lit(0.0), w)))
        shown_columns = [F.col("bag_id"), F.col("k"), t, F.col("tick"), F.col("qpos"), F.col("qvel"), joined(blocks).alias("arm_action"), hold.alias("hold"), F.array(*real).alias("real"), skew.alias("skew"), F.array_max(times).alias("ref"), media["image"].alias("images"), media["depth"].alias("depths")]
        extra = [c.alias(f"seen_{i}") for i, c in enumerate(seen)] + [F.col(f"live_acts_{i}") for i in range(len(seen))]
        rows = df.select(*shown_columns, *extra, *[c.alias(f"ok_{n}") for n, c in parts.items()])

        acts = []
        if p.effectors:  # bound to the latest selected command
            rows = cut(rows)
            at = rows.withColumnRenamed("t", "_t").withColumn("t", F.col("ref"))
            commands = source.where(F.col("stream").startswith("acts_"))
            rows = asof_many(at, commands, ["bag_id"], ["values"], {f"e_{i}": (F.col("stream") == f"acts_{i}", "backward") for i in range(len(p.effectors))})
            rows = rows.drop("t").withColumnRenamed("_t", "t")
            for i, e in enumerate(p.effectors):
                spoke = F.col(f"live_acts_{i}")
                acts.append(F.when(spoke, F.col(f"e_{i}.values")).otherwise(F.col(f"seen_{i}")))
                parts[f"action_{e.name}"] = None
                rows = rows.withColumn(f"ok_action_{e.name}", ~spoke | F.coalesce(F.col("ref") - F.col(f"e_{i}.t") <= tol["effector"], F.lit(False)))
        ok = [F.col(f"ok_{n}") for n in parts]
        state = joined([F.col("qpos"), *[F.col(f"seen_{i}") for i in range(len(seen))]])
        return rows.select(
            "bag_id", "k", "t", "tick", state.alias("state"), joined([F.col("arm_action"), *acts]).alias("action"), F.col("qvel").alias("velocity"), "hold", "real", "skew", "images", "depths",
            F.struct(*[c.alias(re.sub(r"\W", "_", n)) for n, c in zip(parts, ok, strict=True)]).alias("parts"), both(ok).alias("valid"),
        )

    # -- episodes ----------------------------------------------------------------

    def status(self, rows: DataFrame, found: DataFrame) -> DataFrame:
        """bag_id, rows, invalid, kept, held, status, error of each recording; the first reason that holds is the error."""
        s = self.settings
        some = F.exists("real", lambda x: x) if self.fill else F.forall("real", lambda x: x)
        same = F.transform("state", lambda x: x.cast("float")) == F.transform("action", lambda x: x.cast("float"))
        one = rows.groupBy("bag_id").agg(
            F.count("*").alias("rows"), F.count_if(~F.col("valid")).alias("invalid"), F.count_if(some).alias("spoken"),
            F.count_if(F.col("valid") & ~F.coalesce(same, F.lit(False))).alias("own"), F.count_if(F.col("valid") & F.col("hold")).alias("held"),
        )
        runs = islands(rows.where("valid"), ["bag_id"], "hold", "k").groupBy("bag_id").agg(F.max(F.col("end_us") - F.col("start_us")).alias("longest"))
        df = found.select("bag_id", "error").join(one, "bag_id", "left").join(runs, "bag_id", "left")
        good, error = F.col("rows") - F.col("invalid"), F.when(F.col("error").isNotNull(), F.col("error"))
        if s["action_gap_policy"] != "fail":
            error = error.when(F.col("spoken") == 0, "no_real_command")
        if s["invalid_frame_policy"] == "fail":
            error = error.when(F.col("invalid") > 0, "invalid_rows")
        error = error.when(good == 0, "no_valid_rows").when(F.col("own") == 0, "action_is_state")
        if s["max_hold_fraction"] is not None:
            error = error.when(F.col("held") > s["max_hold_fraction"] * good, "too_much_hold")
        if s["max_hold_run_s"] is not None:
            error = error.when(F.coalesce("longest", F.lit(0)) > s["max_hold_run_s"] * 1000 * self.per_ms, "hold_too_long")
        df = df.withColumn("error", error)
        zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
        return df.select("bag_id", zero("rows").alias("rows"), zero("invalid").alias("invalid"), F.when(F.col("error").isNull(), good).otherwise(F.lit(0).cast("long")).alias("kept"), zero("held").alias("held"), F.when(F.col("error").isNull(), "converted").otherwise("failed").alias("status"), "error")

    def episodes(self, rows: DataFrame, status: DataFrame) -> DataFrame:
        """Rows of converted recordings: bag_id, frame, t, state, action, velocity (single precision), hold, images, depths.

        Frames are numbered anew.  Where velocities weren't measured throughout they are backward
        differences of the kept states times the frame rate, the first frame having the second's; effectors always are.
        """
        fps, wide = float(self.settings["fps"]), len(self.profile.joints)
        kept = rows.where("valid").join(status.where("status = 'converted'").select("bag_id"), "bag_id", "left_semi").withColumn("seq", F.col("k"))
        kept = cut(numbered(kept.withColumnRenamed("t", "_t").withColumn("t", F.col("k")), ["bag_id"], "frame"))
        steps = previous(kept, ["bag_id"], ["state"], {"_p": None})
        steps = cut(steps.withColumn("_d", F.zip_with("state", "_p.state", lambda x, y: (x - y) * fps)).drop("_p"))
        whole = F.bool_and(F.coalesce(F.size("velocity") == wide, F.lit(False)) & F.coalesce(~F.exists("velocity", lambda x: x.isNull() | F.isnan(x)), F.lit(False)))
        firsts = steps.groupBy("bag_id").agg(whole.alias("_whole"), F.max(F.when(F.col("frame") == 1, F.col("_d"))).alias("_second"))
        df = steps.join(firsts, "bag_id")
        moved = F.coalesce("_d", "_second", F.transform("state", lambda x: F.lit(0.0)))
        arm = F.when(F.col("_whole"), F.col("velocity")).otherwise(F.slice(moved, 1, wide))
        single = lambda c: F.transform(c, lambda x: x.cast("float"))
        rest = F.slice(moved, wide + 1, F.greatest(F.size("state") - wide, F.lit(0)))
        return df.select("bag_id", "frame", F.col("_t").alias("t"), single(F.col("state")).alias("state"), single(F.col("action")).alias("action"), single(F.concat(arm, rest)).alias("velocity"), "hold", "images", "depths")


def align(msgs: DataFrame, profile: Profile, settings: Mapping, per_ms: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """Episodes and status of all recordings of ``msgs`` (see ``Alignment``)."""
    plan = Alignment(profile, settings, per_ms)
    rows, found = plan.rows(msgs)
    status = cut(plan.status(rows, found))
    return plan.episodes(rows, status), status
