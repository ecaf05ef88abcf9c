"""Training-log lines as columns: counters, durations, metrics, links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of abbreviated counters.
SCALES = {"K": 1e3, "M": 1e6, "B": 1e9, "T": 1e12, "Q": 1e15}
#: Fixed value: run pages are at this host, as team/project/runs/id.
RUN_URL = r"https://wandb\.ai/[\w.-]+/[\w.-]+/runs/\w+"


def group(text: Column, pattern: str, i: int) -> Column:
    """A regex group, null instead of empty."""
    return F.nullif(F.regexp_extract(text, pattern, i), F.lit(""))


def big_number(text: Column) -> Column:
    """1.5M as 1500000, rounded half even; null for anything else.  Commas may stand before the point."""
    text = F.trim(text)
    last = F.substring(text, -1, 1)
    scale = F.lit(1.0)
    for k, v in SCALES.items():
        scale = F.when(last == k, v).otherwise(scale)
    digits = F.when(last.isin(*SCALES), text.substr(F.lit(1), F.length(text) - 1)).otherwise(text)
    parts = F.split(digits, r"\.")
    whole, rest = F.get(parts, 0), F.get(parts, 1)
    bare = lambda c, more: (c != "") & (F.translate(c, "0123456789" + more, "") == "")
    sane = bare(whole, ",") & (F.size(parts) <= 2) & F.coalesce(bare(rest, ""), F.lit(True))
    return F.when(sane, F.rint(F.translate(digits, ",", "").try_cast("double") * scale).cast("long"))


def duration(text: Column) -> Column:
    """MM:SS or HH:MM:SS in seconds; null for anything else."""
    parts = F.split(text, ":")
    n = [F.get(parts, i).try_cast("long") for i in range(3)]
    return F.when(F.size(parts) == 2, n[0] * 60 + n[1]).when(F.size(parts) == 3, n[0] * 3600 + n[1] * 60 + n[2])


def token(text: Column, name: str) -> Column:
    """The word after the first ``name:``, if the line has it."""
    return group(text, rf"{name}:\s*(\S+)", 1)


def is_metric(text: Column) -> Column:
    return text.contains("step:") & text.contains("loss:")


def metrics(text: Column) -> dict[str, Column]:
    number = lambda n: F.when(is_metric(text), token(text, n).try_cast("double"))
    return {"step": F.when(is_metric(text), big_number(token(text, "step"))), "loss": number("loss"), "lr": number("lr"), "grad_norm": number("grdn")}


def progress(text: Column) -> dict[str, Column]:
    """Step, total and seconds left of a bar: label, percent, the bar between two marks, step/total [spent<left, rate]."""
    parts = F.split(text, r"\|")
    percent = F.rtrim(F.trim(F.substring_index(F.get(parts, 0), "Training:", -1)), F.lit("%"))
    counts, times = F.trim(F.substring_index(F.get(parts, 2), "[", 1)), F.substring_index(F.get(parts, 2), "[", -1)
    left = F.when(times.contains("<"), group(F.substring_index(times, "<", -1), r"^[0-9:]+", 0))
    step, total = F.substring_index(counts, "/", 1).try_cast("long"), F.substring_index(counts, "/", -1).try_cast("long")
    whole = text.contains("Training:") & percent.try_cast("long").isNotNull() & counts.contains("/") & step.isNotNull() & total.isNotNull() & left.isNotNull()
    return {"bar_step": F.when(whole, step), "bar_total": F.when(whole, total), "eta_s": F.when(whole, duration(left))}
