"""Serialised robot messages: header stamps as expressions, joint states in Arrow batches."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

NAMES = 4096


def header(sec: int, nanosec: int, little: bool = True, frame: str = "") -> bytes:
    """A message of a header only; for tests and fixtures."""
    o = "<" if little else ">"
    raw = frame.encode() + b"\0"
    return bytes([0, int(little), 0, 0]) + struct.pack(f"{o}iII", sec, nanosec, len(raw)) + raw


def joint_state(names: list[str], position: list[float], velocity: list[float]) -> bytes:
    body = bytearray(struct.pack("<iII", 1, 2, 1) + b"\0")

    def put(fmt: str, size: int, *v) -> None:
        body.extend(b"\0" * (-len(body) % size))
        body.extend(struct.pack("<" + fmt, *v))

    put("I", 4, len(names))
    for n in names:
        put("I", 4, len(n.encode()) + 1)
        body.extend(n.encode() + b"\0")
    for values in (position, velocity, []):
        put("I", 4, len(values))
        if values:
            put(f"{len(values)}d", 8, *values)
    return b"\0\1\0\0" + bytes(body)


def header_stamp(raw: Column) -> Column:
    """Nanoseconds of the stamp at byte 4, by the endian flag; null if short, not positive or over a second of nanoseconds."""
    little = F.conv(F.hex(F.substring(raw, 2, 1)), 16, 10).cast("int") % 2 == 1

    def word(at: int) -> Column:
        b = [F.hex(F.substring(raw, at + i, 1)) for i in range(4)]
        return F.conv(F.when(little, F.concat(*b[::-1])).otherwise(F.concat(*b)), 16, 10).cast("long")

    sec, nanosec = word(5), word(9)
    return F.when((F.length(raw) >= 12) & (sec > 0) & (sec < 2**31) & (nanosec < 1_000_000_000), sec * 1_000_000_000 + nanosec)


class _Body:
    """Reads the fields of a message after its 4 leading bytes; alignment counts from there."""

    def __init__(self, raw: bytes):
        if len(raw) < 4:
            raise ValueError("no message")
        self.order, self.body, self.at = "<" if raw[1] & 1 else ">", memoryview(raw)[4:], 0

    def numbers(self, kind: str, size: int, n: int = 1) -> np.ndarray:
        self.at += -self.at % size if n else 0
        out = np.frombuffer(self.body, f"{self.order}{kind}{size}", n, self.at) if n else np.zeros(0)
        self.at += n * size
        return out

    def uint(self) -> int:
        return int(self.numbers("u", 4)[0])

    def text(self) -> str:
        n = self.uint()
        if self.at + n > len(self.body):
            raise ValueError("text beyond the end")
        out = bytes(self.body[self.at : self.at + max(n - 1, 0)]).decode("utf-8", "replace")
        self.at += n
        return out

    def stamp(self) -> int | None:
        """Nanoseconds of a header, whose frame name is passed over."""
        sec, nanosec = int(self.numbers("i", 4)[0]), self.uint()
        self.text()
        return sec * 1_000_000_000 + nanosec if sec > 0 and nanosec < 1_000_000_000 else None

    def sequence(self, size: int) -> list[float]:
        return self.numbers("f", size, self.uint()).astype(float).tolist()


def _joint_state(b: _Body) -> dict | None:
    out = {"stamp_ns": b.stamp()}
    n = b.uint()
    if n > NAMES:
        return None
    out["name"] = [b.text() for _ in range(n)]
    out |= {f: b.sequence(8) for f in ("position", "velocity", "effort")}
    return out | {"trailing": len(b.body) - b.at}


def _multi_array(b: _Body) -> dict:
    for _ in range(b.uint()):  # dimensions: label, size, stride
        b.text()
        b.uint()
        b.uint()
    b.uint()  # offset of the data
    return {"data": b.sequence(4)}


def _read(raw: bytes | None, reader) -> dict | None:
    """The fields of a message; null if it is broken."""
    try:
        return reader(_Body(raw)) if raw is not None else None
    except (ValueError, TypeError, IndexError, struct.error):
        return None


def _parser(fields: dict, reader):
    """A pandas function from messages to a struct of ``fields``, all null for broken ones."""
    kind = StructType([StructField(k, v) for k, v in fields.items()])

    @F.pandas_udf(kind)
    def parse(raw: pd.Series) -> pd.DataFrame:
        rows = [_read(r, reader) or {} for r in raw]
        return pd.DataFrame({f: pd.Series([r.get(f) for r in rows], dtype=object) for f in fields})

    return parse


DOUBLES = ArrayType(DoubleType())


def parse_joint_state():
    """stamp_ns, name, position, velocity, effort and trailing: bytes after the message, which a strict reader refuses."""
    fields = {"stamp_ns": LongType(), "name": ArrayType(StringType()), "position": DOUBLES, "velocity": DOUBLES, "effort": DOUBLES, "trailing": IntegerType()}
    return _parser(fields, _joint_state)


def parse_joint_command(dim: int):
    """stamp_ns and position of a command with ``dim`` values."""
    return _parser({"stamp_ns": LongType(), "position": DOUBLES}, lambda b: {"stamp_ns": b.stamp(), "position": b.numbers("f", 8, dim).astype(float).tolist()})


def parse_float():
    """value of a message that is one 32-bit number and has no header."""
    return _parser({"value": DoubleType()}, lambda b: {"value": float(b.numbers("f", 4)[0])})


def parse_float_array():
    """data of an array of 32-bit numbers; its layout is passed over."""
    return _parser({"data": DOUBLES}, _multi_array)


@F.pandas_udf(BinaryType())
def _written(position: pd.Series, velocity: pd.Series) -> pd.Series:
    return pd.Series([joint_state([f"j{i}" for i in range(len(p))], list(p), list(v)) for p, v in zip(position, velocity, strict=True)])


def write_joint_states():
    """A pandas function from positions and velocities to joint messages; joints are named by number."""
    return _written


def decode_report(parsed: Column) -> list[Column]:
    """Aggregates of ``parse_joint_state``: messages, broken ones, and those that only a tolerant reader takes."""
    broken = parsed["name"].isNull()
    return [F.count("*").alias("n"), F.count_if(broken).alias("broken"), F.count_if(parsed["trailing"] > 0).alias("tolerant")]
