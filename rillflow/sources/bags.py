"""Recordings as tables: a batch data source over SQLite and MCAP files.

A partition is a range of a SQLite file's message ids, or a chunk of an MCAP file.  Filters on
topic and time are pushed down: into the SQLite query, and to the choice of MCAP chunks by
their index, so what isn't asked for isn't read.
"""

from __future__ import annotations

import os
import sqlite3
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..functions import cdr
from .profiles import Profile

SCHEMA = "bag string, topic string, kind string, seq bigint, t bigint, raw binary"
#: Messages of a SQLite partition.
ROWS = 50_000
#: The format's magic bytes and its record codes.
MAGIC = b"\x89MCAP0\r\n"
HEADER, FOOTER, SCHEMA_RECORD, CHANNEL, MESSAGE, CHUNK, MESSAGE_INDEX, CHUNK_INDEX = 1, 2, 3, 4, 5, 6, 7, 8


@dataclass
class Wanted:
    """What filters leave: topics (None: all) and a closed range of times."""

    topics: frozenset | None = None
    low: int = -(1 << 63)
    high: int = (1 << 63) - 1


@dataclass
class Part(InputPartition):
    path: str
    low: int
    high: int
    wanted: Wanted = field(default_factory=Wanted)

    def __init__(self, path: str, low: int, high: int, wanted: Wanted):
        self.path, self.low, self.high, self.wanted = path, low, high, wanted


# ---- MCAP


def _text(raw: bytes, at: int) -> tuple[str, int]:
    n = struct.unpack_from("<I", raw, at)[0]
    return raw[at + 4 : at + 4 + n].decode(), at + 4 + n


def records(raw: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at + 9 <= len(raw):
        code, n = struct.unpack_from("<BQ", raw, at)
        yield code, raw[at + 9 : at + 9 + n]
        at += 9 + n


def unpacked(method: str, raw: bytes, size: int) -> bytes:
    if not method:
        return raw
    if method == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompress(raw, max_output_size=size)
    if method == "lz4":
        return pa.input_stream(pa.BufferReader(raw), compression="lz4").read()
    raise ValueError(f"chunks compressed by {method} can't be read")


@dataclass
class Summary:
    """An MCAP file's summary section: (place, length, first and last time, channels) of each chunk, and the channels."""

    chunks: list[tuple[int, int, int, int, frozenset]]
    channels: dict[int, tuple[str, str]]
    definitions: dict[str, str]


def _channels(found: Iterator[tuple[int, bytes]]) -> tuple[dict[int, tuple[str, str]], dict[str, str]]:
    names, channels, texts = {}, {}, {}
    for code, raw in found:
        if code == SCHEMA_RECORD:
            number = struct.unpack_from("<H", raw)[0]
            name, at = _text(raw, 2)
            _, at = _text(raw, at)
            n = struct.unpack_from("<I", raw, at)[0]
            names[number], texts[name] = name, raw[at + 4 : at + 4 + n].decode("utf-8", "replace")
        elif code == CHANNEL:
            number, schema = struct.unpack_from("<HH", raw)
            channels[number] = (_text(raw, 4)[0], schema)
    return {k: (topic, names.get(schema, "")) for k, (topic, schema) in channels.items()}, texts


def summary(path: str) -> Summary:
    """Read from the file's end; chunks themselves aren't."""
    with open(path, "rb") as f:
        if f.read(8) != MAGIC:
            raise ValueError(f"{path} is no MCAP file")
        f.seek(-37, os.SEEK_END)  # the footer record and the closing magic
        end = f.read(37)
        if end[-8:] != MAGIC or end[0] != FOOTER:
            raise ValueError(f"{path} has no footer: its recording didn't end")
        start = struct.unpack_from("<Q", end, 9)[0]
        if not start:
            raise ValueError(f"{path} has no summary")
        size = f.seek(0, os.SEEK_END)
        f.seek(start)
        raw = f.read(size - 37 - start)
    chunks = []
    for code, body in records(raw):
        if code == CHUNK_INDEX:
            first, last, at, n, offsets = struct.unpack_from("<QQQQI", body)
            own = frozenset(struct.unpack_from("<H", body, 36 + i)[0] for i in range(0, offsets, 10))
            chunks.append((at, n, first, last, own))
    channels, texts = _channels(records(raw))
    return Summary(chunks, channels, texts)


def chunk_messages(path: str, at: int, length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """channel, seq, time, payload of a chunk."""
    with open(path, "rb") as f:
        f.seek(at)
        code, n = struct.unpack("<BQ", f.read(9))
        if code != CHUNK:
            raise ValueError(f"{path} has no chunk at {at}")
        body = f.read(n)
    size = struct.unpack_from("<Q", body, 16)[0]
    method, where = _text(body, 28)
    n = struct.unpack_from("<Q", body, where)[0]
    for code, raw in records(unpacked(method, body[where + 8 : where + 8 + n], size)):
        if code == MESSAGE:
            channel, seq, t = struct.unpack_from("<HIQ", raw)
            yield channel, seq, t, raw[22:]


# ---- SQLite


def connected(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def intact(path: str) -> bool:
    """Whether SQLite finds no fault in the file."""
    try:
        with connected(path) as con:
            return con.execute("PRAGMA quick_check(1)").fetchone()[0] == "ok"
    except sqlite3.DatabaseError:
        return False


# ---- the source


class BagReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths, self.wanted = paths, Wanted()

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column == "topic" and isinstance(f, (EqualTo, In)):
                own = frozenset([f.value] if isinstance(f, EqualTo) else f.value)
                self.wanted.topics = own if self.wanted.topics is None else self.wanted.topics & own
            elif column == "t" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.wanted.low = max(self.wanted.low, f.value + isinstance(f, GreaterThan))
            elif column == "t" and isinstance(f, (LessThan, LessThanOrEqual)):
                self.wanted.high = min(self.wanted.high, f.value - isinstance(f, LessThan))
            elif column == "t" and isinstance(f, EqualTo):
                self.wanted.low, self.wanted.high = max(self.wanted.low, f.value), min(self.wanted.high, f.value)
            else:
                yield f

    def partitions(self) -> list[Part]:
        out = []
        for path in self.paths:
            if path.endswith(".mcap"):
                s = summary(path)
                for at, length, first, last, own in s.chunks:
                    here = {s.channels[c][0] for c in own if c in s.channels}
                    if last >= self.wanted.low and first <= self.wanted.high and (self.wanted.topics is None or not own or here & self.wanted.topics):
                        out.append(Part(path, at, length, self.wanted))
            else:
                with connected(path) as con:
                    low, high = con.execute("SELECT min(id), max(id) FROM messages").fetchone()
                out += [Part(path, a, min(a + ROWS, high + 1), self.wanted) for a in range(low, high + 1, ROWS)] if low is not None else []
        return out or [Part("", 0, 0, self.wanted)]

    def read(self, part: Part) -> Iterator[tuple]:
        if not part.path:
            return
        bag, w = os.path.dirname(part.path), part.wanted
        if part.path.endswith(".mcap"):
            channels = summary(part.path).channels
            for channel, seq, t, raw in chunk_messages(part.path, part.low, part.high):
                topic, kind = channels[channel]
                if w.low <= t <= w.high and (w.topics is None or topic in w.topics):
                    yield bag, topic, kind, seq, t, raw
            return
        with connected(part.path) as con:
            topics = {i: (name, kind) for i, name, kind in con.execute("SELECT id, name, type FROM topics") if w.topics is None or name in w.topics}
            if not topics:
                return
            marks = ",".join("?" * len(topics))
            rows = con.execute(f"SELECT id, topic_id, timestamp, data FROM messages WHERE id >= ? AND id < ? AND timestamp BETWEEN ? AND ? AND topic_id IN ({marks})", (part.low, part.high, w.low, w.high, *topics))
            for number, topic, t, raw in rows:
                yield bag, *topics[topic], number, t, bytes(raw)


class Bags(DataSource):
    """``spark.read.format("bags").load(folder or file)``: bag, topic, kind, seq, t, raw of all messages."""

    @classmethod
    def name(cls) -> str:
        return "bags"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BagReader:
        return BagReader(files(self.options["path"]))


def files(source: str) -> list[str]:
    """A recording's files: SQLite wins where a folder has both."""
    if os.path.isfile(source):
        return [source]
    out = []
    for folder, _, names in sorted(os.walk(source)):
        own = sorted(n for n in names if n.endswith(".db3")) or sorted(n for n in names if n.endswith(".mcap"))
        out += [os.path.join(folder, n) for n in own]
    return out


def read_bags(spark: SparkSession, source: str) -> DataFrame:
    """All messages below a folder that every executor sees."""
    spark.dataSource.register(Bags)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("bags").load(source)


def decoded(messages: DataFrame, profile: Profile) -> DataFrame:
    """bag_id, topic, seq, t, h, values, velocities of a profile's messages, for ``operators.profiled``; one pass.

    Images are not decoded.  Joints are put in the profile's order by their names; a message that is broken, or lacks a
    joint, has null values.
    """
    raw, topic = F.col("raw"), F.col("topic")
    joints = [profile.state_topic, *[s.topic for e in profile.effectors for s in (e.command, e.state) if s and s.header]]
    arrays = [s.topic for e in profile.effectors for s in (e.command, e.state) if s and not s.header and s.pick]
    floats = [s.topic for e in profile.effectors for s in (e.command, e.state) if s and not s.header and not s.pick]
    images = [*profile.cameras.values(), *profile.depths.values()]
    of = lambda topics: F.when(topic.isin(*topics), raw)
    df = messages.where(topic.isin(*images, *profile.sides()))
    df = df.withColumn("_j", cdr.parse_joint_state()(of(joints))).withColumn("_c", cdr.parse_joint_command(profile.command_width)(of(profile.commands)))
    df = df.withColumn("_a", cdr.parse_float_array()(of(arrays or [""]))).withColumn("_f", cdr.parse_float()(of(floats or [""])))

    def ordered(values: Column) -> Column:
        """Values by the names that the profile has for the topic."""
        out = F.when(F.lit(False), values)
        named = ([(profile.state_topic, profile.joints)] if profile.named else []) + [(s.topic, e.names) for e in profile.effectors for s in (e.command, e.state) if s and s.header]
        for t, names in named:
            places = [F.array_position("_j.name", n) for n in names]
            known = F.lit(True)
            for p in places:
                known = known & (p > 0)
            # an effector's messages may come without names; an arm's may not
            mine = known if t == profile.state_topic else known & (F.size("_j.name") > 0)
            other = F.lit(None).cast("array<double>") if t == profile.state_topic else values
            out = out.when(topic == t, F.when(mine, F.array(*[F.get(values, (p - 1).cast("int")) for p in places])).otherwise(other))
        return out.otherwise(values)

    values = F.when(topic.isin(*joints), ordered(F.col("_j.position"))).when(topic.isin(*profile.commands), F.col("_c.position"))
    values = values.when(topic.isin(*(arrays or [""])), F.col("_a.data")).when(topic.isin(*(floats or [""])) & F.col("_f.value").isNotNull(), F.array("_f.value"))
    h = F.when(topic.isin(*images), cdr.header_stamp(raw)).when(topic.isin(*joints), F.col("_j.stamp_ns")).when(topic.isin(*profile.commands), F.col("_c.stamp_ns"))
    speed = F.when((topic == profile.state_topic) & (F.size("_j.velocity") == F.size("_j.position")), ordered(F.col("_j.velocity")))
    return df.select(F.col("bag").alias("bag_id"), "topic", "seq", "t", h.alias("h"), values.alias("values"), speed.alias("velocities"))


def definitions(path: str, profile: dict[str, str] | None = None) -> dict[str, str]:
    """Message definitions by type name: those that the file holds, and a profile's for the rest; a type with neither is an error."""
    profile = profile or {}
    if path.endswith(".mcap"):
        s = summary(path)
        kinds, own = {k for _, k in s.channels.values()}, {k: v for k, v in s.definitions.items() if v}
    else:
        with connected(path) as con:
            kinds = {k for (k,) in con.execute("SELECT type FROM topics")}
            there = con.execute("SELECT 1 FROM sqlite_master WHERE name = 'message_definitions'").fetchone()
            own = dict(con.execute("SELECT topic_type, encoded_message_definition FROM message_definitions")) if there else {}
    out = {k: own.get(k) or profile.get(k, "") for k in kinds}
    if lacking := sorted(k for k, v in out.items() if not v and not k.startswith(("std_msgs/", "sensor_msgs/"))):
        raise ValueError(f"no definition of {', '.join(lacking)}: give it in the profile")
    return out
