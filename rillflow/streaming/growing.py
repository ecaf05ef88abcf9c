"""A streaming source of growing log files, and a sink that holds one state file a job."""

from __future__ import annotations

import io
import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage

#: Bytes that a task reads, and that the driver looks back for the last line's end at a time.
PIECE, BACK = 32 << 20, 1 << 16
LINES = "job string, made timestamp, file string, place bigint, line string"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


@dataclass
class Piece(InputPartition):
    """Lines of ``file`` that begin in [start, end)."""

    file: str
    start: int
    end: int
    limit: int
    made: int

    def __init__(self, file: str, start: int, end: int, limit: int, made: int):
        self.file, self.start, self.end, self.limit, self.made = file, start, end, limit, made


class GrowingReader(DataSourceStreamReader):
    """Offsets are a byte position for each file, always after a line's end, so a half line waits until it is whole.

    The driver lists the files and looks for the last line's end in what is new; it reads no
    lines.  A file that shrank was written anew and starts from 0.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {}

    def _ends(self) -> dict[str, int]:
        system, root = opened(self.folder)
        found = {}
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if info.type != fs.FileType.File or posixpath.basename(info.path).startswith((".", "_")):
                continue
            with system.open_input_file(info.path) as f:
                end = f.size()
                while end > 0:
                    low = max(0, end - BACK)
                    at = f.read_at(end - low, low).rfind(b"\n")
                    if at >= 0:
                        end = low + at + 1
                        break
                    end = low
            found[info.path] = end
        return found

    def latestOffset(self) -> dict:
        return {k: v for k, v in sorted(self._ends().items()) if v}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        system, _ = opened(self.folder)
        out = []
        for file, to in end.items():
            a = start.get(file, 0)
            a = 0 if a > to else a
            if a < to:
                made = system.get_file_info(file).mtime_ns // 1000
                out += [Piece(file, low, min(low + PIECE, to), to, made) for low in range(a, to, PIECE)]
        return out

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.folder)
        job = posixpath.basename(posixpath.dirname(piece.file))
        with io.BufferedReader(system.open_input_file(piece.file), 1 << 20) as f:
            at = piece.start
            if at:  # a line that began before is another piece's
                f.seek(at - 1)
                at += len(f.readline()) - 1
            f.seek(at)
            places: list[int] = []
            lines: list[str] = []
            while at < piece.end:
                raw = f.readline()
                if not raw or at + len(raw) > piece.limit:
                    break
                places.append(at)
                lines.append(raw.rstrip(b"\r\n").decode("utf-8", "replace"))
                at += len(raw)
                if len(lines) == 10_000:
                    yield self._batch(job, piece, places, lines)
                    places, lines = [], []
            if lines:
                yield self._batch(job, piece, places, lines)

    def _batch(self, job: str, piece: Piece, places: list[int], lines: list[str]) -> pa.RecordBatch:
        n = len(lines)
        columns = [pa.array([job] * n), pa.array([piece.made] * n, pa.timestamp("us", "UTC")), pa.array([piece.file] * n), pa.array(places, pa.int64()), pa.array(lines)]
        return pa.RecordBatch.from_arrays(columns, ["job", "made", "file", "place", "line"])

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


@dataclass
class Staged(WriterCommitMessage):
    """(job, staged file) of a task."""

    files: tuple[tuple[str, str], ...] = ()


class StateWriter(DataSourceStreamWriter):
    """One JSON file a job, replaced by a rename; tasks stage the files, the driver renames them.

    The last committed batch is remembered in ``_batch``: a batch that is tried again changes nothing.
    Staged files of a failed batch are removed.  A query's trigger is how often a file can be replaced.
    """

    def __init__(self, path: str, key: str, names: list[str]):
        self.path, self.key, self.names = path, key, names

    def write(self, rows: Iterator) -> Staged:
        system, root = opened(self.path)
        system.create_dir(f"{root}/_staged", recursive=True)
        last = {}
        for row in rows:
            last[row[self.key]] = row
        out = []
        for job, row in last.items():
            name = f"{root}/_staged/{uuid.uuid4().hex}"
            with system.open_output_stream(name) as f:
                f.write(json.dumps({c: row[c] for c in self.names}, default=str, sort_keys=True).encode())
            out.append((str(job), name))
        return Staged(tuple(out))

    def _committed(self, system: fs.FileSystem, root: str) -> int:
        if system.get_file_info(f"{root}/_batch").type != fs.FileType.File:
            return -1
        with system.open_input_stream(f"{root}/_batch") as f:
            return int(f.read())

    def _discard(self, system: fs.FileSystem, messages) -> None:
        for m in messages:
            for _, name in m.files if m else ():
                if system.get_file_info(name).type == fs.FileType.File:
                    system.delete_file(name)

    def commit(self, messages: list, batchId: int) -> None:
        system, root = opened(self.path)
        if batchId <= self._committed(system, root):
            self._discard(system, messages)
            return
        for m in messages:
            for job, name in m.files if m else ():
                system.move(name, f"{root}/{job.replace('/', '_')}.json")
        mark = f"{root}/_staged/{uuid.uuid4().hex}"
        system.create_dir(f"{root}/_staged", recursive=True)
        with system.open_output_stream(mark) as f:
            f.write(str(batchId).encode())
        system.move(mark, f"{root}/_batch")

    def abort(self, messages: list, batchId: int) -> None:
        system, _ = opened(self.path)
        self._discard(system, messages)


class GrowingLogs(DataSource):
    """``readStream.format("growing_logs").load(folder)``: whole lines of all files below a folder as they are appended."""

    @classmethod
    def name(cls) -> str:
        return "growing_logs"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader(self.options["path"])


class JobStates(DataSource):
    """``writeStream.format("job_states").option("key", ...).start(folder)``: the last row of each key as a file of its own."""

    @classmethod
    def name(cls) -> str:
        return "job_states"

    def schema(self) -> str:
        return "job string"

    def streamWriter(self, schema, overwrite: bool) -> StateWriter:
        return StateWriter(self.options["path"], self.options.get("key", "job"), [f.name for f in schema.fields])


def register(spark) -> None:
    for source in (GrowingLogs, JobStates):
        spark.dataSource.register(source)
