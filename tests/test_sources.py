import json
import os

import pytest

from rillflow.plans.episodes import indexed
from rillflow.sources import repair
from rillflow.sources.discovery import datasets, episodes, find_recordings, listing, newest, ordered, recordings


def test_discovery(spark, tmp_path):
    for f in ("one/a.mcap", "two/metadata.yaml", "two/x.db3", "two/y.mcap", "three/metadata.yaml", "e/1.hdf5", "e/2.h5", "e/3.txt"):
        (tmp_path / f).parent.mkdir(exist_ok=True)
        (tmp_path / f).write_text("x")
    files = listing(spark, str(tmp_path))
    got = {r.bag.rpartition("/")[2]: r.storage for r in recordings(files).collect()}
    assert got == {"one": "mcap", "two": "sqlite3", "three": "unknown"}
    assert episodes(files).count() == 2
    assert [r.bag.rpartition("/")[2] for r in find_recordings(spark, str(tmp_path / "one" / "a.mcap")).collect()] == ["one"]
    with pytest.raises(ValueError):
        find_recordings(spark, str(tmp_path / "e" / "3.txt"))
    for i, f in enumerate(("one/a.mcap", "two/y.mcap", "two/x.db3", "two/metadata.yaml", "three/metadata.yaml")):
        os.utime(tmp_path / f, (1000 - i, 1000 - i))
    found, name = recordings(listing(spark, str(tmp_path))), lambda rows: [r.bag.rpartition("/")[2] for r in rows.collect()]
    assert name(newest(found)) == ["one"] and name(newest(found, 2)) == ["one", "two"]
    assert name(ordered(found, 2, "mtime")) == ["three", "two"] and name(ordered(found)) == ["one", "three", "two"] and name(ordered(found, -1)) == ["one", "three", "two"]
    with pytest.raises(ValueError):
        ordered(found, 1, "size")


def test_datasets(spark, tmp_path):
    for d, files in {"org/a": {"info": {"total_frames": 5, "fps": 30}}, "org/b": {"info": {"repo_id": "x/b"}}, "org/c": {"info": {"repo_id": "x/c"}, "conversion_manifest": {"repo_id": "y/c"}}}.items():
        (tmp_path / d / "meta").mkdir(parents=True)
        for name, doc in files.items():
            (tmp_path / d / "meta" / f"{name}.json").write_text(json.dumps(doc))
    got = {(r.repo_id, r.origin, r.frames) for r in datasets(spark, str(tmp_path)).collect()}
    assert got == {("org/a", "path", 5), ("x/b", "info", None), ("y/c", "manifest", None)}


def test_repair(spark, tmp_path):
    """Three shards, the second without a footer: only the first counts, and episodes past the last whole one are trimmed."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    shards = tmp_path / "data" / "chunk-000"
    shards.mkdir(parents=True)
    (tmp_path / "meta").mkdir()
    for i, episodes_ in enumerate([[0, 0, 0, 1, 1, 2], [3, 3], [4]]):
        pq.write_table(pa.table({"episode_index": episodes_, "task_index": [e % 2 for e in episodes_]}), shards / f"file-{i:03d}.parquet")
    assert repair.frames(spark, str(tmp_path)).count() == 0  # no tasks table: nothing was finished
    pq.write_table(pa.table({"task_index": [0, 1]}), tmp_path / "meta" / "tasks.parquet")
    broken = shards / "file-001.parquet"
    broken.write_bytes(broken.read_bytes()[:-4])
    assert {(r.file, r.broken, r.usable) for r in repair.readable(repair.probed(spark, str(tmp_path))).collect()} == {(0, False, True), (1, True, False), (2, False, False)}
    index = sorted((r.episode, r.length, r.from_idx, r.to_idx, r.tasks, r.file) for r in indexed(repair.frames(spark, str(tmp_path))).collect())
    assert index == [(0, 3, 0, 3, [0], 0), (1, 2, 3, 5, [1], 0), (2, 1, 5, 6, [0], 0)]
    assert repair.trimmed(spark, str(tmp_path), 1, str(tmp_path / "new")) == 1
    assert spark.read.parquet(str(tmp_path / "new")).count() == 5
