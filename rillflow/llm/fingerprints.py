"""Homomorphic multiset fingerprints of documents.

Every paragraph (a line with any character) is hashed by an extendable hash to a wide
vector: 1024 lanes of 16 random bits, and beside them 128 lanes of +1 or -1.  A
document's fingerprint is the sum of its paragraphs' vectors modulo 2**16 in each
lane.  The sum doesn't depend on the order, and a paragraph is inserted or deleted by
adding or subtracting its vector.  The wide lanes tell multisets apart: two unequal
ones agree by chance with probability 2**-16384, and by design only if someone finds a
short relation among random vectors.  (A paragraph repeated 2**16 times is the one
exception: it adds nothing.)  The squared distance of the sign lanes estimates the
number of paragraphs in which documents differ, which gives their likeness.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut, drop

SIGNS, WIDE = 128, 1024
#: Documents that a part of the order holds.
PART = 4_000


def fingerprints(texts: list[str]) -> np.ndarray:
    """One row of int16 lanes for each text: the sign lanes, then the wide ones."""
    size = SIGNS // 8 + 2 * WIDE
    digests, rows = [], []
    out = np.zeros((len(texts), SIGNS + WIDE), np.int16)

    def add() -> None:
        lanes = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, size)
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        own = np.array(rows)[starts]
        signs = np.unpackbits(lanes[:, : SIGNS // 8], axis=1).astype(np.int16) * np.int16(2) - np.int16(1)
        wide = np.ascontiguousarray(lanes[:, SIGNS // 8 :]).view(">i2").astype(np.int16)
        out[own, :SIGNS] += np.add.reduceat(signs, starts, axis=0, dtype=np.int16)
        out[own, SIGNS:] += np.add.reduceat(wide, starts, axis=0, dtype=np.int16)
        digests.clear()
        rows.clear()

    for i, t in enumerate(texts):
        for x in t.split("\n"):
            if x:
                digests.append(hashlib.shake_128(x.encode()).digest(size))
                rows.append(i)
                if len(rows) == 1 << 12:  # in blocks, so that one long text needs no more memory
                    add()
    if rows:
        add()
    return out


def inserted(fingerprint: str, paragraphs: Iterable[str], sign: int = 1) -> str:
    """A fingerprint with paragraphs added (or with ``sign`` -1, deleted)."""
    return to_text(from_text(fingerprint) + np.int16(sign) * fingerprints(["\n".join(paragraphs)])[0])


def to_text(lanes: np.ndarray) -> str:
    """Base64 of the lanes, high byte first."""
    return base64.b64encode(lanes.astype(">i2").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">i2").astype(np.int16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 - |a - b|^2 / (|a|^2 + |b|^2) of the rows' sign lanes, not under 0; 1 for two empty documents."""
    a, b = a[:, :SIGNS], b[:, :SIGNS]
    d = (a - b).astype(np.float64)
    both = (a.astype(np.float64) ** 2).sum(axis=1) + (b.astype(np.float64) ** 2).sum(axis=1)
    return np.clip(1 - (d**2).sum(axis=1) / np.where(both > 0, both, 1), 0, 1)


def _part_of(ids: np.ndarray, null: np.ndarray, keys: np.ndarray, splits: list[tuple[int | None, int]]) -> tuple[np.ndarray, np.ndarray]:
    """How many of the ordered splits (id, key; null ids first) are under each row, and whether the next one is the row's own."""
    low = np.array([k for i, k in splits if i is None], np.int64)
    tops, ends = (np.array([s[j] for s in splits if s[0] is not None], np.int64) for j in (0, 1))
    first, last = np.searchsorted(tops, ids, "left"), np.searchsorted(tops, ids, "right")
    part = first + len(low)
    own = np.zeros(len(ids), bool)
    for i in np.unique(ids[(first < last) & ~null]):  # ids that are splits: few
        rows = np.flatnonzero((ids == i) & ~null)
        here = ends[first[rows[0]] : last[rows[0]]]
        under = np.searchsorted(here, keys[rows])
        part[rows] += under
        own[rows] = here[np.minimum(under, len(here) - 1)] == keys[rows]
    part[null] = np.searchsorted(low, keys[null])
    if len(low):
        own[null] = low[np.minimum(part[null], len(low) - 1)] == keys[null]
    return part, own


def _dealt(splits: list[tuple[int | None, int]]):
    """Each row with its part of the order; the first row of a part also ends the part that comes before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null = np.asarray(batch.column(0).is_null())
            ids, keys = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
            part, own = _part_of(ids, null, keys, splits)
            take = np.concatenate([np.arange(len(part)), np.flatnonzero(own)])
            halo = np.arange(len(take)) >= len(part)
            part = np.where(halo, (part[take] + 1) % max(len(splits), 1), part[take])
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(halo), *(batch.column(i).take(pa.array(take)) for i in range(3))], ["part", "halo", "doc_id", "tkey", "text"])

    return run


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a part in order, the row after the last with ``halo``: fingerprints of each text and its edited text."""
    held = None  # the last row of the batch before
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            rows = batch.slice(lo, 500)
            part, halo, ids, texts = (rows.column(i).to_pylist() for i in (0, 1, 2, 4))
            prints = fingerprints(texts)
            if held is not None:
                part, halo, ids, texts = ([h, *x] for h, x in zip(held, (part, halo, ids, texts), strict=False))
                prints = np.concatenate([held[4][None], prints])
            own = [i for i in range(len(part) - 1) if not halo[i] and part[i] == part[i + 1]]
            held = (part[-1], halo[-1], ids[-1], texts[-1], prints[-1])
            edited = [texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][: len(texts[i]) // 2] for i in own]
            after = fingerprints(edited)
            own = np.array(own, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i] for i in own], pa.int64()),
                    pa.array([len(texts[i]) for i in own], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                    pa.array([to_text(prints[i]) for i in own], pa.string()),
                    pa.array([to_text(x) for x in after], pa.string()),
                    pa.array(likeness(prints[own], after)),
                    pa.array(likeness(prints[own], prints[own + 1])),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )


def fingerprint_edits(docs: DataFrame, part: int = PART) -> DataFrame:
    """Fingerprints of each text and of its edited text, one row for each row of ``docs``.

    The edited text has the last half of the text's characters replaced by as many (or
    all) of the next document's first ones.  Next is by descending doc_id, equal ids by
    descending hash of the text, rows without id last; after the last row comes the
    first.  Null text is empty.

    Ids and hashes, without the texts, are sorted into ranges of about ``part`` rows; a
    range's last id and hash come to the driver (16 bytes a part: ``part`` bounds them) and
    deal the texts to parts, which then move once.  A part's first row goes also to the
    part before it, so each part is whole by itself.  With the table the number of parts
    and tasks grows, not their size.  Rows of one id, and rows without, are spread by
    the hash.  Only rows that agree in id and text share a part.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tkey"), text.alias("text"))
    keys = cut(rows.select("doc_id", "tkey"))
    ranges = keys.repartitionByRange(keys.count() // part + 1, F.asc_nulls_first("doc_id"), F.asc("tkey"))
    top = F.max(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "tkey")).alias("top")
    ends = ranges.groupBy(F.spark_partition_id().alias("range")).agg(top).select("top.doc_id", "top.tkey").collect()
    drop(keys)
    splits = sorted(map(tuple, ends), key=lambda s: (s[0] is not None, s[0] or 0, s[1]))
    dealt = rows.mapInArrow(_dealt(splits), "part long, halo boolean, doc_id long, tkey long, text string")
    order = "part", "halo", F.desc_nulls_last("doc_id"), F.desc("tkey")
    # so many tasks that few get several parts
    ordered = dealt.repartition(2 * len(splits) + 1, "part").sortWithinPartitions(*order)
    out = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(_edited, out)
