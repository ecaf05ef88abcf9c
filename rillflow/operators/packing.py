"""Next fit over ordered rows without one task for a whole key.

Rows are laid out in the order of key and ``order`` and cut into shards, each of which a task
reads as a stream of blocks.  Which bin is open at a shard's first row isn't known then, but
the first row that opens a bin in the shard is one of few: at most as many rows as a bin holds.
A shard follows all of them, until they share an opened bin; from there on its rows
have their bins but for a number to add.  One row a shard, what it makes of each of these
rows, meets in one place, where the shards' open bins follow in order.  Then the numbers are
added, and the rows at the start of a shard that weren't known are read once more.
Without a most of rows, bins that are longer than shards make all rows of a shard candidates,
and four numbers of each meet there.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import ROUND_FLOOR, ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from .buckets import ROWS
from .cuts import cut

#: Sizes that aren't whole are exact in units of 1e-9.
EXACT = "decimal(30,9)"
#: What a shard's rows have besides their own columns; ``_map`` (JSON) is of the one row that sums up the shard.
LAID = {"_shard": pa.int32(), "_at": pa.int64(), "_x": pa.int64(), "_bin": pa.int64(), "_offset": pa.float64(), "_map": pa.string()}
LAID_DDL = "_shard int, _at long, _x long, _bin long, _offset double, _map string"


def _key(by: list[str]) -> Column:
    return F.to_json(F.struct(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")).alias(c) for c in by]))


@dataclass(frozen=True)
class Bins:
    """Capacity and most rows of a bin; the capacity in units, ``per`` units are 1."""

    cap: int
    per: float
    most: int | None

    @property
    def block(self) -> int:
        """Rows whose sizes, up to a unit over the capacity each, add up in 64 bits."""
        return max(1, (1 << 62) // (self.cap + 1))


def scaled(rows: DataFrame, size: str, cap: float, most: int | None) -> tuple[Column, Bins]:
    """Sizes in units, and the bins in them; what is over the capacity is a unit over it, as no row joins it.

    Whole sizes stay what they are.  Units are coarser where the capacity is over 2e9 (2e18 for
    whole sizes), yet finer than a double of that size.
    """
    whole = isinstance(rows.schema[size].dataType, IntegralType)
    exact, places = Decimal(repr(float(cap))), 0 if whole else 9
    while exact.scaleb(places) >= 1 << 61:
        places -= 1
    top = int(exact.scaleb(places).to_integral_value(ROUND_FLOOR if whole else ROUND_HALF_UP))
    x = F.coalesce(F.col(size), F.lit(0))
    if whole and places == 0:
        x = F.least(x.cast("long"), F.lit(top + 1).cast("long"))
    else:
        x = F.round(F.least(x.cast(EXACT) * F.lit(Decimal(10) ** places), F.lit(Decimal(top + 1)))).cast("long")
    return x, Bins(top, 10.0**places, most)


# --- a block: sizes x, and their sums before each row and at the end ---------------


def links(x: np.ndarray, sums: np.ndarray, ends: np.ndarray, bins: Bins) -> np.ndarray:
    """For a bin that each row would open, the row that opens the next one; the row's end of ``ends`` if none before does."""
    i = np.arange(len(x))
    over = np.searchsorted(sums[1:], sums[:-1] + bins.cap, "right")
    if bins.most is None:
        some = np.flatnonzero(x)
        to = np.maximum(over, np.append(some, len(x))[np.searchsorted(some, i)] + 1)
    else:
        to = np.minimum(np.maximum(over, i + 1), i + bins.most)
    return np.minimum(to, ends)


def opening(sums: np.ndarray, n: np.ndarray, s: np.ndarray, bins: Bins) -> np.ndarray:
    """The first row that opens a bin while one of ``n`` rows and size ``s`` is open (0 rows: none is); their number if none does.  Sums are after each row."""
    at = np.searchsorted(sums, bins.cap - s, "right")
    if bins.most is None:
        at = np.where(s == 0, np.maximum(at, np.searchsorted(sums, 0, "right") + 1), at)
    else:
        at = np.minimum(at, bins.most - n)
    return np.where(n == 0, 0, np.minimum(at, len(sums)))


def lay(x: np.ndarray, new: np.ndarray, state: tuple[int, int, int] | None, bins: Bins) -> tuple[int, np.ndarray, np.ndarray, tuple[int, int, int] | None]:
    """The first row of another key, and for each row bin and size before it in the bin; ``new`` marks the first rows of keys.

    ``state`` has rows and size of the open bin and how many bins were opened; it is returned as it is after the block.
    If it is None, the rows before another key aren't known.
    """
    i, starts = np.arange(len(x)), np.flatnonzero(new)
    lead = int(starts[0]) if len(starts) else len(x)
    sums = np.append(0, np.cumsum(x))
    n, s, opened = state or (0, 0, 0)
    at = lead if state is None else min(lead, int(opening(sums[1:], np.array(n), np.array(s), bins)))
    to = links(x, sums, np.append(starts, len(x))[np.searchsorted(starts, i, "right")], bins).tolist()
    opens = []
    while at < len(x):
        opens.append(at)
        at = to[at]
    upto = np.searchsorted(opens, i, "right")
    offset = sums[:-1] - np.append(-s, sums[np.array(opens, np.int64)])[upto]
    number = upto - 1 + opened
    if lead < len(x):
        number[lead:] = upto[lead:] - upto[starts[np.searchsorted(starts, i[lead:], "right") - 1]]
    if opens:
        state = len(x) - opens[-1], int(sums[-1] - sums[opens[-1]]), int(number[-1]) + 1
    elif state is not None:
        state = n + len(x), s + int(sums[-1]), opened
    return lead, number, offset, state


class Heads:
    """All rows that may be the first of a shard to open a bin, and what became of each: rows and size of the bin that is open now, bins opened."""

    def __init__(self, bins: Bins):
        self.limits, self.rows, self.size, self.closed = bins, 0, 0, False
        self.up = self.n = self.s = self.bins = np.zeros(0, np.int64)

    def add(self, x: np.ndarray) -> None:
        m, sums = len(x), np.append(0, np.cumsum(x))
        to, i = links(x, sums, np.full(m, m), self.limits), np.arange(m)
        last, hops = np.where(to < m, to, i), (to < m).astype(np.int64)
        while (more := hops[last]).any():  # the last bin that the block opens, by doubling
            hops, last = hops + more, last[last]
        at = opening(sums[1:], self.n, self.s, self.limits)
        row, opens = np.minimum(at, m - 1), at < m
        self.n = np.where(opens, m - last[row], self.n + m)
        self.s = np.where(opens, sums[-1] - sums[last[row]], self.s + sums[-1])
        self.bins = self.bins + np.where(opens, hops[row] + 1, 0)
        if not self.closed:
            # the bin that holds out longest has one row without a size
            end = int(opening(sums[1:], np.array(self.rows + 1), np.array(self.size), self.limits))
            row = i[: end + 1]
            if self.limits.most is None:
                row = row[(x[row] > 0) | (row + self.rows == 0) | (row == end)]  # others have no size to open one
            self.up = np.append(self.up, self.size + sums[row + 1])
            self.n, self.s, self.bins = np.append(self.n, m - last[row]), np.append(self.s, sums[-1] - sums[last[row]]), np.append(self.bins, hops[row] + 1)
            self.rows, self.size, self.closed = self.rows + m, self.size + int(sums[-1]), end < m

    def one(self) -> tuple[int, int, int] | None:
        """The open bin, if it is the same for all; bins are counted from here."""
        return (int(self.n[0]), int(self.s[0]), 0) if self.closed and (self.n == self.n[0]).all() else None


# --- shards ------------------------------------------------------------------------

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _merged(batches: Iterator[pa.RecordBatch], key: str, order: str) -> Iterator[pa.RecordBatch]:
    """Neighbours of one key and place are one row, of the greatest size."""
    held = None
    for batch in batches:
        batch = batch if held is None else pa.concat_batches([held, batch])
        if m := batch.num_rows:
            starts = np.flatnonzero(np.append(True, _steps(batch.column(key)) | _steps(batch.column(order))))
            if len(starts) < m:
                x = pa.array(np.maximum.reduceat(batch.column("_x").to_numpy(), starts))
                batch = batch.take(pa.array(starts)).set_column(batch.schema.get_field_index("_x"), "_x", x)
            held = batch.slice(len(starts) - 1)  # the next batch may go on with it
            yield batch.slice(0, len(starts) - 1)
    if held is not None:
        yield held


def _steps(column: pa.Array) -> np.ndarray:
    """For each but the first value, whether it isn't the one before."""
    a, b = column[:-1], column[1:]
    return pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def _shard(names: list[str], key: str, bins: Bins, merged: str | None, offsets: bool) -> Run:
    """A shard's rows with ``LAID``: ``_bin`` lacks a number where there is a shard; where it isn't known, place and size are there instead.  Last, a row with ``_map``.

    Repeats in the order of ``merged`` are merged before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows, first, last, single, state, heads = TaskContext.get().partitionId(), 0, None, None, True, None, Heads(bins)
        for batch in _blocks(_merged(batches, key, merged) if merged else batches, bins.block):
            m, x, keys = batch.num_rows, batch.column("_x").to_numpy(), batch.column(key)
            new = np.append(rows > 0 and keys[0].as_py() != last, _steps(keys)).astype(bool)
            first, last = (first if rows else keys[0].as_py()), keys[m - 1].as_py()
            known = state is not None
            lead, number, offset, state = lay(x, new, state, bins)
            head = (np.arange(m) < lead) & single
            hidden = head & (not known)
            laid = {"_shard": pa.array(np.full(m, shard, np.int32), mask=~head), "_at": pa.array(np.arange(rows, rows + m), mask=~hidden), "_x": pa.array(x, mask=~hidden), "_bin": pa.array(number, mask=hidden)}
            laid["_offset"] = pa.array(offset / bins.per, mask=hidden) if offsets else pa.nulls(m, pa.float64())
            laid["_map"] = pa.nulls(m, pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *laid.values()], [*names, *LAID])
            rows, single = rows + m, single and lead == m
            if state is None:
                heads.add(x)
                state = heads.one()
        if rows:
            arrays = {c: getattr(heads, c).tolist() for c in ("up", "n", "s", "bins")}
            sums = json.dumps({"first": first, "last": last, "single": single, "rows": heads.rows, "size": heads.size, "end": state} | arrays)
            laid = [pa.array([shard], pa.int32()), *[pa.nulls(1, t) for t in list(LAID.values())[1:-1]], pa.array([sums])]
            yield pa.RecordBatch.from_arrays([*[pa.nulls(1, batch.schema.field(c).type) for c in names], *laid], [*names, *LAID])

    return run


ENTERED = "_shard int, _n long, _s long, _opened long, _number long"


def _entered(bins: Bins) -> Run:
    """From the shards' maps in order: rows, size and number of the bin that is open where each begins (none: 0 rows), and the number that its known rows lack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, (0, 0, 0)
        for batch in _blocks(batches, 1):
            m = json.loads(batch.column("_map")[0].as_py())
            rows, size, opened = state if m["first"] == last else (0, 0, 0)
            at = int(opening(np.array(m["up"], np.int64), np.array(rows), np.array(size), bins))
            number = opened + (m["bins"][at] if at < len(m["bins"]) else 0)
            yield pa.RecordBatch.from_arrays([batch.column("_shard"), *[pa.array([v], pa.int64()) for v in (rows, size, opened, number)]], ["_shard", "_n", "_s", "_opened", "_number"])
            if not m["single"]:
                state = m["end"]
            elif m["end"]:
                state = m["end"][0], m["end"][1], number + m["end"][2]
            elif at < len(m["n"]):
                state = m["n"][at], m["s"][at], number
            else:
                state = rows + m["rows"], size + m["size"], opened
            last = m["last"]

    return run


def _again(names: list[str], bins: Bins) -> Run:
    """Rows at the start of shards, in order, with bin and offset from the bin that is open there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, state = None, None
        for batch in _blocks(batches, bins.block):
            x, shards = batch.column("_x").to_numpy(), batch.column("_shard").to_numpy()
            numbers, offsets = [], []
            starts = np.append(0, np.flatnonzero(np.diff(shards)) + 1)
            for a, b in zip(starts, np.append(starts[1:], len(x)), strict=True):
                if shards[a] != shard:
                    shard, state = shards[a], tuple(batch.column(c)[int(a)].as_py() for c in ("_n", "_s", "_opened"))
                _, number, offset, state = lay(x[a:b], np.zeros(b - a, bool), state, bins)
                numbers.append(number)
                offsets.append(offset)
            out = [pa.array(np.concatenate(numbers).astype(np.int32)), pa.array(np.concatenate(offsets) / bins.per)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *out], [*names, "bin", "offset"])

    return run


def next_fit(rows: DataFrame, by: list[str], order: str, size: str, cap: float, most: int | None = None, repeats: bool = False, offsets: bool = True) -> DataFrame:
    """``rows`` with bin (from 0) and, with ``offsets``, offset in it, for each key ``by`` in the order of ``order`` (unique in a key).

    A row opens a bin if the size so far and its own are over ``cap``, or if the bin has
    ``most`` rows.  Without ``most`` a bin that has no size yet takes any row.  Null is 0; sizes aren't negative.
    With ``repeats``, ``order`` needn't be unique: rows that share it in a key are one, of the greatest size, and only ``by`` and ``order`` are kept of them.
    """
    shards = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS))
    x, bins = scaled(rows, size, cap, most)
    names = [*by, order] if repeats else rows.columns
    kind = [StructField(f.name, f.dataType) for f in rows.select(*names).schema]
    # a text is its own key
    key = by[0] if len(by) == 1 and rows.schema[by[0]].dataType == StringType() else "_key"
    laid = rows.select(*names, x.alias("_x")).repartitionByRange(shards, _key(by) if key == "_key" else key, order)
    laid = (laid.withColumn("_key", _key(by)) if key == "_key" else laid).sortWithinPartitions(key, order)
    laid = cut(laid.mapInArrow(_shard(names, key, bins, order if repeats else None, offsets), StructType(kind + StructType.fromDDL(LAID_DDL).fields)))
    maps = laid.where("_map IS NOT NULL").select("_shard", "_map").repartition(1).sortWithinPartitions("_shard")
    entered = F.broadcast(cut(maps.mapInArrow(_entered(bins), ENTERED)))  # a row a shard
    number = (F.col("_bin") + F.coalesce("_number", F.lit(0))).cast("int")
    known = laid.where("_bin IS NOT NULL").join(entered, "_shard", "left").select(*names, number.alias("bin"), F.col("_offset").alias("offset"))
    rest = laid.where("_at IS NOT NULL").select(*names, "_shard", "_at", "_x").repartition(shards, "_shard").join(entered, "_shard").sortWithinPartitions("_shard", "_at")
    out = known.unionByName(rest.mapInArrow(_again(names, bins), StructType([*kind, *StructType.fromDDL("bin int, offset double").fields])))
    return out if offsets else out.drop("offset")
