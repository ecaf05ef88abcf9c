"""Exact top-k search by inner product over an impact-ordered index.

Rows are hashed into blocks.  A block's index has, for each dimension, its components
quantised to levels and a posting list of rows for each (dimension, level): a segment.
For a query a segment has an impact, the query's component times the level's.  Segments
are processed score at a time, by descending size of the impact: their postings add the
greatest contribution that the level allows to the accumulators of their rows.  What
a row still lacks is at most the next impact for each dimension it hasn't been met in.  After
each round the best accumulators are scored exactly, which raises the k-th best score known; rows
whose bound is below it are out, and that is the only ground on which any row is left.
Once the possible members are fewer than what another round would cost, they are
scored exactly.

The index covers every row.  Queries, in chunks, meet blocks, in slices; a slice's
k-th best scores carry over to its next block, and each (chunk, slice) sends k rows a
query to the final ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrays import ranges
from .tables import cut, drop

LEVELS, BLOCK, SLICE, CHUNK = 32, 4096, 8, 256
#: Sums of products below this are exact as integers of 64 bits.
EXACT = 1 << 62


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of integers as rows; shorter ones end in zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    wide = int(sizes.max()) if len(sizes) else 0
    if (sizes == wide).all():
        return flat.reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), ranges(np.zeros(len(sizes), np.int64), sizes)] = flat
    return out


class Block:
    """The index of some rows: components, quantised levels and the postings of each segment."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray):
        self.rows, self.ids, self.x = rows, ids, x
        n, dims = x.shape
        self.low = x.min(axis=0)
        # levels in floats: spans can be over 64 bits
        self.step = np.maximum(1.0, np.ceil((x.max(axis=0).astype(float) - self.low + 1) / LEVELS))
        level = np.clip((x.astype(float) - self.low) // self.step, 0, LEVELS - 1).astype(np.int64)
        self.postings = np.argsort(level, axis=0, kind="stable").T.ravel().astype(np.int32)
        self.counts = np.bincount((level + np.arange(dims) * LEVELS).ravel(), minlength=dims * LEVELS)
        self.starts = np.cumsum(self.counts) - self.counts
        self.used = np.flatnonzero(self.counts)
        self.floor = self.low[:, None] + self.step[:, None] * np.arange(LEVELS)
        self.ceil = self.floor + self.step[:, None] - 1
        self.most = int(np.abs(x).max(initial=0))

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products; as Python integers where 64 bits could be too few."""
        x = self.x[at]
        if self.most * int(np.abs(q).max(initial=0)) * max(1, len(q)) < EXACT:
            return x @ q
        return np.array([sum(a * b for a, b in zip(r, q.tolist(), strict=True)) for r in x.tolist()], object)

    def search(self, q: np.ndarray, own: int, k: int, least: int | None) -> tuple[np.ndarray, int]:
        """Rows of the block that can be among the k best beside the row ``own``, and the postings processed.  ``least``: a score that k rows elsewhere have."""
        n, dims = self.x.shape
        q = np.concatenate([q[:dims], np.zeros(max(0, dims - len(q)), np.int64)])
        never = np.flatnonzero(self.rows == own)
        everything = np.setdiff1d(np.arange(n), never)
        if n <= 2 * k or not dims:
            return everything, 0
        f = q.astype(float)[:, None]
        ends = f * self.floor, f * self.ceil
        most = np.maximum(*ends).ravel()
        size = np.maximum(np.abs(ends[0]), np.abs(ends[1])).ravel()
        order = self.used[np.argsort(-size[self.used], kind="stable")]
        upto = np.cumsum(self.counts[order])
        slack = 1.0 + 1e-9 * float(size.reshape(dims, LEVELS).max(axis=1).sum())
        sums, met, at, done = np.zeros(n), np.zeros(n, np.int64), 0, 0
        while at < len(order):
            to = max(at + 1, int(np.searchsorted(upto, done + n * dims // 8, "right")))
            part = order[at:to]
            counts = self.counts[part]
            ids = self.postings[ranges(self.starts[part], counts)]
            sums += np.bincount(ids, np.repeat(most[part], counts), n)
            met += np.bincount(ids, minlength=n)
            at, done = to, int(upto[to - 1])
            rest = size[order[at]] if at < len(order) else 0.0
            bound = sums + (dims - met) * rest + slack
            bound[never] = -np.inf
            if 4 * done < n * dims:  # bounds can't tell yet
                if least is None or (bound >= least).sum() > n // 8:
                    continue
            best = np.argpartition(-bound, 2 * k)[: 2 * k]
            exact = np.sort(self.scores(best[bound[best] > -np.inf], q))
            if len(exact) >= k and (least is None or exact[-k] > least):
                least = int(exact[-k])
            if least is None:
                continue
            possible = np.flatnonzero(bound >= least)
            if 8 * len(possible) <= n or at == len(order):
                return possible, done
        return everything, done


def _built(table: pa.Table) -> pa.Table:
    """A block's rows as one row."""
    x = _matrix(table["v"])
    cells = [np.asarray(table[c], np.int64).tobytes() for c in ("row", "vec_id")]
    return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int64()), "n": pa.array([len(x)], pa.int64()), "rows": pa.array([cells[0]], pa.binary()), "ids": pa.array([cells[1]], pa.binary()), "x": pa.array([x.tobytes()], pa.binary())})


def _searched(k: int):
    def run(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        kind = {"q": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}
        if not queries.num_rows or not blocks.num_rows:
            return pa.table({c: pa.array([], t) for c, t in kind.items()})
        vectors = [np.array(v, np.int64) for v in queries["v"].to_pylist()]
        names, rows = queries["vec_id"].to_pylist(), queries["row"].to_pylist()
        best: list[list[tuple]] = [[] for _ in rows]
        for b in blocks.to_pylist():
            own_rows, ids = (np.frombuffer(b[c], np.int64) for c in ("rows", "ids"))
            block = Block(own_rows, ids, np.frombuffer(b["x"], np.int64).reshape(b["n"], -1))
            for i, (q, row) in enumerate(zip(vectors, rows, strict=True)):
                least = -best[i][k - 1][0] if len(best[i]) >= k else None
                at, _ = block.search(q, row, k, least)
                wide = np.concatenate([q[: block.x.shape[1]], np.zeros(max(0, block.x.shape[1] - len(q)), np.int64)])
                exact = block.scores(at, wide)
                if len(at) > k:  # ties with the k-th stay
                    keep = exact >= np.sort(exact)[-k]
                    at, exact = at[keep], exact[keep]
                best[i] = sorted([*best[i], *zip((-exact).tolist(), ids[at].tolist(), strict=True)])[:k]
        cells = [(row, name, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for row, name, top in zip(rows, names, best, strict=True) for s, i in top]
        return pa.table({c: pa.array([x[j] for x in cells], t) for j, (c, t) in enumerate(kind.items())})

    return run


def integers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component as double; null where a component is null or not finite, or the vector is null."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k greatest inner products of each query with every row but its own.

    ``vectors`` has vec_id and ``v``, an array of longs; rows without id, or with null ``v``,
    take no part.  ``is_query`` says which rows are queries too.  Ties go to smaller ids.  A
    repeated row is a row of its own: a candidate for its twin, and a query with results of
    its own.  Vectors of different lengths meet as if the shorter one ended in zeros.  With fewer
    than k candidates a query gets all.  A score over 64 bits is ranked exactly and shown as the
    nearest long.  Work is queries times rows in the worst case; what the bounds prove saves the rest.
    """
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "v", F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = cut(rows.where("vec_id IS NOT NULL AND v IS NOT NULL"))
    total, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    n_blocks, n_chunks = -(-total // BLOCK) or 1, -(-asking // CHUNK) or 1
    n_slices = -(-n_blocks // SLICE)
    place = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    blocks = rows.select("row", "vec_id", "v", place("row", n_blocks).alias("block")).groupBy("block").applyInArrow(_built, "block long, n long, rows binary, ids binary, x binary")
    index = cut(blocks)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = rows.where("asks").select("row", "vec_id", "v", place("row", n_chunks).cast("int").alias("chunk"), every(n_slices).alias("slice"))
    held = index.select("*", every(n_chunks).alias("chunk"), F.floor(F.col("block") / SLICE).cast("int").alias("slice"))
    found = asked.groupBy("chunk", "slice").cogroup(held.groupBy("chunk", "slice")).applyInArrow(_searched(k), "q long, query_id long, vec_id long, score long")
    found = cut(found)
    drop(rows, index)
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return found.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
