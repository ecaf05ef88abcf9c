"""Substring dedup by compaction of a de Bruijn graph of words.

The edges of the graph are windows of k words.  Storing each edge on its own would
multiply the corpus, so edges travel as paths: a path is a run of consecutive
windows of one document that share their least inner gram (its anchor).  Equal
windows have equal anchors, so

1. anchors met under two ids or more are found by one aggregation;
2. only paths of such anchors go on, each with a 64-bit hash of its windows, its source
   coordinate (row, first window, windows) and the path that follows it there;
3. a path that all its sources follow with the same path, one that has no other
   sources, doesn't branch there: a join finds these links, and linked paths that
   repeat are compacted into one chain;
4. where several paths share an anchor, sources branch inside it, and the first source
   of each path opens it into its windows;
5. the words at the source coordinates of each chain, and of the opened windows, are
   read and compared by 128 bits of hash; those that also start under a smaller id are
   the spans to remove.  A clash of 64-bit hashes can't remove anything by itself.

No step needs all sources of a path or an anchor in one group: hot keys are broadcast,
their rows stay spread (``spread_join``), and the plan is the same at any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrays import grams, mixed, ranges, text_slices, word_bounds, word_hashes
from .tables import cut, drop, keyed, spread_join

#: A place is a window's number times this, plus the windows of the path.
PLACE = 1 << 16


def _paths(buf: np.ndarray, offsets: np.ndarray, k: int, inner: int):
    """Anchor, row, first window and windows of all paths in some texts, each text's first word, word hashes."""
    start, end, first = word_bounds(buf, offsets)
    hashes = word_hashes(buf, start, end)
    values, at, _ = grams(hashes, first, inner)
    full = np.full(len(hashes) + k, ~np.uint64(0), np.uint64)
    full[at] = values
    counts = np.maximum(np.diff(first) - k + 1, 0)
    windows = ranges(first[:-1], counts)
    least = full[windows]
    for j in range(1, k - inner + 1):
        np.minimum(least, full[windows + j], out=least)
    row = np.repeat(np.arange(len(counts)), counts)
    new = np.ones(len(windows), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    runs = np.flatnonzero(new)
    # an anchor that repeats on the spot (one word over and over) makes long runs: at most k windows a path
    length = np.diff(np.append(runs, len(windows)))
    new[ranges(np.zeros(len(runs), np.int64), length) % k == 0] = True
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, len(windows)))
    return least[heads], row[heads], windows[heads], size, first, hashes


def _anchors(k: int, inner: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, buf, offsets in text_slices(batch.column(1)):
                anchor, row, *_ = _paths(buf, offsets, k, inner)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(ids[lo + row])], ["anchor", "doc_id"])

    return run


def _pieces(k: int, inner: int):
    """Paths with a hash of all their windows, their source coordinates and the path after them (0: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, buf, offsets in text_slices(batch.column(2)):
                anchor, row, at, size, first, hashes = _paths(buf, offsets, k, inner)
                each, _, _ = grams(hashes, first, k)
                # a path's windows follow each other in ``each``; their weighted sum tells the path
                weights = mixed(np.arange(k, dtype=np.uint64))[ranges(np.zeros(len(size), np.int64), size)] | np.uint64(1)
                body = np.add.reduceat(each * weights, np.cumsum(size) - size) if len(size) else each
                path = mixed(mixed(body + size.astype(np.uint64)) ^ anchor)
                after = np.append(path[1:], np.uint64(0)) if len(path) else path
                after[:-1][row[1:] != row[:-1]] = 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (anchor.view(np.int64), path.view(np.int64), ids[lo + row], keys[lo + row], (at - first[row]) * PLACE + size, after.view(np.int64))],
                    ["anchor", "path", "doc_id", "tkey", "place", "next"],
                )

    return run


def _read(k: int):
    """The words at some source coordinates of each text, as 128 bits: a chain as one row, an opened path as a row for each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(3)
            bounds = parts.offsets.to_numpy().astype(np.int64)
            place, total, opened = (parts.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(3))
            bounds = bounds - bounds[0]
            for lo, buf, offsets in text_slices(batch.column(2)):
                rows = len(offsets) - 1
                start, end, first = word_bounds(buf, offsets)
                own = np.arange(bounds[lo], bounds[lo + rows])
                row = np.repeat(np.arange(rows), np.diff(bounds[lo : lo + rows + 1]))
                at, size = place[own] // PLACE, place[own] % PLACE
                # a chain that a clash of hashes placed beyond the end of this text isn't in it
                chain = (total[own] > 0) & (first[row] + at + total[own] + k - 1 <= first[row + 1])
                a, n = (first[row] + at)[chain], total[own][chain]
                digests = [hashlib.blake2b(b" ".join(buf[start[i] : end[i + m + k - 2]].tobytes().split()), digest_size=16).digest() for i, m in zip(a, n, strict=True)]
                whole = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                wide = opened[own]
                one, _, counts = grams(word_hashes(buf, start, end), first, k)
                two, _, _ = grams(word_hashes(buf, start, end, salt=1), first, k)
                pick = ranges((np.cumsum(counts) - counts)[row[wide]] + at[wide], size[wide])
                take = pa.array(lo + np.concatenate([row[chain], np.repeat(row[wide], size[wide])]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(np.concatenate([whole[:, i], x[pick].view(np.int64)])) for i, x in enumerate((one, two))),
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array(np.concatenate([at[chain], ranges(at[wide], size[wide])]).astype(np.int32)),
                        pa.array(np.concatenate([n, np.ones(len(pick), np.int64)]).astype(np.int32)),
                    ],
                    ["one", "two", "doc_id", "tkey", "at", "size"],
                )

    return run


def _kept(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(1), batch.column(2)
            n_words, n_removed, digest = [], [], []
            for text, cuts in zip(texts, spans, strict=True):
                words = (text.as_py() or "").encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                if cuts.is_valid and len(cuts.values):
                    a = cuts.values.field(0).to_numpy()
                    np.add.at(gone, a, 1)
                    np.add.at(gone, a + cuts.values.field(1).to_numpy() + k - 1, -1)
                    left = [w for w, g in zip(words, np.cumsum(gone)[:-1] > 0, strict=True) if not g]
                else:
                    left = words
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                digest.append(hashlib.sha256(b" ".join(left)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return run


def chains(paths: DataFrame) -> DataFrame:
    """path, total: the first path of each chain of repeated paths, and the windows of the whole chain.

    ``paths`` has path, n (its sources), next (the path after all of them, else null) and
    rep (doc_id, tkey, place of its first source).  a and its next path b are linked if b
    has as many sources as a: then every source of b follows one of a.  Linked paths follow
    each other in the first source too, so a chain is numbered within one document.
    """
    after = paths.where("next IS NOT NULL").select(F.col("next").alias("path"), F.col("n").alias("m"))
    linked = after.join(paths.select("path", "n"), "path").where("n = m").select("path", F.lit(True).alias("linked"))
    rows = paths.join(linked, "path", "left").select("path", "rep", F.coalesce("linked", F.lit(False)).alias("linked"))
    by = W.partitionBy("rep.doc_id", "rep.tkey").orderBy("rep.place").rowsBetween(W.unboundedPreceding, 0)
    head = F.last(F.when(~F.col("linked"), F.col("path")), True).over(by)
    return rows.select(head.alias("path"), (F.col("rep.place") % PLACE).alias("size")).groupBy("path").agg(F.sum("size").alias("total"))


def repeated_spans(docs: DataFrame, k: int = 13, inner: int = 6) -> DataFrame:
    """doc_id, tkey, spans: array of (at, size), ``size`` windows from window ``at`` on, each found under a smaller id."""
    keys = keyed(docs).where("doc_id IS NOT NULL AND text IS NOT NULL")
    met = keys.select("doc_id", "text").mapInArrow(_anchors(k, inner), "anchor long, doc_id long")
    shared = met.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"))
    shared = cut(shared.where("lo < hi").select("anchor", "n"))
    pieces = keys.mapInArrow(_pieces(k, inner), "anchor long, path long, doc_id long, tkey long, place long, next long")
    pieces = cut(spread_join(pieces, shared, "anchor", shared.agg(F.sum("n")).first()[0] or 0))
    drop(shared)

    same = F.when((F.min("next") == F.max("next")) & (F.min("next") != 0), F.min("next"))
    rep = F.min(F.struct("doc_id", "tkey", "place")).alias("rep")
    one = F.min("anchor").alias("anchor"), F.max("doc_id").alias("high"), F.count("*").alias("n")
    every = cut(pieces.groupBy("path").agg(*one, same.alias("next"), rep))
    forks = every.groupBy("anchor").agg((F.count("*") > 1).alias("fork"), F.count("*").alias("n"))
    paths = spread_join(every.withColumnRenamed("n", "sources"), forks, "anchor", every.count()).withColumnRenamed("sources", "n")
    paths = cut(paths.where("fork OR rep.doc_id < high"))
    heads = chains(paths.where("rep.doc_id < high"))
    wanted = paths.join(heads, "path", "left").where("fork OR total IS NOT NULL")
    wanted = cut(wanted.select("path", "n", F.col("rep.doc_id").alias("low"), "fork", F.coalesce("total", F.lit(0)).alias("total")))
    found = spread_join(pieces.select("path", "doc_id", "tkey", "place"), wanted, "path", pieces.count())
    opened = F.col("fork") & (F.col("low") == F.col("doc_id"))
    parts = found.where(opened | (F.col("total") > 0)).select("doc_id", "tkey", F.struct("place", "total", opened.alias("opened")).alias("part"))
    parts = cut(parts.groupBy("doc_id", "tkey").agg(F.collect_set("part").alias("parts")))
    drop(pieces, every, paths, wanted)

    each = keys.join(parts, ["doc_id", "tkey"]).select("doc_id", "tkey", "text", "parts")
    each = cut(each.mapInArrow(_read(k), "one long, two long, doc_id long, tkey long, at int, size int"))
    least = each.groupBy("one", "two").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"))
    least = cut(least.where("least < most").select("one", F.col("two").alias("same"), "least", "n"))
    spans = spread_join(each, least, "one", each.count()).where("two = same AND least < doc_id")
    spans = cut(spans.groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("at", "size")).alias("spans")))
    drop(parts, each, least)
    return spans


def substring_dedup(docs: DataFrame, k: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, one row for each row of ``docs``.

    Words are compared as they are.  A word goes if a window of k words over it also
    starts in a row with a smaller id; windows are judged on the input.  Null text
    has no words; texts under k words lose nothing; rows that share an id don't
    remove each other's words; a row without id loses nothing and removes nothing.
    """
    spans = repeated_spans(docs, k)
    rows = keyed(docs).join(spans, ["doc_id", "tkey"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_kept(k), "doc_id long, n_words long, n_removed long, kept_sha256 string")
