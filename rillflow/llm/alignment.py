"""Alignment of two tokenizers' tokens by a cogroup of postings.

Both tokenizers cut a text's bytes; where both cut, a group of tokens ends, and the two tokens
that end there are linked.  Segments between words are encoded once, many of them as one text, and
remembered, since neither tokenizer joins what stands on the two sides of such a cut.

A document's postings are its linked id pairs with their multiplicities.  They are
shuffled by the id of side B; an id with many postings is spread over several parts by its count.
Each part receives the pre-aggregated counts of the id's pairs ahead of its postings, in one
sorted stream that Spark spills as needed: a task reads the counts of an id, takes
their maximum, and then turns each posting into its document's contribution.
Contributions are summed by document.

The counts of one id are bounded by the vocabularies: of a linked pair, one token's bytes
end the other's.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import ranges
from .tables import cut, drop

SPACE = "▁"
#: A pair of ids is b * WIDTH + a.
WIDTH = 1 << 21
#: Characters of a segment that is remembered, and of all that are before memory starts anew.
LONGEST, REMEMBERED = 64, 4_000_000
#: Segments that are encoded as one text.
RUN = 50


def _byte_of() -> dict[str, int]:
    """Byte-level BPE writes each byte as a printable character: itself, or one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Tokens of both sides for texts, as groups."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(byte_level), sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a.encode_special_tokens = True
        of = _byte_of()
        self.a_bytes = {i: bytes(of[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        kinds = range(self.b.get_piece_size())
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace(SPACE, " ").encode() for i in kinds]
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, t in self.a_bytes.items():
            self.a_sizes[i] = len(t)
        self.b_sizes = np.array([len(t) for t in self.b_bytes])
        # a token as text with what may stand after it, inside a group or at the end of its side
        self.a_text, self.b_text = (np.array([[f"{i}{end}" for i in range(len(sizes))] for end in ends], "S") for sizes, ends in ((self.a_sizes, ",|"), (self.b_sizes, ",;")))
        if any(SPACE in self.b.id_to_piece(i).lstrip(SPACE) for i in kinds):
            raise ValueError("pieces that join words are not supported")
        # both sides cut before a single space that a visible character follows
        self.cut = re.compile(r"(?<! )(?= \S)")
        self.forget()

    def forget(self) -> None:
        """``known`` gives a segment's place in ``words`` (its groups as text, a ; after each) and ``numbers`` (n_a, n_b, n_groups, 1 if a side doesn't give its bytes back); ``pairs`` are the linked ones, place after place."""
        self.known: dict[str, int] = {}
        self.words: list[str] = []
        self.numbers, self.pairs = np.zeros((0, 4), np.int64), np.zeros(0, np.int64)
        self.size = 0

    def segments(self, text: str) -> list[str]:
        """``text`` with the leading space of both sides, in pieces that start with a space each."""
        return [s for s in self.cut.split(" " + text) if s]

    def learn(self, segments: set[str]) -> list[str]:
        """Make all of ``segments`` known; returns the long ones, which stand last and are to be dropped (``drop``) once their texts are done."""
        new = [s for s in segments if s not in self.known]
        size = sum(len(s) for s in new if len(s) <= LONGEST)
        if self.size + size > REMEMBERED:
            self.forget()
            new = list(segments)
            size = sum(len(s) for s in new if len(s) <= LONGEST)
        self.size += size
        short, long = [s for s in new if len(s) <= LONGEST], [s for s in new if len(s) > LONGEST]
        # a text of segments that start with a visible character and end with one is cut where they meet, as they were
        plain = [s for s in short if s[-1] != " " and not s[1].isspace()]
        odd = [s for s in short if s[-1] == " " or s[1].isspace()]
        runs = [plain[lo : lo + RUN] for lo in range(0, len(plain), RUN)] + [[s] for s in odd + long]
        numbers, pairs = [self.numbers], [self.pairs]
        for lo in range(0, len(runs), 5000 // RUN):
            for n, words, linked in self.groups(runs[lo : lo + 5000 // RUN]):
                numbers.append(n)
                self.words += words
                pairs.append(linked)
        self.numbers, self.pairs = np.concatenate(numbers), np.concatenate(pairs)
        self.known.update(zip(chain(plain, odd, long), range(len(self.known), len(self.words)), strict=True))
        return long

    def drop(self, long: list[str]) -> None:
        """Forget segments that stand last."""
        for s in long:
            del self.known[s]
        n = len(self.known)
        self.pairs = self.pairs[: self.numbers[:n, 2].sum()]
        self.words, self.numbers = self.words[:n], self.numbers[:n]

    def groups(self, runs: list[list[str]]) -> Iterator[tuple[np.ndarray, list[str], np.ndarray]]:
        """numbers, words and pairs of the segments of each of ``runs``, in parts one after the other.

        A run is encoded as one text, and all runs are cut at once, on the byte ends of their tokens one after the other.
        """
        texts = ["".join(run) for run in runs]
        sides = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)], self.b.encode([t[1:] for t in texts], num_threads=1)
        raw = [t.encode("utf-8", "replace") for t in texts]
        size = np.array(list(map(len, raw)))
        bad = np.zeros(len(runs), bool)
        flat, ends = [], []
        for ids, known, sizes in zip(sides, (self.a_bytes, self.b_bytes), (self.a_sizes, self.b_sizes), strict=True):
            one = np.fromiter(chain.from_iterable(ids), np.int64)
            first = np.cumsum([0, *map(len, ids)])
            end = np.cumsum(sizes[one])
            if b"".join([known[i] for i in one.tolist()]) != b"".join(raw) or (np.diff(np.append(0, end)[first]) != size).any():
                bad |= [b"".join([known[i] for i in x]) != r for x, r in zip(ids, raw, strict=True)]
            flat.append(one)
            ends.append(end)
        if not bad.any():
            (a, b), stops = flat, np.cumsum([len(s) if s.isascii() else len(s.encode("utf-8", "replace")) for s in chain.from_iterable(runs)])
            both, i, j = np.intersect1d(*ends, assume_unique=True, return_indices=True)
            last = np.searchsorted(both, stops)
            apart = both[last] != stops
            if not apart.any():
                yield self.described(a, b, i, j, last)
                return
            bad[np.searchsorted(np.cumsum(list(map(len, runs))), np.flatnonzero(apart), "right")] = True
        # runs that don't come back, or not cut as they were, are encoded by segments, and segments that don't come back have no tokens
        lo = 0
        for at in [*np.flatnonzero(bad).tolist(), len(runs)]:
            if lo < at:
                yield from self.groups(runs[lo:at])
            if at < len(runs) and len(runs[at]) > 1:
                yield from self.groups([[s] for s in runs[at]])
            elif at < len(runs):
                yield np.array([[0, 0, 0, 1]]), [""], np.zeros(0, np.int64)
            lo = at + 1

    def described(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
        """numbers, words and pairs of segments: their tokens, the places of those that end together, and the last of these in each segment."""
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[i], end_b[j] = 1, 1
        # a token stands after those of its side and those of the other side in the groups before (B: and in its own)
        at_a = np.arange(len(a)) + np.append(0, j + 1)[np.cumsum(end_a) - end_a]
        at_b = np.arange(len(b)) + (i + 1)[np.cumsum(end_b) - end_b]
        text = np.empty(len(a) + len(b), max(self.a_text.dtype, self.b_text.dtype, key=lambda t: t.itemsize))
        text[at_a], text[at_b] = self.a_text[end_a, a], self.b_text[end_b, b]
        shown = text.view(np.uint8).reshape(len(text), -1)
        visible = shown != 0
        after = np.cumsum(visible.sum(axis=1))[i[last] + j[last] + 1].tolist()
        whole = shown[visible].tobytes().decode()
        words = [whole[p:q] for p, q in zip([0, *after], after, strict=False)]
        n = np.diff(np.stack([i[last], j[last], last], axis=1) + 1, axis=0, prepend=0)
        return np.append(n, np.zeros((len(n), 1), np.int64), axis=1), words, b[j] * WIDTH + a[i]

    def aligned(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of the texts: n_a, n_b, n_groups (a row each), the groups as text, where each text's linked pairs end, and the pairs with their multiplicities; zeros where a text has no tokens."""
        split = [self.segments(t) if t else [] for t in texts]
        long = self.learn({s for segments in split for s in segments})
        places = [list(map(self.known.__getitem__, segments)) for segments in split]
        flat = np.fromiter(chain.from_iterable(places), np.int64)
        row = np.repeat(np.arange(len(texts)), list(map(len, places)))
        whole = np.bincount(row[self.numbers[flat, 3] > 0], minlength=len(texts)) == 0
        flat, row = flat[whole[row]], row[whole[row]]
        sums = np.zeros((len(texts), 3), np.int64)
        if len(flat):
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            sums[row[first]] = np.add.reduceat(self.numbers[flat, :3], first)
        words = ["".join(map(self.words.__getitem__, p))[:-1] if w else "" for p, w in zip(places, whole.tolist(), strict=True)]
        n = self.numbers[:, 2]
        pairs = self.pairs[ranges((np.cumsum(n) - n)[flat], n[flat])]
        # pairs have 42 bits
        links = np.sort((np.repeat(np.arange(len(texts)), sums[:, 2]) << 42) + pairs)
        first = np.flatnonzero(np.append(True, links[1:] != links[:-1])) if len(links) else links
        times = np.diff(np.append(first, len(links)))
        self.drop(long)
        return sums, words, np.searchsorted(links[first], np.arange(1, len(texts) + 1) << 42), links[first] & ((1 << 42) - 1), times


@lru_cache(maxsize=1)
def aligner(byte_level: str, pieces: str) -> Aligner:
    return Aligner(byte_level, pieces)


def token_groups(docs: DataFrame, byte_level: str, pieces: str, texts: bool = True) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, groups, groups_sha256, pairs, times: one row for each row of ``docs``.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` (null unless ``texts``; '' without tokens), ``pairs`` the
    distinct linked pairs as b * WIDTH + a, ``times`` how often the text has each.  Texts that are
    null or empty, or whose bytes a side doesn't give back, have no tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = aligner(byte_level, pieces)
        for batch in batches:
            texts_here = [t or "" for t in batch.column(2).to_pylist()]
            sizes = np.cumsum([0, *map(len, texts_here)])
            lo = 0
            while lo < batch.num_rows:  # about two million characters at a time, in a million rows at most
                hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + 2_000_000, "right")) - 1)
                hi = min(hi, lo + 1_000_000)
                part = batch.slice(lo, hi - lo)
                numbers, words, ends, pairs, times = sides.aligned(texts_here[lo:hi])
                sums = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in words]
                lists = [pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(x)) for x in (pairs, times)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(x) for x in numbers.T.copy()), pa.array(words if texts else [None] * len(words), pa.string()), pa.array(sums, pa.string()), *lists],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "groups", "groups_sha256", "pairs", "times"],
                )
                lo = hi

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "row long, doc_id long, n_a long, n_b long, n_groups long, groups string, groups_sha256 string, pairs array<bigint>, times array<bigint>")


def _contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (pair, part, row, n) in order of id, part, and counts (null row) before postings: row, best, total of each posting."""
    kept: tuple[np.ndarray, ...] = (np.zeros(0, np.int64),) * 3  # id and part, pair, count of the last id's counts
    for batch in batches:
        pair, part, n = (np.asarray(batch.column(i)) for i in (0, 1, 3))
        counts = batch.column(2).is_null().to_numpy(zero_copy_only=False)
        ids, old = pair // WIDTH, kept[1] // WIDTH
        # places of (id, part) in the order of the stream; what was kept comes first
        one, two = np.append(old, ids), np.append(kept[0], part)
        step = np.append(0, np.cumsum((one[1:] != one[:-1]) | (two[1:] != two[:-1]))) if len(one) else one
        k = len(old)
        from_counts = np.append(np.ones(k, bool), counts)
        where, pairs, size = step[from_counts], np.append(kept[1], pair)[from_counts], np.append(kept[2], n)[from_counts]
        if len(where):
            first = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            most = np.zeros(int(step[-1]) + 1, np.int64)
            most[where[first]] = np.maximum.reduceat(size, first)
            asked = np.flatnonzero(~counts)
            if len(asked):
                at = np.searchsorted((where << 43) + pairs, (step[k:][asked] << 43) + pair[asked])
                links, m = size[at], n[asked]
                best = np.where(links == most[step[k:][asked]], m, 0)
                yield pa.RecordBatch.from_arrays([batch.column(2).take(pa.array(asked)), pa.array(best), pa.array(links * m)], ["row", "best", "total"])
        last = where == step[-1] if len(step) else np.zeros(0, bool)
        kept = two[from_counts][last], pairs[last], size[last]


def align_tokenizers(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, one row for each row of ``docs``.

    Links are the token pairs that end together, one a group.  A pair's count is how many links
    of all rows hold it; n_best counts the row's links whose count is the highest of their B id
    (ties included), count_sum adds up the links' counts.  A repeated row counts as often as it is
    there.  Both vocabularies must have under 2**21 ids.
    """
    table = cut(token_groups(docs, byte_level, pieces, texts=False).drop("groups"))
    postings = table.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("e")).select("row", F.col("e.pairs").alias("pair"), F.col("e.times").alias("n"))
    side = F.floor(F.col("pair") / WIDTH)
    counts = cut(postings.groupBy("pair").agg(F.sum("n").alias("n"), F.count("*").alias("k")))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = (counts.agg(F.sum("k")).first()[0] or 0) // (4 * tasks) + 1
    # a row for each id of B at most
    parts = counts.groupBy(side.alias("b")).agg(F.ceil(F.sum("k") / share).cast("int").alias("parts"))
    spread = lambda df: df.withColumn("b", side).join(F.broadcast(parts), "b")
    ahead = spread(counts).select("pair", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("row"), "n")
    behind = spread(postings).select("pair", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("part"), "row", "n")
    both = ahead.unionByName(behind).repartition(tasks, side, "part").sortWithinPartitions(side, "part", F.col("row").isNotNull(), "pair")
    sums = both.mapInArrow(_contributions, "row long, best long, total long").groupBy("row").agg(F.sum("best").alias("n_best"), F.sum("total").alias("count_sum"))
    sums = cut(sums)
    drop(counts)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return table.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")
