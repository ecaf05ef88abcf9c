"""Toxicity as severity grades by cumulative-link ordinal regression.

P(grade > j) = sigmoid(w . x - cut_j) with one sparse weight vector shared by all
thresholds and increasing cuts.  x marks which hashed words and stems a text has.
Labels say toxic or not; no severity is labelled.  So the grades of toxic rows are
derived, in two steps: a fit of one threshold scores the toxic rows, those under the
median score are grade 1 and the others grade 2; then all thresholds are fitted
together.  Severity thus ranks by what tells toxic rows from others, no more.  Weights are fitted on a bounded sample by
proximal gradient steps with an L1 penalty, which leaves the few words that tell
grades apart; scoring streams over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import MARKS, mixed, text_slices, word_bounds, word_hashes
from .tables import cut, drop, least_hashes

#: Hashed word features (a power of two), labelled rows that are fitted on at most, grades.
BUCKETS, TRAINING_ROWS, GRADES = 1 << 20, 20_000, 3
#: Bytes of stems; occurrences from which a word or stem is there often.
STEMS, OFTEN = (6, 7), 3


def features(buf: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each distinct feature of each text.

    Words are runs without white space and ASCII marks, A-Z as a-z.  A text has a
    feature for each word and each stem (the first ``STEMS`` bytes of a longer word),
    and another one for a word or stem that it has ``OFTEN`` times or more.
    """
    start, end, first = word_bounds(buf, offsets, MARKS)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first)).astype(np.uint64)
    found = []
    for salt, size in enumerate((None, *STEMS)):
        some = slice(None) if size is None else end - start > size
        a, b, r = start[some], end[some], row[some]
        both = r * np.uint64(buckets) + (word_hashes(buf, a, b if size is None else a + size, fold=True, salt=salt) & np.uint64(buckets - 1))
        both, count = np.unique(both, return_counts=True)
        again = both[count >= OFTEN]
        found += [both, again - again % np.uint64(buckets) + (mixed(again % np.uint64(buckets) + np.uint64(salt + 1)) & np.uint64(buckets - 1))]
    both = np.unique(np.concatenate(found))
    return (both // np.uint64(buckets)).astype(np.int64), (both % np.uint64(buckets)).astype(np.int64)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, buf, offsets in text_slices(batch.column(1)):
            row, bucket = features(buf, offsets)
            n = len(offsets) - 1
            ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0)[lo : lo + n], pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int32)))], ["grade", "words"])


class CumulativeLink:
    """Shared weights and ordered cuts; ``fit`` minimises the log loss of all thresholds plus an L1 penalty."""

    def __init__(self, grades: int = GRADES, steps: int = 300):
        self.grades, self.steps = grades, steps
        self.index, self.weights = np.zeros(0, np.int64), np.zeros(0)
        self.cuts = np.full(grades - 1, 30.0) + np.arange(grades - 1)

    def fit(self, rows: list[np.ndarray], grade: np.ndarray, least: int = 5) -> CumulativeLink:
        """``rows`` are buckets of each text; buckets in under ``least`` texts have no weight.

        The penalty is the level that chance features stay under (a standard deviation
        of the slope times sqrt(2 log features)); the features that pass it are then
        fitted again, by more steps, with a small part of the penalty.
        """
        if not len(rows) or len(np.unique(grade)) < 2:
            if len(rows):  # one grade only: every text gets it
                self.cuts = np.where(np.arange(self.grades - 1) < grade[0], -30.0, 30.0)
            return self
        above = (np.asarray(grade)[:, None] > np.arange(self.grades - 1)).astype(float)
        bucket, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), list(map(len, rows)))
        index, column, count = np.unique(bucket, return_inverse=True, return_counts=True)
        picked = np.flatnonzero(count >= least)
        # a feature whose slope without any weights is far under the penalty stays without
        wrong = (above.mean(axis=0) - above).sum(axis=1)
        slope = np.abs(np.bincount(column, wrong[row], minlength=len(index))) / np.sqrt(len(rows) * np.maximum(count, 1))
        spread = np.sqrt((above.mean(axis=0) * (1 - above.mean(axis=0))).sum())
        level = 1.2 * spread * np.sqrt(2 * np.log(max(len(picked), 2)) / len(rows))
        picked = picked[slope[picked] > level / 2]
        for penalty, steps in ((level, self.steps), (level / 300, 15 * self.steps)):
            place = np.full(len(index), -1)
            place[picked] = np.arange(len(picked))
            inside = place[column] >= 0
            w, cuts = self._descend(row[inside], place[column[inside]], len(picked), above, penalty, steps)
            picked, w = picked[w != 0], w[w != 0]
        self.index, self.weights, self.cuts = index[picked], w, cuts
        return self

    def _descend(self, row: np.ndarray, column: np.ndarray, m: int, above: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Accelerated proximal steps; columns are scaled to unit length for the penalty to treat rare and common words alike."""
        n = len(above)
        scale = np.sqrt(np.maximum(np.bincount(column, minlength=m), 1) / n)
        values = 1 / scale[column]
        share = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
        w, cuts = np.zeros(m), -np.log(share / (1 - share))
        # the curvature is at most a quarter of the largest eigenvalue of the scaled columns, found by power steps
        u = np.ones(m) / np.sqrt(max(m, 1))
        top = 1.0
        for _ in range(20 if m else 0):
            u = np.bincount(column, np.bincount(row, u[column] * values, minlength=n)[row] * values, minlength=m) / n
            top = np.linalg.norm(u)
            u /= max(top, 1e-12)
        rate = 1 / (0.25 * above.shape[1] * (1.1 * top + 1))
        v, c, t = w.copy(), cuts.copy(), 1.0
        for _ in range(steps):
            score = np.bincount(row, v[column] * values, minlength=n)
            wrong = 1 / (1 + np.exp(-np.clip(score[:, None] - c, -30, 30))) - above
            new = v - rate * np.bincount(column, wrong.sum(axis=1)[row] * values, minlength=m) / n
            new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
            moved = np.maximum.accumulate(c + rate * wrong.mean(axis=0))
            after = (1 + np.sqrt(1 + 4 * t * t)) / 2
            v, c = new + (t - 1) / after * (new - w), moved + (t - 1) / after * (moved - cuts)
            w, cuts, t = new, moved, after
        return w / scale, cuts

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) of each row."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.cuts, -30, 30)))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> DataFrame:
    """toxic, text of at most ``limit`` labelled documents, those whose ids have the least hashes."""
    toxic, doc = F.col("toxic").cast("int"), F.col("doc_id").cast("long").alias("doc_id")
    one = labels.where(toxic.isNotNull() & F.col("doc_id").isNotNull()).groupBy(doc).agg(F.max(toxic).alias("grade"))
    one = least_hashes(one, one.count(), limit, "doc_id")  # no more than the bound, so small enough to broadcast
    return docs.select(doc, F.col("text").cast("string").alias("text")).join(F.broadcast(one), "doc_id").select("grade", "text")


def fit_rows(rows: list[np.ndarray], toxic: np.ndarray) -> CumulativeLink:
    """Grades of toxic rows by a first fit's score, then the model of all grades."""
    # copies count once, and the order is the same at any partitioning
    order = [i for _, i in sorted({(int(toxic[i]), rows[i].tobytes()): i for i in range(len(rows))}.items())]
    rows, toxic = [rows[i] for i in order], np.asarray(toxic)[order].astype(int)
    first = CumulativeLink(grades=2).fit(rows, toxic)
    if not len(first.index):
        return CumulativeLink(GRADES).fit([np.zeros(0, np.int64) for _ in rows], toxic)
    score = np.array([first.weights[np.isin(first.index, r, assume_unique=True)].sum() for r in rows])
    grade = toxic * (1 + (score >= np.median(score[toxic > 0])))
    return CumulativeLink(GRADES).fit([r[np.isin(r, first.index)] for r in rows], grade)


def fit_toxicity(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> CumulativeLink:
    """The model of the labelled rows; their sparse features, not their texts, come to the driver."""
    table = cut(training_rows(docs, labels, limit).mapInArrow(_sparse, "grade int, words array<int>"))
    found = table.toArrow()
    drop(table)
    words = found["words"].combine_chunks()
    flat, bounds = words.values.to_numpy(zero_copy_only=False), words.offsets.to_numpy()
    return fit_rows([flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], found["grade"].to_numpy())


def score_toxicity(docs: DataFrame, model: CumulativeLink) -> DataFrame:
    """doc_id, p_toxic, severity (expected grade), grade (most likely), toxic (p_toxic >= 0.5), one row for each row.

    Null and empty texts score as a text without words.
    """
    dense = np.zeros(BUCKETS, np.float32)
    dense[model.index] = model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, buf, offsets in text_slices(batch.column(1)):
                n = len(offsets) - 1
                row, bucket = features(buf, offsets)
                above = model.above(np.bincount(row, dense[bucket].astype(np.float64), minlength=n))
                each = np.concatenate([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo : lo + n], pa.array(np.round(above[:, 0], 6)), pa.array(np.round(above.sum(axis=1), 6)), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= 0.5)],
                    ["doc_id", "p_toxic", "severity", "grade", "toxic"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, p_toxic double, severity double, grade int, toxic boolean")
