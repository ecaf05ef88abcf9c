"""Fill-in-the-middle: texts cut into prefix, middle and suffix by a streaming matcher.

A text's units are matched lazily, twice: the first pass counts them, the second
advances the match iterator to the two cuts.  No list of units is ever made, so beside
the text itself a task needs constant memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run of ASCII letters, or one other code point.
UNIT = r"[A-Za-z]+|[^A-Za-z]"
#: What stands before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")


def draws(doc_id: int | None, seed: str) -> list[int]:
    """Four 32-bit numbers of a document: the first groups of sha256 of seed, colon and id (null: the word null)."""
    h = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]


def cut_ends(units: re.Pattern, text: str, a: int, b: int) -> tuple[int, int]:
    """The code points that the first ``a`` and the first ``b`` units end at (a <= b)."""
    matches = units.finditer(text)
    ends = []
    done = at = 0
    for n in (a, b):
        if n > done:
            at = next(islice(matches, n - done - 1, None)).end()
            done = n
        ends.append(at)
    return ends[0], ends[1]


def transformed(units: re.Pattern, text: str, doc_id: int | None, seed: str, rate: int, spm: int, marks: tuple[str, str, str]) -> tuple:
    """n, form, prefix_chars, middle_chars, output of one text."""
    n = sum(1 for _ in units.finditer(text))
    h = draws(doc_id, seed)
    if not text or h[2] % 100 >= rate or any(m in text for m in marks):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = cut_ends(units, text, a, b)
    p, s, m = marks
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, "".join((s, text[b:], p, text[:a], m, text[a:b]))
    return n, "psm", a, b - a, "".join((p, text[:a], s, text[b:], m, text[a:b]))


def fill_in_middle(docs: DataFrame, rate: int = 90, spm: int = 20, seed: str = "1", marks: tuple[str, str, str] = MARKS, unit: str = UNIT) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output, one row for each row of ``docs``.

    ``n`` counts the matches of ``unit``, which has to match everywhere.  The first cut is
    after the lesser of two drawn ranks, the second after the greater; of 100 texts ``rate``
    are cut, ``spm`` of 100 of these with the suffix first.  ``form`` is psm, spm or
    plain (as it was, the lengths null): texts that are null (an empty output) or empty, hold a
    mark, or are not drawn.  Draws depend on id and ``seed`` only, so repeated rows agree; a
    null id draws as the word null.  Marks must not hold each other or share first characters
    with their own insides; then ``restored`` gives back every text exactly.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = re.compile(unit)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo in range(0, batch.num_rows, 64):
                part = [transformed(units, t.as_py() or "", i, seed, rate, spm, marks) for i, t in zip(ids[lo : lo + 64], batch.column(1)[lo : lo + 64], strict=True)]
                n, form, a, b, out = zip(*part, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo : lo + 64], pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(out, pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``fill_in_middle`` made ``output`` of."""
    p, s, m = map(len, marks)

    def between(start: Column, end: Column) -> Column:
        return F.substring(output, start, end - start)

    at_p, at_s, at_m = (F.instr(output, mark) for mark in marks)
    end = F.length(output) + 1
    middle = between(at_m + m, end)
    psm = F.concat(between(at_p + p, at_s), middle, between(at_s + s, at_m))
    spm = F.concat(between(at_p + p, at_m), middle, between(at_s + s, at_p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
