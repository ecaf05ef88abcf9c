"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and
its maximum, so a signature costs half the evaluations of plain MinHash.  The
signature is banded: two texts whose sets have similarity J share a band of r values
with probability J**r, and of b bands at least one with 1 - (1 - J**r)**b.  With
r = 6, all bands miss with probability 1e-9 at J = 0.8 and b = 68, and at J = 0.85
and b = 44.  (The formula takes the values of a band as independent.  Minimum and maximum under one permutation are
nearly so for sets of some size; tests/llm measures bands and links against all pairs.)

Candidates are confirmed on the full sets.  Copies (equal sets) are one class from
the start, so only class representatives are compared:

1. in each band bucket, members are compared with the least member (a star, linear
   in the bucket);
2. in buckets whose members are then still in different components, pairs across
   components are compared too, unless counts rule the link out (see ``_across``).
   Pairs within a component, the bulk of a large group of near copies, are never made;
3. buckets with many members outside their largest component, of whose pairs counts rule
   out too few (texts with a common frame), would give all pairs.  Their members are banded
   again by longer bands, as many as keep the miss at 1e-9 (``deep_bands``), and pairs are
   made in those buckets only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import grams, mixed, text_slices, word_bounds, word_hashes
from .tables import components, cut, drop, keyed, maybe_in, spread_join

ROWS, BANDS, SHINGLE = 6, 68, 5
#: Members outside the largest component of a bucket up to which its pairs are made as they are.
NARROW = 3
#: Members of a bucket that one task joins with the others' side.
SHARE = 512
#: Odd members and members of a bucket, about, whose pairs tell how many of all its pairs the counts leave.
TRIED = 16, 64
#: Part of the least similarity below which texts share less than one long band: 20.73 * 0.8**14 = 0.9.
UNLIKE = 0.8


def deep_bands(members: int, percent: int) -> tuple[int, int]:
    """Rows and number of longer bands for texts of which ``members`` share short ones without being linked.

    The number keeps the probability of a missed link at 1e-9.  Longer bands mean more
    keys a text, but fewer pairs of unlike texts (similarity 0.5) that meet; a pair costs
    about as much as 50 keys.  The least sum is taken, so both grow with a small power
    of ``members``.
    """
    share = percent / 100
    if share <= 0.5:  # no longer band tells such texts apart
        return ROWS, math.ceil(20.73 / share**ROWS)
    return min(((r, math.ceil(20.73 / share**r)) for r in range(ROWS, 65, 2)), key=lambda x: x[1] * (1 + 50 * members / 2 ** x[0]))


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """Each text's distinct k-word shingles as sorted hashes; under k words, the whole sequence as one."""
    start, end, first = word_bounds(buf, offsets)
    hashes = word_hashes(buf, start, end, fold=True)
    values, _, counts = grams(hashes, first, k)
    ends = np.cumsum(counts)
    for row in range(len(counts)):
        if counts[row]:
            yield np.unique(values[ends[row] - counts[row] : ends[row]])
        else:
            words = hashes[first[row] : first[row + 1]]
            whole = np.zeros(1, np.uint64)
            for w in words:
                whole = mixed(whole * np.uint64(0x9FB21C651E98DF25) + w + np.uint64(len(words)))
            yield whole if len(words) else whole[:0]


def _signature(values: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the set under each permutation, side by side."""
    low = high = None
    x = (values >> np.uint64(32)).astype(np.uint32)[:, None]
    step = max(1, (1 << 20) // max(len(factors), 1))
    for lo in range(0, len(x), step):
        part = x[lo : lo + step] * factors
        part += shifts
        a, b = part.min(axis=0), part.max(axis=0)
        low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
    return np.stack([low, high], axis=1).ravel()


def _band_keys(rows: int, bands: int, first: int = 1):
    """A function that gives the band keys of a set of shingles; ``first``: seed of the permutations."""
    half = rows * bands // 2
    seeds = mixed(np.arange(first, first + 2 * half, dtype=np.uint64))
    factors, shifts = (seeds[:half] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[half:] >> np.uint64(32)).astype(np.uint32)
    weights = mixed(np.arange(7, 7 + rows, dtype=np.uint64)) | np.uint64(1)
    salt = mixed(np.arange(100, 100 + bands, dtype=np.uint64))

    def keys(values: np.ndarray) -> np.ndarray:
        bits = _signature(values, factors, shifts).astype(np.uint64).reshape(bands, rows)
        return mixed((bits * weights).sum(axis=1, dtype=np.uint64) + salt).view(np.int64)

    return keys


def _sketches(rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band_keys = _band_keys(rows, bands)
        for batch in batches:
            for lo, buf, offsets in text_slices(batch.column(2)):
                n, sums, keys = [], [[], []], []
                for values in shingle_sets(buf, offsets):
                    n.append(len(values))
                    # two sums over the distinct shingles tell the set: equal sets, equal sums
                    for i, s in enumerate(sums):
                        s.append(int(mixed(values + np.uint64(i * 77 + 1)).sum(dtype=np.uint64)))
                    keys.append(band_keys(values) if len(values) else np.zeros(0, np.int64))
                ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
                part = slice(lo, lo + len(n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], batch.column(1)[part], pa.array(n, pa.int64()), *(pa.array(np.array(s, np.uint64).view(np.int64)) for s in sums), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))],
                    ["doc_id", "tkey", "n_shingles", "set1", "set2", "bands"],
                )

    return run


def _set_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, buf, offsets in text_slices(batch.column(1)):
            sets = [v.tobytes() for v in shingle_sets(buf, offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0)[lo : lo + len(sets)], pa.array(sets, pa.binary())], ["node", "shingles"])


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that two full sets share."""
    for batch in batches:
        counts = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            both = np.concatenate([np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y)])
            both.sort(kind="stable")  # two sorted runs: one merge
            counts.append(int((both[1:] == both[:-1]).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["a", "b", "common"])


def _each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(1)]
            take = pa.array(np.repeat(np.arange(len(sets)), list(map(len, sets))))
            yield pa.RecordBatch.from_arrays([part.column(0).take(take), pa.array(np.concatenate(sets))], ["node", "shingle"])


NODE = "struct<id:bigint,t:bigint>"


def _deep_keys(rows: int, bands: int):
    """Each node of sets with its long bands, 100 nodes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band_keys = _band_keys(rows, bands, 1 << 32)
        for batch in batches:
            for lo in range(0, batch.num_rows, 100):
                part = batch.slice(lo, 100)
                keys = [band_keys(np.frombuffer(x.as_buffer(), np.uint64)) for x in part.column(1)]
                ends = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * bands)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys)))], ["node", "bands"])

    return run


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, common of pairs of nodes.

    Pairs of a node with many partners (the head of a group of near copies) are dealt to
    shares of ``SHARE``, and the node's set goes to each share.
    """
    total = pairs.count()
    tables = []
    placed = pairs
    for side in "a", "b":
        n = pairs.groupBy(side).agg(F.count("*").alias("n")).withColumn("shares", F.ceil(F.col("n") / SHARE).cast("int"))
        placed = spread_join(placed, n, side, total)
        placed = placed.withColumn(f"share_{side}", F.pmod(F.xxhash64("a", "b"), F.col("shares")).cast("int")).drop("shares")
        shares = n.select(side, F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias(f"share_{side}"))
        tables.append(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"s{side}")).join(shares, side))
    both = placed.join(tables[1], ["b", "share_b"]).join(tables[0], ["a", "share_a"])
    return cut(both.select("a", "b", "sa", "sb").mapInArrow(_common, f"a {NODE}, b {NODE}, common long"))


def _met(odd: DataFrame, all_: DataFrame) -> DataFrame:
    """Pairs of ``odd`` and ``all_`` rows of one bucket; both have its ``size``, and large buckets meet in shares."""
    shares = F.ceil(F.col("size") / SHARE).cast("int")
    odd = odd.withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("size")
    return odd.join(all_.withColumn("share", F.pmod(F.xxhash64("node"), shares).cast("int")), ["bucket", "share"])


def _by_long_bands(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of ``nodes`` (node, n, root, u, odd) in different components that share a long band.

    One of the two is odd, and neither has too many shingles of its own (u): other pairs can't be linked.
    """
    rows, bands = deep_bands(nodes.count(), percent)
    keys = sets.join(nodes.select("node"), "node", "left_semi").mapInArrow(_deep_keys(rows, bands), f"node {NODE}, bands array<long>")
    each = cut(keys.join(nodes, "node")).select("node", "n", "root", "u", "odd", F.explode("bands").alias("bucket"))
    met = cut(each.groupBy("bucket").agg(F.count("*").alias("n"), (F.min("root") < F.max("root")).alias("several")).where("several").drop("several"))
    total = met.agg(F.sum("n")).first()[0] or 0
    shared = cut(spread_join(each, met, "bucket", total))
    drop(met)
    sides = shared.groupBy("bucket", "root").agg(F.count("*").alias("k")).groupBy("bucket").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.sum("k").alias("size"))
    split = spread_join(shared, sides.withColumn("n", F.col("size")), "bucket", total)
    odd = split.where("root <> main").select("bucket", "size", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("root").alias("rx"), F.col("u").alias("ux"), F.col("odd").alias("ox"))
    most = F.least(F.col("nx") - F.col("ux"), F.col("n") - F.col("u"))
    fits = (F.col("rx") != F.col("root")) & (F.col("ox") | F.col("odd")) & (100 * most >= percent * (F.col("nx") + F.col("n") - most))
    pairs = cut(_met(odd, split).where(fits).select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct())
    drop(shared)
    return pairs


def _crowded(split: DataFrame, fits: Column, percent: int) -> DataFrame:
    """bucket, n, wide of the buckets with an odd member; ``split`` has all members.

    Wide ones have more than ``SHARE`` odd members; or more than ``NARROW``, if these are unlike the head (near
    copies that just aren't linked share long bands too) and counts would leave over ``NARROW`` pairs a member.
    That is told by the pairs of about ``TRIED`` members; either way the links are found.
    """
    like = F.col("c") / (2 * F.col("n") - F.col("c"))
    odds = cut(split.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("odd").alias("odds"), F.avg(F.when(F.col("odd"), like)).alias("like")).where("odds > 0"))
    several = odds.where((F.col("odds") > NARROW) & (F.col("odds") <= SHARE) & (F.col("like") < UNLIKE * percent / 100)).select("bucket", "odds")
    place = F.xxhash64("node", "bucket")
    one, other = F.col("odd") & (F.pmod(place, F.col("odds")) < TRIED[0]), F.pmod(place, F.col("size")) < TRIED[1]
    few = cut(split.join(several, "bucket").withColumn("one", one).withColumn("other", other).where("one OR other"))
    x = {"node": "x", "n": "nx", "c": "cx", "e": "ex", "root": "rx"}
    share = F.greatest(F.col("odds") / TRIED[0], F.lit(1.0)) * F.greatest(F.col("size") / TRIED[1], F.lit(1.0))
    left = few.where("one").select("bucket", *[F.col(c).alias(v) for c, v in x.items()]).join(few.where("other"), "bucket").where(fits)
    left = left.groupBy("bucket").agg(F.sum(share).alias("left"))
    wide = (F.col("odds") > SHARE) | (F.coalesce("left", F.lit(0.0)) > NARROW * F.col("n"))
    return odds.join(left, "bucket", "left").select("bucket", "n", wide.alias("wide"))


def _across(shared: DataFrame, compared: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of one bucket or more in different components that could still be linked.

    Only members of buckets with several components are looked at.  What is known of
    a member x: its size n, the c shingles it shares with the head of the bucket, and
    its u shingles that no other such member has.  For any y, x and y share at most
    min(c) + min(n - c - u) shingles, and x at most n - u with anything.  Members, and
    then pairs, that these bounds rule out are left; the rest is compared.  In a group
    of near copies each copy's own edits are its unique shingles, so nearly all pairs
    across are ruled out by counts alone.  Where counts leave too many pairs of a bucket
    (``_crowded``), its members meet by long bands instead.
    """
    rooted = cut(shared.join(roots, "node", "left").select("bucket", "node", "n", F.col("head.node").alias("h"), F.coalesce("root", "node").alias("root")))
    several = rooted.groupBy("bucket").agg(F.count("*").alias("n"), (F.min("root") < F.max("root")).alias("several")).where("several").drop("several")
    members = cut(spread_join(rooted, several, "bucket", rooted.count()))
    own = sets.join(members.select("node").distinct(), "node", "left_semi")
    once = own.mapInArrow(_each_shingle, f"node {NODE}, shingle long").groupBy("shingle").agg(F.count("*").alias("k"), F.min("node").alias("node"))
    unique = once.where("k = 1").groupBy("node").agg(F.count("*").alias("u"))
    known = compared.select(F.col("a").alias("h"), F.col("b").alias("node"), F.col("common").alias("c"))
    placed = members.join(known, ["h", "node"], "left").join(unique, "node", "left")
    placed = placed.select("bucket", "node", "n", F.coalesce("c", "n").alias("c"), F.coalesce("u", F.lit(0)).alias("u"), "root")
    placed = cut(placed.where(f"100 * (n - u) >= {percent} * n").withColumn("e", F.greatest(F.expr("n - c - u"), F.lit(0))))
    sides = placed.groupBy("bucket", "root").agg(F.count("*").alias("k"), F.min("n").alias("low"), F.max("e").alias("most"))
    main = F.max_by("root", F.struct("k", "root")).alias("main")
    sides = sides.groupBy("bucket").agg(main, F.min("low").alias("low"), F.max("most").alias("most"), F.count("*").alias("sides"), F.sum("k").alias("size")).where("sides > 1").drop("sides")
    total = placed.count()
    split = spread_join(placed, sides.withColumn("n", F.col("size")), "bucket", total)
    bound = F.col("c") + F.least("e", "most")
    split = split.withColumn("odd", (F.col("root") != F.col("main")) & (100 * bound >= percent * (F.col("n") + F.col("low") - bound)))
    # buckets without an odd member give no pair; a pair is made in the least narrow bucket that it shares
    most = F.least("cx", "c") + F.least("ex", "e")
    fits = (F.col("rx") != F.col("root")) & (100 * most >= percent * (F.col("nx") + F.col("n") - most))
    met = cut(split.drop("main", "low", "most"))
    split = cut(spread_join(met, _crowded(met, fits, percent), "bucket", total))
    narrow = split.where("NOT wide")
    narrow = cut(narrow.join(narrow.groupBy("node").agg(F.collect_set("bucket").alias("mine")), "node"))
    x = {"node": "x", "n": "nx", "c": "cx", "e": "ex", "root": "rx", "mine": "mx"}
    odd = narrow.where("odd").select("bucket", "size", *[F.col(c).alias(v) for c, v in x.items()])
    pairs = _met(odd, narrow).where(fits & (F.array_min(F.array_intersect("mx", "mine")) == F.col("bucket")))
    pairs = pairs.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"))
    nodes = cut(split.where("wide").groupBy("node", "n", "root", "u").agg(F.max("odd").alias("odd")))
    if not nodes.isEmpty():
        pairs = pairs.unionByName(_by_long_bands(nodes, sets, percent))
    pairs = cut(pairs.distinct().join(compared, ["a", "b"], "left_anti"))
    drop(rooted, members, placed, met, split, narrow, nodes)
    return pairs


def _joined(found: DataFrame, more: DataFrame) -> DataFrame:
    """``found`` (node, root) with further links: only the components that they join are labelled again."""
    ends = more.select(F.col("a").alias("node")).unionByName(more.select(F.col("b").alias("node"))).distinct()
    every = found.unionByName(ends.join(found.select("node"), "node", "left_anti").select("node", F.col("node").alias("root")))
    root = lambda c: every.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    tops = cut(more.join(root("a"), "a").join(root("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).where("a <> b").distinct())
    if tops.isEmpty():
        return found
    up = components(tops).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return every.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def near_duplicates(docs: DataFrame, percent: int = 80, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and tkey (hash of the text), one row for each row of ``docs``.

    Documents with 100 * common >= percent * united shingles are linked, and
    component_id is the least doc_id reachable.  Null or blank texts have an empty set
    and are linked with nothing.  Rows that share an id and a text are the same
    document; rows that share only the id are nodes of their own.  A row without id is
    linked with nothing, has a null component_id and is kept.
    """
    spec = "doc_id long, tkey long, n_shingles long, set1 long, set2 long, bands array<long>"
    sketch = cut(keyed(docs).mapInArrow(_sketches(rows, bands), spec))
    node = F.struct(F.col("doc_id").alias("id"), F.col("tkey").alias("t"))

    def sorted_out(sketch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows with a set, and the classes of equal sets."""
        known = sketch.where("doc_id IS NOT NULL AND n_shingles > 0")
        return known, known.groupBy("set1", "set2").agg(F.min(node).alias("node"), F.count("*").alias("n"))

    known, classes = sorted_out(sketch)
    heads = known.join(classes.select(F.col("node.id").alias("doc_id"), F.col("node.t").alias("tkey")), ["doc_id", "tkey"], "left_semi").dropDuplicates(["doc_id", "tkey"])
    buckets = heads.select(node.alias("node"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    # most rows are alone in their bucket: counts of bare buckets tell which ones travel on
    met = cut(buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket", F.col("size").alias("n")))
    rows = cut(spread_join(buckets.select("bucket", "node", F.col("n").alias("size")), met, "bucket", met.agg(F.sum("n")).first()[0] or 0).withColumnRenamed("size", "n"))
    least = rows.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("head"), F.count("*").alias("n"))
    shared = cut(spread_join(rows, least, "bucket", rows.count()))  # a head for each row
    drop(met, rows)
    columns = "doc_id", "tkey", "n_shingles", "set1", "set2"
    banded, sketch = sketch, cut(sketch.select(*columns))
    drop(banded)  # bands take 8 bytes each a row, and aren't read any more
    known, classes = sorted_out(sketch)
    texts = keyed(docs).select(F.struct(F.col("doc_id").alias("id"), F.col("tkey").alias("t")).alias("node"), "text")
    nodes = shared.select("node").distinct()
    some = maybe_in(texts, nodes.select(F.xxhash64("node").alias("slot")), F.col("node")).where("_maybe").drop("_maybe")
    some = some.join(nodes, "node").dropDuplicates(["node"])  # not a semi join: Spark would do that before the filter
    sets = cut(some.mapInArrow(_set_bytes, f"node {NODE}, shingles binary"))
    size = sets.select("node", (F.length("shingles") / 8).cast("long").alias("n"))

    def links(pairs: DataFrame) -> DataFrame:
        sizes = pairs.join(size.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
        return sizes.where(f"100 * common >= {percent} * (na + nb - common)").select("a", "b")

    star = cut(shared.select(F.col("head.node").alias("a"), F.col("node").alias("b")).where("a <> b").distinct())
    compared = _compared(star, sets)
    drop(star)
    found = components(links(compared))
    across = _across(shared, compared, found, sets, percent)
    if not across.isEmpty():
        more = _compared(across, sets)
        found = _joined(found, cut(links(more)))
        drop(more)
    drop(shared, sets, compared, across)
    member = classes.join(found, "node", "left").select("set1", "set2", "n", F.coalesce("root.id", "node.id").alias("least"))
    # copies of one set are spread; rows that are linked with nothing don't travel
    linked = spread_join(known.select(*columns), member, ["set1", "set2"], known.count())
    alone = sketch.where("NOT (doc_id IS NOT NULL AND n_shingles > 0)").select(*columns, F.col("doc_id").alias("least"))
    out = linked.unionByName(alone)
    least_id = F.col("least")
    return out.select("doc_id", "n_shingles", least_id.alias("component_id"), F.coalesce(F.col("doc_id") == least_id, F.lit(True)).alias("kept"), "tkey")
