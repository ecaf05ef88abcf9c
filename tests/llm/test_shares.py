"""Tokens of the mixed copies against targets raked in plain Python, on skewed sources."""

import math
import random
import time
from collections import Counter, defaultdict

import pytest
from test_llm import WORD

from rillflow.llm.mixing import marginals, mix, mixed_marginals, rake

POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.7}


def form(text):
    n = len(WORD.findall(text))
    if n and text.count("|") * 10 >= n:
        return "table"
    return "empty" if n == 0 else "short" if n < 100 else "long" if n >= 1000 else "prose"


def raked(rows, form=form):
    """Weight of each cell (source, lang, topic)."""
    cells = Counter()
    for _, t, lang, source in rows:
        cells[source, lang, form(t)] += len(WORD.findall(t))
    cells = {k: v for k, v in cells.items() if v}
    total, w = sum(cells.values()), {k: float(v) for k, v in cells.items()}
    targets = []
    for d, p in enumerate(POWERS.values()):
        sums = Counter()
        for k, v in cells.items():
            sums[k[d]] += v
        powers = {v: n**p for v, n in sums.items()}
        targets.append({v: n / sum(powers.values()) for v, n in powers.items()})
    for _ in range(300):
        for d, target in enumerate(targets):
            have = defaultdict(float)
            for k, v in w.items():
                have[k[d]] += v
            w = {k: v * target[k[d]] * total / have[k[d]] for k, v in w.items()}
    return {k: w[k] / cells[k] for k in cells}, targets, total


@pytest.fixture(scope="module")
def skewed():
    r = random.Random(8)
    rows = []
    for i in range(900):
        source = r.choices(["a", "b", "c"], [90, 8, 2])[0]
        words = ["w"] * r.choice([30, 60, 150, 250, 250])
        if r.random() < 0.05:
            words = [w + "|" for w in words]
        rows.append((i, " ".join(words), r.choices(["en", "de"], [9, 1])[0], source))
    return rows


def test_copies_meet_the_targets(spark, skewed):
    import corpus_pipeline as c

    weights, targets, total = raked(skewed)
    docs = spark.createDataFrame(skewed, "doc_id long, text string, lang string, source string")
    out = mix(docs, keep=0.8).collect()
    assert any(0.8 * w > 2 for w in weights.values())
    tokens = [Counter(), Counter(), Counter()]
    for x in out:
        due = 0.8 * weights[x.source, x.lang, x._topic]
        assert abs(x._chance - min(1, due)) < 1e-6 and x._copies in (int(due), int(due) + 1) and x._kept == (x._copies > 0)
        for d, v in enumerate((x.source, x.lang, x._topic)):
            tokens[d][v] += x._copies * x._tokens
    for have, target in zip(tokens, targets, strict=True):
        for v, share in target.items():
            # a draw alters a copy by less than one: far under a tenth of the target in all
            assert abs(have[v] / (0.8 * total * share) - 1) < 0.1, v
    stage = Counter(r.doc_id for r in c.mixing_stage(spark, docs, "").collect())
    assert stage == Counter({x.doc_id: x._copies for x in out if x._copies})


def one_language_each(n):
    """n sources; the first two of three speak English only, the others French only."""
    return [(i, "w " * (20 + 7 * (i % 11) + 90 * (i % 3 == 0)), "fr" if i % n % 3 == 2 else "en", f"s{i % n}") for i in range(20 * n)]


def divergence(w, targets):
    total, out = sum(w.values()), 0.0
    for d, target in enumerate(targets):
        have = defaultdict(float)
        for k, v in w.items():
            have[k[d]] += v
        out += sum(t * math.log(t * total / have[v]) for v, t in target.items())
    return out


@pytest.mark.parametrize("n", [4, 10])
def test_targets_that_exclude_each_other(spark, n):
    """Marginals as near as they come: no cell can be moved for a lesser sum of divergences."""
    import corpus_pipeline as c

    rows = one_language_each(n)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    began = time.time()
    out = mix(docs, keep=0.8).collect()
    assert time.time() - began < 60  # seconds on a quiet machine: under 20
    _, targets, total = raked(rows)
    w = defaultdict(float)
    for x in out:
        w[x.source, x.lang, x._topic] += x._weight * x._tokens
    least = divergence(w, targets)
    assert abs(sum(w.values()) / total - 1) < 0.2
    for k in w:
        for factor in (0.97, 1.03):
            assert divergence(w | {k: w[k] * factor}, targets) > least - 1e-6
    left = mixed_marginals(docs).collect()
    assert {x.dimension for x in left} == {"_source", "_lang", "_topic"} and max(abs(x.residual) for x in left) > 1e-3
    assert abs(sum(x.share for x in left) - 3) < 1e-6
    stage = Counter(r.doc_id for r in c.mixing_stage(spark, docs, "").collect())
    assert stage == Counter({x.doc_id: x._copies for x in out if x._copies})


def test_few_rounds_still_give_weights(spark):
    cells = spark.createDataFrame([("a", "x", 60), ("a", "y", 40), ("b", "x", 30), ("b", "y", 70)], "p string, q string, tokens long")
    even = {d: spark.createDataFrame([(v, 0.4 + 0.2 * (v in "ax")) for v in vs], f"{d} string, share double") for d, vs in (("p", "ab"), ("q", "yx"))}
    assert max(abs(x.residual) for x in marginals(rake(cells, even), even).collect()) < 1e-8
    assert max(abs(x.residual) for x in marginals(rake(cells, even, rounds=4), even).collect()) < 0.05
