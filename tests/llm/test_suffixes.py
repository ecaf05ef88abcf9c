"""Suffix statistics of all URLs, whatever the size of the training sample."""

from collections import Counter

import pytest

from rillflow.llm import urls

URLS = [f"http://a{i}.big.org/p{i}" for i in range(80)] + [f"http://casino.t{i % 30}.net/x{i}" for i in range(60)] + [f"http://w.u{i}.com/" for i in range(40)] + ["none", None]


def suffix(u):
    return ".".join(u.split("/")[2].split(".")[-2:]) if u and "://" in u else ""


@pytest.mark.parametrize("most", [100_000, 3])
def test_suffix_statistics_are_of_all_urls(spark, monkeypatch, most):
    seen = []
    joined = urls.with_suffixes
    monkeypatch.setattr(urls, "HOT_SHARE", 0.1)
    monkeypatch.setattr(urls, "with_suffixes", lambda rows, counts: seen.append(joined(rows, counts, most)) or seen[-1])
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    assert urls.judge_urls(pages, training_urls=25, trees=2).count() == len(URLS)
    sample, rows = seen
    assert 15 <= sample.count() <= 25  # the held-out fifth isn't fitted on
    got = rows.collect()
    fold = {r.url: r.fold for r in got}
    n = Counter(suffix(u) for u in URLS if suffix(u))
    each = Counter((suffix(u), fold[u]) for u in URLS if suffix(u))
    bad = Counter((suffix(u), fold[u]) for u in URLS if u and "casino" in u)
    base = sum(bad.values()) / sum(n.values())
    assert Counter(r.page_id for r in got) == Counter(range(len(URLS)))
    for r in got:
        s = suffix(r.url)
        assert r.f_suffix_share == pytest.approx(n[s] / sum(n.values()))
        other = s, 1 - r.fold  # a row's own label is not in its rate
        assert r.f_suffix_rate == pytest.approx((bad[other] + 10 * base) / (each[other] + 10))
