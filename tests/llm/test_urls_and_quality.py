"""URL trie and importance resampling."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeline.llm import importance, url_trie
from lakeline.llm.queries import URL_RULES

PAGES = "page_id long, url string, host string, rule int"


def plain(url, rules, default="allow"):
    host, path = url_trie.parts(url)
    fit = [(len(h + p), v == "block", h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else (None, default)


URLS = ["http://Example.ORG/es/1", "https://a.b.example.org/en/12?x=/es/", "http://example.org", "http://example.org?q=/x", "org/es/", None, "",
        "http://", "http:///es/", "x://com/fr/1#a://b", "http://notexample.org/es/", "http://com/de/", "http://a.com/de", "HTTP://É.Com/fr/É",
        "http://a.example.org./es/", "http://example.org/en/", "http://example.org/en/1", "http://example.org//es/", "http://u@example.org:80/es/"]


def test_urls_equal_plain_matching(spark):
    rows = [(i, u, "h", 1) for i, u in enumerate(URLS)] + [(0, URLS[0], None, None), (None, URLS[1], None, None)]
    got = url_trie.judge_urls(spark.createDataFrame(rows, PAGES), URL_RULES).collect()
    expected = [(i, *url_trie.parts(u), *plain(u, URL_RULES)) for i, u, *_ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert url_trie.judge_urls(spark.createDataFrame([], PAGES), URL_RULES).count() == 0


def test_parts():
    assert url_trie.parts("http://A.b?x/y") == ("a.b", "")
    assert url_trie.parts("http://A.b/C?x/y#z") == ("a.b", "/C")
    assert url_trie.parts("http://A.b#x") == ("a.b", "")
    assert url_trie.parts("a.b/c") == url_trie.parts(None) == ("", "")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["allow", "block"]), st.sampled_from(["a", "b.a", "c.b.a", "b"]),
                          st.sampled_from(["/", "/x", "/x/", "/x/y", "/xy/z"])), max_size=6),
       st.sampled_from(["a", "b.a", "z.c.b.a", "b", "ab", "x.b"]), st.sampled_from(["", "/", "/x", "/xy", "/x/y/z", "/xy/zz"]))
def test_any_rules(rules, host, path):
    url = f"s://{host}{path}"
    assert (url_trie.Trie(rules).find(host, path) or (None, "allow")) == plain(url, rules)


def test_too_many_rules():
    with pytest.raises(ValueError, match="at most"):
        url_trie.Trie([("allow", f"h{i}", "/") for i in range(url_trie.MAX_RULES + 1)])


def corpus(n=600, seed=2):
    rng = random.Random(seed)
    good = [f"w{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        text = " ".join((rng.choice(good) + ("!!" if bad and rng.random() < 0.8 else "")) for _ in range(rng.randint(20, 150)))
        rows.append((i, text, 0.5, True, "k"))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1, 0, 1.0))
    return rows, labels


DOCS, LABELS = "doc_id long, text string, log_weight double, kept boolean, key string", "doc_id long, quality int, toxic int, key double"


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    labelled = {l[0] for l in labels}
    got = importance.resample(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    fresh = [r for r in got if r["doc_id"] not in labelled]
    assert np.mean([r["kept"] for r in fresh if r["doc_id"] % 6]) >= 0.98
    assert np.mean([r["kept"] for r in got if r["doc_id"] % 6 == 0]) <= 0.05


def test_rejected_rows_go_and_columns_stay(spark):
    rows, labels = corpus()
    rows += [(None, rows[1][1], None, None, None), (5_000, None, None, None, None), (5_001, "", 0.0, False, ""), rows[7],
             (5_002, "w1 " * 20_000, None, None, None)]
    labels += [(None, 1, 0, None), (4, None, None, None), labels[1]]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    verdict = importance.resample(docs, marks)
    kept = importance.keep_target_like(docs, marks)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in verdict.filter("kept").collect())


def test_no_labels_or_no_documents(spark):
    rows, labels = corpus(30)
    docs, none = spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)
    assert all(r["kept"] for r in importance.resample(docs, none).collect())
    assert importance.resample(docs.limit(0), spark.createDataFrame(labels, LABELS)).count() == 0
    assert importance.keep_target_like(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 17, 20_499, 20_500, 20_501])
def test_kth_largest(spark, monkeypatch, k):
    monkeypatch.setattr(importance, "_BINS", 7)
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.standard_normal(6_000), np.full(14_000, 0.25), rng.standard_normal(500) * 1e6])
    keys = spark.createDataFrame([(float(v),) for v in values], "key double")
    cut = importance.kth_largest(keys, k)
    expected = np.inf if k == 0 else -np.inf if k >= len(values) else np.sort(values)[::-1][k - 1]
    assert cut == expected


def test_threshold_over_all_targets_the_fit_left(spark):
    """The bounded sample is for the fit alone; every other target has a say in k."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["good", "fine", "dull", "poor"]) for _ in range(rng.randint(5, 60)))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 400)) for i, _ in rows], "doc_id long, quality int")
    sample, keep = 40, 0.9
    fitted = importance._good(labels).selectExpr(
        "target_id", f"xxhash64(target_id, {importance.SEED}) AS h", "pmod(xxhash64(target_id), 2) = 0 AS fit").orderBy("h").limit(sample)
    fitted = {r["target_id"] for r in fitted.collect() if r["fit"]}
    scored = importance.resample(docs, labels, sample, keep).collect()
    held = [r["log_weight"] for r in scored if r["doc_id"] < 400 and r["doc_id"] not in fitted]
    assert 0 < len(fitted) <= sample and len(held) == 400 - len(fitted)
    floor = np.quantile(held, 1 - keep)
    assert sum(r["kept"] for r in scored) == sum(r["log_weight"] >= floor for r in scored)


@pytest.mark.parametrize("share", [0.0, 0.002, 0.31, 1.0])
def test_quantile(spark, share):
    values = [float(i * i % 97) for i in range(150)]
    got = importance.quantile(spark.createDataFrame([(v,) for v in values], "key double"), share)
    assert got == pytest.approx(np.quantile(values, share))
