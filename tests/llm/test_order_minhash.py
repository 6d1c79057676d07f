"""Order MinHash near-duplicates: alignment against dynamic programming, classes against all pairs."""

import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeline.llm import order_minhash as om
from lakeline.llm.components import components

SCHEMA = "doc_id long, text string, rep long, tokens string, sketch int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(0, 4), max_size=40), st.integers(0, 12))
def test_banded_alignment_equals_dynamic_programming(a, b, most):
    got = om.edit_distance(np.array(a, np.uint32), np.array(b, np.uint32), most)
    assert got == min(distance(a, b), most + 1)


def test_alignment_of_long_near_copies():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 500, 6_000).astype(np.uint32)
    b = np.delete(a, [10, 500, 5_999])
    b[3_000] = 777
    assert om.edit_distance(a, b, 100) == 4
    assert om.edit_distance(a, a[::-1].copy(), 50) == 51


@pytest.mark.parametrize("n, share, most_missed", [
    (250, 0.05, 0.005), (250, 0.1, 0.005), (250, 0.15, 0.005), (250, 0.2, 0.02), (60, 0.05, 0.005), (60, 0.1, 0.005),
    (60, 0.15, 0.005), (60, 0.2, 0.02), (40, 0.2, 0.02), (20, 0.1, 0.005), (20, 0.2, 0.04)])
def test_accepted_pairs_become_candidates(n, share, most_missed):
    """Recall per share of replaced words, up to the last share that still links."""
    rng = np.random.default_rng(5)
    missed = 0
    for _ in range(400):
        a = rng.integers(1, 1 << 62, n, dtype=np.uint64)
        b = a.copy()
        edits = int(share * n + 1e-9)
        b[rng.choice(n, edits, replace=False)] = rng.integers(1, 1 << 62, edits, dtype=np.uint64)
        assert om.edit_distance(a, b, n) <= om.allowed(n, n, om.SIMILARITY)
        missed += not (om.sketches(a) == om.sketches(b)).any()
    assert missed <= most_missed * 400


def words(t):
    return re.findall(r"\w+", (t or "").lower())


def edited(rng, w, share):
    w = list(w)
    for _ in range(int(share * len(w))):
        i = rng.randrange(len(w))
        kind = rng.random()
        if kind < 0.4:
            w[i] = f"new{rng.randrange(10**6)}"
        elif kind < 0.7:
            del w[i]
        else:
            w.insert(i, f"more{rng.randrange(10**6)}")
    return w


def corpus():
    rng = random.Random(11)
    vocabulary = [f"word{i}" for i in range(400)]
    docs = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 200))]
        docs.append(base)
        for _ in range(rng.choice([0, 0, 1, 3])):
            docs.append(edited(rng, base, rng.choice([0.01, 0.03, 0.3, 0.6])))
    big = [rng.choice(vocabulary) for _ in range(120)]
    docs += [edited(rng, big, 0.02) for _ in range(60)]  # a large group
    passage = [rng.choice(vocabulary) for _ in range(40)]  # shared, but most of none of them
    docs += [[rng.choice(vocabulary) for _ in range(120)] + passage for _ in range(20)]
    rows = [(i, " ".join(w), 0, "t", 1) for i, w in enumerate(docs)]
    n = len(rows)
    extra = ["", None, " \n", "one two", "One, two!", "one two three", "!!!", "solo", docs and " ".join(docs[0]).upper()]
    rows += [(n + i, t, None, None, None) for i, t in enumerate(extra)]
    rng.shuffle(rows)
    rows.append(rows[0])
    return rows


def test_classes_against_all_pairs(spark):
    rows = corpus()
    got = om.near_classes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    found = {r["doc_id"]: r["class_id"] for r in got}
    text = {r[0]: words(r[1]) for r in rows}
    ids = sorted(text)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    close = []
    for x in ids:
        for y in ids:
            a, b = text[x], text[y]
            if x < y and a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) - 1e-9:
                sa = {tuple(a[i:i + 5]) for i in range(max(1, len(a) - 4))}
                sb = {tuple(b[i:i + 5]) for i in range(max(1, len(b) - 4))}
                if len(sa & sb) < 0.02 * len(sa | sb):
                    continue  # far below the threshold by any measure
                if distance(a, b) <= om.allowed(len(a), len(b), 0.8):
                    parent[max(root(x), root(y))] = min(root(x), root(y))
                    if len(sa & sb) >= 0.8 * len(sa | sb):
                        close.append((x, y))
    for i in ids:  # nothing is joined that no chain of aligned pairs joins
        assert root(found[i]) == root(i)
        assert found[i] <= i and found[found[i]] == found[i]
    assert len(close) > 100
    assert all(found[x] == found[y] for x, y in close)


def test_short_texts_find_all_links(spark):
    """Every pair of texts of at most 14 words that links shares a class."""
    rng = random.Random(4)
    texts, pairs = [], []
    for i in range(400):
        n = rng.randint(5, 14)
        a = [f"w{rng.randrange(10**9)}" for _ in range(n)]
        b = list(a)
        for _ in range(rng.randint(1, n // 5)):
            at = rng.randrange(len(b))
            rng.choice([lambda: b.__setitem__(at, f"new{i}"), lambda: b.pop(at), lambda: b.insert(at, a[0])])()
        if len(b) <= 14 and a != b and distance(a, b) <= om.allowed(len(a), len(b), 0.8):
            pairs.append((len(texts), len(texts) + 1))
            texts += [a, b]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = {r["doc_id"]: r["class_id"] for r in om.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(pairs) > 250
    assert all(found[a] == found[b] == a for a, b in pairs)


def test_keep_one_keeps_columns_and_rows(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = om.keep_one(docs)
    assert kept.columns == docs.columns
    classes = {r["doc_id"]: r["class_id"] for r in om.near_classes(docs).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r[0] for r in rows if classes[r[0]] == r[0]})


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e f g"), (3, "a b c d e f g"), (4, "x"), (None, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["class_id"] is None, r["class_id"] or 0) for r in om.near_classes(docs).collect())
    assert got == [(False, 3, False, 3), (False, 4, False, 4), (True, 0, False, 3), (True, 0, True, 0)]
    assert om.near_classes(docs.limit(0)).count() == 0
    assert om.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "mixed"])
def test_components(spark, shape):
    rng = random.Random(5)
    if shape == "path":
        links = [(i, i + 1) for i in range(60)]
    elif shape == "star":
        links = [(7, i) for i in range(8, 200)]
    else:
        links = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(3, 3)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: root(i) for a, b in links if a != b for i in (a, b)}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def prose(seed, n=60):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def near_copy(words_, at=(7, 31)):
    return [f"new{i}" if i in at else w for i, w in enumerate(words_)]


def kept(spark, rows, names="doc_id long, text string, row string"):
    return sorted((tuple(r) for r in om.keep_one(spark.createDataFrame(rows, names)).collect()), key=str)


def test_one_id_with_two_texts_loses_neither(spark):
    a, b = prose(1), prose(2)
    a2, b2 = near_copy(a), near_copy(b)
    rows = [(i, " ".join(t), "r") for i, t in ((5, a), (9, b), (7, a2), (7, b2))]
    assert [r[:2] for r in kept(spark, rows)] == [(5, " ".join(a)), (7, " ".join(b2))]
    classes = {(r["doc_id"], r["class_id"]) for r in om.near_classes(spark.createDataFrame(rows, "doc_id long, text string, row string")).collect()}
    assert classes == {(5, 5), (7, 5), (9, 7), (7, 7)}


def test_texts_without_ids_are_compared_each_on_its_own(spark):
    a, b = prose(3), prose(4)
    rows = [(5, " ".join(a), "r"), (9, " ".join(b), "r"), (None, " ".join(near_copy(a)), "r"), (None, " ".join(near_copy(b)), "r")]
    assert [r[0] for r in kept(spark, rows)] == [5, 9]
    got = om.near_classes(spark.createDataFrame(rows, "doc_id long, text string, row string")).collect()
    assert sorted(r["class_id"] for r in got) == [5, 5, 9, 9]
    only = [(None, " ".join(prose(6)), "x"), (None, " ".join(near_copy(prose(6))), "y")]
    assert len(kept(spark, only)) == 1


def test_repeated_rows_stay_once_with_clashing_columns(spark):
    names = "doc_id long, text string, row string, at int, same int, _later int, component int, class int"
    text, other = " ".join(prose(8)), " ".join(near_copy(prose(8)))
    rows = [(i, t, "r", 1, 2, 3, 4, 5) for i, t in ((2, text), (2, text), (3, other), (4, None), (4, None), (6, "  "), (None, None))]
    got = kept(spark, rows, names)
    assert sorted(((r[0] is None, r[0]), r[1] is None) for r in got if r[0] is not None) == [((False, 2), False), ((False, 4), True), ((False, 6), False)]
    assert len(got) == 4 and all(r[2:] == ("r", 1, 2, 3, 4, 5) for r in got)


@pytest.mark.parametrize("change", [lambda w: "\u00a0".join(w), lambda w: " \u201c" + "\u201d \u2014 ".join(w) + "\u3000", lambda w: "\uff0c".join(w)])
def test_marks_beyond_ascii_end_words(spark, change):
    w = prose(9)
    rows = [(1, " ".join(w)), (2, change(w)), (3, "\u65e5\u672c\u8a9e\u306e\u6587\u7ae0\u3067\u3059\u3002" * 3), (4, "\u65e5\u672c\u8a9e\u306e\u6587\u7ae0\u3067\u3059" * 3)]
    got = {r["doc_id"]: (r["class_id"], r["n_words"]) for r in om.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (1, 60) and got[2] == (1, 60) and got[3] == got[4] == (3, 24)


def test_texts_that_link_share_a_rare_kmer():
    rng = random.Random(12)
    for n in (2, 3, 5, 8, 20, 60, 250):
        for _ in range(60):
            a = np.array([rng.randrange(1, 40) for _ in range(n)], "<u4")  # few words, so many repeats
            b = a.tolist()
            for _ in range(rng.randint(0, om.allowed(n, n, 0.8))):
                at = rng.randrange(len(b))
                rng.choice([lambda: b.__setitem__(at, 77), lambda: len(b) > 1 and b.pop(at), lambda: b.insert(at, 78)])()
            b = np.array(b, "<u4")
            if distance(list(a), list(b)) > om.allowed(len(a), len(b), 0.8) or min(len(a), len(b)) < om.K:
                continue
            frequency = np.array([rng.randrange(5) for _ in range(om.SLOTS // 1024)])
            rank = lambda k: (frequency[int(k) % len(frequency)], int(k))
            first = [set(sorted(om._kmers_of(t.tobytes()).tolist(), key=rank)[:om.needed(len(t), 0.8)]) for t in (a, b)]
            assert first[0] & first[1]


def test_a_shared_passage_makes_no_pairs_and_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(om, "CROWDED", 4)  # every bucket counts as crowded
    passage = prose(99, 40)
    texts = [passage + prose(i, 60) for i in range(60)]
    texts += [near_copy(t, (50, 70)) for t in texts[:20]] + [near_copy(passage, (3,)) + t[40:] for t in texts[20:30]]
    aligned = []
    real = om._verified
    monkeypatch.setattr(om, "_verified", lambda pairs, *a: aligned.append(pairs.count()) or real(pairs, *a))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in om.near_classes(docs).collect()}
    assert all(got[i] == i for i in range(60)) and all(got[60 + i] == i for i in range(30))
    assert aligned[-1] <= 40


def test_a_repeat_changes_no_other_kmer():
    a = np.arange(1, 30, dtype=np.uint64)
    b = np.concatenate([a, a[:2]])
    assert set(om.labelled_kmers(a).tolist()) < set(om.labelled_kmers(b).tolist())
    assert len(set(om.labelled_kmers(b).tolist())) == len(b) - om.K + 1


def joined(pairs, n):
    label = list(range(n))
    for a, b in pairs:
        label = [label[a] if x == label[b] else x for x in label]
    return {frozenset(i for i in range(n) if label[i] == x) for x in label}


@pytest.mark.parametrize("block", [4, 16, 256])
def test_links_by_rare_kmers_join_all_that_link(spark, monkeypatch, block):
    monkeypatch.setattr(om, "BLOCK", block)  # down to groups of several blocks a k-mer
    rng = np.random.default_rng(11)
    passage = rng.integers(1, 1 << 32, 70, dtype=np.uint64)
    texts = [np.concatenate([rng.integers(1, 60, int(rng.integers(0, 40)), dtype=np.uint64), passage[int(rng.integers(0, 20)):]])
             for _ in range(70)]
    texts += [np.where(rng.random(len(t)) < 0.08, np.uint64(5), t) for t in texts[:20]] + [texts[3], texts[3]]
    texts += [rng.integers(1, 1 << 32, 90, dtype=np.uint64) for _ in range(20)]
    texts += [np.where(rng.random(len(t)) < 0.05, np.uint64(6), t) for t in texts[-20:-10]]
    rows = [(i, len(t), i // 2, t.astype("<u4").tobytes()) for i, t in enumerate(texts)]
    crowd = spark.createDataFrame(rows, "rep long, n_words int, component long, tokens binary")
    got = [tuple(r) for r in om._links_by_rare_kmers(crowd, 0.8, 10**9).collect()]

    def link(a, b):
        most = om.allowed(len(a), len(b), 0.8)
        return om.edit_distance(a.astype(np.uint32), b.astype(np.uint32), most) <= most

    links = {(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if link(texts[a], texts[b])}
    known = [(i, i + 1) for i in range(0, len(rows) - 1, 2)]
    assert len(links) > 100 and set(got) <= links
    assert joined(got + known, len(rows)) == joined([*links, *known], len(rows)) != joined(known, len(rows))
    assert om._links_by_rare_kmers(crowd, 0.8, 0) is None


def test_kmers_that_other_texts_show_pass_the_bit_set(spark):
    kmers = [0, 1, -1, 63, 64, -(1 << 63), (1 << 63) - 1, om.SEEN_BITS, -om.SEEN_BITS - 7]
    seen = om._bits_of(spark.createDataFrame([(k,) for k in kmers], "kmer long"))
    bits = {(k % (1 << 64)) % om.SEEN_BITS for k in kmers}
    assert {64 * int(w) + b for w in np.flatnonzero(seen) for b in range(64) if int(seen[w]) >> b & 1} == bits


def test_kmers_of_one_component_meet_nowhere(spark, monkeypatch):
    """Near copies that are joined already share most rare k-mers; only those that others show too are kept."""
    rng = np.random.default_rng(4)
    bases = [rng.integers(1, 1 << 32, 60, dtype=np.uint64) for _ in range(6)]
    texts = [np.where(rng.random(60) < 0.05, rng.integers(1, 1 << 32, 60, dtype=np.uint64), b) for b in bases for _ in range(12)]
    texts += [np.where(np.arange(60) % 20 == 0, np.uint64(99), texts[0])]  # links to the first, in a component of its own
    rows = [(i, len(t), i // 12, t.astype("<u4").tobytes()) for i, t in enumerate(texts)]
    crowd = spark.createDataFrame(rows, "rep long, n_words int, component long, tokens binary")
    kept, real = [], om.store

    def store(df, name):
        table = real(df, name)
        kept.extend(r["kmer"] for r in table.collect()) if name == "order-minhash-shared" else None
        return table

    monkeypatch.setattr(om, "store", store)
    got = [tuple(r) for r in om._links_by_rare_kmers(crowd, 0.8, 10**9).collect()]
    assert {(a // 12, b // 12) for a, b in got} == {(0, 6)}
    first = {int(k) for t in texts[:12] for k in om._kmers_of(t.astype("<u4").tobytes()).astype(np.int64)}
    assert kept and set(kept) <= first


def test_texts_are_dealt_out_once_and_their_sketches_go(spark, monkeypatch):
    plans, paths, real = {}, [], om.store

    def store(df, name):
        table = real(df, name)
        paths.append((name, table.stored_at))
        if name == "order-minhash-buckets":
            df.collect()
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return table

    monkeypatch.setattr(om, "store", store)
    docs = spark.createDataFrame([(i, " ".join(prose(i // 2, 40) + ["more"] * (i % 2))) for i in range(40)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in om.near_classes(docs).collect()}
    assert got == {i: i // 2 * 2 for i in range(40)}
    final = plans["order-minhash-buckets"].split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("- Exchange hashpartitioning") == 1
    assert not any(os.path.exists(p.removeprefix("file://").removeprefix("file:")) for n, p in paths if n == "order-minhash")


def test_wanted_texts_are_found_without_a_shuffle(spark):
    wanted = [0, 1, 63, 64, 65, 8_000, (3 << 33) + 63, (3 << 33) + 127]
    rows = [(r, b"x") for r in [*wanted, 2, 62, 66, 127, 8_001, 3 << 33, (3 << 33) + 126, (4 << 33) + 63]]
    texts = spark.createDataFrame(rows, "rep long, tokens binary")
    got = om._only(texts, spark.createDataFrame([(r,) for r in wanted * 2], "rep long"))
    assert got.columns == ["rep", "tokens"] and sorted(r["rep"] for r in got.collect()) == sorted(wanted)
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert om._only(texts, texts.limit(0)).count() == 0


def test_frequencies_are_added_up_in_few_rows(spark):
    """The rows that leave a task do not grow with its texts."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    texts = [rng.integers(1, 1 << 32, 300).astype("<u4").tobytes() for _ in range(20)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i:i + 5])], names=["tokens"]) for i in range(0, 20, 5)]
    rows = [r for b in batches for out in om._frequencies(iter([b])) for r in out.to_pylist()]
    assert len(rows) == 4 * om.PARTS
    got = np.concatenate([np.frombuffer(om._summed(pa.Table.from_pylist([r for r in rows if r["part"] == p]))["held"][0].as_py(), np.int64)
                          for p in range(om.PARTS)])
    want = np.bincount(np.concatenate([om._kmers_of(t) % np.uint64(om.SLOTS) for t in texts]).astype(np.int64), minlength=om.SLOTS)
    assert got.tolist() == want.tolist()


def test_words_are_not_dealt_out_to_find_equal_texts(spark, monkeypatch):
    """The texts are stored once and read where they lie: rows of words cross no shuffle and are not written again."""
    columns, plans, real = {}, {}, om.store

    def store(df, name):
        table = real(df, name)
        columns.setdefault(name, df.columns)
        df.collect()
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return table

    monkeypatch.setattr(om, "store", store)
    docs = spark.createDataFrame([(i, " ".join(prose(i // 3, 40) + ["more"] * (i % 3 // 2))) for i in range(30)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in om.near_classes(docs).collect()}
    assert got == {i: i // 3 * 3 for i in range(30)}
    assert "tokens" in columns["order-minhash"] and not {"tokens", "sketches"} & {*columns["order-minhash-texts"]}
    assert "tokens" not in plans["order-minhash-texts"] and "tokens" not in plans["order-minhash-buckets"]


def _carried(n):
    """Bytes that go with the rare k-mers of a text of ``n`` different words."""
    tokens = np.random.default_rng(3).integers(1, 1 << 32, n, dtype=np.uint64).astype("<u4").tobytes()
    batch = pa.RecordBatch.from_pydict({"rep": [1], "n_words": pa.array([n], pa.int32()), "component": [1], "tokens": [tokens]})
    seen = np.full(om.SEEN_BITS // 64, np.iinfo(np.uint64).max, np.uint64)
    return sum(b.nbytes for b in om._rarest(np.zeros(om.SLOTS, np.int64), 0.8, seen)([batch]))


def test_a_long_text_does_not_go_with_each_of_its_kmers():
    assert _carried(16_000) < 6 * _carried(4_000) < 1_000_000


@pytest.mark.parametrize("words", [0, 40, 80])
def test_long_texts_link_as_those_that_are_carried(spark, monkeypatch, words):
    rng = np.random.default_rng(5)
    passage = rng.integers(1, 1 << 32, 50, dtype=np.uint64)
    texts = [np.concatenate([rng.integers(1, 60, int(rng.integers(0, 40)), dtype=np.uint64), passage[int(rng.integers(0, 20)):]])
             for _ in range(50)]
    texts += [np.where(rng.random(len(t)) < 0.08, np.uint64(5), t) for t in texts[:20]]
    rows = [(i, len(t), i // 2, t.astype("<u4").tobytes()) for i, t in enumerate(texts)]
    crowd = spark.createDataFrame(rows, "rep long, n_words int, component long, tokens binary")
    known = [(i, i + 1) for i in range(0, len(rows) - 1, 2)]
    carried = {tuple(r) for r in om._links_by_rare_kmers(crowd, 0.8, 10**9).collect()}
    monkeypatch.setattr(om, "CARRIED", words)
    got = {tuple(r) for r in om._links_by_rare_kmers(crowd, 0.8, 10**9).collect()}
    assert len(carried) > 20 and joined([*got, *known], len(rows)) == joined([*carried, *known], len(rows)) != joined(known, len(rows))
    for a, b in got:
        most = om.allowed(len(texts[a]), len(texts[b]), 0.8)
        assert om.edit_distance(texts[a].astype(np.uint32), texts[b].astype(np.uint32), most) <= most
