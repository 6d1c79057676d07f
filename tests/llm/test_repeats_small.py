"""Substring operators against brute force on small, awkward documents."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lakeline.llm import repeats
from lakeline.llm.fm_substrings import remove_repeated_windows
from lakeline.llm.suffix_dedup import remove_later_copies

SCHEMA = "text string, doc_id long, anchor int, stretch string, at string"


def awkward(seed: int):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(60))
    line = "the very same line stands in most of these documents\n"
    docs = []
    for i in range(80):
        own = " ".join(word() for _ in range(rng.randint(0, 120)))
        parts = [own, rng.choice([passage, passage[7:300], ""]), line * rng.randint(0, 3), rng.choice([own[:200], ""])]
        rng.shuffle(parts)
        docs.append(" ".join(parts) if i % 3 else "\t".join(parts))
    docs += [docs[3], docs[3], "", None, None, "a" * 400, "a" * 300, "x y " * 90, passage, "é" * 120, "short", "short"]
    docs += [" \n\x0b ", " ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(1500, 1600))]
    rows = [(t, i * 3 - 20, 1, "s", "a") for i, t in enumerate(docs)]
    rng.shuffle(rows)
    rows.append(rows[0])  # a repeated row
    rows.append((docs[5], None, None, None, None))
    return rows


def bytes_brute(rows, width=50):
    first = {}
    key = lambda d: -(1 << 63) if d is None else d
    for t, d, *_ in rows:
        b = (t or "").encode()
        for p in range(len(b) - width + 1):
            s = b[p:p + width]
            first[s] = min(first.get(s, 1 << 62), key(d))
    out = Counter()
    for t, d, *_ in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - width + 1):
            if first[b[p:p + width]] < key(d):
                gone[p:p + width] = [True] * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[(d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def words_brute(rows, width=35):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t, *_ in rows]
    seen = defaultdict(int)
    for w in split:
        for p in range(len(w) - width + 1):
            seen[tuple(w[p:p + width])] += 1
    out = Counter()
    for (t, d, *_), w in zip(rows, split):
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if seen[tuple(w[p:p + width])] > 1:
                gone[p:p + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[(d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("seed, distinct", [(1, 2_000), (2, 2)])
def test_later_copies_equal_brute_force(spark, monkeypatch, seed, distinct):
    monkeypatch.setattr(repeats, "DISTINCT_PER_ANCHOR", distinct)  # 2: most anchors take the split way
    rows = awkward(seed)
    got = remove_later_copies(spark.createDataFrame(rows, SCHEMA))
    found = Counter(tuple(r)[:5] for r in got.collect())
    assert found == bytes_brute(rows)


@pytest.mark.parametrize("seed, distinct", [(3, 2_000), (4, 2)])
def test_repeated_windows_equal_brute_force(spark, monkeypatch, seed, distinct):
    monkeypatch.setattr(repeats, "DISTINCT_PER_ANCHOR", distinct)
    rows = awkward(seed)
    got = remove_repeated_windows(spark.createDataFrame(rows, SCHEMA))
    found = Counter(tuple(r)[:4] for r in got.collect())
    assert found == words_brute(rows)


def test_common_anchors_announced_from_one_slice_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(repeats, "COMMON_IN_SLICE", 2)
    rows = awkward(5)
    got = remove_later_copies(spark.createDataFrame(rows, SCHEMA))
    assert Counter(tuple(r)[:5] for r in got.collect()) == bytes_brute(rows)


def test_many_slices_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE", 500)
    rows = awkward(6)
    got = remove_repeated_windows(spark.createDataFrame(rows, SCHEMA))
    assert Counter(tuple(r)[:4] for r in got.collect()) == words_brute(rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert remove_later_copies(empty).count() == 0
    assert remove_repeated_windows(empty).count() == 0


def test_anchors_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    units = rng.integers(1, 4, 5_000).astype(np.uint64)
    units[1_000:1_400] = 7
    bounds = np.array([0, 900, 900, 2_000, 2_030, 5_000])

    def anchors():
        first, count, key = repeats.runs(units, bounds, 50, 32)
        return dict(zip((np.repeat(first, count) + np.concatenate([np.arange(c) for c in count])).tolist(), np.repeat(key, count).tolist()))

    whole = anchors()
    monkeypatch.setattr(repeats, "_BLOCK", 300)
    assert anchors() == whole
    assert len(whole) == sum(max(0, n - 49) for n in np.diff(bounds).tolist())
    by_content = defaultdict(set)
    for at, key in whole.items():
        by_content[units[at:at + 50].tobytes()].add(key)
    assert all(len(k) == 1 for k in by_content.values())


def test_rows_without_id_go_by_their_text(spark):
    rows = [(t, None if i % 2 else d, *rest) for i, (t, d, *rest) in enumerate(awkward(7))]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert Counter(tuple(r)[:5] for r in remove_later_copies(frame).collect()) == bytes_brute(rows)
    assert Counter(tuple(r)[:4] for r in remove_repeated_windows(frame).collect()) == words_brute(rows)


def test_answers_arrive_whole_however_few_are_gathered_at_a_time(monkeypatch):
    rng = np.random.default_rng(3)
    owner = rng.integers(-1 << 63, 1 << 62, 300)
    sent = {(int(o), int(a)) for o, a in zip(rng.choice(owner, 4_000), rng.integers(1 << 36, (1 << 36) + 900, 4_000))}
    by_anchor = Counter(a for _, a in sent)
    pairs = np.array(sorted(sent, key=lambda p: p[1]), np.int64)
    asked = repeats._packed(pairs[:, 1].astype(np.uint64), np.zeros(len(pairs), np.uint16), pairs[:, 0], 1)
    told = repeats._tell(pa.Table.from_batches([asked]))
    assert len(set(told.column("home").to_pylist())) == told.num_rows <= repeats.HOMES
    for gathered in (repeats.GATHERED, 7):
        monkeypatch.setattr(repeats, "GATHERED", gathered)
        got = [(k, a) for b in repeats._by_document(told.to_batches()) for k, raw in zip(*(c.to_pylist() for c in b.columns))
               for a in np.frombuffer(raw, np.uint64).tolist()]
        assert sorted(got) == sorted(p for p in sent if by_anchor[p[1]] > 1)
