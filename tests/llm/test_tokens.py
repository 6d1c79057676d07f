"""Tokenizing operators: packing, token files, SentencePiece."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeline.llm import bpe, packing, token_files
from lakeline.llm import sentencepiece_scan as sps

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "text string, doc_id long, length int, rank string, file string, chunk int"
AWKWARD = [
    "", " ", "  ", " a", "a ", "a  b", "x\n\n y", "\tfoo", "a 's b", "don't we'll", "a\u00a0b", "a \u200bb c", "<|endoftext|> x",
    "...  !!", "a \n b", "é ñ 日本 語", "it's,'s','ll a'", "x\ny", "\n", "x\n", "a\x00b", "12ab,34' 'x", "¿qué? ¡no!", "3×4",
    "end.\nNext' ,\"q\"", "a'b,c-d_e f_g 1.5e3", "É.*** l'été,l' été", "word " * 3000, "ab" * 4000, "a\u0085b", "œuvre", "-\n-",
]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BPE)
    model.encode_special_tokens = True
    return lambda t: model.encode(t, add_special_tokens=False).ids


def rows_of(texts, start=0):
    return [(t, start + 2 * i, 1, "r", "f", 0) for i, t in enumerate(texts)]


def some_documents(n=60, seed=1):
    rng = random.Random(seed)
    vocabulary = ["the", "Word", "naïve", "x,y", "12", "end.", "\n", "deux", "(a)", "'s", "--"]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 50, 900, 4000]))) for _ in range(n)]


def test_batch_ids_equal_the_library(reference):
    texts = AWKWARD + some_documents(20) + AWKWARD
    flat, n = bpe.encoder(BPE).encode(texts)
    cuts = np.concatenate([[0], np.cumsum(n)])
    for i, t in enumerate(texts):
        assert flat[cuts[i]:cuts[i + 1]].tolist() == reference(t), t[:60]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab'., \n-é1¿", max_size=12), min_size=1, max_size=6))
def test_batch_ids_equal_the_library_on_any_text(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BPE) if not hasattr(bpe, "_model") else bpe._model
    bpe._model = model
    flat, n = bpe.encoder(BPE).encode(texts)
    assert flat.tolist() == [i for t in texts for i in model.encode(t, add_special_tokens=False).ids]
    assert n.tolist() == [len(model.encode(t, add_special_tokens=False).ids) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), min_size=1, max_size=12))
def test_a_window_is_filled_as_well_as_can_be(counts):
    chosen = packing.fill(counts, 40)
    largest = max(counts)
    assert chosen[largest] >= 1 and all(c <= counts[n] for n, c in chosen.items())
    sums = {largest}
    for n, c in counts.items():
        sums = {s + n * k for s in sums for k in range(c - (n == largest) + 1) if s + n * k <= 40}
    assert sum(n * c for n, c in chosen.items()) == max(sums)


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), min_size=1, max_size=30))
def test_a_plan_places_every_item_once(counts):
    windows = defaultdict(list)
    placed = Counter()
    entries = packing.plan(counts, 64)
    for n, group in entries.groupby("length"):
        ends = [*group["rank0"].tolist()[1:], counts[n]]
        for r, end in zip(group.itertuples(), ends):
            for j in range(end - r.rank0):
                windows[r.sequence0 + j // r.copies].append((r.offset0 + j % r.copies * n, n))
                placed[n] += 1
    assert placed == counts
    for w in windows.values():
        at = 0
        for offset, n in sorted(w):
            assert offset == at
            at += n
        assert at <= 64
    assert sorted(windows) == list(range(len(windows)))


def test_packing_places_every_id(spark, reference):
    texts = AWKWARD + some_documents() + [None, AWKWARD[-3]]
    rows = rows_of(texts)
    rows += [rows[1], ("null id", None, 1, None, None, None)]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(5), BPE, 512).collect()
    ids = {}
    for t, d, *_ in rows:
        ids[d] = np.array([*reference(t or ""), 1], "<u4")
    seen = Counter()
    for r in got:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(own[r["start"]:r["start"] + r["length"]].tobytes())
        seen[r["doc_id"]] += r["length"]
    times = Counter(d for _, d, *_ in rows)
    assert seen == {d: len(ids[d]) * times[d] for d in ids}
    windows = defaultdict(list)
    for r in got:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for w in windows.values():
        at = 0
        for offset, n in sorted(w):
            assert offset == at
            at += n
        assert at <= 512
    fills = [sum(n for _, n in w) for w in windows.values()]
    assert 512 * len(fills) - sum(fills) <= 0.02 * sum(fills) + 512


def test_packing_nothing(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), BPE).count() == 0


@pytest.mark.parametrize("block", [7, 500, 100_000])
def test_token_counts(spark, reference, block):
    rows = rows_of(AWKWARD + some_documents(30) + [None])
    rows.append(rows[0])
    blocks = token_files.flat_blocks(spark.createDataFrame(rows, SCHEMA).repartition(3), BPE, block=block)
    got = token_files.count_tokens(blocks).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter((d, len(reference(t or ""))) for t, d, *_ in rows)
    by_file = defaultdict(list)
    for r in got:
        by_file[r["file"]].append((r["start"], r["n_tokens"]))
    for f in by_file.values():
        at = 0
        for start, n in sorted(f):
            assert start == at
            at += n + 1


def test_token_counts_of_odd_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCKS_PER_SPAN", 2)
    raw = lambda *x: np.array(x, "<u2").tobytes()
    rows = [(0, 0, raw(5, 5), [], 1), (0, 1, None, None, 1), (0, 2, raw(5), None, 2), (0, 3, raw(5, 9, 9, 5), [11], 1),
            (0, 4, raw(), [], 1), (0, 5, raw(5, 5), [], 1), (0, 6, raw(9, 5), [13], 1), (1, 0, raw(5), [], 0)]
    blocks = spark.createDataFrame(rows, "file int, block long, payload binary, doc_ids array<long>, n int")
    got = sorted((tuple(r) for r in token_files.count_tokens(blocks, end=9).collect()), key=lambda r: r[2])
    assert got == [(11, 0, 0, 4), (None, 0, 5, 0), (13, 0, 6, 3)]
    assert token_files.count_tokens(blocks.limit(0)).count() == 0


@pytest.fixture(scope="module")
def unigram():
    """The library's own unigram segmentation over the same pieces."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(PIECES, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


SP_TEXTS = ["", " ", "Hello world, this is thatananouan", "ééé  två  x\n\ny 日本 😀", "a" * 500, "word " * 400, "x" * 70 + " " + "né" * 90,
            "   lead", "trail   ", "tab\tand\u00a0such", "Zu für enerte und. Der des in stch", "ab   cd" * 60]


def best_sum(model, s):
    """Plain dynamic program over all pieces, from the right."""
    best = {len(s): 0.0}
    for i in range(len(s) - 1, -1, -1):
        ends = [j for j in range(i + 1, min(len(s), i + model.reach) + 1) if s[i:j] in model.score]
        found = [model.score[s[i:j]] + best[j] for j in ends]
        best[i] = max(found + ([] if i + 1 in ends else [model.unknown + best[i + 1]]))
    return best[0] if s else 0.0


def test_segmentation_is_the_best_one(unigram):
    """No segmentation has a higher sum, the library's neither (it adds in single precision)."""
    model = sps.pieces(PIECES)
    texts = [t for t in [*SP_TEXTS, *some_documents(10)] if t]
    for t in texts:
        s = sps.escaped(t)
        score, ids = model.encode(s)
        assert score == best_sum(model, s)
        assert model.decode(np.frombuffer(ids, "<i4")) == t
        theirs = unigram.encode(t)
        if all(unigram.id_to_piece(i) in model.score for i in theirs):
            assert score >= sum(model.score[unigram.id_to_piece(i)] for i in theirs)


@pytest.mark.parametrize("chunk", [16, 23, 100, 65_536])
def test_encoding_does_not_depend_on_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(sps, "GROUP", 3)
    texts = SP_TEXTS + ["nospace" * 60, "日" * 50 + "x" * 40]
    rows = rows_of([*texts, None]) + [("null id " * 9, None, 0, None, None, 1)]
    rows.append(rows[2])
    got = sps.decode(sps.encode(spark.createDataFrame(rows, SCHEMA), PIECES, chunk), PIECES).collect()
    model = sps.pieces(PIECES)
    expected = Counter((d, *model.encode(sps.escaped(t or "")), t or "") for t, d, *_ in rows)
    assert Counter((r["doc_id"], r["score"], bytes(r["ids"]), r["decoded"]) for r in got) == expected


def test_transfer_matrices_are_associative():
    model = sps.pieces(PIECES)
    s = sps.escaped("thatananouan und die Verheißung" * 3 + "q" * 20)
    whole = sps.transfer(model, s, len(s))
    parts = [sps.transfer(model, s[a:a + 20 + model.reach], min(20, len(s) - a)) for a in range(0, len(s), 20)]
    if len(s) % 20 and len(s) % 20 < model.reach:
        parts[-2:] = [sps.transfer(model, s[len(s) // 20 * 20 - 20:], len(s) - len(s) // 20 * 20 + 20)]
    left = parts[0]
    for p in parts[1:]:
        left = sps.product(left, p)
    right = parts[-1]
    for p in parts[-2::-1]:
        right = sps.product(p, right)
    assert left[0, 0] == right[0, 0] == whole[0, 0] == model.encode(s)[0]


def test_encoding_nothing(spark):
    assert sps.encode(spark.createDataFrame([], SCHEMA), PIECES).count() == 0


def test_ids_that_doubles_cannot_hold(spark):
    big = 2**53 + 1
    rows = rows_of(["a b c", None, "d"])
    docs = spark.createDataFrame([(r[0], i, *r[2:]) for r, i in zip(rows, (big, None, -big))], SCHEMA).coalesce(1)
    got = packing.pack(docs, BPE, 8).collect()
    assert {r["doc_id"] for r in got} == {big, None, -big}


def test_foreign_vocabularies_run_as_their_file_says():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    assert bpe.splits_by_pattern(BPE) and not bpe.splits_by_pattern(path)
    flat, n = bpe.encoder(path).encode(["Hello  World", "", "<|endoftext|>"])
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    want = [model.encode(t, add_special_tokens=False).ids for t in ("Hello  World", "", "<|endoftext|>")]
    assert n.tolist() == list(map(len, want)) and flat.tolist() == sum(want, [])


def test_identifiers_must_fit_a_token_file():
    import pyarrow as pa

    write = token_files._write(BPE, 70_000, 16, "<u2")
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b"])], names=["doc_id", "text"])
    from unittest import mock
    with mock.patch.object(token_files, "TaskContext"), pytest.raises(ValueError, match="does not fit"):
        list(write(iter([batch])))


def test_words_outlive_one_change_of_generation(monkeypatch):
    """Full memory does not forget the words in use: they are not segmented again."""
    monkeypatch.setattr(sps, "REMEMBERED", 4)
    model = sps.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    seen, word = [], model.word
    monkeypatch.setattr(model, "word", lambda w: seen.append(w) or word(w))
    want = model.encode(sps.escaped("often"))
    for i in range(40):
        assert model.encode(sps.escaped("often")) == want
        model.encode(sps.escaped(f"once{i}"))
    assert seen.count("▁often") == 1 and len(seen) == 41
    assert len(model.words) <= 6 and len(model.older) <= 6


def test_many_words_at_once_are_segmented_as_one_by_one():
    import random

    rng = random.Random(3)
    model = sps.Pieces(PIECES)
    words = ["".join(rng.choice("▁▁aeénstrhd日x😀́ïß") for _ in range(rng.randint(1, 40))) for _ in range(3_000)]
    words += ["▁", "日" * 200, "▁" + "than" * 100]
    assert model.segmented(words) == [model.word(w) for w in words]


def test_a_batch_is_encoded_and_decoded_in_slices():
    """What a worker holds besides its batch does not grow with the batch."""
    import pandas as pd
    import pyarrow as pa

    texts = ["some words " * 20_000] * 9 + ["", "b c"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    got = list(sps._short(PIECES)(iter([batch])))
    assert len(got) > 3 and max(sum(map(len, texts[:b.num_rows])) for b in got) <= 2 * sps.SLICE
    model = sps.pieces(PIECES)
    assert [i for b in got for i in b["doc_id"].to_pylist()] == list(range(len(texts)))
    assert [i for b in got for i in b["ids"].to_pylist()] == [model.encode(sps.escaped(t))[1] for t in texts]
    ids = pd.Series([i for b in got for i in b["ids"].to_pylist()] * 3 + [None])
    decoded = list(sps._decoded(PIECES)(iter([ids])))
    assert len(decoded) > 1 and [t for s in decoded for t in s] == texts * 3 + [None]
