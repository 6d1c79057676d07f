"""Size shards, fill-in-the-middle and token alignment against brute force."""

import hashlib
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lakeline.llm import boundaries, fill_middle, size_shards, token_alignment
from tests.conftest import SF001

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "text string, doc_id long, row string, shard int, at long, task int, cut int, slice int, n string, pair int, form string"
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
AWKWARD = [None, "", " ", "\n\n", "a", "  a  b ", "naïve 日本語 text x", "a▁b", "▁", "has <P> mark", "x<S", "M> <M", "<|endoftext|> y",
           "\x00 z", "tab\tand\x0bmore\r\n", "🙂 🙂🙂", "<s> </s> <unk> <0x41>", "word " * 30_000, "ab" * 40_000, "é" * 70_000 + " end"]


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(t, i, "r", 1, 2, 3, 4, 5, "n", 6, "f") for t, i in zip(texts, ids)], SCHEMA)


# --- boundary set


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400_000), st.integers(1, 9_000), st.integers(1, 9)), max_size=5))
def test_boundary_set_selects_every_value(stretches):
    values = np.unique(np.concatenate([np.zeros(0, np.int64)] + [np.arange(a, a + n * step, step) for a, n, step in stretches]))
    inside = boundaries.BoundarySet(values)
    assert len(inside) == len(values)
    for k in {0, len(values) // 3, len(values) // 2, len(values) - 1} - {-1}:
        if len(values):
            assert inside.select(k) == values[k]
    with pytest.raises(IndexError):
        inside.select(len(values))


def test_each_kind_of_container():
    kinds = lambda v: [type(c) for c in boundaries.BoundarySet(np.asarray(v)).containers]
    assert kinds([1, 5, 70_000, 70_009]) == [boundaries.ArrayContainer] * 2
    assert kinds(np.arange(0, 60_000, 2)) == [boundaries.BitmapContainer]
    assert kinds(np.arange(200_000)) == [boundaries.RunContainer] * 4
    for v in ([1, 5, 70_000, 70_009], np.arange(0, 60_000, 2), np.arange(200_000)):
        inside = boundaries.BoundarySet(np.asarray(v))
        assert [inside.select(k) for k in range(0, len(v), 97)] == list(v[::97])


# --- fill in the middle


def middle_brute(doc_id, text, rate=50):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:i]), "".join(tokens[i:j]), "".join(tokens[j:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate", [50, 100])
def test_fill_in_middle_against_brute_force(spark, rate):
    rng = random.Random(7)
    texts = AWKWARD * 3 + ["".join(rng.choice("ab <>PSMé\n\t") for _ in range(rng.randrange(60))) for _ in range(300)]
    ids = [None, None, 3, 3, *range(10**15, 10**15 + len(texts) - 4)]
    got = fill_middle.fill_in_middle(frame(spark, texts, ids), rate=rate) \
        .withColumn("back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((middle_brute(i, t, rate) for t, i in zip(texts, ids)), key=key)
    assert sorted(r["back"] for r in got) == sorted(t or "" for t in texts)
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}


def test_fill_in_middle_of_nothing_and_bad_marks(spark):
    assert fill_middle.fill_in_middle(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(frame(spark, ["a"]), marks=("<P>", "<S>", "<P>"))
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(frame(spark, ["a"]), marks=("abc", "c", "d"))


# --- shards


def shards_brute(rows, count):
    """(doc_id, size, checksum, shard, slot) in order of doc_id, size and checksum."""
    sized = sorted(((i is not None, i or 0), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t, i in rows)
    total, before, slots, out = sum(s for _, s, _ in sized), 0, Counter(), []
    for (known, i), size, crc in sized:
        shard = (2 * before + size) * count // (2 * total)
        out.append((i if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return out


@pytest.mark.parametrize("block", [3, size_shards.BLOCK_ROWS])
@pytest.mark.parametrize("count", [1, 24])
def test_shards_against_brute_force(spark, monkeypatch, block, count):
    monkeypatch.setattr(size_shards, "BLOCK_ROWS", block)
    rng = random.Random(3)
    texts = AWKWARD + ["x" * rng.randrange(200) for _ in range(400)] + ["same"] * 200
    ids = [None, None, *rng.sample(range(-(10**12), 10**12), len(texts) - 202), *[77] * 200]
    got = size_shards.assign(frame(spark, texts, ids).repartition(7), count).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(shards_brute(zip(texts, ids), count), key=key)


def test_shards_are_near_equal_and_gapless(spark):
    got = entry.queries()["op11_size_shards"](spark, SF001).toPandas()
    sizes = got.groupby("shard")["size"].sum().reindex(range(24), fill_value=0)
    assert sizes.max() - sizes.min() <= 2 * got["size"].max()
    for _, slots in got.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    assert got["grown_shard"].isna().all() and set(got["law"]) == {"bytes"}


def test_shards_keep_input_rows_and_are_written_in_order(spark, workdir):
    docs = frame(spark, ["a", None, "ccc", "dd" * 50], [4, 3, None, 1])
    kept = size_shards.assign(docs, 2, carry=True)
    assert sorted(map(str, kept.select("row.*").collect())) == sorted(map(str, docs.collect()))
    size_shards.write_shards(docs, f"{workdir}/shards", 2)
    assert spark.read.parquet(f"{workdir}/shards").select("row.doc_id", "shard").distinct().count() == 4
    assert size_shards.assign(frame(spark, []), 24).collect() == []
    with pytest.raises(ValueError):
        size_shards.assign(docs, 0)


def test_shards_run_no_python(spark):
    plan = entry.queries()["op11_size_shards"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- alignment


def alignment_brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    from lakeline.llm.bpe import byte_of_character

    first = Tokenizer.from_file(BPE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    of = byte_of_character()
    spelled = {i: bytes(of.get(c, 0) for c in t) for t, i in first.get_vocab().items()}

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    counts, seen = Counter(), []
    for t, i in rows:
        entry_ = (i, 0, 0, 0, [], "")
        if t:
            a, b, want = first.encode(" " + t, add_special_tokens=False).ids, second.encode(t), (" " + t).encode()
            bytes_a, bytes_b = [spelled[x] for x in a], [piece(x) for x in b]
            if b"".join(bytes_a) == want == b"".join(bytes_b):
                ends_a, ends_b = (np.cumsum(list(map(len, x))).tolist() for x in (bytes_a, bytes_b))
                shared = sorted(set(ends_a) & set(ends_b))
                groups = [([], []) for _ in shared]
                for side, (ids, ends) in enumerate(((a, ends_a), (b, ends_b))):
                    for x, e in zip(ids, ends):
                        groups[bisect_left(shared, e)][side].append(str(x))
                links = [(x, y) for x, e in zip(a, ends_a) for y in [b[k] for k in [bisect_left(ends_b, e)] if k < len(b) and ends_b[k] == e]]
                counts.update(links)
                entry_ = (i, len(a), len(b), len(shared), links, ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups))
        seen.append(entry_)
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(i, a, b, g, len(links), text, sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links))
            for i, a, b, g, links, text in seen]


def test_alignment_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "SLICE", 500)  # many slices
    rng = random.Random(5)
    vocabulary = ["the", "Word", "naïve", "x,y", "12", "end.", "\n", "deux", "(a)", "'s", "--", "日本", "🙂", "internationalization"]
    texts = AWKWARD + [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 2, 40, 300]))) for _ in range(80)] + ["the Word"] * 30
    ids = [None, None, 5, 5, *range(100, 96 + len(texts))]
    got = token_alignment.align(frame(spark, texts, ids).repartition(5), BPE, PIECES).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(alignment_brute(list(zip(texts, ids))), key=key)


def test_alignment_query_on_the_small_table(spark):
    rows = [(r["text"], r["doc_id"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = entry.queries()["op13_token_alignment"](spark, SF001).collect()
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    want = [(i, a, b, g, n, digest(text), best, total) for i, a, b, g, n, text, best, total in alignment_brute(rows)]
    fields = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
    assert sorted(tuple(r[f] for f in fields) for r in got) == sorted(want)


def test_alignment_without_tokens(spark):
    assert token_alignment.align(frame(spark, []), BPE, PIECES).collect() == []
    got = token_alignment.align(frame(spark, [None, "", "▁a"]), BPE, PIECES).collect()
    assert sorted(map(tuple, got)) == [(i, 0, 0, 0, 0, "", 0, 0) for i in range(3)]
