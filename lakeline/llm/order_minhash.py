"""Near-duplicate documents by order MinHash and banded alignment.

A document's two-word k-mers are labelled with their occurrence number, so that
repeats differ. A sketch takes the ``sample`` k-mers with the least hashes and
keeps them in text order; it is equal for two documents only if they share those
k-mers in one order, which edits spoil and mere overlap does not bring about.
Documents with an equal sketch are candidates. An alignment of their words inside
the band that the threshold allows decides.

Candidates are not paired up. Every member of a bucket is first aligned with one
of it (the pivot, another one in each quarter of the sketches; the first quarter
goes ahead); what has met in one component needs no further pairs, as only the
classes are asked for. The rest, members outside the pivot's component, is
aligned with the members of other components; in buckets where that would be many
pairs (texts that share a passage and little else), with those of them that share
one of their rarest k-mers, as all that can link do, unless that makes more pairs.
So no link between candidates is lost.
"""

from __future__ import annotations

import zlib
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm import words
from lakeline.llm.components import hooked, labels, oriented, settled
from lakeline.llm.repeats import mix
from lakeline.llm.tables import discard, shuffle_partitions, slices, store, texts

K = 2
SKETCHES = 64  # with K and SAMPLE, 0.1 % of pairs of 250 words with just SIMILARITY are missed (by formula), fewer above
SAMPLE = 3
PIVOTS = 4
CROWDED = 1_024  # pairs that a bucket may leave to be aligned; beyond, they must share a rare k-mer
SLOTS = 1 << 18  # of the k-mer frequencies by which a crowded bucket's members order their k-mers
PARTS = 64  # in which the tasks' frequencies are added up
SEEN_BITS = 1 << 23  # of the filter that tells which rare k-mers other texts show too
BLOCK = 256  # texts of one k-mer that a task compares with as many others at a time
CARRIED = 1_024  # words up to which a text goes along with each of its rare k-mers
LEFT_OUT = 128  # keys of a short text at most: 14 words at a similarity of 0.8
SIMILARITY = 0.8
_CELLS = 4_000_000  # hashes of a document ranked at a time
_REMEMBERED = 500  # texts of a task whose word counts are kept
_FEW_EDITS = 8  # edits after which texts of at most _COLUMN_WORDS go on by columns
_COLUMN_WORDS = 16_384
_PLAIN_EDITS = 48  # edits up to which the few diagonals are followed one by one

_SEEDS = np.random.default_rng(2).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) | np.uint64(1)


def labelled_kmers(tokens: np.ndarray, k: int = K) -> np.ndarray:
    """Hash of every ``k`` words in a row together with how often they came before.

    A text of fewer words is one k-mer."""
    if len(tokens) < k:
        k = max(1, len(tokens))
    n = len(tokens) - k + 1
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + tokens[i:i + n])
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    times = np.diff(np.append(first, n))
    if len(first) == n:
        return h
    label = np.empty(n, np.uint64)
    label[order] = np.arange(n) - np.repeat(first, times)
    again = label > 0  # a first occurrence has the hash it has in a text without repeats
    h[again] = mix(h[again] + label[again] * np.uint64(0xC2B2AE3D27D4EB4F))
    return h


def _places_of_least(kmers: np.ndarray, seeds: np.ndarray, take: int) -> np.ndarray:
    """Where the ``take`` k-mers that each seed ranks first are, one row a seed.

    Ranks have 32 bits: of equal ones, which only texts of very many words have among
    their least, the one that comes first in the text is taken."""
    rank = (kmers >> np.uint64(32)).astype(np.uint32) * ((seeds >> np.uint64(31)).astype(np.uint32) | np.uint32(1))[:, None]
    rank ^= rank >> np.uint32(15)
    rank *= np.uint32(0x2C1B3C6D)
    row = np.arange(len(seeds))
    at = np.empty((len(seeds), take), np.int64)
    for i in range(take):  # a few passes cost less than a selection
        at[:, i] = rank.argmin(axis=1)
        rank[row, at[:, i]] = np.uint32(0xFFFFFFFF)
    return at


def sketches(tokens: np.ndarray) -> np.ndarray:
    """One 64-bit number per sketch: the least k-mers' hashes in text order."""
    kmers = labelled_kmers(tokens)
    take = min(SAMPLE, len(kmers))
    if len(kmers) > take:
        per = max(1, _CELLS // len(kmers))  # sketches ranked at a time
        at = np.concatenate([_places_of_least(kmers, _SEEDS[i:i + per], take) for i in range(0, SKETCHES, per)])
        at.sort(axis=1)
    else:
        at = np.broadcast_to(np.arange(take), (SKETCHES, take))
    h = np.arange(1, SKETCHES + 1, dtype=np.uint64)
    for column in kmers[at].T:
        h = mix((h ^ column) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(take))
    return h


def left_out(tokens: np.ndarray, similarity: float) -> np.ndarray:
    """One 64-bit number for each way to leave out as many words as may be edited, or
    fewer; none for a text with over ``LEFT_OUT`` ways.

    Texts of n and n + m words that link by d words dropped, d + m added and s replaced
    agree when one leaves out s + d <= allowed(n), the other s + d + m <= allowed(n + m).
    """
    n = len(tokens)
    most = allowed(n, n, similarity)
    ways = 0
    for e in range(most + 1):
        ways += comb(n, e)
        if ways > LEFT_OUT:  # at once for all but short texts
            return np.zeros(0, np.uint64)
    keys = []
    for e in range(most + 1):
        stay = np.array(list(combinations(range(n), n - e)), np.int64)
        h = np.full(len(stay), n - e, np.uint64)
        for column in tokens[stay].T:
            h = mix((h ^ column) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        keys.append(h)
    return np.unique(np.concatenate(keys))


_SKETCHED = "at long, same long, content long, content2 long, n_words int, tokens binary, sketches array<long>"


def _sketch(similarity: float):
    def run(batches):
        for batch in batches:
            at, same = batch.column(0), batch.column(1)
            docs = [t.encode() for t in batch.column(2).to_pylist()]
            rows: list[tuple] = []
            for a, b in slices(map(len, docs), 4_000_000):
                data, starts, ends, bounds = words.find(docs[a:b], words.LETTERS)
                tokens = words.hashes(data, starts, ends)
                for i in range(b - a):
                    own = tokens[bounds[i]:bounds[i + 1]]
                    if not len(own):
                        rows.append((None, None, 0, None, None))
                        continue
                    place = mix(np.arange(len(own), dtype=np.uint64) + np.uint64(1))
                    content = (mix(own) * (place | np.uint64(1))).sum(dtype=np.uint64).astype(np.int64)
                    content2 = (own * (mix(place) | np.uint64(1))).sum(dtype=np.uint64).astype(np.int64)
                    rows.append((int(content), int(content2), len(own), (own >> np.uint64(32)).astype("<u4").tobytes(),
                                 np.concatenate([sketches(own), left_out(own, similarity)]).astype(np.int64)))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [at, same, *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))],
                names=["at", "same", "content", "content2", "n_words", "tokens", "sketches"])

    return run


def _mismatch_free(a: np.ndarray, b: np.ndarray):
    """Longest common extensions from many places at once, by doubling prefix hashes."""
    base = np.uint64(0x9E3779B97F4A7C15)
    n = max(len(a), len(b)) + 1
    power = np.full(n, base, np.uint64)
    power[0] = 1
    power = np.cumprod(power)

    def prefix(x):
        h = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(mix(x.astype(np.uint64) + np.uint64(7)) * power[:len(x)], out=h[1:])
        return h

    pa_, pb = prefix(a), prefix(b)

    def extend(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        room = np.minimum(len(a) - i, len(b) - j)
        done = np.zeros(len(i), np.int64)
        step = 1
        grow = room > 0
        while grow.any():  # gallop forward while whole blocks agree
            k = np.flatnonzero(grow)
            s = np.minimum(step, room[k] - done[k])
            same = _equal(pa_, pb, power, i[k] + done[k], j[k] + done[k], s)
            done[k[same]] += s[same]
            grow[k[~same]] = False
            grow &= done < room
            step *= 2
        back = step
        while back >= 1:  # then close in
            s = np.minimum(back, room - done)
            k = np.flatnonzero(s > 0)
            if len(k):
                same = _equal(pa_, pb, power, i[k] + done[k], j[k] + done[k], s[k])
                done[k[same]] += s[k][same]
            back //= 2
        return done

    return extend


def _equal(pa_, pb, power, i, j, s):
    x, y = pa_[i + s] - pa_[i], pb[j + s] - pb[j]
    low = np.minimum(i, j)
    return x * power[j - low] == y * power[i - low]


def counted(tokens: np.ndarray) -> np.ndarray:
    """A sequence as a set: every word with the number of its occurrence."""
    s = np.sort(tokens).astype(np.uint64)
    return s << np.uint64(32) | (np.arange(len(s)) - np.searchsorted(s, s)).astype(np.uint64)


def least_edits(a: np.ndarray, b: np.ndarray) -> int:
    """Edits that two sequences (as :func:`counted`) need at least: a word that one lacks needs one."""
    both = np.concatenate([a, b])
    both.sort()
    return max(len(a), len(b)) - int(np.count_nonzero(both[1:] == both[:-1]))


def _band_distance(a: list, b: list, most: int) -> int:
    """Edits between two sequences, or ``most + 1``: the band of ``most`` diagonals either
    side as bits of one number, moved down a row with every column."""
    d = len(a) - len(b)
    held: dict[int, int] = {}
    for i, word in enumerate(a):
        held[word] = held.get(word, 0) | 1 << (i + most)
    mask = (1 << (2 * most + 1)) - 1
    top = 1 << (2 * most)
    less = (1 << (most + 1)) - 1  # rows one less than the row above; before the first row distances grow upwards
    more = mask ^ less
    edits, at = abs(d), most + d  # on the diagonal that ends in the last cell
    for j, word in enumerate(b):
        more, less = more >> 1 | top, less >> 1
        equal = held.get(word, 0) >> j & mask
        same = (((equal & more) + more) ^ more | equal | less) & mask  # as the cell up and left
        right, left = (less | mask & ~(same | more)) << 1 & mask | 1, (more & same) << 1 & mask
        more, less = left | mask & ~(same | right), right & same
        if not same >> at & 1:
            edits += 1
            if edits > most:
                break
    return edits


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edits between two sequences of words, or ``most + 1`` if there are more.

    Only the band of ``most`` diagonals either side is followed: per number of
    edits, the furthest row each diagonal reaches, extended over equal words; where
    more than a few edits are needed and the texts are not huge, column by column.
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    far = [-2] * (2 * most + 3)  # furthest i on diagonal d = j - i, at most + 1 + d
    mid = most + 1
    goal = mid + m - n
    left, right = a.tolist(), b.tolist()
    raw_a, raw_b, item = a.tobytes(), b.tobytes(), a.itemsize

    def run(i: int, d: int) -> int:
        """End of the equal words from row i on along diagonal d."""
        j, step = i + d, 1
        if i >= n or j >= m or left[i] != right[j]:
            return i
        while True:  # gallop while whole blocks agree, then close in
            size = min(step, n - i, m - i - d)
            if size and raw_a[i * item:(i + size) * item] == raw_b[(i + d) * item:(i + d + size) * item]:
                i += size
                step *= 2
                continue
            step = 1 << (size - 1).bit_length() >> 1 if size > 1 else 0
            while step:
                if (i + step <= n and i + step + d <= m
                        and raw_a[i * item:(i + step) * item] == raw_b[(i + d) * item:(i + d + step) * item]):
                    i += step
                step //= 2
            return i

    far[mid] = run(0, 0)
    columns = most > _FEW_EDITS and max(n, m) <= _COLUMN_WORDS
    for edits in range(min(most, _PLAIN_EDITS) + 1):
        if far[goal] >= n:
            return edits
        if edits == most:
            return most + 1
        if columns and edits == _FEW_EDITS:
            return _band_distance(left, right, most)
        old = far[:]
        for d in range(max(-edits - 1, -n), min(edits + 1, m) + 1):
            at = mid + d
            i = max(old[at] + 1, old[at - 1] if at else -2, old[at + 1] + 1 if at + 1 < len(old) else -2)  # replace, take from b, drop from a
            i = min(i, n, m - d)
            if i >= 0 and i + d >= 0:
                far[at] = run(i, d)
    extend = _mismatch_free(a, b)
    far = np.array(far)
    for edits in range(_PLAIN_EDITS + 1, most + 1):
        if far[goal] >= n:
            return edits
        if edits == most:
            break
        d = np.arange(-edits - 1, edits + 2)
        d = d[(d >= -n) & (d <= m)]
        at = d + mid
        prior = np.concatenate([[-2], far, [-2]])
        i = np.maximum(np.maximum(prior[at + 1] + 1, prior[at + 2] + 1), prior[at])
        i = np.minimum(i, np.minimum(n, m - d))
        ok = (i >= 0) & (i + d >= 0)
        i, at, d = i[ok], at[ok], d[ok]
        far[at] = i + extend(i, i + d)
    return most + 1


def allowed(n: int, m: int, similarity: float) -> int:
    """Edits with which 1 - edits / longer length is still ``similarity``."""
    return int((1 - similarity) * max(n, m) + 1e-9)


def _align(similarity: float):
    def run(batches):
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def text(key: int, raw: bytes):
            if key not in known:
                if len(known) >= _REMEMBERED:
                    known.clear()
                tokens = np.frombuffer(raw, "<u4")
                known[key] = tokens, counted(tokens)
            return known[key]

        for batch in batches:
            ok = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x, y = text(a, x), text(b, y)
                most = allowed(len(x[0]), len(y[0]), similarity)
                ok.append(least_edits(x[1], y[1]) <= most and edit_distance(x[0], y[0], most) <= most)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _verified(pairs: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that align. The pivot's words come first: its rows may be many."""
    b = reps.select(F.col("rep").alias("b"), F.col("tokens").alias("tokens_b"))
    a = reps.select(F.col("rep").alias("a"), F.col("tokens").alias("tokens_a"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "tokens_a", "tokens_b").mapInArrow(_align(similarity), "a long, b long")


def _kmers_of(tokens: bytes) -> np.ndarray:
    return labelled_kmers(np.frombuffer(tokens, "<u4").astype(np.uint64))


def _frequencies(batches):
    """How many k-mers of the task's texts each slot has, a row for each of the ``PARTS``."""
    held = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for tokens in batch.column("tokens").to_pylist():
            held += np.bincount((_kmers_of(tokens) % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
    packed = [zlib.compress(part.tobytes(), 1) for part in np.split(held, PARTS)]  # mostly zeros
    yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(packed, pa.binary())], names=["part", "held"])


def _summed(table: pa.Table) -> pa.Table:
    held = sum(np.frombuffer(zlib.decompress(p), np.int64) for p in table.column("held").to_pylist())
    return pa.table({"part": table.column("part").slice(0, 1), "held": pa.array([held.tobytes()], pa.binary())})


def needed(n: int, similarity: float) -> int:
    """How many of its k-mers, the rarest first, a text of ``n`` words has to show.

    Texts that link by e edits share all but K * e of the longer one's k-mers, so if all
    order k-mers alike, each has one of the shared ones among so many."""
    return max(1, n - K + 1) - max(1, int((1 - K * (1 - similarity)) * n - 1e-9) - K) + 1


def _rarest(frequency: np.ndarray, similarity: float, seen: np.ndarray | None = None):
    """Rows (kmer, before, component) of each text's rarest k-mers, ``before`` being the next
    rarer one (a number of the text's own for the first). With ``seen``, a bit set of k-mers,
    only of those in it, and with the text's own columns; its tokens only up to ``CARRIED``
    words, as a longer text has as many more k-mers to go with."""
    def run(batches):
        for batch in batches:
            for i, tokens in enumerate(batch.column("tokens").to_pylist()):
                kmers = _kmers_of(tokens)
                order = np.lexsort((kmers, frequency[(kmers % np.uint64(SLOTS)).astype(np.int64)]))
                first = kmers[order[:needed(len(tokens) // 4, similarity)]]
                row = batch.slice(i, 1)
                own = mix(np.array(row.column("rep").to_pylist(), np.int64).astype(np.uint64) + np.uint64(1))
                pair = np.stack([first, np.concatenate([own, first[:-1]])]).astype(np.int64)
                if seen is None:
                    component = row.column("component").take(pa.array(np.zeros(pair.shape[1], np.int64)))
                    yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in pair), component], names=["kmer", "before", "component"])
                    continue
                bit = first % np.uint64(SEEN_BITS)
                pair = pair[:, (seen[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)]
                again = pa.array(np.zeros(pair.shape[1], np.int64))
                own_columns = ["rep", "n_words", "component"]
                carried = pa.nulls(pair.shape[1], pa.binary()) if len(tokens) > 4 * CARRIED else row.column("tokens").take(again)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x) for x in pair), *(row.column(c).take(again) for c in own_columns), carried],
                    names=["kmer", "before", *own_columns, "tokens"])

    return run


def _bits_of(kmers: DataFrame) -> np.ndarray:
    """The bit set of the k-mers by their last bits; SEEN_BITS / 64 rows are collected at most."""
    bit = F.pmod(F.col("kmer"), F.lit(SEEN_BITS))  # as the unsigned remainder: SEEN_BITS divides 2 ** 64
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    held = kmers.select(F.shiftright(bit, 6).alias("word"), one.alias("b")).groupBy("word").agg(F.bit_or("b").alias("b")).collect()
    seen = np.zeros(SEEN_BITS // 64, np.uint64)
    for r in held:
        seen[r["word"]] = np.int64(r["b"]).astype(np.uint64)
    return seen


def _linked_within(similarity: float):
    """Links (a, b) between the texts of block x and of block y of one k-mer; of texts that
    links found here connect already, no more are looked for. Pairs with a text whose tokens
    did not come along are not ``aligned`` yet."""
    def run(key, table):
        x, y = key[1].as_py(), key[2].as_py()
        rep, before, block, size = (table.column(c).to_numpy() for c in ("rep", "before", "block", "n_words"))
        group = table.column("component").to_numpy().copy()
        tokens = [None if t is None else np.frombuffer(t, "<u4") for t in table.column("tokens").to_pylist()]
        sets: dict[int, np.ndarray] = {}

        def words_of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = counted(tokens[i])
            return sets[i]

        links = []
        at = np.arange(len(rep))
        for i in np.flatnonzero(block == x):
            open_ = (block == y) & (before != before[i])
            open_ &= np.minimum(size, size[i]) >= similarity * np.maximum(size, size[i]) - 1e-9
            if x == y:
                open_ &= at > i
            for j in np.flatnonzero(open_ & (group != group[i])):
                if group[j] == group[i]:
                    continue
                if tokens[i] is None or tokens[j] is None:
                    links.append((min(rep[i], rep[j]), max(rep[i], rep[j]), 0))
                    continue
                most = allowed(int(size[i]), int(size[j]), similarity)
                if least_edits(words_of(i), words_of(j)) <= most and edit_distance(tokens[i], tokens[j], most) <= most:
                    links.append((min(rep[i], rep[j]), max(rep[i], rep[j]), 1))
                    group[group == group[j]] = group[i]
        found = np.array(links, np.int64).reshape(-1, 3)
        return pa.table({"a": found[:, 0], "b": found[:, 1], "aligned": found[:, 2].astype(bool)})

    return run


def _links_by_rare_kmers(crowd: DataFrame, similarity: float, most: int) -> DataFrame | None:
    """Links (a, b) that join all texts of different components that link, found among those
    that share a k-mer among each one's rarest; all that can link do. None if they meet more
    than ``most`` times, as they do where few words make up all texts.

    ``crowd``: rep, n_words, component, tokens. A passage that many texts share is common
    to all of them and so is mostly not what they meet by. Where it is, texts that hold the
    same k-mer next before (in the order by rarity) share that one too, so only texts with
    different ones need to meet here: they have no earlier k-mer in common, or meet there again.
    K-mers that only one component's texts show (copies that are joined already) join nothing.

    The texts of a k-mer with over ``BLOCK`` of them are dealt into blocks, those with the
    commonest ``before`` (which need no comparison among themselves) apart from the others,
    and each pair of blocks is one group. Pairs are compared where they meet: only links leave the task.
    Texts of over ``CARRIED`` words do not go there themselves; each pair that they meet in is aligned once, after.
    """
    # in turn, as by hash some tasks have twice as many; read from files it would lie in few tasks
    spread = crowd.repartition(shuffle_partitions(crowd.sparkSession))
    totals = spread.mapInArrow(_frequencies, "part int, held binary").groupBy("part").applyInArrow(_summed, "part int, held binary")
    frequency = np.zeros((PARTS, SLOTS // PARTS), np.int64)
    for r in totals.collect():
        frequency[r["part"]] = np.frombuffer(r["held"], np.int64)
    frequency = frequency.reshape(-1)
    sides = spread.mapInArrow(_rarest(frequency, similarity), "kmer long, before long, component long") \
        .groupBy("kmer", "before").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    shared = store(
        sides.groupBy("kmer").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"), F.count("*").alias("sides"),
                                  F.max(F.struct("n", "before")).alias("major"), F.min("low").alias("low"), F.max("high").alias("high"))
        .filter("sides > 1 and low < high")
        .select("kmer", "n", "own", F.col("major.n").alias("n_major"), F.col("major.before").alias("major")), "order-minhash-shared")
    if (shared.agg(F.sum(F.col("n") * F.col("n") - F.col("own"))).first()[0] or 0) > 2 * most:
        discard(shared)
        return None
    rows = spread.mapInArrow(_rarest(frequency, similarity, _bits_of(shared.select("kmer"))),
                             "kmer long, before long, rep long, n_words int, component long, tokens binary").join(shared, "kmer")
    whole = F.col("n") <= BLOCK
    majors = F.ceil(F.col("n_major") / BLOCK).cast("int")
    minors = F.ceil((F.col("n") - F.col("n_major")) / BLOCK).cast("int")
    dealt = F.xxhash64("rep")
    of_major = ~whole & (F.col("before") == F.col("major"))
    block = F.when(whole, 0).when(of_major, minors + F.pmod(dealt, majors)).otherwise(F.pmod(dealt, minors)).cast("int")
    others = F.when(whole, F.array(F.lit(0))).when(of_major, F.sequence(F.lit(0), minors - 1)).otherwise(F.sequence(F.lit(0), minors + majors - 1))
    meetings = rows.withColumn("block", block).withColumn("other", F.explode(others)) \
        .select("kmer", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                "block", "before", "rep", "n_words", "component", "tokens")
    met = store(meetings.groupBy("kmer", "x", "y").applyInArrow(_linked_within(similarity), "a long, b long, aligned boolean"),
                "order-minhash-met")
    discard(shared)
    links, unread = met.filter("aligned").select("a", "b"), met.filter("not aligned").select("a", "b")
    return links if unread.isEmpty() else links.unionByName(_verified(unread.distinct(), crowd, similarity))


# scripts that are written without spaces: each of their characters is a word
_UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"
_MARKS = r"[\p{Z}\p{P}\p{S}&&[^\x00-\x7F]]"  # spaces, punctuation and symbols beyond ASCII


def _worded(text: Column) -> Column:
    """Lower case, with blanks wherever a word ends that :data:`words.LETTERS` would not see."""
    low = F.lower(text)
    spaced = F.regexp_replace(F.regexp_replace(low, _MARKS, " "), _UNSPACED, " $1 ")
    # most texts hold ASCII and accented Latin letters only: one cheap look tells
    return F.when((F.octet_length(low) != F.char_length(low)) & low.rlike(r"[\x{80}-\x{BF}\x{250}-\x{10FFFF}]"), spaced).otherwise(low)


def _word_and_bit() -> tuple[Column, Column]:
    return F.shiftright("rep", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("rep") % 64).cast("int"))


def _bits(wanted: DataFrame) -> DataFrame:
    """word, bits: a bit for each ``rep`` in ``wanted``, 64 in a row."""
    word, one = _word_and_bit()
    return wanted.select(word, one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def _marked(texts_: DataFrame, bits: DataFrame) -> DataFrame:
    """The texts whose ``rep`` has its bit in ``bits``, which are broadcast."""
    word, one = _word_and_bit()
    return texts_.withColumn("word", word).join(F.broadcast(bits), "word").filter(F.col("bits").bitwiseAND(one) != 0).drop("word", "bits")


def _only(texts_: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts whose ``rep`` is in ``wanted``, found where they lie: a bit for each text
    is broadcast, as the words need not be shuffled for that."""
    return _marked(texts_, _bits(wanted))


def _classed(docs: DataFrame, similarity: float) -> DataFrame:
    """at (doc_id), same (hash of the text), n_words, component and class of every row;
    the last two are null for wordless texts."""
    worded = texts(docs).select(F.col("doc_id").alias("at"), F.xxhash64("text").alias("same"), _worded(F.col("text")).alias("text"))
    sketched = store(worded.mapInArrow(_sketch(similarity), _SKETCHED).withColumn("rep", F.monotonically_increasing_id()), "order-minhash")
    same = ["content", "content2", "n_words"]
    rows = store(sketched.select("at", "same", *same), "order-minhash-rows")  # all that is needed of each row in the end
    # one node per different text: the first of its rows, told by numbers alone and read where it lies
    firsts = store(
        sketched.filter("n_words > 0").groupBy(*same).agg(F.min("at").alias("first"), F.min("rep").alias("rep")), "order-minhash-texts")
    chosen = store(_bits(firsts), "order-minhash-chosen")
    reps = _marked(sketched.select("rep", "n_words", "tokens", "sketches"), chosen)
    # dealt out by bucket once, for the bucket's pivot and for the members that join it
    member = reps.select("rep", "n_words", F.posexplode("sketches").alias("sketch", "bucket")) \
        .withColumn("sketch", F.least("sketch", F.lit(SKETCHES))) \
        .repartition("sketch", "bucket")  # keys of short texts meet wherever they stand
    order = F.struct(F.xxhash64("rep", (F.col("sketch") % PIVOTS)), "rep", "n_words")
    buckets = member.groupBy("sketch", "bucket").agg(F.count("*").alias("n"), F.min(order).alias("p")).filter("n > 1") \
        .select("sketch", "bucket", F.col("p.rep").alias("pivot"), F.col("p.n_words").alias("pivot_words"))
    shared = store(member.join(buckets, ["sketch", "bucket"]), "order-minhash-buckets")
    near = lambda x, y: F.least(x, y) >= similarity * F.greatest(x, y) - 1e-9
    stars = shared.filter("rep != pivot").filter(near("n_words", "pivot_words"))

    def tried(pairs: DataFrame, reps: DataFrame) -> DataFrame:
        return store(_verified(pairs.distinct(), reps, similarity), "order-minhash-links")

    def joined(edges: DataFrame, links: DataFrame) -> DataFrame:
        return oriented(edges.toDF("a", "b").unionByName(links))

    def known(rows: DataFrame) -> DataFrame:
        """``rows`` with the components that their members and pivots are in so far."""
        return rows.join(found.withColumnRenamed("node", "rep"), "rep", "left") \
            .join(found.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_component")), "pivot", "left") \
            .withColumn("component", F.coalesce("component", "rep")) \
            .withColumn("pivot_component", F.coalesce("pivot_component", "pivot"))

    pair = F.col("rep").alias("a"), F.col("pivot").alias("b")
    # a quarter joins most of what belongs together; what two rounds of hooking do not see as joined is only compared once more
    edges = hooked(hooked(oriented(tried(stars.filter(F.col("sketch") % PIVOTS == 0).select(*pair), reps))))
    found = labels(edges)
    edges = hooked(joined(edges, tried(known(stars).filter("component != pivot_component").select(*pair), reps)))
    found = labels(edges)
    whole = Window.partitionBy("sketch", "bucket")  # it holds its pivot, whose component needs no join of its own
    open_ = store(
        shared.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        .withColumn("pivot_component", F.max(F.when(F.col("rep") == F.col("pivot"), F.col("component"))).over(whole))
        .withColumn("members", F.count("*").over(whole))
        .withColumn("apart", F.count_if(F.col("component") != F.col("pivot_component")).over(whole)).filter("apart > 0")
        .withColumn("crowded", F.col("members") * F.col("apart") > CROWDED), "order-minhash-open")
    left = store(_only(sketched.select("rep", "tokens"), open_), "order-minhash-left")  # mostly few
    discard(shared, sketched, chosen)
    crowd = open_.filter("crowded").select("rep", "n_words", "component").distinct()
    met = None
    if not crowd.isEmpty():
        pairs = open_.filter("crowded and component != pivot_component").agg(F.sum("members")).first()[0] or 0
        met = _links_by_rare_kmers(store(crowd.join(_only(left, crowd), "rep"), "order-minhash-crowd"), similarity, pairs)
    few = open_.filter("not crowded") if met is not None else open_
    apart = few.filter("component != pivot_component").alias("y")
    rest = apart.join(few.alias("x"), ["sketch", "bucket"]).filter(
        (F.col("x.component") != F.col("y.component")) & near(F.col("x.n_words"), F.col("y.n_words"))
        & (F.col("x.rep") != F.col("y.pivot"))
        & ((F.col("x.component") == F.col("y.pivot_component")) | (F.col("x.rep") < F.col("y.rep")))
    ).select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b"))
    more = tried(rest, left) if met is None else tried(rest, left).unionByName(met)
    discard(left)
    found = settled(joined(edges, more))
    placed = firsts.join(found.withColumnRenamed("node", "rep"), "rep", "left") \
        .select(*same, "first", F.coalesce("component", "rep").alias("component"))
    least = placed.groupBy("component").agg(F.min("first").alias("class"))
    classes = placed.join(least, "component").select(*same, "component", "class")
    return rows.join(classes, same, "left")


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the near-duplicates), n_words of every row.

    ``docs``: doc_id, text; other columns are not read, whatever their names. Words are
    runs of letters, digits and underscores in lower case; each character of a script
    without spaces is a word. Two documents link when an
    alignment of their words needs at most (1 - similarity) of the longer one's length
    in edits; linked documents, and those linked through others, form a class. A null,
    empty or wordless text is in a class of its own, whose class_id is its doc_id. Texts
    with equal words always share a class, however short. Different texts are compared
    each on its own, also where they share a doc_id or have none: rows that repeat a
    doc_id with another text can be in another class. A null doc_id stays null and is
    no class_id unless the class has no other. No rows give no rows.
    """
    return _classed(docs, similarity).select(
        F.col("at").alias("doc_id"), F.when(F.col("n_words") > 0, F.col("class")).otherwise(F.col("at")).alias("class_id"), "n_words")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each class, all columns as they were.

    It is one with the smallest doc_id (a row without one only if no other is there).
    Rows go by doc_id and text together, so of two texts under one doc_id each is judged
    by its own class, and a row that repeats both is there once, whichever of them.
    Rows with a null, empty or wordless text stay, but once where both repeat.
    """
    rows = store(_classed(docs, similarity), "order-minhash-classes")
    key = F.struct(F.col("at").isNull(), F.col("at"), F.col("same"))
    best = rows.filter("component is not null").groupBy("component").agg(F.min(key).alias("best"))
    # ids that go: keys that are not their class's best, and all keys that repeat (one row of those comes back)
    later = rows.join(best, "component").filter(key != F.col("best")).select("at", "same")
    repeated = store(rows.groupBy("at", "same").agg(F.count("*").alias("n")).filter("n > 1").select("at", "same"), "order-minhash-repeated")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col("doc_id").cast("long").alias("at"), F.xxhash64(text).alias("same"))

    def equal(x: str, y: str):
        return F.col(f"{x}.at").eqNullSafe(F.col(f"{y}.at")) & (F.col(f"{x}.same") == F.col(f"{y}.same"))

    def without(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.alias("x").join(right.distinct().alias("y"), equal("x", "y"), "left_anti")

    kept = without(source, later.unionByName(repeated)).select("row.*")
    if not repeated.isEmpty():
        chosen = without(repeated, later)
        again = source.alias("x").join(chosen.alias("y"), equal("x", "y"), "left_semi")
        kept = kept.unionByName(again.groupBy("at", "same").agg(F.any_value("row").alias("row")).select("row.*"))
    return kept
