"""SentencePiece encoding by a max-plus scan, and decoding.

The best segmentation maximises the sum of its pieces' scores. Seen from one place
of the text to another that is a matrix over boundary states: a piece may reach up
to ``reach`` characters past the place where a document is cut, so M[s][t] is the
best score of the pieces that begin in a chunk when the first begins s characters
into it and the last ends t characters past it. Max-plus products of these are
associative. A giant document is cut into chunks, every chunk yields its matrix,
groups of them are multiplied, a scan gives the scores that enter each chunk, maps
from leaving to entering states are composed backwards, and then every chunk is
traced back on its own.

No piece goes on past a word's end (checked when the model is read), so within a
chunk all paths meet at word boundaries: words are segmented many at a time, the latest
remembered, and a chunk's matrix is its first and last, cut, word with a number in between.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm.tables import slices, store, texts

SPACE = "▁"
CHUNK = 65_536  # characters; a longer document is a giant one
GROUP = 64  # chunks whose matrices are multiplied together
REMEMBERED = 50_000  # words held by a worker, and as many older ones, besides those of a slice
SLICE = 500_000  # characters of text whose words are held at a time
_FEW = 32  # times the longest word; words of fewer characters together are segmented one by one
_UNKNOWN_PENALTY = 10.0
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """A model's pieces: ids, scores, and the best segmentation of stretches of text."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        self.text: list[bytes] = [b""] * n
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.text[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.score[piece], self.id[piece] = model.get_score(i), i
                self.text[i] = piece.replace(SPACE, " ").encode()
        self.unknown = min(self.score.values()) - _UNKNOWN_PENALTY
        self.reach = max(map(len, self.score))
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("a piece goes on past a word's end; such a model cannot be split at words")
        self.words: dict[str, tuple[float, bytes]] = {}
        self.older: dict[str, tuple[float, bytes]] = {}

    @cached_property
    def tree(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The pieces as a tree, numbered level by level from the root, 0.

        (letter, step, score, id): the number of every code point (0: in no piece); sorted,
        node * number of letters + letter of each step, the k-th leading to node k + 1; by
        node, the score of the piece that ends there (-inf: only the beginning of one) and its id."""
        letters = sorted(set().union(*self.score))
        letter = np.zeros(0x110000, np.int32)
        letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        node, step = {"": 0}, []
        for n in range(1, self.reach + 1):
            level = sorted((node[p[:-1]] * (len(letters) + 1) + int(letter[ord(p[-1])]), p) for p in {q[:n] for q in self.score if len(q) >= n})
            for k, p in level:
                node[p] = len(node)
                step.append(k)
        score = np.array([self.score.get(p, -np.inf) for p in node])
        return letter, np.array(step, np.int64), score, np.array([self.id.get(p, -1) for p in node], np.int32)

    def arcs(self, s: str, at: int):
        """(length, score) of the pieces that begin at ``at``, shortest first."""
        get = self.score.get
        for n in range(1, min(self.reach, len(s) - at) + 1):
            v = get(s[at:at + n])
            if v is not None:
                yield n, v
            elif n == 1:
                yield 1, self.unknown

    def forward(self, s: str, enter: dict[int, float], stop: int) -> tuple[dict[int, float], dict[int, int]]:
        """Best score of reaching every position by pieces that begin before ``stop``,
        and where the last piece began (-1: entered here). The longer piece wins ties."""
        best, back = dict(enter), dict.fromkeys(enter, -1)
        for at in range(stop):
            here = best.get(at)
            if here is None:
                continue
            for n, v in self.arcs(s, at):
                if here + v > best.get(at + n, -np.inf):
                    best[at + n], back[at + n] = here + v, at
        return best, back

    def ids(self, s: str, back: dict[int, int], end: int) -> tuple[list[int], int]:
        """Ids of the path to ``end`` and the position where it entered."""
        out: list[int] = []
        while back[end] >= 0:
            piece = s[back[end]:end]
            i = self.id.get(piece)
            out += [i] if i is not None else [self.byte[b] for b in reversed(piece.encode("utf-8", "replace"))]
            end = back[end]
        return out[::-1], end

    def word(self, w: str) -> tuple[float, bytes]:
        """Score and ids of one word."""
        best, back = self.forward(w, {0: 0.0}, len(w))
        out = self.ids(w, back, len(w))[0]
        return best[len(w)], struct.pack(f"<{len(out)}i", *out)

    def segmented(self, words: list[str]) -> list[tuple[float, bytes]]:
        """:meth:`word` of many words, none empty: a step of all their positions down the
        tree at a time, then the pieces that begin at one offset of all words at a time."""
        letter, step, score, piece = self.tree
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        code = letter[points]
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size)
        own = np.repeat(np.arange(len(words)), size)  # the word of each character
        width = int(letter.max()) + 1

        at, node = np.arange(len(code)), np.zeros(len(code), np.int64)
        begin, length, value, which = [], [], [], []
        for n in range(1, self.reach + 1):
            key = node * width + code[at + n - 1]
            k = np.minimum(np.searchsorted(step, key), len(step) - 1)
            found = step[k] == key
            if n == 1:  # a single character without a piece is unknown, and its number below 0
                lone = np.flatnonzero(~found | (score[k + 1] == -np.inf))
                begin.append(lone)
                value.append(np.full(len(lone), self.unknown))
                which.append(-1 - points[lone].astype(np.int64))
                length.append(np.ones(len(lone), np.int64))
            at, node = at[found], k[found] + 1
            hit = score[node] > -np.inf
            begin.append(at[hit])
            value.append(score[node[hit]])
            which.append(piece[node[hit]].astype(np.int64))
            length.append(np.full(len(begin[-1]), n))
            on = at + n < end[own[at]]
            at, node = at[on], node[on]
        begin, length, value, which = (np.concatenate(x) for x in (begin, length, value, which))

        offset = begin - (end - size)[own[begin]]
        order = np.argsort(offset, kind="stable")
        places = np.concatenate([[0], np.cumsum(np.bincount(offset))])
        source = (begin + own[begin])[order]  # each word has a place more than characters
        target, value = source + length[order], value[order]
        last = end + np.arange(len(words))
        best, back = np.full(len(code) + len(words), -np.inf), np.zeros(len(code) + len(words), np.int64)
        best[last - size] = 0.0
        for a, b in zip(places[:-1].tolist(), places[1:].tolist()):  # targets differ within an offset
            reached = best[source[a:b]] + value[a:b]
            better = np.flatnonzero(reached > best[target[a:b]])
            best[target[a + better]] = reached[better]
            back[target[a + better]] = a + better

        which = which[order]
        path, now, still = [], last, np.arange(len(words))
        while len(still):  # one piece back in every word
            arc = back[now]
            path.append((still, which[arc]))
            now = source[arc]
            on = now > (last - size)[still]
            now, still = now[on], still[on]
        whose = np.concatenate([p[0] for p in path[::-1]])
        ids = np.concatenate([p[1] for p in path[::-1]])[np.argsort(whose, kind="stable")]
        counts = np.bincount(whose, minlength=len(words))
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):
            spelt = [[self.byte[b] for b in chr(-1 - i).encode("utf-8", "replace")] for i in ids[unknown].tolist()]
            times = np.ones(len(ids), np.int64)
            times[unknown] = list(map(len, spelt))
            counts = np.bincount(np.repeat(np.arange(len(words)), counts), times, len(words)).astype(np.int64)
            ids = np.repeat(ids, times)
            ids[ids < 0] = np.concatenate(spelt)
        raw = ids.astype("<i4").tobytes()
        stop = 4 * np.cumsum(counts)
        return [(v, raw[a:b]) for v, a, b in zip(best[last].tolist(), (stop - 4 * counts).tolist(), stop.tolist())]

    def encode_all(self, escaped: list[str]) -> list[tuple[float, bytes]]:
        """Score and ids of escaped texts that begin and end at a word's boundary."""
        if len(self.words) > REMEMBERED:  # frequent words come back from the older ones
            self.words, self.older = {}, self.words
        known, older = self.words, self.older
        split = [_WORD.findall(s) for s in escaped]
        new = set().union(*split).difference(known)
        again = new.intersection(older)
        known.update((w, older[w]) for w in again)
        new = list(new - again)
        few = sum(map(len, new)) <= _FEW * max(map(len, new), default=0)
        known.update(zip(new, map(self.word, new) if few else self.segmented(new)))
        out = []
        for words in split:
            scores, ids = zip(*map(known.__getitem__, words)) if words else ((0.0,), ())
            out.append((0.0 + float(np.cumsum(scores)[-1]), b"".join(ids)))  # added from left to right
        for w in new:
            if len(w) > 64:
                del known[w]
        return out

    def encode(self, s: str) -> tuple[float, bytes]:
        return self.encode_all([s])[0]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.text[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text  # the space put before the text


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def escaped(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _boundaries(s: str, n: int) -> tuple[int, int] | None:
    """First and last place up to ``n`` where a word begins, if any."""
    first = next((m.start() + 1 for m in re.finditer(f"[^{SPACE}]{SPACE}", s[:n + 1])), None)
    if first is None:
        return None
    at = n
    while not (s[at:at + 1] == SPACE and s[at - 1] != SPACE):
        at -= 1
    return first, at


def transfer(model: Pieces, s: str, n: int) -> np.ndarray:
    """Matrix of the chunk ``s[:n]``; the rest of ``s`` is what follows it."""
    r = model.reach
    out = np.full((r, r), -np.inf)
    cut = _boundaries(s, n)
    if cut is None:
        for i in range(min(r, n + 1)):
            best, _ = model.forward(s, {i: 0.0}, n)
            for t in range(r):
                out[i, t] = best.get(n + t, -np.inf)
        return out
    first, last = cut
    tail, _ = model.forward(s[last:], {0: 0.0}, n - last)
    leave = np.array([tail.get(n - last + t, -np.inf) for t in range(r)])
    middle = model.encode(s[first:last])[0]
    for i in range(min(r, first + 1)):
        best, _ = model.forward(s[:first], {i: 0.0}, first)
        out[i] = best.get(first, -np.inf) + middle + leave
    return out


def trace(model: Pieces, s: str, n: int, enter: np.ndarray, leave: int) -> tuple[bytes, int]:
    """Ids of the pieces that begin in the chunk, on the best path that leaves in a
    state, and the state it entered in."""
    start = {i: float(v) for i, v in enumerate(enter) if v > -np.inf}
    cut = _boundaries(s, n)
    if cut is None:
        _, back = model.forward(s, start, n)
        if n + leave not in back:
            return b"", 0
        ids, i = model.ids(s, back, n + leave)
        return np.asarray(ids, "<i4").tobytes(), i
    first, last = cut
    _, back = model.forward(s[:first], {i: v for i, v in start.items() if i <= first}, first)
    ids, i = model.ids(s, back, first)
    _, back = model.forward(s[last:], {0: 0.0}, n - last)
    tail = model.ids(s[last:], back, n - last + leave)[0] if n - last + leave in back else []
    return np.asarray(ids, "<i4").tobytes() + model.encode(s[first:last])[1] + np.asarray(tail, "<i4").tobytes(), i


def _arrow(cols: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in cols.values()], names=list(cols))


def _short(path: str):
    def run(batches):
        model = pieces(path)
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column(1)).to_pylist(), SLICE):
                done = model.encode_all([escaped(t) for t in batch.column(1).slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([d[0] for d in done], pa.float64()), pa.array([d[1] for d in done], pa.binary())],
                    names=["doc_id", "score", "ids"])

    return run


def _split(chunk: int, path: str):
    def run(batches):
        model = pieces(path)
        for batch in batches:
            for doc, row, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                s = escaped(text)
                for k, a in enumerate(range(0, len(s), chunk)):
                    own = s[a:a + chunk]
                    yield _arrow({"doc_id": ([doc], pa.int64()), "row": ([row], pa.int64()), "chunk": ([k], pa.int64()),
                                  "size": ([len(own)], pa.int32()), "text": ([s[a:a + chunk + model.reach]], pa.string()),
                                  "last": ([a + chunk >= len(s)], pa.bool_())})

    return run


def _matrices(path: str):
    def run(batches):
        model = pieces(path)
        for batch in batches:
            out = [transfer(model, s, n).tobytes() for s, n in zip(batch.column("text").to_pylist(), batch.column("size").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), pa.array(out, pa.binary())], names=["row", "chunk", "matrix"])

    return run


def _square(raw: bytes) -> np.ndarray:
    m = np.frombuffer(raw, np.float64)
    side = int(round(len(m) ** 0.5))
    return m.reshape(side, side)


def _ordered(table: pa.Table, by: str) -> list[dict]:
    return table.sort_by(by).to_pylist()


def _multiply(table: pa.Table) -> pa.Table:
    rows = _ordered(table, "chunk")
    m = _square(rows[0]["matrix"])
    for r in rows[1:]:
        m = product(m, _square(r["matrix"]))
    return pa.table({"row": pa.array([rows[0]["row"]]), "part": pa.array([rows[0]["part"]]), "matrix": pa.array([m.tobytes()], pa.binary())})


def _scan(level: str):
    """Scores that enter each row: the product of all before it, from ``enter``."""
    def run(table: pa.Table) -> pa.Table:
        rows = _ordered(table, level)
        side = _square(rows[0]["matrix"]).shape[0]
        first = rows[0].get("enter")
        v = np.frombuffer(first, np.float64) if first else np.where(np.arange(side) == 0, 0.0, -np.inf)
        out = []
        for r in rows:
            out.append(v.tobytes())
            v = (v[:, None] + _square(r["matrix"])).max(axis=0)
        return pa.table({"row": pa.array([r["row"] for r in rows]), level: pa.array([r[level] for r in rows]), "enter": pa.array(out, pa.binary())})

    return run


def _maps(path: str):
    """For every state a chunk can be left in, the one it was entered in."""
    def run(batches):
        model = pieces(path)
        for batch in batches:
            out = []
            for s, n, enter in zip(*(batch.column(c).to_pylist() for c in ("text", "size", "enter"))):
                v = np.frombuffer(enter, np.float64)
                if _boundaries(s, n):  # every path meets at the first word: one trace tells all
                    out.append(bytes([trace(model, s, n, v, 0)[1]] * model.reach))
                else:
                    out.append(bytes([trace(model, s, n, v, t)[1] for t in range(model.reach)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), pa.array(out, pa.binary())], names=["row", "chunk", "states"])

    return run


def _leaving(table: pa.Table) -> pa.Table:
    """The state in which the best path leaves each chunk of a document."""
    rows = _ordered(table, "chunk")
    out, state = [0] * len(rows), 0
    for k in range(len(rows) - 1, -1, -1):
        out[k] = state
        state = rows[k]["states"][state]
    return pa.table({"row": pa.array([r["row"] for r in rows]), "chunk": pa.array([r["chunk"] for r in rows]), "leave": pa.array(out, pa.int32())})


def _trace(path: str):
    def run(batches):
        model = pieces(path)
        for batch in batches:
            out, score = [], []
            for s, n, enter, leave, last in zip(*(batch.column(c).to_pylist() for c in ("text", "size", "enter", "leave", "last"))):
                v = np.frombuffer(enter, np.float64)
                ids, _ = trace(model, s, n, v, leave)
                out.append(ids)
                score.append(float((v[:, None] + transfer(model, s, n)).max(axis=0)[0]) if last else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), batch.column("chunk"), pa.array(out, pa.binary()), pa.array(score, pa.float64())],
                names=["doc_id", "row", "chunk", "ids", "score"])

    return run


def _giants(long: DataFrame, path: str, chunk: int) -> DataFrame:
    spark = long.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = store(long.mapInArrow(_split(chunk, path), "doc_id long, row long, chunk long, size int, text string, last boolean")
                   .repartition(n, "row", "chunk"), "sentencepiece-chunks")
    part = F.floor(F.col("chunk") / GROUP)
    matrices = store(chunks.mapInArrow(_matrices(path), "row long, chunk long, matrix binary").withColumn("part", part), "sentencepiece-matrices")
    groups = matrices.groupBy("row", "part").applyInArrow(_multiply, "row long, part long, matrix binary")
    entered = groups.groupBy("row").applyInArrow(_scan("part"), "row long, part long, enter binary")
    inside = matrices.join(entered, ["row", "part"]).groupBy("row", "part").applyInArrow(_scan("chunk"), "row long, chunk long, enter binary")
    ready = store(chunks.join(inside, ["row", "chunk"]), "sentencepiece-entered")
    maps = ready.mapInArrow(_maps(path), "row long, chunk long, states binary")
    leaving = maps.groupBy("row").applyInArrow(_leaving, "row long, chunk long, leave int")
    traced = ready.join(leaving, ["row", "chunk"]).mapInArrow(_trace(path), "doc_id long, row long, chunk long, ids binary, score double")
    whole = traced.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"), F.max("score").alias("score"))
    return whole.select("doc_id", "score", F.aggregate("parts", F.unhex(F.lit("")), lambda x, p: F.concat(x, p["ids"])).alias("ids"))


def encode(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, score, ids (little-endian 32-bit integers) of every row.

    ``docs``: doc_id, text; other columns are not read. The ids are those of the
    segmentation with the highest sum of the model's piece scores; on a tie the
    longer last piece wins. A space is put before the text and spaces are escaped;
    characters without a piece become their bytes' pieces. A null or empty text has
    no ids and score 0. Documents of over ``chunk`` characters are cut and scanned;
    the result does not depend on ``chunk`` (at least the longest piece). Repeated
    rows each have their result; a null doc_id stays null. No rows give no rows.
    """
    if chunk < pieces(path).reach:
        raise ValueError("a chunk must hold the longest piece")
    rows = texts(docs)
    size = F.char_length("text") + 1
    short = rows.filter(size <= chunk).mapInArrow(_short(path), "doc_id long, score double, ids binary")
    long = rows.filter(size > chunk).withColumn("row", F.monotonically_increasing_id())
    return short.unionByName(_giants(long.select("doc_id", "row", "text"), path, chunk))


def _decoded(path: str):
    def run(series):
        model = pieces(path)
        for ids in series:
            for a, b in slices((len(x or b"") for x in ids), SLICE):
                yield ids.iloc[a:b].map(lambda x: model.decode(np.frombuffer(x, "<i4")) if x is not None else None)

    run.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The columns of ``encoded`` and ``decoded``, the text of its ids."""
    return encoded.withColumn("decoded", F.pandas_udf(_decoded(path), "string")(F.col("ids")))
