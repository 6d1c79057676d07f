"""URL filtering by a trie of reversed host labels and path segments.

The rules are a list a person writes, so the trie travels to the tasks inside
the function (``MAX_RULES`` bounds its size) and each URL is decided where it is
read, without a shuffle.
"""

from __future__ import annotations

import string
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RULES = 100_000
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def parts(url: str | None) -> tuple[str, str]:
    """Host (ASCII letters lower-cased) and path; both empty without ``://``."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    end = len(rest)
    for mark in "?#":
        if (i := rest.find(mark, 0, end)) >= 0:
            end = i
    rest = rest[:end]
    slash = rest.find("/")
    if slash < 0:
        return rest.translate(_LOWER), ""
    return rest[:slash].translate(_LOWER), rest[slash:]


@dataclass
class _Segment:
    children: dict[str, _Segment] = field(default_factory=dict)
    # what begins a segment here: (text the segment must begin with, rule, verdict)
    ends: list[tuple[str, str, str]] = field(default_factory=list)


@dataclass
class _Label:
    children: dict[str, _Label] = field(default_factory=dict)
    paths: _Segment | None = None


class Trie:
    """``rules``: (verdict, host, path); the longest host + path that fits wins."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root = _Label()
        rules = list(rules)
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; the trie is broadcast and holds {MAX_RULES} at most")
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r} of {host}{path}")
            node = self.root
            for label in reversed(host.translate(_LOWER).split(".")):
                node = node.children.setdefault(label, _Label())
            if node.paths is None:
                node.paths = _Segment()
            segment = node.paths
            *inner, last = path.split("/")
            for s in inner:
                segment = segment.children.setdefault(s, _Segment())
            segment.ends.append((last, host + path, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits; a block wins a tie."""
        best: tuple[int, bool, str, str] | None = None
        node = self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.children.get(label)
            if node is None:
                break
            segment = node.paths
            for s in segments:
                if segment is None:
                    break
                for begin, rule, verdict in segment.ends:
                    if s.startswith(begin):
                        found = (len(rule), verdict == "block", rule, verdict)
                        best = max(best, found) if best else found
                segment = segment.children.get(s)
        return best and best[2:]


def _judge(trie: Trie, default: str):
    def run(batches):
        for batch in batches:
            rows = []
            for url in batch.column(1).to_pylist():
                host, path = parts(url)
                rule, verdict = trie.find(host, path) or (None, default)
                rows.append((host, path, rule, verdict))
            cols = [pa.array([r[i] for r in rows], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *cols], names=["page_id", "host", "path", "rule", "verdict"])

    return run


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``.

    A rule (verdict, host, path) fits its host and all subdomains when the URL's
    path starts with the rule's. The longest rule (host and path together) wins;
    between two of one length a block wins. Where none fits, ``rule`` is null and
    the verdict is ``default``. A null URL, an empty one and one without ``://``
    have an empty host and path, which no rule fits. Repeated rows and null
    page_ids stay as they are; other columns are not read.
    """
    ids = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    return ids.mapInArrow(
        _judge(Trie(rules), default),
        "page_id long, host string, path string, rule string, verdict string")
