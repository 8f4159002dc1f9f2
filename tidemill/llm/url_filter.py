"""URL filter: rules for hosts and paths in a trie over reversed host labels and path segments.

The trie is built on the driver from the rules it is given, at most ``MOST_RULES`` of them, and sent to
the executors once; a url walks it from the top-level label down. The longest rule that fits decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A rule is a few hundred bytes in the trie, so that a broadcast stays below about 300 MB.
MOST_RULES = 1_000_000

_HOST = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Rule(NamedTuple):
    """``block`` or ``allow`` for a host with all its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from
    there up to ``?``, ``#`` or the end. Both empty for null and without ``://``."""
    found = _HOST.search(url or "")
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


class Trie:
    """Host labels from the last one down, then path segments; the last segment of a rule is a prefix.

    A node is a pair: the next labels or segments, and the rules that end there by their last segment's
    prefix. A host node keeps the root of its paths under the key ``None``.
    """

    def __init__(self, rules: Sequence[Rule]) -> None:
        if len(rules) > MOST_RULES:
            raise ValueError(f"{len(rules)} rules; the trie is meant for {MOST_RULES} at most")
        self.root: tuple[dict, dict] = ({}, {})
        for rule in rules:
            if rule.verdict not in ("allow", "block"):
                raise ValueError(f"{rule.verdict!r} is no verdict")
            node = self.root
            for label in reversed(rule.host.translate(_LOWER).split(".")) if rule.host else ():
                node = node[0].setdefault(label, ({}, {}))
            node = node[0].setdefault(None, ({}, {}))
            *segments, last = rule.path.split("/")
            for segment in segments:
                node = node[0].setdefault(segment, ({}, {}))
            if node[1].get(last) != "block":  # of two equal rules the blocking one counts
                node[1][last] = rule.verdict

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest rule (characters of host and path, then of the host) that fits, with its verdict."""
        best: tuple[tuple[int, int], str, str] | None = None
        labels, segments = host.split("."), path.split("/")
        node, depth = self.root, 0
        while True:
            if paths := node[0].get(None):
                name = ".".join(labels[len(labels) - depth :])
                before = ""
                for segment in segments:
                    ends = paths[1]
                    fits = (segment[:n] for n in range(min(len(segment), max(map(len, ends), default=-1)), -1, -1)) if ends else ()
                    for last in fits:
                        if last in ends:
                            size = (len(name) + len(before) + len(last), len(name))
                            if best is None or size > best[0]:
                                best = (size, name + before + last, ends[last])
                            break
                    if segment not in paths[0]:
                        break
                    paths = paths[0][segment]
                    before += segment + "/"
            if depth == len(labels) or labels[-1 - depth] not in node[0]:
                return best and best[1:]
            node, depth = node[0][labels[-1 - depth]], depth + 1


def judged(pages: DataFrame, rules: Sequence[Rule], otherwise: str = "allow", url: str = "url", key: str = "page_id") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each page.

    A rule fits its host and all subdomains if the path starts with the rule's path. ``rule`` is its host
    and path, null where none fits; then the verdict is ``otherwise``. Null urls and urls without ``://``
    have an empty host and path. An allowing and a blocking rule of the same host and path: it blocks.
    """
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [host_and_path(u) for u in batch.column("url").to_pylist()]
            found = [trie.value.match(*p) or (None, otherwise) for p in parts]
            columns = [*zip(*parts, strict=True), *zip(*found, strict=True)] or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(c, pa.string()) for c in columns)], ["key", "host", "path", "rule", "verdict"])

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    return rows.mapInArrow(walk, f"key {kind}, host string, path string, rule string, verdict string").withColumnRenamed("key", key)
