"""Periodic runs in the word sequence of documents, found with suffix-tree LCE on Lyndon roots.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends, here with at least ``POWERS`` periods and
``LEAST`` words. Every run has a root that is the longest Lyndon word at its
start, in the order of the words or in the reverse order, so two candidates a
position are enough. A candidate of length q at word i is extended to the right
by the longest common extension (LCE) of the suffixes at i and i + q, and to
the left by that of the reversed text: depths of lowest common ancestors in two
suffix trees (Ukkonen's construction), which a range minimum over the Euler
tour of a tree answers in constant time.

Trees are built where a run can stand. In a run of period q every word but the
last q occurs again within q words, so a stretch of 3q words that do is
necessary; stretches are found for q up to 1, 2, 4, ... in array operations,
with the words around them, and a stretch that fails cannot hold a run. A text
of one repeated word is one stretch, whole.

One document is worked on by one task, in memory of some 300 bytes a word of
its longest stretch. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import PIECE, buffers, row_groups, runs as flag_runs

POWERS = 4  # periods that a run has at least
LEAST = 6  # words that a run has at least

_RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
_ARROW_RUN = pa.struct([(f.name, pa.int64()) for f in _RUN])


class SuffixTree:
    """Ukkonen's suffix tree of a list of symbols (>= 0), with constant-time LCE of two positions.

    Suffix i is leaf ``~i``; an internal node holds its children by first symbol. A symbol below all others ends the
    text, so every suffix is a leaf.
    """

    def __init__(self, text: list[int]):
        self.n = len(text) + 1
        self._build([*text, -1])
        self._tour()

    def _build(self, s: list[int]) -> None:
        kids: list[dict[int, int]] = [{}]
        begin, end, link = [0], [0], [0]  # the edge into each internal node, and its suffix link
        leaf_begin = [0] * len(s)  # the edge into each leaf, which ends with the text
        node = edge = length = 0  # the active point
        leaf = 0  # the next suffix without a leaf
        for i, c in enumerate(s):
            unlinked = 0
            while leaf <= i:
                if not length:
                    edge = i
                here, first = kids[node], s[edge]
                child = here.get(first)
                if child is None:
                    here[first] = ~leaf
                    leaf_begin[leaf] = i
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    at = leaf_begin[~child] if child < 0 else begin[child]
                    if child > 0 and length >= end[child] - at:
                        edge += end[child] - at
                        length -= end[child] - at
                        node = child
                        continue
                    if s[at + length] == c:
                        if unlinked:
                            link[unlinked] = node
                        length += 1
                        break
                    fork = len(kids)
                    kids.append({c: ~leaf, s[at + length]: child})
                    begin.append(at)
                    end.append(at + length)
                    link.append(0)
                    here[first] = fork
                    leaf_begin[leaf] = i
                    if child < 0:
                        leaf_begin[~child] = at + length
                    else:
                        begin[child] = at + length
                    if unlinked:
                        link[unlinked] = fork
                    unlinked = fork
                leaf += 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = leaf
        self._kids, self._begin, self._end = kids, begin, end

    def _tour(self) -> None:
        """Leaves in symbol order, and the least depth that the Euler tour meets between neighbouring leaves."""
        kids, begin, end = self._kids, self._begin, self._end
        depth = [0] * len(kids)
        order, valley = [], []
        low = 0
        # (node, depth of the parent that the tour comes back through; -1 for a first child)
        stack: list[tuple[int, int]] = [(0, -1)]
        while stack:
            node, back = stack.pop()
            if back >= 0:
                low = back
            if node < 0:
                order.append(~node)
                valley.append(low)
                continue
            children, d = kids[node], depth[node]
            names = sorted(children, reverse=True)
            least = names.pop()
            for name in names:
                child = children[name]
                if child > 0:
                    depth[child] = d + end[child] - begin[child]
                stack.append((child, d))
            child = children[least]
            if child > 0:
                depth[child] = d + end[child] - begin[child]
            stack.append((child, -1))
        del self._kids, self._begin, self._end
        self.rank = np.empty(self.n, dtype=np.int64)
        self.rank[np.array(order)] = np.arange(self.n)
        self._least = [np.array(valley, dtype=np.int32)]
        half = 1
        while 2 * half <= self.n:
            last = self._least[-1]
            self._least.append(np.minimum(last[:-half], last[half:]))
            half *= 2

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``i`` and ``j`` (arrays, i != j)."""
        a, b = self.rank[i], self.rank[j]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), dtype=np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            least = self._least[k]
            out[at] = np.minimum(least[lo[at]], least[hi[at] - (1 << int(k))])
        return out


def _next_beyond(rank: list[int]) -> tuple[list[int], list[int]]:
    """For each suffix the next smaller and the next greater one to its right (the last, the end, is the smallest)."""
    n = len(rank)
    smaller, greater = [n - 1] * n, [n] * n
    falling, rising = [], []
    for i, r in enumerate(rank):
        while falling and rank[falling[-1]] > r:
            smaller[falling.pop()] = i
        falling.append(i)
        while rising and rank[rising[-1]] < r:
            greater[rising.pop()] = i
        rising.append(i)
    return smaller, greater


def runs_of(symbols: list[int], powers: int = POWERS, least: int = LEAST) -> np.ndarray:
    """All runs of the sequence as rows (start, length, period), by start, then period."""
    n = len(symbols)
    if n < 2:
        return np.empty((0, 3), np.int64)
    tree = SuffixTree(symbols)
    mirror = SuffixTree(symbols[::-1])
    smaller, greater = _next_beyond(tree.rank.tolist())
    # the end mark is the least symbol in one order and the greatest in the other
    i = np.concatenate([np.arange(n), np.arange(n)])
    j = np.concatenate([np.array(smaller[:n]), np.array(greater[:n])])
    q = j - i
    fits = (j < n) & (q * powers <= n)
    i, j, q = i[fits], j[fits], q[fits]
    right = tree.lce(i, j)
    left = np.zeros(len(i), np.int64)
    inner = i > 0
    left[inner] = mirror.lce(n - i[inner], n - j[inner])
    length = left + q + right
    keep = (length >= powers * q) & (length >= least)
    found = np.stack([i - left, length, q], axis=1)[keep]
    found = np.unique(found, axis=0) if len(found) else found.reshape(0, 3)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(key: np.ndarray, bounds: np.ndarray, powers: int = POWERS, least: int = LEAST) -> np.ndarray:
    """Spans (start, end) of word positions that hold every run, each run with a word to spare on both sides.

    ``key`` is a number for every word, equal only for equal words of one document; document d holds the words
    ``bounds[d]`` to ``bounds[d + 1]``.
    """
    n = len(key)
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    gap = np.full(n, n + 1, dtype=np.int64)  # words to the next occurrence
    gap[order[again]] = order[again + 1] - order[again]
    longest = int(np.diff(bounds).max(initial=0))
    spans, top = [], 1
    while (top // 2 + 1) * powers <= longest:
        lowest = top // 2 + 1  # periods from here to top
        start, end = flag_runs(gap <= top)
        wide = end - start >= max((powers - 1) * lowest, least - top)
        spans.append(np.stack([start[wide] - 1, end[wide] + top + 1], axis=1))
        top *= 2
    if not spans or not sum(map(len, spans)):
        return np.empty((0, 2), np.int64)
    span = np.concatenate(spans)
    doc = np.searchsorted(bounds, span[:, 0] + 1, side="right") - 1
    span[:, 0] = np.maximum(span[:, 0], bounds[doc])
    span[:, 1] = np.minimum(span[:, 1], bounds[doc + 1])
    span = span[np.argsort(span[:, 0], kind="stable")]
    reach = np.maximum.accumulate(span[:, 1])
    first = np.ones(len(span), dtype=bool)
    first[1:] = span[1:, 0] >= reach[:-1]
    last = np.append(np.flatnonzero(first)[1:] - 1, len(span) - 1)
    return np.stack([span[first, 0], reach[last]], axis=1)


def _documents(texts: list[bytes], powers: int, least: int) -> Iterator[tuple]:
    """``(n_words, runs, kept)`` of each text."""
    words = [t.split() for t in texts]  # at exactly the separators of the contracts
    bounds = np.cumsum([0, *map(len, words)])
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for ws in words for w in ws), np.int64, bounds[-1])
    doc = np.repeat(np.arange(len(words)), np.diff(bounds))
    found: list[list] = [[] for _ in words]
    for lo, hi in stretches(doc * len(names) + ids, bounds, powers, least):
        rows = runs_of(ids[lo:hi].tolist(), powers, least)
        if len(rows):
            d = int(doc[lo])
            rows[:, 0] += lo - bounds[d]
            found[d].append(rows)
    for ws, some, text in zip(words, found, texts, strict=True):
        if not some:
            yield len(ws), [], b" ".join(ws)
            continue
        rows = np.concatenate(some)
        step = np.zeros(len(ws) + 1, np.int64)
        np.add.at(step, rows[:, 0] + rows[:, 2], 1)
        np.add.at(step, rows[:, 0] + rows[:, 1], -1)
        stay = np.cumsum(step[:-1]) == 0
        yield len(ws), rows.tolist(), b" ".join([w for w, s in zip(ws, stay.tolist(), strict=True) if s])


def periodic_runs(docs: DataFrame, text_col: str = "text", powers: int = POWERS, least: int = LEAST) -> DataFrame:
    """Every row of ``docs``, packed as ``row``, with ``n_words``, its ``runs``, the ``top`` run and the ``kept`` text.

    ``runs`` are (start, length, period) in words, by start, then period. ``top`` has the greatest exact
    length/period; of equal ones the smallest start, then the smallest period; it is null without a run. ``kept``
    (UTF-8) holds the words that no run covers after its first period, joined by one space.

    A null, empty or blank text has no words, no runs and an empty ``kept``. Rows are independent of each other, so
    repeated rows and null or repeated ids need no care, and columns cannot clash, being packed. An empty table
    gives an empty one. A very long text is one task's work, its memory in proportion to its longest stretch.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = buffers(batch.column("text"))
            for lo, hi in row_groups(offsets, PIECE):
                texts = [raw[offsets[r] : offsets[r + 1]].tobytes() for r in range(lo, hi)]
                n_words, all_runs, top, kept = [], [], [], []
                for n, rows, rest in _documents(texts, powers, least):
                    n_words.append(n)
                    named = [{"start": s, "length": w, "period": q} for s, w, q in rows]
                    all_runs.append(named)
                    best = min(named, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]), default=None)
                    top.append(best)
                    kept.append(rest)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(lo, hi - lo), pa.array(n_words, pa.int64()),
                        pa.array(all_runs, pa.list_(_ARROW_RUN)), pa.array(top, _ARROW_RUN), pa.array(kept, pa.binary()),
                    ],
                    names=["row", "n_words", "runs", "top", "kept"],
                )

    # the text goes once, in its own column
    rest = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*rest).alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        packed.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)),
        T.StructField("top", _RUN), T.StructField("kept", T.BinaryType()),
    ])
    return packed.mapInArrow(work, schema)
