"""Runs of periodic words, found by a suffix automaton with link-cut access.

The states of a text's suffix automaton form a tree by suffix links; the strings of a state
all end at the same places.  Words are appended one by one: each walks from its prefix's
state to the root and gives the whole path its own place as colour, so a path falls into
segments whose colour says where their strings ended last.  The link-cut tree keeps every
one-coloured path as one splay tree, and an access meets each segment once: few on average.

A segment with deepest string length L that ended d words earlier is a stretch of L + d words
with period d, and no smaller period would leave d the latest distance.  So every run of at
least ``exponent`` periods is met when its first ``exponent * d`` words are complete, as a
segment with L >= (exponent - 1) * d, and is then extended both ways.

Before that, word positions no run can cover are left out: in a run of period q, all words
(and all sequences of eight) behind the first q have an equal one at most q before.
Stretches of positions with near equals that are long enough for some q, widened by q, are
what the automaton reads.  This drops nothing: runs lie in such stretches as a whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 8  # words in a sequence whose equals are looked for, for periods from this on
FAR = np.iinfo(np.int64).max


class SuffixTree:
    """Suffix links of an automaton: ``parent`` and ``length`` of states from 1 (0: the root,
    as a parent none), and ``prefix``, the state of each prefix."""

    def __init__(self, codes: list[int]):
        moves: list[dict[int, int]] = [{}]
        self.parent, self.length = parent, length = [-1], [0]
        self.prefix = []
        last = 0
        for code in codes:
            state = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            parent.append(0)
            p = last
            while p >= 0 and code not in moves[p]:
                moves[p][code] = state
                p = parent[p]
            if p >= 0:
                q = moves[p][code]
                if length[q] == length[p] + 1:
                    parent[state] = q
                else:  # the shorter strings of q get a state of their own
                    copy = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    parent.append(parent[q])
                    parent[state] = parent[q] = copy
                    while p >= 0 and moves[p].get(code) == q:
                        moves[p][code] = copy
                        p = parent[p]
            self.prefix.append(state)
            last = state
        parent[0] = 0


class LastPlaces:
    """Link-cut access over a suffix tree; the colour of a path stands at its splay root."""

    def __init__(self, tree: SuffixTree):
        n = len(tree.parent)
        self._length, self._up = tree.length, list(tree.parent)
        self._left, self._right, self._colour = [0] * n, [0] * n, [-1] * n

    def _lift(self, x: int) -> None:
        """Rotate ``x`` over its parent in the same splay tree."""
        up, left, right = self._up, self._left, self._right
        p = up[x]
        g = up[p]
        if left[p] == x:
            left[p] = inner = right[x]
            right[x] = p
        else:
            right[p] = inner = left[x]
            left[x] = p
        if inner:
            up[inner] = p
        up[p], up[x] = x, g
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:  # p was the root
            self._colour[x] = self._colour[p]

    def _splay(self, x: int) -> None:
        up, left, right = self._up, self._left, self._right
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self._lift(p if (left[g] == p) == (left[p] == x) else x)
            self._lift(x)

    def access(self, state: int, place: int) -> list[tuple[int, int]]:
        """Colour the path of ``state`` with ``place``; (length, earlier place) per segment."""
        up, right, colour = self._up, self._right, self._colour
        segments, below, x = [], 0, state
        while x:
            self._splay(x)
            before = colour[x]
            if before >= 0:
                segments.append((self._length[x], before))
            if right[x]:
                colour[right[x]] = before  # deeper states keep their colour
            right[x] = below
            below, x = x, up[x]
        colour[below] = place
        return segments


def _near_equals(codes: np.ndarray) -> np.ndarray:
    """Distance from each position to the one before it with the same code."""
    order = np.argsort(codes, kind="stable")
    again = codes[order[1:]] == codes[order[:-1]]
    distance = np.full(len(codes), FAR)
    distance[order[1:][again]] = (order[1:] - order[:-1])[again]
    return distance


def _stretches(codes: np.ndarray, shortest: int, exponent: int) -> list[tuple[int, int]]:
    """Disjoint ranges of positions that hold every run whole."""
    n, found, low = len(codes), [], 1
    distance, gram = _near_equals(codes), 1
    while low * exponent <= n:
        high = 2 * low - 1  # periods low to high
        if low >= GRAM and gram == 1:
            while gram < GRAM:  # numbers of sequences twice as long
                codes = pd.factorize(codes[:-gram] * len(distance) + codes[gram:])[0]
                gram *= 2
            distance = _near_equals(codes)
        least = max(1, max(shortest - high, (exponent - 1) * low) - (gram - 1))
        edges = np.diff(np.r_[False, distance <= high, False].astype(np.int8))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        long = ends - begins >= least
        found += zip((begins[long] - high).tolist(), (ends[long] + gram - 1).tolist())
        low *= 2
    merged: list[tuple[int, int]] = []
    for begin, end in sorted(found):
        begin = max(begin, 0)
        if merged and begin <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((begin, end))
    return merged


def find_runs(words: list, shortest: int = 6, exponent: int = 4) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` of a list of words, by start, then period.

    A run is a stretch with smallest period q, at least ``shortest`` and ``exponent * q``
    words long (``exponent`` from 2), that no neighbouring word extends with that period.
    """
    n = len(words)
    if n < max(shortest, exponent):
        return []
    codes = pd.factorize(np.array([*words, None], object)[:-1])[0].astype(np.int64)
    runs, covered = set(), {}
    flat = codes.tolist()
    for begin, end in _stretches(codes, shortest, exponent):
        tree = SuffixTree(flat[begin:end])
        last = LastPlaces(tree)
        for i, state in enumerate(tree.prefix, begin):
            for length, before in last.access(state, i):
                period = i - before
                if (exponent - 1) * period > length or covered.get(period, -1) >= i:
                    continue
                first, after = before - length + 1, i + 1
                while first > 0 and flat[first - 1] == flat[first - 1 + period]:
                    first -= 1
                while after < n and flat[after] == flat[after - period]:
                    after += 1
                covered[period] = after - 1
                if after - first >= shortest:
                    runs.add((first, after - first, period))
    return sorted(runs, key=lambda run: (run[0], run[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words outside runs and in the first period of a run that no other run goes on in."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    runs: str = "runs",
    collapsed: str = "collapsed",
    shortest: int = 6,
    exponent: int = 4,
) -> DataFrame:
    """Add ``runs``, an array of ``start, length, period`` (word numbers from 0, by start and
    period), and ``collapsed``, the words that ``collapse`` leaves, joined by one space.

    Words are what ASCII white space parts.  Null, empty and blank texts have no runs and
    collapse to the empty text.  Each row counts for itself.  Other columns stay as they
    are; one that has the name of a result is replaced by it, unless it is the text itself.
    """
    if text in (runs, collapsed) or runs == collapsed:
        raise ValueError("the results need names of their own")
    rest = [f for f in docs.schema if f.name not in (runs, collapsed)]
    inputs = docs.select(*[F.col(f"`{f.name}`") for f in rest])
    at = [f.name for f in rest].index(text)
    names = [f.name for f in rest] + [runs, collapsed]
    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"
    quoted = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest]
    schema = ", ".join([*quoted, f"`{runs}` {kind}", f"`{collapsed}` string"])
    entry = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            found, left = [], []
            for value in batch.column(at):
                words = (value.as_py() or "").encode().split()
                own = find_runs(words, shortest, exponent)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                left.append(b" ".join(collapse(words, own)).decode())
            results = [pa.array(found, pa.list_(entry)), pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *results], names)

    return inputs.mapInArrow(run, schema)
