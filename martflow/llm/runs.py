"""Periodic runs in the word sequences of texts.

A run is a stretch of consecutive words with smallest period q and at least
``MIN_LENGTH`` words and ``MIN_PERIODS`` periods that can't be made longer on
either side.  Runs are found with a suffix automaton whose suffix links form
a link-cut forest: each word appended accesses the path from its prefix to
the root.  The path falls into segments whose suffixes last ended at the same
word; where that lies d words back and the segment's longest suffix has L >=
d words, the last L + d words have period d, and hold a square.  As no later
end exists, d is their smallest period, and as L is the longest, they can't
be extended to the left; the last word that reports the same start and period
ends the run.

Only stretches that can hold a run are given to the automaton: each of a
run's three-word windows occurs in it three times at least, so windows that
are rarer in their stretch cut it, until nothing is cut any more.  No word of
a run is lost by that, and hashes that collide only leave a stretch longer.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martflow.llm.textops import SubstringHash, U64, chunks, fill_text, mix, word_spans

MIN_LENGTH = 6
MIN_PERIODS = 4
WINDOW, TIMES = 3, 3         # every window of a run, and how often it occurs in the run at least

_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False


class Automaton:
    """Suffix automaton of a sequence of word numbers.  State 0 is the root;
    ``length``, ``link`` per state, ``ends``: the state of every prefix.
    Most states have one transition: those lie in two arrays, and only
    branching states have a dict."""

    def __init__(self, words: list[int]):
        self.length, self.link, self.ends = array("i", [0]), array("i", [-1]), array("i")
        length, link = self.length, self.link
        only_word, only_state = array("i", [-1]), array("i", [0])
        branches: dict[int, dict[int, int]] = {}

        def target(state: int, word: int) -> int:
            """The state after ``word``; 0 if there is none."""
            if only_word[state] == word:
                return only_state[state]
            return branches[state].get(word, 0) if state in branches else 0

        def point(state: int, word: int, to: int) -> None:
            if only_word[state] in (-1, word):
                only_word[state], only_state[state] = word, to
            else:
                branches.setdefault(state, {})[word] = to

        def new(n: int, to: int) -> int:
            length.append(n)
            link.append(to)
            only_word.append(-1)
            only_state.append(0)
            return len(length) - 1

        last = 0
        for w in words:
            state, p = new(length[last] + 1, 0), last
            q = 0
            while p >= 0:
                q = target(p, w)
                if q:
                    break
                point(p, w, state)
                p = link[p]
            if p >= 0:
                if length[q] != length[p] + 1:
                    clone = new(length[p] + 1, link[q])
                    only_word[clone], only_state[clone] = only_word[q], only_state[q]
                    if q in branches:
                        branches[clone] = branches[q].copy()
                    while p >= 0 and target(p, w) == q:
                        point(p, w, clone)
                        p = link[p]
                    link[q] = clone
                    q = clone
                link[state] = q
            last = state
            self.ends.append(state)


class LinkCutForest:
    """Preferred paths of a rooted forest as splay trees ordered by depth.

    ``colour`` is kept at the root of each splay tree and holds for the whole
    path.  Node 0 stands for "none"."""

    def __init__(self, parents: array):
        self.parent = array("i", parents)
        self.left, self.right = (array("i", bytes(4 * len(parents))) for _ in range(2))
        self.colour = array("i", bytes(4 * len(parents)))

    def _rotate(self, u: int, p: int) -> None:
        parent, left, right = self.parent, self.left, self.right
        g = parent[p]
        if left[p] == u:
            b = left[p] = right[u]
            right[u] = p
        else:
            b = right[p] = left[u]
            left[u] = p
        if b:
            parent[b] = p
        parent[p], parent[u] = u, g
        if g and left[g] == p:
            left[g] = u
        elif g and right[g] == p:
            right[g] = u
        else:
            self.colour[u] = self.colour[p]  # p was the root

    def splay(self, u: int) -> None:
        parent, left, right = self.parent, self.left, self.right
        while True:
            p = parent[u]
            if not p or (left[p] != u and right[p] != u):
                return
            g = parent[p]
            if g and left[g] == p:
                self._rotate(*((p, g) if left[p] == u else (u, p)))
                p = parent[u]
            elif g and right[g] == p:
                self._rotate(*((p, g) if right[p] == u else (u, p)))
                p = parent[u]
            self._rotate(u, p)

    def access(self, v: int, colour: int) -> Iterator[tuple[int, int]]:
        """Makes the path from ``v`` to its root one preferred path of
        ``colour``; yields (deepest node, colour so far) of each segment."""
        below, u = 0, v
        while u:
            self.splay(u)
            old = self.colour[u]
            yield u, old
            cut = self.right[u]
            if cut:
                self.colour[cut] = old  # a path of its own from now on
            self.right[u] = below
            below, u = u, self.parent[u]
        self.colour[below] = colour


def runs_of(words: list[int], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start and period."""
    automaton = Automaton(words)
    link, length = automaton.link, automaton.length
    link[0] = 0
    forest = LinkCutForest(link)
    found: dict[tuple[int, int], int] = {}
    for end, state in enumerate(automaton.ends, 1):
        for node, before in forest.access(state, end):
            distance, longest = end - before, length[node]
            # a square, and with the periods that a run needs so far
            if before and distance <= longest and longest >= (min_periods - 1) * distance:
                found[end - distance - longest, distance] = end
    return sorted((start, end - start, period) for (start, period), end in found.items() if end - start >= min_length)


def stretches(words: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """(word, word after the last) of the stretches that can hold runs; ``words``
    are hashes, ``first`` the index of each row's first word."""
    n = len(words)
    if n < MIN_LENGTH:
        return []
    step = U64(0x9E3779B97F4A7C15)
    window = mix(mix(words[:-2] * step + words[1:-1]) * step + words[2:])
    at = np.arange(n - 2)
    inside = np.ones(n - 2, dtype=bool)
    for back in (1, 2):  # windows don't cross rows
        edges = first[1:-1] - back
        inside[edges[(edges >= 0) & (edges < n - 2)]] = False
    at, before = at[inside], -1
    while len(at) != before:
        before = len(at)
        # consecutive windows are one stretch
        stretch = np.cumsum(np.diff(at, prepend=-2) != 1)
        long_enough = np.bincount(stretch)[stretch] >= MIN_LENGTH - WINDOW + 1
        at, stretch = at[long_enough], stretch[long_enough]
        if not len(at):
            return []
        _, which, times = np.unique(mix(window[at] + stretch.astype(U64) * step), return_inverse=True, return_counts=True)
        at = at[times[which] >= TIMES]
    starts = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    ends = np.append(starts[1:], len(at)) - 1
    return list(zip(at[starts].tolist(), (at[ends] + WINDOW).tolist()))


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for b in batches:
        texts = fill_text(b.column(1))
        for lo, hi, data, offsets in chunks(texts):
            starts, ends, first = word_spans(_WORD[data], offsets)
            hashes = SubstringHash(data).of(starts, ends)
            raw = data.tobytes()
            runs: list[list[tuple[int, int, int]]] = [[] for _ in range(hi - lo)]
            for a, e in stretches(hashes, first):
                numbers: dict[bytes, int] = {}
                sequence = [numbers.setdefault(raw[s:t], len(numbers)) for s, t in zip(starts[a:e].tolist(), ends[a:e].tolist())]
                row = int(np.searchsorted(first, a, side="right")) - 1
                base = a - int(first[row])
                runs[row] += [(base + s, n, q) for s, n, q in runs_of(sequence)]
            collapsed = []
            for row, (a, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                words = raw[a:e].split()
                if runs[row]:
                    keep = np.ones(len(words), dtype=bool)
                    for s, n, q in runs[row]:
                        keep[s + q:s + n] = False
                    words = [words[i] for i in np.flatnonzero(keep)]
                collapsed.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([
                b.column(0).slice(lo, hi - lo), pa.array(np.diff(first)),
                pa.array([[dict(zip(("start", "length", "period"), x)) for x in sorted(r, key=lambda x: (x[0], x[2]))] for r in runs], pa.list_(run)),
                pa.array(collapsed, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of ``docs``.

    Words are what lies between ASCII blanks, numbered from 0; ``runs`` has
    (start, length, period) by start and period; ``collapsed`` is the text's
    words joined by one blank, without those that a run holds after its first
    period.  Null and blank texts have no words, no runs and an empty
    ``collapsed``; null and repeated ids change nothing, every row comes back
    once; an empty table gives an empty result; other columns aren't read.
    Texts are taken one by one, nothing is shuffled.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_found, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (id, text) in which one id in ten, by the CRC-32 of its digits,
    repeats a stretch of its words up to the text's end: with g the CRC's
    other digits, from word a = g % n on in periods of
    1 + (n - a) div (3 + g % 8) words.  Other rows, null ids and texts
    without words stay as they are."""
    mark = F.crc32(F.col(id_col).cast("long").cast("string").cast("binary"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), mark.alias("mark"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    rows = rows.withColumn("words", F.when((F.col("mark") % 10 == 0) & F.col("text").isNotNull(), words))
    rows = rows.withColumn("n", F.size("words")).withColumn("g", F.expr("mark div 10"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)")))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    planted = F.expr("concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), cast(3 + g % 8 as int))), 1, n - a))")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))
