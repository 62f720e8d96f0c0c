"""Periodic runs of words: a suffix automaton whose link tree is accessed once for each appended word.

The access of a prefix recolours the path from its state to the root with the prefix's end. Each path segment of one colour
that it meets holds the suffixes whose last occurrence ended there: with distance d to the new end and a longest suffix
of m words, the m + d words up to the new end have period d. From m >= 2 d on that is a run of three periods or more; it
begins at the first of those words, and its last sighting gives its end.

Shorter distances cannot hide a run: a suffix of two periods that occurs again nearer would have a shorter period.
The segments are the paths of a link-cut tree (splay trees), so an access costs logarithmic time on average.

Every 16 words in a run occur again inside it, one period apart. So before automata are built, words that no repeated
16 words cover are set aside, again until nothing changes. A run lies within one of the stretches that stay, and could not grow beyond
it without the next word being covered as well, so each stretch has its own automaton and the result is that of the whole text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.common import add_columns

#: A run has so many words and so many periods at least.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Any so many words of a run occur twice in it: LEAST_WORDS - q >= GRAM for q <= 8, and 2 q >= GRAM beyond.
GRAM = 16


def suffix_automaton(ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and longest length of each state, and the state of each prefix."""
    link, length, moves = [-1], [0], [{}]
    states, last = [], 0
    for w in ids:
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        moves.append({})
        p = last
        while p >= 0 and w not in moves[p]:
            moves[p][w] = new
            p = link[p]
        if p >= 0:
            q = moves[p][w]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                moves.append(moves[q].copy())
                while p >= 0 and moves[p].get(w) == q:
                    moves[p][w] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
        states.append(new)
    return link, length, states


class Paths:
    """A link-cut tree over the links: each splay tree is a path of one colour, by depth; ``up`` also holds path parents."""

    def __init__(self, link: list[int], length: list[int]):
        n = len(link)
        self.up, self.left, self.right, self.length = link[:], [-1] * n, [-1] * n, length
        #: The colour of a path stands at the root of its splay tree, and at all nodes of paths cut off from it since.
        self.end = [-1] * n
        self.waiting = [-1] * n  # colour that the children still have to take

    def _splay(self, x: int) -> None:
        up, left, right, end, waiting = self.up, self.left, self.right, self.end, self.waiting
        y = up[x]
        if waiting[x] < 0 and (y < 0 or (left[y] != x and right[y] != x)):
            return
        upper, y = [x], x
        while True:
            z = up[y]
            if z < 0 or (left[z] != y and right[z] != y):
                break
            upper.append(z)
            y = z
        for y in reversed(upper):  # colours go down before the tree turns
            c = waiting[y]
            if c >= 0:
                for z in (left[y], right[y]):
                    if z >= 0:
                        end[z] = waiting[z] = c
                waiting[y] = -1
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                self._turn(p if (left[g] == p) == (left[p] == x) else x)
            self._turn(x)

    def _turn(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            c = left[p] = right[x]
            right[x] = p
        else:
            c = right[p] = left[x]
            left[x] = p
        if c >= 0:
            up[c] = p
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        up[p], up[x] = x, g

    def access(self, state: int, now: int) -> Iterator[tuple[int, int]]:
        """Colours the path from ``state`` to the root with ``now``; yields (last end, longest length) of each segment it met."""
        below, x = -1, state
        while x >= 0:
            self._splay(x)
            if self.end[x] >= 0:
                yield self.end[x], self.length[x]
            self.right[x] = below  # the deeper part of the old path keeps its colour in a tree of its own
            below, x = x, self.up[x]
        self._splay(state)
        self.end[state] = self.waiting[state] = now


def runs_of_stretch(ids: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a word sequence, through automaton and accesses."""
    link, length, states = suffix_automaton(ids)
    paths = Paths(link, length)
    ends: dict[tuple[int, int], int] = {}
    for now, state in enumerate(states):
        for before, longest in paths.access(state, now):
            period = now - before
            if longest >= (LEAST_PERIODS - 1) * period:
                ends[before - longest + 1, period] = now
    found = ((start, end - start + 1, period) for (start, period), end in ends.items())
    return sorted((s, n, q) for s, n, q in found if n >= max(LEAST_WORDS, LEAST_PERIODS * q))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeating_stretches(hashes: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the stretches that repeated 16 words of one owner cover, until no word goes any more.

    ``owner`` numbers the texts whose words' hashes follow each other. Equal hashes of different words only keep more.
    """
    at = np.arange(len(hashes))
    group = owner.astype(np.uint64)
    while True:
        if len(at) < LEAST_WORDS:
            return []
        h = _mixed(hashes[at].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        step = 1
        while step < GRAM:
            h = h[:-step] * np.uint64(0xD6E8FEB86659FD93) + _mixed(h[step:])
            step *= 2
        whole = group[:len(h)] == group[GRAM - 1:]
        h = _mixed(h ^ _mixed(group[:len(h)] + np.uint64(1)))[whole]
        first = np.flatnonzero(whole)
        order = np.argsort(h)
        same = h[order][1:] == h[order][:-1]
        again = np.zeros(len(h), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        change = np.zeros(len(at) + 1, np.int64)
        change[first[again]] = 1  # each place once
        change[first[again] + GRAM] -= 1
        covered = change.cumsum()[:-1] > 0
        kept, old = at[covered], group[covered]
        if not len(kept):
            return []
        fresh = np.ones(len(kept), bool)
        fresh[1:] = (np.diff(kept) > 1) | (old[1:] != old[:-1])
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, len(kept)))
        enough = np.repeat(sizes >= LEAST_WORDS, sizes)
        if len(kept) == len(at) and enough.all() and len(starts) == len(np.unique(group)):
            return [(int(kept[a]), int(kept[a] + n)) for a, n in zip(starts, sizes)]
        at, group = kept[enough], (fresh.cumsum() - 1)[enough].astype(np.uint64)


def find_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each word list, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate(([0], sizes.cumsum()))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    hashes = np.fromiter(map(hash, chain.from_iterable(texts)), np.int64, int(begins[-1]))
    for a, b in repeating_stretches(hashes, np.repeat(np.arange(len(texts)), sizes)):
        doc = int(np.searchsorted(begins, a, side="right")) - 1
        shift, known = a - int(begins[doc]), {}
        ids = [known.setdefault(w, len(known)) for w in texts[doc][shift:shift + b - a]]
        found[doc] += [(s + shift, n, q) for s, n, q in runs_of_stretch(ids)]
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def repeated_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for each of ``n`` words that some run holds after its first period."""
    if not runs:
        return np.zeros(n, bool)
    change = np.zeros(n + 1, np.int64)
    for s, m, q in runs:
        change[s + q] += 1
        change[s + m] -= 1
    return change.cumsum()[:-1] > 0


def stretched(words: list[bytes], key: str | None) -> list[bytes]:
    """The words with a periodic tail for one key in ten, as its hash says; a test load for texts without runs of their own."""
    h = zlib.crc32(key.encode()) if key is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def summary(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """n_runs, the run of greatest exponent, and digests of all runs and of the words that no run repeats."""
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    if runs:
        drop = repeated_words(len(words), runs).tolist()
        words = [w for w, d in zip(words, drop) if not d]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    start, length, period = best or (None, None, None)
    return (
        len(runs), start, length, period, 1000 * length // period if best else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest(),
    )


FIELDS = [
    *(T.StructField(n, T.LongType()) for n in ("n_runs", "start", "length", "period", "exponent_milli")),
    T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType()),
]
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()  # bytes part at 0x20 and 0x09 to 0x0D only


def periodic_runs(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with ``runs``, an array of (start, length, period) by start, then period, and ``collapsed``, the text without repeats.

    Words are what stands between white space (0x20, 0x09 to 0x0D). A run is a longest stretch of words of one smallest period,
    of ``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods at least. ``collapsed`` joins the words that no run holds behind its first
    period by one blank. A null or empty text has no runs and an empty ``collapsed``. New columns replace those of the same name.
    A step narrow in Spark's sense: rows stay where they are. Memory of a task follows its longest repeating stretch.
    """

    def make():
        def work(texts):
            words = [_words(t) for t in texts]
            runs = find_runs(words)
            kept = [b" ".join([w for w, d in zip(ws, repeated_words(len(ws), rs).tolist()) if not d]).decode("utf-8", "surrogatepass") for ws, rs in zip(words, runs)]
            return [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs], kept

        return work

    return add_columns(docs, column, make, [T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])


def run_digests(docs: DataFrame, key: str = "doc_id", column: str = "text", stretch: bool = False) -> DataFrame:
    """``docs`` with the columns of ``summary``; with ``stretch`` over the words that ``stretched`` makes of each text.

    A null key stretches nothing. Otherwise as ``periodic_runs``, without its arrays and texts.
    """
    marked = docs.withColumn("_key", F.col(key).cast("string"))

    def make():
        def work(texts, keys):
            words = [_words(t) for t in texts]
            if stretch:
                words = [stretched(w, k) for w, k in zip(words, keys)]
            return list(zip(*map(summary, words, find_runs(words))))

        return work

    return add_columns(marked, [column, "_key"], make, FIELDS).drop("_key")
