"""Benchmark decontamination by a generalised suffix automaton of the benchmark's items.

Training words stream through the automaton, which knows at each word the longest match that ends there. A match
of ten words, or of a whole shorter item, marks its words as hit. Hit spans are cut out of the text, and a text
that is hit for more than a given share goes as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.common import add_columns

#: Words of a window.
WINDOW = 10
#: Words of benchmark text in one automaton, unless a single item is longer; more items make more automata.
BLOCK_WORDS = 100_000

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: A-Z to a-z, what parts words to a blank.
TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TO_WORDS).split() if text else []


class SuffixAutomaton:
    """Suffix automaton of several word sequences, with the items that each window and short item belongs to."""

    def __init__(self, items: Iterable[tuple], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.size, self.link, self.step = [0], [-1], [{}]
        entered = []
        for item, text in items:
            words = [self.ids.setdefault(w, len(self.ids)) for w in words_of(text)]
            if words:
                entered.append((item, words))
                last = 0
                for w in words:
                    last = self._extend(last, w)
        self.least = min([window, *(len(w) for _, w in entered)])
        self._mark(entered)

    def _new(self, size: int, link: int, step: dict) -> int:
        self.size.append(size)
        self.link.append(link)
        self.step.append(step)
        return len(self.size) - 1

    def _extend(self, last: int, w: int) -> int:
        """State of the sequence so far with one more word; states of earlier sequences are used again."""
        step, size, link = self.step, self.size, self.link
        if w in step[last]:
            q = step[last][w]
            return q if size[q] == size[last] + 1 else self._clone(last, w, q)
        new = self._new(size[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            q = step[p][w]
            link[new] = q if size[q] == size[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._new(self.size[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = copy
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = copy
            p = self.link[p]
        return copy

    def _holder(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of a match in ``state``."""
        while self.size[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _mark(self, entered: list) -> None:
        states = len(self.size)
        self.windows: dict[int, set] = {}
        self.short: dict[int, dict[int, set]] = {}
        for item, words in entered:
            state = 0
            for i, w in enumerate(words, 1):
                state = self.step[state][w]
                if i >= self.window:
                    state_of = self._holder(state, self.window)
                    self.windows.setdefault(state_of, set()).add(item)
            if len(words) < self.window:
                at = self._holder(state, len(words))
                self.short.setdefault(at, {}).setdefault(len(words), set()).add(item)
        # the holder of a window for each longer match, and the nearest shorter match that ends a short item
        self.held = [-1] * states
        self.ends = [-1] * states
        for s in sorted(range(1, states), key=self.size.__getitem__):
            up = self.link[s]
            if self.size[s] >= self.window:
                self.held[s] = s if self.size[up] < self.window else self.held[up]
            self.ends[s] = s if s in self.short else self.ends[up] if up >= 0 else -1

    def match(self, words: list[bytes]) -> tuple[int, list[tuple[int, int]], set]:
        """Words hit, the hit spans (first and past the last word) and the items with occurring windows."""
        n = len(words)
        if n < self.least or not self.ids:
            return 0, [], set()
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int32, n)
        known = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        runs = known.reshape(-1, 2)
        runs = runs[runs[:, 1] - runs[:, 0] >= self.least]
        spans: list[tuple[int, int]] = []
        found: set = set()
        for a, b in runs.tolist():
            self._stream(ids[a:b].tolist(), a, spans, found)
        spans = _joined(spans)
        return sum(b - a for a, b in spans), spans, found

    def _stream(self, ids: list[int], start: int, spans: list, found: set) -> None:
        step, size, link, window = self.step, self.size, self.link, self.window
        state = length = 0
        for end, w in enumerate(ids, start + 1):
            while state and w not in step[state]:
                state = link[state]
                length = size[state]
            if w not in step[state]:
                continue
            state = step[state][w]
            length += 1
            if length >= window:
                spans.append((end - window, end))
                found |= self.windows[self.held[state]]
            at = self.ends[state]
            while at >= 0:
                for m, items in self.short[at].items():
                    if m <= length:
                        spans.append((end - m, end))
                        found |= items
                at = self.ends[link[at]] if link[at] >= 0 else -1


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def cut_out(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    places = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last:places[a][0]])
        last = places[b - 1][1]
    return "".join(out) + text[last:]


_LOWER = {c: c + 32 for c in range(65, 91)}


def blocks(benchmark: DataFrame, item: str = "item_id", column: str = "text", most: int = BLOCK_WORDS):
    """Items in blocks of a proven size, one after the other: each block's words are counted before it is fetched."""
    items = benchmark.select(F.col(item).alias("item"), F.col(column).cast("string").alias("text")).where("text is not null")
    words = F.size(F.split(F.col("text"), r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    total = items.agg(F.coalesce(F.sum(words), F.lit(0))).first()[0]
    n = max(1, -(-total * 5 // (most * 4))) if total > most else 1
    while True:
        block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
        sizes = items.groupBy(block.alias("block")).agg(F.sum(words).alias("words"), F.max(words).alias("longest"))
        over = sizes.where((F.col("words") > most) & (F.col("words") > F.col("longest"))).limit(1).count()
        if not over or n > 4 * total:
            break
        n *= 2
    for k in range(n):
        yield [(r.item, r.text) for r in items.where(block == k).collect()]


def find_hits(docs: DataFrame, benchmark: DataFrame, column: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, hit_items (sorted as strings) and hit_spans (in words).

    Each block of the benchmark is matched against all documents in a narrow step; hits of several blocks are
    joined row by row. A null or empty text has no words. Items without words match nothing, a null item id is
    matched and not listed, repeated items count once. New columns replace clashing ones.
    """
    fields = [
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
        T.StructField("hit_items", T.ArrayType(T.StringType())), T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
    out = None
    for block in blocks(benchmark, item, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(SuffixAutomaton(block, window))

        def make(shared=shared):
            automaton = shared.value

            def run(texts):
                rows = []
                for text in texts:
                    words = words_of(text)
                    n, spans, items = automaton.match(words)
                    names = sorted({str(x) for x in items if x is not None})
                    rows.append((len(words), n, len(names), names, [list(s) for s in spans]))
                return list(zip(*rows))

            return run

        if out is None:
            out = add_columns(docs, column, make, fields)
            continue
        before = out.withColumn("_items", F.col("hit_items")).withColumn("_spans", F.col("hit_spans"))
        both = add_columns(before, column, make, fields)
        spans = _join_spans(F.concat("_spans", "hit_spans"))
        items = F.array_sort(F.array_union("_items", "hit_items"))
        out = both.withColumn("hit_items", items).withColumn("hit_spans", spans).withColumn("n_items", F.size("hit_items").cast("long"))
        hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]))
        out = out.withColumn("n_hit", hit).drop("_items", "_spans")
    return out


def _join_spans(spans):
    """Overlapping and touching spans as one, as an expression."""
    empty = F.array().cast("array<array<int>>")

    def add(done, s):
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.array(last[0], F.greatest(last[1], s[1]))))
        return F.when((F.size(done) > 0) & (s[0] <= F.try_element_at(done, F.lit(-1))[1]), longer).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), empty, add)


def remove_hits(
    docs: DataFrame, benchmark: DataFrame, column: str = "text", most_coverage: float = 0.5, **names,
) -> DataFrame:
    """``docs`` without benchmark passages: hit spans are cut out, and a row hit for more than ``most_coverage`` goes.

    Rows that are not hit stay as they are; columns are those of ``docs``, whatever their names.
    """
    own = [f"_{i}" for i in range(len(docs.columns))]
    text = own[docs.columns.index(column)]
    hits = find_hits(docs.toDF(*own), benchmark, text, **names)
    hits = hits.where(F.col("n_hit") <= F.col("n_words") * F.lit(most_coverage))
    hits = hits.select(*own, "hit_spans", F.when(F.col("n_hit") > 0, F.col(text)).alias("hit_text"))

    def make():
        return lambda texts, spans: [[t if t is None else cut_out(t, s) for t, s in zip(texts, spans)]]

    cut = add_columns(hits, ["hit_text", "hit_spans"], make, [T.StructField("hit_text", T.StringType())])
    return cut.select(*[(F.coalesce("hit_text", c) if c == text else F.col(c)).alias(n) for c, n in zip(own, docs.columns)])


def items_digest(column: str = "hit_items"):
    """Hex digest of the item ids, joined by commas."""
    return F.sha2(F.array_join(column, ","), 256)
