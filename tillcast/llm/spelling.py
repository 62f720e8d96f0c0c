"""Spelling variants: a bit-sliced position index over the vocabulary, searched with one error for all words at once.

A block holds words of one length, most frequent first. For each (position, letter) it has a bit set over its words.
A query word is read letter by letter; the set of words that agree so far and the set of those with one error move on
together, the latter with the position shifted by one where a letter is inserted or deleted.

Words at one error from each other share their first three or their last three letters (both are of six or more), so
words are dealt by either end into groups that the vocabulary's size numbers, and a group has a block for each length.
A block of more than ``BLOCK`` words is dealt over several tasks, and every query of its group visits each part: no pair
of words is emitted, only counts and best words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import chunks
from tillcast.session import materialise

LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A word's form occurs so many times as often at least; one letter is lost at each run whose hash this number divides.
RATIO = 5
LOSS = 199
#: Letters of the shared end; words of a group on average; most words of a block; distinct words a task gathers before it passes counts on.
ENDS = 3
GROUP = 4_096
BLOCK = 8_192
GATHERED = 200_000
#: 64-bit words of one bit set table that a step of a search holds.
STEP_WORDS = 1 << 17

#: Runs of ASCII letters and U+00C0 to U+00FF, in Latin-1 with A-Z lower-cased: a byte for each letter.
RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LETTERS)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words_of(key: str, text: str) -> list[bytes]:
    """The counted words of one text in Latin-1, of ``LEAST_LETTERS`` or more, after the loss of letters."""
    crc, start = zlib.crc32, zlib.crc32(key.encode() + b":")
    found = RUN.findall(text.encode("latin-1", "replace").translate(LOWER))
    hashes = [crc(w if w.isascii() else w.decode("latin-1").encode(), start) for w in found]
    lost = [i for i, h in enumerate(hashes) if not h % LOSS]
    for i in lost:
        w, at = found[i], hashes[i] % len(found[i])
        found[i] = w[:at] + w[at + 1:]
    return [w for w in found if len(w) >= LEAST_LETTERS] if lost else found


def vocabulary(docs: DataFrame, key: str = "doc_id", column: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """word and n for every word of ``least`` or more occurrences; a null text has no words, a null key counts as an empty one."""
    given = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.coalesce(F.col(column).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        counts: Counter = Counter()

        def rows():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"],
            )
            counts.clear()
            return batch

        for batch in batches:
            for part in chunks(batch, "text"):
                for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts.update(words_of(k, t))
                    if len(counts) > GATHERED:
                        yield rows()
        if counts:
            yield rows()

    found = given.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class PositionIndex:
    """Bit sets over words of one length, for each position and letter; bit 0 is the first word."""

    def __init__(self, words: list[str]):
        self.length, self.size = len(words[0]), len(words)
        self.width = -(-self.size // 64)
        letters = _letters(words)
        self.sets: list[tuple[np.ndarray, np.ndarray]] = []  # per position: its letters, and a row of bits for each; a last row of none
        for p in range(self.length):
            found, code = np.unique(letters[:, p], return_inverse=True)
            bits = np.zeros((len(found) + 1, self.width * 64), bool)
            bits[code, np.arange(self.size)] = True
            self.sets.append((found, np.packbits(bits, axis=1, bitorder="little").view(np.uint64)))
        all_words = np.zeros(self.width * 64, bool)
        all_words[:self.size] = True
        self.all = np.packbits(all_words, bitorder="little").view(np.uint64)

    def having(self, p: int, letters: np.ndarray) -> np.ndarray:
        """For each letter the words that have it at position ``p``; none outside the words."""
        if not 0 <= p < self.length:
            return np.zeros((len(letters), self.width), np.uint64)
        found, bits = self.sets[p]
        at = np.searchsorted(found, letters)
        at[(at == len(found)) | (found[np.minimum(at, len(found) - 1)] != letters)] = len(found)
        return bits[at]

    def near(self, letters: np.ndarray, beyond_start: bool) -> np.ndarray:
        """A row of bits for each query (all of one length): its words at exactly one error.

        ``beyond_start`` leaves out words that have the query's first ``ENDS`` letters, and without it only those count: a pair is found once.
        """
        shift = self.length - letters.shape[1]
        exact = np.broadcast_to(self.all, (len(letters), self.width))
        one = np.zeros_like(exact)
        start = None
        for i in range(letters.shape[1]):
            here = self.having(i, letters[:, i])
            if shift == 0:
                one = (one & here) | (exact & ~here)  # another letter in this place
            elif shift == 1:
                one = (one | exact) & self.having(i + 1, letters[:, i])  # the word has one more letter, before this one
            else:
                one = (one & self.having(i - 1, letters[:, i])) | exact  # the word lacks this letter
            exact = exact & here
            if i == ENDS - 1:
                start = exact
        if shift == 1:
            one = one | exact  # one more letter at the end
        return one & (~start if beyond_start else start)


def _letters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def search(index: PositionIndex, words: list[str], beyond_start: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each query, all of one length: the number of near words and the place of the first of them (-1: none)."""
    numbers, firsts = [], []
    step = max(1, STEP_WORDS // index.width)
    for a in range(0, len(words), step):
        bits = index.near(_letters(words[a:a + step]), beyond_start)
        numbers.append(np.bitwise_count(bits).sum(axis=1, dtype=np.int64))
        word = (bits != 0).argmax(axis=1)
        value = bits[np.arange(len(bits)), word]
        lowest = np.bitwise_count((value & -value) - np.uint64(1)).astype(np.int64)
        firsts.append(np.where(value != 0, word * 64 + lowest, -1))
    return np.concatenate(numbers), np.concatenate(firsts)


def _search_groups(batches):
    """Rows sorted by (side, group, length, part, indexed first, n downwards, word): builds each index, then streams its queries."""
    at, index, kept, counts = None, None, [], []

    def finish(words):
        numbers, firsts = search(index, words, at[0] == 1)
        hit = numbers > 0
        places = firsts[hit]
        return pa.RecordBatch.from_arrays([
            pa.array(words, pa.string()).filter(pa.array(hit)), pa.array(numbers[hit]),
            pa.array([counts[p] for p in places], pa.int64()), pa.array([kept[p] for p in places], pa.string()),
        ], names=["word", "n_near", "form_n", "form"])

    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(7)]
        waiting: list[str] = []
        for *group, query, n, word in zip(*cols):
            if group != at or (waiting and len(word) != len(waiting[0])):
                if waiting:
                    yield finish(waiting)
                waiting = []
            if group != at:
                at, index, kept, counts = group, None, [], []
            if not query:
                kept.append(word)
                counts.append(n)
                continue
            if not kept:
                continue
            index = index or PositionIndex(kept)
            waiting.append(word)
        if waiting:
            yield finish(waiting)


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, form_n, form for every word of ``words`` (word, n; distinct): the near words' number, and the most frequent of them.

    Words of fewer than twice ``ENDS`` letters are not searched: they may share no end with a near word.
    """
    spark = words.sparkSession
    own, groups = F.length("word"), max(1, words.count() // GROUP)
    sides = [(0, F.substring("word", 1, ENDS)), (1, F.substring("word", -ENDS, ENDS))]
    sides = F.explode(F.array(*(F.struct(F.lit(i).alias("side"), F.pmod(F.xxhash64(e), F.lit(groups)).alias("group")) for i, e in sides)))
    long = words.where(own >= 2 * ENDS).select("word", "n", own.alias("own"), sides.alias("s")).select("word", "n", "own", "s.*")
    keys = ["side", "group", "length"]
    sizes = long.groupBy("side", "group", F.col("own").alias("length")).agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    indexed = long.withColumnRenamed("own", "length").join(sizes, keys)
    asking = long.withColumn("length", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1))).join(sizes, keys)
    dealt = indexed.select(*keys, F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("query"), "n", "word")
    asked = asking.select(*keys, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("query"), "n", "word")
    # The rows of a task stay sorted by group, so one index is held at a time; queries of one length follow each other.
    tasks = dealt.unionByName(asked).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, "part")
    tasks = tasks.sortWithinPartitions(*keys, "part", "query", F.when(F.col("query"), F.length("word")), F.desc("n"), "word")
    found = tasks.mapInArrow(_search_groups, "word string, n_near long, form_n long, form string")
    none = words.select("word", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form"))))
    return found.unionByName(none).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.form").alias("form"),
    )


def _roots(forms: DataFrame) -> DataFrame:
    """word and root for every word with a form: each round doubles the steps, so few rounds reach any end.

    A form is ``RATIO`` times as frequent as its word, so no path is longer than the logarithm of the largest count.
    """
    reached = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(reached.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        reached = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            return reached


def group_variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """For every word of ``words`` (word, n): n_near, form, form_n and root.

    The form is the near word of largest n (of equal ones the first by code points) if it occurs ``ratio`` times as often
    at least, else null; the root is the end of the path of forms, the word itself without a form. Empty in, empty out.
    """
    words = materialise(words.select("word", "n"), "spelling-words")
    enough = F.col("form_n") >= F.col("n") * ratio
    found = near_words(words, block).join(words, "word").select(
        "word", "n", "n_near", F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
    )
    found = materialise(found, "spelling-near")
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")).select("word", "n", "n_near", "form", "form_n", "root")
