"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by a self-join of binary tries.

Fingerprints are dealt out by blocks of their bits, so that any two within the error budget share a group. In a
group, sorted fingerprints are a binary trie whose nodes are ranges. Node pairs are traversed together, bit by
bit; differing bits add up, and a pair beyond the budget is pruned. Groups keep a spanning forest of the links.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.common import add_columns, whole_groups
from tillcast.llm.components import connected_components
from tillcast.session import materialise

BITS = 64
SHINGLE = 4
SEED = 42
BUDGET = 4
#: Fingerprints that one trie holds; a larger group is joined in pairs of tries of this size.
TRIE = 1_024
#: Node pairs small enough to be compared member by member.
LEAF_PAIRS = 16


def fingerprints(texts: list[str | None], size: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each text; zero if it has no word."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes, counts = [], []
    for text in texts:
        words = text.encode().lower().split() if text else []
        if not words:
            counts.append(0)
            continue
        n = max(1, len(words) - size + 1)
        line = b" ".join(words)
        ends = (np.fromiter(map(len, words), np.int64, len(words)) + 1).cumsum() - 1
        starts = np.concatenate(([0], ends[:n - 1] + 1)).tolist()
        hashes += [digest(line[a:b], SEED) for a, b in zip(starts, ends[-n:].tolist())]
        counts.append(n)
    out = np.zeros(len(texts), np.uint64)
    values = np.array(hashes, "<u8")
    ends = np.cumsum(counts)
    for i, n in enumerate(counts):
        if n:
            ones = _bit_counts(values[ends[i] - n:ends[i]])
            out[i] = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
    return out


def _bit_counts(values: np.ndarray) -> np.ndarray:
    """How many values have each bit set; sums run in bytes over 255 rows at a time."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    total = bits[whole:].sum(0, dtype=np.int64)
    if whole:
        total += bits[:whole].reshape(-1, 255, BITS).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return total


def add_fingerprints(docs: DataFrame, column: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit integer; null and empty texts have zero."""
    return add_columns(docs, column, lambda: lambda texts: [fingerprints(texts).view(np.int64)], [T.StructField(name, T.LongType())])


def block_masks(fingerprints_in_all: int, budget: int = BUDGET, full: int = TRIE) -> list[int]:
    """Masks of which any two fingerprints within the budget agree on one.

    64 bits in b blocks leave b - budget of them untouched; b grows until groups are small on average.
    """
    for b in range(budget + 1, budget + 6):
        if fingerprints_in_all >> (BITS * (b - budget) // b) <= full // 8:
            break
    edges = [BITS * i // b for i in range(b + 1)]
    parts = [sum(1 << bit for bit in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, b - budget)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def trie_join(values: np.ndarray, group: np.ndarray, side: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs within ``budget`` bits, in each group of ascending unsigned ``values``.

    ``side`` 0 rows meet all of their group, ``side`` 1 and 2 rows only each other: the two halves of a pair of
    tries. Rows are sorted by group, side and value; a trie node is a range of rows.
    """
    n = len(values)
    edge = np.concatenate(([0], np.flatnonzero((group[1:] != group[:-1]) | (side[1:] != side[:-1])) + 1, [n]))
    lo, hi = edge[:-1], edge[1:]
    alone = side[lo] == 0
    left = np.flatnonzero((side[lo] == 1)[:-1] & (side[lo] == 2)[1:] & (group[lo][:-1] == group[lo][1:])) if len(lo) > 1 else np.zeros(0, int)
    a0, a1 = np.concatenate([lo[alone], lo[left]]), np.concatenate([hi[alone], hi[left]])
    b0, b1 = np.concatenate([lo[alone], lo[left + 1]]), np.concatenate([hi[alone], hi[left + 1]])
    errors = np.zeros(len(a0), np.int64)
    found_a, found_b = [], []
    for bit in range(BITS - 1, -1, -1):
        same = a0 == b0
        sizes = (a1 - a0) * (b1 - b0)
        keep = (sizes > 0) & ~(same & (a1 - a0 == 1))
        small = keep & (sizes <= LEAF_PAIRS)
        if small.any():
            i, j = _members(a0[small], a1[small], b0[small], b1[small])
            once = i < j
            i, j = i[once], j[once]
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            found_a.append(i[near])
            found_b.append(j[near])
        go = keep & ~small
        if not go.any():
            break
        a0, a1, b0, b1, errors, same = a0[go], a1[go], b0[go], b1[go], errors[go], same[go]
        zeros = np.concatenate(([0], ((values >> np.uint64(bit)) & np.uint64(1) == 0).cumsum()))
        am, bm = a0 + zeros[a1] - zeros[a0], b0 + zeros[b1] - zeros[b0]
        other = ~same & (errors < budget)
        cross = errors < budget
        a0, a1, b0, b1, errors = (
            np.concatenate(x) for x in (
                (a0, am, a0[cross], am[other]), (am, a1, am[cross], a1[other]),
                (b0, bm, bm[cross], b0[other]), (bm, b1, b1[cross], bm[other]),
                (errors, errors, errors[cross] + 1, errors[other] + 1),
            )
        )
    else:  # all bits are used: what is left agrees but for the errors counted
        keep = (a1 > a0) & (b1 > b0) & (a0 != b0)
        i, j = _members(a0[keep], a1[keep], b0[keep], b1[keep])
        found_a.append(i)
        found_b.append(j)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _members(a0, a1, b0, b1) -> tuple[np.ndarray, np.ndarray]:
    """All places of the first range with all of the second, for each pair of ranges."""
    wide = b1 - b0
    n = (a1 - a0) * wide
    at = np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
    wide = np.repeat(wide, n)
    return np.repeat(a0, n) + at // wide, np.repeat(b0, n) + at % wide


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place that has a smaller one in its component, the smallest such place: at most n - 1 links."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        np.minimum.at(least, root, least.copy())
        least = least[least]
        if (least == root).all():
            break
        root = least
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def fingerprint_links(distinct: DataFrame, name: str = "fingerprint", budget: int = BUDGET, full: int = TRIE) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all within ``budget`` bits of each other.

    Groups of more than ``full`` fingerprints are cut into parts, and each pair of parts is joined by itself.
    """
    n = distinct.count()
    masks = block_masks(n, budget, full)
    each = F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))
    rows = distinct.select(F.col(name).alias("fp")).withColumn("mask", each).withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
    sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("size")).where("size > 1")
    rows = materialise(rows.join(sizes, ["mask", "value"]), "trie-groups")
    small = rows.where(F.col("size") <= full).select("mask", "value", "fp", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"))
    return _joined(small.unionByName(_part_pairs(rows.where(F.col("size") > full), full)), budget, full)


def _part_pairs(rows: DataFrame, full: int) -> DataFrame:
    """Rows of large groups, once for each pair of parts that they take part in.

    Parts are dealt by a hash, so they are even whatever the fingerprints.
    """
    parts = F.ceil(F.col("size") / (full // 2)).cast("int")
    dealt = rows.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return pairs.select("mask", "value", "fp", i.alias("i"), j.alias("j"), side.cast("int").alias("side"))


def _joined(rows: DataFrame, budget: int, full: int) -> DataFrame:
    keys = ["mask", "value", "i", "j"]
    order = [*keys, "side", F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))]  # unsigned order

    def run(frames):
        import pandas as pd

        for frame in whole_groups(frames, keys, 4 * full):
            k = frame[keys].to_numpy()
            group = np.concatenate(([0], (k[1:] != k[:-1]).any(1).cumsum()))
            cuts = np.searchsorted(group, np.arange(group[-1] + 2))
            start = 0
            while start < len(cuts) - 1:  # as many groups at once as a few tries hold
                stop = max(start + 1, int(np.searchsorted(cuts, cuts[start] + 4 * full, side="right")) - 1)
                lo, hi = cuts[start], cuts[stop]
                fp = frame["fp"].to_numpy()[lo:hi]
                a, b = trie_join(fp.view(np.uint64), group[lo:hi], frame["side"].to_numpy()[lo:hi], budget)
                u, v = spanning(a, b, hi - lo)
                if len(u):
                    yield pd.DataFrame({"a": fp[u], "b": fp[v]})
                start = stop

    dealt = rows.repartition(*keys).sortWithinPartitions(*order)
    return dealt.mapInPandas(run, "a long, b long").distinct()


def duplicate_classes(prints: DataFrame, key: str = "doc_id", name: str = "fingerprint") -> DataFrame:
    """(fingerprint, component, component_id) for each distinct fingerprint: its class, and the smallest key in it.

    ``prints`` has a row for each document. A null key never stands for a class that has another. Only ``component``
    tells classes apart: those without a key share the null, and a key on several rows may stand for several.
    """
    classes = materialise(prints.groupBy(name).agg(F.min(key).alias("least")), "fingerprints")
    nodes = connected_components(fingerprint_links(classes, name))
    linked = classes.join(nodes.withColumnRenamed("node", name), name, "left")
    linked = linked.withColumn("component", F.coalesce("component", name))
    roots = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    return linked.join(roots, "component").select(name, "component", "component_id")


def near_duplicates(docs: DataFrame, column: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint, component_id) for every row of ``docs``; other columns are left out.

    Fingerprints of 4 words, linked at 4 or fewer differing bits. Rows with equal keys each get a row.
    """
    prints = materialise(add_fingerprints(docs.select(F.col(key).alias("key"), F.col(column).alias("text")), "text").select("key", "fingerprint"), "prints")
    found = prints.join(duplicate_classes(prints, "key"), "fingerprint")
    return found.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, column: str = "text", key: str = "doc_id") -> DataFrame:
    """The row of smallest key of each class of near-duplicates, with the columns of ``docs``.

    Of rows with that same key one of the smallest fingerprint stays. A row whose key is null stays only where no
    row of its class has a key.
    """
    columns = docs.columns
    own = [f"_{i}" for i in range(len(columns))]
    k, text = own[columns.index(key)], own[columns.index(column)]
    marked = materialise(add_fingerprints(docs.toDF(*own), text), "marked")
    prints = marked.select(F.col(k).alias("key"), "fingerprint")
    classes = duplicate_classes(prints, "key").select("fingerprint", "component")
    # nulls come last; a key may have several texts of the class: the smallest fingerprint of them stays
    least = prints.groupBy("fingerprint").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key")).alias("x"))
    chosen = least.join(classes, "fingerprint").groupBy("component").agg(F.min(F.struct("x", "fingerprint")).alias("first"))
    chosen = chosen.select(F.col("first.x.key").alias("key"), F.col("first.fingerprint").alias("fp"))
    rows = marked.join(chosen, marked[k].eqNullSafe(chosen["key"]) & (marked["fingerprint"] == chosen["fp"]))
    copies = chosen_twice(rows, k)
    return copies.select(*[F.col(o).alias(c) for o, c in zip(own, columns)])


def chosen_twice(rows: DataFrame, key: str) -> DataFrame:
    """One row of each (key, fingerprint), whichever repeated rows there are."""
    from pyspark.sql import Window

    first = Window.partitionBy("fingerprint", key).orderBy(F.lit(0))
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "key", "fp")
