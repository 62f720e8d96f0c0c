"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

Each of several tables rotates the unit vectors by three rounds of random signs and Hadamard transform; the
hash is the axis, with sign, that is nearest. Every vector sits in its home bucket of each table and visits the
next likely ones. Pairs that meet are verified by cosine in double precision, counted once, in the first bucket
where they meet. Equal vectors are one class; large buckets are joined in blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import whole_groups
from tillcast.llm.components import connected_components
from tillcast.session import materialise

SIGNS_SEED = 20_240_611


@dataclass(frozen=True)
class Settings:
    """``tables``: independent hashes of one axis. ``probes``: buckets visited in each, the home not counted. ``block``:
    classes of a bucket that are compared at once; a larger bucket is cut into blocks, none is left out.
    ``bucket``: wanted classes in a bucket, which sets how many axes make a hash."""

    least: float = 0.93
    tables: int = 8
    probes: int = 2
    block: int = 1_024
    bucket: int = 64

    def axes(self, classes: int, d: int) -> int:
        """Axes of a hash for a group of so many classes of ``d`` numbers."""
        width = 1 << max(1, (d - 1).bit_length())
        axes = 1
        while classes / (2 * width) ** axes > self.bucket and (2 * width) ** (axes + 1) < 1 << 62:
            axes += 1
        return axes

    def of(self, axes: int) -> Settings:
        """Each further axis makes it rarer that two near vectors meet in a table, so it doubles the tables."""
        return replace(self, tables=self.tables << axes - 1)


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def codes(unit: np.ndarray, settings: Settings, axes: int) -> tuple[np.ndarray, np.ndarray]:
    """Home bucket (rows x tables) and visited buckets (rows x tables x probes) of unit vectors."""
    n, d = unit.shape
    width = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :d] = unit
    rng = np.random.default_rng([SIGNS_SEED, width])
    home = np.zeros((n, settings.tables), np.int64)
    visits = np.zeros((n, settings.tables, settings.probes), np.int64)
    for t in range(settings.tables):
        choices, losses = [], []
        for _ in range(axes):
            x = padded
            for _ in range(3):
                x = _hadamard(x * rng.choice((-1.0, 1.0), width))
            both = np.concatenate((x, -x), 1)
            top = np.argsort(-both, 1, kind="stable")[:, :settings.probes + 1]
            height = np.take_along_axis(both, top, 1)
            choices.append(top)
            losses.append((height[:, :1] - height)[:, 1:] ** 2)
        place = np.array([(2 * width) ** a for a in range(axes)], np.int64)
        home[:, t] = sum(c[:, 0] * p for c, p in zip(choices, place))
        # each probe changes one axis: the cheapest changes over all axes come first
        change = np.concatenate([(c[:, 1:] - c[:, :1]) * p for c, p in zip(choices, place)], 1)
        cheap = np.argsort(np.concatenate(losses, 1), 1, kind="stable")[:, :settings.probes]
        visits[:, t] = home[:, t, None] + np.take_along_axis(change, cheap, 1)
    return home, visits


def _unit_rows(vectors: DataFrame, key: str, column: str, label: str) -> DataFrame:
    """(key, label, vector) of the vectors that can link: finite, not zero, with a label."""
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), v.alias("vector")).where(usable).where(finite).where(some)


def vector_links(classes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Links among ``classes`` (cid, label, vector, weight).

    Rows (cid, other, n): n vectors that a class is linked to beyond its own, ``other`` null, or a link (n 0) of a
    spanning forest. Vectors of different length never meet.
    """
    classes = classes.withColumn("label", F.col("label").cast("string"))
    groups = classes.groupBy("label", F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    large = groups.where(F.col("n") > 2 * F.col("d") * settings.bucket)  # others have one axis
    axes = {(r.label, r.d): a for r in large.collect() if (a := settings.axes(r.n, r.d)) > 1}
    probes, block = settings.probes, settings.block

    def hashed(frames):
        import pandas as pd

        for frame in frames:
            sizes = frame["vector"].map(len)
            many = pd.Series([axes.get(group, 1) for group in zip(frame["label"], sizes)], frame.index, int)
            for (_, a), same in frame.groupby([sizes, many], sort=False):
                x = np.stack(same["vector"].to_numpy()).astype(np.float64)
                unit = _unit(x)
                home, visits = codes(unit, settings.of(a), a)
                yield pd.DataFrame({
                    "cid": same["cid"].to_numpy(), "label": same["label"].to_numpy(), "weight": same["weight"].to_numpy(),
                    "vector": list(x), "home": list(home), "visits": list(visits.reshape(len(home), -1)),
                })

    dealt = classes.mapInPandas(hashed, "cid long, label string, weight long, vector array<double>, home array<long>, visits array<long>")
    dealt = materialise(dealt, "vector-hashes")
    at = F.transform("home", lambda x, i: F.struct(i.alias("t"), x.alias("bucket"), F.lit(True).alias("own")))
    away = F.transform("visits", lambda x, i: F.struct(F.floor(i / probes).cast("int").alias("t"), x.alias("bucket"), F.lit(False).alias("own")))
    keys = ["label", "d", "t", "bucket"]
    meet = dealt.select("cid", "label", F.size("vector").alias("d"), F.explode(F.concat(at, away)).alias("x")).select("cid", "label", "d", "x.*")
    sizes = meet.groupBy(*keys).agg(F.count("*").alias("size"), F.max("own").alias("homes"))
    wide = materialise(sizes.where("size > 1 and homes"), "vector-buckets").drop("homes")
    parts = F.ceil(F.col("size") / block).cast("int")
    meet = meet.join(wide, keys).withColumn("parts", parts).withColumn("mine", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    pairs = meet.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = pairs.select(
        "cid", *keys, "own", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).alias("second"),
    )
    full = pairs.join(dealt.select("cid", "weight", "vector", "home", "visits"), "cid")
    group = [*keys, "i", "j"]

    def verified(frames):
        import pandas as pd

        for frame in whole_groups(frames, group, 4 * block):
            change = np.zeros(len(frame), bool)
            for k in group:
                v = frame[k].to_numpy()
                change[1:] |= v[1:] != v[:-1]
            counts: dict[int, int] = {}
            edges: set = set()
            for own in np.split(np.arange(len(frame)), np.flatnonzero(change)):
                if len(own) > 1:
                    _count_links(frame.iloc[own], settings, counts, edges)
            if counts:
                yield pd.DataFrame({"cid": list(counts), "other": pd.array([None] * len(counts), "Int64"), "n": list(counts.values())})
            if edges:
                a, b = zip(*edges)
                yield pd.DataFrame({"cid": a, "other": pd.array(b, "Int64"), "n": 0})

    return full.repartition(*group).sortWithinPartitions(*group, "cid").mapInPandas(verified, "cid long, other long, n long")


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _count_links(group, settings: Settings, counts: dict, edges: set) -> None:
    """Counts the links that a bucket finds first, and keeps a spanning forest of them."""
    from tillcast.llm.simhash_dedup import spanning

    unit = _unit(np.stack(group["vector"].to_numpy()))
    own, second = group["own"].to_numpy(), group["second"].to_numpy()
    crossed = group["i"].iat[0] != group["j"].iat[0]
    a, b = np.nonzero(unit @ unit.T >= settings.least - 1e-9)
    ok = (a < b) & (own[a] | own[b])
    if crossed:
        ok &= second[a] != second[b]
    a, b = a[ok], b[ok]
    exact = (unit[a] * unit[b]).sum(1) >= settings.least
    a, b = a[exact], b[exact]
    if not len(a):
        return
    t, bucket = int(group["t"].iat[0]), int(group["bucket"].iat[0])
    home = np.stack(group["home"].to_numpy())
    visits = np.stack(group["visits"].to_numpy()).reshape(*home.shape, settings.probes)
    ha, hb = home[a], home[b]
    to_a = (ha == hb) | (visits[b] == ha[:, :, None]).any(2)  # they meet where a is at home
    to_b = (ha == hb) | (visits[a] == hb[:, :, None]).any(2)
    first = (to_a | to_b).argmax(1)
    rows = np.arange(len(a))
    far = np.int64(1) << 62
    least = np.minimum(np.where(to_a[rows, first], ha[rows, first], far), np.where(to_b[rows, first], hb[rows, first], far))
    mine = (first == t) & (least == bucket)
    a, b = a[mine], b[mine]
    cid, weight = group["cid"].to_numpy(), group["weight"].to_numpy()
    linked = np.bincount(a, weight[b], len(cid)) + np.bincount(b, weight[a], len(cid))
    for i in np.flatnonzero(linked).tolist():
        counts[cid[i]] = counts.get(cid[i], 0) + int(linked[i])
    for u, v in zip(*spanning(a, b, len(cid))):
        edges.add((int(cid[u]), int(cid[v])))


def near_duplicate_vectors(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str = "label", settings: Settings = Settings(),
) -> DataFrame:
    """(key, n_links, component_id, kept) for every row; other columns are left out.

    Vectors link when their labels are equal and not null and their cosine is at least ``settings.least``. Null,
    zero and non-finite vectors link with nothing. Equal vectors of one label link without hashing. Each row
    counts as a vector, also where keys repeat.
    """
    plain = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(column).alias("vector"))
    usable = _unit_rows(plain, "key", "vector", "label")
    classes = usable.groupBy("label", "vector").agg(F.min("key").alias("least"), F.count("*").alias("weight"))
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    links = materialise(vector_links(classes.select("cid", "label", "vector", "weight"), settings), "vector-links")
    nodes = connected_components(links.where("other is not null"), "cid", "other")
    counted = links.where("other is null").groupBy("cid").agg(F.sum("n").alias("n"))
    known = classes.select("cid", "least", "weight").join(counted, "cid", "left").join(nodes.withColumnRenamed("node", "cid"), "cid", "left")
    known = known.withColumn("component", F.coalesce("component", "cid"))
    roots = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(roots, "component").select("cid", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    known = known.join(classes.select("cid", F.col("label").alias("_l"), F.col("vector").alias("_v")), "cid")
    doubles = plain.withColumn("vector", F.transform("vector", lambda x: x.cast("double")))
    rows = doubles.join(known, (doubles["label"] == known["_l"]) & (doubles["vector"] == known["_v"]), "left")
    component = F.coalesce("component_id", "key")
    return rows.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )
