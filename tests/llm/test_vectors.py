import numpy as np
import pytest

from tillcast.llm import vector_dedup as v


def brute(rows, least=0.93):
    usable = {}
    for i, (key, x, label) in enumerate(rows):
        if x is not None and label is not None and len(x) and all(e is not None and np.isfinite(e) for e in x) and any(x):
            usable[i] = np.array(x, float) / np.linalg.norm(x)
    root, links = list(range(len(rows))), [0] * len(rows)
    for i in usable:
        for j in usable:
            if i != j and rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= least:
                links[i] += 1
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    ids = [r[0] for r in rows]
    return {ids[i]: (links[i], min(ids[j] for j in range(len(rows)) if root[j] == root[i])) for i in range(len(rows))}


def table(d, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(40):
        centre = rng.normal(size=d)
        rows += [(centre + 0.2 * rng.normal(size=d)).tolist() for _ in range(int(rng.integers(1, 12)))]
    rows += [rows[0]] * 30 + [[2 * e for e in rows[0]]]
    rows = [(900 - i, x, int(i % 7 == 0)) for i, x in enumerate(rows)]
    odd = [None, [0.0] * d, [float("nan")] + [1.0] * (d - 1), [float("inf")] + [1.0] * (d - 1), [None] + [1.0] * (d - 1), [], rows[3][1][:-1]]
    return rows + [(2000 + i, x, 0) for i, x in enumerate(odd)] + [(3000, rows[0][1], None), (3001, rows[0][1], None)]


@pytest.mark.parametrize("block", [1024, 8])
def test_links_equal_brute_force(spark, block):
    rows = table(24)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    found = v.near_duplicate_vectors(df, settings=v.Settings(block=block)).collect()
    wanted = brute(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == wanted
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_several_axes(spark):
    rows = table(16, 2)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = v.near_duplicate_vectors(df, settings=v.Settings(bucket=2, tables=16, probes=6)).collect()
    wanted = brute(rows)
    assert np.mean([(r.n_links, r.component_id) == wanted[r.vec_id] for r in found]) > 0.95


def pairs(n, d=64, cosine=0.9301, seed=5):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=(2, n, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    return a, cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1, keepdims=True)


@pytest.mark.parametrize("bucket, axes", [(1.0, 2), (0.01, 3)])
def test_hot_label_keeps_its_links(spark, bucket, axes):
    settings = v.Settings(bucket=bucket)
    a, b = pairs(600)
    assert settings.axes(2 * len(a), 64) == axes and settings.of(axes).tables == 8 << axes - 1
    rows = [(2 * i + side, x.tolist(), "hot") for i, both in enumerate(zip(a, b)) for side, x in enumerate(both)]
    rows += [(5000 + i, x.tolist(), "few") for i, x in enumerate((a[0], b[0], a[1]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(4)
    found = {r.vec_id: (r.n_links, r.component_id) for r in v.near_duplicate_vectors(df, settings=settings).collect()}
    assert found == {i: (1, i // 2 * 2) for i in range(1200)} | {5000: (1, 5000), 5001: (1, 5000), 5002: (0, 5002)}


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, extra string")
    assert v.near_duplicate_vectors(df).count() == 0
