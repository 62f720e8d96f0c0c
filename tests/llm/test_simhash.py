import random

import numpy as np
import pytest
import xxhash

from tillcast.llm import simhash_dedup as s
from tillcast.llm.components import connected_components


def plain(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(prints, budget=4):
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= budget:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(prints))]


def test_fingerprints():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["A", "b", "Çé", "dd"]) for _ in range(n)) for n in (0, 1, 3, 4, 5, 300, 1200)] + [None, " \t\n\x0b", "a b c"]
    assert [int(x) for x in s.fingerprints(texts)] == [plain(t) for t in texts]


@pytest.mark.parametrize("seed", range(12))
def test_trie_join_finds_all(seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    values = sorted({c ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (1 << 64) - 1 for c in centres for _ in range(60)})
    v = np.array(values, np.uint64)
    a, b = s.trie_join(v, np.zeros(len(v), int), np.zeros(len(v), int), 4)
    assert sorted(zip(a.tolist(), b.tolist())) == [(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if bin(values[i] ^ values[j]).count("1") <= 4]
    side = np.array([1 + (x * 7919 % 3 == 0) for x in range(len(v))])
    order = np.lexsort((v, side))
    a, b = s.trie_join(v[order], np.zeros(len(v), int), side[order], 4)
    got = sorted(tuple(sorted((int(order[x]), int(order[y])))) for x, y in zip(a, b))
    assert got == [(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if bin(values[i] ^ values[j]).count("1") <= 4 and side[i] != side[j]]


def test_masks_meet():
    rng = random.Random(5)
    for n in (100, 10**6, 10**9, 10**11):
        masks = s.block_masks(n)
        for _ in range(300):
            x = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(m & x == 0 for m in masks)


@pytest.mark.parametrize("full", [1024, 16])
def test_links_connect_what_is_near(spark, full):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(30)]
    values = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(12)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = s.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), full=full)
    found = {r.node: r.component for r in connected_components(links).collect()}
    wanted = closure(values)
    ours = [found.get(v, v) for v in signed]
    assert len(set(zip(ours, wanted))) == len(set(ours)) == len(set(wanted))


BASE = " ".join(f"word{i % 83}x{i}" for i in range(400))
TEXTS = [BASE, BASE, BASE.replace("word7x7 ", "changed "), "other text entirely here now", None, "", "  ", "Z " * 5000, BASE.upper()]


def test_near_duplicates(spark, docs_of):
    docs = docs_of(TEXTS, [9, 8, 7, 6, 5, 4, 3, 2, 1])
    rows = s.near_duplicates(docs).collect()
    prints = {r.doc_id: r.fingerprint for r in rows}
    ids = [9, 8, 7, 6, 5, 4, 3, 2, 1]
    assert [prints[i] for i in ids] == [f"{plain(t):016x}" for t in TEXTS]
    roots = closure([plain(t) for t in TEXTS])
    least = {root: min(i for i, r in zip(ids, roots) if r == root) for root in set(roots)}
    assert {r.doc_id: r.component_id for r in rows} == {i: least[r] for i, r in zip(ids, roots)}
    assert s.near_duplicates(docs.where("false")).count() == 0


def test_keep_one(spark, docs_of):
    texts, ids = [*TEXTS, BASE, "lone null", "lone null"], [9, 8, 7, 6, 5, 4, 3, 2, 1, 1, None, None]
    docs = docs_of(texts, ids)
    kept = s.keep_one(docs)
    rows = kept.collect()
    assert kept.columns == docs.columns
    roots = closure([plain(t) for t in texts])
    least = {min((i for i, r in zip(ids, roots) if r == root and i is not None), default=None) for root in set(roots)}
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(least - {None})
    assert [r.text for r in rows if r.doc_id is None] == ["lone null"]


def test_keep_one_tells_classes_without_own_key_apart(spark, docs_of):
    def words(name):
        return " ".join(f"{name}{i}" for i in range(50))

    texts = [words("a"), words("b"), words("c"), words("c"), words("d"), words("e"), words("f"), words("f")]
    docs = docs_of(texts, [None, None, None, None, 5, 5, None, 8])
    kept = [(r.doc_id, r.text) for r in s.keep_one(docs).collect()]
    wanted = [(None, words("a")), (None, words("b")), (None, words("c")), (5, words("d")), (5, words("e")), (8, words("f"))]
    assert sorted(kept, key=lambda x: x[1]) == wanted


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(None, 3), (5, 5)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}
