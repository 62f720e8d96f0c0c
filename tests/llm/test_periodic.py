import hashlib
import random
import zlib
from fractions import Fraction

from tillcast.llm import periodic


def brute(words):
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            part = words[s:s + length]
            if i > s and length >= max(24, 3 * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                found.append((s, length, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def made(draw, most=150):
    words, size, letters = [], draw.randrange(most), draw.choice([1, 2, 3, 9, 60])
    while len(words) < size:
        part = [b"%d" % draw.randrange(letters) for _ in range(draw.randint(1, 14))]
        words += part * draw.randint(1, 9) + part[:draw.randint(0, len(part))]
        words += [b"w%d" % draw.randrange(1000) for _ in range(draw.choice([0, 0, 3, 30]))]
    return words


def test_runs_against_all_periods():
    draw, total = random.Random(5), 0
    for _ in range(300):
        texts = [made(draw) for _ in range(3)]
        wanted = [brute(t) for t in texts]
        assert periodic.find_runs(texts) == wanted
        for t, w in zip(texts, wanted):  # the automaton alone, without setting words aside first
            assert periodic.runs_of_stretch([hash(x) for x in t]) == sorted(w)
        total += sum(map(len, wanted))
    assert total > 500


def test_stretches_hold_every_run():
    draw = random.Random(6)
    import numpy as np

    for _ in range(200):
        words = made(draw)
        kept = periodic.repeating_stretches(np.array([hash(w) for w in words], np.int64), np.zeros(len(words), np.int64))
        assert all(any(a <= s and s + n <= b for a, b in kept) for s, n, _ in brute(words))


def test_nested_and_touching_runs():
    a, b = [b"a"] * 24, [b"a", b"b"] * 12
    assert periodic.find_runs([a + [b"x"] + b, a[:23], [b"x", *b, b"b"]]) == [[(0, 24, 1), (25, 24, 2)], [], [(1, 24, 2)]]
    inner = [b"p"] * 30 + [b"q"]
    assert periodic.find_runs([inner * 3]) == [[(0, 30, 1), (0, 93, 31), (31, 30, 1), (62, 30, 1)]]


def test_long_periodic_text_is_quick():
    words = [b"x", b"y", b"z"] * 40_000 + [b"end"]
    assert periodic.find_runs([words]) == [[(0, 120_000, 3)]]


def digest(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    exponent = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, exponent, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_digests_of_documents(spark, docs_of):
    draw = random.Random(7)
    texts = [None, "", " \t\n", "a\x0bb\x1cc d", "same words " * 30, *(b" ".join(made(draw)).decode() for _ in range(60))]
    texts += ["tie " * 24 + "x " + "toe " * 24] * 3
    ids = [None, *range(-3, len(texts) - 4)]
    found = periodic.run_digests(docs_of(texts, ids), stretch=True)
    assert {"score", "fingerprint"} <= set(found.columns) and "_key" not in found.columns
    wanted = []
    for i, t in zip(ids, texts):
        words = (t or "").encode().split()
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
        wanted.append((i, *digest(words, brute(words))))
    got = [tuple(r) for r in found.select("doc_id", *(f.name for f in periodic.FIELDS)).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert any(w[0] is not None and zlib.crc32(str(w[0]).encode()) % 10 == 0 and w[1] for w in wanted)


def test_run_arrays_and_collapsed_text(spark, docs_of):
    docs = docs_of(["say " + "it again " * 20 + "now", None]).withColumnRenamed("score", "runs")
    rows = sorted(periodic.periodic_runs(docs).collect(), key=lambda r: r.doc_id)
    assert [tuple(x) for x in rows[0].runs] == [(1, 40, 2)] and rows[0].collapsed == "say it again now"
    assert rows[1].runs == [] and rows[1].collapsed == ""
    assert periodic.periodic_runs(docs.where("false")).count() == 0
