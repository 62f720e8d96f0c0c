import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tillcast.llm import spelling


def brute_words(rows, least=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{key}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += len(w) >= 6
    return {w: n for w, n in counts.items() if n >= least}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(words, ratio=5):
    out, forms = {}, {}
    for w, n in words.items():
        near = [v for v in words if is_near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
        out[w] = [n, len(near), forms[w], words[best] if forms[w] else None]
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out[w].append(root)
    return out


def as_dict(df):
    return {r.word: [r.n, r.n_near, r.form, r.form_n, r.root] for r in df.collect()}


def test_words_of_texts(spark, docs_of):
    draw = random.Random(3)
    pool = ["Straße", "coração", "ABCDEFÀ", "letters", "Letters", "short", "×÷multip", "naïvetés", "x" * 3000]
    texts = [" 1,Ā".join(draw.choices(pool, k=60)) for _ in range(150)] + [None, "", "letters" * 2000]
    ids = [*range(1000, 1000 + len(texts) - 1), None]
    found = {r.word: r.n for r in spelling.vocabulary(docs_of(texts, ids)).collect()}
    wanted = brute_words(zip(["" if i is None else i for i in ids], texts))
    assert found == wanted
    assert len(wanted) > 7  # a word that has lost a letter is among them


@pytest.mark.parametrize("block", [3, 8192])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "GROUP", 100)
    draw = random.Random(block)
    words = {}
    for _ in range(250):
        w = "".join(draw.choices("abé", k=draw.randrange(6, 10)))
        words[w] = draw.choice([5, 5, 6, 30, 150, 800])
    words["a" * 400], words["a" * 401], words["abcdef"] = 5, 25, 5
    given = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert as_dict(spelling.group_variants(given, block=block)) == brute_groups(words)


def test_paths_and_ties(spark):
    words = {"colour": 3125, "colou": 1, "colours": 625, "colourso": 125, "colourson": 25, "colourzon": 5, "colourxx": 125, "harbour": 50, "harbor": 10, "harboru": 50}
    found = as_dict(spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert found["colourzon"][2:] == ["colourson", 25, "colour"]
    assert found["harbor"][2] == "harboru" and found["harbour"][2] is None  # of equal counts the first; no pair of equals has a form
    assert found["colou"][1:] == [0, None, None, "colou"]  # too short to be searched


def test_empty(spark, docs_of):
    assert spelling.group_variants(spelling.vocabulary(docs_of([None, "", "one two"]))).count() == 0
    assert spelling.group_variants(spelling.vocabulary(docs_of(["x"]).where("false"))).count() == 0


def test_position_index_directly():
    draw = random.Random(9)
    words = list({"".join(draw.choices("ab", k=8)) for _ in range(150)})
    index = spelling.PositionIndex(words)
    for size in (7, 8, 9):
        asked = ["".join(draw.choices("abz", k=size)) for _ in range(80)]
        both = [spelling.search(index, asked, side) for side in (False, True)]
        for i, q in enumerate(asked):
            near = [j for j, w in enumerate(words) if is_near(q, w)]
            inside = [j for j in near if words[j][:3] == q[:3]]
            for (numbers, firsts), part in zip(both, (inside, sorted(set(near) - set(inside)))):
                assert numbers[i] == len(part) and firsts[i] == min(part, default=-1)
    assert np.bitwise_count(index.all).sum() == len(words)
