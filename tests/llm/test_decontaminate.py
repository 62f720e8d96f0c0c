import random
import re

import pytest

from tillcast.llm import decontaminate as d

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for item, body in items:
        body = words(body)
        size = min(window, len(body))
        grams = {tuple(body[i:i + size]) for i in range(len(body) - size + 1)} if size else set()
        for i in range(len(own) - size + 1) if size else ():
            if tuple(own[i:i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("seed", range(40))
def test_automaton_equals_brute_force(seed):
    rng = random.Random(seed)
    letters = "abcd"[:rng.randint(1, 4)]
    items = [(i, " ".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))) for i in range(rng.randint(0, 6))]
    automaton = d.SuffixAutomaton(items)
    for _ in range(20):
        text = " ".join(rng.choice(letters + "z") for _ in range(rng.randint(0, 60)))
        n, spans, found = automaton.match(d.words_of(text))
        assert (len(d.words_of(text)), n, sorted(map(str, found))) == brute(text, items)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and then it sleeps well"), (2, "short item"), (3, None), (4, "..."),
    (2, "short item"), (10, "Ünïcode wörds äre kept as they are even though these ones are quite long"),
]
TEXTS = [
    "x QUICK brown-fox jumps over the lazy dog and then it y", "a SHORT, item!", None, "", "nothing here " * 2000,
    "ünïcode wörds äre kept as they are even though these", "quick brown fox jumps over the lazy dog and", "short", ITEMS[0][1],
]


@pytest.mark.parametrize("most", [100_000, 10])
def test_find_hits(spark, docs_of, monkeypatch, most):
    monkeypatch.setattr(d, "BLOCK_WORDS", most)
    monkeypatch.setattr(d.blocks, "__defaults__", ("item_id", "text", most))
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = d.find_hits(docs_of(TEXTS), benchmark).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert (r.n_words, r.n_hit, r.hit_items) == brute(r.text, ITEMS), r.text
        assert r.n_items == len(r.hit_items) and sum(b - a for a, b in r.hit_spans) == r.n_hit


def test_remove_hits(spark, docs_of):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    before = "Intro stays here as it was before, fully. "
    texts = [before + ITEMS[0][1] + ". Outro stays too, with many more words than were cut out of it.", "clean text", None, "", ITEMS[0][1]]
    docs = docs_of(texts)
    found = {r.doc_id: r for r in d.remove_hits(docs, benchmark).collect()}
    assert d.remove_hits(docs, benchmark).columns == docs.columns
    assert found[0].text == before + ". Outro stays too, with many more words than were cut out of it."
    assert found[1].text == "clean text" and found[2].text is None and found[3].text == "" and 4 not in found


def test_empty_tables(spark, docs_of):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.find_hits(docs_of(["x"]).where("false"), benchmark).count() == 0
    assert [r.n_hit for r in d.find_hits(docs_of(["short item"]), benchmark.where("false")).collect()] == [0]
