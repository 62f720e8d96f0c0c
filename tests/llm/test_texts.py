"""Languages, toxicity, licenses and pages: held-out accuracy, odd inputs, and small cases with known results."""

import random

import pytest

from tillcast.llm import html_text, lang_id, license_scan, toxicity
from tillcast.llm.common import held_out

SYLLABLES = {"aa": "ka to mi ren sul", "bb": "zw ij oe schr ach", "cc": "ñu lle ció qui ão"}
ODD = [None, "", "  \n", "12 34 !!", "½ ²", "x" * 300_000]


def prose(rng, lang, words=60):
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus(docs_of):
    rng = random.Random(4)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(300)]
    return docs_of([prose(rng, g) for g in langs], langs=langs)


def test_language_of_held_out_texts(corpus):
    models = lang_id.train(corpus.where(~held_out("doc_id")))
    assert models.languages == ["aa", "bb", "cc"]
    rows = lang_id.identify(corpus.where(held_out("doc_id")), models).collect()
    assert len(rows) > 30 and all(r.lang_pred == r.lang and 0 <= r.score <= 1 and not r.lang_rejected for r in rows)


def test_language_of_odd_texts(corpus, docs_of):
    models = lang_id.train(corpus)
    rows = {r.doc_id: r for r in lang_id.identify(docs_of([*ODD, "ka to"]), models).collect()}
    assert [rows[i].lang_pred for i in range(5)] == ["und"] * 5 and all(rows[i].lang_rejected and rows[i].score == 0 for i in range(5))
    assert rows[5].lang_pred in models.languages and rows[6].lang_pred == "aa"
    assert lang_id.identify(corpus.where("false"), models).count() == 0


def test_no_language_to_learn(docs_of):
    docs = docs_of(["a b", None], langs=[None, "aa"])
    assert {r.lang_pred for r in lang_id.identify(docs, lang_id.train(docs)).collect()} == {"und"}


def test_kneser_ney_sums_to_one(corpus):
    model = lang_id.train(corpus.where("lang = 'aa'")).models[0]
    letters = sorted({c for w in SYLLABLES["aa"].split() for c in w} | {" "})
    import numpy as np

    for context in ("    ", "  ka", "toka", "renr", "qqqq"):
        joined = "".join(context + x for x in letters)
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.uint64)
        spots = np.arange(len(letters)) * 5 + 4
        total = np.exp(model.log_probabilities(codes, spots, 1 / len(letters))).sum()
        assert abs(total - 1) < 1e-4


def toxic_table(docs_of, spark, n=400):
    rng = random.Random(9)
    texts, labels = [], []
    for i in range(n):
        words = prose(rng, "aa", 80).split()
        bad = i % 4 == 0
        for _ in range(4 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["blarg", "snod", "grufka", "gruftomi", "gruful", "grufren"]))
        texts.append(" ".join(words) + ".")
        labels.append((i, int(bad)))
    return docs_of(texts), spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")


def test_toxicity_of_held_out_texts(docs_of, spark):
    docs, labels = toxic_table(docs_of, spark)
    model = toxicity.train(docs, labels)
    found = toxicity.score_toxicity(docs, model).where(held_out("doc_id")).collect()
    assert all(r.predicted == int(r.doc_id % 4 == 0) and 0 <= r.score <= 1 for r in found) and len(found) > 40
    odd = toxicity.score_toxicity(docs_of(ODD), model).collect()
    assert [r.predicted for r in odd] == [0] * len(ODD)
    assert toxicity.score_toxicity(docs.where("false"), model).count() == 0


def test_no_labels(docs_of, spark):
    docs, labels = toxic_table(docs_of, spark, 8)
    model = toxicity.train(docs, labels.where("false"))
    assert {r.predicted for r in toxicity.score_toxicity(docs, model).collect()} == {0}


def test_clause_grammar():
    model = toxicity.ToxicityModel({"oaf": 4.0}, {"gruf": 2.0}, None, (4, 8))
    scorer = model.scorer()

    def clauses(text):
        scorer.features([text])
        return [round(x, 3) for x in scorer.clauses(text.lower())]

    assert clauses("an oaf") == [4.0] and clauses("you oaf") == [5.0] and clauses("the gruffest") == [2.0]
    assert clauses("not an oaf") == [1.2] and clauses("he said oaf") == [2.5] and clauses("not. oaf") == [4.0]
    assert clauses("oaf. oaf!") == [4.0, 4.0] and clauses("kill you") == [1.0] and clauses("you kill") == []


def test_licenses(docs_of):
    texts = [
        "text\nReleased under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the GNU General Public License, version 3.", "This work is licensed under the GNU General Public License, version 2.",
        license_scan.TEMPLATES["MIT"].replace(". ", ".\n"), "his driver license expired and he asked permission to leave", *ODD,
        license_scan.TEMPLATES["MPL-2.0"].replace("distributed with", "shipped along with"),
    ]
    rows = {r.doc_id: r for r in license_scan.scan_licenses(docs_of(texts)).collect()}
    wanted = [["MIT"], ["CC-BY-NC-4.0"], ["CC-BY-SA-4.0"], ["GPL-3.0"], ["GPL-2.0"], ["MIT"], [], *[[] for _ in ODD], ["MPL-2.0"]]
    assert [rows[i].licenses for i in range(len(texts))] == wanted
    assert rows[0].notices[0].wording == "exact" and rows[len(texts) - 1].notices[-1].wording == "changed"


def test_all_notices_of_a_text(docs_of):
    filler = " ".join(f"word{i}" for i in range(200))
    bsd = license_scan.TEMPLATES["BSD-3-Clause"]
    texts = [
        f"{filler} Released under the MIT License. {filler}",
        "Licensed under the Apache License, Version 2.0. Released under the MIT License.",
        f"{filler}\n\n{bsd.replace(' 1. ', '\n\n1. ').replace(' 2. ', '\n\n2. ').replace(' 3. ', '\n\n3. ')}\n\n{filler}",
        f"{filler} {license_scan.TEMPLATES['MPL-2.0'].replace('distributed with', 'shipped along with')} {filler} {bsd.replace('specific prior', 'prior')}",
    ]
    rows = {r.doc_id: r for r in license_scan.scan_licenses(docs_of(texts)).collect()}
    found = [[(n.license, n.wording) for n in rows[i].notices] for i in range(len(texts))]
    assert found == [
        [("MIT", "exact")], [("Apache-2.0", "exact"), ("MIT", "exact")], [("BSD-3-Clause", "exact")],
        [("MPL-2.0", "changed"), ("BSD-3-Clause", "changed")],
    ]
    assert rows[0].notices[0].block == "Released under the MIT License"


def test_compression_decides_where_notices_are_looked_for(monkeypatch):
    filler = " ".join(f"word{i}" for i in range(3000))
    texts = [f"{filler} {t.replace(' ', chr(10))} {filler}" for t in license_scan.TEMPLATES.values()]
    scanner = license_scan.LicenseScanner()
    names = [n.removesuffix("-line") for n in license_scan.TEMPLATES]
    assert [[x[0] for x in scanner.scan(t)] for t in texts] == [[n] for n in names]  # each beside all other templates
    assert all(x[4] == "exact" and x[1] > 0.25 for t in texts for x in scanner.scan(t))
    monkeypatch.setattr(license_scan, "NOTICED", 1.0)  # no window shrinks to nothing: no template is looked for
    assert not any(scanner.scan(t) for t in texts)


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><article>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>First&nbsp;  par<b>a</b>graph
goes <a href=x>on</a>.<br>And on &lt;tag&gt; 1 < 2</p><aside>Side</aside><p>Two</p><form><input name="q"><p>Search</p></form>
<div class="ad">Buy</div><blockquote>Said</blockquote><section class="comments"><p>First!</p></section></article>
<div id="sidebar">Bar</div><footer>&copy; foot</footer></body></html>"""


def test_article():
    assert html_text.main_text(PAGE) == "Head & line\nFirst paragraph goes on. And on <tag> 1 < 2\nTwo\nSaid"


def test_page_without_article():
    body = "".join(f"<p>{'Some sentence of the body text goes here. ' * 3}{i}</p>" for i in range(5))
    page = f"<body><div><a href=1>One</a> <a href=2>Two</a></div><p>Hi</p>{body}<p>short</p>{body}<div><a href=3>Three link text</a></div></body>"
    lines = html_text.main_text(page).split("\n")
    assert len([x for x in lines if x.startswith("Some")]) == 10 and "short" in lines and not any("One" in x or "Three" in x for x in lines)


def test_body_beside_teaser_articles():
    body = [f"Ordinary paragraph {i} of the body text. " * 6 for i in range(6)]
    menu = "".join(f"<div><a href={i}>Menu entry {i}</a></div>" for i in range(5))
    cards = "".join(f"<article><h3>Card {i}</h3></article>" for i in range(3))
    page = f"<body>{menu}<div>{''.join(f'<p>{x}</p>' for x in body)}</div>{menu}{cards}{menu}</body>"
    lines = html_text.main_text(page).split("\n")
    assert [x for x in lines if not x.startswith("Menu")] == [*(x.strip() for x in body), "Card 0", "Card 1", "Card 2"]
    assert sum(x.startswith("Menu") for x in lines) < 5


def test_page_with_one_very_long_block():
    body = [f"Ordinary paragraph {i} of the body text. " * 6 for i in range(12)]
    body.insert(6, "Long block. " * 2_000)
    page = "<body><div><a href=1>One menu</a></div>" + "".join(f"<p>{x}</p>" for x in body) + "</body>"
    assert html_text.main_text(page).split("\n") == [x.strip() for x in body]


def test_page_with_lists_in_the_middle():
    body = [f"Ordinary paragraph {i} of the body text. " * 6 for i in range(8)]
    items = [f"item {i}" for i in range(9)]
    links = "".join(f"<li><a href={i}>Link number {i}</a></li>" for i in range(9))
    parts = [f"<p>{x}</p>" for x in body]
    page = f"<body>{''.join(parts[:3])}<ul>{''.join(f'<li>{x}</li>' for x in items)}</ul>{''.join(parts[3:6])}<ul>{links}</ul>{''.join(parts[6:])}</body>"
    assert html_text.main_text(page).split("\n") == [x.strip() for x in [*body[:3], *items, *body[3:]]]


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<script>x", "<!--", "</p>", "<nav>only a menu", "&#xFFFFFFF;", '<p class="a'])
def test_broken_pages(page):
    assert isinstance(html_text.main_text(page), str)


def test_extract_text(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, "u", None, "x"), (3, None, "<p>a" + "b " * 200_000, "x")], "page_id long, url string, html string, text string")
    rows = {r.page_id: r for r in html_text.extract_text(pages).collect()}
    assert rows[2].text == "" and rows[2].n_chars == 0 and rows[1].n_chars == len(rows[1].text) and rows[3].n_chars > 300_000
    assert html_text.extract_text(pages.where("false")).count() == 0
