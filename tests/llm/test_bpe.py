import hashlib
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillcast.llm import bpe, token_store

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
OURS = bpe.WordBpe(bpe.vocabulary(PATH))
THEIRS = Tokenizer.from_file(PATH)
BYTES_OURS = token_store.ByteEncoder(bpe.vocabulary(BYTES))
BYTES_THEIRS = Tokenizer.from_file(BYTES)

TEXTS = [
    "", " ", "Hello, World's 3rd   test!\n\nIt's 12345 o'clock", "ÀÉÎ straße ΣΑΣ Σ ǅ İstanbul", "áë  x y​z",
    "<|endoftext|>x<|startoftext|> <|endoftext|", "日本語テキスト 漢字 🎉👩‍👩‍👧", "a\x1cb\x1fc \x85d", "x" * 5000, "abcdefgh" * 700,
    "don't WE'LL they'd 'S", "\t\r\n", "é" * 40, "the  the   the",
]


def same(text):
    ids, decoded = OURS.encode([text])[0]
    wanted = THEIRS.encode(text or "", add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == wanted
    assert decoded == THEIRS.decode(wanted, skip_special_tokens=False)


def test_equals_the_library():
    for text in TEXTS:
        same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeABC 'sSt12,.\n\tàÉßø漢<|>́"), max_size=200))
def test_equals_the_library_on_random_text(text):
    same(text)


def test_both_trees_agree():
    rng = random.Random(1)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 64))) for _ in range(400)]
    for word, ids in zip(words, OURS.encode_words(words)):
        assert bpe.merge_long(OURS.symbols(word), OURS.pairs) == ids.tolist()


def test_encode_texts(spark, docs_of):
    texts = [*TEXTS, None, "the cat", "the cat"]
    rows = bpe.encode_texts(docs_of(texts), PATH).collect()
    assert len(rows) == len(texts) and {"lang", "score"} <= set(rows[0].asDict())
    for r in rows:
        wanted = THEIRS.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == wanted and r.n_tokens == len(wanted) and r.decoded == THEIRS.decode(wanted, skip_special_tokens=False)
    digests = {r.doc_id: r for r in bpe.encode_texts(docs_of(texts), PATH, keep_text=False).collect()}
    for r in rows:
        assert digests[r.doc_id].ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert digests[r.doc_id].decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert bpe.encode_texts(docs_of(["x"]).where("false"), PATH).count() == 0


def byte_ids(text):
    return np.frombuffer(BYTES_OURS.encode([text], None)[0], BYTES_OURS.kind).tolist()


def test_byte_pieces_equal_whole_texts():
    for text in [*TEXTS, "a  b", " lead", "trail ", "a \n b", "x  y", "a <|endoftext|> b<|endoftext|>"]:
        assert byte_ids(text) == BYTES_THEIRS.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcAB  'st12,.\n\tàÉ漢 \x1c"), max_size=120))
def test_byte_pieces_equal_whole_random_texts(text):
    assert byte_ids(text) == BYTES_THEIRS.encode(text, add_special_tokens=False).ids
