import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tillcast.llm import token_store

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_round_trip(spark, docs_of):
    texts = ["one two", None, "", "x y z " * 300, "one two", "ünïcode  and\nlines"] * 5
    ids = [29 - i for i in range(30)]
    folder, manifest = token_store.write_tokens(docs_of(texts, ids), PATH, shards=4)
    found = token_store.read_tokens(spark, folder).orderBy("doc_id").collect()
    library, start = Tokenizer.from_file(PATH), 0
    by_id = dict(zip(ids, texts))
    assert [r.doc_id for r in found] == sorted(ids)
    for r in found:
        wanted = [*library.encode(by_id[r.doc_id] or "", add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(wanted), zlib.crc32(np.array(wanted, "<u4").tobytes()))
        start += len(wanted)
    assert manifest.agg({"tokens": "sum"}).first()[0] == start


def test_repeated_and_null_ids(spark, docs_of):
    docs = docs_of(["b", "a", "c", "d"], [5, 5, None, None])
    folder, _ = token_store.write_tokens(docs, PATH, shards=2)
    found = sorted(token_store.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, None, 5, 5] and [r.start for r in found] == [0, 2, 4, 6]


def test_empty_table(spark, docs_of):
    folder, manifest = token_store.write_tokens(docs_of(["x"]).where("false"), PATH)
    assert manifest.count() == 0 and token_store.read_tokens(spark, folder).count() == 0
