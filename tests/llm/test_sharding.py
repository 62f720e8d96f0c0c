import random

import pytest
from pyspark.sql import functions as F

from tillcast.llm import sharding


def brute(rows, shards):
    """(key, size) in order to (shard, slot): the shard whose share of the bytes holds the middle of the row."""
    total, before, slots, out = sum(s for _, s in rows), 0, {}, []
    for _, size in rows:
        shard = min(shards - 1, (2 * before + size) * shards // max(1, 2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        out.append((shard, slots[shard]))
        before += size
    return out


@pytest.mark.parametrize(("shards", "partitions"), [(1, 3), (7, 1), (7, 5), (40, 3), (300, 4)])
def test_equals_running_sums(spark, docs_of, shards, partitions):
    draw = random.Random(shards)
    texts = [None if i % 17 == 0 else "é" * draw.randrange(60) for i in range(200)]
    texts[50] = "long " * 5000
    ids = draw.sample(range(-500, 500), 200)
    found = sharding.assign_shards(docs_of(texts, ids), shards, partitions=partitions).collect()
    rows = sorted((i, len((t or "").encode()) + 16) for i, t in zip(ids, texts))
    wanted = {i: (size, *place) for (i, size), place in zip(rows, brute(rows, shards))}
    assert {r.doc_id: (r["size"], r.shard, r.slot) for r in found} == wanted


def test_one_key_and_one_row_fill_many_shards(spark, docs_of):
    texts = ["the same text"] * 300 + [f"other {i}" for i in range(100)] + [None] * 50
    ids = [7] * 350 + [None] * 100
    found = sharding.assign_shards(docs_of(texts, ids), 10, partitions=6).cache()
    per = found.groupBy("shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high")).collect()
    share = sum(r.bytes for r in per) / 10
    assert len(per) == 10 and all(abs(r.bytes - share) <= 29 and r.low == 0 and r.high == r.n - 1 for r in per)
    assert found.groupBy("text").count().where("text = 'the same text'").first()["count"] == 300
    assert {r.shard for r in found.where("doc_id is null").select("shard").collect()}.isdisjoint({9})  # null keys come first


def test_columns_of_the_same_name(spark, docs_of):
    docs = docs_of(["a", "bb"]).withColumns({"shard": F.lit("mine"), "row": F.lit(1.5), "part": F.lit(None), "tie": F.lit("t"), "place": F.lit(3)})
    found = sharding.assign_shards(docs, 2)
    assert found.columns == [*(c for c in docs.columns if c != "shard"), "size", "shard", "slot"]
    assert {(r.text, r.row, r.tie, r.place) for r in found.collect()} == {("a", 1.5, "t", 3), ("bb", 1.5, "t", 3)}


def test_empty_table_and_own_size(spark, docs_of):
    assert sharding.assign_shards(docs_of(["x"]).where("false")).count() == 0
    none = sharding.assign_shards(docs_of(["x", "y"]), 3, size=F.lit(0)).collect()
    assert [(r.shard, r.slot) for r in sorted(none, key=lambda r: r.slot)] == [(0, 0), (0, 1)]
    with pytest.raises(ValueError):
        sharding.assign_shards(docs_of(["x"]), 0)


def test_written_shards(spark, docs_of, tmp_path):
    back = sharding.write_shards(docs_of([f"text {i}" for i in range(40)]), str(tmp_path / "out"), shards=4)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == [(i, f"text {i}") for i in range(40)]
    assert {p.name for p in (tmp_path / "out").glob("shard=*")} == {f"shard={i}" for i in range(4)}


def test_plan_is_native(spark, docs_of):
    plan = sharding.assign_shards(docs_of(["a", "b"]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
