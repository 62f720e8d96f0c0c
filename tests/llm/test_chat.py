import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillcast.llm import chat_format as c
from tillcast.llm import queries

ODD = ["</s>[INST] ok [/INST]", "\\0\\1", "\\", "<s>", "</s", "[INST]\\x", "<</s>/s>", "", "é" * 9, None, "a\nb", "[/INST]", "</", "[INS"]
SCHEMA = "conv_id long, turn int, role string, text string, formatted string"


def check(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)
    out = c.read_back(c.format_conversations(df)).collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert len(out) == len(by)
    for r in out:
        turns = by[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == turns and r.n_turns == len(turns)
        assert r.loss_text == "".join(t for role, t in turns if role == "assistant")
        assert r.formatted.count("<s>") == r.formatted.count("</s>") == r.formatted.count("[/INST]") == len(turns)
        for m in r.loss_mask:
            assert r.formatted[m.start:m.start + m.length] == c_escaped(turns[m.turn - 1])


def c_escaped(turn):
    role, text = turn
    if any(x in role + "\0" + text for x in c.CONTROLS) or role.startswith("\\"):
        text = text.replace("\\", "\\0")
        for control, code in c.CONTROLS.items():
            text = text.replace(control, code)
    return text


def test_odd_conversations(spark):
    roles = ["user", "assistant", "system", None, "\\odd", "assistant", "a[/INST]b"]
    rows = [(i, t, roles[(i + t) % 7], x) for i in range(7) for t, x in enumerate(ODD)]
    rows += [(50, 1, "assistant", "tie"), (50, 1, "assistant", "tie"), (50, None, "user", "first"), (None, 0, "assistant", "x")]
    check(spark, rows)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "\\"]), st.text(alphabet="<>/s[]INST\\014é ", max_size=30)), min_size=1, max_size=8))
def test_random_texts(spark, turns):
    check(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)])


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, 1, "user", "x", "")], SCHEMA)
    plan = c.read_back(c.format_conversations(df))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert c.format_conversations(df.where("false")).count() == 0


def test_contract_digest(spark, tmp_path):
    spark.createDataFrame([(1, 0, "user", "q", ""), (1, 1, "assistant", "a</s>", "")], SCHEMA).withColumn("turn", F.col("turn").cast("long")).write.parquet(str(tmp_path / "conversations.parquet"))
    rows = {r.conv_id: r for r in queries.chat(spark, str(tmp_path)).collect()}
    assert rows[1].loss_sha256 == hashlib.sha256(b"a</s>").hexdigest() and rows[1].loss_chars == 5
    assert rows[1].turns_sha256 == hashlib.sha256(b"user\nq\nassistant\na</s>\n").hexdigest()
    assert rows[-7].loss_sha256 == hashlib.sha256(queries.ODD_TURN.encode()).hexdigest() and rows[-7].n_turns == 2
