"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is written as ``<s>[INST]role[/INST]text</s>``. Written turns are parsed again by a fixed grammar; a turn
whose recovered role and text differ from the source, or that holds a control string, is written escaped, and a
conversation that still differs as a whole gets all its turns escaped. ``[INST]\\`` opens an escaped turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template, and the code that stands for each in an escaped text.
CONTROLS = {"</s>": "\\1", "<s>": "\\2", "[INST]": "\\3", "[/INST]": "\\4"}
TRAINED_ROLE = "assistant"

_TURN = r"(?s)^<s>\[INST\](\\?)(.*?)\[/INST\](.*)$"


def escape(text: Column) -> Column:
    """No control string is left; a backslash always begins a code of two characters."""
    text = F.replace(text, F.lit("\\"), F.lit("\\0"))
    for control, code in CONTROLS.items():
        text = F.replace(text, F.lit(control), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for control, code in CONTROLS.items():
        text = F.replace(text, F.lit(code), F.lit(control))
    return F.replace(text, F.lit("\\0"), F.lit("\\"))


def written(role: Column, text: Column, escaped: Column) -> Column:
    plain = F.concat(F.lit("<s>[INST]"), role, F.lit("[/INST]"), text, F.lit("</s>"))
    coded = F.concat(F.lit("<s>[INST]\\"), escape(role), F.lit("[/INST]"), escape(text), F.lit("</s>"))
    return F.when(escaped, coded).otherwise(plain)


def segments(formatted: Column) -> Column:
    """The turns of a written conversation, without their end mark."""
    return F.filter(F.split(formatted, "</s>", -1), lambda x: x != "")


def parsed(segment: Column) -> Column:
    """Role, text and whether it is escaped, of one written turn; role is null where the grammar does not fit."""
    coded = F.regexp_extract(segment, _TURN, 1) != ""
    role, text = F.regexp_extract(segment, _TURN, 2), F.regexp_extract(segment, _TURN, 3)
    return F.struct(
        F.when(segment.rlike(_TURN), F.when(coded, unescape(role)).otherwise(role)).alias("role"),
        F.when(coded, unescape(text)).otherwise(text).alias("text"), coded.alias("escaped"),
    )


def format_conversations(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """(conversation, n_turns, formatted, loss_mask): a row for each conversation.

    ``loss_mask`` lists the spans to be trained on, the assistant's texts as they are written: the turn (from 1),
    the start in ``formatted`` and in the turn's own string, and the length, in code points. Null roles and texts
    are empty. Turns are ordered by ``turn``, then role and text, nulls first; repeated turns all stay. Rows with
    a null conversation make one of their own. Other columns are left out.
    """
    rows = turns.select(
        F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    back = parsed(F.element_at(segments(F.col("plain")), 1))
    holds = F.lit(False)
    for control in CONTROLS:
        holds = holds | F.contains("text", F.lit(control)) | F.contains("role", F.lit(control))
    same = (F.size(segments(F.col("plain"))) == 1) & back["role"].eqNullSafe(F.col("role")) & (back["text"] == F.col("text"))
    rows = rows.withColumn("plain", written(F.col("role"), F.col("text"), F.lit(False)))
    rows = rows.withColumn("escaped", holds | ~F.coalesce(same, F.lit(False)))
    rows = rows.withColumn("out", F.when(F.col("escaped"), written(F.col("role"), F.col("text"), F.lit(True))).otherwise(F.col("plain")))
    rows = rows.drop("plain", "escaped")
    gathered = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "out"))).alias("turns"))
    # the round trip of the whole conversation
    again = F.transform(segments(F.array_join(F.transform("turns", lambda t: t["out"]), "")), lambda s: F.struct(parsed(s)["role"].alias("role"), parsed(s)["text"].alias("text")))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    gathered = gathered.withColumn("same", again.eqNullSafe(source))
    coded = F.transform("turns", lambda t: F.struct(t["turn"], t["role"], t["text"], written(t["role"], t["text"], F.lit(True)).alias("out")))
    gathered = gathered.withColumn("turns", F.when(F.col("same"), F.col("turns")).otherwise(coded))
    # where each turn starts: a running sum over the lengths
    sizes = F.transform("turns", lambda t: F.length(t["out"]).cast("long"))
    gathered = gathered.withColumn("starts", F.aggregate(
        sizes, F.array(F.lit(0).cast("long")), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)),
    ))
    marks = F.transform("turns", lambda t, i: F.struct(
        (i + 1).alias("turn"), t["role"].alias("role"), F.element_at("starts", i + 1).alias("begin"),
        (F.instr(t["out"], "[/INST]") + F.lit(len("[/INST]") - 1)).alias("head"), F.length(t["out"]).alias("size"),
    ))
    mask = F.transform(F.filter(marks, lambda m: m["role"] == TRAINED_ROLE), lambda m: F.struct(
        m["turn"].alias("turn"), (m["begin"] + m["head"]).alias("start"), m["head"].alias("offset"),
        (m["size"] - m["head"] - F.lit(len("</s>"))).alias("length"),
    ))
    return gathered.select(
        F.col("conv").alias(conversation), F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["out"]), "").alias("formatted"), mask.alias("loss_mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with turns (role and text, recovered by the parser) and loss_text (all text under the mask)."""
    cut = formatted.withColumn("_segments", segments(F.col("formatted")))
    turns = F.transform("_segments", lambda s: F.struct(parsed(s)["role"].alias("role"), parsed(s)["text"].alias("text")))

    def under(m):
        segment = F.element_at("_segments", m["turn"])
        part = F.substring(segment, m["offset"] + 1, m["length"])
        return F.when(F.startswith(segment, F.lit("<s>[INST]\\")), unescape(part)).otherwise(part)

    return cut.withColumn("turns", turns).withColumn("loss_text", F.array_join(F.transform("loss_mask", under), "")).drop("_segments")
