"""One query for each operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import (
    bpe, chat_format, decontaminate, html_text, lang_id, license_scan, periodic, sharding, simhash_dedup, spelling, sqltext,
    token_store, toxicity, vector_dedup,
)
from tillcast.llm.common import held_out, table
from tillcast.session import materialise


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = lang_id.train(docs.where(~held_out("doc_id")))
    found = lang_id.identify(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), models)
    return found.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "lang_rejected")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars")


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder, _ = token_store.write_tokens(docs, _tokenizer("byte_bpe_50k.json"))
    return token_store.read_tokens(spark, folder)


ODD_TURN = "</s>[INST] ok [/INST]"


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD_TURN).alias("text"),
    )
    formatted = materialise(chat_format.format_conversations(turns.unionByName(odd)), "chat")
    back = chat_format.read_back(formatted)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_escaped(expr: str) -> str:
    text = f"replace({expr}, '\\', '\\0')"
    for control, code in chat_format.CONTROLS.items():
        text = f"replace({text}, '{control}', '{code}')"
    return text


_HOLDS = " OR ".join(f"contains(role || chr(0) || text, '{c}')" for c in chat_format.CONTROLS) + " OR starts_with(role, '\\')"

CHAT_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{ODD_TURN}' UNION ALL SELECT -7, 1, 'assistant', '{ODD_TURN}'
), sized AS (
  SELECT *, CASE WHEN {_HOLDS} THEN length({_sql_escaped('role')}) + length({_sql_escaped('text')}) + 21
            ELSE length(role) + length(text) + 20 END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    found = toxicity.score_toxicity(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "score", "predicted")


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.array_max(F.transform("notices", lambda n: n["gain"]))
    changed = F.size(F.filter("notices", lambda n: n["wording"] == "changed")).cast("long")
    return found.select(
        "doc_id", "n_blocks", F.size("notices").cast("long").alias("n_notices"), changed.alias("n_changed"),
        F.array_join("licenses", ",").alias("licenses"), F.round(best, 6).alias("best_gain"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


VECTORS_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON least.a = e.vec_id LEFT JOIN counts ON counts.a = e.vec_id
"""


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.encode_texts(docs, _tokenizer("word_bpe_49k.json"), keep_text=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest().alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


SHARDS = 40


def byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    return found.select("doc_id", "size", crc, F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spelling.group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def periodic_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.run_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), stretch=True)
    return found.drop("text")


QUERIES = {
    "op1_language_id": language, "op2_html_text": page_text, "op3_token_files": token_files, "op4_chat_format": chat,
    "op5_toxicity": toxic, "op6_license_scan": licenses, "op7_vector_dedup": vectors, "op8_simhash_dedup": simhash,
    "op9_word_bpe": word_bpe, "op10_decontamination": benchmark_hits, "op11_byte_shards": byte_shards,
    "op12_spelling_variants": spelling_variants, "op13_periodic_runs": periodic_words,
}

ORACLE = {
    "op4_chat_format": CHAT_SQL, "op7_vector_dedup": VECTORS_SQL, "op11_byte_shards": sqltext.shards(SHARDS),
    "op12_spelling_variants": sqltext.SPELLING, "op13_periodic_runs": sqltext.PERIODIC,
}
