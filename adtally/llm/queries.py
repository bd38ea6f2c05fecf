"""One named query per operator of this package, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import (
    bpe, chat, language_id, line_templates, mixture, nearest, personal_data, quality, sharding, shingle_join,
    spelling, spot_signatures, whitening,
)
from adtally.llm.common import fold, read_table


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.decode(bpe.encode(read_table(spark, folder, "documents"), path), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_nearest(spark: SparkSession, folder: str) -> DataFrame:
    index = nearest.build_index(read_table(spark, folder, "embeddings"))
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return nearest.search(index, F.col("vec_id") % 20 == 0)


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = personal_data.find(docs, personal_data.learn(docs))
    # The contract's counts are of base spans; the operator's own count added ones too.
    counts = [F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}") for kind in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = quality.learn(docs, read_table(spark, folder, "labels"), fold("doc_id", 5) != 0)
    held = docs.withColumn("held_out", fold("doc_id", 5) == 0)
    scored = quality.score(held, model, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    found = shingle_join.join_similar(read_table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mix_sources(read_table(spark, folder, "documents")).documents.drop("source")


def op7_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    found = spot_signatures.fingerprint_neighbours(read_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
    )


def op8_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs).select(
        "doc_id", "text", F.length("text").cast("long").alias("n_chars"), "n_dropped"
    )


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    rows = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    made = chat.format_conversations(
        chat.as_chain(rows, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text")
    )
    turns = made.withColumn("turns", chat.read_back(F.col("formatted")))
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    # Read off the output: what stands under the mask, unescaped.
    under = lambda s: F.substr(F.col("formatted"), (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int"))
    trained = F.array_join(F.transform("loss_spans", lambda s: chat.unescaped(under(s))), "")
    return turns.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(each, ""), 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


CHAT_SQL = """
WITH given AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), clean AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM given
), pieces AS (
    SELECT *, '<turn>' || replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&br;') || chr(10)
        || replace(replace(text, '&', '&amp;'), '<', '&lt;') || '</turn>' || chr(10) AS piece
    FROM clean
), joined AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(length(piece)) AS formatted
    FROM pieces GROUP BY conv_id
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256,
    CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
    CAST(formatted AS BIGINT) AS formatted_chars
FROM joined
"""


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = language_id.learn(docs, fold("doc_id", 3) != 1)
    held = docs.withColumn("held_out", fold("doc_id", 3) == 1)
    return language_id.predict(held, model, keep=("doc_id", "held_out"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    made = whitening.whiten(read_table(spark, folder, "embeddings"))
    # A long holds the deviations of some ten million vectors; the operator's decimals go on, the column is null.
    return made.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    made = sharding.shard_by_bytes(read_table(spark, folder, "documents"), shards=8)
    return made.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_forms(read_table(spark, folder, "documents"))


# The crc32 of a text's bytes, by a table of 256 remainders; near words by what is left when a letter is dropped.
SPELLING_SQL = """
WITH RECURSIVE steps AS (
    SELECT i AS i, 0 AS k, CAST(i AS BIGINT) AS c FROM range(256) AS r(i)
    UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), remainders AS MATERIALIZED (
    SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8
), runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), counted AS MATERIALIZED (
    SELECT doc_id, run, count(*) AS times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS digits
    FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run
), hashed AS (
    SELECT run, times, xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(digits) // 2), lambda i: CAST('0x' || substr(digits, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) AS h
    FROM counted, remainders
), words AS MATERIALIZED (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
        SELECT times, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), dropped AS MATERIALIZED (
    SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), pairs AS (
    SELECT a.word, b.word AS near FROM dropped a JOIN dropped b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT w.word, d.word FROM words w JOIN dropped d ON d.rest = w.word
    UNION SELECT d.word, w.word FROM words w JOIN dropped d ON d.rest = w.word
), nearest AS (
    SELECT p.word, count(*) AS n_near, arg_min(p.near, struct_pack(m := -v.n, w := p.near)) AS best, max(v.n) AS best_n
    FROM pairs p JOIN words v ON v.word = p.near GROUP BY p.word
), forms AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form, CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
    FROM words w LEFT JOIN nearest USING (word)
), ways AS (
    SELECT word, word AS place, 0 AS k FROM forms
    UNION ALL SELECT ways.word, forms.form, k + 1 FROM ways JOIN forms ON forms.word = ways.place WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, arg_max(place, k) AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f JOIN ways USING (word) GROUP BY f.word, f.form, f.n, f.n_near, f.form_n
"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_bpe": op1_bpe, "op2_nearest": op2_nearest,
        "op3_personal_data": op3_personal_data,
        "op4_quality": op4_quality, "op5_shingle_join": op5_shingle_join,
        "op6_mixture": op6_mixture, "op7_spot_signatures": op7_spot_signatures,
        "op8_line_templates": op8_line_templates,
        "op9_chat": op9_chat, "op10_language_id": op10_language_id,
        "op11_whitening": op11_whitening, "op12_kd_shards": op12_kd_shards, "op13_spelling": op13_spelling}


def llm_oracles() -> dict[str, str]:
    return {"op9_chat": CHAT_SQL, "op13_spelling": SPELLING_SQL}
