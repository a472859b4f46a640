"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import token_digests
from tidemark.llm.golay_dedup import near_duplicates
from tidemark.llm.grid_join import near_vectors
from tidemark.llm.hard_negatives import mine_negatives
from tidemark.llm.language_id import identify_language, train_language_model
from tidemark.llm.line_dedup import drop_shared_lines
from tidemark.llm.packing import pack_documents
from tidemark.llm.periodic_runs import find_runs, repeat_tail
from tidemark.llm.quality import score_quality, train_quality_model
from tidemark.llm.repeats import remove_repeats
from tidemark.llm.repetition import quality_rules
from tidemark.llm.sampling import held_out
from tidemark.llm.sharding import assign_shards
from tidemark.llm.simhash_index import as_text, count_neighbours, fingerprint_with_edits
from tidemark.session import stage

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", "text")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    labelled = docs.where(~held_out("doc_id")).select("doc_id", "text", "lang")
    model = train_language_model(labelled)
    found = identify_language(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """n_near: other documents within 3 bits, for the query set of ids divisible by 20."""
    found = stage(fingerprint_with_edits(_texts(spark, folder)), "fingerprint-rows")
    prints = found.select(F.col("fingerprint").alias("print"), "doc_id")
    near = count_neighbours(prints.select("print"), prints.where(F.col("doc_id") % 20 == 0).select("print"))
    return (
        found.join(near, F.col("fingerprint") == F.col("print"), "left")
        .withColumn("n_near", F.when(F.col("doc_id") % 20 == 0, F.col("near") - 1))
        .select(
            "doc_id", "n_chars", "edited_sha256",
            as_text(F.col("fingerprint")).alias("fingerprint"),
            as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
            "near_edited", "near_next", "n_near",
        )
    )


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_texts(spark, folder), TOKENIZER)


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = remove_repeats(_texts(spark, folder), length=200)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(_texts(spark, folder), words=4, bits=4)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``bytes``, with which no shard is grown."""
    placed = assign_shards(_texts(spark, folder), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _texts(spark, folder)
    labels = _table(spark, folder, "labels").where(~held_out("doc_id"))
    scored = score_quality(docs, train_quality_model(docs, labels), keep=["doc_id"])
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(_table(spark, folder, "embeddings"), least=0.93)


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = drop_shared_lines(_texts(spark, folder))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(_texts(spark, folder), TOKENIZER, ["doc_id"])


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One document in ten first gets a periodic tail, chosen by its id; a null id gets none."""
    h, g = F.crc32(F.col("doc_id").cast("string")), F.expr("crc32(CAST(doc_id AS STRING)) div 10")
    n = F.size(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    at = (g % n).cast("int")
    width = (1 + F.floor((n - at) / (3 + g % 8))).cast("int")
    planted = F.when((h % 10 == 0) & (n > 0), repeat_tail(F.col("text"), at, width)).otherwise(F.col("text"))
    found = find_runs(_texts(spark, folder).withColumn("text", planted), keep=["doc_id"])
    # Greatest length, then smallest start, then smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules(_texts(spark, folder), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_fingerprints": op2_fingerprints,
    "op3_packing": op3_packing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_sharding": op6_sharding,
    "op7_quality": op7_quality,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_bpe": op10_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_quality_rules": op13_quality_rules,
}

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWERED = "translate(trim(line, {b}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format(b=_BLANKS)

ORACLES: dict[str, str] = {
    "op8_embedding_dedup": """
        WITH RECURSIVE sound AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM sound a
            JOIN sound b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.93
        ), reach(v, low) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.v
        ), least AS (SELECT v, min(low) AS component_id FROM reach GROUP BY v),
        degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(d.n, 0) AS n_links, t.component_id, e.vec_id = t.component_id AS kept
        FROM embeddings e JOIN least t ON t.v = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id""",
    "op9_line_dedup": f"""
        WITH cut AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), numbered AS (
            SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM cut
        ), keys AS (
            SELECT doc_id, place, line, {_LOWERED} AS key FROM numbered
        ), shared AS (
            SELECT key FROM keys WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        ), marked AS (
            SELECT k.*, s.key IS NOT NULL AS gone FROM keys k LEFT JOIN shared s ON s.key = k.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op12_hard_negatives": """
        WITH sound AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                   list_dot_product(a.v, b.v)::BIGINT AS score
            FROM sound a JOIN sound b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
            WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
        )
        SELECT p.anchor_id, positive_id,
               row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
               other AS negative_id, positive_score, score AS negative_score
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
             AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5""",
    "op13_quality_rules": r"""
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), base AS (
            SELECT doc_id, len(ws) AS n_words,
                   coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM cut
        ), words AS (
            SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i, len(ws) AS n FROM cut
        ), windows AS (
            SELECT doc_id, i, CASE WHEN i + 8 <= n THEN concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o,
                   lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o, lead(word, 6) OVER o,
                   lead(word, 7) OVER o) END AS win
            FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
        ), again AS (
            SELECT doc_id, i, win, win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 AS hit FROM windows
        ), covered AS (
            SELECT doc_id, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c
            FROM again
        ), repeats AS (SELECT doc_id, count(*) FILTER (c) AS n_repeat_words FROM covered GROUP BY doc_id
        ), judged AS (
            SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words,
                   n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words AS base_failed
            FROM base LEFT JOIN repeats USING (doc_id)
        ), pairs AS (
            SELECT a.doc_id, b.i - a.i AS apart, a.i FROM again a JOIN again b
            ON a.doc_id = b.doc_id AND a.win = b.win AND a.i < b.i AND a.hit AND b.hit
            WHERE a.doc_id IN (SELECT doc_id FROM judged WHERE NOT base_failed)
        ), islands AS (
            SELECT doc_id, apart, i - row_number() OVER (PARTITION BY doc_id, apart ORDER BY i) AS island FROM pairs
        ), longest AS (
            SELECT doc_id, max(size) + 7 AS size FROM (
                SELECT doc_id, count(*) AS size FROM islands GROUP BY doc_id, apart, island) GROUP BY doc_id
        )
        SELECT j.*, NOT base_failed AND 100 * coalesce(size, 0) <= 20 * n_words AS kept
        FROM judged j LEFT JOIN longest USING (doc_id)""",
}
