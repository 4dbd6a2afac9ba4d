"""The registered queries of the operators, over the tables of the test data."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.llm import alignment, bpe, decontam, divergence, divergence_sql, langid, mixing, mixture, outliers, quality_mil, rlz, sharding, simhash, tokenfile
from chatlake.llm.common import remainder, remove_tree, table, text_of
from chatlake.session import checkpointed, staged_path


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digest(bpe.encode(table(spark, sf_dir, "documents"), path), path)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = staged_path(spark, "token-files")
    tokenfile.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), out, end_id=1)
    rows = checkpointed(
        tokenfile.read(spark, out).select(
            "doc_id",
            "file",
            "file_start",
            F.expr("octet_length(ids) div 4").alias("n_tokens"),
            F.crc32("ids").alias("ids_crc32"),
        )
    )
    remove_tree(spark, out)
    return tokenfile.positions(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_of()
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.xxhash64(text).alias("text_hash"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    shards = sharding.shard_by_size(docs, 16, F.col("size"), F.col("text_hash"))
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs, remainder("doc_id", 4) != 2)
    found = langid.identify(docs, model)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op5_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_mil.learn(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return quality_mil.score(docs, model).select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = outliers.with_statistics(table(spark, sf_dir, "documents"))
    slim = checkpointed(counted.select("doc_id", "lang", "source", *outliers.STATISTICS, "base_failed"))
    return outliers.Rules(slim).judge(slim).drop("lang", "source")


def op8_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.removal(table(spark, sf_dir, "documents")).drop("factors")


def op10_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 7) == 2
    trained = mixing.Trained(docs, ~held_out)
    return mixing.score(docs, trained).withColumn("held_out", held_out)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.Audit(table(spark, sf_dir, "documents")).report()


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.alignment(table(spark, sf_dir, "documents"), *paths)


def op13_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = checkpointed(docs.select("doc_id", "source", mixture.word_count().alias("size"), F.xxhash64("text").alias("text_hash")))
    weights = mixture.cyclic_weights(mixture.source_sizes(sized), [1, 2, 3])
    mixed = mixture.mix(sized, weights, tie=F.col("text_hash"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "part")


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_token_files": op2_token_files,
    "op3_histogram_shards": op3_histogram_shards,
    "op4_cross_parsing_language": op4_cross_parsing_language,
    "op5_attention_quality": op5_attention_quality,
    "op6_simhash": op6_simhash,
    "op7_robust_outliers": op7_robust_outliers,
    "op8_template_leaks": op8_template_leaks,
    "op9_relative_lz": op9_relative_lz,
    "op10_context_mixing": op10_context_mixing,
    "op11_source_divergence": op11_source_divergence,
    "op12_token_alignment": op12_token_alignment,
    "op13_source_mixture": op13_source_mixture,
}

# The other results cannot be written in SQL; tests/llm compares them with brute force, exact
# round trips or held-out labels.
ORACLE: dict[str, str] = {
    "op11_source_divergence": divergence_sql.SQL,
    "op9_relative_lz": r"""
        WITH split AS (
            SELECT doc_id, [w FOR w IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words
            FROM documents),
        windows AS (
            SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM split)),
        first AS (SELECT w, min(doc_id) AS source FROM windows GROUP BY w),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
            FROM windows JOIN first USING (w) WHERE source < doc_id),
        placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
            FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
            sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (doc_id)
    """,
}
