"""Registered queries of the training-data operators: name -> callable(spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.llm import bpe, chat, decontaminate, dual_tree, mixing, near_dup, pii, quality, repeats, resample, urls, vectors, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sainte_lague_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op2_rule_ensemble(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_positional_index(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
        F.size("near_items").cast("bigint").alias("n_near_items"))


@query
def op4_warc_segments(spark, sf_dir):
    read = warc.archive_and_read(table(spark, sf_dir, "pages"), payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


@query
def op5_candidate_boosting(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{k}" for k in pii.KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op6_relational_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digests(chat.format_chats(turns.unionByName(control)))


SQL["op6_relational_chat"] = chat.SQL


@query
def op7_nn_descent(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op8_url_vocabulary(spark, sf_dir, vocabulary: str | None = None):
    """``vocabulary`` may be the path of a term table (``urls.read_vocabulary``)."""
    terms = urls.read_vocabulary(spark, vocabulary) if vocabulary else None
    return urls.judge(table(spark, sf_dir, "pages"), vocabulary=terms).select("page_id", "host", "path", "rule", "verdict")


SQL["op8_url_vocabulary"] = urls.sql()


@query
def op9_suffix_array_repeats(spark, sf_dir):
    cleaned = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_minhash_lsh_forest(spark, sf_dir):
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op11_importance_resampling(spark, sf_dir):
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_dual_tree_search(spark, sf_dir):
    return dual_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op12_dual_tree_search"] = dual_tree.sql()


@query
def op13_byte_bpe(spark, sf_dir):
    import public_tokenizers  # only the driver needs the file

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    read = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return read.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(bpe.ids_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
