"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweft.llm import bpe_codec, chat_repair, collocations, decontaminate, licences, line_dedup, mixing, ngram_join, quality
from goldweft.llm import substring_dedup, token_counts, tool_chat, topk_search
from goldweft.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op1_token_counts(spark, sf_dir):
    return token_counts.count_tokens(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512
    )


@_query
def op2_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.withColumn("kept_sha256", F.sha2(F.col("text"), 256)).drop("text")


@_query
def op3_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels")))


@_query
def op4_topk_search(spark, sf_dir):
    return topk_search.top_k(read(spark, sf_dir, "embeddings"), k=5, every=50)


@_query
def op5_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"), F.array("source"))


@_query
def op6_licence_scan(spark, sf_dir):
    return licences.scan(read(spark, sf_dir, "documents"))


@_query
def op7_decontamination(spark, sf_dir):
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@_query
def op8_ngram_join(spark, sf_dir):
    return ngram_join.join(read(spark, sf_dir, "documents"))


@_query
def op9_substring_dedup(spark, sf_dir):
    kept = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2(F.col("kept"), 256)).drop("kept")


@_query
def op10_tool_chat(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations")
    calls, results = tool_chat.from_turns(turns)
    return tool_chat.format_chat(calls, results, tool_chat.context(turns)).withColumnRenamed("conv", "conv_id")


@_query
def op11_bpe_codec(spark, sf_dir):
    coded = bpe_codec.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@_query
def op12_collocations(spark, sf_dir):
    return collocations.collocations(read(spark, sf_dir, "documents"))


@_query
def op13_chat_repair(spark, sf_dir):
    conversations = read(spark, sf_dir, "conversations")
    return chat_repair.repair(chat_repair.damage(conversations), conversations)
