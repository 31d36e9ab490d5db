"""One query per operator over the test tables, as the contracts ask, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from chronomart.llm import (
    byte_bpe,
    chat_format,
    lexical_search,
    licence_scan,
    line_dedup,
    ngram_jaccard,
    oracles,
    packing,
    prefix_trie,
    quality_rules,
    secret_scan,
    substring_dedup,
    token_counts,
    topk_search,
)
from chronomart.llm.scratch import written
from chronomart.operators.ranks import with_positions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence families found in each document."""
    found = licence_scan.licence_paragraphs(table(spark, sf_dir, "documents"))
    families = F.array_sort(F.array_distinct(F.transform("found", lambda p: p["family"])))
    return found.select(
        "doc_id",
        F.size("found").cast("long").alias("n_notices"),
        F.array_join(families, ",").alias("families"),
        F.array_join(F.transform("found", lambda p: p["line"].cast("string")), ",").alias("lines"),
    )


def byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, spaced=True)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def substring_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: What a user's turn asks for, as the arguments of a call.
REPLY_SCHEMA = {
    "required": ["turn", "text"],
    "properties": {"turn": "integer", "text": "string", "words": "integer"},
}


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations with each user's turn as a call to ``reply``, answered by the assistant's next turn."""
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("conv"), "turn", F.lit(0).alias("index"), "role", F.col("text").alias("content")
    )

    def identifier(turn: Column) -> Column:
        return F.concat(F.lit("call-"), turn.cast("string"))

    arguments = F.to_json(
        F.struct(
            F.col("turn"),
            F.col("content").alias("text"),
            F.size(F.split("content", r"\s+")).cast("long").alias("words"),
        )
    )
    calls = rows.where("role = 'user'").select(
        "conv", "turn", "index", identifier(F.col("turn")).alias("id"), F.lit("reply").alias("tool"), arguments.alias("arguments")
    )
    results = rows.where("role = 'assistant'").select(
        "conv", "turn", "index", identifier(F.col("turn") - 1).alias("id"), "content"
    )
    others = rows.where("role is null or role not in ('user', 'assistant')")
    out = chat_format.linked(calls, results, {"reply": REPLY_SCHEMA}).unionByName(chat_format.plain_messages(others))
    return out.select(
        F.col("conv").alias("conv_id"), "step", "place", "turn", "kind", "id", "status",
        F.array_join("problems", ",").alias("problems"), "json",
    )


def alike_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.linked(table(spark, sf_dir, "documents"), n=4, percent=85)


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def lines_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.keep_one_of_alike(table(spark, sf_dir, "documents").select("doc_id", "text"), whole=True)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("class_distance", 9).alias("class_distance"), F.round("word_distance", 9).alias("word_distance"),
    )


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "format")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


#: A rebuilt conversation borrows fewer turns than this from the first of its hundred.
BORROWED = 6


def rebuilt_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv, depth, hash, chars)`` and ``(conv)``: every conversation with its first turns taken from the first of its hundred.

    Turns are in the order of ``turn``, null first; equal turn numbers stand by role and text. Only hashes of the turns
    are kept.
    """
    rows = rows.where("conv_id is not null").select(
        F.col("conv_id").alias("conv"), "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    )
    rows = rows.select("*", *prefix_trie.hashed_turns(rows))
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    placed = written(with_positions(rows, order, within=["conv"], drop=["turn", "role", "text"]), "ordered_turns")
    base = (F.col("conv") - F.col("conv") % 100).alias("base")
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % BORROWED).alias("head")
    first = placed.where(F.col("position") < BORROWED)
    ids = placed.select("conv").distinct()
    asked = ids.select("conv", base, head).where("head > 0")
    lent = asked.join(first.withColumnRenamed("conv", "base"), "base").where("position <= head")
    held = first.groupBy(F.col("conv").alias("base")).agg(F.count("*").alias("held"))
    own = placed.select("*", base, head).where("position > head").join(held, "base", "left")
    taken = F.least("head", F.coalesce("held", F.lit(0)))
    own = own.select("conv", (taken + F.col("position") - F.col("head")).alias("depth"), "hash", "chars")
    return lent.select("conv", F.col("position").alias("depth"), "hash", "chars").union(own), ids


def conversation_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(*rebuilt_conversations(table(spark, sf_dir, "conversations")))


def tokens_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path, limit=512)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licence_scan": licences,
    "op2_byte_bpe": byte_bpe_round_trip,
    "op3_substring_dedup": substring_removal,
    "op4_chat_format": chat_messages,
    "op5_ngram_jaccard": alike_documents,
    "op6_topk_search": nearest_vectors,
    "op7_line_dedup": lines_kept,
    "op8_quality_rules": quality,
    "op9_best_fit_packing": packed,
    "op10_secret_scan": secrets,
    "op11_lexical_search": ranked_documents,
    "op12_prefix_trie": conversation_prefixes,
    "op13_token_counts": tokens_counted,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op3_substring_dedup": oracles.SUBSTRING,
    "op4_chat_format": oracles.CHAT,
    "op5_ngram_jaccard": oracles.JACCARD,
    "op6_topk_search": oracles.NEAREST,
    "op11_lexical_search": oracles.LEXICAL,
    "op12_prefix_trie": oracles.PREFIXES,
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
