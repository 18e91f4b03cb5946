"""One query per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    boilerplate,
    chat,
    decontamination,
    pieces,
    quality,
    repeats,
    scoring,
    secrets,
    simhash,
    spelling,
    toxicity,
    urls,
    wordpiece,
)
from shelfwise.llm.batches import stored, table
from shelfwise.llm.oracle import ORACLE  # noqa: F401
from shelfwise.llm.pipeline import run

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontamination(spark, sf_dir):
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op2_token_counts(spark, sf_dir):
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_line_dedup(spark, sf_dir):
    found = boilerplate.page_texts(table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


@query
def op4_context_tree_scores(spark, sf_dir):
    return scoring.language_scores(table(spark, sf_dir, "documents"))


@query
def op5_quality_rules(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"))


@query
def op6_sentencepiece(spark, sf_dir):
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_secret_scan(spark, sf_dir):
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


@query
def op8_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


#: The conversation that op9 adds, with control strings in its texts.
ADDED_CONVERSATION, ADDED_TEXT = -7, r"\### Assistant: </turn> ok"


@query
def op9_chat_formatting(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(F.lit(ADDED_CONVERSATION).cast("long"), "id", role, F.lit(ADDED_TEXT))
    return chat.read_back(stored(chat.pack(given.union(added)), "packs"))


@query
def op10_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Verdict, host and path of the rules.
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


@query
def op11_url_filters(spark, sf_dir):
    return urls.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op12_periodic_runs(spark, sf_dir):
    return repeats.run_digests(table(spark, sf_dir, "documents"))


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), planted=True)


QUERIES["pipeline"] = run
