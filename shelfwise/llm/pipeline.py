"""From raw documents to token counts of clean ones: five stages, each a table for the next.

Every stage takes a table with the columns of ``documents``, in which texts, ids and all other
columns may be null, texts empty or very long, rows repeated, and further columns of any
name may follow. An empty table gives an empty one. What each operator does with such cases
is said there; what a stage adds is said here.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import boilerplate, decontamination, pieces, simhash, toxicity
from shelfwise.llm.batches import free_name, named, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold; the labels of ``sf_dir`` teach it.

    Null and empty texts have the score of the bias alone. Without labels every score is 0.5, and
    every document goes.
    """
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that too many documents of their source have; n_chars follows.

    A null text stays null, a null source is the source "". Repeated rows each count as a
    document. ``n_chars`` changes only with the text.
    """
    text, n_lines, n_dropped = (free_name(docs, f"new_{n}") for n in ("text", "n_lines", "n_dropped"))
    made = boilerplate.drop_boilerplate(docs, named("source"), named("text"), (text, n_lines, n_dropped))
    changed = F.col(n_dropped) > 0
    new = {"text": F.when(changed, F.col(text)).otherwise(named("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(named("n_chars"))
    return made.select(*[new.get(c, named(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates.

    Null and blank texts are one group. Of rows with the same id one stays, and a null id only
    where a group has no other.
    """
    return simhash.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark of ``sf_dir`` doesn't contaminate; those without words aren't."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, covered_bytes of what is left; a null text is empty."""
    return pieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece", encode),
]
#: SQL can express neither the trained classifier nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
