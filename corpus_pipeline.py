"""Corpus preparation: language, boilerplate lines, near-duplicates, benchmark, tokens.

Each stage reads what its predecessor kept and returns the columns of documents; the last
returns token digests. Nulls, empty texts and repeated rows follow the operators' rules:
a null or letterless text has no language and goes; other empty texts are kept once, as
one group of near-duplicates. Near-duplicates are told by whole rows, not by ids: a null id
or one that other texts bear too costs no document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.llm import bpe, decontaminate, language, lines, simhash
from stayledger.llm.common import Workspace, table, text_key

#: Near-duplicates: words of a shingle, bits in which linked fingerprints may differ.
SHINGLE, RADIUS = 4, 4


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus, lang set to the predicted one where it is null."""
    model = language.train_on(docs)
    # keyed by text: ids may be null or repeat
    found = language.identify(docs.select(F.struct(*docs.columns).alias("row"), "text"), model, id_col="row")
    kept = found.where(F.col("lang_pred") != "und")
    return kept.select(*(F.coalesce("row.lang", "lang_pred").alias("lang") if c == "lang" else F.col(f"row.{c}").alias(c) for c in docs.columns))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on many sites, short ones included."""
    total, removed = (next(n for n in (name + "_" * k for k in range(len(docs.columns) + 1)) if n not in docs.columns) for name in ("n_lines", "n_removed"))
    done = lines.remove_lines(docs, least=1, count_col=total, removed_col=removed)
    size = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return done.select(*(size.alias(c) if c == "n_chars" else c for c in docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the least id, nulls last.

    Rows of one id are ordered by text and then by the other columns; equal rows are one.
    """
    kind = docs.schema["doc_id"].dataType
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast(kind)).alias("doc_id"), *text_key("text"), F.xxhash64(*docs.columns).alias("rest"))
    keyed = docs.select(key.alias("key"), "text", F.struct(*docs.columns).alias("row"))
    groups = simhash.near_duplicates(keyed, id_col="key", width=SHINGLE, radius=RADIUS)
    first = groups.where(F.col("key") == F.col("component_id")).select("key").distinct()
    return keyed.join(first, "key", "left_semi").dropDuplicates(["key"]).select(*(F.col("row")[c].alias(c) for c in docs.columns))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate.find_overlap(docs.select(F.struct(*docs.columns).alias("row"), "text"), table(spark, sf_dir, "benchmark"), id_col="row")
    return found.where(F.size("hits") == 0).select(*(F.col(f"id.{c}").alias(c) for c in docs.columns))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document."""
    return bpe.digest_documents(docs, bpe.public_vocabulary())


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("bpe", token_stage),
]

#: Language profiles, fingerprints and BPE can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
