"""Corpus pipeline over ``documents``: language ID, near-duplicate removal,
benchmark decontamination, secret redaction, tokenisation.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage
before it kept, and returns them with the columns of ``docs``; the last one
returns token ids.  ``run`` writes each stage's rows as Parquet in the shared
folder and reads them again for the next.

Special rows: documents without a letter go in the first stage; of repeated
rows and other near duplicates the one with the least doc_id stays (of rows
with a null doc_id among them, one if no other row is linked); extra columns
are carried along; empty tables give empty results.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeweave.llm import op2_decontaminate, op3_bpe, op6_jaccard, op7_language, op9_secrets
from routeweave.llm.registry import ship_package
from routeweave.llm.tables import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a predicted language go; a missing ``lang`` becomes
    the predicted one."""
    ship_package(spark)
    trees = op7_language.train(docs)
    names = ("lang_predicted__", "lang_score__", "lang_bits__")
    found = op7_language.predict(docs, trees, tuple(docs.columns), names)
    found = found.filter("lang_predicted__ != 'und'").withColumn("lang", F.coalesce("lang", "lang_predicted__"))
    return found.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word
    shingles, Jaccard of 0.8 or more)."""
    ship_package(spark)
    return op6_jaccard.drop_duplicates(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    ship_package(spark)
    return op2_decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; ``n_chars`` follows the text.  Ids of
    documents that were not unwrapped whole are written, with a warning."""
    ship_package(spark)
    made = written(op9_secrets.redact_documents(docs, flag="unwrapped_all__"), "secrets")
    left = made.filter("not unwrapped_all__").select("doc_id")
    if not left.isEmpty():
        path = written(left, "secrets-not-unwrapped").inputFiles()[0].rpartition("/")[0]
        warnings.warn(f"secret scans: some documents hold layers that were not unwrapped whole, see {path}", stacklevel=2)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return made.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text: doc_id, lang, source, token_ids, n_tokens."""
    import public_tokenizers

    ship_package(spark)
    return op3_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                    keep=("lang", "source"))


STAGES = [("language ID", language_id), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontamination),
          ("secret scans", secrets), ("byte-level BPE encoding and decoding", tokens)]

#: No stage is expressible in SQL; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = written(docs, f"stage-{k}")
    return docs
