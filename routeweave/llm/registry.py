"""Queries of the operators with their SQL, where SQL can express them."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from routeweave.llm import op1_licenses, op8_quality, op11_collocations

Query = Callable[[SparkSession, str], DataFrame]

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
SPARK_ROWS = 10_000
BATCH_ROWS = 1000

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def register(name: str, sql: str | None = None, batch_rows: int = BATCH_ROWS):
    """``batch_rows``: rows of an Arrow batch, where the session has no value of its own."""
    def deco(fn: Query) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark, batch_rows)
            return fn(spark, sf_dir)
        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ship_package(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> None:
    """Give workers this package where their path lacks it (a session that
    was started from another folder, without --py-files)."""
    # Spark's own value gives a worker up to 10,000 whole texts at once
    if spark.conf.get(BATCH) in (str(SPARK_ROWS), str(BATCH_ROWS)):
        spark.conf.set(BATCH, str(batch_rows))
    if _ROOT in map(os.path.abspath, os.environ.get("PYTHONPATH", "").split(os.pathsep)) or os.getcwd() == _ROOT:
        return
    sc = spark.sparkContext
    if getattr(sc, "_routeweave_shipped", False):
        return
    zipped = os.path.join(tempfile.mkdtemp(prefix="routeweave-"), "routeweave.zip")
    with zipfile.ZipFile(zipped, "w") as z:
        for folder, _, names in os.walk(os.path.join(_ROOT, "routeweave")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, _ROOT))
    sc.addPyFile(zipped)
    sc._routeweave_shipped = True


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op3_byte_bpe")
def op3(spark, sf_dir):
    import public_tokenizers

    from routeweave.llm.op3_bpe import encode_digests
    return encode_digests(documents(spark, sf_dir), _public("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register("op10_token_counts")
def op10(spark, sf_dir):
    import public_tokenizers

    from routeweave.llm.op10_token_counts import count_documents
    return count_documents(documents(spark, sf_dir), _public("byte_bpe_50k.json"), public_tokenizers.PATTERN, 512)


@register("op7_language_id")
def op7(spark, sf_dir):
    from routeweave.llm.op7_language import identify
    return identify(documents(spark, sf_dir))


@register("op9_secrets")
def op9(spark, sf_dir):
    from routeweave.llm.op9_secrets import scan_documents
    return scan_documents(documents(spark, sf_dir))


@register("op4_lm_scores", batch_rows=SPARK_ROWS)     # full pieces from each batch
def op4(spark, sf_dir):
    from routeweave.llm.op4_lm import score_documents
    return score_documents(documents(spark, sf_dir))


@register("op6_jaccard_join")
def op6(spark, sf_dir):
    from routeweave.llm.op6_jaccard import jaccard_components
    return jaccard_components(documents(spark, sf_dir), k=3, percent=90).drop("sid")


@register("op5_suffix_dedup")
def op5(spark, sf_dir):
    from routeweave.llm.op5_suffix_dedup import dedup_documents
    return dedup_documents(documents(spark, sf_dir), length=200, keep="none", digest=True)


@register("op2_decontamination")
def op2(spark, sf_dir):
    from routeweave.llm.op2_decontaminate import find_leaks
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@register("op8_quality_rules", op8_quality.ORACLE_SQL)
def op8(spark, sf_dir):
    return op8_quality.quality(documents(spark, sf_dir))


@register("op1_license_scan", op1_licenses.ORACLE_SQL)
def op1(spark, sf_dir):
    return op1_licenses.scan_licenses(documents(spark, sf_dir))


@register("op13_spelling_variants")
def op13(spark, sf_dir):
    from routeweave.llm.op13_spelling import spelling_groups
    return spelling_groups(documents(spark, sf_dir))


@register("op11_collocations", op11_collocations.ORACLE_SQL)
def op11(spark, sf_dir):
    return op11_collocations.collocations(documents(spark, sf_dir))


@register("op12_personal_data")
def op12(spark, sf_dir):
    from routeweave.llm.op12_pii import scan_documents
    return scan_documents(documents(spark, sf_dir))
