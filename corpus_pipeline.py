"""From raw documents to packed training sequences: five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of ``docs``, whatever their names.

In every stage a null text counts as an empty one, texts of any length are read whole, repeated rows
are rows of their own, and an empty table gives an empty one. What a stage does with the rest is
said there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logbarge.llm.common import quoted, table, written
from logbarge.llm.kneser_ney import good_documents
from logbarge.llm.mixing import mix_sources
from logbarge.llm.prob_minhash import deduplicated
from logbarge.llm.queries import WEIGHTS
from logbarge.llm.secret_scan import redact_secrets
from logbarge.llm.slack_packing import pack_tokens
from logbarge.settings import own_shared_folder


#: Rows and bytes of an Arrow batch between Spark and its Python workers.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def in_small_batches(spark: SparkSession) -> SparkSession:
    """Batches of whole texts in place of 10,000 rows at once, which take tens of MB several times over in each task."""
    for key, most in BATCH.items():
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    return spark


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model of their language does not reject; unscored ones stay: empty texts, languages without a model."""
    return good_documents(docs, table(in_small_batches(spark), sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, equal rows included; texts without words are equal only to themselves."""
    in_small_batches(spark)
    return deduplicated(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text give way to their kind in brackets."""
    in_small_batches(spark)
    return redact_secrets(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights, in random order; unweighted sources keep their share."""
    return mix_sources(docs, WEIGHTS, other=None).select(*map(quoted, docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, repeated ones too, in sequences of 2048 ids, with their ids; an empty text is one id."""
    in_small_batches(spark)
    return pack_tokens(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good),
    ("MinHash near-dedup", without_copies),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = table(own_shared_folder(spark), sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, "pipeline-" + name.replace(" ", "-"))
    return docs


#: No SQL twin: language model, signatures and packing are beyond SQL; tests use brute force.
ORACLE_SQL = None
