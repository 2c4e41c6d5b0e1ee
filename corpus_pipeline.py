"""The corpus pipeline: five stages from raw documents to token ids.

Counted as part of ``linefold.llm``; every stage takes what its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from linefold.llm import bpe, decontaminate, langid, secrets, setjoin, simhash
from linefold.llm.common import remove, shared_dir, table

#: Rows of whole texts that go to a Python worker at a time, and the setting that says so.
BATCH_ROWS, BATCH_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage whose Arrow batches have ``BATCH_ROWS`` rows at most: a batch is held by the
    executor and its Python worker alike, and both keep most of that memory.  Results do not
    depend on it.  The stage's rows are computed when they are written, so the setting stays
    with the session; ``run`` puts it back."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
            spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


@short_batches
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the language model rejects."""
    return langid.keep_known(docs)


@short_batches
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of SimHash links and of all pairs of texts
    whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return simhash.keep_one(docs, setjoin.alike)


@short_batches
def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of the benchmark occurs."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


@short_batches
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; every document stays."""
    return secrets.redact(docs)


@short_batches
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text, and digests of ids and decoded bytes."""
    return bpe.encode(docs, *bpe.tokenizer())


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontaminate", uncontaminated),
    ("secrets", without_secrets),
    ("tokens", token_ids),
]
#: No stage but the third is expressible in SQL, and it needs the others' rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the shared
    folder and read again as the next one's documents, and goes when that one is written.
    Returns the last stage's rows, token ids included."""
    import uuid

    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    own = spark.conf.get(BATCH_SETTING)
    try:
        for name, stage in STAGES:
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            if before:
                remove(spark, before)
            before = f"{folder}/{name}"
    finally:
        spark.conf.set(BATCH_SETTING, own)
    return docs
