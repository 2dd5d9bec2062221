"""From raw documents to encoded training text, in five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again
as the next stage's documents. All but the last keep the columns of ``documents``.

Null texts count as empty. An empty text is scored like any other; if it is kept, it is one group of
equal texts, near to nothing, of size 0 in the mix and without tokens. Repeated rows are equal texts,
of which one stays. Null ids come last where ids decide. An empty table, or one that loses all rows,
goes through all stages. Further columns, whatever their names, are carried up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from geolayer.llm.bpe import encode_documents
from geolayer.llm.common import documents
from geolayer.llm.exact_dedup import unique_documents
from geolayer.llm.mixing import mixed_documents
from geolayer.llm.near_dedup import distinct_documents
from geolayer.llm.quality_classifier import good_documents
from geolayer.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return unique_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by five-word shingles."""
    return distinct_documents(docs, size=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as it takes them."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return encode_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), columns=["doc_id", "lang", "source"],
        cached_words=CACHED_WORDS)


#: The workers of the last stage have run the others before it, and keep fewer words.
CACHED_WORDS = 100_000

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing sources to target weights", mixing),
    ("BPE encoding and decoding", encoding),
]

#: Random features, MinHash components and merge queues have no SQL form; the stages are tested
#: against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
