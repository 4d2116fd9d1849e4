"""Training-data pipeline over ``documents``: five stages, each an operator of ``revlake.llm`` on all that is left.

Each stage is written as Parquet below ``spark.checkpoint.dir`` and read again as the next one's input. SQL can express
neither the classifier nor the encoding, so there is no ORACLE_SQL; ``tests/llm/test_pipeline.py`` holds the result
against a brute-force version.

Every stage but the last returns all columns of its input, whatever further ones there are and however they are named. A null or
empty text, or one in a language without trusted texts, is kept by the classifier, is no duplicate and holds no item; the last stage gives
it null or no tokens. Rows that repeat are one group of near duplicates: one of them stays, that of the least id, null ids last.
Documents on the classifier's threshold stay. Texts of any length are handled whole. An empty table stays empty; without labels or
items the stage that needs them keeps everything.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revlake.llm.bpe_sql import encode
from revlake.llm.common import written
from revlake.llm.decontaminate import drop_contaminated
from revlake.llm.near_dup import drop_near_duplicates
from revlake.llm.pii import replace_personal
from revlake.llm.quality import drop_low_quality


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity classifier doesn't reject."""
    return drop_low_quality(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced; n_chars stays that of the text as it was."""
    return replace_personal(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, tokens, round_trip) of all documents."""
    return encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pseudonyms", pseudonyms),
    ("encoding", encoding),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
