"""The corpus pipeline: quality, near duplicates, benchmark passages, secrets, mix.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept, written as Parquet and read again. All but
the last return the columns of documents; the last adds copy and shuffle_key and gives the training order.

1. quality: documents that the classifier rejects (score under 0.5) go.
2. near_duplicates: of each component of documents with a Jaccard similarity of 0.8 or more (five-word shingles) the smallest
   id stays.
3. decontamination: documents that hold a benchmark item within its edit budget go.
4. secrets: every span of a secret is replaced by its kind in brackets; n_chars follows the text.
5. mixing: copies by a Poisson rate that brings each source to the same share, in a global random order.

Defined cases: null texts count as empty ones, and both are scored by the classifier's curve without features, so they stay or
go alike; rows with a null id teach nothing, are near duplicates of nobody, and stay if their text does; repeated rows go through
alike, and those of the id that stays all stay; of equally alike documents the smallest id stays; a null source is a source
of its own in the mix; texts of any length are read whole; columns of any other name come along, and those named copy or shuffle_key
get an underscore behind their names in the mix; without labels of both classes no document is rejected that is as likely
good as not; empty tables give an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontam, mixing, neardup, quality, secrets
from tessera.llm.common import Saved, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on labelled rows of its own input, the held-out part aside."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs, k=5, num=80, den=100)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs, secrets.BlobLedger(spark))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the tables between them lie in the shared folder."""
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            saved = Saved(docs, f"pipeline-{name}")
            if before is not None:
                before.drop()
            docs, before = saved.df, saved
    return docs


#: Trained models and edit distances have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None
