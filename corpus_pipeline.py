"""A training corpus from raw documents, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir), with
docs being what the stage before kept, and returns a DataFrame. ``run`` writes
every stage's result to the shared folder and reads it back for the next one,
so a lost executor never goes back further than one stage. All but the last
return the columns of ``documents``.

Nulls: a null text is an empty one; the quality stage scores it like any
other, the language stage rejects it (it has no letter). Null ids are kept
apart by their texts. Repeated rows are near duplicates of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farecast.llm import jaccard, langid, packing, pii, quality
from farecast.llm.common import read_table
from farecast.llm.queries import WORD_VOCABULARY
from farecast.session import scratch_path

LEAST_FAMILIARITY = 0.75  # times what 19 of 20 documents of the predicted language reach


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.5 or more; the trees learn from the labelled ones outside the held-out fold."""
    return quality.keep_good(docs, quality.learn(docs, read_table(spark, sf_dir, "labels")), 0.5)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in known languages, also mixed; every text is identified, and those without letters or unlike the
    language found go."""
    return langid.keep_known(docs, langid.learn(docs), LEAST_FAMILIARITY)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity of 0.8 or more)."""
    return jaccard.keep_one(docs, words=5, num=80, den=100)


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens (``packing.SCHEMA``)."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(WORD_VOCABULARY))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near duplicates", duplicate_stage),
    ("personal data", private_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the trained stages nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
