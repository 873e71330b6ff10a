"""From raw documents to token files: five stages, each a corpus operator over all that is left.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postsieve.llm.common import read_table, shared_folder, written
from postsieve.llm.decontamination import keep_clean
from postsieve.llm.language import keep_identified, train
from postsieve.llm.mixing import mixed
from postsieve.llm.near_copies import keep_one
from postsieve.llm.token_files import read_token_files, write_token_files


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go: no letter, or no likeness to any learned language."""
    return keep_identified(docs, train(docs))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    Copies share 0.8 or more of their five-word shingles; SimHash finds them, the shingles decide.
    """
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exactly or edited, go."""
    return keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or thinned to equal shares of the text, and all copies shuffled."""
    return mixed(docs, seed=17)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mixture; a row per copy, read back from them."""
    import public_tokenizers

    target = shared_folder(spark, "tokens")
    write_token_files(docs, target, public_tokenizers.path("word_bpe_49k.json"), end_id=1, order_by_id=False)
    return read_token_files(spark, target)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]

#: Kernel regression, alignment and tokenizers are out of SQL's reach; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
