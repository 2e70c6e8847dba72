"""The corpus pipeline: toxicity, near-duplicates, benchmark decontamination, personal data, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lacuna.llm import bpe_replay, fm_decontam, pii, prob_minhash, toxicity_ssk
from lacuna.llm.queries import tokenizer_file
from lacuna.llm.text import drop, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic. The machine learns from the labelled rows of the whole table."""
    machine = toxicity_ssk.trained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity_ssk.clean_documents(docs, machine)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of the smallest doc_id."""
    return prob_minhash.first_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark; these stay as they are."""
    return fm_decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return pii.mask_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids and the text that the ids decode to."""
    return bpe_replay.encode_documents(docs, *tokenizer_file())


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("decontamination", drop_contaminated), ("pii", mask_personal_data), ("bpe", tokens)]

#: A learned classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, read = stored(stage(spark, docs, sf_dir)), before
        if read is not None:
            drop(read)  # the stage before is whole in docs
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
