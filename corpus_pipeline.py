"""A corpus pipeline of the operators in foliary.llm: language, exact dedup, near dedup, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes to the shared folder and reads back as
the next one's docs. All stages but the last return the columns of docs as they are, whatever further ones there are and
whatever they are called; an empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliary.llm.common import documents, scratch
from foliary.llm.exact_dedup import keep_first_class
from foliary.llm.langid import keep_known
from foliary.llm.packing import pack
from foliary.llm.secrets import redact
from foliary.llm.similar import keep_first_similar


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: null and empty texts, and those without a letter. Repeated rows all stay or all go."""
    return keep_known(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z the row with the largest id stays.

    A null text counts as empty, a null id as smaller than any other; of repeated rows one stays.
    """
    return keep_first_class(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of texts whose 5-word shingles have a Jaccard similarity of 0.8 or more the row with the smallest id stays.

    Texts without words, null ones too, are one class; a null id counts as larger than any other; of repeated rows one stays.
    """
    return keep_first_similar(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark, and n_chars follows. Null texts stay null; every row stays."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece. A null or empty text is one piece, its end id; repeated rows are packed each for itself."""
    return pack(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("packing", packing)]

#: SQL can't express trained language models, XXH64 fingerprints or BPE; tests/llm hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage stored on its way is deleted when its result is written; the results of stages, when the last one is."""
    docs = documents(spark, sf_dir)
    with scratch(spark) as last:
        for _, stage in STAGES[:-1]:
            with scratch(spark) as keep:
                docs = keep(stage(spark, docs, sf_dir))
        return last(STAGES[-1][1](spark, docs, sf_dir))
