"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes a stored table of documents and hands on what it keeps with the
same columns; the last packs what is left. ``run`` stores the documents between
stages, so that a lost executor repeats at most a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martflow.llm.common import stored, table, with_package
from martflow.llm.decontaminate import decontaminate
from martflow.llm.near_duplicates import one_of_each
from martflow.llm.packing import pack_documents
from martflow.llm.queries import PACKING_VOCABULARY, vocabulary
from martflow.llm.repeats import remove_repeats
from martflow.llm.rules import apply_rules

#: Bytes of a string that must not repeat in the corpus: less than fifty words of prose take.
REPEATED_BYTES = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that are frequent in their source go from the others.

    Null, empty and short texts are rejected; a null source is a source.
    """
    return apply_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the smallest id's, null ids last.

    Texts without words are no duplicates of each other; repeated rows are.
    """
    return one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings are cut out; documents of which nothing is left go.

    Null texts and texts shorter than the string stay as they are.
    """
    return remove_repeats(docs, length=REPEATED_BYTES)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go.

    Null texts have no window, null items no words; repeated rows go or stay together.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenised and packed into sequences.

    A null text is an empty one, of its end token alone; repeated rows are packed
    one by one.
    """
    return pack_documents(docs, *vocabulary(PACKING_VOCABULARY))


STAGES = [
    ("quality rules", with_package(quality)),
    ("n-gram Jaccard join", with_package(near_duplicates)),
    ("suffix-array dedup", with_package(repeats)),
    ("benchmark decontamination", with_package(decontamination)),
    ("best-fit packing", with_package(packing)),
]
#: Tokens, suffixes and similarities are beyond SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, which is stored after each.

    Further columns go along, whatever their names, until the last stage. An
    empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name.replace(' ', '-')}")
    return docs
