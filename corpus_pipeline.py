"""Corpus pipeline: documents through five corpus operators, stage by stage.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``documents``:
rejected documents go, one document of each near-duplicate class stays,
repeated passages are cut out of the texts, documents are repeated or left
out to reach their source's target, and the last stage returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm.bpe import encode, vocabulary
from bazaar.llm.common import keep, read
from bazaar.llm.mixing import mix_sources
from bazaar.llm.order_minhash import near_dedup
from bazaar.llm.quality import quality_filter
from bazaar.llm.suffix_dedup import suffix_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


#: Bytes of a passage that count as repeated.  A passage of 50 words has 285
#: bytes or more in European prose (6 a word with its space, short words
#: included); 250 leaves room for a shorter wording.
PASSAGE = 250


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup(docs, length=PASSAGE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs, vocabulary())


STAGES = [
    ("quality_classifier", quality),
    ("order_minhash", near_copies),
    ("suffix_dedup", repeats),
    ("systematic_mix", mix),
    ("bpe_tree", tokens),
]

#: Several stages (a trained model, suffix ranks, BPE) are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
