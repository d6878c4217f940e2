"""Corpus pipeline: quality rules, near-dedup, passage dedup, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor
kept. ``run`` writes every stage's result as Parquet below the shared
checkpoint folder and reads it back as the next stage's documents.

Defined results: a null or empty text fails the quality rules, so such documents
go in the first stage; a stage that is given one nevertheless keeps it as it is
(near-dedup, passage dedup, mixing) and packs its end token. Rows without id, and
rows that repeat one id, are documents of their own: of a group of near copies one
row stays whatever their ids are. An empty table passes through all stages as an
empty table. The first four stages return the columns of the documents, extra ones
included; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kmstream.llm import mixing, near, packing, quality, repeats
from kmstream.llm.common import stored
from kmstream.llm.queries import tokenizer_path
from kmstream.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; bad lines of the others go."""
    return quality.clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8) stays."""
    return near.deduplicated(spark, docs)


#: What the pipeline calls a repeated passage: 256 bytes, since the shortest passages of over 50 words that
#: documents share are some 270 bytes long. (The query of the operator alone goes by 400.)
PASSAGES = repeats.RepeatRules(length=256, reach=128, gram=16)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 256-byte strings that start twice go."""
    return repeats.without_repeats(spark, docs, PASSAGES)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once per epoch in which their leaf's budget takes them."""
    return mixing.mixed_documents(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    # the workers also serve the other stages: a smaller word memory (no effect on results)
    rules = packing.PackRules(cache_words=200_000)
    return packing.pack(spark, packing.token_pieces(docs, tokenizer_path(), rules), rules)


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Tokenising, MinHash and byte strings are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(spark, docs, f"pipeline-{k}")
    return docs
