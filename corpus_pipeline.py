"""A corpus pipeline of the operators in tidemark.llm: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and returns a frame; `run` writes it as Parquet into the shared
scratch folder and hands what it reads back to the next stage. All stages but the last return
the columns of documents, whatever others there are, under names of their own or of an operator's.

Defined cases, for all stages: null texts count as empty ones and stay null; texts of any length are whole; an
empty table leaves every stage empty. What a stage does with nulls, ties and repeated rows:

* toxicity: an empty text has no telling words and stays; each row is judged by its text alone;
* exact dedup: of equal texts the row with the largest id stays, a null id counts as the smallest, and of rows that
  repeat that id one stays; all empty texts are equal;
* near dedup: a text without words is linked with nothing; rows that share an id go or stay together; of a group
  the rows with the smallest id stay, a null id being the smallest;
* mix sources: a null source is a source; every row stays, rows that repeat an id and a source are drawn together;
* pack: each row is a document, an empty one its end id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.exact_dups import drop_exact_duplicates
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.near_dups import drop_near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.queries import END_ID, MAX_REPEATS, tokenizer
from tidemark.llm.toxicity import drop_toxic
from tidemark.scratch import owned_scratch, release, scratch_path

#: Chunks whose ids a worker of the last stage remembers, and characters that it cuts into chunks at a time: less than
#: packing alone may take, since by then the executor's heap has its full size.
REMEMBERED, CUT_AT_ONCE = 100_000, 1_000_000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts stays: the one with the smallest id."""
    return drop_near_duplicates(docs, threshold_percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least; those of small sources more often, as the weights ask."""
    return mixed_documents(docs, max_repeats=MAX_REPEATS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    words = tokenizer("word_bpe_49k.json")
    return pack_documents(docs, words, END_ID, remembered=REMEMBERED, cut_at_once=CUT_AT_ONCE)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("MinHash near dedup", near_dedup),
    ("mix sources", mix_sources),
    ("pack", pack_sequences),
]

#: Scores, MinHash links and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with owned_scratch():  # what a stage stores on its way goes when its result is written
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        if before is not None:
            release(spark, before)
        docs, before = spark.read.schema(made.schema).parquet(path), path
    return docs
