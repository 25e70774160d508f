"""From documents to token ids in five stages.

Each stage takes all that the stage before it kept, as a DataFrame with the columns of documents, and its decisions
take effect on what it returns: low quality documents go; lines that many documents share go; of near copies one
stays; the rest is put in the order of the mixture; its texts become token ids, with their place in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import bpe, gam, linededup, mixing, ngramjoin
from strandlake.llm.common import table, written
from strandlake.llm.queries import FIT_ROWS, MIX_BLOCK, MIX_SEED, OTHERS, WEIGHTS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more.

    A null text counts as an empty one, which has a score too; equal texts share their fate, repeated rows stay or go
    together; without labels all scores are 1/2, so that all stay; an empty table stays empty.
    """
    model = gam.trained(docs, table(spark, sf_dir, "labels"), most_rows=FIT_ROWS)
    return docs.where(gam.score(model, F.col("text")) >= 0.3)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that the last of five or more documents holds; n_chars follows the text.

    A null text stays null, and its n_chars is null; rows with the same doc_id count as one document; a text may become
    empty, but its row stays; an empty table stays empty.
    """
    cut = linededup.applied(docs, linededup.keep_bitmaps(docs))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity 0.8 on five-word shingles connect, the one with the smallest id.

    Null and empty texts all stay; a null doc_id is the largest; of rows with the same id and text one stays; an empty
    table stays empty.
    """
    return ngramjoin.one_of_each(docs, words=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture.

    A null source belongs to the others; ties of the shuffle are broken by id; rows with the same id follow each other;
    an empty table stays empty.
    """
    return mixing.mixed(docs, WEIGHTS, OTHERS, block_rows=MIX_BLOCK, seed=MIX_SEED)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all documents, with their slot and seq in the mixture.

    Files that are read back don't keep the order of rows, so that the place is found again, from ids and sources.
    Null and empty texts have no ids; repeated rows stay, with one place; an empty table gives no rows.
    """
    import public_tokenizers

    placed = mixing.placed(docs, WEIGHTS, OTHERS, block_rows=MIX_BLOCK, seed=MIX_SEED)
    return bpe.tokenised(placed, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, further=("slot", "seq"))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: SQL cannot state the classifier; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
