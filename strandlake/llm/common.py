"""What the operators of this subpackage share: readers of tables, names that cannot clash, checkpoints."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.lineage import settled, shared_folder

__all__ = ["BLANKS", "LOWER", "UPPER", "WORD", "carried", "marked", "released", "restored", "settled", "shared_folder", "table", "written"]

#: Bits of the bitmap of marked(): its table has a 64th as many rows at most, whatever the input.
MARK_BITS = 1 << 22

#: Bytes 32 and 9 to 13, the white space that separates words and pads lines.
BLANKS = " \t\n\x0b\f\r"
#: A word: a longest run of other characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by Spark's reader, so that any file system will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as a Parquet table to the shared folder and read back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def carried(rows: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and all of a row's own in the struct _row, so that no name among them can clash with another."""
    return rows.select(*needed, F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("_row"))


def restored(rows: DataFrame, columns: list[str], *new: str) -> DataFrame:
    """Rows of carried() with the columns that they had, and new ones, which replace those of the same names in either case."""
    taken = {c.lower() for c in new}
    return rows.select(*(F.col("_row").getField(c).alias(c) for c in columns if c.lower() not in taken), *new)


def released() -> None:
    """At the end of a Python task: gives memory that Arrow keeps back to the system, as workers live on for other tasks."""
    pa.default_memory_pool().release_unused()


def marked(rows: DataFrame, key: str, ids: DataFrame, name: str = "maybe") -> DataFrame:
    """Rows with a further column: false if their key is not among ids (a column of the same name), else perhaps true.

    Ids set bits of a bitmap of fixed size, which is broadcast; so large rows that have nothing to do with ids need
    not be shuffled to join them. A full bitmap, where ids are very many, only saves nothing.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(MARK_BITS))
    words = ids.select(slot.alias("_slot")).groupBy(F.expr("_slot div 64").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_slot % 64 AS int))")).alias("_bits"))
    placed = rows.withColumn("_slot", slot).withColumn("_word", F.expr("_slot div 64"))
    # at most MARK_BITS / 64 rows of two numbers
    joined = placed.join(F.broadcast(words), "_word", "left")
    return joined.withColumn(name, F.expr("coalesce(shiftright(_bits, cast(_slot % 64 AS int)) & 1, 0) = 1")).drop("_slot", "_word", "_bits")
