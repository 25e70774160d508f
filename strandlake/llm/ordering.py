"""Ranks in seeded shuffled orders, without a sort of all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the shuffle key, and how many of its first bits name a bucket.
KEY_BITS = 60


def shuffle_key(doc_id: Column, seed: int) -> Column:
    """60 bits of the MD5 of seed and id, as other engines compute them too; a null id has a key of its own."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def ranked(rows: DataFrame, group: str, key: str, ties: list[str], bucket_bits: int = 12) -> DataFrame:
    """Rows with `rank` (from 1, by key and ties, within the group) and `group_rows`.

    The first bits of the key name buckets. The rows of a bucket are numbered where they meet, and the rows of the
    buckets before it are counted beforehand, so that a group with a third of all rows is spread over 2**bucket_bits
    pieces. What is joined has one row for each group and bucket.
    """
    bucketed = rows.withColumn("_bucket", F.shiftrightunsigned(F.col(key), KEY_BITS - bucket_bits).cast("int"))
    per = Window.partitionBy(group)
    ahead = (
        bucketed.groupBy(group, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_ahead", F.sum("_n").over(per.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
        .withColumn("group_rows", F.sum("_n").over(per))
        .drop("_n")
    )
    within = Window.partitionBy(group, "_bucket").orderBy(key, *ties)
    numbered = bucketed.withColumn("_at", F.row_number().over(within))
    return numbered.join(ahead, [group, "_bucket"]).withColumn("rank", F.col("_ahead") + F.col("_at")).drop("_ahead", "_at", "_bucket")
