"""Shards that all match the mixture of sources: proportional stratified interleaving.

The rows of each source are shuffled by a seed and ranked. Row r of n has the fractional rank (2r - 1) / 2n; sorted
by it, the sources interleave in proportion, and cut into equal lengths each stretch holds its share of every
source. Everything is DataFrame functions on ids and counts; texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.ordering import ranked, shuffle_key

NO_SOURCE = "\x00none"


def sharded(docs: DataFrame, shards: int = 8, seed: int = 11, bucket_bits: int = 12) -> DataFrame:
    """One row for each row: doc_id, size, text_crc32, law ("rows"), shard, slot, grown_shard (null), and the source's fractional rank.

    Counts of shards differ by one at most; slots of a shard run from 0 without gaps. A null source is a source of
    its own; a null text has size 1 and the checksum of nothing; repeated rows are rows of their own, next to each
    other in their source's order; an empty table gives no rows; further columns play no part.
    """
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit(NO_SOURCE)).alias("_source"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        shuffle_key(F.col("doc_id"), seed).alias("_key"),
    )
    placed = ranked(rows, "_source", "_key", ["doc_id", "size", "text_crc32"], bucket_bits)
    twice = 2 * F.col("rank") - 1
    pieces = 1 << bucket_bits
    placed = placed.withColumn("fraction", twice / (2 * F.col("group_rows"))).withColumn("_piece", F.floor(twice * F.lit(pieces).cast("long") / (2 * F.col("group_rows"))).cast("int"))
    one = Window.orderBy("_piece")  # over a row for each piece
    ahead = (
        placed.groupBy("_piece")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_ahead", F.sum("_n").over(one.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
        .withColumn("_all", F.sum("_n").over(Window.partitionBy()))
        .drop("_n")
    )
    within = Window.partitionBy("_piece").orderBy("fraction", "_source", "_key", "doc_id", "size", "text_crc32")
    # the pieces are 2**bucket_bits rows at most, whatever the input
    at = placed.withColumn("_at", F.row_number().over(within)).join(F.broadcast(ahead), "_piece").withColumn("_pos", F.col("_ahead") + F.col("_at") - 1)
    cut = at.withColumn("shard", F.expr(f"cast((_pos * {shards}L) div _all as int)"))
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.expr(f"_pos - ((shard * _all + {shards - 1}L) div {shards}L)").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "fraction",
    )


def oracle(shards: int = 8, seed: int = 11) -> str:
    """The same in DuckDB, but for the checksum, which its SQL lacks: computed bit by bit from the bytes."""
    return f"""
WITH r AS (SELECT doc_id, coalesce(source, chr(0) || 'none') AS s, text, ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS k FROM documents),
f AS (SELECT *, (2 * row_number() OVER (PARTITION BY s ORDER BY k, doc_id) - 1)::DOUBLE / (2 * count(*) OVER (PARTITION BY s))::DOUBLE AS fraction FROM r),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, s, k, doc_id) - 1 AS pos, count(*) OVER () AS n FROM f),
q AS (SELECT *, (pos * {shards} // n)::INT AS shard FROM p),
crc AS (SELECT i, list_reduce([i::BIGINT, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) t(i)),
tab AS (SELECT list(c ORDER BY i) AS t FROM crc)
SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, strlen(coalesce(text, ''))), lambda i: ('0x' || substr(hex(encode(coalesce(text, ''))), 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32,
  'rows' AS law, shard, (pos - (shard * n + {shards - 1}) // {shards})::BIGINT AS slot, NULL::INT AS grown_shard, fraction
FROM q, tab"""
