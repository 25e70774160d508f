"""Line dedup: lines that many documents share go, but for one document; a document's result is a keep bitmap.

The occurrences of long lines, as hashes, are partitioned by range of (hash, document) and sorted by position within
them, so that one pass sees which occurrences are a document's first of a key, and a very common line is spread over
many partitions. Counts of documents follow from partial sums. What comes out for a document are words of 64 bits,
only those with a line to drop; texts are read once, at the end, to apply them. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.common import BLANKS, LOWER, UPPER, carried, marked, settled


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _version(text: Column) -> Column:
    """Tells apart rows that share a doc_id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """doc_id, version, words: map from i to the 64 bits of lines 64i to 64i + 63, 1 for a line that stays.

    A word, and a document, that is not there keeps all its lines. A key is a line without blanks at its ends and
    with A-Z lower-cased; keys of at least `least_chars` code points in at least `least_docs` documents stay only in
    the largest doc_id that holds them. Rows that share a doc_id are one document; null is the least id.
    """
    line = F.btrim(F.col("line"), F.lit(BLANKS))
    found = (
        docs.select("doc_id", _version(F.col("text")).alias("version"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
        .select("doc_id", "version", "pos", line.alias("line"))
        .where(F.length("line") >= least_chars)
        .withColumn("line", F.translate("line", UPPER, LOWER))
        .select(F.xxhash64("line").alias("a"), F.xxhash64(F.lit("second"), "line").alias("b"), "doc_id", "version", "pos")
    )
    ordered = found.repartitionByRange("a", "b", "doc_id").sortWithinPartitions("a", "b", "doc_id", "version", "pos")
    firsts = ordered.withColumn("first", (F.row_number().over(Window.partitionBy("a", "b", "doc_id").orderBy("version", "pos")) == 1).cast("int"))
    keys = firsts.groupBy("a", "b").agg(F.sum("first").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= least_docs)
    # joined by one struct, so that both sides are dealt anew and a very common key is split as a skewed join
    keyed = firsts.select(F.struct("a", "b").alias("key"), "doc_id", "version", "pos").join(keys.select(F.struct("a", "b").alias("key"), "last"), "key")
    gone = keyed.where(~F.col("doc_id").eqNullSafe(F.col("last")))
    words = gone.groupBy("doc_id", "version", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return words.groupBy("doc_id", "version").agg(F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("words"))


def applied(docs: DataFrame, bitmaps: DataFrame, text: str = "text") -> DataFrame:
    """Rows with the lines that stay in place of their text, and n_lines and n_dropped as further columns.

    Only texts whose id may have a bitmap are shuffled to it.
    """
    known = settled(bitmaps.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), F.col("words").alias("_words")))
    whole_text = F.col("_row").getField(text)  # not a column beside it, as rows are shuffled
    kept = carried(docs, "doc_id").withColumn("_id", F.col("doc_id"))
    rows = marked(kept, "_id", known.select("_id"), "_maybe").drop("_id")
    whole = rows.where("NOT _maybe").withColumn("n_lines", F.size(_lines(whole_text)).cast("long")).withColumn("n_dropped", F.lit(0).cast("long"))
    found = rows.where("_maybe").withColumn("_v", _version(whole_text))
    joined = found.join(known.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_v") == F.col("_version")), "left")
    cut = joined.withColumn("_lines", _lines(whole_text)).withColumn(
        "_kept", F.expr("if(_words IS NULL, _lines, filter(_lines, (x, i) -> coalesce(shiftright(try_element_at(_words, cast(i div 64 AS int)), cast(i % 64 AS int)) & 1, 1) = 1))")
    )
    cut = (
        cut.withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dropped", (F.size("_lines") - F.size("_kept")).cast("long"))
        .withColumn("_text", F.when(F.col("_words").isNull(), whole_text).otherwise(F.array_join("_kept", "\n")))
    )
    left = ["_row", "_text", "n_lines", "n_dropped"]
    both = whole.withColumn("_text", whole_text).select(*left).unionByName(cut.select(*left))
    own = [F.col("_text").alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return both.select(*own, "n_lines", "n_dropped")


def digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of each row; a null or empty text is one empty line.

    Repeated rows have equal results; ties cannot arise, as the largest doc_id keeps all its lines of a key; further
    columns play no part; an empty table gives no rows.
    """
    cut = applied(docs.select("doc_id", "text"), keep_bitmaps(docs, **options))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, g.key IS NOT NULL AND k.doc_id <> g.last AS gone FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id"""
