"""Domain relations derived from the given tables, as DataFrames and as DuckDB common table expressions.

The tables hold no genomic data, so contigs, intervals, scores, masks and features follow from their keys by fixed
formulas, over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _chrom(k):
    return F.concat(F.when(k % 2 == 0, F.lit("chr")).otherwise(F.lit("")), k.cast("string"))


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, chrom, raw_bp"""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k.alias("k"), _chrom(k).alias("chrom"), (200000 + 1000 * k).cast("long").alias("raw_bp"))


def genome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contigs that the genome has; annotations also name others."""
    return contigs(spark, sf_dir).where("k % 10 <> 7")


def ivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom, start, end, kind; some reach past their contig"""
    start = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 210000
    return table(spark, sf_dir, "lineitem").select(_chrom(F.col("l_suppkey")).alias("chrom"), start.cast("long").alias("start"), (start + F.col("l_quantity").cast("long")).cast("long").alias("end"), F.col("l_returnflag").alias("kind"))


def kind(spark: SparkSession, sf_dir: str, flag: str) -> DataFrame:
    return ivals(spark, sf_dir).where(F.col("kind") == flag).select("chrom", "start", "end")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, chrom, start, end, h (hundredths of the score), score (single precision)"""
    n = table(spark, sf_dir, "supplier").count()
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % n).alias("k"), "o_orderkey", (F.round(F.col("o_totalprice") * 100).cast("long") % 101).cast("int").alias("h"))
    rn = F.row_number().over(Window.partitionBy("k").orderBy("o_orderkey", "h")).cast("long")
    return o.withColumn("rn", rn).select("k", _chrom(F.col("k")).alias("chrom"), (700 * (F.col("rn") - 1)).alias("start"), (700 * F.col("rn")).alias("end"), "h", (F.col("h") / F.lit(100.0)).cast("float").alias("score"))


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom, start, end, name: high-scoring runs, some of them extra masks, and some contigs whole"""
    r = runs(spark, sf_dir).where("h >= 90")
    high = r.select("chrom", "start", "end", F.concat(F.when(F.col("h") >= 98, F.lit("extra:")).otherwise(F.lit("")), F.lit("m"), F.col("start").cast("string")).alias("name"))
    whole = contigs(spark, sf_dir).where("k % 10 = 3").select("chrom", F.lit(0).cast("long").alias("start"), F.col("raw_bp").alias("end"), F.lit("whole").alias("name"))
    return high.unionByName(whole)


#: Contigs in the roles of X and Y.
X_KEY, Y_KEY = "5", "4"


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line_no (a number of its own for each row) and the nine fields, 1-based inclusive; some lack a gene_id or have an empty name"""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("q"), "l_returnflag", "l_linestatus")
    p = F.col("l_partkey")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "q", "l_returnflag", "l_linestatus"))
    start = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 210000 + 1
    kind_ = F.when(F.col("l_returnflag") == "A", "gene").when(F.col("l_returnflag") == "N", "transcript").otherwise("exon")
    attributes = F.concat(
        F.lit('ref_gene_id "D'), (p % 7).cast("string"), F.lit('"; '),
        F.when(p % 31 == 0, F.lit("")).otherwise(F.concat(F.lit('gene_id "G'), (p % 20).cast("string"), F.lit('"; '))),
        F.when(kind_ != "gene", F.concat(F.lit('transcript_id "T'), (p % 60).cast("string"), F.lit('"; '))).otherwise(""),
        F.when(p % 37 == 0, F.lit('gene_name ""; ')).otherwise(F.lit("")),
        F.when(F.col("l_linenumber") != 1, F.concat(F.when(p % 2 == 0, F.lit('gene_name "N')).otherwise(F.lit('gene "N')), (p % 23).cast("string"), F.lit('"; '))).otherwise(""),
        F.lit('gene_biotype "'), F.when(p % 3 == 0, "lncRNA").otherwise("protein_coding"), F.lit('";'),
    )
    return li.select(
        (F.col("l_orderkey") * 1000 + place).cast("long").alias("line_no"), _chrom(F.col("l_suppkey")).alias("seqname"), F.concat(F.lit("s"), (p % 3).cast("string")).alias("source"), kind_.alias("feature"),
        start.cast("long").alias("start"), (start + F.col("q") * 40).cast("long").alias("end"), F.lit(".").alias("score"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        F.when(kind_ == "exon", (p % 3).cast("string")).otherwise(".").alias("frame"), attributes.alias("attributes"),
    )


def par(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom, start, end, name: low-scoring runs on the contigs in the roles of X and Y, the Y side named Y in any case"""
    r = runs(spark, sf_dir).where(F.col("k").isin(int(X_KEY), int(Y_KEY)) & (F.col("h") < 30))
    return r.select(F.when(F.col("k") == int(Y_KEY), F.when(F.col("h") % 2 == 0, "chrY").otherwise("y")).otherwise(F.col("chrom")).alias("chrom"), "start", "end", F.concat(F.lit("PAR"), F.col("h").cast("string")).alias("name"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """contig, line_no, seq: documents as sequences of lines"""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("contig"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "seq"))


#: What letters become as bases; a space becomes nothing, all else N.
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz "
_BASES = "".join("ACGT"[(i % 26 * 5 + i % 26 // 3) % 4] for i in range(52))


def bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """contig, line_no, seq: the lines of the documents of a source as the bases of a contig"""
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    seq = F.regexp_replace(F.translate("line", _LETTERS, _BASES), "[^ACGT]", "N")
    return rows.select(F.col("source").alias("contig"), (F.col("doc_id") * (1 << 20) + F.col("i")).alias("line_no"), seq.alias("seq"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom, region, region_group, start, end: thirds of each contig"""
    c = contigs(spark, sf_dir).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return c.select("chrom", F.concat("chrom", F.lit(":"), F.col("i").cast("string")).alias("region"), F.concat(F.lit("g"), (F.col("k") % 4).cast("string"), F.lit("_"), F.col("i").cast("string")).alias("region_group"), F.expr("(i * raw_bp) div 3").alias("start"), F.expr("((i + 1) * raw_bp) div 3").alias("end"))


_C = "(CASE WHEN {0} % 2 = 0 THEN 'chr' ELSE '' END) || {0}"
#: The same relations for DuckDB.
CTES = {
    "contigs": f"SELECT s_suppkey AS k, {_C.format('s_suppkey')} AS chrom, (200000 + 1000 * s_suppkey)::BIGINT AS raw_bp FROM supplier",
    "genome": "SELECT * FROM contigs WHERE k % 10 <> 7",
    "ivals": f"SELECT {_C.format('l_suppkey')} AS chrom, ((l_orderkey * 7919 + l_linenumber * 104729) % 210000)::BIGINT AS start, ((l_orderkey * 7919 + l_linenumber * 104729) % 210000 + l_quantity::BIGINT)::BIGINT AS \"end\", l_returnflag AS kind FROM lineitem",
    "runs": f"SELECT k, {_C.format('k')} AS chrom, 700 * (rn - 1) AS start, 700 * rn AS \"end\", h, (h / 100.0::DOUBLE)::FLOAT AS score FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o_orderkey, h) AS rn FROM (SELECT o_custkey % (SELECT count(*) FROM supplier) AS k, o_orderkey, (round(o_totalprice * 100)::BIGINT % 101)::INT AS h FROM orders))",
    "masks": "SELECT chrom, start, \"end\", (CASE WHEN h >= 98 THEN 'extra:' ELSE '' END) || 'm' || start AS name FROM runs WHERE h >= 90 UNION ALL SELECT chrom, 0, raw_bp, 'whole' FROM contigs WHERE k % 10 = 3",
    "par": f"SELECT CASE WHEN k = {Y_KEY} THEN CASE WHEN h % 2 = 0 THEN 'chrY' ELSE 'y' END ELSE chrom END AS chrom, start, \"end\", 'PAR' || h AS name FROM runs WHERE k IN ({X_KEY}, {Y_KEY}) AND h < 30",
    "features": f"""SELECT (l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity::BIGINT, l_returnflag, l_linestatus))::BIGINT AS line_no,
      {_C.format('l_suppkey')} AS seqname, 's' || (l_partkey % 3) AS source, CASE l_returnflag WHEN 'A' THEN 'gene' WHEN 'N' THEN 'transcript' ELSE 'exon' END AS feature,
      ((l_orderkey * 7919 + l_linenumber * 104729) % 210000 + 1)::BIGINT AS start, ((l_orderkey * 7919 + l_linenumber * 104729) % 210000 + 1 + l_quantity::BIGINT * 40)::BIGINT AS "end", '.' AS score, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
      CASE WHEN l_returnflag NOT IN ('A', 'N') THEN (l_partkey % 3)::VARCHAR ELSE '.' END AS frame,
      'ref_gene_id "D' || (l_partkey % 7) || '"; ' || CASE WHEN l_partkey % 31 = 0 THEN '' ELSE 'gene_id "G' || (l_partkey % 20) || '"; ' END || CASE WHEN l_returnflag <> 'A' THEN 'transcript_id "T' || (l_partkey % 60) || '"; ' ELSE '' END
        || CASE WHEN l_partkey % 37 = 0 THEN 'gene_name ""; ' ELSE '' END || CASE WHEN l_linenumber <> 1 THEN CASE WHEN l_partkey % 2 = 0 THEN 'gene_name "N' ELSE 'gene "N' END || (l_partkey % 23) || '"; ' ELSE '' END || 'gene_biotype "' || CASE WHEN l_partkey % 3 = 0 THEN 'lncRNA' ELSE 'protein_coding' END || '";' AS attributes FROM lineitem""",
    "parsed": """SELECT *, 1::BIGINT AS n, regexp_replace(seqname, '^chr', '') AS contig_key, regexp_extract(attributes, '(?:^|; )gene_id "([^"]*)"', 1) AS gene_id, nullif(regexp_extract(attributes, '(?:^|; )transcript_id "([^"]*)"', 1), '') AS transcript_id,
      CASE WHEN regexp_matches(attributes, '(?:^|; )gene_name "([^"]*)"') THEN regexp_extract(attributes, '(?:^|; )gene_name "([^"]*)"', 1) ELSE regexp_extract(attributes, '(?:^|; )gene "([^"]*)"', 1) END AS gene_name,
      CASE WHEN regexp_matches(attributes, '(?:^|; )gene_biotype "([^"]*)"') THEN regexp_extract(attributes, '(?:^|; )gene_biotype "([^"]*)"', 1) ELSE regexp_extract(attributes, '(?:^|; )gene_type "([^"]*)"', 1) END AS gene_biotype FROM features""",
    "lines": "SELECT doc_id AS contig, unnest(string_split(text, chr(10))) AS seq, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents",
    "bases": f"SELECT contig, doc_id * {1 << 20} + i AS line_no, regexp_replace(translate(line, '{_LETTERS}', '{_BASES}'), '[^ACGT]', 'N', 'g') AS seq FROM (SELECT source AS contig, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)",
    "regions": "SELECT chrom, chrom || ':' || i AS region, 'g' || (k % 4) || '_' || i AS region_group, (i * raw_bp) // 3 AS start, ((i + 1) * raw_bp) // 3 AS \"end\" FROM contigs, range(3) t(i)",
}
_NEEDS = {"par": ["runs"], "genome": ["contigs"], "masks": ["runs", "contigs"], "parsed": ["features"], "regions": ["contigs"]}


def with_(*names: str) -> str:
    """`WITH` and the named relations, and those that they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order)


def merged(source: str, out: str, keys: str = "chrom") -> str:
    """Tables for the merged intervals of a source."""
    return f"""{out}_f AS (SELECT *, CASE WHEN start > coalesce(max("end") OVER (PARTITION BY {keys} ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN 1 ELSE 0 END AS new FROM {source}),
{out}_b AS (SELECT *, sum(new) OVER (PARTITION BY {keys} ORDER BY start, "end" RANGE UNBOUNDED PRECEDING) AS b FROM {out}_f),
{out} AS (SELECT {keys}, min(start) AS start, max("end") AS "end" FROM {out}_b GROUP BY {keys}, b)"""


def clipped(source: str, out: str, contigs_: str = "contigs") -> str:
    return f"""{out} AS (SELECT i.* REPLACE (greatest(i.start, 0) AS start, least(i."end", c.raw_bp) AS "end") FROM {source} i JOIN {contigs_} c USING (chrom) WHERE greatest(i.start, 0) < least(i."end", c.raw_bp))"""


def complemented(source: str, out: str, contigs_: str = "contigs") -> str:
    """Of merged and clipped intervals."""
    return f"""{out} AS (SELECT chrom, before AS start, start AS "end" FROM (SELECT *, coalesce(lag("end") OVER (PARTITION BY chrom ORDER BY start), 0) AS before FROM {source}) WHERE before < start
UNION ALL SELECT c.chrom, coalesce(m.e, 0), c.raw_bp FROM {contigs_} c LEFT JOIN (SELECT chrom, max("end") AS e FROM {source} GROUP BY chrom) m USING (chrom) WHERE coalesce(m.e, 0) < c.raw_bp)"""


def crossed(left: str, right: str, out: str, extra: str = "") -> str:
    return f"""{out} AS (SELECT l.chrom, greatest(l.start, r.start) AS start, least(l."end", r."end") AS "end"{extra} FROM {left} l JOIN {right} r ON l.chrom = r.chrom AND l.start < r."end" AND l."end" > r.start)"""
