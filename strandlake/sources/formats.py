"""Readers of the text formats as DataFrames, with explicit schemas; coordinates become 0-based half-open."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.functions.columns import PRIMARY, contig_key
from strandlake.functions.lineage import settled

#: Lines that are numbered in one task.
BLOCK_LINES = 1 << 17


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "")


def bed(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, name. Headers and comments go; a missing name is chrom:start-end; end must be past start."""
    rows = _lines(spark, path).where(~F.col("value").rlike("^(#|track|browser)")).select(F.split("value", "\t").alias("f"))
    start, end = F.get("f", F.lit(1)).cast("long"), F.get("f", F.lit(2)).cast("long")
    checked = F.when(end > start, end).otherwise(F.raise_error(F.concat(F.lit("an interval ends before it starts: "), F.array_join("f", " "))).cast("long"))
    return rows.select(F.get("f", F.lit(0)).alias("chrom"), start.alias("start"), checked.alias("end"), F.coalesce(F.get("f", F.lit(3)), F.concat(F.get("f", F.lit(0)), F.lit(":"), F.get("f", F.lit(1)), F.lit("-"), F.get("f", F.lit(2)))).alias("name"))


def bed3(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end; a # starts a comment anywhere in a line."""
    rows = spark.read.text(path).select(F.split(F.rtrim(F.regexp_replace("value", "#.*$", "")), "\t").alias("f")).where(F.size("f") >= 3)
    return rows.select(F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("start"), F.col("f")[2].cast("long").alias("end"))


def sizes(spark: SparkSession, path: str) -> DataFrame:
    """chrom, raw_bp from the first two fields, and ord, its line; of a name that comes twice the last line counts."""
    rows = _numbered(_splits(spark, path)).where(F.trim("value") != "").select("line_no", F.split(F.trim("value"), r"\s+").alias("f"))
    last = rows.groupBy(F.col("f")[0].alias("chrom")).agg(F.max(F.struct("line_no", F.col("f")[1].cast("long").alias("bp"))).alias("r"), F.min("line_no").alias("ord"))
    return last.select("chrom", F.col("r.bp").alias("raw_bp"), "ord")


def primary_sizes(spark: SparkSession, path: str) -> DataFrame:
    """chrom, raw_bp of the primary chromosomes alone, by their keys."""
    rows = sizes(spark, path).select(contig_key(F.col("chrom")).alias("chrom"), "raw_bp")
    return rows.where(F.col("chrom").isin(PRIMARY))


def plain_bed(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end of the first three fields, as they are: an interval may end before it starts."""
    rows = _lines(spark, path).where(~F.col("value").rlike("^(#|track|browser)")).select(F.split("value", r"\s+").alias("f"))
    return rows.select(F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("start"), F.col("f")[2].cast("long").alias("end"))


def assembly_report(spark: SparkSession, path: str) -> DataFrame:
    """row_no, role, molecule, accession of an assembly report; rows without an accession go."""
    rows = _numbered(_splits(spark, path)).where((F.col("value") != "") & ~F.col("value").startswith("#")).select("line_no", F.split("value", "\t").alias("f"))
    named = rows.select(F.col("line_no").alias("row_no"), F.get("f", F.lit(1)).alias("role"), F.get("f", F.lit(2)).alias("molecule"), F.get("f", F.lit(6)).alias("accession"))
    return named.where("accession IS NOT NULL AND accession NOT IN ('na', '')")


def gaps(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, type of a nine-column gap table; Spark prunes the other columns at the parser."""
    return spark.read.csv(path, sep="\t", schema="bin int, chrom string, start long, end long, ix int, n string, size long, type string, bridge string").select("chrom", "start", "end", "type")


def cytobands(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, name, gieStain."""
    return spark.read.csv(path, sep="\t", schema="chrom string, start long, end long, name string, gieStain string")


def regions(spark: SparkSession, path: str) -> DataFrame:
    """chrom, region, region_group, start, end; the file counts from 1, inclusive."""
    rows = spark.read.csv(path, sep="\t", header=True, comment="#", schema="chrom string, region string, region_group string, start long, end long")
    return rows.withColumn("start", F.col("start") - 1)


def bedgraph(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, score."""
    rows = _lines(spark, path).where(~F.col("value").rlike("^(#|track)")).select(F.split("value", r"\s+").alias("f"))
    return rows.select(F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("start"), F.col("f")[2].cast("long").alias("end"), F.col("f")[3].cast("float").alias("score"))


def registry(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """A commented table of strings with a header; with a key, of rows that share it the last one."""
    rows = spark.read.csv(path, sep="\t", header=True, comment="#", inferSchema=False)
    if key is None:
        return rows
    rest = [c for c in rows.columns if c != key]
    ordered = rows.withColumn("_at", F.monotonically_increasing_id())  # a registry is a file of one split
    return ordered.groupBy(key).agg(F.max(F.struct("_at", *rest)).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in rest))


def idxstats(spark: SparkSession, path: str) -> DataFrame:
    """contig, length, mapped, unmapped."""
    return spark.read.csv(path, sep="\t", schema="contig string, length long, mapped long, unmapped long")


def _splits(spark: SparkSession, path: str) -> DataFrame:
    """path, part and at (the place of a line) of each line with its value; a file may be read in many splits.

    A split is named by where its block starts; its lines come in the order of the file, so that monotonic ids order
    them within a partition. Compressed files are one split by their nature, but are still read line by line.
    """
    rows = spark.read.option("lineSep", "\n").text(path)
    read = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("part"), "value", F.monotonically_increasing_id().alias("at"))
    return settled(read)


def _numbered(lines: DataFrame) -> DataFrame:
    """path, part, line_no (from 1, within the file) and value, cut at its end, of lines from _splits().

    Lines are numbered within blocks of BLOCK_LINES; what is before a block comes from a summary with a row a block.
    """
    blocks = lines.withColumn("block", F.expr(f"at div {BLOCK_LINES}L"))
    counts = blocks.groupBy("path", "part", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("path", "part", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("path", "part", "block").orderBy("at")
    placed = blocks.withColumn("i", F.row_number().over(within)).join(ahead, ["path", "part", "block"])
    return placed.select("path", "part", "block", (F.col("ahead") + F.col("i")).alias("line_no"), F.rtrim("value").alias("value"))


def _gtf_lines(spark: SparkSession, path: str) -> DataFrame:
    return _numbered(_splits(spark, path)).withColumn("f", F.split("value", "\t"))


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """line_no and the nine fields; comments and lines with fewer than nine fields go."""
    rows = _gtf_lines(spark, path).where(~F.col("value").startswith("#") & (F.size("f") >= 9))
    f = F.col("f")
    return rows.select(
        "line_no", f[0].alias("seqname"), f[1].alias("source"), f[2].alias("feature"), f[3].cast("long").alias("start"), f[4].cast("long").alias("end"),
        f[5].alias("score"), f[6].alias("strand"), f[7].alias("frame"), f[8].alias("attributes"),
    )


def gtf_header(spark: SparkSession, path: str) -> DataFrame:
    """line_no and value of the comments ahead of the first line that has fields."""
    rows = _gtf_lines(spark, path)
    first = rows.where(~F.col("value").startswith("#") & (F.size("f") > 1)).agg(F.min("line_no").alias("_first"))
    comments = rows.where(F.col("value").startswith("#")).withColumn("_one", F.lit(1)).join(F.broadcast(first.withColumn("_one", F.lit(1))), "_one")  # one row
    return comments.where("_first IS NULL OR line_no < _first").select("line_no", "value")


def gtf_malformed(spark: SparkSession, path: str) -> DataFrame:
    """One row: how many lines are neither comments nor have nine fields; blank lines don't count."""
    rows = _gtf_lines(spark, path).where("value <> ''")
    return rows.agg(F.count_if(~F.col("value").startswith("#") & (F.size("f") < 9)).alias("n_malformed"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """contig, line_no, seq; blank lines go, a contig is the first token of its header."""
    rows = _numbered(_splits(spark, path)).where("value <> ''")
    rows = rows.withColumn("head", F.when(F.col("value").startswith(">"), F.element_at(F.split(F.substring("value", 2, 1 << 30), r"\s+"), 1)))
    # the last header of each block, carried on to the blocks behind it; a row a block
    last = rows.groupBy("path", "part", "block").agg(F.max_by("head", F.when(F.col("head").isNotNull(), F.col("line_no"))).alias("last"))
    before = Window.partitionBy("path").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("path", "part", "block", F.last("last", ignorenulls=True).over(before).alias("carried"))
    own = F.last("head", ignorenulls=True).over(Window.partitionBy("path", "part", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0))
    named = rows.withColumn("own", own).join(carried, ["path", "part", "block"]).withColumn("contig", F.coalesce("own", "carried"))
    return named.where("head IS NULL").select("contig", "line_no", F.col("value").alias("seq"))


#: Splits of files whose state at their start is sent to all tasks; with more of them lines are placed by shuffles.
MOST_SPLITS = 1 << 18


def _raw(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("part"), "value")


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """path, part and lines (cut at their ends) of rows that come by splits."""
    for batch in batches:
        paths, parts, values = (batch.column(k).to_pylist() for k in range(3))
        at = 0
        for k in range(1, len(values) + 1):
            if k == len(values) or parts[k] != parts[at] or paths[k] != paths[at]:
                yield paths[at], parts[at], [x.rstrip() for x in values[at:k]]
                at = k


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split: its lines, its bases, and its last header with the bases ahead of it."""
    found: dict[tuple[str, int], list] = {}
    for path, part, lines in _stretches(batches):
        own = found.setdefault((path, part), [0, 0, None, None])
        for x in lines:
            own[0] += 1
            if x.startswith(">"):
                own[2], own[3] = x[1:].split()[0] if x[1:].split() else "", own[1]
            else:
                own[1] += len(x)
    rows = [(*k, *v) for k, v in found.items()]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=["path", "part", "n", "bases", "head", "ahead"])


def placed_fasta(spark: SparkSession, path: str) -> DataFrame:
    """path, part, line_no, contig, offset and seq of the lines of sequences, which stay where they were read; headers come too, with a null seq.

    Files are read twice: first for a few numbers of each split, from which the line, contig and base at which each
    begins are told, then with these sent to all tasks. Lines are neither shuffled nor sorted.
    """
    totals = settled(_raw(spark, path).mapInArrow(_totals, "path string, part long, n long, bases long, head string, ahead long").groupBy("path", "part").agg(*(F.max(c).alias(c) for c in ("n", "bases", "head", "ahead"))))
    if totals.count() > MOST_SPLITS:
        raise ValueError(f"more than {MOST_SPLITS} splits: use fasta(), which places lines by shuffles, or larger splits")
    by = Window.partitionBy("path").orderBy("part")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    begun = totals.withColumn("_n", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("_bases", F.coalesce(F.sum("bases").over(before), F.lit(0)))
    begun = begun.withColumn("_head", F.last("head", ignorenulls=True).over(before)).withColumn("_at", F.last(F.col("_bases") + F.col("ahead"), ignorenulls=True).over(before))
    rows = begun.select("path", "part", "_n", "_head", (F.col("_bases") - F.coalesce("_at", F.lit(0))).alias("_offset")).collect()  # MOST_SPLITS at most
    shared = spark.sparkContext.broadcast({(r["path"], r["part"]): (r["_n"], r["_head"], r["_offset"]) for r in rows})
    schema = pa.schema([("path", pa.string()), ("part", pa.int64()), ("line_no", pa.int64()), ("contig", pa.string()), ("offset", pa.int64()), ("seq", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, (0, None, 0)
        for path_, part, lines in _stretches(batches):
            if (path_, part) != key:
                key, state = (path_, part), shared.value[path_, part]
            number, contig, offset = state
            out = []
            for x in lines:
                number += 1
                if x.startswith(">"):
                    contig, offset = x[1:].split()[0] if x[1:].split() else "", 0
                    out.append((number, contig, 0, None))
                elif x:
                    out.append((number, contig, offset, x))
                    offset += len(x)
            state = number, contig, offset
            yield pa.RecordBatch.from_arrays([pa.array([path_] * len(out), pa.string()), pa.array([part] * len(out), pa.int64()), *(pa.array([r[c] for r in out], schema.field(c + 2).type) for c in range(4))], schema=schema)

    return _raw(spark, path).mapInArrow(run, "path string, part long, line_no long, contig string, offset long, seq string")
