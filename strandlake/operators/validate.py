"""Constraints as queries: each returns the rows that break it, so that a job can report, stop or go on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.columns import PRIMARY, contig_key


def empty_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals that end at or before their start."""
    return intervals.where("end <= start")


def unknown_contigs(intervals: DataFrame, contigs: DataFrame) -> DataFrame:
    """Contigs of intervals that the genome lacks, and how many intervals they have."""
    known = contigs.select(contig_key(F.col("chrom")).alias("key"))
    return intervals.withColumn("key", contig_key(F.col("chrom"))).join(known, "key", "left_anti").groupBy("chrom").agg(F.count(F.lit(1)).alias("n"))


def name_differences(features: DataFrame, genome: DataFrame) -> DataFrame:
    """Names on one side only: name, side."""
    f = features.select(contig_key(F.col("seqname")).alias("name")).distinct()
    g = genome.select(contig_key(F.col("chrom")).alias("name")).distinct()
    return f.join(g, "name", "left_anti").withColumn("side", F.lit("annotation")).unionByName(g.join(f, "name", "left_anti").withColumn("side", F.lit("genome")))


def missing_primaries(contigs: DataFrame) -> DataFrame:
    """Primary chromosomes without a contig."""
    expected = contigs.sparkSession.createDataFrame([(x,) for x in PRIMARY], "name string")
    return expected.join(contigs.select(contig_key(F.col("chrom")).alias("name")), "name", "left_anti")


def without_track(labels: DataFrame, runs: DataFrame) -> DataFrame:
    """Contigs that no run of a track is on; their bases count as 0."""
    return labels.select("chrom").distinct().join(runs.select("chrom").distinct(), "chrom", "left_anti")


def pair_problems(regions: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (source, target) of which a region is missing or there more than once."""
    counts = regions.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select("source", "target", F.explode(F.array("source", "target")).alias("region"))
    return sides.join(counts, "region", "left").select("source", "target", "region", F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


def postconditions(judged: DataFrame, kept: DataFrame, kept_keys: list[str]) -> DataFrame:
    """For each contig what was there, what the drop set takes away, and what is left; a row only where these disagree.

    kept_keys: the columns by which a drop decision holds, such as (seqname, gene_id).
    """
    gone = judged.where("hit").select(*kept_keys).distinct()
    before = judged.groupBy("seqname").agg(F.sum("n").alias("n_in"))
    taken = judged.join(gone, kept_keys, "left_semi").groupBy("seqname").agg(F.sum("n").alias("n_gone"))
    after = kept.groupBy("seqname").agg(F.sum("n").alias("n_out"))
    table = before.join(taken, "seqname", "left").join(after, "seqname", "left")
    filled = table.select("seqname", "n_in", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_gone", "n_out")))
    return filled.where("n_in - n_gone <> n_out")


def partial_overlaps(judged: DataFrame) -> DataFrame:
    """Features that a mask covers in part, by contig and reason."""
    return judged.where("partial").groupBy("seqname", "reason").agg(F.sum("n").alias("n"))


def untouched(judged: DataFrame, kept: DataFrame, classes: DataFrame) -> DataFrame:
    """Contigs that no mask is on but that lost features all the same."""
    before = judged.groupBy("seqname").agg(F.sum("n").alias("n_in"))
    after = kept.groupBy("seqname").agg(F.sum("n").alias("n_out"))
    free = classes.where("class = 'KEEP'").select("seqname")
    return before.join(free, "seqname").join(after, "seqname", "left").where("n_in <> coalesce(n_out, 0)")


class Refused(ValueError):
    """A constraint that a job was told to stop at does not hold."""


def policy(broken: DataFrame, what: str, on: str = "fail", most: int = 20) -> DataFrame:
    """The rows that break a constraint, by what a job does about them: "fail" stops it, "warn" and "drop" let it go on.

    To stop, at most `most` of the rows are looked at, which the message shows.
    """
    if on not in ("fail", "warn", "drop"):
        raise ValueError("a policy is fail, warn or drop")
    if on == "fail":
        shown = [str(tuple(r)) for r in broken.limit(most).collect()]
        if shown:
            raise Refused(f"{what}: {', '.join(shown)}")
    return broken
