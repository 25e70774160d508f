"""What is masked of a genome, for each complement: plan, application to its contigs, and the variants' masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.columns import contig_key, is_y_side

#: Variants of an annotation and the complement of the genome that each goes with (fixed values).
COMPLEMENT = {"XX": "XX", "XY": "XY", "XY-noYPAR": "XY"}


def trusted(par_status: str, allow_approximate: bool = False) -> None:
    """Refuses parts that are known only approximately, unless they are asked for."""
    if par_status == "approximate" and not allow_approximate:
        raise ValueError("these pseudo-autosomal parts are approximate: give curated ones, or allow approximate ones")


def y_side(par: DataFrame, y_key: str) -> DataFrame:
    """The Y side of pseudo-autosomal parts (chrom, start, end, name), on the contig that is the Y of this genome."""
    return par.where(is_y_side(F.col("chrom"), F.lit(y_key))).withColumn("chrom", F.lit(y_key))


def plan(complement: str, par: DataFrame, extra: DataFrame, y_key: str) -> DataFrame:
    """chrom (its key), start, end (-1: up to the contig's end), name of what a complement masks.

    XX: the whole Y. XY: the Y side of the pseudo-autosomal parts. Extra intervals come on top of either.
    """
    if complement not in ("XX", "XY"):
        raise ValueError("a complement is XX or XY")
    if complement == "XX":
        main = par.sparkSession.createDataFrame([(y_key, 0, -1, "whole_Y_mask")], "chrom string, start long, end long, name string")
    else:
        main = y_side(par, y_key).select("chrom", "start", "end", F.concat("name", F.lit("_masked")).alias("name"))
    return main.unionByName(extra.select(contig_key(F.col("chrom")).alias("chrom"), "start", "end", F.concat(F.lit("extra:"), "name").alias("name")))


def allowed(contigs: DataFrame, names: list[str] | None, column: str = "chrom") -> DataFrame:
    """Rows of the named contigs only, by their keys; without names, all."""
    if names is None:
        return contigs
    keys = sorted({x[3:] if x.startswith("chr") else x for x in (n.strip() for n in names) if x})
    return contigs.where(contig_key(F.col(column)).isin(keys))


def applied(plan_: DataFrame, contigs: DataFrame) -> DataFrame:
    """chrom (the contig's own name), start, end, name of what is really masked: ends resolved and cut to the contig."""
    sized = contigs.select(contig_key(F.col("chrom")).alias("_key"), F.col("chrom").alias("_chrom"), "raw_bp")
    joined = plan_.join(sized, plan_["chrom"] == F.col("_key"))
    end = F.when(F.col("end") == -1, F.col("raw_bp")).otherwise(F.least("end", "raw_bp"))
    return joined.select(F.col("_chrom").alias("chrom"), "start", end.alias("end"), "name").where("end > start")


def variant_mask(variant: str, par: DataFrame, extra: DataFrame, genome: DataFrame, y_key: str) -> DataFrame:
    """The mask that an annotation's variant is filtered by: nothing for XY but extra intervals, else that of its genome."""
    if variant == "XY":
        return applied(plan("XX", par, extra, y_key).where("name <> 'whole_Y_mask'"), genome)
    return applied(plan("XX" if variant == "XX" else "XY", par, extra, y_key), genome)


def report(applied_: DataFrame) -> DataFrame:
    """One row: n_masked_intervals and masked_bp, overlaps counted as often as they are masked."""
    return applied_.agg(F.count(F.lit(1)).alias("n_masked_intervals"), F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("masked_bp"))
