"""Whole runs: a masked genome, and the annotations that go with it, as files that are published together or not at all.

Files are written to a folder beside their place. What is checked is counted on the rows that are written, in the pass
that writes them, and compared with what was told before; if it differs, or a policy refuses, the folder goes and
nothing is published.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.lineage import settled
from strandlake.operators import annotation as an
from strandlake.operators import masking as ma
from strandlake.operators import sequences as sq
from strandlake.operators import validate as va
from strandlake.sources import formats, onefile, release, sinks


class Disagrees(va.Refused):
    """What was written is not what was predicted."""


@dataclass
class Rules:
    """How an annotation is filtered, and what is refused rather than reported."""

    x_key: str = "X"
    y_key: str = "Y"
    overlap: str = "any"
    unit: str = "gene"
    unknown: str = "drop"
    partial: str = "warn"
    out_of_range: str = "warn"
    par_status: str = "verified"
    allow_approximate: bool = False
    facts: dict[str, object] = field(default_factory=dict)


def _published(folder: str, names: list[str], out: str, force: bool, write: Callable[[str], dict]) -> dict:
    """What `write` returns, after all that it wrote to a folder of its own has been moved to `out`."""
    system, base = (fs.LocalFileSystem(), folder) if folder.startswith("/") else fs.FileSystem.from_uri(folder)
    there = [n for n in names if system.get_file_info(f"{base}/{n}").type != fs.FileType.NotFound]
    if there and not force:
        raise FileExistsError(f"{', '.join(there)} exist in {folder}")
    staged = f"{base}/.{out}-{uuid.uuid4().hex[:12]}"
    system.create_dir(staged)
    try:
        found = write(staged if folder.startswith("/") else f"{folder}/{staged.rsplit('/', 1)[1]}")
        for n in names:
            system.move(f"{staged}/{n}", f"{base}/{n}")
    finally:
        system.delete_dir(staged)
    return found


def _digests(spark: SparkSession, folder: str) -> dict[str, tuple[int, str]]:
    """bytes and md5 of each file of a folder."""
    return {r["filename"]: (r["bytes"], r["md5"]) for r in release.files(spark, folder, ()).select("filename", "bytes", "md5").collect()}


def annotation(spark: SparkSession, gtf: str, genome: DataFrame, par: DataFrame, extra: DataFrame, folder: str, prefix: str, variants: tuple[str, ...] = ("XX", "XY", "XY-noYPAR"), rules: Rules | None = None, force: bool = False) -> dict[str, dict]:
    """For each variant prefix.variant.gtf.gz, .t2g.tsv, .dropped_genes.tsv, .metadata.json and .gtf.gz.md5; returns what the metadata state.

    genome: chrom, raw_bp; par, extra: chrom, start, end, name. Refused: approximate parts that aren't allowed, and what
    the policies of `rules` say. After a variant is written: it has the features that were predicted, none of Y in XX,
    none that a mask touches under the rule "any", and all of X.
    """
    r = rules or Rules()
    ma.trusted(r.par_status, r.allow_approximate)
    features = an.parsed(formats.gtf(spark, gtf))
    head = [x["value"] for x in formats.gtf_header(spark, gtf).orderBy("line_no").limit(10_000).collect()]  # lines of a head
    va.policy(an.out_of_range(features, genome), "features behind the end of their contig", r.out_of_range)
    source = release.files(spark, gtf, ()).select("md5").first()["md5"]
    known = va.policy(an.unknown_names(features, genome), "names that the genome lacks", "fail" if r.unknown == "fail" else "warn").count()

    def one(variant: str, out: str) -> dict:
        masks = settled(ma.variant_mask(variant, par, extra, genome, r.y_key))
        judged = an.judged(features, an.classify(features, masks, genome, r.unknown), masks, r.overlap, r.y_key)
        genes = settled(an.dropped_genes(judged))
        va.policy(an.genes(judged).where("partial").select("seqname", "gene_id"), "genes across an edge of the mask", r.partial)
        told = an.predicted(judged, r.unit).first()
        x, y = F.col("contig_key") == r.x_key, F.col("contig_key") == r.y_key
        before = judged.agg(F.count_if(x).alias("x")).first()["x"]
        off = F.col("reason") == "seqname_not_in_genome"
        dropped = genes.agg(F.count_if(~off).alias("mask"), F.count_if(off).alias("off")).first()
        facts = {"variant": variant, "complement": ma.COMPLEMENT[variant], "features_in": told["n_in"], "features_predicted": told["n_predicted"], "genes_dropped_by_mask": dropped["mask"], "genes_dropped_off_genome": dropped["off"]}
        kept = an.UNITS[r.unit](judged)
        seen = Observation()
        name = f"{prefix}.{variant}"
        sinks.annotation(kept, f"{out}/{name}.gtf.gz", [*head, *an.provenance(facts)], observed=(seen, {"features_out": F.lit(True), "x_out": x, "y_out": y, "on_mask": F.col("hit")}))
        counts = {k: v or 0 for k, v in seen.get.items()}
        problems = []
        if told["n_predicted"] is not None and counts["features_out"] != told["n_predicted"]:
            problems.append(f"{told['n_predicted']} features predicted, {counts['features_out']} written")
        if variant == "XX" and counts["y_out"]:
            problems.append(f"{counts['y_out']} features of {r.y_key} left")
        if r.overlap == "any" and counts["on_mask"]:
            problems.append(f"{counts['on_mask']} features on the mask left")
        if counts["x_out"] != before:
            problems.append(f"{before} features of {r.x_key} before, {counts['x_out']} after")
        if problems:
            raise Disagrees(f"{name}: {'; '.join(problems)}")
        pairs = an.t2g(kept)
        sinks.transcripts(pairs, f"{out}/{name}.t2g.tsv")
        sinks.dropped(genes, f"{out}/{name}.dropped_genes.tsv")
        size, md5 = _digests(spark, out)[f"{name}.gtf.gz"]
        sinks.checksums(spark.createDataFrame([(f"{name}.gtf.gz", md5)], "filename string, md5 string"), f"{out}/{name}.gtf.gz.md5")
        said = facts | counts | r.facts | {
            "annotation_md5": source, "output_bytes": size, "output_md5": md5, "overlap_rule": r.overlap, "drop_unit": r.unit, "unknown_names": known, "par_status": r.par_status,
            "collisions": pairs.where("collision").count(), "identical_to_standard_xy": variant == "XY-noYPAR" and dropped["mask"] == 0,
        }
        sinks.metadata(spark.createDataFrame([{k: str(v) if not isinstance(v, (bool, int, float)) else v for k, v in said.items() if v is not None}]), f"{out}/{name}.metadata.json")
        return said

    names = [f"{prefix}.{v}.{x}" for v in variants for x in ("gtf.gz", "t2g.tsv", "dropped_genes.tsv", "metadata.json", "gtf.gz.md5")]
    return _published(folder, names, prefix, force, lambda out: {v: one(v, out) for v in variants})


def genome(spark: SparkSession, fasta: str, complement: str, par: DataFrame, extra: DataFrame, folder: str, prefix: str, rules: Rules | None = None, only: list[str] | None = None, force: bool = False) -> dict:
    """prefix.complement.fa.gz, .chrom.sizes, .masked.bed, .metadata.json and .fa.gz.md5 of a genome whose masked parts are N; returns what the metadata state.

    Lines stay where they are read, with their breaks; headers are cut to their names. Written lines must have as many
    bases as were read, and as many N as the masks and what was N before make.
    """
    r = rules or Rules()
    ma.trusted(r.par_status, r.allow_approximate)
    lines = ma.allowed(formats.placed_fasta(spark, fasta), only, "contig")
    bases = lines.where("seq IS NOT NULL")
    heads = settled(lines.groupBy("contig").agg(F.min(F.struct("path", "line_no")).alias("at"), F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("raw_bp")))
    sizes = heads.select(F.col("contig").alias("chrom"), "raw_bp", F.col("at.line_no").alias("ord"))
    plan = settled(ma.applied(ma.plan(complement, par, extra, r.y_key), sizes))
    if complement == "XX" and plan.where("name = 'whole_Y_mask'").isEmpty():
        raise va.Refused(f"the genome has no contig {r.y_key}")
    masked = sq.masked_in_place(lines, plan.select(F.col("chrom").alias("contig"), "start", "end"))
    n = lambda c: F.length(c) - F.length(F.regexp_replace(c, "[Nn]", ""))
    clean = sq.masked_in_place(bases.withColumn("seq", F.regexp_replace("seq", "[^Nn]", "A")), plan.select(F.col("chrom").alias("contig"), "start", "end"))
    told = clean.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("bases"), F.coalesce(F.sum(n("seq")), F.lit(0)).alias("n")).first()
    name, seen = f"{prefix}.{complement}", Observation()

    def write(out: str) -> dict:
        text = masked.withColumn("value", F.coalesce("seq", F.concat(F.lit(">"), "contig"))).withColumn("block", F.expr(f"line_no div {sinks.BLOCK_LINES}"))
        counted = text.observe(seen, F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("bases"), F.coalesce(F.sum(n("seq")), F.lit(0)).alias("n"), F.count_if(F.col("seq").isNull()).alias("contigs"))
        onefile.in_place(counted, f"{out}/{name}.fa.gz", "gzip")
        if (got := seen.get)["bases"] != told["bases"] or got["n"] != told["n"]:
            raise Disagrees(f"{name}: {told['bases']} bases and {told['n']} N predicted, {got['bases']} and {got['n']} written")
        sinks.sizes(sizes, f"{out}/{name}.chrom.sizes")
        sinks.bed(plan, f"{out}/{name}.masked.bed")
        size, md5 = _digests(spark, out)[f"{name}.fa.gz"]
        sinks.checksums(spark.createDataFrame([(f"{name}.fa.gz", md5)], "filename string, md5 string"), f"{out}/{name}.fa.gz.md5")
        report = ma.report(plan).first().asDict()
        said = {"complement": complement, "bases": got["bases"], "n_bases": got["n"], "contigs": got["contigs"], "output_bytes": size, "output_md5": md5, "par_status": r.par_status} | report | r.facts
        sinks.metadata(spark.createDataFrame([said]), f"{out}/{name}.metadata.json")
        return said

    return _published(folder, [f"{name}.{x}" for x in ("fa.gz", "chrom.sizes", "masked.bed", "metadata.json", "fa.gz.md5")], name, force, write)

