"""Writers of the text formats, to one file each: sorted where the format has an order, never over what is there unless told to."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strandlake.functions.columns import chrom_rank, contig_key
from strandlake.operators.annotation import FIELDS
from strandlake.operators.assemblies import MANIFEST
from strandlake.sources import onefile


#: Lines of a block: what a gzip member of a file holds, where lines are numbered.
BLOCK_LINES = 1 << 14


def _tsv(df: DataFrame, columns: Sequence[str], order: Sequence[Column | str], path: str, header: bool, force: bool, compression: str | None = None, blocks: Sequence[Column] | None = None) -> None:
    """Columns by tabs in one file, in an order; blocks: what a gzip member holds, told by the first columns of the order."""
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    fields = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    parts = [k if blocks is None else blocks[i] for i, k in enumerate(keys[: len(blocks)] if blocks is not None else keys)]
    rows = df.select(F.lit(1).alias("part"), *(k.alias(f"b{i}") for i, k in enumerate(parts)), *(k.alias(f"o{i}") for i, k in enumerate(keys)), fields.alias("value"))
    if header:
        first = df.sparkSession.createDataFrame([(0, "\t".join(columns))], "part int, value string")
        rows = first.unionByName(rows, allowMissingColumns=True)
    onefile.written(rows, path, ["part", *(f"b{i}" for i in range(len(parts)))], [f"o{i}" for i in range(len(keys))], compression, force)


def six_digits(value: Column) -> Column:
    """A number to six significant digits, without trailing zeros, as C's %.6g prints it."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: None if pd.isna(x) else f"{x:.6g}").astype(object)

    return F.pandas_udf(run, "string")(value.cast("double"))


def sizes(contigs: DataFrame, path: str, force: bool = False) -> None:
    """chrom and raw_bp, in the order of `ord` (that of the sequences) if it is there, else in canonical order."""
    by = ["ord"] if "ord" in contigs.columns else [chrom_rank(contig_key(F.col("chrom"))), "chrom"]
    _tsv(contigs, ["chrom", "raw_bp"], by, path, False, force)


def bed(intervals: DataFrame, path: str, force: bool = False) -> None:
    """chrom, start, end and name if there is one, sorted by all of them."""
    columns = [c for c in ("chrom", "start", "end", "name") if c in intervals.columns]
    _tsv(intervals, columns, columns, path, False, force)


def bedgraph(runs: DataFrame, path: str, value: str = "score", force: bool = False) -> None:
    """Runs with a value other than 0, sorted by contig and start."""
    rows = runs.where(F.col(value) != 0).select("chrom", "start", "end", six_digits(F.col(value)).alias(value))
    _tsv(rows, rows.columns, ["chrom", "start"], path, False, force, "gzip", [F.col("chrom"), F.expr(f"start div {1 << 20}")])


def transcripts(t2g: DataFrame, path: str, force: bool = False) -> None:
    """transcript_id, gene_id, gene_name in the order in which transcripts were first seen."""
    _tsv(t2g, ["transcript_id", "gene_id", "gene_name"], ["first_line", "transcript_id"], path, False, force)


def dropped(genes: DataFrame, path: str, force: bool = False) -> None:
    """The report of dropped genes, sorted by seqname, start and gene_id, with a header."""
    columns = ["gene_id", "gene_name", "gene_biotype", "seqname", "start", "end", "strand", "n_transcripts", "n_exons", "exonic_bp", "reason"]
    _tsv(genes, columns, ["seqname", "start", "gene_id"], path, True, force)


def annotation(kept: DataFrame, path: str, header: Sequence[str] = (), force: bool = False, observed: tuple[Observation, dict[str, Column]] | None = None) -> None:
    """The header's lines, then the nine fields of the features that stay, in their order.

    observed: gets, for each name, how many of the written features fulfil a condition, counted as they are written.
    """
    head = kept.sparkSession.createDataFrame([(0, k, line) for k, line in enumerate(header)], "part int, at long, value string")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in FIELDS]
    flags = observed[1] if observed else {}
    rows = kept.select(F.lit(1).alias("part"), F.col("line_no").alias("at"), F.concat_ws("\t", *fields).alias("value"), *(F.coalesce(c, F.lit(False)).alias(f"_{n}") for n, c in flags.items()))
    rows = head.unionByName(rows, allowMissingColumns=True).withColumn("block", F.expr(f"at div {BLOCK_LINES}"))
    watch = (lambda df: df.observe(observed[0], *(F.count_if(f"_{n}").alias(n) for n in flags))) if observed else None
    onefile.written(rows, path, ["part", "block"], ["at"], "gzip", force, watch=watch)


def fasta(lines: DataFrame, order: DataFrame, path: str, force: bool = False, compression: str | None = None) -> None:
    """Sequences as lines (contig, line_no, seq) with a header ahead of each contig, in the order of its `ord`; line breaks stay.

    order: contig, ord. Lines are sorted by ranges, so that a contig is written by many tasks.
    """
    heads = order.select("ord", F.lit(-1).cast("long").alias("line_no"), F.concat(F.lit(">"), "contig").alias("value"))
    rows = lines.join(order, "contig").select("ord", F.col("line_no").cast("long").alias("line_no"), F.col("seq").alias("value")).unionByName(heads)
    onefile.written(rows.withColumn("block", F.expr(f"greatest(line_no, 0) div {BLOCK_LINES}")), path, ["ord", "block"], ["line_no"], compression, force)


def territory(wide: DataFrame, label: str, path: str, force: bool = False) -> None:
    """A territory table with a header, labels of contigs in canonical order."""
    _tsv(wide, wide.columns, [chrom_rank(contig_key(F.col(label))), label], path, True, force)


def long_territory(long_form: DataFrame, label: str, path: str, force: bool = False) -> None:
    """A territory table in long form with a header."""
    _tsv(long_form, long_form.columns, [chrom_rank(contig_key(F.col(label))), label, "territory_metric"], path, True, force)


def manifest(rows: DataFrame, path: str, force: bool = False) -> None:
    """The columns of a manifest with a header, in the order of paths."""
    _tsv(rows, MANIFEST, ["path"], path, True, force)


def report(facts: DataFrame, path: str, force: bool = False) -> None:
    """One row's columns as lines of key and value."""
    keys = facts.columns
    pairs = facts.select(F.posexplode(F.array(*(F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys))).alias("at", "kv"))
    _tsv(pairs.select("at", "kv.key", "kv.value"), ["key", "value"], ["at"], path, False, force)


def metadata(table: DataFrame, path: str, force: bool = False) -> None:
    """Each row as one JSON document."""
    onefile.written(table.select(F.to_json(F.struct("*")).alias("value")), path, ["value"], [], None, force)


def checksums(files: DataFrame, path: str, force: bool = False) -> None:
    """`md5  name` for each file (filename, and md5 or content), by name."""
    digest = F.col("md5") if "md5" in files.columns else F.md5("content")
    onefile.written(files.select("filename", F.concat(digest, F.lit("  "), F.col("filename")).alias("value")), path, ["filename"], [], None, force)
