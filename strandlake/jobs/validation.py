"""Queries of the constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.jobs.annotation import _j, _judged, _reasons, _verdicts
from strandlake.operators import annotation as an
from strandlake.operators import validate as va
from strandlake.sources import derived as d


def _post(s, p):
    """Against a result that lacks exons: the contigs where that shows."""
    j = _judged(s, p)
    return va.postconditions(j, an.kept_by_gene(j).where("feature <> 'exon'"), ["seqname", "gene_id"])


def _pairs(s, p):
    pairs = d.contigs(s, p).select(F.concat("chrom", F.lit(":0")).alias("source"), F.concat("chrom", F.when(F.col("k") % 3 == 0, ":9").otherwise(":2")).alias("target"))
    return va.pair_problems(d.regions(s, p), pairs)


def _untouched(s, p):
    """Against a result that lacks exons: contigs without a mask that lost features."""
    f, m = an.parsed(d.features(s, p)), d.masks(s, p).where("name NOT LIKE 'm%0'")
    classes = an.classify(f, m, d.genome(s, p))
    j = an.judged(f, classes, m, "any", d.Y_KEY)
    return va.untouched(j, an.kept_by_gene(j).where("feature <> 'exon'"), classes).select("seqname", "n_in", F.coalesce("n_out", F.lit(0)).cast("long").alias("n_out"))


QUERIES = {
    "va_untouched": _untouched,
    "va_policy": lambda s, p: va.policy(an.unknown_names(an.parsed(d.features(s, p)), d.genome(s, p), 1 << 30), "names that the genome lacks", "warn"),
    "va_empty_intervals": lambda s, p: va.empty_intervals(d.ivals(s, p).withColumn("end", F.col("end") - 3)),
    "va_unknown_contigs": lambda s, p: va.unknown_contigs(d.masks(s, p), d.genome(s, p)),
    "va_name_differences": lambda s, p: va.name_differences(d.features(s, p), d.genome(s, p)),
    "va_missing_primaries": lambda s, p: va.missing_primaries(d.contigs(s, p)),
    "va_without_track": lambda s, p: va.without_track(d.contigs(s, p), d.runs(s, p).where("h >= 60 AND start < 1400")),
    "va_pair_problems": _pairs,
    "va_postconditions": _post,
    "va_partial_overlaps": lambda s, p: va.partial_overlaps(_judged(s, p)),
}
_FEWER = "fm AS (SELECT * FROM masks WHERE name NOT LIKE 'm%0')"
ORACLE = {
    "va_untouched": f"""{d.with_('contigs', 'genome', 'masks', 'parsed')}, {_FEWER},{_verdicts('fm').replace("CASE WHEN g.raw_bp IS NULL THEN 'DROP_ALL'", "CASE WHEN g.raw_bp IS NULL THEN 'KEEP'")},{_reasons()}
SELECT seqname, count(*) AS n_in, count(*) FILTER (feature <> 'exon') AS n_out FROM j WHERE class = 'KEEP' GROUP BY seqname HAVING count(*) FILTER (feature = 'exon') > 0""",
    "va_policy": f"{d.with_('genome', 'parsed')} SELECT seqname, sum(n)::BIGINT AS n_features FROM parsed WHERE seqname NOT IN (SELECT chrom FROM genome) GROUP BY seqname",
    "va_empty_intervals": f"{d.with_('ivals')} SELECT chrom, start, \"end\" - 3 AS \"end\", kind FROM ivals WHERE \"end\" - 3 <= start",
    "va_unknown_contigs": f"{d.with_('genome', 'masks')} SELECT chrom, count(*) AS n FROM masks WHERE chrom NOT IN (SELECT chrom FROM genome) GROUP BY chrom",
    "va_name_differences": f"{d.with_('genome', 'features')}, f AS (SELECT DISTINCT replace(seqname, 'chr', '') AS name FROM features), g AS (SELECT replace(chrom, 'chr', '') AS name FROM genome) SELECT name, 'annotation' AS side FROM f WHERE name NOT IN (SELECT name FROM g) UNION ALL SELECT name, 'genome' FROM g WHERE name NOT IN (SELECT name FROM f)",
    "va_missing_primaries": f"{d.with_('contigs')} SELECT name FROM (SELECT i::VARCHAR AS name FROM range(1, 23) t(i) UNION ALL SELECT unnest(['X', 'Y'])) WHERE name NOT IN (SELECT replace(chrom, 'chr', '') FROM contigs)",
    "va_without_track": f"{d.with_('contigs', 'runs')} SELECT chrom FROM contigs WHERE chrom NOT IN (SELECT chrom FROM runs WHERE h >= 60 AND start < 1400)",
    "va_pair_problems": f"{d.with_('contigs', 'regions')} SELECT chrom || ':0' AS source, chrom || ':9' AS target, chrom || ':9' AS region, 0::BIGINT AS n FROM contigs WHERE k % 3 = 0",
    "va_postconditions": f"""{_j()}, k2 AS (SELECT * FROM kept WHERE feature <> 'exon'), t AS (SELECT seqname, sum(n) AS n_in, sum(n) FILTER (EXISTS (SELECT 1 FROM j x WHERE x.hit AND x.seqname = j.seqname AND x.gene_id = j.gene_id)) AS n_gone FROM j GROUP BY seqname)
SELECT seqname, n_in::BIGINT AS n_in, coalesce(n_gone, 0)::BIGINT AS n_gone, coalesce(n_out, 0)::BIGINT AS n_out FROM t LEFT JOIN (SELECT seqname, sum(n) AS n_out FROM k2 GROUP BY seqname) USING (seqname) WHERE n_in - coalesce(n_gone, 0) <> coalesce(n_out, 0)""",
    "va_partial_overlaps": f"{_j()} SELECT seqname, reason, sum(n)::BIGINT AS n FROM j WHERE partial GROUP BY ALL",
}
