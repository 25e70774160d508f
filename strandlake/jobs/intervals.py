"""Queries of the interval operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions import columns as fc
from strandlake.operators import intervals as iv
from strandlake.sources import derived as d

BINS = 200


def _features0(spark, sf):
    f = d.features(spark, sf)
    return f.select(F.col("seqname").alias("chrom"), (F.col("start") - 1).alias("start"), "end", "line_no", "feature")


QUERIES = {
    "iv_clip": lambda s, p: iv.clip(d.ivals(s, p), d.contigs(s, p)),
    "iv_merge": lambda s, p: iv.merge(d.ivals(s, p)),
    "iv_complement": lambda s, p: iv.complement(d.contigs(s, p).select("chrom", "raw_bp"), d.ivals(s, p)),
    "iv_intersect": lambda s, p: iv.intersect(iv.merge(d.kind(s, p, "R")), iv.merge(d.kind(s, p, "A"))),
    "iv_subtract": lambda s, p: iv.subtract(d.kind(s, p, "R"), d.kind(s, p, "A"), d.contigs(s, p)),
    "iv_union": lambda s, p: iv.union(d.kind(s, p, "R"), d.kind(s, p, "A")),
    "iv_lengths": lambda s, p: iv.lengths(iv.merge(d.ivals(s, p))),
    "iv_lengths_label": lambda s, p: iv.lengths(d.ivals(s, p), "kind"),
    "iv_coverage_bins": lambda s, p: iv.coverage_bins(d.contigs(s, p).select("chrom", "raw_bp"), d.ivals(s, p), BINS),
    "iv_semi": lambda s, p: iv.semi(_features0(s, p), d.masks(s, p)).distinct(),
    "iv_anti": lambda s, p: iv.anti(_features0(s, p), d.masks(s, p)),
    "iv_contained": lambda s, p: iv.overlap_pairs(_features0(s, p), d.masks(s, p))
    .groupBy("chrom")
    .agg(F.count(F.lit(1)).alias("n_overlaps"), F.count_if(fc.within_bed(F.col("start") + 1, F.col("end"), F.col("r_start"), F.col("r_end"))).alias("n_contained")),
    "iv_closed_span": lambda s, p: iv.closed_span(d.masks(s, p), d.contigs(s, p)),
    "iv_dilate": lambda s, p: iv.lengths(iv.merge(iv.dilate(d.kind(s, p, "A"), d.contigs(s, p), 50))),
    "iv_masked_bp": lambda s, p: iv.lengths(d.masks(s, p), "chrom", "masked_bp"),
}

_OV = 'm.chrom = f.seqname AND f.start - 1 < m."end" AND f."end" > m.start'
ORACLE = {
    "iv_clip": f"{d.with_('contigs', 'ivals')}, {d.clipped('ivals', 'c')} SELECT * FROM c",
    "iv_merge": f"{d.with_('ivals')}, {d.merged('ivals', 'm')} SELECT * FROM m",
    "iv_complement": f"{d.with_('contigs', 'ivals')}, {d.clipped('ivals', 'c')}, {d.merged('c', 'm')}, {d.complemented('m', 'g')} SELECT * FROM g",
    "iv_intersect": f"{d.with_('ivals')}, r AS (SELECT * FROM ivals WHERE kind = 'R'), a AS (SELECT * FROM ivals WHERE kind = 'A'), {d.merged('r', 'mr')}, {d.merged('a', 'ma')}, {d.crossed('mr', 'ma', 'x')} SELECT * FROM x",
    "iv_subtract": f"{d.with_('contigs', 'ivals')}, {d.clipped('ivals', 'c')}, r AS (SELECT * FROM c WHERE kind = 'R'), a AS (SELECT * FROM c WHERE kind = 'A'), {d.merged('r', 'mr')}, {d.merged('a', 'ma')}, {d.complemented('ma', 'g')}, {d.crossed('mr', 'g', 'x')} SELECT * FROM x",
    "iv_union": f"{d.with_('ivals')}, u AS (SELECT * FROM ivals WHERE kind IN ('R', 'A')), {d.merged('u', 'm')} SELECT * FROM m",
    "iv_lengths": f"{d.with_('ivals')}, {d.merged('ivals', 'm')} SELECT chrom, sum(\"end\" - start)::BIGINT AS bp FROM m GROUP BY chrom",
    "iv_lengths_label": f"{d.with_('ivals')} SELECT kind, sum(\"end\" - start)::BIGINT AS bp FROM ivals GROUP BY kind",
    "iv_coverage_bins": f"""{d.with_('contigs', 'ivals')}, {d.clipped('ivals', 'c')}, {d.merged('c', 'm')},
e AS (SELECT chrom, i::INT AS bin, floor(i * (raw_bp / {BINS}.0::DOUBLE))::BIGINT AS start, CASE WHEN i + 1 = {BINS} THEN raw_bp ELSE floor((i + 1) * (raw_bp / {BINS}.0::DOUBLE))::BIGINT END AS "end" FROM contigs, range({BINS}) t(i))
SELECT e.chrom, bin, e.start, e."end", coalesce(sum(least(m."end", e."end") - greatest(m.start, e.start)) FILTER (m.start IS NOT NULL), 0)::BIGINT AS covered_bp FROM e LEFT JOIN m ON m.chrom = e.chrom AND m.start < e."end" AND m."end" > e.start GROUP BY ALL""",
    "iv_semi": f"{d.with_('features', 'masks')} SELECT DISTINCT seqname AS chrom, f.start - 1 AS start, f.\"end\", line_no, feature FROM features f WHERE EXISTS (SELECT 1 FROM masks m WHERE {_OV})",
    "iv_anti": f"{d.with_('features', 'masks')} SELECT seqname AS chrom, f.start - 1 AS start, f.\"end\", line_no, feature FROM features f WHERE NOT EXISTS (SELECT 1 FROM masks m WHERE {_OV})",
    "iv_contained": f"{d.with_('features', 'masks')} SELECT seqname AS chrom, count(*) AS n_overlaps, count(*) FILTER (f.start - 1 >= m.start AND f.\"end\" <= m.\"end\") AS n_contained FROM features f JOIN masks m ON {_OV} GROUP BY seqname",
    "iv_closed_span": f"""{d.with_('contigs', 'masks')}, s AS (SELECT *, lag("end") OVER (PARTITION BY chrom ORDER BY start, "end") AS p FROM masks),
g AS (SELECT chrom, min(start) AS first_start, max("end") AS last_end, bool_and(p IS NULL OR start <= p) AS contiguous FROM s GROUP BY chrom)
SELECT g.*, raw_bp, first_start <= 0 AND last_end >= raw_bp AND contiguous AS closed FROM g JOIN contigs USING (chrom)""",
    "iv_dilate": f"""{d.with_('contigs', 'ivals')}, x AS (SELECT chrom, start, least(i."end" + 48, raw_bp) AS "end" FROM ivals i JOIN contigs USING (chrom) WHERE kind = 'A' AND start < least(i."end" + 48, raw_bp)), {d.merged('x', 'm')} SELECT chrom, sum("end" - start)::BIGINT AS bp FROM m GROUP BY chrom""",
    "iv_masked_bp": f"{d.with_('masks')} SELECT chrom, sum(\"end\" - start)::BIGINT AS masked_bp FROM masks GROUP BY chrom",
}
