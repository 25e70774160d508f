"""Queries of the score-track operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions.columns import territory_of, threshold_label
from strandlake.operators import intervals as iv
from strandlake.operators import territory as te
from strandlake.operators import tracks as tr
from strandlake.sources import derived as d

K = 100
THRESHOLDS = {threshold_label(t): t for t in te.THRESHOLDS}


def conditions():
    return {n: F.col("score") >= F.lit(t).cast("float") for n, t in THRESHOLDS.items()}


def scored(pieces, runs, by):
    """Hundredths of scores summed, and bases by threshold."""
    return tr.sums(pieces, runs, "h", conditions(), by)


def _multi(s, p):
    c = d.contigs(s, p).select("chrom", "raw_bp")
    return tr.multi_read(iv.merge(iv.clip(tr.passing(d.runs(s, p), 0.5), c)), c, K)


def _multi_sums(s, p):
    """Sum of counts over all bases of a contig, and the largest count."""
    n = F.col("end") - F.col("start")
    seg = _multi(s, p)
    return seg.groupBy("chrom").agg(F.sum(n * F.col("at_start") + F.col("slope") * F.expr("((end - start) * (end - start - 1)) div 2")).cast("long").alias("total"), F.max(F.greatest(F.col("at_start"), F.col("at_start") + F.col("slope") * (n - 1))).cast("long").alias("most"), F.sum(n).cast("long").alias("bp"))


def _bins(s, p):
    c = d.contigs(s, p).select("chrom", "raw_bp")
    cov = iv.coverage_bins(c, tr.passing(d.runs(s, p), 0.5), 50).withColumn("track", F.lit("single"))
    wide = iv.coverage_bins(c, tr.passing(d.runs(s, p), 0.2), 50).withColumn("track", F.lit("multi"))
    return cov.unionByName(wide)


def _means(s, p):
    return _bins(s, p).groupBy("track", "chrom").agg(F.sum("covered_bp").alias("_v"), F.sum(F.col("end") - F.col("start")).alias("_w")).select("track", "chrom", (F.col("_v") / F.col("_w")).alias("mean"))


def _territory_means(s, p):
    """Means by track and territory, rounded as they are shown, of bins with their middles."""
    shown = tr.middles(_bins(s, p)).withColumn("territory", territory_of(F.when(F.col("chrom") == d.X_KEY, "X").when(F.col("chrom") == f"chr{d.Y_KEY}", "Y").otherwise(F.col("chrom"))))
    width = F.col("end") - F.col("start")
    by = ["track", "territory"]
    means = tr.weighted_mean(shown.withColumn("share", F.col("covered_bp") / width), by, "share", width)
    return means.join(shown.groupBy(*by).agg(F.max("mid_mb").alias("last_mid_mb")), by).select(*by, F.round("mean", 5).alias("mean"), "last_mid_mb")


QUERIES = {
    "tr_multi_mean": lambda s, p: (lambda c: tr.multi_mean(iv.merge(iv.clip(tr.passing(d.runs(s, p), 0.5), c)), c, K))(d.contigs(s, p).select("chrom", "raw_bp")),
    "tr_territory_mean": _territory_means,
    "tr_rle": lambda s, p: tr.run_length(d.runs(s, p), "h"),
    "tr_islands": lambda s, p: tr.islands(d.runs(s, p), 0.9),
    "tr_minlen": lambda s, p: tr.islands(d.runs(s, p), 0.5, 2000),
    "tr_single": lambda s, p: iv.lengths(tr.unique_indicator(d.runs(s, p)), "chrom", "unique_bp"),
    "tr_multi_k": _multi,
    "tr_multi_sums": _multi_sums,
    "tr_effective": lambda s, p: tr.with_all_labels(scored(iv.complement(d.contigs(s, p).select("chrom", "raw_bp"), d.ivals(s, p)), d.runs(s, p), ["chrom"]), d.contigs(s, p), ["chrom"]),
    "tr_by_label": lambda s, p: tr.with_all_labels(scored(d.regions(s, p), d.runs(s, p), ["region"]), d.regions(s, p), ["region"]),
    "tr_weighted_mean": _means,
    "tr_delta": lambda s, p: tr.delta(_means(s, p).where("track = 'multi'"), _means(s, p).where("track = 'single'"), ["chrom"], "mean"),
}


def _cov(threshold: float, out: str) -> str:
    return f"""{out}_r AS (SELECT * FROM runs WHERE score >= {threshold}::FLOAT), {d.clipped(f'{out}_r', f'{out}_c')}, {d.merged(f'{out}_c', f'{out}_m')},
{out} AS (SELECT e.chrom, bin, e.start, e."end", coalesce(sum(least(m."end", e."end") - greatest(m.start, e.start)) FILTER (m.start IS NOT NULL), 0)::BIGINT AS covered_bp FROM e LEFT JOIN {out}_m m ON m.chrom = e.chrom AND m.start < e."end" AND m."end" > e.start GROUP BY ALL)"""


_EDGES = 'e AS (SELECT chrom, i::INT AS bin, floor(i * (raw_bp / 50.0::DOUBLE))::BIGINT AS start, CASE WHEN i + 1 = 50 THEN raw_bp ELSE floor((i + 1) * (raw_bp / 50.0::DOUBLE))::BIGINT END AS "end" FROM contigs, range(50) t(i))'
_MEANS = f"{d.with_('contigs', 'runs')}, {_EDGES}, {_cov(0.5, 's')}, {_cov(0.2, 'w')}, b AS (SELECT 'single' AS track, * FROM s UNION ALL SELECT 'multi', * FROM w), means AS (SELECT track, chrom, sum(covered_bp)::DOUBLE / sum(\"end\" - start)::DOUBLE AS mean FROM b GROUP BY track, chrom)"
_SUMS = "coalesce(sum(h * bp), 0)::BIGINT AS effective, " + ", ".join(f"coalesce(sum(bp) FILTER (score >= {t}::FLOAT), 0)::BIGINT AS {n}" for n, t in THRESHOLDS.items())
#: The events of multi_read, without tiles.
_EVENTS = f"""{d.with_('contigs', 'runs')}, r AS (SELECT chrom, start, "end" FROM runs WHERE score >= 0.5::FLOAT), {d.clipped('r', 'c')}, {d.merged('c', 'm')},
ev AS (SELECT chrom, start AS pos, 1 AS d FROM m UNION ALL SELECT chrom, "end", -1 FROM m UNION ALL SELECT chrom, start + {K}, -1 FROM m UNION ALL SELECT chrom, "end" + {K}, 1 FROM m UNION ALL SELECT chrom, 0, 0 FROM contigs UNION ALL SELECT chrom, raw_bp, 0 FROM contigs),
ea AS (SELECT chrom, pos, sum(d)::BIGINT AS d FROM ev JOIN contigs USING (chrom) WHERE pos <= raw_bp GROUP BY chrom, pos),
es AS (SELECT chrom, pos AS start, lead(pos) OVER w AS "end", sum(d) OVER w AS slope, sum(d * pos) OVER w AS mm FROM ea WINDOW w AS (PARTITION BY chrom ORDER BY pos)),
seg AS (SELECT chrom, start, "end", (slope * (start + 1) - mm)::BIGINT AS at_start, slope::BIGINT AS slope FROM es WHERE "end" IS NOT NULL)"""
ORACLE = {
    "tr_multi_mean": f"""{_EVENTS}, v AS (SELECT chrom, greatest(start, {K - 1}) AS start, "end", (at_start::DOUBLE / {K})::FLOAT AS score FROM seg WHERE slope = 0 AND "end" > {K - 1} AND at_start <> 0
UNION ALL SELECT chrom, i, i + 1, ((at_start + slope * (i - start))::DOUBLE / least(i + 1, {K}))::FLOAT FROM (SELECT *, unnest(range(start, CASE WHEN slope = 0 THEN least("end", {K - 1}) ELSE "end" END)) AS i FROM seg)),
z AS (SELECT * FROM v WHERE score <> 0), {d.merged('z', 'zm', 'chrom, score')} SELECT chrom, start, "end", score FROM zm""",
    "tr_territory_mean": f"""{_MEANS} SELECT track, CASE chrom WHEN '{d.X_KEY}' THEN 'chrX' WHEN 'chr{d.Y_KEY}' THEN 'chrY' ELSE 'Autosomes' END AS territory, round(sum(covered_bp)::DOUBLE / sum("end" - start)::DOUBLE, 5) AS mean, max((start + "end") / 2e6::DOUBLE) AS last_mid_mb FROM b GROUP BY ALL""",
    "tr_rle": f"{d.with_('runs')}, z AS (SELECT * FROM runs WHERE h <> 0), {d.merged('z', 'm', 'chrom, h')} SELECT * FROM m",
    "tr_islands": f"{d.with_('runs')}, z AS (SELECT * FROM runs WHERE score >= 0.9::FLOAT), {d.merged('z', 'm')} SELECT * FROM m",
    "tr_minlen": f"{d.with_('runs')}, z AS (SELECT * FROM runs WHERE score >= 0.5::FLOAT), {d.merged('z', 'm')} SELECT * FROM m WHERE \"end\" - start >= 2000",
    "tr_single": f"{d.with_('runs')} SELECT chrom, sum(\"end\" - start)::BIGINT AS unique_bp FROM runs WHERE score >= 1.0 GROUP BY chrom",
    "tr_multi_k": f"{_EVENTS} SELECT * FROM seg",
    "tr_multi_sums": f"""{_EVENTS}, u AS (SELECT m.chrom, m.start AS s, m."end" AS e, raw_bp FROM m JOIN contigs USING (chrom)),
t AS (SELECT chrom, sum((least(e, raw_bp) - s) * {K} - (CASE WHEN e + {K} > raw_bp THEN (SELECT sum(greatest(0, {K} - (raw_bp - b))) FROM range(s, e) x(b)) ELSE 0 END)) AS total FROM u GROUP BY chrom)
SELECT c.chrom, coalesce(t.total, 0)::BIGINT AS total, (SELECT max(greatest(at_start, at_start + slope * ("end" - start - 1))) FROM seg WHERE seg.chrom = c.chrom)::BIGINT AS most, raw_bp AS bp FROM contigs c LEFT JOIN t USING (chrom)""",
    "tr_effective": f"""{d.with_('contigs', 'ivals', 'runs')}, {d.clipped('ivals', 'c')}, {d.merged('c', 'm')}, {d.complemented('m', 'g')}, x AS (SELECT g.chrom, least(g."end", r."end") - greatest(g.start, r.start) AS bp, h, score FROM g JOIN runs r ON g.chrom = r.chrom AND g.start < r."end" AND g."end" > r.start)
SELECT chrom, {_SUMS} FROM (SELECT chrom FROM contigs) LEFT JOIN x USING (chrom) GROUP BY chrom""",
    "tr_by_label": f"""{d.with_('regions', 'runs')}, x AS (SELECT g.region, least(g."end", r."end") - greatest(g.start, r.start) AS bp, h, score FROM regions g JOIN runs r ON g.chrom = r.chrom AND g.start < r."end" AND g."end" > r.start)
SELECT region, {_SUMS} FROM (SELECT region FROM regions) LEFT JOIN x USING (region) GROUP BY region""",
    "tr_weighted_mean": f"{_MEANS} SELECT * FROM means",
    "tr_delta": f"{_MEANS} SELECT chrom, a.mean - b.mean AS delta FROM means a JOIN means b USING (chrom) WHERE a.track = 'multi' AND b.track = 'single'",
}
