"""Queries of the territory tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.jobs.tracks import _SUMS, THRESHOLDS, conditions
from strandlake.functions.columns import label_rank
from strandlake.functions.lineage import stored
from strandlake.operators import intervals as iv
from strandlake.operators import territory as te
from strandlake.sources import derived as d


def _inputs(s, p):
    c = d.contigs(s, p).select("chrom", "raw_bp")
    black = d.runs(s, p).where("h = 100").select("chrom", "start", "end")
    return c, te.base_sets(c, d.kind(s, p, "A"), d.kind(s, p, "R"), black), d.runs(s, p)


def _chrom(s, p):
    c, sets, runs = _inputs(s, p)
    whole = c.select("chrom", F.lit(0).cast("long").alias("start"), F.col("raw_bp").alias("end"))
    return _scored(whole, ["chrom"], sets, runs)


def _scored(labels, by, sets, runs):
    return te.table(labels, by, sets, runs, "h", conditions())


def _region(s, p):
    _, sets, runs = _inputs(s, p)
    return _scored(d.regions(s, p), ["region"], sets, runs)


def _group(s, p):
    names = d.regions(s, p).select("region", "region_group")
    return te.grouped(_region(s, p).join(names, "region"), "region_group")


_COPIED_METRICS = ["effective", "t50_bp", "t70_bp", "t90_bp"]


def _pairs(s, p):
    """Some contigs' first regions as the sources of their last ones."""
    return d.contigs(s, p).where("k % 5 IN (0, 1)").select(F.concat("chrom", F.lit(":0")).alias("source"), F.concat("chrom", F.lit(":2")).alias("target"))


def _copy(s, p):
    return te.copied(_region(s, p), _pairs(s, p), _COPIED_METRICS)


def _faulty(wide):
    """The contig table with faults put in where the label says so."""
    return wide.withColumn("t90_bp", F.when(F.col("chrom").endswith("3"), F.col("t50_bp") + 1).otherwise(F.col("t90_bp"))).withColumn("gap_bp", F.when(F.col("chrom").endswith("4"), F.lit(-1)).otherwise(F.col("gap_bp")))


def _additivity(s, p):
    """Contigs and their regions are labels of one sweep, each with sums of its own."""
    c, sets, runs = _inputs(s, p)
    regions = d.regions(s, p).select(F.lit("region").alias("level"), "chrom", "region", "start", "end")
    whole = c.select(F.lit("chrom").alias("level"), "chrom", F.lit("").alias("region"), F.lit(0).cast("long").alias("start"), F.col("raw_bp").alias("end"))
    rows = stored(_scored(regions.unionByName(whole), ["level", "chrom", "region"], sets, runs))
    return te.additivity(rows.where("level = 'region'"), _faulty(rows.where("level = 'chrom'")), "chrom")


_XY = [d.X_KEY, f"chr{d.Y_KEY}"]


def _levels(s, p):
    """The tables of all levels, from metrics computed once, some regions copied from others before they are summed."""
    c, sets, runs = _inputs(s, p)
    rows = _scored(te.level_labels(c, d.regions(s, p), _XY), ["chrom", "region_group", "region"], sets, runs)
    return te.three_levels(te.copied(rows, _pairs(s, p), _COPIED_METRICS))


def _level(s, p, name):
    return _levels(s, p).where(F.col("level") == name).withColumnRenamed("label", name).drop("level")


def _ordered(s, p):
    """The table by region in an order of its own: two labels first, the rest as contigs come."""
    seen = d.contigs(s, p).select(F.explode(F.array("chrom", F.concat("chrom", F.lit(":0")), F.concat("chrom", F.lit(":1")), F.concat("chrom", F.lit(":2")))).alias("region_group"), "k")
    rows = _level(s, p, "region_group").join(seen, "region_group")
    return rows.select("region_group", "raw_bp", label_rank(F.col("region_group"), [f"{d.X_KEY}:2", f"chr{d.Y_KEY}:0", f"{d.X_KEY}:2"], F.col("k").cast("long")).alias("rank"))


def _bands(s, p):
    """Bands of territory by stain."""
    bands = d.ivals(s, p).withColumn("gieStain", F.when(F.col("kind") == "A", "acen").when(F.col("kind") == "R", "stalk").otherwise("gneg"))
    return iv.lengths(iv.merge(te.structural_bands(iv.clip(bands, d.contigs(s, p)))), "chrom", "structural_bp")


QUERIES = {
    "te_rollup": _levels,
    "te_whole_xy": lambda s, p: _level(s, p, "chrom"),
    "te_by_group": lambda s, p: _level(s, p, "region"),
    "te_by_region": lambda s, p: _level(s, p, "region_group"),
    "te_ordered": _ordered,
    "te_bands": _bands,
    "te_named": lambda s, p: te.named_metrics(_chrom(s, p), 100),
    "te_chrom": _chrom,
    "te_region": _region,
    "te_group": _group,
    "te_copy_pair": _copy,
    "te_long": lambda s, p: te.long_form(_chrom(s, p), ["chrom"]),
    "te_violations": lambda s, p: te.violations(_faulty(_chrom(s, p)), ["chrom"]),
    "te_additivity": _additivity,
}

_BASE = f"""{d.with_('contigs', 'ivals', 'runs', 'regions')}, {d.clipped('ivals', 'cl')}, ga AS (SELECT * FROM cl WHERE kind = 'A'), {d.merged('ga', 'gap')}, xa AS (SELECT chrom, start, "end" FROM cl WHERE kind IN ('A', 'R')), {d.merged('xa', 'xm')}, {d.complemented('xm', 'stru')},
bl AS (SELECT chrom, start, "end" FROM runs WHERE h = 100), {d.clipped('bl', 'bc')}, xc AS (SELECT * FROM xa UNION ALL SELECT * FROM bc), {d.merged('xc', 'xcm')}, {d.complemented('xcm', 'calb')}, whole AS (SELECT chrom, 0::BIGINT AS start, raw_bp AS "end" FROM contigs)"""


def _table(labels: str, by: str, out: str) -> str:
    def part(src: str, name: str) -> str:
        return f"""{out}_{name} AS (SELECT l.{by}, sum(least(l."end", s."end") - greatest(l.start, s.start)) AS bp FROM {labels} l JOIN {src} s ON s.chrom = l.chrom AND s.start < l."end" AND s."end" > l.start GROUP BY 1)"""

    return f"""{part('gap', 'g')}, {part('stru', 's')}, {part('calb', 'c')},
{out}_p AS (SELECT l.{by}, l.chrom, greatest(l.start, s.start) AS start, least(l."end", s."end") AS "end" FROM {labels} l JOIN stru s ON s.chrom = l.chrom AND s.start < l."end" AND s."end" > l.start),
{out}_x AS (SELECT p.{by}, least(p."end", r."end") - greatest(p.start, r.start) AS bp, h, score FROM {out}_p p JOIN runs r ON r.chrom = p.chrom AND r.start < p."end" AND r."end" > p.start),
{out}_t AS (SELECT {by}, {_SUMS} FROM {out}_x GROUP BY {by}),
{out} AS (SELECT l.{by}, l."end" - l.start AS raw_bp, coalesce(g.bp, 0)::BIGINT AS gap_bp, (l."end" - l.start - coalesce(g.bp, 0))::BIGINT AS nongap_bp, coalesce(s.bp, 0)::BIGINT AS structural_bp, coalesce(c.bp, 0)::BIGINT AS callable_bp, coalesce(effective, 0) AS effective, {', '.join(f'coalesce({n}, 0) AS {n}' for n in THRESHOLDS)}
FROM {labels} l LEFT JOIN {out}_g g USING ({by}) LEFT JOIN {out}_s s USING ({by}) LEFT JOIN {out}_c c USING ({by}) LEFT JOIN {out}_t t USING ({by}))"""


_CH, _RE = _table("whole", "chrom", "ct"), _table("regions", "region", "rt")
_METRICS = ", ".join(te.METRICS)
_FAULT = "ft AS (SELECT * REPLACE (CASE WHEN chrom LIKE '%3' THEN t50_bp + 1 ELSE t90_bp END AS t90_bp, CASE WHEN chrom LIKE '%4' THEN -1 ELSE gap_bp END AS gap_bp) FROM ct)"
_COPIED = f"""pr AS (SELECT chrom || ':0' AS source, chrom || ':2' AS target FROM contigs WHERE k % 5 IN (0, 1)), rc AS (SELECT rt.* REPLACE ({', '.join(f'coalesce(s.{c}, rt.{c}) AS {c}' for c in ('effective', 't50_bp', 't70_bp', 't90_bp'))}), g.chrom, g.region_group FROM rt JOIN regions g ON g.region = rt.region LEFT JOIN pr ON pr.target = rt.region LEFT JOIN rt s ON s.region = pr.source),
xy AS (SELECT * FROM rc WHERE chrom IN ('{d.X_KEY}', 'chr{d.Y_KEY}')), au AS (SELECT * FROM ct WHERE chrom NOT IN ('{d.X_KEY}', 'chr{d.Y_KEY}'))"""
_SUMMED = ", ".join(f"sum({m})::BIGINT AS {m}" for m in te.METRICS)
ORACLE = {
    "te_rollup": f"""{_BASE}, {_CH}, {_RE}, {_COPIED} SELECT 'chrom' AS level, chrom AS label, {_METRICS} FROM au UNION ALL SELECT 'chrom', chrom, {_SUMMED} FROM xy GROUP BY chrom UNION ALL SELECT 'region', chrom, {_METRICS} FROM au UNION ALL SELECT 'region', region_group, {_SUMMED} FROM xy GROUP BY region_group
UNION ALL SELECT 'region_group', chrom, {_METRICS} FROM au UNION ALL SELECT 'region_group', region, {_METRICS} FROM xy""",
    "te_whole_xy": f"{_BASE}, {_CH}, {_RE}, {_COPIED} SELECT chrom, {_METRICS} FROM au UNION ALL SELECT chrom, {_SUMMED} FROM xy GROUP BY chrom",
    "te_by_group": f"{_BASE}, {_CH}, {_RE}, {_COPIED} SELECT chrom AS region, {_METRICS} FROM au UNION ALL SELECT region_group, {_SUMMED} FROM xy GROUP BY region_group",
    "te_by_region": f"{_BASE}, {_CH}, {_RE}, {_COPIED} SELECT chrom AS region_group, {_METRICS} FROM au UNION ALL SELECT region, {_METRICS} FROM xy",
    "te_ordered": f"""{_BASE} SELECT region_group, raw_bp, CASE region_group WHEN '{d.X_KEY}:2' THEN 1 WHEN 'chr{d.Y_KEY}:0' THEN 2 ELSE 4 + k END::BIGINT AS rank FROM (SELECT chrom AS region_group, raw_bp, k FROM contigs WHERE k NOT IN ({d.X_KEY}, {d.Y_KEY}) UNION ALL SELECT region, "end" - r.start, k FROM regions r JOIN contigs USING (chrom) WHERE k IN ({d.X_KEY}, {d.Y_KEY}))""",
    "te_bands": f"{_BASE} SELECT chrom, sum(\"end\" - start)::BIGINT AS structural_bp FROM xm GROUP BY chrom",
    "te_named": f"{_BASE}, {_CH} SELECT * RENAME (t50_bp AS mappable_k100_t50_bp, t70_bp AS mappable_k100_t70_bp, t90_bp AS mappable_k100_t90_bp, effective AS effective_mappable_k100_bp) FROM ct",
    "te_chrom": f"{_BASE}, {_CH} SELECT * FROM ct",
    "te_region": f"{_BASE}, {_RE} SELECT * FROM rt",
    "te_group": f"{_BASE}, {_RE} SELECT region_group, {', '.join(f'sum(rt.{m})::BIGINT AS {m}' for m in te.METRICS)} FROM rt JOIN regions USING (region) GROUP BY region_group",
    "te_copy_pair": f"""{_BASE}, {_RE}, pr AS (SELECT chrom || ':0' AS source, chrom || ':2' AS target FROM contigs WHERE k % 5 IN (0, 1))
SELECT rt.* REPLACE ({', '.join(f'coalesce(s.{c}, rt.{c}) AS {c}' for c in ('effective', 't50_bp', 't70_bp', 't90_bp'))}) FROM rt LEFT JOIN pr ON pr.target = rt.region LEFT JOIN rt s ON s.region = pr.source""",
    "te_long": f"{_BASE}, {_CH} SELECT chrom, territory_metric, bp, bp / 1e6::DOUBLE AS mb FROM (UNPIVOT ct ON {_METRICS} INTO NAME territory_metric VALUE bp)",
    "te_violations": f"{_BASE}, {_CH}, {_FAULT} " + " UNION ALL ".join(f"SELECT chrom, '{n}' AS rule FROM ft WHERE {c}" for n, c in te.RULES),
    "te_additivity": f"""{_BASE}, {_CH}, {_RE}, {_FAULT}, a AS (SELECT chrom, territory_metric, bp FROM (UNPIVOT ft ON {_METRICS} INTO NAME territory_metric VALUE bp)),
b AS (SELECT chrom, territory_metric, sum(bp)::BIGINT AS region_bp FROM (UNPIVOT (SELECT rt.*, chrom FROM rt JOIN regions USING (region)) ON {', '.join(te.METRICS)} INTO NAME territory_metric VALUE bp) GROUP BY ALL)
SELECT chrom, territory_metric, region_bp, bp AS contig_bp FROM a JOIN b USING (chrom, territory_metric) WHERE region_bp <> bp""",
}
