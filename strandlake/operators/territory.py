"""Usable territory at three levels of labels: contigs, regions of a partition, and groups of regions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.columns import threshold_label
from strandlake.functions.lineage import settled
from strandlake.operators import intervals as iv
from strandlake.operators.integrals import between

METRICS = ["raw_bp", "gap_bp", "nongap_bp", "structural_bp", "callable_bp", "effective", "t50_bp", "t70_bp", "t90_bp"]


def base_sets(contigs: DataFrame, gaps: DataFrame, bands: DataFrame, blacklist: DataFrame) -> dict[str, DataFrame]:
    """Merged gaps, what is outside of gaps and bands (structural), and what is outside of the blacklist too (callable)."""
    gap, band, black = (settled(iv.clip(x, contigs)) for x in (gaps, bands, blacklist))
    excluded = gap.unionByName(band)
    return {"gap": settled(iv.merge(gap)), "structural": settled(iv.complement(contigs, excluded)), "callable": settled(iv.complement(contigs, excluded.unionByName(black)))}


#: Scores from which bases count as mappable.
THRESHOLDS = (0.5, 0.7, 0.9)
#: Stains of bands that are no usable territory (fixed values).
STRUCTURAL_STAINS = ("acen", "gvar", "stalk")


def structural_bands(bands: DataFrame, stains: tuple[str, ...] = STRUCTURAL_STAINS) -> DataFrame:
    """The bands of these stains."""
    return bands.where(F.col("gieStain").isin(*stains))


def named_metrics(wide: DataFrame, k: int) -> DataFrame:
    """Columns of scores under the names that say by which read length they were found."""
    return wide.withColumnsRenamed({c: f"mappable_k{k}_{c}" for c in map(threshold_label, THRESHOLDS)} | {"effective": f"effective_mappable_k{k}_bp"})


def table(labels: DataFrame, by: list[str], sets: dict[str, DataFrame], runs: DataFrame, value: str, thresholds: dict[str, Column]) -> DataFrame:
    """METRICS for each label. labels: by, chrom, start, end; scores are summed over the structural set.

    Sets and scores are tracks of one sweep over their edges: no set meets the labels in a join.
    """
    scores = (runs, {"_value": F.col(value)} | {f"_{n}": F.coalesce(c, F.lit(False)).cast("long") for n, c in thresholds.items()})
    measures = {f"{n}_bp": (lambda s, n=n: s(n)) for n in sets}
    measures |= {"effective": lambda s: s("structural") * s("_value")} | {n: (lambda s, n=n: s("structural") * s(f"_{n}")) for n in thresholds}
    sums = between([*((x, {n: F.lit(1)}) for n, x in sets.items()), scores], labels, by, measures)
    joined = iv.lengths(labels, by, "raw_bp").join(sums, by)
    return joined.withColumn("nongap_bp", F.col("raw_bp") - F.col("gap_bp")).select(*by, *METRICS)


def rollup(regions: DataFrame, levels: dict[str, str]) -> DataFrame:
    """level, label and METRICS: the regions summed by each of several columns at once. levels: name of a level -> its column."""
    columns = list(levels.values())
    sums = regions.groupingSets([[c] for c in columns], *columns).agg(F.grouping_id().alias("_set"), *(F.sum(m).alias(m) for m in METRICS))
    # the bits of grouping_id are those columns that a set leaves out
    at = {n: (1 << len(columns)) - 1 - (1 << len(columns) - 1 - k) for k, n in enumerate(levels)}
    level = reduce(lambda c, n: c.when(F.col("_set") == at[n], F.lit(n)), levels, F)
    return sums.select(level.alias("level"), F.coalesce(*columns).alias("label"), *METRICS)


def grouped(regions: DataFrame, by: str) -> DataFrame:
    """Sums of all metrics over the regions of a label."""
    return regions.groupBy(by).agg(*(F.sum(m).alias(m) for m in METRICS))


def copied(regions: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Target regions take these columns from their source region; pairs: source, target. Without a source row a target keeps its own."""
    source = regions.select(F.col("region").alias("source"), *(F.col(c).alias(f"_{c}") for c in columns)).join(pairs, "source").drop("source")
    joined = regions.join(source.withColumnRenamed("target", "region"), "region", "left")
    return joined.select(*(F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in regions.columns))


def level_labels(contigs: DataFrame, regions: DataFrame, xy: list[str]) -> DataFrame:
    """chrom, region_group, region, start, end: the regions of X and Y, and each other contig as its own region and group."""
    own = regions.where(F.col("chrom").isin(xy)).select("chrom", "region_group", "region", "start", "end")
    whole = contigs.where(~F.col("chrom").isin(xy)).select("chrom", F.col("chrom").alias("region_group"), F.col("chrom").alias("region"), F.lit(0).cast("long").alias("start"), F.col("raw_bp").alias("end"))
    return own.unionByName(whole)


#: The tables of three_levels(), and the column of regions that labels each.
LEVELS = {"chrom": "chrom", "region": "region_group", "region_group": "region"}


def three_levels(regions: DataFrame) -> DataFrame:
    """level, label and METRICS of the tables by contig, by group of regions and by region, from one table of level_labels()."""
    return rollup(regions, LEVELS)


def long_form(wide: DataFrame, by: list[str]) -> DataFrame:
    """A row for each label and metric, with mb as well."""
    return wide.unpivot(by, METRICS, "territory_metric", "bp").withColumn("mb", F.col("bp") / 1e6)


#: The rules that hold between metrics: name, and the condition of a violation.
RULES = [
    *((f"negative_{m}", f"{m} < 0") for m in METRICS),
    ("t90_over_t70", "t90_bp > t70_bp"), ("t70_over_t50", "t70_bp > t50_bp"), ("t50_over_structural", "t50_bp > structural_bp"),
    ("callable_over_structural", "callable_bp > structural_bp"), ("structural_over_nongap", "structural_bp > nongap_bp"), ("nongap_over_raw", "nongap_bp > raw_bp"),
]


def violations(wide: DataFrame, by: list[str]) -> DataFrame:
    """A row for each label and broken rule."""
    broken = F.array_compact(F.array(*(F.when(F.expr(c), F.lit(n)) for n, c in RULES)))
    return wide.select(*by, F.explode(broken).alias("rule"))


def additivity(regions: DataFrame, contigs: DataFrame, owner: str) -> DataFrame:
    """Metrics for which the regions of a contig don't sum to the contig's."""
    summed = long_form(regions, [owner, "region"]).groupBy(owner, "territory_metric").agg(F.sum("bp").alias("region_bp"))
    whole = long_form(contigs, [owner]).select(owner, "territory_metric", F.col("bp").alias("contig_bp"))
    return summed.join(whole, [owner, "territory_metric"]).where("region_bp <> contig_bp")
