"""Interval algebra on half-open [start, end) rows with a contig column.

A contig can hold a third of all rows, so nothing here orders a whole contig in one task: rows are ordered within
tiles of fixed width, and what a tile needs to know of those before it comes from a summary with one row a tile.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = 1 << 17
BIN = 1 << 14
#: A place behind all others.
NOWHERE = 1 << 60


def clip(intervals: DataFrame, contigs: DataFrame) -> DataFrame:
    """Intervals of known contigs (chrom, raw_bp), cut to their bounds; empty ones go."""
    sized = intervals.join(contigs.select("chrom", F.col("raw_bp").alias("_bp")), "chrom")
    cut = sized.withColumn("start", F.greatest(F.col("start"), F.lit(0))).withColumn("end", F.least(F.col("end"), F.col("_bp")))
    return cut.where("start < end").drop("_bp")


def in_tiles(rows: DataFrame, keys: list[str], at: str, tile: int = TILE) -> DataFrame:
    """Rows with the tile of a place; those without a key or place go.

    They would find no partner in the joins by tile that follow. If it were left to these to leave them out, the rows
    and the summaries told from them would be different to Spark, and be shuffled apart.
    """
    tiled = rows.withColumn("_tile", F.expr(f"{at} div {tile}L"))
    return tiled.where(reduce(lambda c, k: c & F.col(k).isNotNull(), keys, F.col("_tile").isNotNull()))


def _blocks(intervals: DataFrame, keys: list[str], tile: int) -> DataFrame:
    """Merged intervals of each tile: keys, start, end, reach (the largest end of all that is before it, or null), and joins.

    joins is the start of the last block that none before it reaches, of earlier tiles: what a block that begins
    within the reach goes on with. Rows of one start are one before they are shuffled by tile, so that a tile has no
    more rows than bases.
    """
    firsts = in_tiles(intervals, keys, "start", tile).groupBy(*keys, "_tile", "start").agg(F.max("end").alias("end"))
    within = Window.partitionBy(*keys, "_tile").orderBy("start")
    ahead = F.max("end").over(within.rowsBetween(Window.unboundedPreceding, -1))
    opened = firsts.withColumn("_new", F.coalesce((F.col("start") > ahead).cast("int"), F.lit(1)))
    blocks = opened.withColumn("_block", F.sum("_new").over(within)).groupBy(*keys, "_tile", "_block").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    blocks = blocks.withColumn("_near", F.lag("end").over(within))
    tiles = Window.partitionBy(*keys).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy(*keys, "_tile").agg(F.max("start").alias("_start"), F.max("end").alias("_end")).withColumn("_far", F.max("_end").over(tiles))
    last = F.when(F.col("_far").isNull() | (F.col("_start") > F.col("_far")), F.col("_start"))
    sums = sums.withColumn("_last", last).withColumn("joins", F.max("_last").over(tiles)).select(*keys, "_tile", "_far", "joins")
    return blocks.join(sums, [*keys, "_tile"]).select(*keys, "start", "end", F.greatest("_near", "_far").alias("reach"), "joins")


def merge(intervals: DataFrame, keys: list[str] | None = None, tile: int = TILE) -> DataFrame:
    """Overlapping and touching intervals of the same keys (default: chrom) become one."""
    keys = keys or ["chrom"]
    named = _blocks(intervals.select(*keys, "start", "end"), keys, tile).withColumn("start", F.when(F.col("start") <= F.col("reach"), F.col("joins")).otherwise(F.col("start")))
    return named.groupBy(*keys, "start").agg(F.max("end").alias("end"))


def complement(contigs: DataFrame, intervals: DataFrame, tile: int = TILE) -> DataFrame:
    """What contigs (chrom, raw_bp) have outside of the intervals; a contig without any comes whole."""
    inside = clip(intervals, contigs).select("chrom", "start", "end")
    blocks = _blocks(inside, ["chrom"], tile)
    gaps = blocks.select("chrom", F.coalesce("reach", F.lit(0)).cast("long").alias("start"), F.col("start").alias("end"))
    ends = inside.groupBy("chrom").agg(F.max("end").alias("_end"))
    tails = contigs.select("chrom", "raw_bp").join(ends, "chrom", "left").select("chrom", F.coalesce("_end", F.lit(0)).cast("long").alias("start"), F.col("raw_bp").alias("end"))
    return gaps.unionByName(tails).where("start < end")


def _binned(intervals: DataFrame, width: int) -> DataFrame:
    return intervals.withColumn("_bin", F.explode(F.expr(f"sequence(start div {width}, greatest(start, end - 1) div {width})")))


def overlap_pairs(left: DataFrame, right: DataFrame, how: str = "inner", key: str = "chrom", width: int = BIN) -> DataFrame:
    """Pairs of rows that share a base, each once; right's columns get the prefix r_.

    Both sides are dealt by contig and bin, so that a long contig is many pieces; a pair counts in the bin where its
    overlap begins. For a left join give left rows an identity and join the pairs back.
    """
    r = _binned(right, width)
    r = r.select(*(F.col(c).alias(f"r_{c}") for c in right.columns), F.col("_bin").alias("_r_bin"))
    first = F.expr(f"greatest(start, r_start) div {width}")
    on = (F.col(key) == F.col(f"r_{key}")) & (F.col("_bin") == F.col("_r_bin")) & (F.col("start") < F.col("r_end")) & (F.col("end") > F.col("r_start")) & (F.col("_bin") == first)
    return _binned(left, width).join(r, on, how).drop("_bin", "_r_bin")


def reaching(intervals: DataFrame, order: list[str], tile: int = TILE, before: str | None = None) -> DataFrame:
    """Intervals that end behind all that come before them by (start, end, order): from a contig's first to its last, both ends ascend.

    Whatever lies inside an earlier one can't be the first that reaches a place or contains a span, so that those which
    are left are an index in which either is found by a search for one end. before: the name of a column with the furthest
    end of those that come before, or null; each contig then also has a row of starts and ends at NOWHERE.
    """
    ones = intervals.groupBy("chrom", "start", "end").agg(F.min(F.struct(*order)).alias("_o")).select("chrom", "start", "end", "_o.*")
    tiled = in_tiles(ones, ["chrom"], "start", tile)
    within = Window.partitionBy("chrom", "_tile").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("chrom").orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    far = tiled.groupBy("chrom", "_tile").agg(F.max("end").alias("_end")).select("chrom", "_tile", F.max("_end").over(earlier).alias("_far"))
    known = tiled.withColumn("_near", F.max("end").over(within)).join(far, ["chrom", "_tile"]).withColumn("_reach", F.greatest("_near", "_far"))
    found = known.where(F.col("end") > F.coalesce("_reach", F.lit(-1)))
    if before is None:
        return found.select("chrom", "start", "end", *order)
    kinds = dict(ones.dtypes)
    nowhere = F.lit(NOWHERE).cast("long")
    last = ones.where("chrom IS NOT NULL").groupBy("chrom").agg(F.max("end").alias(before)).select("chrom", nowhere.alias("start"), nowhere.alias("end"), *(F.lit(None).cast(kinds[o]).alias(o) for o in order), before)
    return found.select("chrom", "start", "end", *order, F.col("_reach").alias(before)).unionByName(last)


def first_reaching(points: DataFrame, index: DataFrame, name: str = "found", tile: int = TILE, contigs: DataFrame | None = None) -> DataFrame:
    """Points (chrom, at, ...) with the first interval of a reaching() index that ends at `at` or behind it, as a struct, or null.

    Points and ends are ordered together, from the last to the first, within tiles; what a tile lacks is the first end of
    the next one that has any. No pairs are made, however many intervals a point lies in. Points may carry columns of any
    kind, as they are shuffled once and joined with nothing but a row for each tile; contigs: chrom and further columns
    that the points of a contig get on the same way, points on others go.
    """
    kept = [c for c in points.columns if c not in ("chrom", "at")]
    found = F.struct(*(c for c in index.columns if c != "chrom"))
    rows = index.select("chrom", F.col("end").alias("at"), found.alias(name)).unionByName(points, allowMissingColumns=True)
    rows = in_tiles(rows, ["chrom"], "at", tile).withColumn("_point", F.col(name).isNull())
    within = Window.partitionBy("chrom", "_tile").orderBy(F.desc("at"), "_point").rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("chrom").orderBy(F.desc("_tile")).rowsBetween(Window.unboundedPreceding, -1)
    # rows of a tile are few before they are shuffled for this, and have no more columns than it needs
    firsts = rows.groupBy("chrom", "_tile").agg(F.min_by(name, F.when(F.col(name).isNotNull(), F.col("at"))).alias("_first"))
    firsts = firsts.select("chrom", "_tile", F.last("_first", ignorenulls=True).over(behind).alias("_next"))
    further = []
    if contigs is not None:
        further = [c for c in contigs.columns if c != "chrom"]
        firsts = firsts.join(contigs, "chrom")
    known = rows.withColumn("_near", F.last(name, ignorenulls=True).over(within)).join(firsts, ["chrom", "_tile"])
    return known.where("_point").select("chrom", "at", *kept, F.coalesce("_near", "_next").alias(name), *further)


def semi(left: DataFrame, right: DataFrame, width: int = BIN) -> DataFrame:
    """Rows of left that share a base with right; only whether counts, so that right is merged first."""
    return left.join(_touched(left, right, width), ["chrom", "start", "end"], "left_semi")


def anti(left: DataFrame, right: DataFrame, width: int = BIN) -> DataFrame:
    """Rows of left that share no base with right."""
    return left.join(_touched(left, right, width), ["chrom", "start", "end"], "left_anti")


def _touched(left: DataFrame, right: DataFrame, width: int) -> DataFrame:
    return overlap_pairs(left.select("chrom", "start", "end"), merge(right), width=width).select("chrom", "start", "end").distinct()


def intersect(left: DataFrame, right: DataFrame, labels: list[str] | None = None, width: int = BIN) -> DataFrame:
    """Each overlap as a piece of its own, with `labels` of the right side."""
    pairs = overlap_pairs(left, right, width=width)
    return pairs.select("chrom", F.greatest("start", "r_start").alias("start"), F.least("end", "r_end").alias("end"), *(F.col(f"r_{x}").alias(x) for x in labels or []))


def subtract(left: DataFrame, right: DataFrame, contigs: DataFrame) -> DataFrame:
    """Bases of left that right doesn't hold, merged."""
    return intersect(merge(clip(left, contigs)), complement(contigs, right))


def union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bases of either side, merged."""
    return merge(left.select("chrom", "start", "end").unionByName(right.select("chrom", "start", "end")))


def lengths(intervals: DataFrame, by: str | list[str] = "chrom", name: str = "bp") -> DataFrame:
    """Sum of lengths by label; no rows for no intervals."""
    return intervals.groupBy(*([by] if isinstance(by, str) else by)).agg(F.sum(F.col("end") - F.col("start")).alias(name))


def coverage_bins(contigs: DataFrame, intervals: DataFrame, bins: int) -> DataFrame:
    """Bases that intervals cover in each of equal bins of each contig; bins without any count 0. Overlaps are merged first."""
    from strandlake.functions.columns import bin_edge
    from strandlake.operators.integrals import between

    edges = contigs.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    edges = edges.select("chrom", "bin", bin_edge(F.col("bin"), bins, F.col("raw_bp")).alias("start"), bin_edge(F.col("bin") + 1, bins, F.col("raw_bp")).alias("end"))
    covered = (merge(clip(intervals, contigs)), {"covered": F.lit(1)})
    return between([covered], edges, ["chrom", "bin", "start", "end"], {"covered_bp": lambda s: s("covered")})


def closed_span(intervals: DataFrame, contigs: DataFrame, tile: int = TILE) -> DataFrame:
    """For each contig with intervals: whether they run from 0 to its end, each starting no later than the one before ends.

    The one before is the previous row by (start, end), not the furthest so far.
    """
    tiled = in_tiles(intervals.select("chrom", "start", "end"), ["chrom"], "start", tile).repartition("chrom", "_tile")
    within = Window.partitionBy("chrom", "_tile").orderBy("start", "end")
    last = tiled.groupBy("chrom", "_tile").agg(F.max(F.struct("start", "end")).alias("_last"))
    last = last.withColumn("_from", F.lag("_last").over(Window.partitionBy("chrom").orderBy("_tile"))).drop("_last")
    previous = F.coalesce(F.lag("end").over(within), F.col("_from.end"))
    steps = tiled.join(last, ["chrom", "_tile"]).withColumn("_ok", previous.isNull() | (F.col("start") <= previous))
    spans = steps.groupBy("chrom").agg(F.min("start").alias("first_start"), F.max("end").alias("last_end"), F.bool_and("_ok").alias("contiguous"))
    sized = spans.join(contigs.select("chrom", "raw_bp"), "chrom")
    return sized.withColumn("closed", (F.col("first_start") <= 0) & (F.col("last_end") >= F.col("raw_bp")) & F.col("contiguous"))


def dilate(intervals: DataFrame, contigs: DataFrame, k: int) -> DataFrame:
    """Ends moved k - 2 bases on, not past the contig: what reads of k bases from here reach."""
    sized = intervals.join(contigs.select("chrom", F.col("raw_bp").alias("_bp")), "chrom")
    return sized.withColumn("end", F.least(F.col("end") + (k - 2), F.col("_bp"))).where("start < end").drop("_bp")


def in_order(df: DataFrame, name: Column) -> DataFrame:
    """Rows sorted by a canonical rank, then start and end; for sinks that need an order."""
    from strandlake.functions.columns import chrom_rank

    return df.orderBy(chrom_rank(name), name, "start", "end")
