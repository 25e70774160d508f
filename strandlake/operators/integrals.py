"""Integrals of tracks between marks, without a range join: a sum over an interval is a difference of two prefix sums.

A track is what holds over half-open runs that don't overlap within it: a value, or just that a base is in a set. The
edges of all tracks are the places where the state of a contig changes; between them every measure of the state is
constant. So the integral of all measures up to a place is a running sum over edges, and marks, the ends of labelled
intervals, are rows of the same order which take what has been summed when they come up. A label's sums are its ends
less its starts, however many intervals it has, whichever way these overlap.

Rows are ordered within tiles of fixed width. What a tile needs of those before it, their state and their integrals,
comes from summaries with a row for each tile.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.operators import intervals as iv

#: A track: its runs (chrom, start, end), and what a base of them adds to each channel of the state.
Track = tuple[DataFrame, dict[str, Column]]
#: A measure: a number for each base, told from the channels by their names.
Measure = Callable[[Callable[[str], Column]], Column]


def _edges(track: Track, channels: list[str]) -> DataFrame:
    """chrom, at and the change of each channel there, of both ends of each run."""
    runs, adds = track
    values = [adds.get(c, F.lit(0)).cast("long") for c in channels]
    sides = F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("by")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("by")))
    rows = runs.where("start < end").select("chrom", F.explode(sides).alias("_e"), *(v.alias(c) for c, v in zip(channels, values, strict=True)))
    return rows.select("chrom", F.col("_e.at").cast("long").alias("at"), *((F.col(c) * F.col("_e.by")).alias(c) for c in channels))


def between(tracks: list[Track], labels: DataFrame, by: list[str], measures: dict[str, Measure], tile: int = iv.TILE) -> DataFrame:
    """The sums of measures over the bases of each label's intervals: by, and a long for each measure.

    labels: chrom, start, end and `by`; a label without bases on any run gets zeros. measures: whole numbers for each
    base, made of the channels of tracks; where no run is, all channels are 0.
    """
    channels = list(dict.fromkeys(c for _, adds in tracks for c in adds))
    keys = [f"_by{k}" for k in range(len(by))]
    sides = F.array(F.struct(F.col("start").cast("long").alias("at"), F.lit(-1).alias("sign")), F.struct(F.col("end").cast("long").alias("at"), F.lit(1).alias("sign")))
    marks = labels.select("chrom", F.explode(sides).alias("_m"), *(F.col(b).alias(k) for b, k in zip(by, keys, strict=True)))
    marks = marks.select("chrom", F.col("_m.at").alias("at"), *(F.lit(0).cast("long").alias(c) for c in channels), F.col("_m.sign").alias("sign"), *keys)
    kinds = dict(marks.dtypes)
    edges = reduce(DataFrame.unionByName, (_edges(t, channels) for t in tracks))
    edges = edges.select("chrom", "at", *channels, F.lit(0).alias("sign"), *(F.lit(None).cast(kinds[k]).alias(k) for k in keys))
    rows = iv.in_tiles(edges.unionByName(marks), ["chrom"], "at", tile).repartition("chrom", "_tile")

    near, tiles = Window.partitionBy("chrom", "_tile"), Window.partitionBy("chrom").orderBy("_tile")
    within, before = near.orderBy("at"), tiles.rowsBetween(Window.unboundedPreceding, -1)
    entered, left = (lambda c: F.col(f"_in_{c}")), (lambda c: F.col(f"_out_{c}"))
    sums = rows.groupBy("chrom", "_tile").agg(*(F.sum(c).alias(c) for c in channels), F.min("at").alias("_first"))
    sums = sums.select("chrom", "_tile", "_first", F.lead("_tile").over(tiles).alias("_next"), *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_in_{c}") for c in channels), *(F.sum(c).over(tiles.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_out_{c}") for c in channels))
    head, gap = F.col("_first") - F.col("_tile") * tile, F.coalesce((F.col("_next") - F.col("_tile") - 1) * tile, F.lit(0))
    sums = sums.select("chrom", "_tile", *(f"_in_{c}" for c in channels), *((m(entered) * head).cast("long").alias(f"_head_{n}") for n, m in measures.items()), *((m(left) * gap).cast("long").alias(f"_gap_{n}") for n, m in measures.items()))
    # rows of one place all see its state, so that it doesn't matter which of them the window takes last
    so_far = within.rangeBetween(Window.unboundedPreceding, 0)
    state = rows.join(sums, ["chrom", "_tile"]).withColumns({c: F.sum(c).over(so_far) + F.col(f"_in_{c}") for c in channels} | {"_bases": F.coalesce(F.lead("at").over(within), (F.col("_tile") + 1) * tile) - F.col("at")})
    state = state.select("chrom", "_tile", "at", "sign", *keys, *((m(F.col) * F.col("_bases")).cast("long").alias(f"_own_{n}") for n, m in measures.items()), *(f"_{x}_{n}" for x in ("head", "gap") for n in measures))
    whole = state.groupBy("chrom", "_tile").agg(*(F.sum(f"_own_{n}").alias(f"_all_{n}") for n in measures), *(F.first(f"_{x}_{n}").alias(f"_{x}_{n}") for x in ("head", "gap") for n in measures))
    # the bases of earlier tiles, and of those between that have no row
    carried = whole.select("chrom", "_tile", *(F.coalesce(F.sum(F.col(f"_head_{n}") + F.col(f"_all_{n}") + F.col(f"_gap_{n}")).over(before), F.lit(0)).alias(f"_far_{n}") for n in measures))
    earlier = within.rangeBetween(Window.unboundedPreceding, -1)
    reached = state.select("chrom", "_tile", "sign", *keys, *((F.col(f"_head_{n}") + F.coalesce(F.sum(f"_own_{n}").over(earlier), F.lit(0))).alias(f"_near_{n}") for n in measures))
    signed = reached.where("sign <> 0").join(carried, ["chrom", "_tile"])
    found = signed.groupBy(*keys).agg(*(F.sum((F.col(f"_far_{n}") + F.col(f"_near_{n}")) * F.col("sign")).alias(n) for n in measures))
    return found.select(*(F.col(k).alias(b) for b, k in zip(by, keys, strict=True)), *measures)
