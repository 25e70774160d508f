"""Interval and track operators against sets of bases, with tiles and bins small enough to matter."""

import random

from strandlake.operators import intervals as iv
from strandlake.operators import tracks as tr

CONTIGS = [("a", 97), ("chrb", 60), ("c", 40)]


def _random(seed, n):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        chrom, bp = r.choice(CONTIGS[:2] + [("zz", 50)])
        s = r.randrange(bp)
        rows.append((chrom, s, s + r.randint(1, 12)))
    return rows + rows[: n // 4]


def _df(spark, rows):
    return spark.createDataFrame(rows, "chrom string, start long, end long")


def _bases(rows):
    return {(c, i) for c, s, e in rows for i in range(s, e)}


def _runs(bases):
    out = []
    for c, i in sorted(bases):
        if out and out[-1][0] == c and out[-1][2] == i:
            out[-1][2] = i + 1
        else:
            out.append([c, i, i + 1])
    return sorted(tuple(x) for x in out)


def _rows(df):
    return sorted((r["chrom"], r["start"], r["end"]) for r in df.select("chrom", "start", "end").collect())


def test_merge_over_tiles(spark):
    for seed in range(3):
        rows = _random(seed, 40)
        for tile in (7, 1 << 20):
            assert _rows(iv.merge(_df(spark, rows), tile=tile)) == _runs(_bases(rows))
    assert _rows(iv.merge(_df(spark, []))) == []


def test_sets_of_bases(spark):
    contigs = spark.createDataFrame(CONTIGS, "chrom string, raw_bp long")
    left, right = _random(1, 30), _random(2, 30)
    whole = {(c, i) for c, bp in CONTIGS for i in range(bp)}
    a, b = _bases(left) & whole, _bases(right) & whole
    assert _rows(iv.complement(contigs, _df(spark, left), tile=9)) == _runs(whole - a)
    assert _bases(_rows(iv.subtract(_df(spark, left), _df(spark, right), contigs))) == a - b
    assert _rows(iv.union(_df(spark, left), _df(spark, right))) == _runs(_bases(left) | _bases(right))
    rows = sorted(left)
    assert _rows(iv.semi(_df(spark, rows), _df(spark, right), 5)) == [r for r in rows if _bases([r]) & _bases(right)]
    assert _rows(iv.anti(_df(spark, rows), _df(spark, right), 5)) == [r for r in rows if not _bases([r]) & _bases(right)]
    beyond = _df(spark, [("a", 97, 120), ("c", 200, 210)])
    assert _rows(iv.complement(contigs, beyond, tile=9)) == sorted((c, 0, bp) for c, bp in CONTIGS)
    pieces = iv.intersect(iv.merge(_df(spark, left)), iv.merge(_df(spark, right)), width=5)
    assert _bases(_rows(pieces)) == _bases(left) & _bases(right)
    assert pieces.count() == len(_rows(pieces))
    cover = iv.coverage_bins(contigs, _df(spark, left), 7).collect()
    assert len(cover) == 7 * len(CONTIGS)
    for r in cover:
        assert r["covered_bp"] == len([i for i in range(r["start"], r["end"]) if (r["chrom"], i) in a])


def test_closed_span_looks_at_the_row_before(spark):
    contigs = spark.createDataFrame([("a", 30), ("b", 30)], "chrom string, raw_bp long")
    masks = _df(spark, [("a", 0, 30), ("a", 2, 5), ("a", 9, 30), ("b", 0, 12), ("b", 12, 40)])
    for tile in (4, 1 << 20):
        found = {r["chrom"]: r["closed"] for r in iv.closed_span(masks, contigs, tile).collect()}
        assert found == {"a": False, "b": True}


def test_multi_read_against_bases(spark):
    contigs = spark.createDataFrame([("a", 60)], "chrom string, raw_bp long")
    for k, tile in ((5, 1 << 20), (11, 13)):
        unique = [("a", 3, 9), ("a", 20, 41), ("a", 55, 60)]
        seg = tr.multi_read(_df(spark, unique), contigs, k, tile).collect()
        got = {}
        for r in seg:
            for i in range(r["start"], r["end"]):
                got[i] = r["at_start"] + r["slope"] * (i - r["start"])
        ind = [int(any(s <= i < e for _, s, e in unique)) for i in range(60)]
        assert got == {i: sum(ind[max(0, i - k + 1) : i + 1]) for i in range(60)}


def test_mean_tracks_against_bases(spark):
    import numpy as np

    contigs = spark.createDataFrame([("a", 90)], "chrom string, raw_bp long")
    for k, tile in ((5, 1 << 20), (11, 13), (200, 16)):
        unique = [("a", 0, 2), ("a", 3, 9), ("a", 20, 61), ("a", 85, 90)]
        ind = [int(any(s <= i < e for _, s, e in unique)) for i in range(90)]
        mean = [float(np.float32(sum(ind[max(0, i - k + 1) : i + 1]) / min(i + 1, k))) for i in range(90)]
        want, i = [], 0
        while i < 90:
            j = next((j for j in range(i, 90) if mean[j] != mean[i]), 90)
            want += [("a", i, j, mean[i])] if mean[i] else []
            i = j
        got = tr.multi_mean(_df(spark, unique), contigs, k, tile).collect()
        assert sorted((r["chrom"], r["start"], r["end"], r["score"]) for r in got) == want


def test_means_inside_ramps_are_not_shuffled(spark, monkeypatch):
    contigs = spark.createDataFrame([("a", 9_000), ("b", 2_000)], "chrom string, raw_bp long")
    unique = _df(spark, [("a", 0, 700), ("a", 1_400, 2_100), ("a", 2_800, 9_000), ("b", 40, 700)])
    merged, run_length = [], tr.run_length
    monkeypatch.setattr(tr, "run_length", lambda runs, *a: merged.append(runs.count()) or run_length(runs, *a))
    got = tr.multi_mean(unique, contigs, 500).collect()
    assert len(got) > 2_000
    assert sum(merged) < 600  # "b" has 460 bases of its own before base 499


def test_thresholds_are_single_precision(spark):
    runs = spark.createDataFrame([("a", 0, 5, 0.9), ("a", 5, 8, float("nan")), ("a", 8, 12, 0.95)], "chrom string, start long, end long, score float")
    assert _rows(tr.islands(runs, 0.9)) == [("a", 0, 5), ("a", 8, 12)]
    assert _rows(tr.islands(runs, 0.9, 5)) == [("a", 0, 5)]
