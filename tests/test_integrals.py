"""Sums over labelled intervals by prefix sums, against a loop over bases."""

import random

import pytest
from pyspark.sql import functions as F

from strandlake.operators import integrals
from strandlake.operators import territory as te


@pytest.mark.parametrize("tile", [1, 7, 64, 1 << 17])
def test_between_by_brute_force(spark, tile):
    r = random.Random(tile)
    size = {"a": 400, "b": 90, "c": 50}
    scores, inside, labels = [], [], []
    for c, n in size.items():
        at = 0
        while c != "c" and at < n - 30:
            at += r.choice([0, 0, 5, 25])
            end = at + r.randint(1, 20)
            (scores if r.random() < 0.7 else inside).append((c, at, end, r.randint(-3, 9)))
            at = end
        for k in range(25):
            x = r.randint(0, n)
            labels.append((c, x, min(n, x + r.choice([0, 1, 10, 300])), r.choice(["x", "y", None, f"own{k}"])))
    labels.append(("d", 3, 9, "elsewhere"))
    schema = "chrom string, start long, end long, v long"
    tracks = [(spark.createDataFrame(scores, schema), {"score": F.col("v"), "high": (F.col("v") > 5).cast("int")}), (spark.createDataFrame(inside, schema), {"inside": F.lit(1)}), (spark.createDataFrame([("a", 5, 200, 0), ("b", 0, 90, 0)], schema), {"set": F.lit(1)})]
    measures = {"both": lambda s: s("set") * s("score"), "high": lambda s: s("high"), "out": lambda s: 1 - s("inside")}
    got = integrals.between(tracks, spark.createDataFrame(labels, "chrom string, start long, end long, name string"), ["name", "chrom"], measures, tile)
    value = lambda rows, c, i: sum(v for k, s, e, v in rows if k == c and s <= i < e)
    want = {}
    for c, s, e, name in labels:
        sums = want.setdefault((name, c), [0, 0, 0])
        for i in range(s, e):
            sums[0] += value([("a", 5, 200, 1), ("b", 0, 90, 1)], c, i) * value(scores, c, i)
            sums[1] += any(v > 5 for k, x, y, v in scores if k == c and x <= i < y)
            sums[2] += not any(k == c and x <= i < y for k, x, y, _ in inside)
    assert {(x["name"], x["chrom"]): [x["both"], x["high"], x["out"]] for x in got.collect()} == want


def test_between_without_rows(spark):
    none = spark.createDataFrame([], "chrom string, start long, end long")
    labels = spark.createDataFrame([("a", 0, 9)], "chrom string, start long, end long")
    measures = {"n": lambda s: s("x")}
    assert integrals.between([(none, {"x": F.lit(1)})], none, ["chrom"], measures).count() == 0
    assert integrals.between([(none, {"x": F.lit(1)})], labels, ["chrom"], measures).collect()[0]["n"] == 0


def test_no_range_join_in_a_territory_table(spark):
    contigs = spark.createDataFrame([("a", 100)], "chrom string, raw_bp long")
    rows = lambda *x: spark.createDataFrame([("a", *s) for s in x], "chrom string, start long, end long")
    sets = te.base_sets(contigs, rows((0, 10), (5, 20)), rows((50, 60)), rows((70, 75)))
    runs = spark.createDataFrame([("a", 0, 30, 2), ("a", 55, 100, 4)], "chrom string, start long, end long, h long")
    table = te.table(rows((0, 100)).withColumn("label", F.lit("all")), ["label"], sets, runs, "h", {"t50_bp": F.col("h") > 3, "t70_bp": F.col("h") > 3, "t90_bp": F.col("h") > 4})
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(sequence" not in plan and "r_start" not in plan
    assert table.collect()[0].asDict() == {"label": "all", "raw_bp": 100, "gap_bp": 20, "nongap_bp": 80, "structural_bp": 70, "callable_bp": 65, "effective": 10 * 2 + 40 * 4, "t50_bp": 40, "t70_bp": 40, "t90_bp": 0}
