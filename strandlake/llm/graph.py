"""Connected components of an undirected graph, on Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import settled

#: Edges that one forest in memory takes.
FOREST = 100_000


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (a, b) to edges from each node to the least one that it is tied to by the edges of this piece."""

    def flush(up: dict) -> pd.DataFrame:
        rows = []
        for x in up:
            r = x
            while up[r] != r:
                r = up[r]
            up[x] = r
            if r != x:
                rows.append((x, r))
        return pd.DataFrame(rows, columns=["a", "b"])

    up: dict = {}
    seen = 0
    for batch in batches:
        for x, y in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            for z in (x, y):
                up.setdefault(z, z)
            while up[x] != x:
                up[x] = x = up[up[x]]
            while up[y] != y:
                up[y] = y = up[up[y]]
            up[max(x, y)] = min(x, y)
        seen += len(batch)
        if seen >= FOREST:
            yield flush(up)
            up, seen = {}, 0
    if up:
        yield flush(up)


def components(edges: DataFrame) -> DataFrame:
    """node and label (the least node reachable) for each node of the edges (a, b), of any one type that has an order.

    Where edges are made, before they are shuffled, and once more after that, pieces of them are replaced by stars
    with the same components, which leaves few edges and short paths. Then come rounds of joins: a node takes the
    least label among its neighbours and itself, then the label of that label. Labels only fall, so that rounds end
    when none does. The rows of each round are written to the shared folder.
    """
    kind = dict(edges.dtypes)["a"]
    schema = f"a {kind}, b {kind}"
    stars = edges.where("a <> b").select("a", "b").mapInPandas(_stars, schema).distinct()
    stars = settled(stars.repartition("b").mapInPandas(_stars, schema).distinct())  # by the least node: a piece sees whole stars
    both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    labels = settled(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = settled(lower.join(jump, "label").select("node", "old", F.least("label", "further").alias("label")))
        labels = moved.select("node", "label")
        if not moved.where("old <> label").take(1):
            return labels
