"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins; shallow trees on one feature at a time, in turn, are boosted with a small
step, and as a tree of one feature only adds to the bins of that feature, all its trees are one lookup table in the
end. The pairs of features that explain most of what is left get tables of two indices in the same way. A score is
the logistic of a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.textstats import FEATURES, labelled, matrix


@dataclass
class Gam:
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for table, at in zip(self.tables, self.bins(x, self.edges), strict=True):
            total += table[at]
        if self.pairs:
            at = self.bins(x, self.coarse)
            for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
                total += table[at[a], at[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, most: int) -> np.ndarray:
    found = np.unique(values)
    if len(found) > most:
        found = np.unique(np.quantile(values, np.linspace(0, 1, most + 1)))
    return (found[1:] + found[:-1]) / 2


def _tree(g: np.ndarray, h: np.ndarray, depth: int, smooth: float = 1.0) -> np.ndarray:
    """Newton steps of the leaves of a tree over ordered bins with gradients g and weights h."""
    out = np.full(len(g), g.sum() / (h.sum() + smooth))
    if depth == 0 or len(g) < 2:
        return out
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl**2 / (hl + smooth) + (g.sum() - gl) ** 2 / (h.sum() - hl + smooth)
    k = int(gain.argmax()) + 1
    if gain[k - 1] <= g.sum() ** 2 / (h.sum() + smooth) + 1e-12:
        return out
    out[:k], out[k:] = _tree(g[:k], h[:k], depth - 1, smooth), _tree(g[k:], h[k:], depth - 1, smooth)
    return out


def _step2(g: np.ndarray, h: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """A tree over two indices: the best cut of the first, then of the second on either side."""
    gains = []
    for k in range(1, len(g)):
        gains.append(sum(np.abs(_tree(g[s].sum(0), h[s].sum(0), 1, smooth) * g[s].sum(0)).sum() for s in (slice(k), slice(k, None))))
    out = np.zeros_like(g)
    k = int(np.argmax(gains)) + 1 if gains else len(g)
    for s in (slice(k), slice(k, None)):
        if g[s].size:
            out[s] = _tree(g[s].sum(0), h[s].sum(0), 1, smooth)
    return out


def fit(x: np.ndarray, y: np.ndarray, *, rounds: int = 120, rate: float = 0.1, depth: int = 2, bins: int = 48, pairs: int = 4, pair_bins: int = 16, pair_rounds: int = 30) -> Gam:
    """The tables. Without rows every score is 1/2; with one label only, near that label."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Gam([_edges(x[:, f], bins) for f in range(x.shape[1])] if len(x) else [np.zeros(0)] * x.shape[1], [_edges(x[:, f], pair_bins) for f in range(x.shape[1])] if len(x) else [np.zeros(0)] * x.shape[1], float(np.log(share / (1 - share))))
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if not len(x) or y.min() == y.max():
        return model
    at = model.bins(x, model.edges)
    total = np.full(len(x), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            g, h = slopes()
            step = rate * _tree(np.bincount(at[f], g, len(table)), np.bincount(at[f], h, len(table)), depth)
            table += step
            total += step[at[f]]
    low = model.bins(x, model.coarse)
    sizes = [len(e) + 1 for e in model.coarse]
    g, h = slopes()

    def cells(a: int, b: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(low[a] * sizes[b] + low[b], v, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    worth = {(a, b): float((cells(a, b, g) ** 2 / (cells(a, b, h) + 1)).sum()) for a, b in combinations(range(x.shape[1]), 2)}
    model.pairs = sorted(worth, key=lambda p: (-worth[p], p))[:pairs]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            step = rate * _step2(cells(a, b, g), cells(a, b, h))
            table += step
            total += step[low[a], low[b]]
    return model


def held_out(doc_id: Column) -> Column:
    """True for a fifth of the ids, of which no label is learned; a null id counts as not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 20_000, **options) -> Gam:
    """A model from at most `most_rows` labelled documents that are not held out; inputs are texts' statistics only."""
    rows = labelled(docs, labels.where(~held_out(F.col("doc_id"))), label, most_rows).toPandas().sort_values(["doc_id", *FEATURES])
    return fit(rows[list(FEATURES)].to_numpy(np.float64).reshape(len(rows), len(FEATURES)), rows[label].to_numpy(np.float64), **options)


def score(model: Gam, text: Column) -> Column:
    """The score of a whole text, from 0 to 1."""

    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(model.scores(matrix(batch)), dtype="float64")

    return F.pandas_udf(scored, "double")(text)


def classified(docs: DataFrame, model: Gam, threshold: float = 0.3) -> DataFrame:
    """One row for each row: doc_id, held_out, score, predicted (1 from the threshold on).

    A null text counts as an empty one, which has a score too; equal texts have equal scores; repeated rows stay;
    an empty table gives no rows.
    """
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(model, F.col("text")).alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
