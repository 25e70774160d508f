"""Exact top-k search by inner product: exhaustive, term at a time.

A term is a component of a vector other than 0. Candidates are dealt to tiles; the vectors of a tile are kept as
postings, for each term the rows that hold it with their weights. A query is a sparse row: for each of its terms the
weighted postings are scattered into a dense array of scores, one for each row of the tile. A term that most rows of a
tile hold has its postings as a whole column, so that they are added rather than scattered. The best k of a tile are
found by partition, and those of all tiles are merged; a query leaves k rows at most of each tile.

Queries pass by the tiles in blocks; what is copied is the query set, once for each tile, not the candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.common import released, settled

#: Candidates of a tile.
TILE = 1 << 13
#: Share of a tile's rows from which a term's postings are kept as a column.
DENSE = 0.25
#: Whole numbers that a double holds exactly.
EXACT = 1 << 53


def whole(vector: Column, scale: int = 256) -> Column:
    """Components as floor(scale * x) in doubles; null for a vector that is null or holds a null, NaN or infinite one."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # Spark's floor() of a double is a long: what no long holds is a whole number already
    down = lambda x: F.when(F.abs(x) < F.lit(float(EXACT)), F.floor(x).cast("double")).otherwise(x)
    return F.when(fine, F.transform(vector, lambda x: down(x.cast("double") * F.lit(float(scale)))))


class Postings:
    """The vectors of a tile by term."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")  # ties go to the smaller id, so to the earlier row
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.copies = ids[order], copies[order]
        rows = np.repeat(place, lengths)
        terms = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        held = values != 0
        by_term = np.argsort(terms[held], kind="stable")
        terms, rows, weights = terms[held][by_term], rows[held][by_term], values[held][by_term]
        self.most = float(np.abs(weights).max(initial=0.0))
        cuts = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1]))) if len(terms) else np.zeros(0, np.int64)
        self.lists: dict[int, tuple[np.ndarray | None, np.ndarray]] = {}
        for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(terms)], strict=True):
            if y - x >= DENSE * len(ids):
                column = np.zeros(len(ids))
                column[rows[x:y]] = weights[x:y]
                self.lists[int(terms[x])] = None, column
            else:
                self.lists[int(terms[x])] = rows[x:y], weights[x:y]

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The inner product of every row with a query, exact: in doubles while they hold it, else in Python's integers."""
        if float(np.abs(weights).sum()) * self.most < EXACT:
            total = np.zeros(len(self.ids))
            for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
                if t in self.lists:
                    rows, held = self.lists[t]
                    if rows is None:
                        total += w * held
                    else:
                        total[rows] += w * held
            return total
        exact = np.zeros(len(self.ids), object)
        for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
            if t in self.lists:
                rows, held = self.lists[t]
                exact[slice(None) if rows is None else rows] += np.array([int(w) * int(x) for x in held], object)
        return exact

    def best(self, query: int, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(id, score) of the k best rows but the query's own, a row for each copy, the score within the limits of a long."""
        scores = self.scores(terms, weights)
        others = np.flatnonzero(self.ids != query)
        own = scores[others]
        if len(own) > k:
            least = np.sort(own)[-k] if own.dtype == object else np.partition(own, len(own) - k)[len(own) - k]
            above, ties = np.flatnonzero(own > least), np.flatnonzero(own == least)
            chosen = np.concatenate([above, ties[: k - len(above)]])
        else:
            chosen = np.arange(len(own))
        found = sorted((-int(own[x]), int(self.ids[others[x]]), int(self.copies[others[x]])) for x in chosen)
        listed = [(i, -s) for s, i, n in found for _ in range(min(n, k))]
        return [(i, min(max(s, -(1 << 63)), (1 << 63) - 1)) for i, s in listed[:k]]


def _searched(k: int, block: int = 256):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        column = batch.column(4)
        return column.value_lengths().to_numpy().astype(np.int64), column.flatten().to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, parts, postings = None, [], None
        for whole_batch in batches:
            tiles, sides = whole_batch.column(0).to_numpy(), whole_batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(tiles) != 0) | (np.diff(sides) != 0)) + 1).tolist(), len(whole_batch)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if x == y:
                    continue
                if tiles[x] != tile:
                    tile, parts, postings = tiles[x], [], None
                part = whole_batch.slice(x, y - x)
                if sides[x] == 0:
                    parts.append((part.column(2).to_numpy(), part.column(3).to_numpy(), *flat(part)))
                    continue
                if postings is None:
                    if not parts:
                        continue
                    postings, parts = Postings(*(np.concatenate(c) for c in zip(*parts, strict=True))), []
                for z in range(0, len(part), block):
                    rows = part.slice(z, block)
                    lengths, values = flat(rows)
                    ends = np.cumsum(lengths)
                    found = []
                    for q, e, n in zip(rows.column(2).to_pylist(), ends.tolist(), lengths.tolist(), strict=True):
                        own = values[e - n : e]
                        terms = np.flatnonzero(own)
                        found += [(q, i, s) for i, s in postings.best(q, terms, own[terms], k)]
                    yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(3)], schema=schema)
        released()

    return run


def searched(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, tile: int = TILE, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k rows with the highest inner product with each query, ties to the smaller id.

    Queries are the rows whose id is divisible by `every`; candidates all rows but those with the query's own id.
    Components count as floor(scale * x). Vectors that are null or hold a null or a component that is not finite take no
    part, nor do rows without an id. A vector has as many components as it lists: those that another has beyond count 0
    in it; an empty one scores 0. A query that has fewer candidates lists all. Candidates that are repeated rows are
    candidates each; a query that is repeated is asked once, one whose id has several vectors with each of them. A score
    beyond a long is ranked by what it is and shown as the nearest long. An empty table gives no rows; further columns
    play no part.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), whole(F.col(vector), scale).alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    # copies of a row are one with their number, so that a row repeated very often is no large tile
    rows = settled(rows.groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies")))
    tiles = max(1, -(-rows.count() // tile))
    candidates = rows.select(F.expr(f"pmod(xxhash64(id, v), {tiles}L)").alias("tile"), F.lit(0).alias("side"), "id", "copies", "v")
    queries = rows.where(F.col("id") % every == 0).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias("tile"), F.lit(1).alias("side"), "id", "copies", "v")
    dealt = candidates.unionByName(queries).repartition("tile").sortWithinPartitions("tile", "side", "id")
    found = dealt.mapInArrow(_searched(k), "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(every: int = 50, k: int = 5, scale: int = 256) -> str:
    """The same in DuckDB: each query with each row."""
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= {k}"""
