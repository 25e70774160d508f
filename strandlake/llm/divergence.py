"""How the sources of a language differ in the words that they use: an audit of all pairs of sources and of each source's own words.

A task lowers letters and blanks separators of a text's bytes in one pass of bytes.translate, and bytes.split gives its
words; a Counter for each document yields their frequencies and which words it holds. These are summed for each source
before they are shuffled, and only what occurs gets a row. A word that a source lacks still has a share of its own
there, which is the same for all such words of the source; so pairs of sources are compared in dense tiles: of some
thousand words and some hundred sources on either side, in arrays, of which only sums for each pair leave the task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.common import released, settled

#: Characters A to Z lowered, and bytes 0 to 64, 91 to 96 and 123 to 127 blanked; all others stay, those of UTF-8 sequences among them.
TRANSLATED = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 128 and not 97 <= b <= 122 else b for b in range(256))
#: Words summed in a task before they are passed on; bytes of a text that are split at a time.
HELD, PIECE = 200_000, 1 << 20
#: Words and sources of a tile.
WORDS, SOURCES = 4096, 128
SCALE = 1_000_000_000


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some of them at a time."""
    plain = text.translate(TRANSLATED)
    at = 0
    while len(plain) - at > PIECE:
        cut = plain.find(b" ", at + PIECE)
        if cut < 0:
            break
        yield plain[at:cut].split()
        at = cut
    yield plain[at:].split()


def frequencies(text: bytes) -> Counter:
    """How often a text holds each of its words."""
    found: Counter = Counter()
    for words in pieces(text):
        found.update(words)
    return found


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n and docs, of a part of the documents; and a row with a null term for each lang and source."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            terms = [None, *n]
            counts = [0, *n.values()]
            holders = [0, *map(docs.__getitem__, n)]
            for k in range(0, len(terms), 50_000):
                part = slice(k, k + 50_000)
                size = len(terms[part])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * size), pa.array([source] * size), pa.array(terms[part], pa.binary()), pa.array(counts[part], pa.int64()), pa.array(holders[part], pa.int64())], schema=_COUNTS)
        groups.clear()

    for batch in batches:
        for k in range(0, len(batch), 500):
            langs, sources, texts = (batch.column(c).slice(k, 500) for c in range(3))
            for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts.cast(pa.binary()).to_pylist(), strict=True):
                if (lang, source) not in groups:
                    groups[lang, source] = (Counter(), Counter())
                    held += 1
                n, docs = groups[lang, source]
                held -= len(n)
                own = frequencies(text)
                docs.update(own.keys())
                for term, count in own.items():
                    n[term] += count
                held += len(n)
                if held > HELD:
                    yield from flush()
                    held = 0
    yield from flush()
    released()


def counts(docs: DataFrame) -> DataFrame:
    """lang, source, term (UTF-8), n (occurrences), docs (documents that hold it); a null term for each lang and source that occurs."""
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    found = named.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str) -> str:
    """SQL of 1 + floor(SCALE * (n + 2) / total), in decimals, so that no count is too large."""
    return f"1L + cast(cast({n} + 2 AS decimal(19, 0)) * {SCALE}BD div cast({total} AS decimal(19, 0)) AS long)"


def _differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """As _share(); where the product would leave 64 bits, in Python's integers."""
    if not len(n) or n.max() < (1 << 63) // SCALE - 2:
        return 1 + SCALE * (n + 2) // total
    return np.array([1 + SCALE * (int(x) + 2) // int(t) for x, t in zip(n, total, strict=True)], np.int64)


def _tiles(kept: DataFrame, groups: DataFrame, words: int, sources: int) -> DataFrame:
    """lang, a, b, value: for each pair of sources of a language, the sum over a tile's words of how much their shares differ.

    kept: lang, source, term, n; groups: lang, source, place (from 0 within the language), total (of a share), v (words
    of the language). A tile has the sources of two blocks of places; its first rows, with a null term, say which these
    are, so that a source without any of its words is there too, and how many words it has.
    """
    sized = groups.withColumn("tiles", F.expr(f"greatest((v + {words - 1}) div {words}, 1L)")).withColumn("blocks", F.expr(f"cast((n_sources + {sources - 1}) div {sources} AS int)")).withColumn("own", F.expr(f"cast(place div {sources} AS int)"))
    side = sized.select("*", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")).select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    heads = side.select("lang", F.explode(F.expr("sequence(0L, tiles - 1)")).alias("tile"), "i", "j", "place", "total", F.lit(None).cast("binary").alias("term"), F.lit(0).cast("long").alias("n"))
    rows = kept.join(side.select("lang", "source", "i", "j", "place", "total", "tiles"), ["lang", "source"]).select("lang", F.expr("pmod(xxhash64(term), tiles)").alias("tile"), "i", "j", "place", "total", "term", "n")
    spans = kept.select("lang", "term").distinct().join(groups.groupBy("lang").agg(F.max("v").alias("v")), "lang")
    spans = spans.groupBy("lang", F.expr(f"pmod(xxhash64(term), greatest((v + {words - 1}) div {words}, 1L))").alias("tile")).agg(F.count(F.lit(1)).alias("here"))
    dealt = heads.unionByName(rows).join(spans, ["lang", "tile"], "left").withColumn("here", F.coalesce("here", F.lit(0)).cast("long"))

    def solve(tile: pd.DataFrame) -> pd.DataFrame:
        heads, cells = tile[tile["term"].isna()], tile[tile["term"].notna()]
        places, total = heads["place"].to_numpy(), heads["total"].to_numpy()
        order = np.argsort(places)
        places, total = places[order], total[order]
        here, i, j = (int(tile[c].iloc[0]) for c in ("here", "i", "j"))
        base = _shares(np.zeros(len(total), np.int64), np.maximum(total, 1))
        term = pd.factorize(cells["term"])[0]
        at = np.searchsorted(places, cells["place"].to_numpy())
        shares = np.repeat(base[:, None], term.max() + 1 if len(term) else 0, axis=1)
        shares[at, term] = _shares(cells["n"].to_numpy(), cells["total"].to_numpy())
        rest = here - shares.shape[1]  # words that none of these sources has
        block = places // sources
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        out = []
        for x in left:
            y = right[right > x] if i == j else right
            out.append(_differ(shares[x], shares[y]).sum(axis=1) + rest * _differ(base[x], base[y]))
        a = np.concatenate([np.full(len(v), places[x]) for x, v in zip(left, out, strict=True)])
        b = np.concatenate([places[right[right > x] if i == j else right] for x in left])
        return pd.DataFrame({"lang": tile["lang"].iloc[0], "a": a, "b": b, "value": np.concatenate(out)})

    return dealt.groupBy("lang", "tile", "i", "j").applyInPandas(solve, "lang string, a long, b long, value long")


def audited(docs: DataFrame, least_docs: int = 10, most_terms: int = 10, words: int = WORDS, sources: int = SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others of its language, and its own words.

    A language keeps the words that `least_docs` of its documents hold. A group of n_i occurrences of each, N in all, of
    V words, gives a word the share p = 1 + floor(10**9 (n_i + 2) / (N + 2 V)). Part pair: each other source of the
    language, with the sum of floor((p - q)**2 / (p + q)) over all kept words, 0 without any. Part term: of the words
    that the source holds and that have a higher share there than in the whole language, the `most_terms` with the
    highest value of their own. Ranks are from 1, by value descending, then by the item's bytes.

    A null text, lang or source counts as an empty one; a document without words still makes its group occur; each row
    is a document, repeated rows too; an empty table gives no rows; further columns play no part.
    """
    tallied = settled(counts(docs))
    seen = tallied.where("term IS NOT NULL")
    terms = seen.groupBy("lang", "term").agg(F.sum("docs").alias("df"), F.sum("n").alias("n_lang")).where(F.col("df") >= least_docs).drop("df")
    kept = settled(seen.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"))
    langs = kept.select("lang", "term", "n_lang").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("all"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    everywhere = tallied.where("term IS NULL").select("lang", "source")
    within = Window.partitionBy("lang")
    groups = everywhere.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("v", F.lit(0)).cast("long").alias("v"), F.expr("coalesce(own, 0) + 2 * coalesce(v, 0)").alias("total"), F.expr("coalesce(all, 0) + 2 * coalesce(v, 0)").alias("total_lang"))
    groups = settled(groups.withColumn("place", F.row_number().over(within.orderBy("source")).cast("long") - 1).withColumn("n_sources", F.count(F.lit(1)).over(within)))

    met = _tiles(kept.select("lang", "source", "term", "n"), groups, words, sources).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = met.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"), "value").select("lang", "x.a", "x.b", "value")
    named = lambda side, name: groups.select("lang", F.col("place").alias(side), F.col("source").alias(name))
    pairs = both.join(named("a", "source"), ["lang", "a"]).join(named("b", "item"), ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(by))

    shared = kept.join(groups.select("lang", "source", "total", "total_lang"), ["lang", "source"])
    shared = shared.withColumn("p", F.expr(_share("n", "total"))).withColumn("q", F.expr(_share("n_lang", "total_lang"))).where("n > 0 AND p > q")
    own = shared.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    own = own.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= most_terms)  # each task keeps no more for a source before they are shuffled
    return pairs.unionByName(own).select("lang", "source", "part", "item", "value", "rank")


def oracle(least_docs: int = 10, most_terms: int = 10) -> str:
    """The same in DuckDB: every pair of sources over every kept word."""
    share = f"1 + {SCALE}::HUGEINT * ({{0}} + 2) // {{1}}"
    return f"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS MATERIALIZED (SELECT i, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, count(*)::BIGINT AS n FROM w GROUP BY ALL HAVING count(DISTINCT i) >= {least_docs}),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
z AS MATERIALIZED (SELECT g.lang, g.source, k.term, k.n AS n_lang, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
t AS (SELECT lang, source, sum(n) AS own FROM z GROUP BY ALL),
p AS MATERIALIZED (SELECT z.*, {share.format('z.n', '(own + 2 * v)')} AS p, {share.format('n_lang', '(total + 2 * v)')} AS q FROM z JOIN t USING (lang, source) JOIN l USING (lang)),
pr AS (SELECT a.lang, a.source, b.source AS item, coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
tm AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q),
u AS (SELECT lang, source, 'pair' AS part, item, value FROM pr UNION ALL SELECT lang, source, 'term', item, value FROM tm),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM u)
SELECT * FROM r WHERE part = 'pair' OR rank <= {most_terms}"""
