"""Statistics of whole texts, from which quality rules and quality scores are learned.

One pass over a text in a Python task; only numbers return to the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log1p

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.common import WORD

_words = re.compile(WORD).findall
_SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in a is that it for was on are with as he be at by this had not but from or have an they which one you were all we when there can more if no out so up what about into than them only some"
    " der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man"
    " le la les de des et un une du en que est pour qui dans par sur pas plus au ne se ce il sont avec son nous mais ou cette leur elle été être sa aux ont"
    " el los las y que del se por con una su para como más pero sus al lo fue este ha sí porque esta entre cuando muy sin sobre también me hasta hay donde".split()
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "bang_rate",
    "bar_rate", "adjacent_share", "stop_rate", "stop_share", "short_share", "top_share", "digit_share", "mean_line",
)


def measure(text: str | None) -> tuple:
    """COUNTS, then FEATURES; of a null or empty text and of one without words all are 0."""
    words = _words(text) if text else []
    n = len(words)
    if not n:
        return (0,) * len(COUNTS) + (0.0,) * len(FEATURES)
    chars = sum(map(len, words))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    dups = len(lines) - len(set(lines))
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    distinct = len(seen)
    repeated = 0
    if n > 2:
        pairs = ids[:-1] * distinct + ids[1:]
        if distinct > 2_000_000:  # three numbers no longer fit 64 bits: number the pairs first
            pairs = np.unique(pairs, return_inverse=True)[1]
        windows = pairs[:-1] * distinct + ids[2:]
        order = np.argsort(windows, kind="stable")
        same = np.diff(windows[order]) == 0
        again = np.zeros(n - 2, bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : n - 2 + k] |= again
        repeated = int(covered.sum())
    stops = sum(w in STOP_WORDS for w in words)
    return (
        n, chars, symbols, dups, repeated,
        log1p(n), chars / n, symbols / chars, dups / len(lines), repeated / n, distinct / n, sum(map(str.isupper, words)) / n, text.count("!") / n,
        text.count("|") / n, float(np.count_nonzero(ids[1:] == ids[:-1])) / n, text.count(".") / n, stops / n, sum(len(w) < 3 for w in words) / n,
        float(np.bincount(ids).max()) / n, sum(map(str.isdigit, words)) / n, log1p(n / len(lines)),
    )


_SCHEMA = ", ".join([f"{x} long" for x in COUNTS] + [f"{x} double" for x in FEATURES])


def _measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure(x) for x in batch], columns=[*COUNTS, *FEATURES])


def stats(text: Column) -> Column:
    """A struct of COUNTS (long) and FEATURES (double) of a whole text."""
    return F.pandas_udf(_measured, _SCHEMA)(text)


def matrix(texts: pd.Series) -> np.ndarray:
    """FEATURES of many texts, a row each."""
    return np.array([measure(x)[len(COUNTS) :] for x in texts], np.float64).reshape(len(texts), len(FEATURES))


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int, seed: int = 7) -> DataFrame:
    """FEATURES and `label` of at most `most` labelled documents, the first ones by a hash of doc_id.

    The bound is what makes it safe to broadcast the chosen ids and to gather the rows on the driver. Of rows of
    labels with the same doc_id the least label counts; null ids and labels don't. Of documents with the same doc_id
    each row counts.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).alias("_label"))
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
        .limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.select("doc_id", "_label", stats(F.col("text")).alias("s")).select("doc_id", F.col("_label").cast("int").alias(label), *(f"s.{x}" for x in FEATURES))
