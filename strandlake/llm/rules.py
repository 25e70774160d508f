"""Quality rules: decision lists that sequential covering learns from labelled statistics.

A rule is a conjunction of thresholds on statistics of a text, such as upper_share > 0.41 and bang_rate > 0.2. It
is grown on two thirds of the labelled rows, condition by condition, by information gain, then pruned from its end
on the last third; it is taken if it is precise enough there, and the rows that it covers go before the next rule is
grown. The list becomes one conditional expression of Spark, in the order of the rules.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.textstats import COUNTS, FEATURES, labelled, stats


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def holds(self, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
        value = x[:, names.index(self.feature)]
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        return reduce(Column.__and__, (c.column() for c in self.conditions))

    def holds(self, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
        return reduce(np.logical_and, (c.holds(x, names) for c in self.conditions), np.ones(len(x), bool))

    def __str__(self) -> str:
        return " and ".join(f"{c.feature} {'>' if c.above else '<='} {c.threshold:.6g}" for c in self.conditions)


def _thresholds(values: np.ndarray, most: int) -> np.ndarray:
    found = np.unique(values)
    if len(found) > most:
        found = np.unique(np.quantile(values, np.linspace(0, 1, most)))
    return (found[1:] + found[:-1]) / 2


def _grow(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...], most_conditions: int, cuts: list[np.ndarray]) -> Rule:
    """Adds the condition of the largest gain until no good row is covered or none gains."""
    conditions: list[Condition] = []
    covered = np.ones(len(x), bool)
    while len(conditions) < most_conditions and (covered & ~bad).any():
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        base, best = log2(p / (p + n)), (1e-9, None)
        for f, name in enumerate(names):
            values = x[covered, f]
            at = np.searchsorted(cuts[f], values, side="left")  # thresholds below the value
            ps = np.bincount(at[bad[covered]], minlength=len(cuts[f]) + 1)
            ns = np.bincount(at[~bad[covered]], minlength=len(cuts[f]) + 1)
            lows = np.cumsum(ps)[:-1], np.cumsum(ns)[:-1]  # value <= threshold
            for above, (pp, nn) in ((False, lows), (True, (p - lows[0], n - lows[1]))):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - base), 0.0)
                if len(gain) and gain.max() > best[0]:
                    k = int(gain.argmax())
                    best = float(gain[k]), Condition(name, above, float(cuts[f][k]))
        if best[1] is None:
            break
        conditions.append(best[1])
        covered &= best[1].holds(x, names)
    return Rule(tuple(conditions))


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> tuple[Rule, float, int]:
    """Leaves out last conditions while that does not lower (p - n) / (p + n) on rows that the rule was not grown on."""
    best = (rule, -2.0, 0.0, 0)
    for k in range(len(rule.conditions), 0, -1):
        cut = Rule(rule.conditions[:k])
        held = cut.holds(x, names)
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[1] or worth == best[1] and p > best[3]:
            best = (cut, worth, p / (p + n) if p + n else 0.0, p)
    return best[0], best[2], best[3]


def learn(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...] = FEATURES, *, precision: float = 0.97, least: int = 5, most_rules: int = 24, most_conditions: int = 4, cuts: int = 64, seed: int = 7) -> list[Rule]:
    """The rules, in order. Without a bad or without a good row there are none."""
    third = np.random.default_rng(seed).permutation(len(x)) % 3 == 0
    grow, prune = (x[~third], bad[~third]), (x[third], bad[third])
    at = [_thresholds(grow[0][:, f], cuts) for f in range(len(names))] if len(grow[0]) else []
    rules: list[Rule] = []
    while len(rules) < most_rules and grow[1].any() and (~grow[1]).any():
        rule = _grow(*grow, names, most_conditions, at)
        if not rule.conditions:
            break
        rule, right, caught = _prune(rule, *prune, names)
        if right < precision or caught < least:
            break
        rules.append(rule)
        grow, prune = (tuple(a[~rule.holds(part[0], names)] for a in part) for part in (grow, prune))
    return rules


def learned(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 20_000, **options) -> list[Rule]:
    """Rules from at most `most_rows` labelled documents (label 0: bad), whose statistics come to the driver."""
    rows = labelled(docs, labels, label, most_rows).toPandas().sort_values(["doc_id", *FEATURES])
    return learn(rows[list(FEATURES)].to_numpy(np.float64), rows[label].to_numpy() == 0, **options)


def first_rule(rules: list[Rule]) -> Column:
    """The number, from 1, of the first rule that holds; 0 if none does."""
    if not rules:
        return F.lit(0)
    whens = F.when(rules[0].column(), F.lit(1))
    for k, rule in enumerate(rules[1:], 2):
        whens = whens.when(rule.column(), F.lit(k))
    return whens.otherwise(F.lit(0))


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row for each row: doc_id, COUNTS, base_failed, kept, and the number of the rule that rejected it.

    A null or empty text has no words, so base_failed is true and kept false. Repeated rows stay, ties and further
    columns play no part, an empty table gives no rows.
    """
    measured = docs.select("doc_id", stats(F.col("text")).alias("s")).select("doc_id", "s.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("rule", first_rule(rules)).select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
