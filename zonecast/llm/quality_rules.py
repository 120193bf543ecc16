"""Quality rules: a decision list learned by sequential covering.

From labelled statistics, rules against low quality are learned one after
another. A rule grows by the threshold condition of highest information gain
until it covers no good document of the growing part, is pruned to the prefix
that does best on the pruning part, and is kept if it is precise there; what
it covers is taken away before the next rule is grown. The list becomes one
ordered ``CASE WHEN`` over the statistics, so applying it is a plain scan.

Learning runs on Spark over at most about ``SAMPLE`` labelled documents: each
step is one aggregation that counts, for every feature and threshold interval,
good and bad documents (features x intervals rows reach the driver).

Defined cases: a null text has no words and fails the base rule; without
labels of both kinds the list is empty and the base rule alone decides; null
and repeated ids keep their rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.statistics import FEATURES, labelled_statistics, with_statistics
from zonecast.llm.storage import documents, picked

SAMPLE = 20_000
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9
MIN_COVERED = 5
PROBABILITIES = [0.01, 0.03, 0.05, *[i / 20 for i in range(2, 19)], 0.92, 0.94, 0.96, 0.98, 0.99]


@dataclass(frozen=True)
class Condition:
    """feature > threshold, or feature <= threshold."""
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold


@dataclass
class DecisionList:
    """Rules against low quality, first match decides; what none matches is kept."""
    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def verdict(self) -> Column:
        out = F.lit(True)
        for rule in reversed(self.rules):
            out = F.when(_all(rule), F.lit(False)).otherwise(out)
        return out

    def text(self) -> str:
        show = lambda c: f"{c.feature} {'>' if c.above else '<='} {c.threshold:.6g}"
        return "\n".join(f"{i}. drop if " + " and ".join(map(show, r)) for i, r in enumerate(self.rules, 1))


def _all(rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _thresholds(table: DataFrame) -> dict[str, list[float]]:
    """Cut points of each feature: quantiles of the good and of the bad documents."""
    asked = F.array(*map(F.lit, PROBABILITIES))
    rows = table.groupBy("quality").agg(
        *[F.percentile_approx(f, asked, F.lit(1000)).alias(f) for f in FEATURES]).collect()
    return {f: sorted({x for r in rows for x in r[f]}) for f in FEATURES}


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict:
    """(feature, interval) -> (bad, good); interval k lies above k of the cut points."""
    place = lambda f: F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda t: t < F.col(f)))
    cell = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), place(f).alias("k")) for f in FEATURES]))
    got = (rows.select("quality", cell.alias("c")).groupBy("c.f", "c.k")
           .agg(F.sum((F.col("quality") == 0).cast("long")).alias("bad"),
                F.sum((F.col("quality") != 0).cast("long")).alias("good")).collect())
    return {(r["f"], r["k"]): (r["bad"], r["good"]) for r in got}


def _best(counts: dict, cuts: dict[str, list[float]]) -> tuple[Condition | None, int]:
    """The condition of highest gain, and the good documents it still covers."""
    bad0 = sum(b for (f, _), (b, _) in counts.items() if f == FEATURES[0])
    good0 = sum(g for (f, _), (_, g) in counts.items() if f == FEATURES[0])
    if not bad0 or not good0:
        return None, good0
    before = math.log2(bad0 / (bad0 + good0))
    best, gain, left = None, 0.0, good0
    for f in FEATURES:
        bad = good = 0
        for k, threshold in enumerate(cuts[f]):
            b, g = counts.get((f, k), (0, 0))
            bad, good = bad + b, good + g
            for above, p, n in ((False, bad, good), (True, bad0 - bad, good0 - good)):
                if p < MIN_COVERED:
                    continue
                now = p * (math.log2(p / (p + n)) - before)
                # between thresholds that cover the same, the one that drops less
                same = above and best is not None and best.feature == f and best.above and abs(now - gain) <= 1e-9
                if now > gain + 1e-9 or same:
                    best, gain, left = Condition(f, above, threshold), now, n
    return best, left


def learn(table: DataFrame) -> DecisionList:
    """The decision list for a table of doc_id, quality (0: bad) and FEATURES."""
    listed = DecisionList()
    kinds = {r["quality"] for r in table.select("quality").distinct().collect()}
    if 0 not in kinds or len(kinds) < 2:
        return listed
    cuts = _thresholds(table)
    part = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3))
    for _ in range(MAX_RULES):
        left = table.where(listed.verdict())
        grow, rule, good = left.where(part > 0), (), 1
        while good and len(rule) < MAX_CONDITIONS:
            condition, good = _best(_counts(grow.where(_all(rule)), cuts), cuts)
            if condition is None:
                break
            rule += (condition,)
        if not rule:
            break
        worth = []                                            # of each prefix, on the pruning part
        sums = [F.sum((_all(rule[:i]) & (F.col("quality") == q)).cast("long")).alias(f"c{i}_{q}")
                for i in range(1, len(rule) + 1) for q in (0, 1)]
        row = left.where(part == 0).agg(*sums).first()
        for i in range(1, len(rule) + 1):
            bad, well = row[f"c{i}_0"] or 0, row[f"c{i}_1"] or 0
            worth.append(((bad - well) / (bad + well) if bad + well else -1.0, bad, -i, bad / max(bad + well, 1)))
        value, bad, length, precision = max(worth)
        if precision < MIN_PRECISION or not bad:
            break
        listed.rules.append(rule[:-length])
    return listed


def apply_rules(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """doc_id, the statistics, base_failed and kept of every document."""
    rows = with_statistics(picked(docs, "doc_id", "text"), F.col("text"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & rules.verdict()).alias("kept"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    table = labelled_statistics(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), SAMPLE)
    return apply_rules(docs, learn(table))
