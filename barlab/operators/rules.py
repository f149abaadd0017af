"""Rules: parsing, merging bounds, and matching them against the feature frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.functions.scalars import CONDITION_PATTERN


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``(feature, op, threshold)``; text is only for display."""

    rule_id: int
    conditions: tuple[tuple[str, str, float], ...]

    def predicate(self) -> Column:
        """True where every condition holds; a null feature is no match."""
        result = F.lit(True)
        for feature, op, threshold in self.conditions:
            result = result & _compare(F.col(feature), op, F.lit(float(threshold)))
        return F.coalesce(result, F.lit(False))


def _compare(left: Column, op: str, right: Column) -> Column:
    return {
        "<": left < right,
        "<=": left <= right,
        ">": left > right,
        ">=": left >= right,
        "==": left == right,
    }[op]


def parse_conditions(rules: DataFrame) -> DataFrame:
    """``rule_id, pos, text, feature, op, threshold`` per condition text.

    A text of another shape gives null ``feature, op, threshold``.
    """
    exploded = rules.select("rule_id", F.posexplode("conditions").alias("pos", "text"))
    parts = {
        name: F.nullif(F.regexp_extract("text", CONDITION_PATTERN, i), F.lit(""))
        for i, name in enumerate(["feature", "op", "number"], start=1)
    }
    return (
        exploded.withColumns(parts)
        .withColumn("threshold", F.expr("try_cast(number AS double)"))
        .withColumns({c: F.when(F.col("threshold").isNotNull(), F.col(c)) for c in ["feature", "op"]})
        .drop("number")
    )


def rejected_rules(parsed: DataFrame) -> DataFrame:
    """Rules with a condition that cannot be read. They are not applied."""
    return parsed.filter(F.col("threshold").isNull()).groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("n_bad"), F.min("text").alias("example")
    )


def merge_bounds(parsed: DataFrame) -> DataFrame:
    """One row per (rule, feature): the tightest bounds its conditions leave.

    ``lower``/``upper`` with ``lower_closed``/``upper_closed``; at equal numbers
    the open bound is the tighter one.
    """
    is_lower, is_upper = F.col("op").isin(">", ">=", "=="), F.col("op").isin("<", "<=", "==")
    open_lower, open_upper = F.col("op") == ">", F.col("op") == "<"
    lower = F.max(F.when(is_lower, F.struct("threshold", open_lower.cast("int").alias("open"))))
    upper = F.min(F.when(is_upper, F.struct("threshold", (-open_upper.cast("int")).alias("open"))))
    return (
        parsed.filter(F.col("threshold").isNotNull())
        .groupBy("rule_id", "feature")
        .agg(lower.alias("_lo"), upper.alias("_hi"))
        .select(
            "rule_id",
            "feature",
            F.col("_lo.threshold").alias("lower"),
            (F.col("_lo.open") == 0).alias("lower_closed"),
            F.col("_hi.threshold").alias("upper"),
            (F.col("_hi.open") == 0).alias("upper_closed"),
        )
    )


def rules_from_table(parsed: DataFrame) -> list[Rule]:
    """Driver-side rules (a tree has at most 2^depth), without rejected ones."""
    found: dict[int, list] = {}
    bad = set()
    for r in parsed.orderBy("rule_id", "pos").collect():
        if r["threshold"] is None:
            bad.add(r["rule_id"])
        found.setdefault(r["rule_id"], []).append((r["feature"], r["op"], r["threshold"]))
    return [Rule(i, tuple(c)) for i, c in found.items() if i not in bad]


def rule_texts(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """``rule_id, rule``: the conditions of each rule as one text, joined by AND, thresholds with all their digits."""
    rows = [(r.rule_id, " AND ".join(f"{f} {op} {float(t)!r}" for f, op, t in r.conditions)) for r in rules]
    return spark.createDataFrame(rows, "rule_id int, rule string")


def matched_rules(rules: Sequence[Rule]) -> Column:
    """Ids of the rules a row matches; rules without conditions are left out."""
    ids = [F.when(r.predicate(), F.lit(r.rule_id)) for r in rules if r.conditions]
    if not ids:
        return F.expr("cast(array() as array<int>)")
    return F.filter(F.array(*ids), lambda i: i.isNotNull())


def rule_hits(features: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per (bar, matched rule)."""
    return features.select("symbol", "ts", "bar_no", F.explode(matched_rules(rules)).alias("rule_id"))


def signal_counts(features: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Number of signal bars per (symbol, rule); pairs without a signal have no row."""
    return rule_hits(features, rules).groupBy("symbol", "rule_id").agg(F.count(F.lit(1)).alias("n_signals"))


def rule_rates(labeled: DataFrame, rules: Sequence[Rule], label: str = "label") -> DataFrame:
    """``rule_id, n_samples, p_label_1`` of each rule on labeled rows."""
    return (
        labeled.select(F.col(label).alias("_label"), F.explode(matched_rules(rules)).alias("rule_id"))
        .groupBy("rule_id")
        .agg(F.count(F.lit(1)).alias("n_samples"), F.avg((F.col("_label") == 1).cast("int")).alias("p_label_1"))
    )
