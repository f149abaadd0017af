"""Rules in JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.operators.model import rules_as_text
from barlab.schema import RULES_JSON


def read_rules(spark: SparkSession, path: str, one_list: bool = True) -> DataFrame:
    """Rules with text conditions, from one JSON list or from one object per line."""
    return spark.read.schema(RULES_JSON).option("multiLine", one_list).json(path)


def rule_json(rules: DataFrame) -> DataFrame:
    """One JSON document per rule, conditions as text."""
    return rules_as_text(rules).select("rule_id", F.to_json(F.struct("*")).alias("json"))


def export_rules(rules: DataFrame, path: str) -> None:
    """Write the rules with text conditions, one JSON object per line."""
    rules_as_text(rules).write.mode("overwrite").json(path)
