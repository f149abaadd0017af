"""Features -> labels -> rules, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.functions.scalars import binary_target
from barlab.operators.model import FittedRules, Learner, fit_rules
from barlab.operators.panel import BLOCK
from barlab.operators.splits import split_by_time
from barlab.operators.touch import label_bars
from barlab.params import FEATURE_COLUMNS
from barlab.session import stage


def labeled_table(
    features: DataFrame, csl: DataFrame | float, ratio: float = 1.5, max_bars: int = 40, train_share: float = 0.7,
    block: int = BLOCK,
) -> DataFrame:
    """Labels 0/1/2 on the feature frame, split into train and test, staged."""
    labeled = label_bars(features, csl, ratio, max_bars=max_bars, binary=False, block=block)
    staged = stage(labeled.withColumn("tp_target", binary_target(F.col("label"))), "labeled")
    return stage(split_by_time(staged, train_share, block=block), "split")


def discover_rules(split: DataFrame, p: Learner = Learner()) -> FittedRules:
    """Rules learnt from the train part."""
    return fit_rules(split.filter(F.col("part") == "train"), "tp_target", FEATURE_COLUMNS, p)
