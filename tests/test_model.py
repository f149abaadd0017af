"""Learnt rules: checked by their properties against the rows they come from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlab.operators import model as M
from barlab.operators.model import Learner
from barlab.plans.discover import discover_rules, labeled_table
from barlab.operators.features import feature_frame
from tests.conftest import to_spark, walk

P = Learner(trees=8, forest_levels=4, leaf=30, rate=0.2, inputs=3)


@pytest.fixture(scope="module")
def split(spark):
    import pandas as pd

    frame = pd.concat([walk("A", 1500, 1), walk("B", 900, 2)])
    return labeled_table(feature_frame(to_spark(spark, frame)), 2.0)


@pytest.fixture(scope="module")
def fitted(split):
    return discover_rules(split, P)


def test_rules_describe_their_rows(split, fitted):
    train = split.filter("part = 'train'")
    rules = {r["rule_id"]: r for r in fitted.rules.collect()}
    assert sorted(rules) == list(range(len(rules))) and rules
    for rule in M.rules_as_list(fitted.rules):
        assert 1 <= len(rule.conditions) <= P.levels
        hit = train.filter(rule.predicate()).agg(F.count("*").alias("n"), F.avg("tp_target").alias("p")).first()
        assert hit["n"] == rules[rule.rule_id]["n_samples"] >= P.leaf
        assert hit["p"] == pytest.approx(rules[rule.rule_id]["p_label_1"]) and hit["p"] >= P.rate
    overlaps = sum(F.when(r.predicate(), 1).otherwise(0) for r in M.rules_as_list(fitted.rules))
    assert train.agg(F.max(overlaps)).first()[0] == 1


def test_importances_rank_the_inputs(fitted):
    rows = fitted.importances.collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    best = sorted(rows, key=lambda r: (r["importance"], r["pos"]))[::-1][:3]
    assert fitted.selected == [r["feature"] for r in best]


def test_equal_importances_prefer_the_later(spark):
    rows = [(0, "a", 0.5), (1, "b", 0.5), (2, "c", 0.0)]
    table = spark.createDataFrame(rows, "pos int, feature string, importance double")
    assert [r["feature"] for r in M.top_features(table, 2).collect()] == ["b", "a"]


def test_scores_are_leaf_rates(split, fitted):
    scored = M.score(fitted.tree, split.filter("part = 'train'"), fitted.selected)
    means = scored.groupBy("score").agg(F.avg("tp_target").alias("p")).collect()
    assert np.allclose([r["score"] for r in means], [r["p"] for r in means])


def test_balanced_weights(split):
    rows = M.balanced(split.withColumn("y", F.col("tp_target").cast("double")), "y")
    sums = [r[1] for r in rows.groupBy("y").agg(F.sum("weight")).collect()]
    assert len(sums) == 2 and sums[0] == pytest.approx(sums[1]) == pytest.approx(split.count() / 2)


def test_inner_split_takes_rows_in_symbol_order(split):
    from barlab.operators.splits import head_by_row_order

    head = head_by_row_order(split, 0.7)
    n = {r["symbol"]: r["count"] for r in head.groupBy("symbol").count().collect()}
    full = {r["symbol"]: r["count"] for r in split.groupBy("symbol").count().collect()}
    assert sum(n.values()) == int(sum(full.values()) * 0.7) and n["A"] == full["A"]
