"""Forest, feature selection and small tree with MLlib; tree leaves as rules.

Regressors on the 0/1 label are used throughout: their variance split equals the
gini split, and unlike the classifier they keep sibling leaves of the same
majority class, whose different rates are the rules.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.functions.scalars import condition_text
from barlab.operators.features import feature_columns
from barlab.operators.rules import Rule
from barlab.operators.splits import head_by_row_order
from barlab.session import shared_folder


@dataclass(frozen=True)
class Learner:
    """Sizes of forest and tree, and which leaves become rules."""

    trees: int = 200
    forest_levels: int = 10
    forest_leaf: int = 50
    inputs: int = 5
    levels: int = 4
    leaf: int = 30
    rate: float = 0.35
    bins: int = 256
    seed: int = 42
    #: Train on the first share of all rows only, in order of symbol and time.
    head: float | None = None


CONDITION = "struct<feature:string,op:string,threshold:double>"
RULES = f"rule_id int, conditions array<{CONDITION}>, n_samples bigint, p_label_1 double"


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="inputs").transform(df)


def balanced(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` = rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_of_class"))
    # One row per class, two at most.
    total = counts.agg(F.sum("_of_class").alias("n"), F.count(F.lit(1)).alias("k")).first()
    share = F.lit(float(total["n"])) / (F.lit(int(total["k"])) * F.col("_of_class"))
    return df.join(F.broadcast(counts), label).withColumn("weight", share).drop("_of_class")


def train_forest(train: DataFrame, columns: Sequence[str], label: str, p: Learner) -> RandomForestRegressionModel:
    forest = RandomForestRegressor(
        featuresCol="inputs", labelCol=label, weightCol="weight", numTrees=p.trees, maxDepth=p.forest_levels,
        minInstancesPerNode=p.forest_leaf, featureSubsetStrategy="sqrt", maxBins=p.bins, seed=p.seed,
    )
    return forest.fit(balanced(assemble(train, columns), label))


def importance_table(spark: SparkSession, model: RandomForestRegressionModel, columns: Sequence[str]) -> DataFrame:
    """``pos, feature, importance``, one row per model input."""
    rows = [(i, c, float(model.featureImportances[i])) for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, "pos int, feature string, importance double")


def forest_nodes(spark: SparkSession, model: RandomForestRegressionModel) -> DataFrame:
    """``tree, id, n, gain, pos`` of every inner node of a forest, from the saved model."""
    path = f"{shared_folder(spark)}/barlab/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    return nodes.filter("leftChild >= 0").select("tree", "id", F.element_at("impurityStats", 1).alias("n"), "gain", F.col("split.featureIndex").alias("pos"))


def importance_of_nodes(nodes: DataFrame) -> DataFrame:
    """``pos, importance`` from :func:`forest_nodes`: gains weighted by rows, as shares of each tree, averaged over trees."""
    per_tree = nodes.groupBy("tree", "pos").agg(F.sum(F.col("gain") * F.col("n")).alias("gained"))
    total = per_tree.groupBy("tree").agg(F.sum("gained").alias("all"))
    shares = per_tree.join(total, "tree").groupBy("pos").agg(F.sum(F.try_divide("gained", "all")).alias("share"))
    return shares.withColumn("one", F.lit(1)).join(shares.agg(F.sum("share").alias("sum")).withColumn("one", F.lit(1)), "one").select(
        "pos", F.try_divide("share", "sum").alias("importance")
    )


def top_features(importances: DataFrame, n: int) -> DataFrame:
    """The ``n`` most important inputs; of equals, the later one goes first."""
    return importances.orderBy(F.desc("importance"), F.desc("pos")).limit(n)


def train_tree(train: DataFrame, columns: Sequence[str], label: str, p: Learner) -> DecisionTreeRegressionModel:
    tree = DecisionTreeRegressor(
        featuresCol="inputs", labelCol=label, maxDepth=p.levels, minInstancesPerNode=p.leaf,
        maxBins=p.bins, seed=p.seed,
    )
    return tree.fit(assemble(train, columns))


def node_table(spark: SparkSession, model: DecisionTreeRegressionModel) -> DataFrame:
    """The nodes of a tree as rows, from the saved model."""
    path = f"{shared_folder(spark)}/barlab/tree-{uuid.uuid4().hex}"
    model.write().save(path)
    return spark.read.parquet(f"{path}/data").select(
        "id", "prediction", F.col("rawCount").alias("n"), "leftChild", "rightChild",
        F.col("split.featureIndex").alias("pos"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    )


def leaf_rules(
    spark: SparkSession, nodes: DataFrame, columns: Sequence[str], min_leaf: int, min_rate: float
) -> DataFrame:
    """Rules of the leaves that are large and positive enough, left to right.

    ``nodes`` has at most ``2^(depth+1) - 1`` rows and is walked on the driver.
    """
    table = {r["id"]: r for r in nodes.collect()}
    rules: list[tuple] = []
    open_ = [(0, [])]
    while open_:
        node_id, path = open_.pop()
        node = table[node_id]
        if node["leftChild"] < 0:
            if node["n"] >= min_leaf and node["prediction"] >= min_rate:
                rules.append((len(rules), path, int(node["n"]), float(node["prediction"])))
            continue
        feature, threshold = columns[node["pos"]], float(node["threshold"])
        # The left child is popped first.
        open_.append((node["rightChild"], [*path, (feature, ">", threshold)]))
        open_.append((node["leftChild"], [*path, (feature, "<=", threshold)]))
    return spark.createDataFrame(rules, RULES)


def rules_as_text(rules: DataFrame) -> DataFrame:
    """Conditions as text with three decimals, for display and export."""
    text = F.transform("conditions", lambda c: condition_text(c["feature"], c["op"], c["threshold"]))
    return rules.withColumn("conditions", text)


def rules_as_list(rules: DataFrame) -> list[Rule]:
    """Driver-side rules with full thresholds; a tree has at most 2^depth."""
    return [
        Rule(r["rule_id"], tuple((c["feature"], c["op"], c["threshold"]) for c in r["conditions"]))
        for r in rules.orderBy("rule_id").collect()
    ]


@dataclass
class FittedRules:
    importances: DataFrame
    selected: list[str]
    forest: RandomForestRegressionModel
    tree: DecisionTreeRegressionModel
    rules: DataFrame


def fit_rules(
    train: DataFrame, label: str = "tp_target", columns: Sequence[str] | None = None, p: Learner = Learner()
) -> FittedRules:
    """Forest -> top features -> tree -> rules.

    ``train`` should be a staged table: the trainers read it many times.
    """
    spark = train.sparkSession
    columns = list(columns) if columns else [c for c in feature_columns(train) if c != label]
    rows = train.na.drop(subset=[*columns, label]).withColumn(label, (F.col(label) == 1).cast("double"))
    if p.head is not None:
        rows = head_by_row_order(rows, p.head)
    forest = train_forest(rows, columns, label, p)
    importances = importance_table(spark, forest, columns)
    selected = [r["feature"] for r in top_features(importances, p.inputs).collect()]
    tree = train_tree(rows, selected, label, p)
    rules = leaf_rules(spark, node_table(spark, tree), selected, p.leaf, p.rate)
    return FittedRules(importances, selected, forest, tree, rules)


def score(model: DecisionTreeRegressionModel, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows plus ``score`` = rate of positives in their leaf."""
    return model.transform(assemble(rows.na.drop(subset=list(columns)), columns)).withColumnRenamed(
        "prediction", "score"
    ).drop("inputs")
