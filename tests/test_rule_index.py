"""Many rules by the index against each rule's own predicate."""

import random

import pytest
from pyspark.sql import functions as F

from barlab.operators import rule_index
from barlab.operators.rules import Rule, parse_conditions, rule_hits

COLUMNS = ["a", "b", "close"]
OPS = ["<", "<=", ">", ">=", "=="]


@pytest.fixture(scope="module")
def bars(spark):
    rng = random.Random(3)

    def number():
        return None if rng.random() < 0.1 else rng.randint(-4, 4) / 2

    rows = [(s, i, number(), number(), number()) for s in ("A", "B") for i in range(150)]
    df = spark.createDataFrame(rows, "symbol string, bar_no bigint, a double, b double, close double")
    return df.withColumns({"ts": F.lit("2024-01-01").cast("timestamp_ntz"), "n_bars": F.lit(150).cast("bigint")})


def made(n, seed):
    rng = random.Random(seed)
    return [
        (i * 7 - 5, [(rng.choice(COLUMNS), rng.choice(OPS), rng.randint(-4, 4) / 2) for _ in range(rng.randint(1, 4))]) for i in range(n)
    ]


def table(spark, rules, extra=()):
    rows = [(i, [f"{f} {op} {t}" for f, op, t in c]) for i, c in rules]
    return parse_conditions(spark.createDataFrame([*rows, *extra], "rule_id int, conditions array<string>"))


def hits(df):
    return sorted((r.symbol, r.bar_no, r.rule_id) for r in df.collect())


@pytest.mark.parametrize("chunk, n, sent", [(64, 150, 1 << 30), (64, 150, 0), (1024, 40, 1 << 30)])
def test_hits_equal_predicates(spark, bars, monkeypatch, chunk, n, sent):
    monkeypatch.setattr(rule_index, "CHUNK", chunk)
    monkeypatch.setattr(rule_index, "WORDS", chunk // 64)
    rules = made(n, chunk + n)
    want = hits(rule_hits(bars, [Rule(i, tuple(c)) for i, c in rules]))
    assert hits(rule_index.rule_hits_many(bars, table(spark, rules), sent_bytes=sent)) == want and want


def test_rules_that_cannot_be_applied_are_left_out(spark, bars):
    good = [(1, [("a", ">", 0.0), ("b", "<=", 1.0)])]
    extra = [(2, ["a > 0", "unreadable"]), (3, ["c > 0"]), (4, ["a > 1", "a < 0"]), (5, ["a > 1", "a <= 1"]), (6, ["a > 1.2.3"])]
    got = hits(rule_index.rule_hits_many(bars, table(spark, good, extra)))
    assert got == hits(rule_hits(bars, [Rule(1, tuple(good[0][1]))]))


def test_no_rules_no_hits(spark, bars):
    assert rule_index.rule_hits_many(bars, table(spark, [])).count() == 0
    assert rule_index.rule_hits_many(bars, table(spark, [], [(1, ["bad"])])).count() == 0


def test_the_plan_does_not_grow_with_the_rules(spark, bars):
    def size(n):
        plan = rule_index.rule_hits_many(bars, table(spark, made(n, 1)))._jdf.queryExecution().optimizedPlan().toString()
        return len(plan.splitlines())

    assert size(20) == size(400)


def test_counts(spark, bars):
    rules = made(30, 9)
    want = {}
    for s, _, r in hits(rule_hits(bars, [Rule(i, tuple(c)) for i, c in rules])):
        want[s, r] = want.get((s, r), 0) + 1
    got = rule_index.signal_counts_many(bars, table(spark, rules)).collect()
    assert {(r.symbol, r.rule_id): r.n_signals for r in got} == want
