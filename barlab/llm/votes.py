"""Weak supervision: voters that raise an alarm, deny it or abstain, and the posterior that all is calm.

The hidden class of a row is calm, or one kind of trouble per voter: the one that this voter is
made to find. (With a single class of trouble, the estimation describes whichever kind makes most
voters fire together, and explains the others as errors.) Every voter has a rate of alarms per class, among the votes
it casts; an abstention says nothing.

Shares of the classes and rates are estimated by expectation-maximisation over the table of vote patterns, which has
at most 3^voters rows however many rows voted. Expectation and maximisation are one aggregate over
that table; only the sums, a row of numbers, come to the driver. Estimates are drawn to the
starting values with a fixed share of all rows, and a voter's alarms stay at least ``edge`` times as frequent
in its own trouble as in the calm, so that the classes keep their meaning.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALM, ALARM, ABSTAIN = 0, 1, 2
ROUNDS = 30
#: Estimates that move less than this in a round have settled.
SETTLED = 1e-4
#: Weight of the starting values, as a share of the number of rows.
STRENGTH = 0.01
LEAST = 1e-6


@dataclass(frozen=True)
class Voters:
    """``share`` of each class (calm first, then the voters' troubles); per voter, the rate of alarms in each."""

    share: tuple[float, ...]
    rates: dict[str, tuple[float, ...]]
    edge: float = 40.0

    def weights(self) -> str:
        """For each kind of trouble its log-odds, then those of each voter's calm, alarm and abstention, as SQL.

        They are one array, so that Spark's generated code is the same in every round and is compiled once.
        """
        numbers = []
        for k in range(1, len(self.share)):
            numbers.append(math.log(self.share[k] / self.share[0]))
            for rate in self.rates.values():
                numbers += [math.log((1 - rate[k]) / (1 - rate[0])), math.log(rate[k] / rate[0]), 0.0]
        return f"array({', '.join(f'{x!r}D' for x in numbers)})"

    def odds(self, weights: str) -> list[str]:
        """The odds of every kind of trouble against calm, as SQL over the voters' columns and ``weights``."""
        width = 1 + 3 * len(self.rates)
        return [
            f"exp(get({weights}, {k * width})"
            + "".join(f" + get({weights}, {voter} + {k * width + 1 + 3 * j})" for j, voter in enumerate(self.rates)) + ")"
            for k in range(len(self.share) - 1)
        ]

    def calm(self) -> Column:
        """The posterior of calm, from the voters' columns."""
        return F.expr(f"1D / (1D + {' + '.join(self.odds(self.weights()))})")


def beginners(voters: list[str], calm: float, own: float, other: float, false: float, edge: float) -> Voters:
    """Voters before the estimation: rates of alarms in the own trouble, in another one, and in the calm."""
    share = (calm, *[(1 - calm) / len(voters)] * len(voters))
    rates = {v: (false, *(own if v == w else other for w in voters)) for v in voters}
    return Voters(share, rates, edge)


def patterns(rows: DataFrame, voters: list[str]) -> DataFrame:
    """``voters`` and ``n``: how many rows voted alike."""
    return rows.groupBy(*voters).agg(F.count(F.lit(1)).alias("n"))


def fit(counted: DataFrame, start: Voters, rounds: int = ROUNDS, strength: float = STRENGTH) -> Voters:
    """Estimate voters from a staged table of patterns; without rows the start is returned."""
    model, classes = start, range(len(start.share))
    alone = counted.coalesce(1)
    for _ in range(rounds):
        weighed = alone.withColumn("__w", F.expr(model.weights())).withColumns(
            {f"odds_{k}": F.expr(o) for k, o in enumerate(["1D", *model.odds("__w")])}
        )
        every = " + ".join(f"odds_{k}" for k in classes)
        votes = ", ".join(f"struct({j} AS voter, {v} AS vote)" for j, v in enumerate(start.rates))
        shared = weighed.withColumn("every", F.expr(every)).select(
            "n", *[F.expr(f"n * odds_{k} / every AS in_{k}") for k in classes], F.expr(f"explode(array({votes})) AS p")
        )
        sums = [F.expr("sum(n) AS n"), *[F.expr(f"sum(in_{k}) AS in_{k}") for k in classes]]
        found = shared.groupBy("p.voter", "p.vote").agg(*sums).collect()  # three rows per voter at most
        if not found:
            return start
        got = {(r["voter"], r["vote"], k): r[f"in_{k}"] for r in found for k in classes}
        rows = sum(r["n"] for r in found if r["voter"] == 0)
        whole = [sum(got.get((0, v, k), 0.0) for v in (CALM, ALARM, ABSTAIN)) for k in classes]
        held = strength * rows
        rates = {}
        for own, (voter, first) in enumerate(start.rates.items(), 1):
            alarm = [got.get((own - 1, ALARM, k), 0.0) for k in classes]
            cast = [a + got.get((own - 1, CALM, k), 0.0) + held * start.share[k] for k, a in zip(classes, alarm)]
            rate = [(alarm[k] + held * start.share[k] * first[k]) / cast[k] for k in classes]
            if rate[own] < start.edge * rate[0]:
                rate[0] = (rate[0] * cast[0] + rate[own] * cast[own]) / (cast[0] + start.edge * cast[own])
                rate[own] = start.edge * rate[0]
            rates[voter] = tuple(min(max(r, LEAST), 1 - LEAST) for r in rate)
        share = [(whole[k] + held * start.share[k]) / (rows + held) for k in classes]
        before, model = model, Voters(tuple(share), rates, start.edge)
        moved = [abs(a - b) for v in rates for a, b in zip(rates[v], before.rates[v])]
        if max(moved + [abs(a - b) for a, b in zip(model.share, before.share)]) < SETTLED:
            break
    return model
