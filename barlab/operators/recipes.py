"""Indicators as columns in stages.

A window expression cannot contain another one, so an indicator is computed in
numbered stages; a column may use the columns of earlier stages. The stage numbers
are common to all indicators, so that windows of different indicators meet in the
same stage and share one Window operator, and all stages share one shuffle and one
sort.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from barlab.operators.panel import BLOCK, block_columns, blocked, own_rows

Stages = dict[int, dict[str, Column]]

# The stages in use. An EMA of a dense column (see scan.py) takes eight stages from its first one on.
LAGS = 0      # windows over panel columns
ROWS = 1      # row expressions over these
ROLLS = 6     # windows over derived columns, beside the last window of a first scan
VALUES = 7    # row expressions over these, results of a first scan
LATER = 8     # row expressions over values
SECOND = 9    # start of a scan over values
FINAL = 17    # row expressions over a second scan


@dataclass(frozen=True)
class Scan:
    """An EMA over a column that may miss any number of values, run after the columns of ``stage``."""

    column: str
    span: float
    out: str
    stage: int


@dataclass(frozen=True)
class Recipe:
    """Columns by stage, the visible ``outputs``, and the bars looked at."""

    stages: Stages
    outputs: list[str]
    lookback: int
    lookahead: int = 0
    after: list["Recipe"] = field(default_factory=list)
    scans: list[Scan] = field(default_factory=list)

    def all_stages(self) -> Stages:
        return merge_stages([*(r.all_stages() for r in self.after), self.stages])

    def all_scans(self) -> list[Scan]:
        return [*(s for r in self.after for s in r.all_scans()), *self.scans]

    def reach(self) -> int:
        """Bars looked back, inputs included."""
        return self.lookback + max((r.reach() for r in self.after), default=0)

    def reach_ahead(self) -> int:
        return self.lookahead + max((r.reach_ahead() for r in self.after), default=0)


def merge_stages(many: Iterable[Stages]) -> Stages:
    """All columns by stage; a shared name is computed once."""
    merged: Stages = {}
    seen: set[str] = set()
    for stages in many:
        for number, columns in stages.items():
            for name, column in columns.items():
                if name not in seen:
                    seen.add(name)
                    merged.setdefault(number, {})[name] = column
    return merged


def add_columns(df: DataFrame, recipes: Iterable[Recipe], block: int = BLOCK) -> DataFrame:
    """Compute the recipes on an already blocked frame; intermediates stay."""
    from barlab.operators.scan import run_scans

    recipes = list(recipes)
    stages = merge_stages(r.all_stages() for r in recipes)
    scans = {s.out: s for r in recipes for s in r.all_scans()}
    for number in sorted({*stages, *(s.stage for s in scans.values())}):
        df = df.withColumns(stages.get(number, {}))
        if now := [s for s in scans.values() if s.stage == number]:
            df = run_scans(df, now, block)
    return df


def with_indicators(panel: DataFrame, *recipes: Recipe, block: int = BLOCK) -> DataFrame:
    """The panel plus the outputs of ``recipes``, on ``(symbol, blk)`` blocks."""
    back = max(r.reach() for r in recipes)
    forward = max(r.reach_ahead() for r in recipes)
    outputs = list(dict.fromkeys(name for r in recipes for name in r.outputs))
    kept = [c for c in panel.columns if c not in outputs and c not in block_columns(panel)]
    cut = blocked(panel, back, forward, block)
    done = own_rows(add_columns(cut, recipes, block), block)
    return done.select(*kept, *outputs)
