"""Row-wise expressions: barriers, sizes, candles, rule text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted shape of a rule condition, "feature op number".
CONDITION_PATTERN = r"^(\w+)\s*(<=|>=|<|>|==)\s*([\d.+-]+)$"


def ratio(num: Column, den: Column) -> Column:
    """``num / den``, null where the denominator is 0 or missing."""
    return F.try_divide(num, den)


def null_if_nan(column: str) -> Column:
    """Spark orders NaN above every number, so NaN must become null on the way in."""
    return F.nullif(F.col(column).cast("double"), F.lit(float("nan")))


def valid_atr(atr: Column) -> Column:
    return F.coalesce(atr > 0, F.lit(False))


def stop_price(entry: Column, atr: Column, c_sl: Column) -> Column:
    return F.when(valid_atr(atr), entry - atr * c_sl)


def target_price(entry: Column, atr: Column, c_sl: Column, c_tp: Column | None = None) -> Column:
    return F.when(valid_atr(atr), entry + atr * (c_sl * 1.5 if c_tp is None else c_tp))


def position_size(atr: Column, c_sl: Column, risk: float) -> Column:
    """Whole shares whose stop loss costs at most ``risk``; 0 when undefined."""
    distance = c_sl * atr
    shares = F.when(valid_atr(atr) & (distance > 0), ratio(F.lit(float(risk)), distance))
    return F.coalesce(F.floor(shares), F.lit(0)).cast("long")


def buying_power(entry: Column, atr: Column, c_sl: Column, risk: float) -> Column:
    return entry * position_size(atr, c_sl, risk)


def candle_columns() -> dict[str, Column]:
    body_top, body_bottom = F.greatest("open", "close"), F.least("open", "close")
    return {
        "Candle_Body": F.abs(F.col("close") - F.col("open")),
        "Candle_Range": F.col("high") - F.col("low"),
        "Upper_Wick": F.col("high") - body_top,
        "Lower_Wick": body_bottom - F.col("low"),
    }


def binary_target(label: Column) -> Column:
    return (label == 1).cast("int")


def above_threshold(score: Column, threshold: float = 0.5) -> Column:
    """Binary prediction from a score."""
    return (score >= threshold).cast("int")


def condition_text(feature: Column, op: Column, threshold: Column) -> Column:
    return F.format_string("%s %s %.3f", feature, op, threshold)
