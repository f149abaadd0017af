"""Fixed values shared by several modules. Settings stand beside the operators that read them."""

# Symbols used when neither a file nor a list names a universe.
DEFAULT_SYMBOLS = [
    "ABSI", "CRMD", "FLGT", "IMUX", "KPTI", "MCRB", "NBTX", "PRQR", "RDUS", "SGMO",
]

# The feature columns of the feature frame, in order.
FEATURE_COLUMNS = [
    "RSI_14", "ATR_50", "EMA_20", "EMA_50", "dist_ema20_pct", "dist_ema50_pct",
    "VWAP_20", "dist_vwap_pct", "MACD_line", "MACD_signal", "MACD_hist", "RVOL_20",
    "ER_Kaufman_10", "Gap_pct", "ADX_14", "ROC_10", "Momentum_10", "Volatility_20",
    "SMA_10", "dist_bb_upper_pct", "dist_bb_lower_pct", "Candle_Body", "Candle_Range",
    "Upper_Wick", "Lower_Wick",
]

# The prices at which bars may be entered, and the money risked per trade.
ENTRY_PRICES = (1.0, 20.0)
TRADE_RISK = 100.0
# Prices on a grid meet limits exactly; a fixed number of digits for ATR and ER keeps the
# outcome independent of the order of additions.
TIE_DIGITS = 8
