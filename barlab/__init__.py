"""Bar analytics on Spark DataFrames: panels keyed by ``(symbol, bar_no)``."""
