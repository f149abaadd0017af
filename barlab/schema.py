"""Fixed schemas of the tables read and written."""

from pyspark.sql import types as T

BAR_COLUMNS = ["symbol", "ts", "open", "high", "low", "close", "volume"]

BARS = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("ts", T.TimestampNTZType())]
    + [T.StructField(c, T.DoubleType()) for c in BAR_COLUMNS[2:]]
)

# A bar file per symbol: header "Date,Time,Open,High,Low,Close,Volume".
CSV_BARS = T.StructType([T.StructField(c, T.StringType()) for c in ["Date", "Time"]]
    + [T.StructField(c, T.DoubleType()) for c in ["Open", "High", "Low", "Close", "Volume"]])

UNIVERSE = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("csl", T.DoubleType()),
        T.StructField("bp_median", T.DoubleType()),
        T.StructField("bp_max", T.DoubleType()),
        T.StructField("n_samples", T.LongType()),
    ]
)

RULES_JSON = T.StructType(
    [
        T.StructField("rule_id", T.IntegerType()),
        T.StructField("conditions", T.ArrayType(T.StringType())),
        T.StructField("n_samples", T.LongType()),
        T.StructField("p_label_1", T.DoubleType()),
        T.StructField("win_rate_train", T.DoubleType()),
    ]
)
