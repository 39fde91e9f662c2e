"""Column contracts and constants shared by every operator.

A *tick frame* is any DataFrame with these columns:

``symbol`` STRING, ``security_type`` STRING, ``price`` DOUBLE,
``event_ts`` TIMESTAMP (an instant; the session time zone is UTC),
``arrival`` (anything orderable, unique: a BIGINT such as a topic offset, or
a STRUCT whose last field is the position inside one file split) and
``partition`` INT (the input partition whose clock decides what is late).
"""

from pyspark.sql import types as T

# The wall clock of the exchange feed, the bar length and the EMA periods.
MARKET_ZONE = "Europe/Amsterdam"
BAR_SIZE = "5 minutes"
EMA_PERIODS = (38, 100)
HISTORY_DAYS = 14
HISTORY_LIMIT = 5000
SEARCH_LIMIT = 200

EVENT_JSON_DDL = "symbol STRING, securityType STRING, price DOUBLE, timestamp STRING"
REGISTRY_JSON_DDL = "symbol STRING, securityType STRING, firstSeen DOUBLE"
POINT_JSON_DDL = (
    "symbol STRING, signal STRING, ema38 DOUBLE, ema100 DOUBLE, close DOUBLE, "
    "windowStart DOUBLE, windowEnd DOUBLE"
)

# The named columns the feed's CSV files may carry (headers are matched trimmed, in any case).
CSV_FIELDS = ("id", "sectype", "last", "date", "time", "trading date", "trading time")

# The positional layout: 39 text columns; the ones the profile reads are named in profile.py.
POSITIONAL = T.StructType([T.StructField(f"c{i:02d}", T.StringType()) for i in range(39)])

POINT = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("ema38", T.DoubleType()),
        T.StructField("ema100", T.DoubleType()),
        T.StructField("signal", T.StringType()),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("security_type", T.StringType()),
        T.StructField("first_seen", T.TimestampType()),
    ]
)
