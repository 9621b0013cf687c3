"""Input record types."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


COMMON = _strings("ar", "ba", "ch", "is_new", "md", "mid", "os", "sid", "uid", "vc")

PAGE = T.StructType(
    [
        T.StructField("during_time", T.LongType()),
        T.StructField("item", T.StringType()),
        T.StructField("item_type", T.StringType()),
        T.StructField("last_page_id", T.StringType()),
        T.StructField("page_id", T.StringType()),
    ]
)

START = T.StructType(
    [
        T.StructField("entry", T.StringType()),
        T.StructField("loading_time", T.LongType()),
        T.StructField("open_ad_id", T.LongType()),
        T.StructField("open_ad_ms", T.LongType()),
        T.StructField("open_ad_skip_ms", T.LongType()),
    ]
)

DISPLAY = T.StructType(
    [
        T.StructField("item", T.StringType()),
        T.StructField("item_type", T.StringType()),
        T.StructField("pos_id", T.LongType()),
        T.StructField("pos_seq", T.LongType()),
    ]
)

ACTION = T.StructType(
    [
        T.StructField("action_id", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("item_type", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)

ERR = T.StructType(
    [T.StructField("error_code", T.LongType()), T.StructField("msg", T.StringType())]
)

# seq is the position of the record in its topic; it breaks ties between equal timestamps.
PAGE_LOG = T.StructType(
    [
        T.StructField("common", COMMON),
        T.StructField("page", PAGE),
        T.StructField("start", START),
        T.StructField("displays", T.ArrayType(DISPLAY)),
        T.StructField("actions", T.ArrayType(ACTION)),
        T.StructField("err", ERR),
        T.StructField("ts", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)

_STRING_MAP = T.MapType(T.StringType(), T.StringType())

CHANGE = T.StructType(
    [
        T.StructField("op", T.StringType()),
        T.StructField("before", _STRING_MAP),
        T.StructField("after", _STRING_MAP),
        T.StructField("source", _STRING_MAP),
        T.StructField("ts_ms", T.LongType()),
    ]
)

SEARCH_LOG = T.StructType(
    [
        T.StructField("query_id", T.IntegerType()),
        T.StructField("query", T.StringType()),
        T.StructField("doc_id", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("type", T.StringType()),
    ]
)
