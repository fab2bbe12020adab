"""The record table: its columns, its search fields and its fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values. They decide results, so they are kept as they are.

COLUMNS = (
    "record_id",
    "phone_number",
    "province",
    "city",
    "operator",
    "area_code",
    "postal_code",
)

SEARCH_FIELDS = ("province", "city", "operator", "area_code", "postal_code")

# (province, city, operator, area_code, postal_code); the position in the list
# is the place index that generation computes.
PLACES = (
    ("广东", "广州", "中国移动", "020", "510000"),
    ("广东", "深圳", "中国联通", "0755", "518000"),
    ("广东", "佛山", "中国电信", "0757", "528000"),
    ("浙江", "杭州", "中国移动", "0571", "310000"),
    ("四川", "成都", "中国联通", "028", "610000"),
    ("湖北", "武汉", "中国电信", "027", "430000"),
    ("北京", "北京", "中国移动", "010", "100000"),
    ("上海", "上海", "中国联通", "021", "200000"),
)

FIRST_RECORD_ID = 115036
FIRST_PHONE_NUMBER = "1477799"
PHONE_BASE = 4_700_000_000

DEFAULT_PROVINCE = "广东"
DEFAULT_CITY = "广州"

ALL_FIELDS_LABEL = "all-attribution-fields"

MAX_LOCATION_LENGTH = 64
MAX_OFFSET = 10_000_000
MAX_LIMIT = 10_000
DEFAULT_LIMIT = 100

SAMPLE_PARTITIONS = 4
SAMPLE_POINTS = 250_000
SAMPLE_SEED = 20260917

# Every character for which Python's str.isspace() is true, because a search
# text is stripped of all of them and not only of U+0020.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

PAIR_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("records_scanned", T.LongType()),
        T.StructField("input", T.StringType()),
        T.StructField("master", T.StringType()),
        T.StructField("completed_at_utc", T.StringType()),
    ]
)

SAMPLE_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("application", T.StringType()),
        T.StructField("partitions", T.LongType()),
        T.StructField("points_per_partition", T.LongType()),
        T.StructField("total_points", T.LongType()),
        T.StructField("inside_points", T.LongType()),
        T.StructField("pi", T.DoubleType()),
        T.StructField("seed", T.LongType()),
        T.StructField("master", T.StringType()),
        T.StructField("completed_at_utc", T.StringType()),
    ]
)

# End of fixed values.

RECORD_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in COLUMNS])

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("location", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("limit", T.LongType()),
    ]
)
