"""Column names and file schemas. Ids stay bigint so that filters on them reach the scan."""

from pyspark.sql import types as T

ITEM_COLUMNS = ["item_id", "title", "genres"]
RATING_COLUMNS = ["user_id", "item_id", "rating"]

ITEMS = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

RATINGS_CSV = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

RATINGS = T.StructType(RATINGS_CSV.fields[:3])

PAIRS = T.StructType(RATINGS_CSV.fields[:2])

USERS = T.StructType(RATINGS_CSV.fields[:1])

USER_REQUESTS = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
])

FORM_FIELDS = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()),
]))
