from datetime import datetime, timedelta

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.FloatType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
    T.StructField("period", T.IntegerType()),
])

T0 = datetime(2024, 1, 1, 0, 0, 0)


def ev(i, sec, etype, session, product=1, category=10, code=None, brand=None, price=1.0, user=7, period=0):
    return (i, T0 + timedelta(seconds=sec), etype, product, category, code, brand, price, user, session, period)


def frame(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)
