"""Explicit schemas at the read boundary."""

from pyspark.sql import types as T

REPORT_EVENT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("idLineEvent", T.StringType()),
    T.StructField("home", T.StringType()),
    T.StructField("away", T.StringType()),
    T.StructField("timeRemaining", T.StringType()),
    T.StructField("entry", T.StringType()),
    T.StructField("scoreHome", T.IntegerType()),
    T.StructField("scoreAway", T.IntegerType()),
    T.StructField("playerName", T.StringType()),
])

MATCH = T.StructType([
    T.StructField("id_match", T.LongType()),
    T.StructField("game_id", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("date", T.StringType()),
    T.StructField("home", T.StringType()),
    T.StructField("away", T.StringType()),
    T.StructField("report", T.ArrayType(REPORT_EVENT)),
])
