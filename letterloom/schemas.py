"""Schemas of the tables the library reads and writes."""

from pyspark.sql import types as T

KAFKA_ROW = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("from_address", T.StringType()),
        T.StructField("to_addresses", T.StringType()),
        T.StructField("cc_addresses", T.StringType()),
        T.StructField("bcc_addresses", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

PART = T.StructType(
    [
        T.StructField("part_no", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("disposition", T.StringType()),
        T.StructField("charset", T.StringType()),
        T.StructField("multipart", T.BooleanType()),
        T.StructField("reachable", T.BooleanType()),
        T.StructField("in_related", T.BooleanType()),
        T.StructField("payload", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

PARSED = T.StructType(
    [
        T.StructField("defect", T.StringType()),
        T.StructField("parts", T.ArrayType(PART)),
    ]
)

MESSAGE_COLUMNS = tuple(MESSAGE.names)
