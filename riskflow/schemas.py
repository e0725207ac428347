"""Declared schemas of the risk flow."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Transaction record carried as JSON in the Kafka value (all nullable).
TRANSACTION_SCHEMA = StructType([
    StructField("transaction_id", StringType(), True),
    StructField("user_id", StringType(), True),
    StructField("amount", DecimalType(10, 2), True),
    StructField("timestamp", TimestampType(), True),
])

# Kafka connector row layout (bronze, uncast).
KAFKA_RECORD_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("timestampType", IntegerType(), True),
])

# Sum of DECIMAL(10,2) widens by 10 digits of precision.
AMOUNT_SUM_TYPE = DecimalType(20, 2)
