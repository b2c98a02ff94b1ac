"""Fixed schemas: silver access log, audit (execution log) and quality rows."""

from __future__ import annotations

from pyspark.sql import types as T

SILVER_LOG_SCHEMA = T.StructType(
    [
        T.StructField("client_ip", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("method", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("endpoint_clean", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("response_size", T.LongType()),
        T.StructField("processed_timestamp", T.TimestampType()),
        T.StructField("processed_date", T.DateType()),
    ]
)

EXECUTION_LOG_SCHEMA = T.StructType(
    [
        T.StructField("execution_time", T.TimestampType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("processed_file_path", T.StringType()),
        T.StructField("time_elapsed", T.DoubleType()),
    ]
)

QUALITY_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("percentage_ok", T.DoubleType()),
        T.StructField("verified_table", T.StringType()),
    ]
)


def ddl(schema: T.StructType) -> str:
    """``col TYPE, …`` for CREATE TABLE."""
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields)
