"""Avro datum decode and encode inside Spark jobs, by the spark-avro package."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope import model

PACKAGE = "org.apache.spark:spark-avro_2.13"


def decode_avro(df: DataFrame, value: str, out: str, record: str) -> DataFrame:
    """Add the decoded record as struct column ``out``; a datum that cannot be read becomes null."""
    from pyspark.sql.avro.functions import from_avro

    text = json.dumps(model.avro_schema_for(record))
    try:
        return df.withColumn(out, from_avro(F.col(value), text, {"mode": "PERMISSIVE"}))
    except (AnalysisException, TypeError) as e:
        raise RuntimeError(f"Avro topics need the package {PACKAGE} on the classpath") from e


def avro_encoder(record: str):
    """Encoder of a record struct for a topic sink; needs the package too."""
    from pyspark.sql.avro.functions import to_avro

    text = json.dumps(model.avro_schema_for(record))
    return lambda row: to_avro(row, text)
