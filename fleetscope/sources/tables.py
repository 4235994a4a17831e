"""Batch sources: lake tables, JDBC tables and queries, views, table listing and profile."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lake:
    """Parquet tables below one folder."""

    root: str


@dataclass(frozen=True)
class Database:
    """A JDBC database; credentials come from options or the environment, never from code."""

    url: str
    properties: dict = field(default_factory=dict, repr=False)

    @staticmethod
    def from_env(prefix: str) -> "Database":
        env = os.environ
        return Database(
            env[f"{prefix}_JDBC_URL"],
            {
                "user": env[f"{prefix}_USER"],
                "password": env[f"{prefix}_PASSWORD"],
                "driver": env.get(f"{prefix}_DRIVER", "org.postgresql.Driver"),
            },
        )


@dataclass(frozen=True)
class Partitioning:
    """How a JDBC table is read in parallel: a numeric or time column, its range, and the parts."""

    column: str
    lower: object
    upper: object
    parts: int


def read_table(spark: SparkSession, source: Lake | Database, name: str, partitioning: Partitioning | None = None) -> DataFrame:
    """A whole table. Filters and columns are pushed down; JDBC reads run in parallel when partitioned."""
    if isinstance(source, Lake):
        return spark.read.parquet(os.path.join(source.root, name))
    if partitioning is None:
        return spark.read.jdbc(source.url, name, properties=source.properties)
    return spark.read.jdbc(
        source.url,
        name,
        column=partitioning.column,
        lowerBound=partitioning.lower,
        upperBound=partitioning.upper,
        numPartitions=partitioning.parts,
        properties=source.properties,
    )


def run_query(spark: SparkSession, source: Lake | Database, query: str) -> DataFrame:
    """A SQL query run by the database, or by Spark over the registered views for a lake."""
    if isinstance(source, Lake):
        return spark.sql(query)
    reader = spark.read.format("jdbc").option("url", source.url).option("query", query)
    return reader.options(**source.properties).load()


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession) -> DataFrame:
    """The names of the registered tables and views."""
    return spark.sql("SHOW TABLES").select(F.col("tableName").alias("table_name")).distinct()


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""

    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])
