"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lathe.operators.sets import union_all_by_name


# both sides agree on quotes doubled inside quotes, blanks kept, empty text
# written as "" (the writer's default) and NULL as \\N
_CSV = {"header": True, "quote": '"', "escape": '"', "nullValue": "\\N",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str,
                   multi_line: bool = True) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass over the data).
    ``multi_line`` lets quoted fields hold line breaks and reads each file in
    one task; without it files are split among tasks."""
    return spark.read.schema(schema).options(**_CSV, emptyValue="", multiLine=multi_line).csv(path)


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_snapshots(spark: SparkSession, paths: list[str], renames: list[dict] | None = None,
                   drop: list[str] | None = None, fmt: str = "parquet",
                   schema=None, tag: str = "snapshot") -> DataFrame:
    """Read N snapshot files, rename each to the shared short names, tag it
    with its 1-based ``snapshot`` number, union by name with type widening
    and drop the snapshot-specific columns."""
    frames = []
    for i, p in enumerate(paths):
        d = (spark.read.parquet(p) if fmt == "parquet" else read_csv_table(spark, p, schema))
        if renames:
            m = renames[i]
            d = d.withColumnsRenamed({k: v for k, v in m.items() if k in d.columns})
        frames.append(d.withColumn(tag, F.lit(i + 1)))
    out = union_all_by_name(frames)
    return out.drop(*[c for c in (drop or []) if c in out.columns])


def write_parquet_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                        mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**_CSV).csv(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Metric tables are a handful of rows: one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def save_fitted(df: DataFrame, path: str) -> None:
    """Fitted state (scaler statistics, encoder dictionaries) as a long
    parquet table ``(feature, kind, key, value)``."""
    df.write.mode("overwrite").parquet(path)


def load_fitted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def fitted_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "feature string, kind string, key string, value double")
