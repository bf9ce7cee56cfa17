"""CSV, JSON and parquet tables: reading, audit columns, backlog slices, month layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the three inputs.
POLICY_SCHEMA = T.StructType(
    [
        T.StructField("policy_id", T.StringType()),
        T.StructField("policy_updated_at", T.TimestampType()),
        T.StructField("policyholder_age", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("region_type", T.StringType()),
        T.StructField("vehicle_year", T.IntegerType()),
        T.StructField("annual_premium_eur", T.DoubleType()),
        T.StructField("has_telematics", T.IntegerType()),
        T.StructField("coverage_type", T.StringType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("policy_start_date", T.DateType()),
        T.StructField("bonus_malus_years", T.IntegerType()),
    ]
)
CLAIM_SCHEMA = T.StructType(
    [
        T.StructField("claim_id", T.StringType()),
        T.StructField("policy_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("accident_type", T.StringType()),
        T.StructField("claimed_amount_eur", T.DoubleType()),
        T.StructField("n_parties_involved", T.IntegerType()),
        T.StructField("telematics_anomaly", T.IntegerType()),
        T.StructField("police_report_filed", T.IntegerType()),
        T.StructField("outside_business_hours", T.IntegerType()),
    ]
)
LABEL_SCHEMA = T.StructType(
    [
        T.StructField("claim_id", T.StringType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("label_available_date", T.StringType()),
    ]
)
AUDIT_COLUMNS = ("ingestion_timestamp", "source_file")


def with_audit(df: DataFrame) -> DataFrame:
    """Ingest time and source file of each row; ``df`` must be read from files."""
    return df.withColumn("ingestion_timestamp", F.current_timestamp()).withColumn(
        "source_file", F.col("_metadata.file_path")
    )


def read_policies(
    spark: SparkSession, path: str, schema: T.StructType | None = None, audit: bool = True
) -> DataFrame:
    """CSV folder with a header line. Without ``schema`` types are inferred by an extra pass."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    df = reader.csv(path)
    return with_audit(df) if audit else df


def infer_json_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of the JSON files now under ``path``, for a stream over the same folder."""
    return spark.read.option("recursiveFileLookup", True).json(path).schema


def stream_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    audit: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of JSON files, each new file once; sub-folders are read too."""
    reader = spark.readStream.schema(schema or infer_json_schema(spark, path)).option(
        "recursiveFileLookup", True
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.json(path)
    return with_audit(df) if audit else df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a parquet table."""
    return spark.read.parquet(path)


def stream_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stream of the files added to a parquet table."""
    return spark.readStream.schema(schema).parquet(path)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Full recompute of a materialised table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def _folder(level: int) -> Column:
    """Name of a folder above the file, without a ``name=`` prefix."""
    folder = F.element_at(F.split("_metadata.file_path", "/"), level)
    return F.element_at(F.split(folder, "="), -1)


def read_partitioned_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON under ``path/<year>/<month>/``, with ``year`` and ``month`` from the file path."""
    reader = spark.read.option("recursiveFileLookup", True)
    if schema:
        reader = reader.schema(schema)
    return reader.json(path).select(
        "*", _folder(-3).cast("int").alias("year"), _folder(-2).cast("int").alias("month")
    )


# Spark's own JSON formats end at the millisecond.
MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_json_by_month(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Append one set of JSON files per year and month of ``ts``."""
    stamped = df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))
    stamped.write.partitionBy("year", "month").mode("append").options(**MICROSECONDS).json(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything under a path, in any file system that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end there."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


# --- backlog slices ---------------------------------------------------------------------------


def high_water_mark(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One row with the newest event time, null for an empty table."""
    return df.agg(F.max(ts).alias("hwm"))


def next_slice(
    backlog: DataFrame, hwm: DataFrame | dt.datetime | None, hours: int, ts: str = "timestamp"
) -> DataFrame:
    """Backlog rows in (hwm, hwm + hours]; without a mark, from the first row on.

    ``hwm`` may be the one-row table of ``high_water_mark``. The bounds are scalar subqueries,
    so they reach the scan as filters.
    """
    kind = backlog.schema[ts].dataType
    length = F.expr(f"INTERVAL {int(hours)} HOURS")
    if isinstance(hwm, dt.datetime):  # the backlog's beginning is not asked for
        start = F.lit(hwm).cast(kind)
        return backlog.filter((F.col(ts) > start) & (F.col(ts) <= start + length))
    mark = hwm.scalar() if isinstance(hwm, DataFrame) else F.lit(hwm)
    first = backlog.agg(F.min(ts)).scalar()
    start = mark.cast(kind)
    after_mark = start.isNull() | (F.col(ts) > start)
    return backlog.filter(after_mark & (F.col(ts) <= F.coalesce(start, first) + length))


def labels_for_slice(
    labels: DataFrame,
    claims: DataFrame,
    done: DataFrame,
    ts: str = "timestamp",
    label_ts: str = "label_available_timestamp",
) -> DataFrame:
    """Labels that became available between the first and last claim of a slice and are not in
    ``done`` yet."""
    first, last = claims.agg(F.min(ts)).scalar(), claims.agg(F.max(ts)).scalar()
    due = labels.filter((F.col(label_ts) >= first) & (F.col(label_ts) <= last))
    return due.join(done.select("claim_id").distinct(), "claim_id", "left_anti")
