"""Versioned snapshots on plain parquet: ``snapshot_id=N`` folders and a manifest table.

A version exists once its manifest row is written, which happens last; a failed write leaves a
folder no reader looks at, and the next attempt overwrites it. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = T.StructType(
    [
        T.StructField("snapshot_id", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("num_rows", T.LongType()),
        T.StructField("num_columns", T.IntegerType()),
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
    ]
)


def _data(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/snapshot_id={version}"


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def snapshot_history(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows, newest first; no rows if nothing was ever written."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(_manifest(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], _MANIFEST)
    return rows.orderBy(F.desc("snapshot_id"))


def latest_version(spark: SparkSession, path: str) -> int | None:
    row = snapshot_history(spark, path).first()
    return row["snapshot_id"] if row else None


def snapshot_meta(spark: SparkSession, path: str, version: int) -> dict[str, str]:
    """Metadata of one version."""
    row = snapshot_history(spark, path).filter(F.col("snapshot_id") == version).first()
    if row is None:
        raise ValueError(f"no version {version} under {path}")
    return dict(row["meta"] or {})


def write_snapshot(
    df: DataFrame, path: str, meta: Mapping[str, object] | None = None, event_ts: str | None = None
) -> int:
    """Write the next version, whatever its schema; earlier versions stay readable.

    With ``event_ts`` the metadata gain ``max_event_date`` of this version and
    ``previous_max_date`` of the version before it, which the rolling split reads.
    """
    spark = df.sparkSession
    before = snapshot_history(spark, path).first()
    version = before["snapshot_id"] + 1 if before else 0
    df.write.mode("overwrite").parquet(_data(path, version))

    written = spark.read.parquet(_data(path, version))
    counts = [F.count(F.lit(1)).alias("n")]
    if event_ts:
        counts.append(F.max(event_ts).cast("date").cast("string").alias("max_event_date"))
    stats = written.agg(*counts).first()
    values = {k: str(v) for k, v in (meta or {}).items()}
    if event_ts and stats["max_event_date"]:
        values["max_event_date"] = stats["max_event_date"]
    previous = (before["meta"] or {}).get("max_event_date") if before else None
    if previous:
        values.setdefault("previous_max_date", previous)

    row = spark.createDataFrame(
        [(version, None, stats["n"], len(written.columns), values)], _MANIFEST
    ).withColumn("created_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(_manifest(path))
    return version


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Exactly one version; the latest by default."""
    if version is None:
        version = latest_version(spark, path)
        if version is None:
            raise ValueError(f"no snapshot under {path}")
    elif snapshot_history(spark, path).filter(F.col("snapshot_id") == version).isEmpty():
        raise ValueError(f"no version {version} under {path}")
    return spark.read.parquet(_data(path, version))


def ensure_like(path: str, template: DataFrame) -> bool:
    """Write an empty first version with the columns of ``template`` if there is none yet."""
    if latest_version(template.sparkSession, path) is not None:
        return False
    write_snapshot(template.limit(0), path)
    return True
