"""Time columns as whole numbers, independent of the session zone for zone-less stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000
US_PER_HOUR = 3_600_000_000


def _is_utc(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z")


def _zoneless_us(df: DataFrame, name: str) -> Column:
    """A zone-less stamp as if it were UTC. Under a UTC session the cast does just that; in
    other zones it would move stamps around clock changes, so they are put together by parts."""
    if _is_utc(df):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.expr(
        f"(unix_date(CAST(`{name}` AS DATE)) * 86400L + hour(`{name}`) * 3600L + minute(`{name}`) * 60L)"
        f" * 1000000L + CAST(extract(SECOND FROM `{name}`) * 1000000L AS BIGINT)"
    )


def epoch_us(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970-01-01 of a timestamp, zone-less timestamp or date column."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return _zoneless_us(df, name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("long") * F.lit(24 * US_PER_HOUR)
    raise TypeError(f"{name} is {kind.simpleString()}, not a time column")


def epoch_ms(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970-01-01, the fraction cut off toward zero."""
    return F.call_function("div", epoch_us(df, name), F.lit(1000))


def truncate_to_ms(df: DataFrame, name: str) -> Column:
    """The stamp with everything below a millisecond cut off, type unchanged."""
    return F.col(name) - F.expr("INTERVAL '0.000001' SECOND") * F.pmod(epoch_us(df, name), F.lit(1000))


def parse_event_time(name: str) -> Column:
    """Text to timestamp; text that is not a time gives null also under ANSI mode."""
    return F.try_to_timestamp(F.col(name))
