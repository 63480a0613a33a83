"""Analytic queries on the unified table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from stratus.functions.text import truncate


def filter_station(df: DataFrame, station_id: str, source: str | None = None) -> DataFrame:
    """Equality filter (pushed to the Parquet scan)."""
    cond = F.col("station_id") == F.lit(station_id)
    if source is not None:
        cond = cond & (F.col("source") == F.lit(source))
    return df.filter(cond)


def day_slice(df: DataFrame, day: dt.date) -> DataFrame:
    """Rows in [day, day + 1), ordered by time."""
    lo = dt.datetime(day.year, day.month, day.day)
    hi = lo + dt.timedelta(days=1)
    ts = F.col("timestamp")
    bound = lambda t: F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return df.filter((ts >= bound(lo)) & (ts < bound(hi))).orderBy("timestamp")


def strong_wind(df: DataFrame, threshold: float = 50.0) -> DataFrame:
    """Wind speed above ``threshold`` km/h, strongest first."""
    return df.filter(F.col("wind_speed_kmh") > F.lit(threshold)).orderBy(F.col("wind_speed_kmh").desc())


def latest_n(df: DataFrame, station_id: str, n: int = 10, tie_break: list | None = None) -> DataFrame:
    """The ``n`` latest rows of a station (top-k, no full sort);
    ``tie_break`` orders rows with equal timestamps deterministically."""
    order = [F.col("timestamp").desc_nulls_last(), *(tie_break or [])]
    return filter_station(df, station_id).orderBy(*order).limit(n)


def sample_row(df: DataFrame, source: str, order: list[str] | None = None) -> DataFrame:
    """T4: one row matching the source, smallest by ``order`` (deterministic)."""
    order = order or ["station_id", "timestamp"]
    return df.filter(F.col("source") == F.lit(source)).orderBy(*order).limit(1)


def station_temp_stats(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per-station temperature avg/min/max/count, highest average first.

    ``exact``: the mean is summed in DECIMAL(38,10), so it does not depend on
    how rows are split over partitions (a double sum does).
    """
    t = F.col("temperature_c")
    mean = F.avg(t.cast("decimal(38,10)")) if exact else F.avg(t)
    return (df.groupBy("station_id")
            .agg(mean.alias("avg_temp"), F.min("temperature_c").alias("min_temp"),
                 F.max("temperature_c").alias("max_temp"), F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("avg_temp").desc_nulls_last(), "station_id"))


def share_by(df: DataFrame, col: str) -> DataFrame:
    """Share of rows per group in %, 1 dp; the total is a one-value subquery."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("records"))
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return g.withColumn("share_pct", F.round(F.col("records").cast("double") / total * 100, 1))


def frequency_table(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("records")).orderBy(F.desc("records"), col)


def reject_counts(rejected: DataFrame, col: str = "reject_type") -> DataFrame:
    """Rejections by type."""
    return rejected.groupBy(col).agg(F.count(F.lit(1)).alias("errors"))


def reject_sample(rejected: DataFrame, order: list[str], n: int = 15,
                  message: str = "message", chars: int = 250) -> DataFrame:
    """T5: the first ``n`` rejections in input order, message cut to ``chars``."""
    return (rejected.orderBy(*order).limit(n)
            .withColumn(message, truncate(message, chars)))
