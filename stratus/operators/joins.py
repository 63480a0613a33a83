"""Station-dimension joins (J1, J2). No broadcast hints: AQE chooses from measured bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

def latest_per_key(dim: DataFrame, key: str, order: str) -> DataFrame:
    """Dimension dedup: for a repeated key the row with the largest ``order`` wins."""
    cols = [c for c in dim.columns if c not in (key, order)]
    return (dim.groupBy(key)
            .agg(F.max_by(F.struct(*cols), F.col(order)).alias("_d"))
            .select(key, "_d.*"))


def enrich_stations(obs: DataFrame, dim: DataFrame, key: str = "station_id",
                    order: str = "pos") -> DataFrame:
    """Left join observations x station dimension; unknown -> nulls; last wins."""
    d = latest_per_key(dim, key, order)
    return obs.join(d, key, "left")


def enrich_stations_default(obs: DataFrame, dim: DataFrame, key: str = "station_id",
                            order: str = "pos", default_type: str = "weather_underground") -> DataFrame:
    """Like J1, but an unknown station gets ``Unknown_<id>`` and a default type."""
    d = latest_per_key(dim, key, order).withColumn("_known", F.lit(True))
    out = obs.join(d, key, "left")
    known = F.col("_known").isNotNull()
    return (out.withColumn("station_name", F.when(known, F.col("station_name"))
                           .otherwise(F.concat(F.lit("Unknown_"), F.col(key))))
            .withColumn("station_type", F.when(known, F.col("station_type"))
                        .otherwise(F.lit(default_type)))
            .drop("_known"))
