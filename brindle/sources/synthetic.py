"""Seeded synthetic tables of any size, generated where they are used."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _uniform(seed: int, stream: int) -> Column:
    """A number in [0, 1) that depends only on the row id, so a lost task replays it exactly."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(stream)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def sensor_readings(spark: SparkSession, rows: int, n_devices: int, n_trips: int, seed: int = 0) -> DataFrame:
    """``device_id``, ``trip_id`` and ``sensor_reading`` in [0, 1000)."""
    return spark.range(rows).select(
        (_uniform(seed, 0) * n_devices).cast("int").alias("device_id"),
        (_uniform(seed, 1) * n_trips).cast("int").alias("trip_id"),
        (_uniform(seed, 2) * 1000).alias("sensor_reading"),
    )


# Three sensors with their ranges, ten class names: the default classification table.
SENSORS: Mapping[str, tuple[float, float]] = {"sensor1": (0, 100), "sensor2": (0, 50), "sensor3": (0, 25)}
CLASSES = tuple(f"class{i}" for i in range(1, 11))


def feature_table(
    spark: SparkSession,
    rows: int,
    features: Mapping[str, tuple[float, float]] = SENSORS,
    labels: Sequence[str] = CLASSES,
    seed: int = 0,
) -> DataFrame:
    """Uniform float features and a random ``result`` label."""
    columns = [
        (F.lit(low) + _uniform(seed, i) * (high - low)).cast("float").alias(name)
        for i, (name, (low, high)) in enumerate(features.items())
    ]
    pick = (_uniform(seed, len(columns)) * len(labels)).cast("int")
    return spark.range(rows).select(*columns, F.get(F.array(*[F.lit(v) for v in labels]), pick).alias("result"))
