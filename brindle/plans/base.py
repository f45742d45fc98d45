"""A registered query: a Spark plan over the test tables and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass
class Catalog:
    plans: dict[str, Plan] = field(default_factory=dict)
    oracles: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
        def register(plan: Plan) -> Plan:
            if name in self.plans:
                raise ValueError(f"query {name!r} is registered twice")
            self.plans[name] = plan
            if sql is not None:
                self.oracles[name] = sql
            return plan

        return register


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A test table. ``spread`` is for work that is heavy per row: a table of fewer splits than
    cores is redistributed first. Tables of many files are left as they are."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if spread and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
