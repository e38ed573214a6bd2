"""The warehouse the registered queries read, stored once per session and data folder."""

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from stratalake.operators.layers import build_star, load
from stratalake.plans.entities import ENTITIES
from stratalake.sources.landing import envelope
from stratalake.sources.shared import fresh_folder, shuffle_by_size, state_of, tune
from stratalake.sources.store import Warehouse
from stratalake.workload import universe
from stratalake.workload.universe import Tables

#: By session, data folder and state of its files: changed tables get layers of their own.
_warehouses: dict[tuple, Warehouse] = {}


class Layers:
    """Stored layers over the given tables; each is built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        tune(spark)
        shuffle_by_size(spark, folder)
        self.spark = spark
        self.tables = Tables(spark, folder)
        key = (spark.sparkContext.applicationId, folder, state_of(spark, folder))
        if key not in _warehouses:
            _warehouses[key] = Warehouse(spark, fresh_folder(spark, "warehouse"))
        self.warehouse = _warehouses[key]
        self.warehouse.spark = spark

    def fresh_warehouse(self) -> Warehouse:
        """A new, empty one, for queries that write."""
        return Warehouse(self.spark, fresh_folder(self.spark, "warehouse"))

    @property
    def raw(self) -> DataFrame:
        if not self.warehouse.is_written("raw.records"):
            # everything the tables hold, referenced or not; discovery has queries of its own
            narrow = partial(self.warehouse.place, "raw.records")
            records = envelope(universe.payloads(self.tables, narrow), "bucket")
            self.warehouse.append("raw.records", records)
        return self.warehouse.table("raw.records")

    @property
    def placed_raw(self) -> DataFrame:
        """As :attr:`raw`, with the buckets the rows are stored in, for queries that store them again."""
        _ = self.raw
        return self.warehouse.placed("raw.records")

    def staging(self, entity: str) -> DataFrame:
        table = ENTITIES[entity].table
        if not self.warehouse.is_written(table):
            _ = self.raw
            load(self.warehouse)
        return self.warehouse.table(table)

    def star(self, table: str) -> DataFrame:
        name = f"analytics.{table}"
        if not self.warehouse.is_written(name):
            _ = self.staging("root")
            build_star(self.warehouse)
        return self.warehouse.table(name)
