"""Registry of the logical datasets: columns, types and storage locations."""

from __future__ import annotations

from dataclasses import dataclass
from posixpath import join

from pyspark.sql import DataFrame, SparkSession, types as T

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}

_CALENDAR_PARTS = "year:int month:int quarter:int week_number:int day_of_week:int year_week:string"
_EVENTS = "holiday_peak_flag:int prime_event_flag:int is_weekend:int marketing_push_flag:int weather_disruption_index:double"


def struct(spec: str) -> T.StructType:
    """``name:type name:type`` to a StructType."""
    fields = [item.split(":") for item in spec.split()]
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


@dataclass(frozen=True)
class Dataset:
    """One logical table. ``contract`` is the minimum set of cleaned columns."""

    name: str
    contract: T.StructType
    raw_columns: tuple[str, ...]
    raw_file: str = ""

    @property
    def raw_schema(self) -> T.StructType:
        """Raw files load as text; typing is a cleaning step of its own."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.raw_columns])


def _dataset(name: str, contract: str, raw: str, raw_file: str = "") -> Dataset:
    return Dataset(name, struct(contract), tuple(raw.split()), raw_file or f"{name}.csv")


DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in [
        _dataset(
            "daily_demand",
            f"date:date sku_id:string region:string units_ordered:double price_usd:double {_EVENTS} {_CALENDAR_PARTS}",
            "date day weekend_flag sku_id region units_ordered price_usd holiday_peak_flag "
            "prime_event_flag marketing_push_flag weather_disruption_index",
        ),
        _dataset(
            "event_calendar",
            f"date:date {_EVENTS} {_CALENDAR_PARTS}",
            "date weekend_flag holiday_peak_flag prime_event_flag marketing_push_flag weather_disruption_index",
        ),
        _dataset(
            "sku_master",
            "sku_id:string category:string unit_cost_usd:double selling_price_usd:double cube_ft:double "
            "target_service_level:double gross_margin_usd:double margin_pct:double stockout_penalty_usd:double "
            "holding_cost_daily_usd:double volume_m3:double",
            "sku_id category unit_cost_usd selling_price_usd cube_ft target_service_level",
        ),
        _dataset(
            "warehouses",
            "warehouse_id:string region:string capacity_units:int fixed_daily_cost_usd:double",
            "warehouse_id region capacity_units fixed_daily_cost_usd",
        ),
        _dataset(
            "warehouse_region_costs",
            "warehouse_id:string demand_region:string ship_cost_per_unit:double lead_time_days:int "
            "distance_km_proxy:double carbon_kg_per_unit:double lane_efficiency_score:double",
            "warehouse_id demand_region ship_cost_per_unit lead_time_days",
        ),
        _dataset(
            "starting_inventory",
            "warehouse_id:string sku_id:string starting_inventory_units:double canonical_warehouse_id:string "
            "inventory_value_usd:double daily_holding_cost_usd:double",
            "warehouse_id sku_id starting_inventory_units",
            "starting_inventory_snapshot.csv",
        ),
    ]
}

# Suffix of each storage layer; ``raw`` keeps the delivered file name.
LAYERS = {"raw": "", "interim": "_interim", "processed": "_clean", "logs": ""}


def dataset(name: str) -> Dataset:
    try:
        return DATASETS[name]
    except KeyError:
        raise KeyError(f"unknown dataset {name!r}; known: {sorted(DATASETS)}") from None


def path_of(root: str, name: str, layer: str) -> str:
    """Storage location of a dataset in one layer below ``root``."""
    if layer not in LAYERS:
        raise KeyError(f"unknown layer {layer!r}; known: {sorted(LAYERS)}")
    entry = dataset(name)
    if layer == "raw":
        return join(root, layer, entry.raw_file)
    if layer == "logs":
        return join(root, layer, f"log_clean_{name}")
    return join(root, layer, name + LAYERS[layer])


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Expose tables to ``spark.sql`` under their catalog names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)


def from_rows(spark: SparkSession, rows: list[tuple], spec: str) -> DataFrame:
    """Literal dimension with an explicit schema."""
    return spark.createDataFrame(rows, struct(spec))


def network_dimension(spark: SparkSession, network: list[tuple]) -> DataFrame:
    """The fixed warehouse network as a four-column table."""
    return from_rows(
        spark, network, "warehouse_id:string region:string capacity_units:int fixed_daily_cost_usd:double"
    )
