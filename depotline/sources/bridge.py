"""Benchmark tables viewed as the supply-chain tables the operators expect.

Each function is a lazy view over the parquet tables of one scale-factor folder.
Joins carry no broadcast hints: the sides grow with the data, so Spark decides
from their measured size, and AQE splits skewed keys when it has to shuffle.
"""

from __future__ import annotations

from posixpath import join

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline import settings as S
from depotline.functions.calendar import date_parts
from depotline.functions.numeric import ratio
from depotline.functions.text import title_case
from depotline.operators.cleaning import collapse_dates, map_values
from depotline.operators.lanes import add_carbon, add_lane_efficiency
from depotline.operators.valuation import add_financials, add_inventory_value

HUB = "WH-CENTRAL"
# Region names of the benchmark schema, as cleaned demand carries them.
REGIONS = ["Africa", "America", "Asia", "Europe", "Middle East"]
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SHORT_IDS = {f"WH-{r[:2].upper()}": f"WH-{r.upper().replace(' ', '-')}" for r in [*REGIONS, "Central"]}
SERVICE_LEVELS = {"PROMO": 0.98, "ECONOMY": 0.95, "MEDIUM": 0.95, "LARGE": 0.92, "SMALL": 0.92, "STANDARD": 0.90}


# Schemas of the benchmark tables in use; naming them spares a job per read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(join(sf_dir, f"{name}.parquet"))


def _sku(key: str):
    """``SKU-`` and at least six digits; longer keys keep all of theirs."""
    digits = F.col(key).cast("string")
    return F.concat(F.lit("SKU-"), F.lpad(digits, F.greatest(F.lit(6), F.length(digits)), F.lit("0")))


def _warehouse(region: str):
    return F.concat(F.lit("WH-"), F.replace(F.upper(region), F.lit(" "), F.lit("-")))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select("r_regionkey", title_case(F.col("r_name")).alias("region"))


def _order_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        regions(spark, sf_dir), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "region")
    customers = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "region")
    return table(spark, sf_dir, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", "region")


def demand_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One demand row per order line: date, SKU, customer region, units, unit price."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", F.to_date("l_shipdate").alias("date")
    )
    # Lines and orders both grow with the data: shuffle and merge, never broadcast.
    regions_of_orders = _order_region(spark, sf_dir).hint("merge")
    return lines.join(regions_of_orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "date",
        _sku("l_partkey").alias("sku_id"),
        "region",
        F.col("l_quantity").alias("units_ordered"),
        ratio(F.col("l_extendedprice"), F.col("l_quantity")).alias("price_usd"),
    )


def raw_event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One calendar row per order, so dates repeat and must be collapsed."""
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"),
        ((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")).cast("int").alias("holiday_peak_flag"),
        (F.col("o_totalprice") > 490000).cast("int").alias("prime_event_flag"),
        (F.col("o_orderpriority") == "2-HIGH").cast("int").alias("marketing_push_flag"),
        (F.col("o_totalprice") / 250000 - 1).alias("weather_disruption_index"),
    )


def event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = collapse_dates(raw_event_calendar(spark, sf_dir))
    return days.withColumns(date_parts(F.col("date")))


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by date. Grouped by date, so 366 rows a year at most, however many orders: sent to the lines instead of dealing the lines by date."""
    return F.broadcast(collapse_dates(raw_event_calendar(spark, sf_dir)))


def daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean daily demand with event flags; a date without events has flags 0."""
    joined = demand_lines(spark, sf_dir).drop("l_orderkey").join(_days(spark, sf_dir), "date", "left")
    flags = {flag: F.coalesce(F.col(flag), F.lit(0)) for flag in S.EVENT_FLAGS}
    return joined.withColumns({**flags, **date_parts(F.col("date"))})


def raw_daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as delivered text, with repeatable damage keyed on the order."""
    rows = demand_lines(spark, sf_dir).join(_days(spark, sf_dir), "date", "left")

    def hit(modulus: int, remainder: int):
        return F.pmod("l_orderkey", F.lit(modulus)) == remainder

    region = F.col("region")
    units = F.col("units_ordered")
    holiday = F.coalesce(F.col("holiday_peak_flag"), F.lit(0)).cast("string")
    return rows.select(
        F.when(hit(101, 7), "not-a-date").otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
        F.date_format("date", "EEEE").alias("day"),
        F.lit("01/01/1970").alias("weekend_flag"),
        F.when(hit(103, 9), F.replace("sku_id", F.lit("SKU-"), F.lit("sku"))).otherwise(F.col("sku_id")).alias("sku_id"),
        F.when(hit(7, 1), F.lower(region))
        .when(hit(7, 2), F.concat(F.lit("  "), region, F.lit(" ")))
        .when(hit(7, 3), F.upper(region))
        .when(hit(107, 11), F.lit("Atlantis"))
        .otherwise(region).alias("region"),
        F.when(hit(97, 5), "n/a").when(hit(89, 3), "0").when(hit(83, 4), (-units).cast("string"))
        .otherwise(units.cast("string")).alias("units_ordered"),
        F.col("price_usd").cast("string").alias("price_usd"),
        F.when(hit(61, 2), "2").when(hit(67, 2), F.lit(None)).otherwise(holiday).alias("holiday_peak_flag"),
        F.coalesce("prime_event_flag", F.lit(0)).cast("string").alias("prime_event_flag"),
        F.coalesce("marketing_push_flag", F.lit(0)).cast("string").alias("marketing_push_flag"),
        F.col("weather_disruption_index").cast("string").alias("weather_disruption_index"),
    )


def raw_sku_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.create_map(*[F.lit(v) for pair in SERVICE_LEVELS.items() for v in pair])
    return table(spark, sf_dir, "part").select(
        _sku("p_partkey").alias("sku_id"),
        F.col("p_type").alias("category"),
        (F.col("p_retailprice") * 0.6).alias("unit_cost_usd"),
        F.col("p_retailprice").alias("selling_price_usd"),
        (F.col("p_size") / 10.0).alias("cube_ft"),
        F.try_element_at(level, F.col("p_type")).alias("target_service_level"),
    )


def sku_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    skus = add_financials(raw_sku_master(spark, sf_dir))
    return skus.withColumn("volume_m3", F.col("cube_ft") * S.M3_PER_CUBIC_FOOT)


def warehouses(spark: SparkSession, sf_dir: str, with_hub: bool = True) -> DataFrame:
    sites = regions(spark, sf_dir).select(
        _warehouse("region").alias("warehouse_id"),
        "region",
        (F.lit(110000) + F.col("r_regionkey") * 10000).cast("int").alias("capacity_units"),
        (F.lit(1700.0) + F.col("r_regionkey") * 100).alias("fixed_daily_cost_usd"),
    )
    if not with_hub:
        return sites
    hub = spark.range(1).select(
        F.lit(HUB).alias("warehouse_id"),
        F.lit(S.HUB_REGION).alias("region"),
        F.lit(180000).alias("capacity_units"),
        F.lit(2600.0).alias("fixed_daily_cost_usd"),
    )
    return sites.unionByName(hub)


def lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every regional warehouse to every demand region; the home lane is cheapest."""
    # The regions are a dimension of a few rows, carried as one array.
    targets = regions(spark, sf_dir).agg(F.collect_list(F.struct(F.col("r_regionkey").alias("key"), F.col("region").alias("name")))).scalar()
    pairs = regions(spark, sf_dir).withColumn("target", F.explode(targets))
    gap = F.abs(F.col("r_regionkey") - F.col("target.key"))
    base = pairs.select(
        _warehouse("region").alias("warehouse_id"),
        F.col("target.name").alias("demand_region"),
        (F.lit(1.5) + gap * 1.25).alias("ship_cost_per_unit"),
        (gap + 1).cast("int").alias("lead_time_days"),
        ((gap + 1) * S.KM_PER_LEAD_DAY).alias("distance_km_proxy"),
    )
    return add_lane_efficiency(base, ["ship_cost_per_unit", "lead_time_days"], invert=True)


def costed_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lanes with carbon per unit for the average SKU volume."""
    return add_carbon(lanes(spark, sf_dir), sku_master(spark, sf_dir))


def raw_starting_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock per site and SKU under short warehouse ids; every tenth supplier fills the hub."""
    nations = table(spark, sf_dir, "nation").join(
        regions(spark, sf_dir), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "region")
    site = F.when(F.pmod("s_suppkey", F.lit(10)) == 0, F.lit("WH-CE")).otherwise(
        F.concat(F.lit("WH-"), F.upper(F.substring("region", 1, 2)))
    )
    suppliers = table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", site.alias("warehouse_id"))
    # Supplier and part pairs hardly repeat, so collapsing them before the join
    # would only add a shuffle; AQE splits a supplier that owns very many lines.
    return (
        table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("warehouse_id", "l_partkey")
        .agg((F.sum("l_quantity") * 10).alias("starting_inventory_units"))
        .select("warehouse_id", _sku("l_partkey").alias("sku_id"), "starting_inventory_units")
    )


def held_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock with network ids, not priced."""
    return map_values(raw_starting_inventory(spark, sf_dir), "warehouse_id", SHORT_IDS, "canonical_warehouse_id")


def starting_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    skus = sku_master(spark, sf_dir).select("sku_id", "unit_cost_usd")
    return add_inventory_value(held_inventory(spark, sf_dir).join(skus, "sku_id", "left")).drop("unit_cost_usd")
