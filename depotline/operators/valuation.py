"""Financial columns per SKU and per stock row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from depotline import settings as S
from depotline.functions.numeric import floor_below, ratio


def add_financials(
    df: DataFrame,
    cost: str = "unit_cost_usd",
    price: str = "selling_price_usd",
    holding_rate: float = S.HOLDING_RATE_PER_YEAR,
    days_per_year: int = S.DAYS_PER_YEAR,
    stockout_multiple: float = S.STOCKOUT_MULTIPLE,
) -> DataFrame:
    """Margin, margin share (not below -1), stock-out penalty, daily holding cost."""
    margin = F.col(price) - F.col(cost)
    return df.withColumns(
        {
            "gross_margin_usd": margin,
            "margin_pct": floor_below(ratio(margin, F.col(price)), -1.0),
            "stockout_penalty_usd": F.col(price) * stockout_multiple,
            "holding_cost_daily_usd": F.col(cost) * holding_rate / days_per_year,
        }
    )


def add_inventory_value(
    df: DataFrame,
    units: str = "starting_inventory_units",
    cost: str = "unit_cost_usd",
    holding_rate: float = S.HOLDING_RATE_PER_YEAR,
    days_per_year: int = S.DAYS_PER_YEAR,
) -> DataFrame:
    value = F.col(units) * F.col(cost)
    return df.withColumns(
        {"inventory_value_usd": value, "daily_holding_cost_usd": value * (holding_rate / days_per_year)}
    )


def add_carbon_features(
    df: DataFrame,
    lead_time: str = "lead_time_days",
    cube_ft: str = "cube_ft",
    km_per_day: float = S.KM_PER_LEAD_DAY,
    density: float = S.FREIGHT_KG_PER_M3,
    factor: float = S.KG_CO2_PER_TONNE_KM,
    m3_per_cubic_foot: float = S.M3_PER_CUBIC_FOOT,
) -> DataFrame:
    """Volume, distance and kg CO2 per unit; an absent input column gives nulls."""

    def scaled(column: str, scale: float):
        return F.col(column) * scale if column in df.columns else F.lit(None).cast("double")

    volume, distance = scaled(cube_ft, m3_per_cubic_foot), scaled(lead_time, km_per_day)
    return df.withColumns(
        {
            "volume_m3": volume,
            "distance_km_proxy": distance,
            "carbon_kg_per_unit": distance * (volume * density / 1000) * factor,
        }
    )
