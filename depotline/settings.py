"""Business constants shared by the operators.

Every value here is a default of an operator argument; callers override them
per call rather than by editing this module.
"""

from __future__ import annotations

# --- Fixed values -----------------------------------------------------------
# Network nodes: warehouse id, region served, capacity (units), fixed USD/day.
NETWORK = [
    ("WH-NORTH", "North", 120000, 1800.0),
    ("WH-SOUTH", "South", 115000, 1700.0),
    ("WH-EAST", "East", 118000, 1750.0),
    ("WH-WEST", "West", 110000, 1680.0),
    ("WH-CENTRAL", "Central", 180000, 2600.0),
]
DEMAND_REGIONS = ["North", "South", "East", "West"]
HUB_WAREHOUSE = "WH-CENTRAL"
HUB_REGION = "Central"
SHORT_WAREHOUSE_IDS = {
    "WH-N": "WH-NORTH",
    "WH-S": "WH-SOUTH",
    "WH-E": "WH-EAST",
    "WH-W": "WH-WEST",
    "WH-C": "WH-CENTRAL",
}
CATEGORIES = ["Electronics", "Toys", "Beauty", "Home", "Kitchen", "Pet"]

# Road-freight carbon model.
KM_PER_LEAD_DAY = 500.0
FREIGHT_KG_PER_M3 = 200.0
KG_CO2_PER_TONNE_KM = 0.062
M3_PER_CUBIC_FOOT = 0.028317

# Cost model.
HOLDING_RATE_PER_YEAR = 0.25
DAYS_PER_YEAR = 365
STOCKOUT_MULTIPLE = 2

# Validation limits.
SERVICE_LEVEL_RANGE = (0.80, 1.00)
OUTLIER_PERCENTILE = 99.9
MIN_POSITIVE = 0.01
SKU_ID_PATTERN = r"^SKU-\d{6}$"
EXPECTED_LANES = 20
DATE_NULL_WARN_SHARE = 0.01
FLAG_WARN_SHARE = 0.05

# Event flags carried by demand and calendar rows.
EVENT_FLAGS = ["holiday_peak_flag", "prime_event_flag", "marketing_push_flag"]

# Weekly features.
LAG_WEEKS = [1, 2, 3, 4, 8, 12, 27]
ROLLING_WEEKS = [4, 8, 12]

# Classification cut-offs, in percent.
ABC_CUTS = (80.0, 95.0)
XYZ_CUTS = (10.0, 25.0)
XYZ_RESIDUAL_CUT = 30.0

# Days-of-cover zones, utilisation bands.
COVER_RISK_DAYS = 14
COVER_HEALTHY_DAYS = 30
UTILISATION_CRITICAL = 100.0
UTILISATION_HIGH = 85.0

# Planning.
SAFETY_BUFFER = 1.20
INTERVAL_Z = 1.282
FORECAST_WEEKS = 12
BASELINE_DAYS = 84
WEEKS_PER_YEAR = 52
SCENARIOS = [
    ("A", "Cost Minimiser", 1.0, 0.0),
    ("B", "Balanced", 0.6, 0.4),
    ("C", "Carbon Champion", 0.2, 0.8),
]
RECOMMENDED_SCENARIO = "B"
STRATEGIES = {
    "AX": "Lean replenishment - high value, predictable",
    "BX": "Standard replenishment",
    "CX": "Consolidate SKUs",
}
RECOMMEND_NONE = "Zero allocation — consolidate demand to active warehouses"
RECOMMEND_LOW = "Under-utilised — candidate for safety stock buffer storage"

# Anomalies and retrieval.
ANOMALY_Z = 2.0
ANOMALY_TOP = 20
RETRIEVAL_TOP_K = 5

# Boosted-tree defaults.
BOOSTING_ROUNDS = 300
BOOSTING_RATE = 0.05
BOOSTING_LEAVES = 31
BOOSTING_LEAF_ROWS = 20
BOOSTING_SEED = 42
# --- End of fixed values ----------------------------------------------------
