"""Fixed values.

Everything in this module is a FIXED VALUE that has to equal the source
pipeline's for identical results: keyword lists, event-type classes, tier
names and cut points, thresholds, fill defaults.  They are kept together, in
their natural order, as plain data.  Nothing else in the package hard-codes
them.
"""

# --- FIXED VALUES: news title keyword classes (case-insensitive substring) ---
NEWS_LEVEL3_KEYWORDS = ["crisis", "critical", "severe", "collapse", "shutdown", "blockage", "strike"]
NEWS_LEVEL2_KEYWORDS = ["disruption", "delay", "shortage", "congestion", "surge", "risk", "warning"]

# --- FIXED VALUES: news level cut points on the mean title score ---
NEWS_HIGH_AT = 2.5
NEWS_MEDIUM_AT = 1.5

# --- FIXED VALUES: storm event type -> severity score (unlisted and NULL -> 1) ---
SEVERITY_CLASSES = [
    (5, ["Hurricane", "Hurricane (Typhoon)", "Typhoon"]),
    (4, ["Tornado", "Tsunami", "Volcanic Ashfall"]),
    (3, ["Flash Flood", "Flood", "Storm Surge/Tide", "Tropical Storm", "Blizzard"]),
    (2, ["High Wind", "Thunderstorm Wind", "Heavy Snow", "Ice Storm", "Winter Storm", "Heavy Rain"]),
]
SEVERITY_DEFAULT = 1
# severity score -> label (anything else -> MINIMAL)
SEVERITY_LABELS = [(5, "CRITICAL"), (4, "HIGH"), (3, "MEDIUM"), (2, "LOW")]
SEVERITY_LABEL_DEFAULT = "MINIMAL"
# "high or critical" storms
SEVERE_STORM_AT = 4

# --- FIXED VALUES: logistics tier from score, right-closed bins (0,2.5] ... (4,5] ---
LPI_TIER_BINS = [
    (2.5, "Very High Risk"),
    (3.0, "High Risk"),
    (3.5, "Medium Risk"),
    (4.0, "Low Risk"),
    (5.0, "Very Low Risk"),
]
LPI_TIER_LOW = 0.0
HIGH_RISK_TIERS = ["Very High Risk", "High Risk"]
# tier -> numeric code for the model (anything else -> 1.0)
LPI_TIER_CODES = [("Very High Risk", 5.0), ("High Risk", 4.0), ("Medium Risk", 3.0), ("Low Risk", 2.0)]
LPI_TIER_CODE_DEFAULT = 1.0
# news level -> numeric code for the model (anything else -> 1.0)
NEWS_LEVEL_CODES = [("HIGH", 3.0), ("MEDIUM", 2.0)]
NEWS_LEVEL_CODE_DEFAULT = 1.0

# --- FIXED VALUES: commodity shock threshold (strictly greater) and series ---
COMMODITY_SHOCK_ABOVE = 85.0
OIL_METRIC = "oil_price_usd"
COMMODITY_SERIES = [
    ("DCOILWTICO", "oil_price_usd"),
    ("PCU331110331110", "steel_index"),
    ("PCU325412325412", "aluminium_index"),
    ("DHHNGSP", "natural_gas_price"),
    ("PCU484121484121", "truck_transport_ppi"),
]
MISSING_OBSERVATION = "."

# --- FIXED VALUES: supplier id pattern ---
SUPPLIER_ID_PATTERN = r"SUP-0*(\d+)"

# --- FIXED VALUES: dashboard market band (delay % strictly above -> HIGH) ---
MARKET_BAND_ABOVE = 57.0
LPI_SCALE_MAX = 5.0

# --- FIXED VALUES: mart thresholds (HAVING order count >=) ---
ROUTE_MIN_ORDERS = 50
SUPPLIER_MIN_ORDERS = 10
SUPPLIER_PREVIEW_MIN_ORDERS = 50
TOP_K = 10
LATEST_PRICES_K = 20

# --- FIXED VALUES: edition of the country logistics scores ---
SCORE_YEAR = 2023
SCORE_SOURCE = "World Bank LPI 2023"

# --- FIXED VALUES: null defaults ---
# after the storm join
WEATHER_DEFAULTS = {"weather_risk_score": 1.0, "storm_event_count": 0, "high_critical_storm_count": 0}
# on the silver projection
SILVER_DEFAULTS = {
    "lpi_score": 3.0,
    "logistics_risk_tier": "Medium Risk",
    "infrastructure_score": 3.0,
    "timeliness_score": 3.0,
    "supplier_risk_flag": 0,
    "route_delay_rate": 0.5,
    "route_avg_delay_days": 0.0,
}
# before model training
MODEL_DEFAULTS = {
    "delay_days": 0.0,
    "route_delay_rate": 0.5,
    "route_avg_delay_days": 0.0,
    "weather_risk_score": 1.0,
    "lpi_score": 3.0,
    "supplier_quality_score": 3.0,
    "supplier_esg_score": 3.0,
    "lead_time_days": 14.0,
    "lpi_risk_numeric": 3.0,
}

# --- FIXED VALUES: model ---
FEATURE_COLS = [
    "delay_days",
    "route_delay_rate",
    "route_avg_delay_days",
    "weather_risk_score",
    "lpi_score",
    "lpi_risk_numeric",
    "supplier_risk_flag",
    "commodity_shock_flag",
    "news_risk_numeric",
    "supplier_quality_score",
    "supplier_esg_score",
    "lead_time_days",
    "profit_margin_flag",
    "shipping_mode_idx",
    "market_idx",
]
GBT_PARAMS = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "seed": 42}
TRAIN_PERCENT = 80
MODEL_VERSION = "gbt_v1.0"
