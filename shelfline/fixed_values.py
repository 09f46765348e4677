"""Fixed values of the data model.

Everything here is data that results depend on: raw column names of the vendor feeds,
lookup tables, thresholds and word patterns.  Operators take them as parameters and use
these as defaults; none of them is repeated elsewhere in the package.
"""

from __future__ import annotations

# --- Fixed values: raw column name -> canonical name, one map per feed layout -------------

FEED_A_COLUMNS = {
    "record_id": "record_id",
    "snapshot_time": "snapshot_time",
    "product_name": "product_name",
    "product_category": "category",
    "pack_size": "pack_size",
    "pack_unit": "pack_unit",
    "city_zone": "location",
    "cost": "mrp",
    "deal_discount_pct": "discount_pct",
    "final_cost": "effective_price",
    "cost_per_unit": "price_per_unit",
    "stock_status": "in_stock",
    "stock_remaining": "stock_remaining",
    "units_ordered": "units_ordered",
    "gross_revenue": "revenue_inr",
    "mins_to_deliver": "delivery_minutes",
    "customer_rating": "rating",
    "hour_of_day": "hour_of_day",
    "is_weekend": "is_weekend",
    "is_rush_hour": "is_peak_hour",
    "month_num": "month",
    "weather_condition": "weather",
    "raining": "is_raining",
    "seasonal_factor": "seasonal_factor",
    "bulk_saving_pct": "bulk_discount_pct",
    "festival_demand": "festival_demand_mult",
}

FEED_B_COLUMNS = {
    "txn_id": "record_id",
    "recorded_at": "snapshot_time",
    "item_name": "product_name",
    "item_type": "category",
    "quantity_ml_g": "pack_size",
    "quantity_unit": "pack_unit",
    "delivery_zone": "location",
    "mrp": "mrp",
    "discount_percent": "discount_pct",
    "selling_price": "effective_price",
    "price_per_unit": "price_per_unit",
    "available": "in_stock",
    "stock_remaining": "stock_remaining",
    "qty_ordered": "units_ordered",
    "revenue_inr": "revenue_inr",
    "eta_mins": "delivery_minutes",
    "app_rating": "rating",
    "order_hour": "hour_of_day",
    "weekend_flag": "is_weekend",
    "peak_slot": "is_peak_hour",
    "month": "month",
    "weather": "weather",
    "is_raining": "is_raining",
    "price_seasonal_mult": "seasonal_factor",
    "bulk_discount_applied": "bulk_discount_pct",
    "festival_demand": "festival_demand_mult",
}

FEED_C_COLUMNS = {
    "order_ref": "record_id",
    "timestamp": "snapshot_time",
    "product": "product_name",
    "category": "category",
    "pack_qty": "pack_size",
    "unit": "pack_unit",
    "location": "location",
    "mrp": "mrp",
    "discount_pct": "discount_pct",
    "offer_price": "effective_price",
    "per_unit_price": "price_per_unit",
    "in_stock": "in_stock",
    "stock_remaining": "stock_remaining",
    "num_ordered": "units_ordered",
    "total_revenue": "revenue_inr",
    "delivery_time": "delivery_minutes",
    "rating": "rating",
    "hour": "hour_of_day",
    "is_weekend": "is_weekend",
    "is_peak_hour": "is_peak_hour",
    "month": "month",
    "weather": "weather",
    "is_raining": "is_raining",
    "seasonal_multiplier": "seasonal_factor",
    "bulk_discount": "bulk_discount_pct",
    "festival_demand": "festival_demand_mult",
}

# Columns of the raw feeds that the canonical table does not keep: pack label, weekday name.
FEED_A_DROPPED = ("pack_label", "weekday")
FEED_B_DROPPED = ("qty_label", "day_name")
FEED_C_DROPPED = ("pack_description", "day_of_week")

# Word that means "in stock" in the feeds that use words.
FEED_A_STOCK_WORD = "available"
FEED_B_STOCK_WORD = "yes"

RAW_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# --- Fixed values: calendar and season ----------------------------------------------------

# (first hour, last hour, factor), both hours inclusive; any other hour has factor 1.0.
TIME_BANDS = ((8, 10, 1.35), (12, 14, 1.20), (18, 21, 1.45), (22, 23, 1.60), (0, 6, 1.60))
PEAK_ABOVE = 1.1

# (month, label, probability of rain, delivery delay factor)
WEATHER_BY_MONTH = (
    (1, "Clear", 0.05, 1.00),
    (2, "Clear", 0.05, 1.00),
    (3, "Partly Cloudy", 0.10, 1.02),
    (4, "Hot", 0.15, 1.05),
    (5, "Hot", 0.20, 1.05),
    (6, "Rainy", 0.75, 1.30),
    (7, "Rainy", 0.85, 1.35),
    (8, "Rainy", 0.80, 1.30),
    (9, "Rainy", 0.60, 1.20),
    (10, "Partly Cloudy", 0.30, 1.10),
    (11, "Clear", 0.10, 1.02),
    (12, "Clear", 0.05, 1.00),
)

# (month, day, demand factor, price factor, days)
FESTIVALS = (
    (1, 1, 1.8, 1.15, 3),
    (3, 8, 1.6, 1.10, 2),
    (3, 25, 1.4, 1.05, 60),
    (10, 24, 2.2, 1.20, 5),
    (12, 25, 1.5, 1.12, 3),
)

# product -> price factor for January..December; products not listed have 1.0.
SEASONAL_FACTORS = {
    "Mango": (1.8, 1.6, 1.2, 0.7, 0.6, 0.65, 1.0, 1.3, 1.5, 1.6, 1.7, 1.9),
    "Tomato": (1.4, 1.1, 0.9, 0.8, 0.9, 1.0, 1.1, 1.0, 1.0, 1.1, 1.4, 1.5),
    "Onion": (1.0, 0.9, 0.9, 0.8, 0.9, 1.0, 1.1, 1.2, 1.5, 1.4, 1.3, 1.1),
}

WEEKEND_PREMIUM = 1.04
WEEKEND_PREMIUM_HOURS = (8, 11)
WEEKEND_PREMIUM_CATEGORIES = ("Dairy", "Staples")
WEEKEND_DELAY = 1.15
BULK_STEP = 0.05
BULK_FLOOR = 0.90

# --- Fixed values: bounds and thresholds --------------------------------------------------

RATING_RANGE = (1.0, 5.0)
DELIVERY_RANGE = (7, 60)
DISCOUNT_STEPS = (0, 5, 10, 15, 20)
TREND_UP = 1.10
TREND_DOWN = 0.90
DEFAULT_WEIGHTS = (50, 30, 20)
DEFAULT_AVAILABILITY = 0.85
RETENTION_DAYS = {"raw": 30, "processed": 180, "curated": 365}
SAMPLE_ROWS = 500
TRAIN_MONTHS = (4, 5)
TEST_MONTH = 6
STOCKOUT_HOURS = (12, 24)
SLOT_MINUTES = 15

# --- Fixed values: wording of questions and answers ---------------------------------------

# Intent -> patterns, tried in this order; {platforms} stands for the platform names.
INTENT_PATTERNS = {
    "find_cheapest": (
        r"cheap(?:est)?",
        r"lowest?\s*price",
        r"best\s*(?:price|deal|offer)",
        r"where.*cheap",
        r"affordable",
        r"budget",
    ),
    "check_delivery": (
        r"fast(?:est)?",
        r"quick(?:est)?",
        r"deliver(?:y)?\s*time",
        r"eta",
        r"how\s*(?:fast|quick|long)",
        r"speed",
        r"soonest",
    ),
    "trending": (
        r"trend(?:ing)?",
        r"popular",
        r"hot\s*(?:products?|items?)?",
        r"what.*(?:popular|trending|hot)",
        r"top\s*(?:products?|items?|selling)",
    ),
    "compare": (
        r"compar(?:e|ison)",
        r"(?:{platforms}).*(?:vs|versus|and|or).*(?:{platforms})",
        r"side\s*by\s*side",
        r"difference\s*between",
    ),
    "recommend": (
        r"recommend",
        r"suggest",
        r"which\s*(?:platform|app|one)",
        r"where\s*(?:should|can|to)\s*(?:i|we)",
        r"best\s*(?:platform|app|option|place)",
        r"order\s*from",
    ),
}
DEFAULT_INTENT = "recommend"
PACK_PATTERN = r"(\d+)\s*(?:ml|g|gm|gram|liter|litre|kg|pcs|tabs|pieces)"
# Spelled unit -> unit in which packs are compared, and how many of it one is.
PACK_UNITS = {
    "g": ("g", 1), "gm": ("g", 1), "gram": ("g", 1), "kg": ("g", 1000),
    "ml": ("ml", 1), "l": ("ml", 1000), "liter": ("ml", 1000), "litre": ("ml", 1000),
    "pcs": ("pcs", 1), "pieces": ("pcs", 1), "tabs": ("tabs", 1),
}

ANSWER_FOUND = (
    "For {product}{pack} in {location}, {platform} is the best option — "
    "₹{price}, {minutes}-minute delivery, rated {rating}/5."
)
ANSWER_CHEAPER = " However, {platform} has the lowest price at ₹{price}."
ANSWER_NONE = "Sorry, I couldn't find data for {product}."

# --- Fixed values: model settings ---------------------------------------------------------

DEMAND_MODEL = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1}
TREND_MODEL = {"numTrees": 100, "maxDepth": 8}
DEMAND_FEATURES = (
    "platform_idx", "category_idx", "product_idx", "weather_idx",
    "hour_of_day", "day_of_week", "month", "pack_size",
    "effective_price", "mrp", "price_per_unit", "discount_pct",
    "delivery_minutes", "rating", "seasonal_factor",
    "bulk_discount_pct", "festival_demand_mult",
    "is_weekend_int", "is_peak_hour_int", "is_raining_int", "in_stock_int",
    "stock_remaining",
)
TREND_FEATURES = (
    "platform_idx", "category_idx", "month",
    "daily_demand", "daily_avg_price", "rolling_avg_7d",
)
FORECAST_HORIZON_HOURS = 24
DEMAND_MODEL_VERSION = "gbt_v1"
SEED = 42
