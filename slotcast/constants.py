"""Fixed values. Results depend on them, so they are stated here once, as plain text."""

# --- fixed values: slot ring (0 = Monday 00:00) ---
MINUTES_PER_SLOT = 15
SLOTS_PER_HOUR = 4
HOURS_PER_DAY = 24
SLOTS_PER_DAY = 96
SLOTS_PER_WEEK = 672

# --- fixed values: hours in which an item may be made, [start, end) ---
AVAILABLE_HOURS = {
    "breakfast": (4, 12),
    "lunch": (10, 22),
    "all_day": (0, 24),
    "chicken": (9, 22),
}

# --- fixed values: opening hours text of stores that close at night, open in [5, 23) ---
LIMITED_HOURS = "5am-11pm"
LIMITED_OPEN_HOUR = 5
LIMITED_CLOSE_HOUR = 23

# --- fixed values: relative traffic by hour of day, 0..23 ---
RUSH_CURVE = (
    0.05, 0.02, 0.02, 0.02, 0.05, 0.15,
    0.50, 0.85, 0.95, 0.75, 0.40, 0.65,
    1.0, 0.85, 0.35, 0.30, 0.60, 0.90,
    0.80, 0.60, 0.35, 0.20, 0.10, 0.07,
)
RUSH_THRESHOLD = 0.6

# --- fixed values: routing ---
ESTABLISHED_DAYS = 14

# --- fixed values: weather effect on demand ---
HOT_ABOVE_F = 70.0
COLD_BELOW_F = 55.0
NEUTRAL_TEMP_F = 62.5
NEUTRAL_PRECIP = 0
PRECIP_FACTOR = 0.70
# category -> (factor when hot, factor when cold); other categories 1.0
TEMPERATURE_FACTORS = {
    "chicken": (2.2, 1.0),
    "roller_grill": (2.2, 0.4),
    "sandwich": (0.45, 1.9),
    "side": (0.45, 1.9),
}

# --- fixed values: category lists of the live read-outs ---
QUEUES = {
    "Kitchen": ("sandwich", "roller_grill", "side"),
    "Chicken": ("chicken", "appetizer"),
}
KPI_GROUPS = {
    "hot_foods": ("sandwich", "side"),
    "roller_grill": ("roller_grill",),
    "chicken": ("chicken", "appetizer"),
}

# --- fixed values: forecast model ---
FEATURE_COLUMNS = (
    "store_id", "item_id", "sale_hour", "sale_minute", "slot_index", "day_of_week",
    "is_weekend", "avg_slot_quantity", "sample_size", "temp_f", "precip",
)
TREES = 300
LEARNING_RATE = 0.05
SEED = 42
TRAIN_FRACTION = 0.8
URGENCY_THRESHOLD = 2.0

# --- fixed values: scoring ---
ARMS = ("ml", "baseline")
ARM_METRICS = ("units_sold", "stockouts", "units_wasted", "waste_cost", "sales_revenue")

# Sums of predictions are rounded to so many digits before they become whole units, so that the
# order of summation does not decide ties.
SUM_DIGITS = 9

# Rows of a narrow frame that a join may broadcast, at some tens of bytes each.
BROADCAST_ROWS = 500_000
