"""Tables and constants that results depend on."""

# Dated events as (name, type, day), 2011 to 2016.
EVENTS = [
    ("SuperBowl", "Sporting", "2011-02-06"),
    ("SuperBowl", "Sporting", "2012-02-05"),
    ("SuperBowl", "Sporting", "2013-02-03"),
    ("SuperBowl", "Sporting", "2014-02-02"),
    ("SuperBowl", "Sporting", "2015-02-01"),
    ("SuperBowl", "Sporting", "2016-02-07"),
    ("ValentinesDay", "Cultural", "2011-02-14"),
    ("ValentinesDay", "Cultural", "2012-02-14"),
    ("ValentinesDay", "Cultural", "2013-02-14"),
    ("ValentinesDay", "Cultural", "2014-02-14"),
    ("ValentinesDay", "Cultural", "2015-02-14"),
    ("ValentinesDay", "Cultural", "2016-02-14"),
    ("Easter", "Religious", "2011-04-24"),
    ("Easter", "Religious", "2012-04-08"),
    ("Easter", "Religious", "2013-03-31"),
    ("Easter", "Religious", "2014-04-20"),
    ("Easter", "Religious", "2015-04-05"),
    ("Easter", "Religious", "2016-03-27"),
    ("MotherDay", "Cultural", "2011-05-08"),
    ("MotherDay", "Cultural", "2012-05-13"),
    ("MotherDay", "Cultural", "2013-05-12"),
    ("MotherDay", "Cultural", "2014-05-11"),
    ("MotherDay", "Cultural", "2015-05-10"),
    ("MotherDay", "Cultural", "2016-05-08"),
    ("Halloween", "Cultural", "2011-10-31"),
    ("Halloween", "Cultural", "2012-10-31"),
    ("Halloween", "Cultural", "2013-10-31"),
    ("Halloween", "Cultural", "2014-10-31"),
    ("Halloween", "Cultural", "2015-10-31"),
    ("Thanksgiving", "National", "2011-11-24"),
    ("Thanksgiving", "National", "2012-11-22"),
    ("Thanksgiving", "National", "2013-11-28"),
    ("Thanksgiving", "National", "2014-11-27"),
    ("Thanksgiving", "National", "2015-11-26"),
    ("Christmas", "National", "2011-12-25"),
    ("Christmas", "National", "2012-12-25"),
    ("Christmas", "National", "2013-12-25"),
    ("Christmas", "National", "2014-12-25"),
    ("Christmas", "National", "2015-12-25"),
]

# Days before and after a holiday that belong to it.
HOLIDAY_WINDOWS = {
    "SuperBowl": (-1, 1),
    "Thanksgiving": (-2, 0),
    "Christmas": (-7, 0),
}

# Last day of the month on which each state's benefit is paid.
SNAP_LAST_DAY = {"snap_CA": 6, "snap_TX": 7, "snap_WI": 8}

# Which calendar flag belongs to which state.
SNAP_STATES = {"CA": "snap_CA", "TX": "snap_TX", "WI": "snap_WI"}

# Key columns of a series, most detailed first.
ID_COLUMNS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]

# Calendar columns carried into the panel.
CALENDAR_COLUMNS = [
    "d", "date", "wm_yr_wk", "weekday", "wday", "month", "year",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2",
    "snap_CA", "snap_TX", "snap_WI",
]

# Columns that are label-encoded.
ENCODED_COLUMNS = [
    "item_id", "dept_id", "cat_id", "store_id", "state_id",
    "weekday", "event_name_1", "event_type_1",
]

# Lags, windows and horizons in days.
LAGS = [7, 14, 28, 35, 42]
WINDOWS = [7, 14, 28, 56]
ROLLING_LAG = 28
HORIZON = 28
PRICE_LAGS = [1, 7, 28]

# Model inputs.
FEATURES = [
    "day_of_week", "day_of_month", "day_of_year", "week_of_year",
    "month", "quarter", "year", "is_weekend",
    "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end",
    "sin_day_year", "cos_day_year", "sin_day_week", "cos_day_week",
    "has_event", "snap",
    "item_id", "dept_id", "cat_id", "store_id", "state_id",
    "sales_lag_7", "sales_lag_14", "sales_lag_28", "sales_lag_35", "sales_lag_42",
    "rolling_mean_7", "rolling_mean_14", "rolling_mean_28", "rolling_mean_56",
    "rolling_std_7", "rolling_std_14", "rolling_std_28", "rolling_std_56",
    "sell_price", "price_roll_mean_28", "price_change", "price_relative", "price_discount",
    "store_daily_mean", "dept_daily_mean",
]

# Hierarchy levels and the keys each keeps besides the date.
LEVELS = {
    "item_store": ["id"],
    "item": ["item_id"],
    "dept_store": ["dept_id", "store_id"],
    "dept": ["dept_id"],
    "cat_store": ["cat_id", "store_id"],
    "cat": ["cat_id"],
    "store": ["store_id"],
    "state": ["state_id"],
    "total": [],
}

# Levels over which the multi-level scaled error is averaged.
SCORED_LEVELS = ["item_store", "item", "dept", "cat", "store", "total"]

# First family whose words occur in a feature name wins.
FEATURE_FAMILIES = [
    ("lag", ["lag"]),
    ("rolling", ["rolling"]),
    ("price", ["price"]),
    ("calendar", ["sin", "cos", "day", "week", "month", "year", "quarter"]),
    ("id", ["store", "cat", "dept", "item", "state"]),
]

# Days of the week in display order.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Defaults of the boosted Tweedie model.
TWEEDIE_POWER = 1.1
BOOSTING_DEFAULTS = {
    "rounds": 1000,
    "learning_rate": 0.05,
    "max_depth": 7,
    "min_rows_per_leaf": 20,
    "feature_fraction": 0.80,
    "bagging_fraction": 0.85,
    "l2": 0.1,
}

# Defaults of the seasonal model.
SEASONAL_DEFAULTS = {
    "yearly_order": 10,
    "weekly_order": 3,
    "changepoints": 25,
    "changepoint_range": 0.8,
    "changepoint_prior": 0.05,
    "seasonality_prior": 10.0,
    "holiday_prior": 10.0,
    "interval_z": 1.2816,
    "min_days": 60,
}
