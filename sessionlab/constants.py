"""Fixed values of the session data model.

These names, orders and thresholds must equal those of the original analysis
for the outputs to line up, so they are stated here once, plainly.
"""

# --- fixed values -----------------------------------------------------------
# Raw event columns, in file order.
RAW_COLUMNS = [
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
]

# Event vocabulary.
VIEW = "view"
CART = "cart"
REMOVE = "remove_from_cart"
PURCHASE = "purchase"

# The 14 model features, in canonical order.
FEATURE_COLS = [
    "n_view",
    "n_cart",
    "n_remove",
    "n_events",
    "cart_to_view_ratio",
    "remove_to_cart_ratio",
    "avg_price",
    "max_price",
    "min_price",
    "price_std",
    "unique_products",
    "unique_categories",
    "has_brand",
    "session_duration_sec",
]

# Features drawn as log1p histograms in the exploration step (60 bins).
HIST_FEATURES = [
    "n_events",
    "n_view",
    "n_cart",
    "avg_price",
    "session_duration_sec",
    "cart_to_view_ratio",
]
HIST_BINS = 60

# Features compared by class median in the exploration step.
MEDIAN_FEATURES = [
    "n_view",
    "n_cart",
    "n_remove",
    "cart_to_view_ratio",
    "unique_products",
    "session_duration_sec",
]

# Split and model settings.
RANDOM_STATE = 42
TEST_SIZE = 0.2
N_FOLDS = 5
THRESHOLD = 0.5

# Audit thresholds.
MAX_UNIVARIATE_AUC = 0.99
MAX_DECILE_PURITY = 0.95
DECILES = 10
OUTLIER_QUANTILE = 0.999
WEIGHT_RATIO_BOUNDS = (3.0, 10.0)
CV_MAX_STD_F1 = 0.02
CV_MAX_STD_AUC = 0.01
CV_MAX_STD_MACRO = 0.02
CV_MAX_STD_WEIGHTED = 0.02
# The class dropped from the session tables.
DEFAULT_DROP_CATEGORIES = ("sport",)

# Session table schema (name, Spark SQL type) in output order.
SESSION_COLUMNS = [
    ("user_session", "string"),
    ("user_id", "bigint"),
    ("n_view", "int"),
    ("n_cart", "int"),
    ("n_remove", "int"),
    ("n_events", "int"),
    ("avg_price", "float"),
    ("max_price", "float"),
    ("min_price", "float"),
    ("price_std", "float"),
    ("unique_products", "int"),
    ("unique_categories", "int"),
    ("has_brand", "tinyint"),
    ("session_duration_sec", "float"),
    ("purchased", "tinyint"),
    ("main_cat", "string"),
]
COUNT_COLS = ["n_view", "n_cart", "n_remove", "n_events", "unique_products", "unique_categories"]
FLOAT_COLS = ["avg_price", "max_price", "min_price", "price_std", "session_duration_sec"]
# ---------------------------------------------------------------------------
