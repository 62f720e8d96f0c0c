"""Names and numbers that define the data contract."""

# Canonical field -> accepted spellings (compared in lower case).
FIELD_SPELLINGS = {
    "country": ("country",),
    "customer_id": ("customer_id",),
    "invoice": ("invoice",),
    "price": ("price", "total_price"),
    "stream_id": ("stream_id", "streamid"),
    "times_viewed": ("times_viewed", "timesviewed"),
    "year": ("year",),
    "month": ("month",),
    "day": ("day",),
}
REQUIRED_FIELDS = tuple(FIELD_SPELLINGS)

# Labels that are not markets, and the home market.
NON_MARKET_LABELS = ("unspecified", "european community")
HOME_MARKET = "United Kingdom"

# Forecasting task.
HORIZON_DAYS = 30
TRAILING_WINDOWS = (7, 14, 28, 70)
DAILY_METRICS = ("revenue", "purchases", "unique_streams", "unique_customers", "total_views")
TOP_MARKETS = 10
MIN_TRAINING_ROWS = 20
HOLDOUT_SHARE = 0.2
MIN_HOLDOUT_ROWS = 40
CV_FOLDS = 4
DRIFT_THRESHOLD = 3.0
MODEL_SEED = 42

OVERALL = "overall"
INVOICE_PATTERN = "invoices-*.json"

# Key of an exact duplicate line.
LINE_KEY = ("country", "customer_id", "invoice", "stream_id", "price", "times_viewed", "date")

TRANSACTION_COLUMNS = (
    "date", "year", "month", "day", "country", "customer_id", "invoice", "invoice_prefix",
    "invoice_clean", "stream_id", "price", "times_viewed", "source_file",
)
