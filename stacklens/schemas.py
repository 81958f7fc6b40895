"""Table schemas and value domains."""

from pyspark.sql import types as T

LOANS = T.StructType([
    T.StructField("patron_id", T.StringType()),
    T.StructField("book_id", T.StringType()),
    T.StructField("book_title", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("checkout_date", T.TimestampType()),
    T.StructField("return_date", T.TimestampType()),
    T.StructField("loan_status", T.StringType()),
    T.StructField("loan_duration_days", T.IntegerType()),
    T.StructField("times_renewed", T.IntegerType()),
    T.StructField("patron_age_group", T.StringType()),
    T.StructField("patron_membership_type", T.StringType()),
])

POS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("patron_id", T.StringType()),
    T.StructField("transaction_date", T.TimestampType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("items_purchased", T.IntegerType()),
])

ACTIVITY = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("patron_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("book_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("event_metadata", T.StringType()),
])

# The value domains of the three sources.
LOAN_STATUSES = ["returned", "overdue", "lost"]
AGE_GROUPS = ["18-25", "26-35", "36-50", "51-65", "65+"]
MEMBERSHIP_TYPES = ["basic", "standard", "premium"]
TRANSACTION_TYPES = ["cafe", "merchandise", "printing", "event_ticket", "donation"]
PAYMENT_METHODS = ["card", "cash", "mobile"]
EVENT_TYPES = [
    "book_search", "book_view", "wishlist_add", "wishlist_remove", "reservation_made",
    "reservation_cancel", "review_submitted", "session_start", "session_end",
]
DEVICE_TYPES = ["desktop", "mobile", "tablet"]
SEASONS = ["fall", "spring", "summer", "winter"]
TIMES_OF_DAY = ["afternoon", "evening", "morning"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
METADATA_KEYS = ["query_length", "results_shown", "rating", "review_length_words", "session_duration_minutes"]

METADATA = T.MapType(T.StringType(), T.IntegerType())


class SchemaError(ValueError):
    """A table lacks required columns or holds rows its contract forbids."""
