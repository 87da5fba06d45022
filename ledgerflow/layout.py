"""Fixed values of the data model: columns, contracts and code lists."""

# --- fixed values -----------------------------------------------------------
PAYMENT_COLUMNS = [
    "transaction_id",
    "merchant_id",
    "customer_id",
    "customer_email",
    "customer_phone",
    "amount",
    "currency",
    "status",
    "transaction_ts",
    "payment_method",
    "card_last4",
    "gateway_ref",
]

MERCHANT_COLUMNS = [
    "merchant_id",
    "merchant_name",
    "merchant_category",
    "country",
    "onboarding_date",
    "is_active",
    "settlement_currency",
]

# Added by the library and never part of the record hash.
METADATA_COLUMNS = ["ingest_ts", "ingest_run_id", "source_file", "record_hash"]

# Personal data: kept in the audit table, never selected by a report.
PERSONAL_COLUMNS = ["customer_id", "customer_email", "customer_phone"]

DAILY_SUMMARY_COLUMNS = [
    "event_date",
    "merchant_id",
    "merchant_name",
    "merchant_category",
    "currency",
    "status",
    "transaction_count",
    "total_amount",
    "avg_amount",
    "max_amount",
    "merchant_daily_approval_rate",
]

PERFORMANCE_KEY_COLUMNS = ["snapshot_date", "merchant_id", "merchant_name"]
PERFORMANCE_MEASURES = [
    "total_transactions",
    "total_approved_amount",
    "merchant_daily_approval_rate",
    "reversal_rate",
    "active_days",
]

STATUSES = ["APPROVED", "DECLINED", "PENDING", "REVERSED", "REFUNDED", "FAILED"]
PAYMENT_METHODS = ["CARD", "BANK_TRANSFER", "WALLET", "DIRECT_DEBIT"]

APPROVED = "APPROVED"
REVERSED = "REVERSED"
CARD = "CARD"
APPROVAL_DENOMINATOR = ("APPROVED", "DECLINED")
WINDOW_DAYS = 7
# ----------------------------------------------------------------------------


def performance_columns(window_days: int) -> list[str]:
    """Column contract of the N-day merchant table."""
    return PERFORMANCE_KEY_COLUMNS + [f"{m}_{window_days}d" for m in PERFORMANCE_MEASURES]


# Types of the stored tables, as Spark DDL. Extra columns of evolved
# deliveries are nullable strings next to these.
BRONZE_PAYMENTS_DDL = (
    "transaction_id string, merchant_id string, customer_id string, customer_email string, "
    "customer_phone string, amount double, currency string, status string, "
    "transaction_ts timestamp, payment_method string, card_last4 string, gateway_ref string, "
    "record_hash string, ingest_ts timestamp, ingest_run_id string, source_file string, "
    "event_date string"
)

BRONZE_MERCHANTS_DDL = (
    "merchant_id string, merchant_name string, merchant_category string, country string, "
    "onboarding_date date, is_active boolean, settlement_currency string, "
    "record_hash string, ingest_ts timestamp, ingest_run_id string, source_file string"
)

DAILY_SUMMARY_DDL = (
    "event_date string, merchant_id string, merchant_name string, merchant_category string, "
    "currency string, status string, transaction_count bigint, total_amount double, "
    "avg_amount double, max_amount double, merchant_daily_approval_rate double"
)


def performance_ddl(window_days: int) -> str:
    """Types of the N-day merchant table."""
    types = ["string", "string", "string", "bigint", "double", "double", "double", "bigint"]
    return ", ".join(f"{c} {t}" for c, t in zip(performance_columns(window_days), types))
